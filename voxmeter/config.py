"""Settings of an evaluation, read from YAML (or JSON) and checked as a whole before anything runs."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from .functions.text import Normalization

# Modes that a setting may have.
DEVICES = ("auto", "cuda", "cpu")
VOICE_TYPES = ("per_row", "fixed_file")
RESAMPLERS = ("soxr_qq", "soxr_lq", "soxr_mq", "soxr_hq", "soxr_vhq")
RECOGNISERS = {"whisper": None, "mms": None, "gigaam": ("ky",), "elevenlabs": None}
ENCODERS = ("wavlm_ft", "ecapa", "wavlm_sv")
DEFAULT_COLUMNS = {"key": "utt", "audio": "audio", "text": "text", "duration": "gen_dur", "latency": "latency_s", "model": "model_id", "voice": "ref_voice"}


class ConfigError(ValueError):
    """All that is wrong with a configuration, a problem a line."""


@dataclass(frozen=True)
class Voice:
    name: str
    type: str
    column: str | None = None
    path: str | None = None


@dataclass(frozen=True)
class Recogniser:
    name: str
    enabled: bool
    options: dict[str, Any] = field(default_factory=dict)

    def covers(self, lang: str) -> bool:
        only = RECOGNISERS.get(self.name)
        return only is None or lang in only


@dataclass(frozen=True)
class Config:
    name: str
    languages: tuple[str, ...]
    benchmark: str
    synthesis: str
    columns: dict[str, str]
    include: tuple[str, ...] | None
    exclude: tuple[str, ...]
    voices: dict[str, Voice]
    normalization: Normalization
    primary: dict[str, str]
    recognisers: dict[str, Recogniser]
    encoders: tuple[str, ...]
    output: str = "results"
    cache: str = ".cache/voxmeter"
    seed: int = 20260725
    resume: bool = True
    replicates: int = 2000
    confidence: float = 0.95
    cluster: str = "speaker_id"
    catastrophic: float = 0.5
    runaway: float = 2.0
    truncated: float = 0.5
    publish: str | None = None

    def voice(self, name: str) -> Voice:
        """A subset's voice; an unknown one is an error unless a default is set."""
        if name in self.voices:
            return self.voices[name]
        if "default" in self.voices:
            return self.voices["default"]
        raise ConfigError(f"voices: no entry for {name!r} and no default")

    def recognisers_for(self, lang: str) -> list[Recogniser]:
        return [r for r in self.recognisers.values() if r.enabled and r.covers(lang)]

    def primary_for(self, lang: str) -> str:
        if lang not in self.primary:
            raise ConfigError(f"asr.primary: none for {lang!r}")
        return self.primary[lang]


class _Reader:
    """Takes typed values out of nested mappings and notes every problem instead of stopping at the first."""

    def __init__(self, raw: dict, problems: list[str]):
        self.raw, self.problems = raw, problems

    def get(self, path: str, default: Any = None, kind: type | tuple | None = None, required: bool = False) -> Any:
        at: Any = self.raw
        for part in path.split("."):
            at = at.get(part) if isinstance(at, dict) else None
        if at is None:
            if required:
                self.problems.append(f"{path}: missing")
            return default
        if kind and not isinstance(at, kind):
            self.problems.append(f"{path}: expected {kind}, got {type(at).__name__}")
            return default
        return at

    def one_of(self, path: str, allowed: tuple, default: Any) -> Any:
        v = self.get(path, default)
        if v not in allowed:
            self.problems.append(f"{path}: {v!r} is not one of {', '.join(map(str, allowed))}")
        return v

    def refuse(self, path: str, why: str) -> None:
        if self.get(path) is not None:
            self.problems.append(f"{path}: {why}")


def parse(raw: dict) -> Config:
    """A configuration from nested mappings; raises one ConfigError with all problems."""
    problems: list[str] = []
    r = _Reader(raw, problems)
    r.one_of("run.device", DEVICES, "auto")
    r.one_of("audio.resampler", RESAMPLERS, "soxr_hq")
    r.one_of("stats.aggregation", ("corpus",), "corpus")
    r.one_of("sim.calibration.fixed_file_voices.anchor.method", ("intra_session",), "intra_session")
    if r.get("sim.batch", 1) != 1:
        problems.append("sim.batch: must be 1, padding a batch changes the embeddings")
    r.refuse("sim.max_duration_sec", "clips are embedded whole")
    languages = tuple(r.get("benchmark.languages", [], list, required=True))
    voices = {}
    for name, v in r.get("voices", {}, dict).items():
        kind = (v or {}).get("type")
        if kind not in VOICE_TYPES:
            problems.append(f"voices.{name}.type: {kind!r} is not one of {', '.join(VOICE_TYPES)}")
        needs = "column" if kind == "per_row" else "path"
        if kind in VOICE_TYPES and not v.get(needs):
            problems.append(f"voices.{name}.{needs}: missing")
        voices[name] = Voice(name, kind, (v or {}).get("column"), (v or {}).get("path"))
    engines = {}
    for name, e in r.get("asr.engines", {}, dict).items():
        e = dict(e or {})
        if "languages" in e:
            problems.append(f"asr.engines.{name}.languages: coverage belongs to the recogniser")
        if name not in RECOGNISERS:
            problems.append(f"asr.engines.{name}: unknown (have: {', '.join(sorted(RECOGNISERS))})")
        engines[name] = Recogniser(name, bool(e.pop("enabled", True)), e)
        key = engines[name].options.get("api_key_env")
        if engines[name].enabled and key and not os.environ.get(key):
            problems.append(f"asr.engines.{name}: ${key} is not set")
    primary = {str(k): str(v) for k, v in r.get("asr.primary", {}, dict).items()}
    for lang in languages:
        own = engines.get(primary.get(lang, ""))
        if lang not in primary:
            problems.append(f"asr.primary: none for {lang!r}")
        elif own is None or not own.enabled or not own.covers(lang):
            problems.append(f"asr.primary.{lang}: {primary[lang]!r} is undefined, disabled, or doesn't cover the language")
    encoders = tuple(r.get("sim.encoders", [], list))
    problems += [f"sim.encoders: unknown encoder {e!r}" for e in encoders if e not in ENCODERS] or ([] if encoders else ["sim.encoders: none"])
    t = r.get("text_normalization", {}, dict)
    try:
        normalization = Normalization(
            t.get("unicode_form", "NFC"), t.get("lowercase", True), t.get("expand_digits", True), tuple(t.get("expand_digits_skip_languages", ("ky",))),
            t.get("keep_apostrophes", True), t.get("fold_typographic_apostrophes", False), t.get("punctuation", Normalization().punctuation),
        )
    except ValueError as e:
        problems.append(f"text_normalization.unicode_form: {e}")
        normalization = Normalization()
    folder = r.get("report.push.folder")
    if folder is not None and (str(folder).startswith("/") or ".." in str(folder) or not str(folder).strip("/. ")):
        problems.append("report.push.folder: must be a folder below the root")
    confidence = r.get("stats.bootstrap.confidence", 0.95, (int, float))
    if not 0 < confidence < 1:
        problems.append("stats.bootstrap.confidence: must be between 0 and 1")
    include = r.get("synthesis.include", None, list)
    config = Config(
        name=str(r.get("run.name", "", required=True)), languages=languages,
        benchmark=str(r.get("benchmark.path", "", required=True)), synthesis=str(r.get("synthesis.path", "", required=True)),
        columns=DEFAULT_COLUMNS | r.get("synthesis.columns", {}, dict), include=None if include is None else tuple(include),
        exclude=tuple(r.get("synthesis.exclude", [], list)), voices=voices, normalization=normalization, primary=primary, recognisers=engines,
        encoders=encoders, output=str(r.get("run.output_dir", "results")), cache=str(r.get("run.cache_dir", ".cache/voxmeter")),
        seed=int(r.get("run.seed", 20260725)), resume=bool(r.get("run.resume", True)), replicates=int(r.get("stats.bootstrap.replicates", 2000)),
        confidence=float(confidence), cluster=str(r.get("stats.bootstrap.cluster_by", "speaker_id")),
        catastrophic=float(r.get("failure.catastrophic_wer", 0.5)), runaway=float(r.get("failure.runaway_duration_ratio", 2.0)),
        truncated=float(r.get("failure.min_duration_ratio", 0.5)), publish=folder,
    )
    if problems:
        raise ConfigError("the configuration can't be used:\n" + "\n".join(f"- {p}" for p in problems))
    return config


def load(path: str | Path) -> Config:
    text = Path(path).read_text()
    try:
        import yaml

        raw = yaml.safe_load(text)
    except ImportError:
        raw = json.loads(text)
    if not isinstance(raw, dict):
        raise ConfigError(f"{path}: the top level must be a mapping")
    return parse(raw)


def load_env(path: str | Path = ".env") -> list[str]:
    """Sets KEY=VALUE lines of a file that the environment doesn't have yet; returns their names."""
    out = []
    if Path(path).is_file():
        for line in Path(path).read_text().splitlines():
            key, sign, value = line.partition("=")
            key = key.strip()
            if sign and key and not key.startswith("#") and key not in os.environ:
                os.environ[key] = value.strip().strip("'\"")
                out.append(key)
    return out
