"""Batch inference in Arrow workers: models loaded once, failures kept to their row.

A model is any object with call(list of inputs) -> list of outputs. Models that can't run here (there are no weights)
are stood in for by deterministic stubs, named as such; their scores say nothing about any voice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import col

REGISTRY: dict[str, Callable[[], object]] = {}
_loaded: dict[str, object] = {}
#: Characters of an error's text that are kept.
ERROR_TEXT = 200


def register(name: str):
    """Decorator: makes a loader known by name."""

    def put(loader: Callable[[], object]):
        REGISTRY[name] = loader
        return loader

    return put


def names() -> list[str]:
    return sorted(REGISTRY)


def model(name: str):
    """The worker's instance of a model, loaded on first use; an unknown name is an error that lists the known ones."""
    if name not in REGISTRY:
        raise KeyError(f"unknown model {name!r} (have: {', '.join(names())})")
    if name not in _loaded:
        _loaded[name] = REGISTRY[name]()
    return _loaded[name]


def isolated(call: Callable[[list], Sequence], inputs: list) -> list[tuple[object, str | None]]:
    """(value, error) of each input: the batch as a whole, or, if that fails, one by one."""
    try:
        values = list(call(inputs))
        if len(values) != len(inputs):
            raise ValueError(f"{len(values)} results for {len(inputs)} inputs")
        return [(v, None) for v in values]
    except Exception:  # noqa: BLE001
        out: list[tuple[object, str | None]] = []
        for x in inputs:
            try:
                out.append((call([x])[0], None))
            except Exception as e:  # noqa: BLE001
                out.append((None, f"{type(e).__name__}: {str(e)[:ERROR_TEXT]}"))
        return out


def _key(name: str, loader: Callable[[], object]) -> str:
    """What a worker knows a loaded model by: its name and what loads it."""
    return f"{name}:{hashlib.md5(cloudpickle.dumps(loader)).hexdigest()}"


def infer(name: str, loader: Callable[[], object], value: Column, result: str, batch: int = 32) -> Column:
    """struct<value, error> of a model's output per row; null inputs give neither. Batches keep to batch inputs.

    The loader travels with the query, so workers need no registry of their own. A batch of 1 is a correctness setting
    for models whose padding changes results.
    """

    key = _key(name, loader)

    @F.pandas_udf(f"value {result}, error string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if key not in _loaded:
            _loaded[key] = loader()
        call = _loaded[key]
        for part in parts:
            values: list = [None] * len(part)
            errors: list = [None] * len(part)
            there = [i for i, x in enumerate(part) if x is not None]
            for at in range(0, len(there), batch):
                own = there[at : at + batch]
                for i, (v, e) in zip(own, isolated(call, [part.iloc[k] for k in own])):
                    values[i], errors[i] = v, e
            yield pd.DataFrame({"value": pd.Series(values, dtype=object), "error": pd.Series(errors, dtype=object)})

    return run(value)


class StubRecogniser:
    """Says the text again, but for every word whose hash is low; refuses texts without letters."""

    def __init__(self, seed: str = "stub"):
        self.seed = seed

    def __call__(self, texts: list[str]) -> list[str]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> str:
        if not any(c.isalpha() for c in text):
            raise ValueError("nothing to hear")
        kept = [w for i, w in enumerate(text.split()) if hashlib.md5(f"{self.seed}:{i}:{w}".encode()).digest()[0] >= 16]
        return " ".join(kept)


class StubJudge:
    """A number in 1..5 from a hash of the text."""

    def __call__(self, texts: list[str]) -> list[float]:
        return [1 + 4 * hashlib.md5(t.encode()).digest()[0] / 255 for t in texts]


class StubListener:
    """Transcribes a waveform: one of eight syllables a quarter of a second, by its loudness; refuses silence."""

    SYLLABLES = ("ba", "de", "gi", "lo", "mu", "na", "re", "ti")

    def __call__(self, waves: list) -> list[str]:
        return [self._one(np.asarray(w, np.float64)) for w in waves]

    def _one(self, wave: np.ndarray) -> str:
        if not np.abs(wave).max(initial=0.0) > 0:
            raise ValueError("nothing to hear")
        blocks = [wave[i : i + 4000] for i in range(0, len(wave), 4000)]
        return " ".join(self.SYLLABLES[int(1000 * np.sqrt(np.mean(b * b))) % 8] for b in blocks)


class StubEncoder:
    """A unit vector of 16 band energies; takes one clip a call, as padding would reach the pooling of a real encoder."""

    def __call__(self, waves: list) -> list[list[float]]:
        if len(waves) != 1:
            raise ValueError("an encoder takes one clip at a time")
        bands = np.array([np.abs(b).sum() for b in np.array_split(np.fft.rfft(np.asarray(waves[0], np.float64)), 16)])
        length = np.sqrt(bands @ bands)
        if not length > 0:
            raise ValueError("silence has no direction")
        return [(bands / length).tolist()]


def stub_mos(name: str, key: str) -> float:
    """A number in 1..5 from a hash of a score's name and a clip's key."""
    return 1 + 4 * hashlib.md5(f"{name}:{key}".encode()).digest()[0] / 255


# The judges and the scores that each gives.
JUDGES = {"dnsmos": ("dnsmos_ovrl", "dnsmos_sig", "dnsmos_bak", "dnsmos_p808"), "utmos": ("utmos",), "nisqa": ("nisqa_mos", "nisqa_noi", "nisqa_dis", "nisqa_col", "nisqa_loud")}
SCORES = tuple(s for names_ in JUDGES.values() for s in names_)


class StubScores:
    """The scores of one judge for a list of inputs, by a hash of each."""

    def __init__(self, judge: str):
        self.scores = JUDGES[judge]

    def __call__(self, inputs: list) -> list[list[float]]:
        return [[stub_mos(s, x if isinstance(x, str) else np.asarray(x, np.float32).tobytes().hex()) for s in self.scores] for x in inputs]


def judged_scores(inputs: dict[str, Column], loaders: dict[str, Callable[[], object]], chunk: int = 128) -> Column:
    """struct of SCORES, null where a judge has none.

    inputs and loaders by judge. dnsmos is asked clip by clip, so a failure costs its row's scores; utmos judges a chunk
    together, cut to the same length, so a failure costs the chunk's; nisqa is asked for a chunk and, if that fails, clip
    by clip, and a clip of which all its scores are 0 is one that it couldn't score.
    """
    asked = [j for j in JUDGES if j in inputs]
    keys = {j: _key(j, loaders[j]) for j in asked}

    @F.pandas_udf(", ".join(f"{s} double" for s in SCORES))
    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for j in asked:
            if keys[j] not in _loaded:
                _loaded[keys[j]] = loaders[j]()
        for part in parts:
            n = len(part[0])
            out = {s: np.full(n, np.nan) for s in SCORES}
            for j, series in zip(asked, part):
                there = [i for i, x in enumerate(series) if x is not None]
                for at in range(0, len(there), chunk):
                    own = there[at : at + chunk]
                    clips = [series.iloc[i] for i in own]
                    call = _loaded[keys[j]]
                    if j == "utmos":
                        try:
                            values = list(call(clips))
                        except Exception:  # noqa: BLE001
                            values = [None] * len(own)
                    elif j == "dnsmos":
                        values = [isolated(call, [x])[0][0] for x in clips]
                    else:
                        values = [v for v, _ in isolated(call, clips)]
                        values = [None if v is not None and not any(v) else v for v in values]
                    for i, v in zip(own, values):
                        for s, x in zip(JUDGES[j], v or ()):
                            out[s][i] = x
            yield pd.DataFrame(out)

    scores = run(*(inputs[j] for j in asked))
    return F.struct(*(F.when(~F.isnan(scores[s]), scores[s]).alias(s) for s in SCORES))


register("stub_recogniser")(StubRecogniser)
register("stub_judge")(StubJudge)
register("stub_listener")(StubListener)
register("stub_encoder")(StubEncoder)


def transcribed(df: DataFrame, text: str, batch: int = 16) -> DataFrame:
    """df with hyp and failure of the stub recogniser."""
    return df.withColumn("_r", infer("stub_recogniser", StubRecogniser, col(text), "string", batch)).select(
        "*", F.col("_r.value").alias("hyp"), F.col("_r.error").alias("failure")
    ).drop("_r")


def judged(df: DataFrame, text: str, batch: int = 32) -> DataFrame:
    return df.withColumn("_j", infer("stub_judge", StubJudge, col(text), "double", batch)).select("*", F.col("_j.value").alias("mos")).drop("_j")
