"""A run over audio files: recognition, similarity and naturalness, unit by unit, each result kept by its fingerprint.

A unit is one model on one subset; its fingerprint holds everything that decides its rows, so a changed setting computes
it again and a trial run never stands in for a full one. Within a unit everything is one plan: scan, decoding and
inference in Arrow batches, scores as expressions. Models are loaders by name; where none is given, labelled stubs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import __version__, infer
from .cache import ResultCache, Unit
from .config import Config, Recogniser
from .functions import audio, scoring, text, vectors
from .operators import similarity as sim
from .operators import stats
from .sources import discovery
from .sources.tables import present, required

# The shortest clips that each stage takes, samples at 16 kHz and seconds, and the rates of the judges.
MIN_HEARD, MIN_EMBEDDED, MIN_JUDGED_SECONDS, EMPTY_SECONDS = 160, 6400, 0.3, 0.3
CANONICAL_RATE, NATIVE_RATE, UTMOS_SECONDS = 16_000, 48_000, 3
CARRIED = ("speaker_id", "speaker_gender", "len_bin", "n_words", "prompt_dur_bin", "gt_dur")
STAGES = ("asr", "sim", "quality")
SCHEMA = 1


@dataclass(frozen=True)
class Subset:
    """One voice in one language and its file."""

    name: str
    lang: str
    voice: str
    path: str


def gates(seconds: Column) -> dict[str, Column]:
    """Counters of clips that are too short to be heard, embedded or judged, and of those that are as good as empty."""
    limits = {"n_too_short_to_hear": MIN_HEARD / CANONICAL_RATE, "n_too_short_to_embed": MIN_EMBEDDED / CANONICAL_RATE, "n_too_short_to_judge": MIN_JUDGED_SECONDS, "n_empty": EMPTY_SECONDS}
    return {n: F.count_if(seconds < x) for n, x in limits.items()}


@dataclass
class Run:
    """An evaluation by its settings. only: names of subsets; limit: the first so many clips of each by key."""

    spark: SparkSession
    config: Config
    only: Sequence[str] | None = None
    limit: int | None = None
    listeners: dict[str, Callable[[], object]] = field(default_factory=dict)
    encoders: dict[str, Callable[[], object]] = field(default_factory=dict)
    judges: dict[str, Callable[[], object]] = field(default_factory=dict)
    clips_per_voice: int | None = 10

    def __post_init__(self) -> None:
        self.cache = ResultCache(self.spark, self.config.cache, self.config.resume)

    # --- what there is to do

    def subsets(self) -> list[Subset]:
        """The subsets that the settings and only admit, by name; none is an error."""
        c = self.config
        found = discovery.flat_subsets(self.spark, c.synthesis).unionByName(discovery.nested_subsets(self.spark, c.synthesis, c.languages))
        rows = discovery.admitted(found.where(F.col("lang").isin(*c.languages)), c.include, c.exclude).orderBy("subset").collect()
        out = [Subset(r["subset"], r["lang"], r["voice"], r["path"]) for r in rows if self.only is None or r["subset"] in self.only]
        if not out:
            raise ValueError(f"no subset matches {list(self.only)}" if self.only is not None else f"no subset under {c.synthesis}")
        return out

    def _common(self, s: Subset) -> dict:
        return {"subset": s.name, "language": s.lang, "rate": CANONICAL_RATE, "row_limit": self.limit, "engine_build": __version__, "schema": SCHEMA}

    def asr_unit(self, r: Recogniser, s: Subset) -> Unit:
        own = {"engine": r.name, "options": r.options, "fold_typographic_apostrophes": self.config.normalization.fold_apostrophes}
        return Unit("asr", f"{s.name}__{r.name}", self._common(s) | own)

    def sim_unit(self, encoder: str, s: Subset) -> Unit:
        v = self.config.voice(s.voice)
        return Unit("sim", f"{s.name}__{encoder}", self._common(s) | {"encoder": encoder, "batch": 1, "voice": v.name, "voice_type": v.type, "least_samples": MIN_EMBEDDED})

    def quality_unit(self, s: Subset) -> Unit:
        own = {"judges": list(infer.JUDGES), "native_rate": NATIVE_RATE, "least_seconds": MIN_JUDGED_SECONDS, "limit_per_voice": self.clips_per_voice}
        return Unit("quality", s.name, self._common(s) | own)

    def units(self, stages: Sequence[str] = STAGES) -> list[tuple[Unit, Callable[[], DataFrame]]]:
        """The units in the order of their models, so that a worker loads each model once, with what computes them."""
        subsets, out = self.subsets(), []
        if "asr" in stages:
            engines = [r for r in self.config.recognisers.values() if r.enabled]
            out += [(self.asr_unit(r, s), lambda r=r, s=s: self.asr(r, s)) for r in engines for s in subsets if r.covers(s.lang)]
        if "sim" in stages:
            out += [(self.sim_unit(e, s), lambda e=e, s=s: self.sim(e, s)) for e in self.config.encoders for s in subsets]
        if "quality" in stages:
            out += [(self.quality_unit(s), lambda s=s: self.quality(s)) for s in subsets]
        return out

    # --- the stages

    def benchmark(self, lang: str) -> DataFrame:
        return discovery.benchmark_scan(self.spark, self.config.benchmark, lang)

    def clips(self, s: Subset, limit: int | None = None, rate: int = CANONICAL_RATE) -> DataFrame:
        """(key, duration, latency, samples, decoding_error): the first clips by key, decoded."""
        rows = discovery.synthesis_scan(self.spark, [s.path], self.config.columns)
        if missing := {"key", "audio"} - set(rows.columns):
            raise ValueError(f"{s.path}: no column for {', '.join(sorted(missing))}")
        least = min((x for x in (self.limit, limit) if x is not None), default=None)
        if least is not None:
            rows = rows.orderBy("key").limit(least)
        for name in ("duration", "latency"):
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast("double"))
        return rows.select("key", "duration", "latency", audio.waveform(F.col("audio"), rate).alias("_w")).select("key", "duration", "latency", "_w.samples", F.col("_w.error").alias("decoding_error"))

    def _carry(self, rows: DataFrame, lang: str, more: Sequence[str] = ()) -> DataFrame:
        """Rows with the benchmark's columns of their utterance, in one join; those that it doesn't have are null."""
        side = present(self.benchmark(lang), ["utt", *more, *CARRIED]).withColumnRenamed("utt", "_utt").dropDuplicates(["_utt"])
        return rows.join(side, rows["utt"] == side["_utt"], "left").drop("_utt")

    def _tagged(self, rows: DataFrame, s: Subset, **more: str) -> DataFrame:
        return rows.withColumns({n: F.lit(v) for n, v in {**more, "lang": s.lang, "voice": s.voice, "subset": s.name, "model": self.config.name}.items()})

    def asr(self, r: Recogniser, s: Subset) -> DataFrame:
        """Transcripts and errors of a subset. A clip below the least length, or that can't be heard, is missing."""
        long_enough = F.size("samples") >= MIN_HEARD
        heard = infer.infer(r.name, self.listeners.get(r.name, infer.StubListener), F.when(long_enough, F.col("samples")), "string", int(r.options.get("batch", 16)))
        rows = self.clips(s).withColumn("_h", heard).select(
            F.col("key").alias("utt"), F.col("duration").alias("gen_dur"), F.col("latency").alias("latency_s"),
            F.when(long_enough, audio.seconds(F.col("samples"), CANONICAL_RATE)).otherwise(F.lit(0.0)).alias("synth_dur"),
            F.col("_h.value").alias("hyp_raw"), F.col("_h.value").isNull().alias("missing"), F.coalesce("_h.error", "decoding_error").alias("failure"),
        )
        rows = self._carry(rows, s.lang, ["text_norm"]).withColumnRenamed("text_norm", "ref_norm")
        rows = rows.withColumn("hyp_norm", text.normalize(F.col("hyp_raw"), F.lit(s.lang), self.config.normalization))
        scored = ~F.col("missing")
        rows = rows.withColumn("_a", scoring.alignment(F.when(scored, F.coalesce("ref_norm", F.lit(""))), F.col("hyp_norm")))
        n = F.when(scored, scoring.word_count(F.col("ref_norm")))
        rows = rows.withColumns({
            "subs": F.col("_a.subs"), "dels": F.col("_a.dels"), "ins": F.col("_a.ins"), "n_ref_words": n,
            "wer": F.try_divide((F.col("_a.subs") + F.col("_a.dels") + F.col("_a.ins")).cast("double"), n.cast("double")),
            "cer_err": F.when(scored, scoring.char_errors(F.col("ref_norm"), F.col("hyp_norm"))), "n_ref_chars": F.when(scored, F.length(F.coalesce("ref_norm", F.lit(""))).cast("long")),
        })
        return self._tagged(rows.drop("_a"), s, asr=r.name)

    def references(self, encoder: str, lang: str) -> DataFrame:
        """(speaker_id, ref): of each speaker's prompts, by utterance, the first that is long enough. An absent column is an error."""
        rows = required(self.benchmark(lang), ["utt", "speaker_id", "prompt_audio"]).where("speaker_id IS NOT NULL")
        waves = rows.select("utt", "speaker_id", audio.waveform(F.col("prompt_audio"), CANONICAL_RATE, None)["samples"].alias("w"))
        first = sim.first_eligible(waves, ["speaker_id"], ["utt"], F.size("w") >= MIN_EMBEDDED, "w")
        return first.select("speaker_id", infer.infer(encoder, self.encoders.get(encoder, infer.StubEncoder), F.col("w"), "array<double>", 1)["value"].alias("ref")).where("ref IS NOT NULL")

    def sim(self, encoder: str, s: Subset) -> DataFrame:
        """Every clip with the similarity to its speaker's prompt, or the reason why it has none."""
        rows = self._carry(self.clips(s).withColumnRenamed("key", "utt"), s.lang)
        refs = self.references(encoder, s.lang).withColumnRenamed("speaker_id", "_speaker")
        rows = rows.join(refs, F.col("speaker_id") == F.col("_speaker"), "left").drop("_speaker")
        there = F.col("ref").isNotNull() & F.col("samples").isNotNull()
        enough = there & (F.size("samples") >= MIN_EMBEDDED)
        rows = rows.withColumn("_e", infer.infer(encoder, self.encoders.get(encoder, infer.StubEncoder), F.when(enough, F.col("samples")), "array<double>", 1))
        why = F.when(~there, "missing").when(~enough, "too_short").when(F.col("_e.value").isNull(), "failed")
        rows = rows.withColumns({"sim": vectors.dot(F.col("_e.value"), F.col("ref")), "unscored": why, "failure": F.col("_e.error")})
        return self._tagged(rows.drop("_e", "samples", "ref", "duration", "latency", "decoding_error"), s, encoder=encoder)

    def quality(self, s: Subset) -> DataFrame:
        """The judges' scores of the first clips of a voice; too short ones have none."""
        rows = self.clips(s, self.clips_per_voice, NATIVE_RATE).withColumnRenamed("key", "utt")
        at_16k = audio.rerated(F.col("samples"), NATIVE_RATE, CANONICAL_RATE)
        enough = F.size("samples") >= MIN_JUDGED_SECONDS * NATIVE_RATE
        rows = rows.withColumns({"too_short": ~F.coalesce(enough, F.lit(False)), "_c": F.when(enough, at_16k)})
        inputs = {"dnsmos": F.col("_c"), "utmos": F.slice("_c", 1, UTMOS_SECONDS * CANONICAL_RATE), "nisqa": F.when(enough, F.col("samples"))}
        loaders = {j: self.judges.get(j, lambda j=j: infer.StubScores(j)) for j in inputs}
        rows = rows.withColumn("_s", infer.judged_scores(inputs, loaders)).select("utt", "too_short", "_s.*")
        return self._tagged(self._carry(rows, s.lang), s)

    # --- the run

    def summary(self, unit: Unit, rows: DataFrame) -> dict:
        """Counters and rates of a unit's rows; keys with an underscore are for the cache alone."""
        if unit.stage == "asr":
            one = stats.error_summary(rows, ["subset", "lang", "voice", "asr"])
        elif unit.stage == "sim":
            one = rows.groupBy("subset", "lang", "voice", "encoder").agg(
                F.count("sim").alias("n_rows"), *(F.count_if(F.col("unscored") == w).alias(f"n_{w}") for w in ("missing", "too_short", "failed")), *sim.distribution(F.col("sim"))
            )
        else:
            one = rows.groupBy("subset", "lang", "voice").agg(
                F.count_if(~F.col("too_short")).alias("n_rows"), F.count_if("too_short").alias("n_too_short_to_judge"), *(F.avg(x).alias(f"{x}_mean") for x in infer.SCORES)
            )
        row = one.first()
        return (row.asDict() if row else {}) | {"_key": unit.key, "_parameters": unit.parameters}

    def run(self, stages: Sequence[str] = STAGES) -> dict[str, DataFrame]:
        """Computes the pending units and returns the pool of each stage, of current results only."""
        planned = self.units(stages)
        left = {u.key for u in self.cache.pending([u for u, _ in planned])}
        for unit, compute in planned:
            if unit.key in left:
                self.cache.save(unit, compute())
                self.cache.finish(unit, self.summary(unit, self.spark.read.parquet(self.cache.path(unit))))
        current = replace(self.cache, resume=True)
        pools = {stage: current.pool([u for u, _ in planned if u.stage == stage]) for stage in stages}
        return {k: v for k, v in pools.items() if v is not None}
