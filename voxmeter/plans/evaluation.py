"""The evaluation's tables and reports: intelligibility, disagreement, failures, similarity, audits and their parts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import infer, stages
from ..functions import numbers, scoring, text, vectors
from ..operators import similarity as sim
from ..operators import stats
from ..runtime import broadcast_if_small, checkpointed, col
from ..sources.tables import table

# The headline recogniser of each language, and the columns that carry the human anchor's counts for it.
PRIMARY = {"en-US": "whisper", "es-MX": "whisper", "es-ES": "whisper", "nl-NL": "whisper", "pt-BR": "whisper", "ky": "gigaam"}
ANCHOR_COLUMNS = {
    "whisper": ("anchor_subs", "anchor_dels", "anchor_ins", "anchor_cer_err"),
    "gigaam": ("anchor_subs", "anchor_dels", "anchor_ins", "anchor_cer_err"),
    "mms": ("anchor_subs_mms", "anchor_dels_mms", "anchor_ins_mms", "anchor_cer_err_mms"),
    "elevenlabs": ("anchor_subs_scribe", "anchor_dels_scribe", "anchor_ins_scribe", "anchor_cer_err_scribe"),
}
ANCHOR_INPUTS = [*sorted({c for cs in ANCHOR_COLUMNS.values() for c in cs[:3]}), "anchor_n_ref_words"]
CARRIED = ["speaker_gender", "gt_speaker_id", "prompt_dur_bin", "sim_ref_dur_bin", "gt_dur"]
ENCODERS = ("wavlm_sv", "wavlm_ft", "ecapa")
RUNAWAY, TRUNCATED, EMPTY_SECONDS = 2.0, 0.5, 0.3
REF_WEIGHT, OWN_WEIGHT = 0.7, 0.3


def pool(spark: SparkSession, root: str) -> DataFrame:
    """Scored rows, each once; only the columns that a query uses are read.

    Deliveries of a row are exact duplicates. Rows without an id are told apart by what they are about.
    """
    rows = table(spark, root, "asr")
    return rows.dropDuplicates([c for c in ("row_id", "subset", "asr", "utt") if c in rows.columns])


def benchmark(spark: SparkSession, root: str, columns: Sequence[str]) -> DataFrame:
    """utt and the columns named of the first delivery of each utterance. Nothing else is read or shuffled."""
    wanted = list(dict.fromkeys(["utt", *columns]))
    rows = table(spark, root, "sources").where("utt IS NOT NULL")
    first = F.min_by(F.struct(*(col(c) for c in wanted)), F.struct("ingested_at", "row_id")).alias("b")
    return rows.groupBy(F.col("utt").alias("_utt")).agg(first).select("b.*")


def with_benchmark(rows: DataFrame, bench: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """Rows with benchmark columns of their utterance, all in one join; a name that rows has is left to rows."""
    wanted = [c for c in columns if c not in rows.columns]
    side = bench.select(col("utt").alias("_utt"), *(col(c) for c in wanted))
    return rows.join(side, rows["utt"] == side["_utt"], how).drop("_utt")


def word_edits() -> Column:
    return F.col("subs") + F.col("dels") + F.col("ins")


def scored(spark: SparkSession, root: str) -> DataFrame:
    return pool(spark, root).where("NOT missing").dropna(subset=["subs", "dels", "ins", "n_ref_words"])


# --- texts and scores --------------------------------------------------------------------------------------------


def text_normalize(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "sources")
    return s.select("row_id", text.normalize(F.col("text"), F.col("lang")).alias("norm"))


def norm_parity(spark: SparkSession, root: str) -> DataFrame:
    """Per language: texts, and those whose normal form is the stored one."""
    s = table(spark, root, "sources")
    same = text.normalize(F.col("text"), F.col("lang")) == F.coalesce("text_norm", F.lit(""))
    return s.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("n_equal"))


def norm_differences(spark: SparkSession, root: str) -> DataFrame:
    """Every text whose normal form isn't the stored one."""
    s = table(spark, root, "sources").select("row_id", "lang", text.normalize(F.col("text"), F.col("lang")).alias("ours"), F.coalesce("text_norm", F.lit("")).alias("stored"))
    return s.where("ours <> stored")


def norm_diagnostics(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "sources")
    counts = text.diagnostics(F.col("text"), F.col("lang"), text.Normalization(fold_apostrophes=True))
    return s.groupBy("lang").agg(*(F.sum(c).alias(n) for n, c in counts.items()))


def expand_digits(spark: SparkSession, root: str) -> DataFrame:
    """Documents in normal form, numbers said in the language that the label begins with."""
    d = table(spark, root, "documents")
    locales = {"en": "en-US", "es": "es-ES", "pt": "pt-BR", "nl": "nl-NL"}
    lang = F.lower(F.left("lang", F.lit(2)))
    locale = F.coalesce(*(F.when(lang == k, v) for k, v in locales.items()))
    return d.select("doc_id", text.normalize(F.col("text"), locale).alias("norm"))


def said_keys(spark: SparkSession, root: str) -> DataFrame:
    """The customers' keys in the words of every language that numbers are said in."""
    keys = table(spark, root, "orders").select(F.col("o_custkey").cast("long").alias("n")).distinct()
    return keys.select("n", *(numbers.said(F.col("n"), x).alias(x) for x in sorted(numbers.SPEAKERS)))


def typographic_count(spark: SparkSession, root: str) -> DataFrame:
    return pool(spark, root).groupBy("subset", "asr").agg(F.count_if(text.has_typographic_apostrophe(F.col("hyp_raw"))).alias("n_typographic"))


def word_errors(spark: SparkSession, root: str) -> DataFrame:
    p = pool(spark, root).where("NOT missing")
    return p.select("row_id", scoring.word_errors(F.col("ref_norm"), F.col("hyp_norm")).alias("errors"), scoring.word_count(F.col("ref_norm")).alias("n_ref"))


def char_errors(spark: SparkSession, root: str) -> DataFrame:
    p = pool(spark, root).where("NOT missing")
    return p.select("row_id", scoring.char_errors(F.col("ref_norm"), F.col("hyp_norm")).alias("errors"), F.length(F.coalesce("ref_norm", F.lit(""))).cast("long").alias("n_ref"))


def sdi_split(spark: SparkSession, root: str) -> DataFrame:
    p = pool(spark, root).where("NOT missing").select("row_id", scoring.alignment(F.col("ref_norm"), F.col("hyp_norm")).alias("a"))
    return p.select("row_id", "a.subs", "a.dels", "a.ins")


def score_invariants(spark: SparkSession, root: str) -> DataFrame:
    """Rows whose stored counts break D - I = n_ref - n_hyp or S + D + I >= the edit distance; none are expected."""
    p = pool(spark, root).where("NOT missing").withColumn("least", scoring.word_errors(F.col("ref_norm"), F.col("hyp_norm")))
    balance = F.col("dels") - F.col("ins") == F.col("n_ref_words") - scoring.word_count(F.col("hyp_norm"))
    return p.select("row_id", balance.alias("balanced"), (word_edits() >= F.col("least")).alias("at_least")).where("NOT balanced OR NOT at_least")


# --- rates -------------------------------------------------------------------------------------------------------


def error_summary(spark: SparkSession, root: str) -> DataFrame:
    return stats.error_summary(pool(spark, root), ["subset", "asr"])


def rates_by_lang(spark: SparkSession, root: str) -> DataFrame:
    return stats.error_summary(pool(spark, root), ["lang", "asr"])


def rates_by_len(spark: SparkSession, root: str) -> DataFrame:
    return stats.error_summary(pool(spark, root), ["asr", "len_bin"])


def cluster_bootstrap_wer(spark: SparkSession, root: str) -> DataFrame:
    return stats.cluster_bootstrap(scored(spark, root), ["lang", "asr"], "speaker_id", word_edits(), F.col("n_ref_words"))


def bootstrap_macro(spark: SparkSession, root: str) -> DataFrame:
    """Intervals of the macro rate: a mean is the ratio of a sum and a count. Per-row rates are summed to nine digits."""
    rows = scored(spark, root).where("n_ref_words > 0").withColumn("_rate", F.round(word_edits() / F.col("n_ref_words"), 9).cast("decimal(20,9)"))
    return stats.cluster_bootstrap(rows, ["lang"], "speaker_id", F.col("_rate"), F.lit(1))


def bootstrap_catastrophic(spark: SparkSession, root: str) -> DataFrame:
    rows = scored(spark, root).where("n_ref_words > 0")
    return stats.cluster_bootstrap(rows, ["lang"], "speaker_id", (word_edits() / F.col("n_ref_words") > stats.CATASTROPHIC).cast("int"), F.lit(1))


def _anchor(column: int) -> Column:
    return F.coalesce(*(F.when(F.col("asr") == a, col(c[column])) for a, c in ANCHOR_COLUMNS.items()))


def _with_anchors(rows: DataFrame, bench: DataFrame, how: str) -> DataFrame:
    """Rows with h_err and h_n, the human anchor's errors and words for the same recogniser and utterance, or null."""
    wide = with_benchmark(rows, bench, ANCHOR_INPUTS, how)
    return wide.withColumns({"h_err": _anchor(0) + _anchor(1) + _anchor(2), "h_n": F.col("anchor_n_ref_words")}).drop(*ANCHOR_INPUTS)


def anchored(spark: SparkSession, root: str) -> DataFrame:
    """Scored rows with the human anchor's errors of the same recogniser on the same utterance, where there are any."""
    return _with_anchors(scored(spark, root), benchmark(spark, root, ANCHOR_INPUTS), "inner").dropna(subset=["h_err", "h_n"])


def paired_bootstrap_anchor(spark: SparkSession, root: str) -> DataFrame:
    return stats.paired_bootstrap(anchored(spark, root), ["lang", "asr"], "speaker_id", (word_edits(), F.col("n_ref_words")), (F.col("h_err"), F.col("h_n")))


def anchor_rates(spark: SparkSession, root: str) -> DataFrame:
    """The human anchor's corpus rates of words and characters by language and recogniser; the wide columns become rows."""
    b = benchmark(spark, root, ["lang", *ANCHOR_INPUTS, "anchor_n_ref_chars", *(c[3] for c in ANCHOR_COLUMNS.values())])
    wide = F.array(*(F.struct(F.lit(a).alias("asr"), (col(c[0]) + col(c[1]) + col(c[2])).alias("err"), col(c[3]).alias("cer_err")) for a, c in ANCHOR_COLUMNS.items()))
    rows = b.select("lang", F.col("anchor_n_ref_words").alias("w"), F.col("anchor_n_ref_chars").alias("c"), F.explode(wide).alias("x")).select("lang", "x.*", "w", "c")
    words, chars = F.col("err").isNotNull() & F.col("w").isNotNull(), F.col("cer_err").isNotNull() & F.col("c").isNotNull()
    return rows.where(words | chars).groupBy("lang", "asr").agg(
        F.count_if(words).alias("n"), F.round(stats.rate(F.when(words, F.col("err")), F.when(words, F.col("w"))), 9).alias("anchor_wer"),
        F.count_if(chars).alias("n_cer"), F.round(stats.rate(F.when(chars, F.col("cer_err")), F.when(chars, F.col("c"))), 9).alias("anchor_cer"),
    )


def intelligibility(spark: SparkSession, root: str) -> DataFrame:
    """One row per subset and recogniser: rates, interval, and the paired difference to the human anchor.

    The rows are joined with the anchors and summed by speaker once; all three parts come from these sums, written out.
    """
    keys = ["subset", "asr"]
    rows = _with_anchors(pool(spark, root), benchmark(spark, root, ANCHOR_INPUTS), "left")
    edits = word_edits().cast("double")
    whole = ~F.col("missing") & edits.isNotNull() & F.col("n_ref_words").isNotNull()
    both = whole & F.col("h_err").isNotNull() & F.col("h_n").isNotNull()
    sums = {n: c.alias(n) for n, c in stats.error_counts().items()}
    for n, c, when in [("_a", edits, whole), ("_n", F.col("n_ref_words"), whole), ("_pa", edits, both), ("_pan", F.col("n_ref_words"), both), ("_pb", F.col("h_err"), both), ("_pbn", F.col("h_n"), both)]:
        sums[n] = F.sum(F.when(when, c.cast("double"))).alias(n)
    speakers = checkpointed(rows.groupBy(*keys, "speaker_id").agg(*sums.values()))
    # a speaker without anchored rows adds nothing to the pair's sums, so both intervals come from the same replicates
    names = ["_a", "_n", "_pa", "_pan", "_pb", "_pbn"]
    named = speakers.where("speaker_id IS NOT NULL").select(*keys, F.col("speaker_id").alias("_cluster"), *(F.coalesce(n, F.lit(0.0)).alias(n) for n in names))
    ours, human = F.try_divide(F.col("_pa"), F.col("_pan")), F.try_divide(F.col("_pb"), F.col("_pbn"))
    wer, delta = F.try_divide(F.col("_a"), F.col("_n")), ours - human
    bands = stats.resamples(named, keys, names).groupBy(*keys).agg(
        *stats.interval(wer, names=("wer_lo", "wer_hi")), *stats.interval(delta, names=("delta_lo", "delta_hi")), F.round(F.avg((delta < 0).cast("double")), 9).alias("p_a_better")
    )
    ra, rb = F.try_divide(F.sum("_pa"), F.sum("_pan")), F.try_divide(F.sum("_pb"), F.sum("_pbn"))
    points = named.groupBy(*keys).agg(F.round(rb, 9).alias("anchor_wer"), F.round(ra - rb, 9).alias("delta"))
    out = stats.joined(stats.joined(stats.summed(speakers, keys), points, keys, "left"), bands, keys, "left")
    # an interval needs more than one scored row
    several = F.col("n_scored") > 1
    return out.withColumns({c: F.when(several, F.col(c)) for c in ("wer_lo", "wer_hi")})


def _pairs(spark: SparkSession, root: str) -> DataFrame:
    rows = scored(spark, root).where("utt IS NOT NULL").select("subset", "utt", "asr", "speaker_id", "hyp_norm", word_edits().alias("err"), F.col("n_ref_words").alias("n"))
    a, b = rows.alias("a"), rows.alias("b")
    on = (F.col("a.subset") == F.col("b.subset")) & (F.col("a.utt") == F.col("b.utt")) & (F.col("a.asr") < F.col("b.asr"))
    return a.join(b, on).select(
        "a.subset", F.col("a.asr").alias("a"), F.col("b.asr").alias("b"), F.col("a.speaker_id").alias("speaker_id"),
        F.col("a.err").alias("err_a"), F.col("a.n").alias("n_a"), F.col("b.err").alias("err_b"), F.col("b.n").alias("n_b"),
        F.coalesce(F.col("a.hyp_norm") == F.col("b.hyp_norm"), F.lit(False)).alias("same"),
    )


def _pair_sums(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of recognisers summed by speaker: shared utterances, identical transcripts, errors and words of both."""
    double = [F.sum(F.col(c).cast("double")).alias(n) for c, n in zip(("err_a", "n_a", "err_b", "n_b"), stats.PAIR)]
    return _pairs(spark, root).groupBy("subset", "a", "b", F.col("speaker_id").alias("_cluster")).agg(F.count(F.lit(1)).alias("_n"), F.count_if("same").alias("_same"), *double)


def _identical(sums: DataFrame) -> DataFrame:
    share = F.round(F.sum("_same").cast("double") / F.sum("_n").cast("double"), 9)
    return sums.groupBy("subset", "a", "b").agg(F.sum("_n").alias("n_shared"), share.alias("identical")).where("n_shared >= 2")


def identical_transcripts(spark: SparkSession, root: str) -> DataFrame:
    return _identical(_pair_sums(spark, root))


def disagreement(spark: SparkSession, root: str) -> DataFrame:
    """One row per subset and pair of recognisers that share at least two utterances.

    Recognisers are joined once and summed by speaker; both parts come from these sums, written out.
    """
    keys = ["subset", "a", "b"]
    sums = checkpointed(_pair_sums(spark, root))
    paired = stats.paired_intervals(sums.where("_cluster IS NOT NULL").select(*keys, "_cluster", *stats.PAIR), keys)
    return stats.joined(_identical(sums), paired.drop("n_clusters"), keys, "left")


def _durations(spark: SparkSession, root: str) -> DataFrame:
    rows = with_benchmark(pool(spark, root), benchmark(spark, root, ["gt_dur"]), ["gt_dur"])
    gt, own = stats.finite(F.col("gt_dur")), stats.finite(F.col("synth_dur"))
    return rows.withColumns({"synth_dur": own, "ratio": F.when(gt > 0, F.try_divide(own, gt))})


def primary_recogniser() -> Column:
    return F.coalesce(*(F.when(F.col("lang") == k, v) for k, v in PRIMARY.items()))


def failures(spark: SparkSession, root: str) -> DataFrame:
    """What a mean hides, by subset and for the language's headline recogniser. Clips without a transcript count too."""
    rows = _durations(spark, root).where(F.col("asr") == primary_recogniser())
    own = F.when(~F.col("missing"), F.try_divide(word_edits().cast("double"), F.col("n_ref_words").cast("double")))
    ratio, present = F.col("ratio"), ~F.col("missing")
    return rows.groupBy("subset", "lang", "voice", "asr").agg(
        F.round(stats.share(F.col("synth_dur") < EMPTY_SECONDS), 9).alias("empty_output"),
        F.round(F.avg((own > stats.CATASTROPHIC).cast("double")), 9).alias("catastrophic"),
        F.round(F.avg((ratio > RUNAWAY).cast("double")), 9).alias("runaway"),
        F.round(F.avg((ratio < TRUNCATED).cast("double")), 9).alias("truncated"),
        F.round(F.percentile(ratio, F.lit(0.5)), 9).alias("median_ratio"),
        F.round(F.max(ratio), 9).alias("max_ratio"),
        (F.count("failure") + F.count_if(F.col("missing") & F.col("failure").isNull())).alias("unreadable"),
        F.count_if(present & text.has_typographic_apostrophe(F.col("hyp_raw"))).alias("n_typographic"),
    )


def empty_clips(spark: SparkSession, root: str, seconds: float = EMPTY_SECONDS) -> DataFrame:
    """Distinct clips (subset and utterance) below the shortest length of an output, by subset."""
    clips = pool(spark, root).groupBy("subset", "utt").agg(F.min(stats.finite(F.col("synth_dur"))).alias("d"))
    return clips.groupBy("subset").agg(F.count_if(F.col("d") < seconds).alias("n_empty"), F.count(F.lit(1)).alias("n_clips"))


def worst_subset(spark: SparkSession, root: str) -> DataFrame:
    """The subset with the most empty clips; of equals the first by name."""
    return empty_clips(spark, root).where("n_empty > 0").orderBy(F.desc("n_empty"), "subset").limit(1)


def worst_short_subset(spark: SparkSession, root: str) -> DataFrame:
    """The same for clips of less than two seconds, which every subset has."""
    return empty_clips(spark, root, 2.0).where("n_empty > 0").orderBy(F.desc("n_empty"), "subset").limit(1)


def missing_gates(spark: SparkSession, root: str, least: float = 1.0) -> DataFrame:
    """Clips by length gate: too short to judge, judged, unknown."""
    d = stats.finite(F.col("synth_dur"))
    return pool(spark, root).groupBy("subset").agg(
        F.count_if(d < least).alias("n_too_short"), F.count_if(d >= least).alias("n_judged"), F.count_if(d.isNull()).alias("n_unknown")
    )


def length_gates(spark: SparkSession, root: str) -> DataFrame:
    """Clips by subset that the stages' length gates stop, each gate with its own counter."""
    clips = pool(spark, root).groupBy("subset", "utt").agg(F.min(stats.finite(F.col("synth_dur"))).alias("d"))
    return clips.groupBy("subset").agg(F.count(F.lit(1)).alias("n_clips"), *(c.alias(n) for n, c in stages.gates(F.col("d")).items()))


# --- joins and audits --------------------------------------------------------------------------------------------


def join_audit(spark: SparkSession, root: str) -> DataFrame:
    """Per subset: keys on both sides, on one, and rows whose texts differ; clean if there is nothing to report."""
    clips = pool(spark, root).where("utt IS NOT NULL").groupBy("subset", "lang", "utt").agg(F.first("ref_norm").alias("ref_norm"))
    bench = benchmark(spark, root, ["lang", "text_norm"])
    rows = with_benchmark(clips, bench.withColumn("found", F.lit(True)), ["text_norm", "found"])
    differs = F.trim(F.coalesce("ref_norm", F.lit(""))) != F.trim(F.coalesce("text_norm", F.lit("")))
    per = rows.groupBy("subset", "lang").agg(
        F.count(F.lit(1)).alias("n_synthesis"), F.count("found").alias("n_joined"), F.count_if(F.col("found") & differs).alias("n_text_mismatch")
    )
    sizes = bench.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("n_benchmark"))
    out = per.join(broadcast_if_small(sizes), F.col("lang") == F.col("_lang"), "left").drop("_lang")
    out = out.withColumns({"n_unknown": F.col("n_synthesis") - F.col("n_joined"), "n_not_synthesised": F.col("n_benchmark") - F.col("n_joined")})
    return out.withColumn("clean", (F.col("n_unknown") == 0) & (F.col("n_not_synthesised") == 0) & (F.col("n_text_mismatch") == 0))


def anti_missing_left(spark: SparkSession, root: str) -> DataFrame:
    """Scored utterances that the benchmark doesn't have."""
    clips = pool(spark, root).where("utt IS NOT NULL").select("subset", "utt").distinct()
    return clips.join(table(spark, root, "sources").select("utt"), "utt", "left_anti").select("subset", "utt")


def anti_missing_right(spark: SparkSession, root: str) -> DataFrame:
    """Benchmark utterances that no recogniser was given."""
    return table(spark, root, "sources").where("utt IS NOT NULL").select("lang", "utt").distinct().join(pool(spark, root).select("utt"), "utt", "left_anti").select("lang", "utt")


def shared_utts(spark: SparkSession, root: str) -> DataFrame:
    """Utterances that both of two recognisers have scored: an intersection."""
    p = pool(spark, root)
    return p.where("asr = 'whisper'").select("subset", "utt").intersect(p.where("asr = 'mms'").select("subset", "utt"))


def text_mismatch(spark: SparkSession, root: str) -> DataFrame:
    rows = with_benchmark(pool(spark, root).where("utt IS NOT NULL"), benchmark(spark, root, ["text_norm"]), ["text_norm"], "inner")
    return rows.where(F.trim(F.coalesce("ref_norm", F.lit(""))) != F.trim(F.coalesce("text_norm", F.lit("")))).select("row_id", "utt")


def carry_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Scored rows with what the benchmark carries along, in one left join."""
    rows = with_benchmark(pool(spark, root), benchmark(spark, root, CARRIED), CARRIED)
    return rows.select("row_id", *(c for c in CARRIED if c != "gt_dur"), stats.finite(F.col("gt_dur")).alias("gt_dur"))


def work_plan(spark: SparkSession, root: str) -> DataFrame:
    """Recognisers by subset of a language that they cover, with the rows to do; recogniser-major."""
    p = pool(spark, root)
    covers = p.select("asr", "lang").distinct()
    subsets = p.groupBy("subset", "lang").agg(F.count_distinct("utt").alias("n_rows"))
    return covers.join(subsets, "lang").select("asr", "subset", "lang", "n_rows")


def work_totals(spark: SparkSession, root: str) -> DataFrame:
    plan = work_plan(spark, root)
    return plan.groupBy("asr").agg(F.count(F.lit(1)).alias("n_units"), F.sum("n_rows").alias("n_passes"))


def work_overall(spark: SparkSession, root: str) -> DataFrame:
    """One row: clips, and how often recognisers and encoders go over them."""
    subsets = pool(spark, root).groupBy("subset").agg(F.count_distinct("utt").alias("n")).agg(F.count(F.lit(1)).alias("n_subsets"), F.sum("n").alias("n_clips"))
    passes = work_plan(spark, root).agg(F.count(F.lit(1)).alias("n_asr_units"), F.sum("n_rows").alias("n_asr_passes"))
    both = stats.joined(subsets, passes, [])
    return both.withColumns({"n_sim_units": F.col("n_subsets") * len(ENCODERS), "n_sim_passes": F.col("n_clips") * len(ENCODERS)})


def limit_per_subset(spark: SparkSession, root: str, n: int = 10) -> DataFrame:
    """The first n rows of each subset and recogniser by key: the cap of a trial run."""
    return sim.ordered_first(pool(spark, root).where("utt IS NOT NULL"), ["subset", "asr"], [F.col("utt"), F.col("row_id")], n).select("subset", "asr", "utt", "row_id")


def dedup_first(spark: SparkSession, root: str) -> DataFrame:
    """One row per subset and utterance: the first by recogniser."""
    p = pool(spark, root).where("utt IS NOT NULL")
    return p.groupBy("subset", "utt").agg(F.min_by("row_id", F.struct("asr", "row_id")).alias("row_id"))


def union_pools(spark: SparkSession, root: str) -> DataFrame:
    """Two pools of different columns as one, by name; what a pool doesn't have is null."""
    a = pool(spark, root).select("utt", "asr", "subset", "subs")
    b = table(spark, root, "sources").select("utt", "lang", F.col("anchor_subs").alias("subs"))
    u = a.unionByName(b, allowMissingColumns=True)
    return u.groupBy("asr", "lang").agg(F.count(F.lit(1)).alias("n"), F.count("subset").alias("n_subset"), F.sum("subs").alias("subs"))


def float_means(spark: SparkSession, root: str) -> DataFrame:
    """Mean of every double column of the pool by subset, whichever there are."""
    p = pool(spark, root)
    doubles = [f.name for f in p.schema.fields if f.dataType.simpleString() == "double"]
    return p.groupBy("subset").agg(F.count(F.lit(1)).alias("n_rows"), *(F.round(F.avg(stats.finite(col(c))), 9).alias(f"{c}_mean") for c in doubles))


def judged_clips(spark: SparkSession, root: str, per_voice: int = 10) -> DataFrame:
    """The first clips of each subset by key with stub scores of all judges; a short one has none. Not naturalness."""
    clips = pool(spark, root).where("utt IS NOT NULL").groupBy("subset", "lang", "voice", "utt").agg(F.max(stats.finite(F.col("synth_dur"))).alias("d"))
    few = sim.ordered_first(clips, ["subset"], [F.col("utt")], per_voice)
    heard = F.when(F.col("d") >= stages.MIN_JUDGED_SECONDS, F.col("utt"))
    scores = infer.judged_scores({j: heard for j in infer.JUDGES}, {j: partial(infer.StubScores, j) for j in infer.JUDGES})
    return few.withColumn("_s", scores).select("subset", "lang", "voice", "utt", heard.isNull().alias("too_short"), "_s.*")


def naturalness(spark: SparkSession, root: str) -> DataFrame:
    """The mean of every score by subset, by the scores' plain names, over the clips that were judged."""
    judged = judged_clips(spark, root)
    means = judged.groupBy("subset", "lang", "voice").agg(
        F.count_if(~F.col("too_short")).alias("n"), F.count_if("too_short").alias("n_too_short_to_judge"), *(F.avg(c).alias(f"{c}_mean") for c in infer.SCORES)
    )
    return means.select("subset", "lang", "voice", "n", "n_too_short_to_judge", *(F.round(col(c), 3).alias(c[: -len("_mean")]) for c in means.columns if c.endswith("_mean")))


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows by subset; only that column is read."""
    return table(spark, root, "asr").groupBy("subset").agg(F.count(F.lit(1)).alias("n_rows"))


def cluster_ratio_orders(spark: SparkSession, root: str) -> DataFrame:
    """The bootstrap on a large table: discount given as a share of the price, customers as clusters."""
    lines = table(spark, root, "lineitem").select("l_orderkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"), F.round(F.col("l_discount") * 100).cast("long").alias("percent"))
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return stats.cluster_bootstrap(rows, ["o_orderpriority"], "o_custkey", F.col("cents") * F.col("percent"), F.col("cents") * 100)


# --- similarity --------------------------------------------------------------------------------------------------


def _clips(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "embeddings")


def _references(spark: SparkSession, root: str) -> DataFrame:
    return sim.first_eligible(_clips(spark, root), ["label"], ["vec_id"], F.size("embedding") > 0, "embedding").withColumnRenamed("embedding", "ref")


def first_reference(spark: SparkSession, root: str) -> DataFrame:
    """Each speaker's first utterance whose prompt is long enough."""
    s = table(spark, root, "sources").where("speaker_id IS NOT NULL")
    return sim.first_eligible(s, ["speaker_id"], ["row_id"], F.col("prompt_dur") >= 3.0, "utt")


def _synthetic(spark: SparkSession, root: str) -> DataFrame:
    """Stand-ins for synthesised clips: each vector drawn towards its speaker's reference."""
    refs = broadcast_if_small(_references(spark, root))
    rows = _clips(spark, root).join(refs, "label")
    return rows.select("vec_id", "label", vectors.combination(F.col("ref"), F.col("embedding"), REF_WEIGHT, OWN_WEIGHT).alias("v")).withColumn("v", vectors.unit(F.col("v")))


def sim_scores(spark: SparkSession, root: str) -> DataFrame:
    rows = sim.similarities(_synthetic(spark, root), "label", "v", _references(spark, root), "ref")
    return rows.select("vec_id", "label", F.round("sim", 9).alias("sim"))


def sim_floor(spark: SparkSession, root: str) -> DataFrame:
    refs = _references(spark, root)
    return sim.floors(refs, "label", "ref", refs.withColumnRenamed("label", "speaker"), "speaker", "ref")


def sim_anchor(spark: SparkSession, root: str) -> DataFrame:
    """Anchors from eight chunks a speaker, the first by id."""
    chunks = sim.ordered_first(_synthetic(spark, root), ["label"], [F.col("vec_id")], 8)
    return sim.anchors(chunks, "label", "vec_id", "v")


def calibration_table(spark: SparkSession, root: str) -> DataFrame:
    return sim.calibrations(sim_floor(spark, root), sim_anchor(spark, root), "label")


def sim_summary(spark: SparkSession, root: str) -> DataFrame:
    """Per speaker: distribution of sim, its normalised mean, share below the floor's 95th percentile, calibration."""
    cal = broadcast_if_small(calibration_table(spark, root).withColumnRenamed("label", "_label"))
    rows = sim_scores(spark, root).join(cal, F.col("label") == F.col("_label"), "left")
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("sim").isNull()).alias("n_missing"), *sim.distribution(F.col("sim")),
        F.round(F.avg(sim.sim_norm(F.col("sim"), F.col("floor_mean"), F.col("anchor"))), 6).alias("sim_norm_mean"),
        F.round(stats.share(F.col("sim") < F.col("floor_p95")), 9).alias("below_floor_p95"),
        F.max("floor_mean").alias("floor_mean"), F.max("anchor").alias("anchor"),
    )


def similarity_bootstrap(spark: SparkSession, root: str) -> DataFrame:
    rows = sim_scores(spark, root).withColumn("sim", F.col("sim").cast("decimal(12,9)"))
    return stats.cluster_bootstrap(rows, [], "label", F.col("sim"), F.lit(1))


def human_similarity(spark: SparkSession, root: str) -> DataFrame:
    """The benchmark's own similarity by language and encoder, as a published scale: wide columns as rows."""
    b = benchmark(spark, root, ["lang", *(f"anchor_sim_{e}" for e in ENCODERS)])
    wide = F.array(*(F.struct(F.lit(e).alias("encoder"), stats.finite(col(f"anchor_sim_{e}")).alias("s")) for e in ENCODERS))
    rows = b.select("lang", F.explode(wide).alias("x")).select("lang", "x.encoder", "x.s").where("s IS NOT NULL")
    return rows.groupBy("lang", "encoder").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("s"), 9).alias("anchor"), F.round(F.percentile("s", F.lit(0.05)), 9).alias("p05")
    )


def published_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Each benchmark row's similarity against its language's published scale: a keyed lookup on two columns."""
    cal = broadcast_if_small(human_similarity(spark, root)).select(F.col("lang").alias("_lang"), F.col("encoder").alias("_encoder"), "anchor", "p05")
    rows = benchmark(spark, root, ["lang", "anchor_sim_ecapa"]).select("utt", "lang", stats.finite(F.col("anchor_sim_ecapa")).alias("sim")).where("sim IS NOT NULL")
    hit = rows.join(cal, (F.col("lang") == F.col("_lang")) & (F.col("_encoder") == "ecapa"), "left")
    return hit.select("utt", F.round(sim.sim_norm(F.col("sim"), F.col("p05"), F.col("anchor")), 6).alias("sim_norm"))


# --- arrays ------------------------------------------------------------------------------------------------------


def array_chunks(spark: SparkSession, root: str) -> DataFrame:
    e = _clips(spark, root)
    c = vectors.chunks(F.col("embedding"), F.lit(16), F.lit(8), 4)
    return e.select("vec_id", F.posexplode(c).alias("chunk", "v")).select("vec_id", "chunk", F.size("v").alias("n"), F.round(vectors.dot(F.col("v"), F.col("v")), 6).alias("energy"))


def array_segments(spark: SparkSession, root: str) -> DataFrame:
    e = _clips(spark, root)
    s = vectors.segments(F.col("embedding"), 15, 4)
    return e.select("vec_id", F.size(s).alias("n_segments"), vectors.segment_count(F.size("embedding"), 15, 4).cast("int").alias("expected"), F.round(vectors.masked_mean(s[1], F.lit(15)), 6).alias("second_mean"))


def power_to_db(spark: SparkSession, root: str) -> DataFrame:
    e = _clips(spark, root)
    db = vectors.power_to_db(F.transform(F.col("embedding"), lambda x: x.cast("double") * x.cast("double")))
    return e.select("vec_id", F.round(F.array_min(db), 6).alias("low"), F.round(F.array_max(db), 6).alias("high"))


def padded_vectors(spark: SparkSession, root: str) -> DataFrame:
    """Vectors cut to 48 and padded to 80 elements, and their powers in decibels scaled to 0..1."""
    e = _clips(spark, root)
    db = vectors.scaled_db(F.transform(F.col("embedding"), lambda x: x.cast("double") * x.cast("double")))

    def total(v: Column) -> Column:
        return F.round(F.aggregate(v, F.lit(0.0), lambda s, x: s + x), 6)

    short, long_ = vectors.padded(F.col("embedding"), 48), vectors.padded(F.col("embedding"), 80)
    return e.select("vec_id", F.size(short).alias("n_short"), total(short).alias("sum_short"), F.size(long_).alias("n_long"), total(long_).alias("sum_long"), F.round(F.array_min(db), 6).alias("low"), F.round(F.array_max(db), 6).alias("high"))


def masked_pools(spark: SparkSession, root: str) -> DataFrame:
    """Mean, maximum and softmax-weighted mean over the first elements, as many as the id says."""
    e = _clips(spark, root).withColumn("valid", (F.col("vec_id") % 64 + 1).cast("int"))
    v = F.col("embedding")
    return e.select(
        "vec_id", "valid",
        F.round(vectors.masked_mean(v, F.col("valid")), 6).alias("mean"),
        F.round(vectors.masked_max(v, F.col("valid")), 6).alias("top"),
        F.round(vectors.masked_softmax_mean(v, v, F.col("valid")), 6).alias("attended"),
    )


def anchor_plan(spark: SparkSession, root: str) -> DataFrame:
    """Into what chunks each prompt would be cut: length, step and number, none if it is too short."""
    s = table(spark, root, "sources").select("row_id", stats.finite(F.col("prompt_dur")).alias("d"))
    chunk = vectors.anchor_chunk_seconds(F.col("d"))
    hop = vectors.anchor_hop(F.col("d"), chunk)
    count = F.when(chunk.isNotNull(), F.least(F.lit(8), (F.floor(F.try_divide(F.col("d") - chunk, hop) + 1e-9) + 1).cast("int")))
    return s.select("row_id", F.round(chunk, 6).alias("chunk"), F.when(chunk.isNotNull(), F.round(hop, 6)).alias("hop"), count.alias("n_chunks"))


# --- units of work -----------------------------------------------------------------------------------------------


def fingerprint(*parts: tuple[str, Column]) -> Column:
    """The first 16 hex digits of the SHA-256 of a JSON object of the parts, in the order of their names."""
    return F.left(F.sha2(F.to_json(F.struct(*(c.alias(n) for n, c in sorted(parts)))), 256), F.lit(16))


# The settings of the runs that the tables stand for.
SETTINGS = {
    "audio": '{"pad_ms":30,"peak_dbfs":-1.0,"resampler":"soxr_hq","target_sample_rate":16000,"vad":true}',
    "options": '{"batch":16}', "fold_apostrophes": False, "row_limit": 0, "schema": 1,
}


def units(spark: SparkSession, root: str) -> DataFrame:
    """Units of recognition with the fingerprint of all that decides their result."""
    p = pool(spark, root)
    rows = p.groupBy("subset", "lang", "asr", "model").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("key", fingerprint(*((n, F.col(n)) for n in ("asr", "lang", "model", "subset")), *((n, F.lit(v)) for n, v in SETTINGS.items())))


def stage_units(spark: SparkSession, root: str) -> DataFrame:
    """Units of all stages: recognisers, encoders and judges by subset, with their fingerprints and passes."""
    subsets = pool(spark, root).groupBy("subset", "lang").agg(F.count_distinct("utt").alias("n_rows"))
    own = units(spark, root).select(F.lit("asr").alias("stage"), F.concat_ws("__", "subset", "asr").alias("unit"), "subset", "key").distinct()
    rows = own.join(subsets, "subset").select("stage", "unit", "key", F.col("n_rows").alias("passes"))
    common = [("subset", F.col("subset")), ("lang", F.col("lang")), ("audio", F.lit(SETTINGS["audio"])), ("row_limit", F.lit(0))]
    encoders = subsets.withColumn("encoder", F.explode(F.array(*map(F.lit, ENCODERS)))).select(
        F.lit("sim").alias("stage"), F.concat_ws("__", "subset", "encoder").alias("unit"),
        fingerprint(*common, ("encoder", F.col("encoder")), ("batch", F.lit(1)), ("least_samples", F.lit(stages.MIN_EMBEDDED))).alias("key"), F.col("n_rows").alias("passes"),
    )
    judges = subsets.select(
        F.lit("quality").alias("stage"), F.col("subset").alias("unit"), fingerprint(*common, ("limit_per_voice", F.lit(10))).alias("key"), F.least(F.lit(10), "n_rows").alias("passes")
    )
    return rows.unionByName(encoders).unionByName(judges)


def pending_units(spark: SparkSession, root: str) -> DataFrame:
    """Units that a manifest of earlier results (those of one model) doesn't cover: only they are computed again."""
    u = units(spark, root)
    first = u.agg(F.min("model").alias("_m"))
    manifest = u.join(F.broadcast(first), F.col("model") == F.col("_m")).select("key")
    return u.join(manifest, "key", "left_anti").select("subset", "lang", "asr", "model", "key")


def json_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Summaries as JSON and back."""
    s = stats.error_summary(pool(spark, root), ["subset", "asr"]).select("subset", "asr", "n_scored", "n_missing")
    j = s.select("subset", F.to_json(F.struct("asr", "n_scored", "n_missing")).alias("j"))
    return j.select("subset", F.from_json("j", "asr string, n_scored bigint, n_missing bigint").alias("x")).select("subset", "x.*")


def subset_names(spark: SparkSession, root: str) -> DataFrame:
    """Language and voice from the subset's name."""
    names = pool(spark, root).select("subset").distinct()
    pattern = r"^([^_]+(?:-[^_]+)?)__(.+)$"
    return names.select("subset", F.regexp_extract("subset", pattern, 1).alias("lang"), F.regexp_extract("subset", pattern, 2).alias("voice"))


def admitted_subsets(spark: SparkSession, root: str) -> DataFrame:
    """Subsets that include and exclude lists let in."""
    from ..sources.discovery import admitted

    return admitted(subset_names(spark, root), include=None, exclude=["nl-NL__femke_veen_f"])


NAMES = [
    text_normalize, norm_parity, norm_differences, norm_diagnostics, expand_digits, said_keys, typographic_count, word_errors, char_errors, sdi_split,
    score_invariants, error_summary, rates_by_lang, rates_by_len, cluster_bootstrap_wer, bootstrap_macro, bootstrap_catastrophic, paired_bootstrap_anchor,
    anchor_rates, intelligibility, identical_transcripts, disagreement, failures, empty_clips, worst_subset, worst_short_subset, missing_gates, length_gates, judged_clips, join_audit,
    anti_missing_left, anti_missing_right, shared_utts, text_mismatch, carry_lookup, work_plan, work_totals, work_overall, limit_per_subset, dedup_first,
    union_pools, float_means, naturalness, row_counts, cluster_ratio_orders, first_reference, sim_scores, sim_floor, sim_anchor,
    calibration_table, sim_summary, similarity_bootstrap, human_similarity, published_lookup, array_chunks, array_segments, power_to_db,
    padded_vectors, masked_pools, anchor_plan, units, stage_units, pending_units, json_roundtrip, subset_names, admitted_subsets,
]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}


def oracles() -> dict[str, str]:
    from .evaluation_sql import ORACLES

    return ORACLES
