"""The report as a whole, with calibration, provenance and discovery tables, and the inference harness' queries."""

from __future__ import annotations

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__, infer
from ..runtime import broadcast_if_small, spread
from ..sources.tables import table
from ..streaming.incremental import windowed_rates
from . import evaluation as ev


def similarity_report(spark: SparkSession, root: str) -> DataFrame:
    """Similarity per speaker with its scale and usable range."""
    s, c = ev.sim_summary(spark, root), ev.calibration_table(spark, root)
    side = c.select(F.col("label").alias("_label"), "floor_p95", "floor_pairs", "usable_range", "anchor_kind", "n_chunks")
    return s.join(broadcast_if_small(side), F.col("label") == F.col("_label"), "left").drop("_label", "p05", "p95")


def calibration_report(spark: SparkSession, root: str) -> DataFrame:
    """Both ends of the scale and the formula, once per voice."""
    c = ev.calibration_table(spark, root).dropDuplicates(["label"])
    formula = F.format_string("(sim - %.4f) / (%.4f - %.4f)", "floor_mean", "anchor", "floor_mean")
    return c.select("label", "anchor", "floor_mean", "floor_p95", "floor_pairs", "usable_range", F.when(F.col("usable_range") > 0, formula).alias("formula"))


def provenance(spark: SparkSession, root: str) -> DataFrame:
    """What each unit was computed with."""
    u = ev.units(spark, root)
    return u.select(F.lit("asr").alias("stage"), "subset", "asr", "key", F.lit(__version__).alias("engine"), F.lit(spark.version).alias("spark"), F.to_json(F.struct("model", *(F.lit(v).alias(n) for n, v in ev.SETTINGS.items()))).alias("parameters"))


def discover(spark: SparkSession, root: str) -> DataFrame:
    """The audit in words: what doesn't join in each subset, and the work implied."""
    a = ev.join_audit(spark, root)
    issues = F.array_compact(F.array(
        F.when(F.col("n_unknown") > 0, F.format_string("%d unknown utt", "n_unknown")),
        F.when(F.col("n_not_synthesised") > 0, F.format_string("%d not synthesised", "n_not_synthesised")),
        F.when(F.col("n_text_mismatch") > 0, F.format_string("%d text mismatch", "n_text_mismatch")),
    ))
    units = ev.work_plan(spark, root).groupBy(F.col("subset").alias("_subset")).agg(F.array_join(F.array_sort(F.collect_set("asr")), ", ").alias("recognisers"), F.sum("n_rows").alias("passes"))
    rows = a.join(units, F.col("subset") == F.col("_subset"), "left")
    return rows.select("subset", "n_joined", "recognisers", "passes", F.when(F.size(issues) == 0, "ok").otherwise(F.array_join(issues, "; ")).alias("status"))


def batch_infer(spark: SparkSession, root: str) -> DataFrame:
    """Stub transcripts of the benchmark's texts, scored: the whole path from model to rate."""
    rows = infer.transcribed(spread(table(spark, root, "sources").select("row_id", "lang", "text")), "text")
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count("hyp").alias("n_heard"), F.count("failure").alias("n_failed"), F.sum(F.size(F.split("hyp", " "))).alias("words")
    )


def isolated_failures(spark: SparkSession, root: str) -> DataFrame:
    """Rows that the stub recogniser refused, each with its own error; the rest of their batches is unharmed."""
    rows = infer.transcribed(spread(table(spark, root, "sources").select("row_id", "text")), "text")
    return rows.where("failure IS NOT NULL").select("row_id", "failure")


def stub_judgements(spark: SparkSession, root: str) -> DataFrame:
    """Stub scores of ten texts a language: a capped sample per group, then a model. Not naturalness."""
    from ..operators.similarity import ordered_first

    few = ordered_first(table(spark, root, "sources").where("text IS NOT NULL").select("row_id", "lang", "text"), ["lang"], [F.col("row_id")], 10)
    return infer.judged(few, "text").select("row_id", "lang", F.round("mos", 6).alias("mos"))


def daily_rates(spark: SparkSession, root: str) -> DataFrame:
    """The streaming query's result over the pool as it is."""
    r = windowed_rates(table(spark, root, "asr"))
    return r.select(F.to_date("start").alias("day"), "asr", "n", "errors", "words", F.round("wer_corpus", 9).alias("wer_corpus"))


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The report's tables in their order."""
    order = lambda df, *keys: df.orderBy(*(F.asc_nulls_last(k) for k in keys))
    return {
        "intelligibility": order(ev.intelligibility(spark, root), "subset", "asr"),
        "disagreement": order(ev.disagreement(spark, root), "subset", "a", "b"),
        "similarity": order(similarity_report(spark, root), "label"),
        "failures": order(ev.failures(spark, root), "lang", "voice"),
        "naturalness": order(ev.naturalness(spark, root), "subset"),
        "calibration": order(calibration_report(spark, root), "label"),
        "provenance": order(provenance(spark, root), "subset", "asr"),
    }


NAMES = [similarity_report, calibration_report, provenance, discover, batch_infer, isolated_failures, stub_judgements, daily_rates]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}


def oracles() -> dict[str, str]:
    from . import evaluation_sql as sql

    everything = (sql.REFS, sql.SYNTH, sql.FLOOR, sql.CHUNKS, sql.CAL)
    audit = sql.ORACLES["join_audit"]
    return {
        "similarity_report": f"""WITH s AS ({sql.ORACLES['sim_summary']}), c AS ({sql.ORACLES['calibration_table']})
SELECT s.* EXCLUDE (p05, p95), c.floor_p95, c.floor_pairs, c.usable_range, c.anchor_kind, c.n_chunks FROM s LEFT JOIN c USING (label)""",
        "calibration_report": sql._with(*everything, """SELECT label, anchor, floor_mean, floor_p95, floor_pairs, usable_range,
CASE WHEN usable_range > 0 THEN printf('(sim - %.4f) / (%.4f - %.4f)', floor_mean, anchor, floor_mean) END AS formula FROM cal"""),
        "provenance": f"""WITH u AS ({sql.ORACLES['units']}) SELECT 'asr' AS stage, subset, asr, key, '{__version__}' AS engine, '{pyspark.__version__}' AS spark,
'{{"model":"' || model || '","audio":"{sql.AUDIO}","options":"{{\\"batch\\":16}}","fold_apostrophes":false,"row_limit":0,"schema":1}}' AS parameters FROM u""",
        "isolated_failures": "SELECT row_id, 'ValueError: nothing to hear' AS failure FROM sources WHERE text IS NOT NULL AND NOT regexp_matches(text, '\\p{L}')",
        "stub_judgements": """WITH t AS (SELECT row_id, lang, text, row_number() OVER (PARTITION BY lang ORDER BY row_id) AS rn FROM sources WHERE text IS NOT NULL)
SELECT row_id, lang, round(1 + 4 * ('0x' || left(md5(text), 2))::BIGINT / 255::DOUBLE, 6) AS mos FROM t WHERE rn <= 10""",
        "batch_infer": f"""WITH t AS (SELECT lang, text, CASE WHEN regexp_matches(text, '\\p{{L}}') THEN list_filter(string_split(translate(text, {sql.quoted(sql.SPACES + chr(9) + chr(10) + chr(13))}, {sql.quoted(' ' * (len(sql.SPACES) + 3))}), ' '), lambda w: w <> '') END AS w FROM sources),
h AS (SELECT *, list_filter(w, lambda x, i: ('0x' || left(md5('stub:' || (i - 1) || ':' || x), 2))::BIGINT >= 16) AS k FROM t)
SELECT lang, count(*) AS n, count(w) AS n_heard, count(*) FILTER (text IS NOT NULL AND w IS NULL) AS n_failed, sum(CASE WHEN w IS NOT NULL THEN greatest(1, len(k)) END)::BIGINT AS words FROM h GROUP BY lang""",
        "discover": f"""WITH a AS ({audit}), w AS ({sql.ORACLES['work_plan']}), u AS (SELECT subset, string_agg(asr, ', ' ORDER BY asr) AS recognisers, sum(n_rows)::BIGINT AS passes FROM w GROUP BY subset)
SELECT a.subset, n_joined, recognisers, passes, CASE WHEN clean THEN 'ok' ELSE concat_ws('; ', CASE WHEN n_unknown > 0 THEN n_unknown || ' unknown utt' END,
CASE WHEN n_not_synthesised > 0 THEN n_not_synthesised || ' not synthesised' END, CASE WHEN n_text_mismatch > 0 THEN n_text_mismatch || ' text mismatch' END) END AS status
FROM a LEFT JOIN u USING (subset)""",
        "daily_rates": sql._with(sql.POOL, """SELECT scored_at::DATE AS day, asr, count(*) AS n, sum(subs + dels + ins)::BIGINT AS errors, sum(n_ref_words)::BIGINT AS words,
round(sum(subs + dels + ins)::DOUBLE / nullif(sum(n_ref_words), 0)::DOUBLE, 9) AS wer_corpus FROM pool WHERE NOT missing GROUP BY day, asr"""),
    }
