"""Queries of the training-data operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stats import joined
from ..runtime import spread
from ..sources.tables import table
from .bpe import decoded, encode_documents, token_count, token_ids
from .canonical import _char_class, canonical_texts, code_points, lookalike_rows
from .language import document_languages, fit_profiles, language_segments, unnamed_languages
from .packing import pack_with_plan, packing_summary
from .quantiles import daily_sketches, percentiles

PROBABILITIES = (0.5, 0.9, 0.95, 0.99)


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return spread(table(spark, root, "documents"))


def _p2(spark: SparkSession, root: str) -> DataFrame:
    return lookalike_rows([
        ("sources", table(spark, root, "sources"), "row_id", "text", "lang"),
        ("asr", table(spark, root, "asr"), "row_id", "hyp_raw", "lang"),
    ])


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return _p2(spark, root).select("src_table", "row_id").distinct()


def p2_forms(spark: SparkSession, root: str) -> DataFrame:
    """The texts that change, before and after."""
    return _p2(spark, root)


def p2_sources(spark: SparkSession, root: str) -> DataFrame:
    """Every sources.text in canonical form."""
    return canonical_texts(table(spark, root, "sources"), "row_id", "text", "lang")


def _days(spark: SparkSession, root: str) -> DataFrame:
    return daily_sketches(table(spark, root, "sources"), ["lang", "len_bin"], "ingested_at", "anchor_wer")


def p4_percentiles(spark: SparkSession, root: str) -> DataFrame:
    """Percentiles of anchor_wer per lang and len_bin, combined from the sketches of single days."""
    return percentiles(_days(spark, root), ["lang", "len_bin"], PROBABILITIES)


def p4_days(spark: SparkSession, root: str) -> DataFrame:
    """The daily partial results' own percentiles."""
    return percentiles(_days(spark, root), ["lang", "len_bin", "day"], PROBABILITIES)


def p4_accuracy(spark: SparkSession, root: str) -> DataFrame:
    """Whether percentiles of a column that sketches do compact keep their bound: ranks against those of all values."""
    lines = table(spark, root, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice")
    answers = percentiles(daily_sketches(lines, ["l_returnflag"], "l_shipdate", "l_extendedprice"), ["l_returnflag"], PROBABILITIES)
    names = [f"p{100 * p:g}" for p in PROBABILITIES]
    both = lines.join(F.broadcast(answers.withColumnRenamed("l_returnflag", "_flag")), F.col("l_returnflag") == F.col("_flag"))
    v = F.col("l_extendedprice")
    ranks = both.groupBy("l_returnflag", "n", "rank_error").agg(*(x for a in names for x in (F.count_if(v < F.col(a)).alias(f"{a}_lt"), F.count_if(v <= F.col(a)).alias(f"{a}_le"))))
    slack, within = F.col("rank_error") * F.col("n"), F.lit(True)
    for p, a in zip(PROBABILITIES, names):
        rank = F.ceil(F.lit(p) * F.col("n"))
        within = within & (F.col(f"{a}_lt") - slack < rank) & (rank <= F.col(f"{a}_le") + slack)
    return ranks.select("l_returnflag", "n", (F.col("rank_error") > 0).alias("compacted"), (F.col("rank_error") < 0.02).alias("tight"), within.alias("within"))


def p6_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids of every document in the default vocabulary."""
    return encode_documents(_documents(spark, root), "doc_id", "text")


def p6_checks(spark: SparkSession, root: str) -> DataFrame:
    """One row: documents, those whose ids don't give their text back, and those that have ids without a text."""
    rows = _documents(spark, root).select("text", token_ids(F.col("text")).alias("ids"))
    same = decoded(F.col("ids")) == F.coalesce("text", F.lit(""))
    return rows.agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if(~same).alias("n_changed"), F.count_if((F.coalesce("text", F.lit("")) == "") & (F.size("ids") > 0)).alias("n_from_nothing")
    )


def _p7(spark: SparkSession, root: str):
    return pack_with_plan(_documents(spark, root), "doc_id", token_count(F.col("text")))


def p7_containers(spark: SparkSession, root: str) -> DataFrame:
    """Documents and their containers of 2,048 tokens."""
    return _p7(spark, root)[0]


def p7_summary(spark: SparkSession, root: str) -> DataFrame:
    """How full the containers are, and how many there must be at least."""
    return packing_summary(*_p7(spark, root))


def p7_checks(spark: SparkSession, root: str) -> DataFrame:
    """One row of what must hold: containers too full, short documents in pieces, documents lost, and nearness to the bound."""
    packed, plan = _p7(spark, root)
    full = packed.where("container IS NOT NULL").groupBy("container").agg(F.sum("tokens").alias("t")).agg(
        F.count_if(F.col("t") > plan.capacity).alias("n_overfull"), F.count_if(F.col("t") <= 0).alias("n_empty"), (F.count(F.lit(1)) <= 1.01 * plan.least + 1).alias("near_bound")
    )
    per = packed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"), F.sum("tokens").alias("t"))
    documents = table(spark, root, "documents").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    pieces = documents.join(per, "doc_id", "left").agg(
        F.sum("n").alias("n_documents"), F.count_if(F.col("k").isNull()).alias("n_lost"), F.count_if((F.col("t") <= plan.capacity) & (F.col("k") > F.col("n"))).alias("n_split")
    )
    return joined(pieces, full, [])


def _p8(spark: SparkSession, root: str) -> DataFrame:
    documents = _documents(spark, root)
    profiles = fit_profiles(documents, "doc_id", "text", "lang")
    return language_segments(documents, "doc_id", "text", ["lang"], profiles)


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return unnamed_languages(_p8(spark, root), "doc_id", "lang")


def p8_documents(spark: SparkSession, root: str) -> DataFrame:
    """Every document with its language and confidence."""
    return document_languages(_p8(spark, root), "doc_id", "lang")


def p8_segments(spark: SparkSession, root: str) -> DataFrame:
    """The segments of one language of every document."""
    rows = _p8(spark, root).select("doc_id", F.posexplode("segments").alias("segment", "s"))
    return rows.select("doc_id", "segment", "s.start", "s.end", "s.lang", "s.confidence", "s.words")


def queries() -> dict:
    return {"p4_percentiles": p4_percentiles, "p4_days": p4_days, "p4_accuracy": p4_accuracy, "p6_ids": p6_ids, "p6_checks": p6_checks, "p7_containers": p7_containers, "p7_summary": p7_summary, "p7_checks": p7_checks, "p8_found": p8_found, "p8_documents": p8_documents, "p8_segments": p8_segments, "p2_found": p2_found, "p2_forms": p2_forms, "p2_sources": p2_sources}


# The sketches are exact while they have compacted nothing, as on the oracle's tables.
_P4 = """
WITH v AS (SELECT {keys}, CASE WHEN isfinite(anchor_wer) THEN anchor_wer END AS v FROM sources),
r AS (SELECT *, row_number() OVER (PARTITION BY {names} ORDER BY v NULLS LAST) AS rn, count(v) OVER (PARTITION BY {names}) AS n FROM v)
SELECT {names}, max(n) AS n, {values}, 0.0::DOUBLE AS rank_error FROM r GROUP BY {names}
"""


def _p4(keys: str, names: str) -> str:
    at = ", ".join(f"max(CASE WHEN rn <= n AND rn = greatest(1, ceil({p}::DOUBLE * n)) THEN v END) AS p{100 * p:g}" for p in PROBABILITIES)
    return _P4.format(keys=keys, names=names, values=at)


def _p2_found() -> str:
    """p2_found by patterns over whole texts: no text is cut, joined or rebuilt. Only the tables are those of the operator."""
    rows = code_points()
    changed = _char_class(r[0] for r in rows if r[1] != r[0])
    within = {r[0] for r in rows if r[7] or r[1] == ""}

    def word(look: int, own: int) -> str:
        """A word with a foreign letter, every one of which has a look-alike."""
        mine, like = {r[0] for r in rows if r[4] and r[own]}, {r[0] for r in rows if r[4] and not r[own] and r[look] is not None}
        outside = _char_class({r[0] for r in rows if r[4]} | within).replace("[", "[^", 1)
        return f"(^|{outside}){_char_class(mine | within)}*{_char_class(like)}{_char_class(mine | like | within)}*($|{outside})"

    latin, cyrillic = word(2, 5), word(3, 6)
    return f"""WITH src AS (SELECT 'sources' AS src_table, row_id, lang, text AS t FROM sources UNION ALL SELECT 'asr', row_id, lang, hyp_raw FROM asr)
SELECT DISTINCT src_table, row_id FROM src WHERE t <> nfc_normalize(t) OR regexp_matches(t, '{changed}')
OR CASE WHEN coalesce(lower(left(lang, 2)) IN ('ky', 'ru'), false) THEN regexp_matches(t, '{cyrillic}') ELSE regexp_matches(t, '{latin}') END"""


def oracles() -> dict[str, str]:
    return {
        "p2_found": _p2_found(),
        "p6_checks": "SELECT count(*) AS n_documents, 0::BIGINT AS n_changed, 0::BIGINT AS n_from_nothing FROM documents",
        "p7_checks": "SELECT count(*) AS n_documents, 0::BIGINT AS n_lost, 0::BIGINT AS n_split, 0::BIGINT AS n_overfull, 0::BIGINT AS n_empty, true AS near_bound FROM documents",
        "p4_percentiles": _p4("lang, len_bin", "lang, len_bin"),
        # what the bound promises: that it holds, although the sketches compacted
        "p4_accuracy": "SELECT l_returnflag, count(*) AS n, true AS compacted, true AS tight, true AS within FROM lineitem GROUP BY l_returnflag",
        "p4_days": _p4("lang, len_bin, ingested_at::DATE AS day", "lang, len_bin, day"),
    }
