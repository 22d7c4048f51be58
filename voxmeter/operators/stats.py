"""Error rates as ratios of sums, and bootstrap intervals over clusters as map-side sums.

A corpus rate is a ratio of sums, so a cluster's pair of sums is all that a resample needs. In each replicate a cluster
counts as often as a Poisson variable of mean 1 says, which depends on seed, replicate and cluster alone: no replicate has
to know the other clusters or how many there are, so nothing is numbered, drawn or joined. The weighted sums of a replicate
are added up before anything is shuffled; what is shuffled is one row per group, replicate and task, whatever the number
of clusters and utterances.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import col, width

REPLICATES, CONFIDENCE, SEED = 2000, 0.95, 20260725
CATASTROPHIC = 0.5
PAIR = ("_a", "_an", "_b", "_bn")
# Fixed values of the weights' hash: a prime modulus below 2^31, so that squares fit 64 bits, and multipliers.
MODULUS, STEP_REP, STEP_DRAW, MIX, ADD = 2147483647, 1103515245, 69069, 48271, 11


def rate(errors: Column, total: Column) -> Column:
    """Sum of errors over sum of totals; null where that is 0."""
    return F.try_divide(F.sum(errors).cast("double"), F.sum(total).cast("double"))


def share(condition: Column) -> Column:
    """Share of rows for which a condition holds; null counts as not holding."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def finite(x: Column) -> Column:
    """x, or null where it is NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def error_counts(threshold: float = CATASTROPHIC) -> dict[str, Column]:
    """What error_summary() is made of, as sums that add up over any parts of a group. Integers, but for _own."""
    err = F.col("subs") + F.col("dels") + F.col("ins")
    scored = ~F.col("missing")
    own = F.try_divide(err.cast("double"), F.col("n_ref_words").cast("double"))
    return {
        "n_scored": F.count_if(scored),
        "n_missing": F.count_if(~scored),
        "n_empty_ref": F.count_if(scored & (F.col("n_ref_words") == 0)),
        "n_transcription_failures": F.count("failure"),
        "n_below_min_samples": F.count_if(~scored & F.col("failure").isNull()),
        "_err": F.sum(err), "_ref": F.sum("n_ref_words"), "_cer": F.sum("cer_err"), "_chars": F.sum("n_ref_chars"),
        "_own": F.sum(own), "_n_own": F.count(own), "_wrong": F.count_if(own > threshold),
        "_exact": F.count_if(scored & (err == 0)), "_n_exact": F.count(F.when(scored, err)),
    }


def summed(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """error_summary() from error_counts() by (keys..., speaker_id)."""
    plain = ["n_scored", "n_missing", "n_empty_ref", "n_transcription_failures", "n_below_min_samples"]

    def ratio(a: str, b: str) -> Column:
        return F.round(F.try_divide(F.sum(a).cast("double"), F.sum(b).cast("double")), 9)

    return parts.groupBy(*(col(k) for k in keys)).agg(
        *(F.sum(n).alias(n) for n in plain),
        F.count_distinct(F.when(F.col("n_scored") > 0, F.col("speaker_id"))).alias("n_clusters"),
        ratio("_err", "_ref").alias("wer_corpus"), ratio("_own", "_n_own").alias("wer_macro"), ratio("_cer", "_chars").alias("cer_corpus"),
        ratio("_exact", "_n_exact").alias("exact_match"), ratio("_wrong", "_n_own").alias("catastrophic_rate"),
    )


def error_summary(pool: DataFrame, keys: Sequence[str], threshold: float = CATASTROPHIC) -> DataFrame:
    """The rates and counters of each group of a pool of scored rows.

    Missing rows are only counted. A row without reference words counts in the corpus rates' errors and in n_empty_ref,
    and has no rate of its own, so it is in none of the means. Groups are summed by speaker first, which counts the
    speakers without a second look at the rows.
    """
    counts = error_counts(threshold)
    return summed(pool.groupBy(*(col(k) for k in keys), "speaker_id").agg(*(c.alias(n) for n, c in counts.items())), keys)


def cluster_sums(rows: DataFrame, keys: Sequence[str], cluster: str, sums: dict[str, Column]) -> DataFrame:
    """(keys..., _cluster, sums...): the sums of each group's clusters.

    Rows without a cluster, and rows with a null among the summed columns, are left out.
    """
    named = rows.select(*(col(k) for k in keys), col(cluster).alias("_cluster"), *(c.cast("double").alias(n) for n, c in sums.items()))
    return named.dropna(subset=["_cluster", *sums]).groupBy(*(col(k) for k in keys), "_cluster").agg(*(F.sum(n).alias(n) for n in sums))


def weight_hash(rep: Column, cluster: Column, seed: int = SEED) -> Column:
    """A number in 0..MODULUS-1 that depends on seed, replicate and cluster (a number below MODULUS) alone."""
    h = (F.lit(seed).cast("long") + (rep + 1) * STEP_REP % MODULUS + (cluster + 1) * STEP_DRAW % MODULUS) % MODULUS
    for _ in range(2):
        h = (h * h % MODULUS * MIX + ADD) % MODULUS
    return h


def poisson_limits(modulus: int = MODULUS) -> list[int]:
    """Hashes below the k-th limit and not below the one before stand for k: Poisson's distribution of mean 1."""
    limits, term, total = [], math.exp(-1), 0.0
    for k in range(1, 13):
        total += term
        term /= k
        limits.append(round(total * modulus))
    return limits


def cluster_number(cluster: Column) -> Column:
    """A cluster's number below MODULUS, from the first 15 hex digits of its name's MD5."""
    return F.conv(F.left(F.md5(cluster.cast("string").cast("binary")), F.lit(15)), 16, 10).cast("long") % MODULUS


def resamples(clusters: DataFrame, keys: Sequence[str], names: Sequence[str], replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """(keys..., rep, sums...): the sums of each replicate's clusters, each as often as its weight says."""
    # rows multiply from here on, so a few clusters are spread over all cores
    spread = clusters.select(*(col(k) for k in keys), cluster_number(F.col("_cluster")).alias("_c"), *names).repartition(width(clusters.sparkSession), *(col(k) for k in keys), "_c")
    drawn = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("rep"))
    drawn = drawn.withColumn("_h", weight_hash(F.col("rep").cast("long"), F.col("_c"), seed))
    weight = F.lit(0)
    for k, limit in enumerate(poisson_limits()):
        weight = F.when(F.col("_h") < limit, k) if k == 0 else weight.when(F.col("_h") < limit, k)
    # a cluster that isn't drawn adds nothing, but a replicate without any cluster must not vanish
    weighted = drawn.withColumn("_w", weight.otherwise(len(poisson_limits())))
    return weighted.groupBy(*(col(k) for k in keys), "rep").agg(*(F.sum(F.col("_w") * F.col(n)).alias(n) for n in names))


def interval(value: Column, confidence: float = CONFIDENCE, names: tuple[str, str] = ("lo", "hi")) -> list[Column]:
    """Both ends of the interval that holds the middle share of a value's replicates."""
    alpha = 1 - confidence
    ends = F.percentile(value, F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return [F.round(ends[i], 9).alias(n) for i, n in enumerate(names)]


def cluster_bootstrap(
    rows: DataFrame, keys: Sequence[str], cluster: str, numerator: Column, denominator: Column,
    replicates: int = REPLICATES, confidence: float = CONFIDENCE, seed: int = SEED,
) -> DataFrame:
    """(keys..., n_clusters, point, lo, hi): a ratio of sums with its percentile interval over resampled clusters.

    A group of one cluster has an interval of width 0. A mean is the ratio of a sum and a count. Replicates whose
    denominator is 0, as where no cluster is drawn, don't count.
    """
    return intervals(cluster_sums(rows, keys, cluster, {"_a": numerator, "_n": denominator}), keys, replicates, confidence, seed)


def intervals(clusters: DataFrame, keys: Sequence[str], replicates: int = REPLICATES, confidence: float = CONFIDENCE, seed: int = SEED) -> DataFrame:
    """cluster_bootstrap() of clusters (keys..., _cluster, _a, _n)."""
    ratio = F.try_divide(F.col("_a"), F.col("_n"))
    bands = resamples(clusters, keys, ["_a", "_n"], replicates, seed).groupBy(*(col(k) for k in keys)).agg(*interval(ratio, confidence))
    points = clusters.groupBy(*(col(k) for k in keys)).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.round(F.try_divide(F.sum("_a"), F.sum("_n")), 9).alias("point")
    )
    return joined(points, bands, keys)


def paired_bootstrap(
    rows: DataFrame, keys: Sequence[str], cluster: str, a: tuple[Column, Column], b: tuple[Column, Column],
    replicates: int = REPLICATES, confidence: float = CONFIDENCE, seed: int = SEED,
) -> DataFrame:
    """(keys..., n_clusters, rate_a, rate_b, delta, lo, hi, p_a_better): the difference of two rates on the same clusters.

    a and b are numerator and denominator of either side in the same row. Every replicate draws clusters once for both.
    p_a_better is the share of replicates with a negative difference; ties don't count.
    """
    return paired_intervals(cluster_sums(rows, keys, cluster, dict(zip(PAIR, (*a, *b)))), keys, replicates, confidence, seed)


def paired_intervals(clusters: DataFrame, keys: Sequence[str], replicates: int = REPLICATES, confidence: float = CONFIDENCE, seed: int = SEED) -> DataFrame:
    """paired_bootstrap() of clusters (keys..., _cluster, and the sums named in PAIR)."""
    names = list(PAIR)
    delta = F.try_divide(F.col("_a"), F.col("_an")) - F.try_divide(F.col("_b"), F.col("_bn"))
    bands = resamples(clusters, keys, names, replicates, seed).groupBy(*(col(k) for k in keys)).agg(*interval(delta, confidence), F.round(F.avg((delta < 0).cast("double")), 9).alias("p_a_better"))
    ra, rb = F.try_divide(F.sum("_a"), F.sum("_an")), F.try_divide(F.sum("_b"), F.sum("_bn"))
    points = clusters.groupBy(*(col(k) for k in keys)).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.round(ra, 9).alias("rate_a"), F.round(rb, 9).alias("rate_b"), F.round(ra - rb, 9).alias("delta")
    )
    return joined(points, bands, keys)


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Two tables of one row per key joined on keys in which null equals null."""
    if not keys:
        return left.crossJoin(right)
    other = right.select(*(col(k).alias(f"_r_{k}") for k in keys), *(col(c) for c in right.columns if c not in keys))
    on = None
    for k in keys:
        one = col(k).eqNullSafe(col(f"_r_{k}"))
        on = one if on is None else on & one
    return left.join(other, on, how).drop(*(f"_r_{k}" for k in keys))
