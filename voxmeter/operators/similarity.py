"""Speaker similarity: references, cosines, the scale between an impostor floor and an anchor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot
from ..runtime import broadcast_if_small, col


def first_eligible(rows: DataFrame, keys: Sequence[str], order: Sequence[str], eligible: Column, value: str) -> DataFrame:
    """(keys..., value): of each group the first row, by order, that is eligible; a group without one is left out.

    min_by aggregates before the shuffle, so a hot group costs one row a task.
    """
    return rows.where(eligible).groupBy(*(col(k) for k in keys)).agg(F.min_by(col(value), F.struct(*(col(o) for o in order))).alias(value))


def similarities(clips: DataFrame, speaker: str, vector: str, references: DataFrame, reference_vector: str) -> DataFrame:
    """Clips with column sim, the cosine to their speaker's reference; null where either is missing. Nothing is dropped."""
    refs = broadcast_if_small(references.select(col(speaker).alias("_speaker"), col(reference_vector).alias("_ref")))
    return clips.join(refs, clips[speaker] == refs["_speaker"], "left").withColumn("sim", dot(col(vector), F.col("_ref"))).drop("_speaker", "_ref")


#: Blocks that the prompts are dealt to.
BLOCKS = 64


def floors(voices: DataFrame, voice: str, vector: str, prompts: DataFrame, prompt: str, prompt_vector: str) -> DataFrame:
    """(voice, floor_mean, floor_p95, floor_pairs): cosines of each voice's vector to the other speakers' prompts.

    The floor of a voice is defined over all prompts, of which there is one a speaker. They are dealt to blocks by a
    hash; each voice meets each block once, in an equi-join, and its cosines to the block are one array.
    """
    blocks = prompts.groupBy(F.pmod(F.xxhash64(col(prompt)), F.lit(BLOCKS)).alias("_b")).agg(F.collect_list(F.struct(col(prompt).alias("p"), col(prompt_vector).alias("v"))).alias("_ps"))
    asked = voices.select(col(voice), col(vector).alias("_v"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(BLOCKS - 1).cast("long"))).alias("_b"))
    met = asked.join(blocks, "_b")
    cosines = F.transform(F.filter("_ps", lambda x: x["p"] != col(voice)), lambda x: dot(F.col("_v"), x["v"]))
    scored = met.select(col(voice), F.explode(cosines).alias("_s"))
    return scored.groupBy(col(voice)).agg(
        F.round(F.avg("_s"), 9).alias("floor_mean"), F.round(F.percentile("_s", F.lit(0.95)), 9).alias("floor_p95"), F.count("_s").alias("floor_pairs")
    )


def on_published_scale(rows: DataFrame, value: str, keys: Sequence[str], scale: DataFrame) -> DataFrame:
    """Rows with sim_norm on the published scale (keys..., floor_mean, anchor); keys that the scale lacks are an error."""
    side = scale.select(*(col(k).alias(f"_s_{k}") for k in keys), F.col("floor_mean").alias("_floor"), F.col("anchor").alias("_anchor"), F.lit(True).alias("_known"))
    on = [col(k) == col(f"_s_{k}") for k in keys]
    joined = rows.join(broadcast_if_small(side), on, "left")
    missed = F.raise_error(F.concat_ws(" ", F.lit("no published scale for"), *(col(k).cast("string") for k in keys)))
    norm = F.when(F.col("_known").isNull(), missed.cast("double")).otherwise(sim_norm(col(value), F.col("_floor"), F.col("_anchor")))
    return joined.withColumn("sim_norm", norm).drop("_known", "_floor", "_anchor", *(f"_s_{k}" for k in keys))


def anchors(chunks: DataFrame, voice: str, order: str, vector: str) -> DataFrame:
    """(voice, n_chunks, anchor): mean cosine over the unordered pairs of a recording's chunks, null below two.

    A voice has few chunks, at most the configured number, so its pairs are formed within one array.
    """
    held = chunks.groupBy(col(voice)).agg(F.sort_array(F.collect_list(F.struct(col(order).alias("o"), col(vector).alias("v")))).alias("_c"))
    n = F.size("_c")
    pairs = F.flatten(F.transform("_c", lambda a, i: F.transform(F.slice("_c", i + 2, n), lambda b: dot(a["v"], b["v"]))))
    total = F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)
    return held.select(col(voice), n.alias("n_chunks"), F.round(F.try_divide(total, F.size(pairs)), 9).alias("anchor"))


def sim_norm(sim: Column, floor: Column, anchor: Column) -> Column:
    """Position of sim between floor (0) and anchor (1); null unless the anchor is above the floor."""
    span = anchor - floor
    return F.when(span > 0, F.try_divide(sim - floor, span))


def calibrations(floor: DataFrame, anchor: DataFrame, voice: str) -> DataFrame:
    """Both ends of the scale by voice, its usable range, and the kind of anchor: intra_session, or none without one."""
    both = floor.join(anchor.withColumnRenamed(voice, "_voice"), col(voice) == F.col("_voice"), "left").drop("_voice")
    return both.withColumns({
        "usable_range": F.round(F.col("anchor") - F.col("floor_mean"), 9),
        "anchor_kind": F.when(F.col("anchor").isNull(), "none").otherwise("intra_session"),
    })


def distribution(x: Column) -> list[Column]:
    """Mean, median, 5th and 95th percentile (linear), and sample standard deviation, to six digits."""
    return [
        F.round(F.avg(x), 6).alias("mean"),
        F.round(F.percentile(x, F.lit(0.5)), 6).alias("median"),
        F.round(F.percentile(x, F.lit(0.05)), 6).alias("p05"),
        F.round(F.percentile(x, F.lit(0.95)), 6).alias("p95"),
        F.round(F.stddev_samp(x), 6).alias("std"),
    ]


def ordered_first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group by a total order; Spark keeps n rows a group and task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*(col(k) for k in keys)).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
