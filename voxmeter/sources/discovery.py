"""Finding benchmark files and synthesis subsets, and admitting them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import col

#: `<lang>__<voice>` as a folder or file name.
SUBSET_NAME = r"([^_/]+(?:-[^_/]+)?)__([^/]+)"


def files_of(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length) of the files below a folder; their contents aren't read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return listed.select("path", "length")


def benchmark_scan(spark: SparkSession, root: str, lang: str, split: str = "main") -> DataFrame:
    """The one shard of a language: `<root>/<lang>/<split>-*.parquet`, else any parquet file there.

    None, or more than one, is an error.
    """
    files = files_of(spark, f"{root}/{lang}")
    is_split = F.element_at(F.split("path", "/"), -1).startswith(f"{split}-")
    one = files.agg(F.count_if(is_split).alias("own"), F.count(F.lit(1)).alias("all"), F.coalesce(F.min(F.when(is_split, F.col("path"))), F.min("path")).alias("path")).first()
    if (one["own"] or one["all"]) != 1:
        raise ValueError(f"{root}/{lang}: expected one shard of {split}, found {one['own'] or one['all']}")
    return spark.read.parquet(one["path"])


def nested_subsets(spark: SparkSession, root: str, languages: Sequence[str]) -> DataFrame:
    """Subsets of `<root>/<lang>/<voice>.parquet`: (subset, lang, voice, path)."""
    f = files_of(spark, root)
    lang, voice = F.regexp_extract("path", r"([^/]+)/([^/]+)\.parquet$", 1), F.regexp_extract("path", r"([^/]+)/([^/]+)\.parquet$", 2)
    rows = f.select(lang.alias("lang"), voice.alias("voice"), "path").where(F.col("lang").isin(*languages) & ~F.col("voice").startswith("."))
    return rows.select(F.concat_ws("__", "lang", "voice").alias("subset"), "lang", "voice", "path")


def flat_subsets(spark: SparkSession, root: str, split: str = "main") -> DataFrame:
    """Subsets of `<root>/<lang>__<voice>/<split>-*.parquet`, the first file of each: (subset, lang, voice, path)."""
    f = files_of(spark, root, f"{split}-*.parquet")
    parts = rf"/{SUBSET_NAME}/[^/]+\.parquet$"
    rows = f.select(F.regexp_extract("path", parts, 1).alias("lang"), F.regexp_extract("path", parts, 2).alias("voice"), "path").where("lang <> ''")
    first = rows.groupBy("lang", "voice").agg(F.min("path").alias("path"))
    return first.select(F.concat_ws("__", "lang", "voice").alias("subset"), "lang", "voice", "path")


def admitted(subsets: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Subsets that include names (all, if null) and exclude doesn't."""
    if include is not None:
        subsets = subsets.where(F.col("subset").isin(*include)) if include else subsets.limit(0)
    return subsets.where(~F.col("subset").isin(*exclude)) if exclude else subsets


def config_names(card: DataFrame, line: str) -> DataFrame:
    """(config_name): what follows `config_name:` in the lines of a dataset card, trimmed."""
    name = F.regexp_extract(col(line), r"config_name:\s*(.*?)\s*$", 1)
    return card.where(col(line).rlike(r"config_name:")).select(name.alias("config_name"))


def synthesis_scan(spark: SparkSession, paths: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Files of synthesised clips with the columns named as configured (wanted: name in the file), those they have.

    lang, voice and subset come from the path.
    """
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    path = F.col("_metadata.file_path")
    flat = rf"/{SUBSET_NAME}/[^/]+\.parquet$"
    nested = r"([^/]+)/([^/]+)\.parquet$"
    is_flat = F.regexp_extract(path, flat, 1) != ""
    lang = F.when(is_flat, F.regexp_extract(path, flat, 1)).otherwise(F.regexp_extract(path, nested, 1))
    voice = F.when(is_flat, F.regexp_extract(path, flat, 2)).otherwise(F.regexp_extract(path, nested, 2))
    named = [col(own).alias(want) for want, own in columns.items() if own in df.columns]
    return df.select(*named, lang.alias("subset_lang"), voice.alias("subset_voice"), F.concat_ws("__", lang, voice).alias("subset"))


def published_calibration(spark: SparkSession, path: str) -> DataFrame:
    """The published scale: (lang, encoder, anchor, floor_mean, floor_p95, floor_pairs) of a CSV file."""
    df = spark.read.option("header", "true").csv(path)
    pairs = col("floor pairs") if "floor pairs" in df.columns else F.lit(None)
    return df.select(
        "lang", "encoder", col("anchor").cast("double").alias("anchor"), col("floor mean").cast("double").alias("floor_mean"),
        col("floor p95").cast("double").alias("floor_p95"), pairs.cast("long").alias("floor_pairs"),
    )
