"""Tolerant table scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..runtime import col


def table(spark: SparkSession, root: str, name: str, wanted: Iterable[str] | None = None) -> DataFrame:
    """The parquet table `root/name.parquet`; with wanted, only those of its columns that the file has."""
    df = spark.read.parquet(f"{root}/{name}.parquet")
    return df if wanted is None else present(df, wanted)


def present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that df has, in the wanted order; absent ones are left out silently."""
    return df.select([col(c) for c in wanted if c in df.columns])


def required(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns of df; an absent one is an error."""
    wanted = list(wanted)
    if absent := [c for c in wanted if c not in df.columns]:
        raise ValueError(f"no column {', '.join(absent)} (have: {', '.join(df.columns)})")
    return df.select([col(c) for c in wanted])


def column_names(spark: SparkSession, path: str) -> list[str]:
    """Names of a parquet file's columns, from its footer."""
    return spark.read.parquet(path).columns


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of parquet files, from their footers: the scan reads no column."""
    return spark.read.parquet(path).select().count()
