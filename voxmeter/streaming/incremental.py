"""Scored rows as they arrive: rates by window of scoring time, with late rows up to a watermark and repeats dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, folder: str, like: DataFrame, files_per_trigger: int = 16) -> DataFrame:
    """Parquet files of a folder as a stream with the schema of a pool."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_rates(rows: DataFrame, window: str = "1 day", late: str = "30 days") -> DataFrame:
    """(start, asr, n, errors, words, wer_corpus) per window of scored_at; sums, so partial results add up."""
    timed = rows.where("NOT missing").withColumn("at", F.col("scored_at").cast("timestamp")).withWatermark("at", late)
    once = timed.dropDuplicatesWithinWatermark(["row_id"]) if rows.isStreaming else timed.dropDuplicates(["row_id"])
    sums = once.groupBy(F.window("at", window).alias("w"), "asr").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("subs") + F.col("dels") + F.col("ins")).alias("errors"), F.sum("n_ref_words").alias("words")
    )
    return sums.select(F.col("w.start").alias("start"), "asr", "n", "errors", "words", F.try_divide(F.col("errors").cast("double"), "words").alias("wer_corpus"))


def keep_rates(rows: DataFrame, out: str, checkpoint: str, window: str = "1 day", late: str = "30 days") -> StreamingQuery:
    """Writes each window once it is closed; what there is now, then stops. Restarts go on from the checkpoint."""
    return (
        windowed_rates(rows, window, late).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
