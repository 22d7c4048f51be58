"""Queries that go through files: layouts of clips and benchmarks, CSV tables, cached units, a published scale.

Each writes what it needs from the tables below the shared checkpoint folder, in a folder of its own, and reads it back
by the sources and sinks of the engine, so that these are checked on whole tables too.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cache import ResultCache, Unit
from ..operators import similarity as sim
from ..operators import stats
from ..runtime import ensure_checkpoint_dir
from ..sources import discovery, sinks
from . import evaluation as ev
from . import evaluation_sql as sql


def _folder(spark: SparkSession) -> sinks.Folder:
    out = sinks.Folder(spark, f"{ensure_checkpoint_dir(spark)}/files-{uuid4().hex}")
    out.renew()
    return out


def _laid_out(df: DataFrame, by: str) -> sinks.Folder:
    """df as `<value of by>/main-<n>.parquet`, one file a value."""
    out = _folder(df.sparkSession)
    df.withColumn("_part", F.col(by)).repartition(by).write.mode("overwrite").partitionBy("_part").parquet(out.path)
    for path, _ in out.files():
        folder, _, name = path.rpartition("/")
        if folder.startswith("_part="):
            out.rename(path, f"{folder.removeprefix('_part=')}/main-{name}")
    return out


def subset_files(spark: SparkSession, root: str) -> DataFrame:
    """Clips laid out as files of subsets, discovered and scanned: clips and mean duration by subset."""
    clips = ev.pool(spark, root).where("utt IS NOT NULL").groupBy("subset", "utt").agg(F.max(stats.finite(F.col("gen_dur"))).alias("audio_seconds"))
    at = _laid_out(clips, "subset").path
    found = discovery.admitted(discovery.flat_subsets(spark, at), include=None, exclude=["nl-NL__femke_veen_f"])
    scan = discovery.synthesis_scan(spark, [r["path"] for r in found.collect()], {"key": "utt", "duration": "audio_seconds", "latency": "gen_seconds"})
    return scan.groupBy("subset", F.col("subset_lang").alias("lang"), F.col("subset_voice").alias("voice")).agg(F.count("key").alias("n"), F.round(F.avg("duration"), 9).alias("mean_duration"))


def benchmark_files(spark: SparkSession, root: str) -> DataFrame:
    """The benchmark laid out by language, each language's one shard resolved: rows and texts."""
    rows = ev.benchmark(spark, root, ["lang", "text"]).where("lang IS NOT NULL")
    at = _laid_out(rows, "lang").path
    out = None
    for lang in sorted(r["lang"] for r in rows.select("lang").distinct().collect()):
        one = discovery.benchmark_scan(spark, at, lang)
        out = one if out is None else out.unionByName(one)
    return out.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count("text").alias("n_texts"))


def csv_tables(spark: SparkSession, root: str) -> DataFrame:
    """A report table written as CSV and read back with its schema."""
    df = ev.error_summary(spark, root)
    at = _folder(spark).at("error_summary")
    sinks.write_csv(df, at)
    return sinks.read_csv(spark, at, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields))


def cached_pool(spark: SparkSession, root: str) -> DataFrame:
    """Units of one recogniser each, saved and pooled; an old result under another fingerprint is left out."""
    rows = ev.pool(spark, root).select("row_id", "subset", "asr", "subs", "n_ref_words", "missing")
    cache = ResultCache(spark, _folder(spark).path)
    units = [Unit("asr", a, {"engine": a, "schema": 1}) for a in sorted(r["asr"] for r in rows.select("asr").distinct().collect())]
    cache.save(Unit("asr", units[0].name, {"engine": units[0].name, "schema": 0}), rows.limit(0), {})
    for unit in cache.pending(units):
        cache.save(unit, rows.where(F.col("asr") == unit.name), {"n": 1})
    if cache.pending(units):
        raise RuntimeError("a saved unit is still pending")
    return cache.pool(units).groupBy("asr", "unit").agg(F.count(F.lit(1)).alias("n"), F.sum("subs").alias("subs"), F.sum("n_ref_words").alias("words"), F.count_if("missing").alias("n_missing"))


def scale_files(spark: SparkSession, root: str) -> DataFrame:
    """The published scale as a CSV file, and the benchmark's own similarities put on it."""
    scale = ev.human_similarity(spark, root).select("lang", "encoder", "anchor", F.col("p05").alias("floor mean"), F.col("p05").alias("floor p95"), F.col("n").alias("floor pairs"))
    at = _folder(spark).at("sim")
    sinks.write_csv(scale, at)
    rows = ev.benchmark(spark, root, ["lang", "anchor_sim_ecapa"]).select("utt", "lang", F.lit("ecapa").alias("encoder"), stats.finite(F.col("anchor_sim_ecapa")).alias("sim")).where("sim IS NOT NULL")
    scaled = sim.on_published_scale(rows, "sim", ["lang", "encoder"], discovery.published_calibration(spark, at))
    return scaled.select("utt", "encoder", F.round("sim_norm", 6).alias("sim_norm"))


NAMES = [subset_files, benchmark_files, csv_tables, cached_pool, scale_files]


def queries() -> dict:
    return {f.__name__: f for f in NAMES}


def oracles() -> dict[str, str]:
    clips = "clips AS (SELECT subset, utt, max(CASE WHEN isfinite(gen_dur) THEN gen_dur END) AS d FROM pool WHERE utt IS NOT NULL GROUP BY subset, utt)"
    return {
        "subset_files": sql._with(sql.POOL, clips, """SELECT subset, split_part(subset, '__', 1) AS lang, split_part(subset, '__', 2) AS voice, count(*) AS n, round(avg(d), 9) AS mean_duration
FROM clips WHERE subset <> 'nl-NL__femke_veen_f' GROUP BY subset"""),
        "benchmark_files": sql._with(sql.BENCH, "SELECT lang, count(*) AS n, count(text) AS n_texts FROM bench WHERE lang IS NOT NULL GROUP BY lang"),
        "csv_tables": sql.ORACLES["error_summary"],
        "cached_pool": sql._with(sql.POOL, "SELECT asr, asr AS unit, count(*) AS n, sum(subs)::BIGINT AS subs, sum(n_ref_words)::BIGINT AS words, count(*) FILTER (missing) AS n_missing FROM pool GROUP BY asr"),
        "scale_files": f"SELECT utt, 'ecapa' AS encoder, sim_norm FROM ({sql.ORACLES['published_lookup']})",
    }
