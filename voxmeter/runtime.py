"""Session helpers shared by all operators: checkpoints, size-checked broadcasts, safe column names."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest size of a join side that may be broadcast, as Catalyst estimates it from compressed files; a hash table of
#: such a side takes some ten times as much memory.
BROADCAST_LIMIT = 1 << 20


def local_session(app: str = "voxmeter", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings that the engine is tested under."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one, removed at the end, only on a local master that names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="voxmeter-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read back: a cut lineage that survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of df, from file sizes and the plan; no job runs."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """df with a broadcast hint if its estimated size is within the limit, else df itself: the join then shuffles."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def col(name: str):
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def width(spark: SparkSession) -> int:
    """Partitions for rows that grow after their shuffle: size-based coalescing can't foresee that."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(scan: DataFrame) -> DataFrame:
    """A scan of at least as many partitions as there are cores, for row-wise maps in Python; larger scans as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
