"""Session defaults that the engine's semantics rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Semantics, not tuning: UTC days, per-partition overwrite, last duplicate JSON key wins.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests, benches and the command line."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daybook")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session made elsewhere."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


#: Bytes of files beyond which a scan is never dealt anew: its splits are as many as they should be.
SPREAD_BYTES = 256 << 20


def spread(rows: DataFrame) -> DataFrame:
    """A scan of a few small files dealt over all cores, most of which they would keep idle; any larger one stays as it is."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if size <= SPREAD_BYTES and rows.rdd.getNumPartitions() < cores else rows


#: Rows of a scan that a task should have at most where each row is much work.
TASK_ROWS = 100_000


def dealt(rows: DataFrame) -> DataFrame:
    """A scan for work by the row: the tasks grow in number with the rows, not in size.

    A split is so many bytes, of which narrow rows take few, and gets whole row groups, so that some splits have none. The
    rows of each split are counted first, which takes the files' footers only; a scan whose splits are small is just spread.
    """
    split = rows.groupBy(F.spark_partition_id().alias("split")).count()
    most, total = split.agg(F.max("count"), F.sum("count")).first()
    if (most or 0) <= TASK_ROWS:
        return spread(rows)
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_ROWS)))
