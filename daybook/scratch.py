"""Intermediate tables in the folder that driver and executors share.

A table written here cuts lineage and survives the loss of executors, which cached blocks and local checkpoints
do not. The folder is spark.checkpoint.dir as the cluster sets it; only a local-mode session without that setting
gets a temporary folder of its own, which goes when the process ends. No setting of the session is changed.

A run keeps nothing but its result (Scratch.result), which a caller reads for as long as they like; clean() deletes the
results of all runs of the application.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_KEY = "spark.checkpoint.dir"
#: Application to its own temporary folder, and to the folders of its runs.
_temporary: dict[str, str] = {}
_runs: dict[str, list[str]] = {}


def qualified(spark: SparkSession, path: str) -> str:
    """path with the scheme and authority that Hadoop, and so Spark, would use for it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if root:
        return qualified(spark, root.rstrip("/"))
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError(f"set {_KEY} to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _temporary:
        _temporary[app] = tempfile.mkdtemp(prefix="daybook-")
        atexit.register(shutil.rmtree, _temporary[app], ignore_errors=True)
    return "file:" + _temporary[app]


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def clean(spark: SparkSession) -> None:
    """Delete what all runs of this application left in the shared folder; frames that read it can't be used any more."""
    for root in _runs.pop(spark.sparkContext.applicationId, []):
        _delete(spark, root)


class Scratch:
    """A run's own folder of named tables."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        _runs.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def path(self, name: str) -> str:
        self.names.add(name)
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and return it read back; the schema is given, so that nothing is inferred."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def result(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Save df, and delete all other tables of the run."""
        out = self.save(df, name)
        self.drop(*(self.names - {name}))
        return out

    def drop(self, *names: str) -> None:
        """Delete tables that no plan reads any more."""
        for name in names:
            _delete(self.spark, f"{self.root}/{name}")
            self.names.discard(name)

    def release(self) -> None:
        """Delete the whole folder."""
        _delete(self.spark, self.root)
        runs = _runs.get(self.spark.sparkContext.applicationId, [])
        if self.root in runs:
            runs.remove(self.root)
        self.names.clear()


@contextmanager
def borrowed(spark: SparkSession) -> Iterator[None]:
    """Release all runs that begin inside, results too: for callers that have written what they need of them."""
    app = spark.sparkContext.applicationId
    before = set(_runs.get(app, []))
    try:
        yield
    finally:
        for root in [r for r in _runs.get(app, []) if r not in before]:
            _delete(spark, root)
            _runs[app].remove(root)


def is_at_most(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; reads no further than that."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcast where a count proves that it has at most so many rows, else df for a shuffled join."""
    return F.broadcast(df) if is_at_most(df, rows) else df
