"""Raw objects: <root>/api-metrics/<day>/<service>/.../<object>, each of JSON lines.

Listing and reading are Spark's own file scans, so they work on any store that Hadoop reads, and many small objects are
packed into few tasks. Objects right under the day, and names that begin with _ or a dot, are not part of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions.columns import lines, trimmed
from daybook.functions.days import BRONZE, check_dt
from daybook.scratch import Scratch


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def names_in(spark: SparkSession, path: str) -> set[str]:
    """What a folder holds, by one call to its store; nothing if there is no such folder."""
    p = _path(spark, path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return {x.getPath().getName() for x in fs.listStatus(p)} if fs.exists(p) else set()


def _key(spark: SparkSession, root: str, path: Column) -> Column:
    """The object's key: its decoded path below root."""
    base = _path(spark, root.rstrip("/") or "/").toUri().getPath().rstrip("/")
    plain = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    return F.substring(plain, len(base) + 2, 1 << 30)


def placed(df: DataFrame) -> DataFrame:
    """With dt and service from the key; objects under no service are left out."""
    part = F.split("source_key", "/")
    return df.withColumns({"dt": part[1], "service": part[2]}).where(F.size(part) > 3)


def _folders(spark: SparkSession, root: str, days: list[str]) -> list[str]:
    base = f"{root.rstrip('/')}/{BRONZE}"
    there = names_in(spark, base)
    return [f"{base}/{d}" for d in days if check_dt(d) in there]


def listing(spark: SparkSession, root: str, days: list[str]) -> DataFrame:
    """source_key, length, modified, dt, service of all objects of the days; contents are not read."""
    folders = _folders(spark, root, days)
    if not folders:
        return spark.createDataFrame([], "source_key string, length long, modified timestamp, dt string, service string")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    sizes = found.select(_key(spark, root, F.col("_metadata.file_path")).alias("source_key"), "length", F.col("modificationTime").alias("modified"))
    # Scans skip empty objects, which the index behind them holds; its names stay on the JVM's side.
    jvm = spark._jvm
    paths = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found._jdf.inputFiles())
    index = spark._jsparkSession.createDataset(paths, jvm.org.apache.spark.sql.Encoders.STRING())
    names = DataFrame(index.toDF(), spark).select(_key(spark, root, F.col("value")).alias("source_key"))
    return placed(names.join(sizes, "source_key", "left").select("source_key", F.coalesce("length", F.lit(0)).alias("length"), "modified"))


def services(found: DataFrame) -> DataFrame:
    return found.select("dt", "service").distinct()


#: What a scan says about the object that a line is from.
SEEN = ("length", "modified")
#: Bytes from which an object is read in several splits.
SPLIT_FROM = 64 << 20


def _seen() -> list[Column]:
    return [F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_modification_time").alias("modified")]


def _scan(spark: SparkSession, whole: bool) -> DataFrameReader:
    # DataFrameReader.text() sets wholetext by itself, to false.
    reader = spark.read.format("text").option("recursiveFileLookup", "true").option("ignoreMissingFiles", True)
    return reader.option("wholetext", True) if whole else reader.option("lineSep", "\n")


def bodies(spark: SparkSession, root: str, days: list[str], keys: list[str] | None = None) -> DataFrame:
    """source_key, dt, service, body, length, modified of all objects that are there, or of those listed; one that vanishes
    is left out, not an error."""
    paths = _folders(spark, root, days) if keys is None else [f"{root.rstrip('/')}/{k}" for k in keys]
    if not paths:
        return spark.createDataFrame([], "source_key string, body string, length long, modified timestamp, dt string, service string")
    found = _scan(spark, True).load([_literal(p) for p in paths])
    return placed(found.select(_key(spark, root, F.col("_metadata.file_path")).alias("source_key"), F.col("value").alias("body"), *_seen()))


def _literal(path: str) -> str:
    """A path that no character of means a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def split_lines(spark: SparkSession, root: str, keys: list[str], scratch: Scratch) -> DataFrame:
    """source_key, dt, service, line_index, line, length, modified of large objects, which many tasks read by ranges of bytes.

    A line belongs to the range it begins in. The lines of a range are numbered as they are read, and written; the numbers
    of lines of the ranges before, of which there are few, then make them those of the object.
    """
    found = _scan(spark, False).load([_literal(f"{root.rstrip('/')}/{k}") for k in keys])
    path = F.col("_metadata.file_path")
    lines_ = found.select(path.alias("path"), F.col("_metadata.file_block_start").alias("start"), trimmed(F.col("value")).alias("line"), *_seen())
    stored = scratch.save(lines_.where(F.length("line") > 0).withColumn("at", F.monotonically_increasing_id()), f"split-lines-{len(scratch.names)}")
    ranges = stored.groupBy("path", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("start")) - F.col("n")
    ranges = ranges.select("path", "start", (before - F.col("first")).alias("shift"))
    numbered = stored.join(ranges, ["path", "start"]).withColumn("line_index", (F.col("at") + F.col("shift")).cast("int"))
    return placed(numbered.select(_key(spark, root, F.col("path")).alias("source_key"), "line_index", "line", *SEEN))


def read_lines(spark: SparkSession, root: str, listed: DataFrame, scratch: Scratch, days: list[str] | None = None) -> DataFrame:
    """The numbered lines of the days' objects, or of the listed ones only; large ones by ranges, objects without lines with a null.

    listed: their source_key and length; the names of the large ones, each of them over SPLIT_FROM bytes, go through the driver,
    as all names do that a scan is given.
    """
    large = [r[0] for r in listed.where(F.col("length") >= SPLIT_FROM).select("source_key").collect()]
    if days is None:
        small = [r[0] for r in listed.where((F.col("length") > 0) & (F.col("length") < SPLIT_FROM)).select("source_key").collect()]
        whole = bodies(spark, root, [], small)
    else:
        whole = bodies(spark, root, days)
    if not large:
        return numbered_lines(whole, outer=True)
    # The scan itself knows how long an object is, so a large one isn't opened as a whole.
    whole = whole.where(F.col("length") < SPLIT_FROM)
    parts = split_lines(spark, root, large, scratch)
    return numbered_lines(whole, outer=True).unionByName(parts)


def numbered_lines(objects: DataFrame, outer: bool = False) -> DataFrame:
    """source_key, dt, service, line_index, line: indexes count the non-blank lines of each object from 0.

    outer: objects without lines keep a row, whose index and line are null.
    """
    split = F.posexplode_outer if outer else F.posexplode
    return objects.select("source_key", "dt", "service", split(lines(F.col("body"))).alias("line_index", "line"), *(c for c in SEEN if c in objects.columns))
