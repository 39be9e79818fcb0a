"""Refused lines as JSON-lines objects for people to mend, and the way back of mended ones.

A source is a service and a number, so that an object holds about LINES_EACH lines however many a service has. Objects are
written by Spark into an attempt's own folder and then renamed to their keys, so a key names a whole object or none; those
of earlier exports that the day no longer has are deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.days import check_dt, quarantine_key
from daybook.operators import validate
from daybook.plans.merge import add_lines
from daybook.sources.bronze import names_in
from daybook.sources.store import Lake

#: Lines of an exported object, about.
LINES_EACH = 100_000
_FIELDS = ("reason", "source_key", "raw", "row_uid")


def json_lines(rows: DataFrame) -> DataFrame:
    """rows (quarantine) with each one's JSON (json)."""
    return rows.withColumn("json", F.to_json(F.struct(*_FIELDS)))


def export(lake: Lake, root: str, dt: str, lines_each: int = LINES_EACH) -> list[str]:
    """Write the day's refused lines below root; the keys of the objects."""
    root = root.rstrip("/")
    rows = lake.read_of(lake.snapshot(), "quarantine", [check_dt(dt)]).withColumn("service", F.split("source_key", "/")[2])
    # One row for each service.
    numbers = F.broadcast(rows.groupBy("service").agg(F.ceil(F.count(F.lit(1)) / lines_each).alias("objects")))
    source = F.concat_ws("-", "service", F.pmod(F.xxhash64("row_uid"), "objects"))
    attempt = f"{root}/{quarantine_key(dt, '_attempt-' + uuid.uuid4().hex).removesuffix('.jsonl')}"
    made = json_lines(rows.join(numbers, "service").withColumn("source", source))
    made.select("source", "json").repartition("source").sortWithinPartitions("source", "json").write.partitionBy("source").text(attempt)
    fs, at = lake._fs(attempt)
    path, keys = lake.spark._jvm.org.apache.hadoop.fs.Path, []
    try:
        for folder in fs.listStatus(at):
            name = folder.getPath().getName()
            if not name.startswith("source="):
                continue
            parts = [x.getPath() for x in fs.listStatus(folder.getPath()) if x.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise RuntimeError(f"{name} was written as {len(parts)} files")
            key = quarantine_key(dt, name.removeprefix("source="))
            target = path(f"{root}/{key}")
            fs.delete(target, False)
            if not fs.rename(parts[0], target):
                raise RuntimeError(f"{key} couldn't be put in place")
            keys.append(key)
    finally:
        fs.delete(at, True)
    folder = keys[0].rpartition("/")[0] if keys else quarantine_key(dt, "x").rpartition("/")[0]
    for name in names_in(lake.spark, f"{root}/{folder}") - {k.rpartition("/")[2] for k in keys}:
        fs.delete(path(f"{root}/{folder}/{name}"), True)
    return sorted(keys)


def exported(lake: Lake, root: str, dt: str) -> DataFrame:
    """reason, source_key, raw, row_uid, dt of a day's exported lines, as they are now."""
    folder = f"{root.rstrip('/')}/{quarantine_key(check_dt(dt), 'x').rpartition('/')[0]}"
    schema = ", ".join(f"{c} string" for c in _FIELDS)
    if not names_in(lake.spark, folder):
        return lake.spark.createDataFrame([], schema + ", dt string")
    # A folder named dt=... isn't a partition here: the day is given.
    found = lake.spark.read.schema(schema).option("recursiveFileLookup", "true").json(folder)
    return found.where("raw is not null").withColumn("dt", F.lit(dt))


def readmit(lake: Lake, root: str, dt: str) -> dict[str, dict]:
    """Validate the exported lines again, under the ids they had: those that are valid now leave the quarantine for silver."""
    lines = exported(lake, root, dt)
    numbered = lines.select(
        "dt", F.split("source_key", "/")[2].alias("service"), "source_key", F.substring_index("row_uid", "#", -1).cast("int").alias("line_index"), F.col("raw").alias("line")
    )
    return add_lines(lake, validate.parsed(numbered), "readmit")
