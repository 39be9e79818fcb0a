"""Raw objects as they arrive: a file stream that validates new ones, and the way of its batches into the lake.

One run takes what is there (Trigger.AvailableNow) and remembers it in the checkpoint. A batch is parsed once and written
under the stream's own id and its number, so one that is repeated after a failure replaces itself, and a stream that begins
anew, with another checkpoint, touches nobody's batches. publish() merges what isn't part of the lake yet, and the commit
that does it says up to which batch of each stream it went, so no batch counts twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from daybook.operators import validate
from daybook.plans.merge import add_lines
from daybook.schemas import QUARANTINE, SILVER
from daybook.sources import bronze
from daybook.sources.bronze import names_in
from daybook.sources.store import Change, Lake

#: What a batch holds: the columns of both tables, told apart by a folder.
_PARSED = StructType([*SILVER, StructField("reason", StringType()), StructField("raw", StringType()), StructField("refused", BooleanType())])


def ingest(spark: SparkSession, bronze_root: str, out: str, checkpoint: str, glob: str = "*") -> None:
    """Write the parsed lines of all new objects below out/stream=<id>/batch=<n>/refused=<whether>."""
    source = (
        spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", "true")
        .schema(StructType([StructField("value", StringType())])).load(f"{bronze_root.rstrip('/')}/{bronze.BRONZE}/{glob}")
    )
    objects = bronze.placed(source.select(bronze._key(spark, bronze_root, F.col("_metadata.file_path")).alias("source_key"), F.col("value").alias("body")))
    parsed = validate.parsed(bronze.numbered_lines(objects)).withColumn("refused", F.col("reason").isNotNull())

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("refused").parquet(f"{out}/stream={_stream(spark, checkpoint)}/batch={number}")

    parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _stream(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream and keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _batches(spark: SparkSession, out: str, done: dict[str, int]) -> dict[str, list[int]]:
    """Stream to the numbers of its batches that are written whole, those after the one that is done; only these are looked at."""
    found: dict[str, list[int]] = {}
    for stream in names_in(spark, out):
        name = stream.removeprefix("stream=")
        for batch in names_in(spark, f"{out}/{stream}") if name != stream else ():
            n = int(batch.removeprefix("batch=")) if batch.startswith("batch=") else -1
            if n > done.get(name, -1) and "_SUCCESS" in names_in(spark, f"{out}/{stream}/{batch}"):
                found.setdefault(name, []).append(n)
    return {k: sorted(v) for k, v in found.items()}


def _read(spark: SparkSession, out: str, batches: dict[str, list[int]]) -> DataFrame:
    paths = [f"{out}/stream={s}/batch={n}" for s, numbers in batches.items() for n in numbers]
    if not paths:
        return spark.createDataFrame([], _PARSED)
    return spark.read.schema(_PARSED).option("basePath", out).parquet(*paths)


def ingested(spark: SparkSession, out: str, table: str) -> DataFrame:
    """What the streams have written so far of silver or quarantine."""
    rows = _read(spark, out, _batches(spark, out, {})).where(F.col("refused") == (table == "quarantine"))
    return rows.select(*{"silver": SILVER, "quarantine": QUARANTINE}[table].fieldNames())


def publish(spark: SparkSession, out: str, lake: Lake) -> dict[str, dict]:
    """Merge the batches that the lake doesn't have yet into their days; the manifests of these days.

    Lines that a day has already, from a run or from another stream, change nothing; none is ever removed.
    """
    done = lake.snapshot().batches
    new = _batches(spark, out, done)
    if not new:
        return {}

    def published(change: Change) -> dict[str, int]:
        if any(change.base.batches.get(s) != done.get(s) for s in new):
            raise RuntimeError("these batches are being published by somebody else")
        return {s: max(numbers) for s, numbers in new.items()}

    return add_lines(lake, _read(spark, out, new).drop("refused", "stream", "batch"), "publish", published)
