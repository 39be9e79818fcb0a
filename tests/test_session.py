"""How a scan is dealt to tasks."""

import pytest
from pyspark.sql import functions as F

from daybook import session
from daybook.plans import workload as w


@pytest.fixture
def folder(spark, tmp_path):
    """1,000 events in one row group."""
    events = spark.range(1000).select(
        F.col("id").alias("event_id"), F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"), F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props"),
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.mark.parametrize("small", [session.SPREAD_BYTES, 0])
def test_lines_are_validated_in_tasks_of_so_many_rows(spark, monkeypatch, folder, small):
    monkeypatch.setattr(session, "SPREAD_BYTES", small)
    monkeypatch.setattr(session, "TASK_ROWS", 100, raising=False)
    assert sizes(w.parsed(spark, folder)) == [100] * 10


def test_small_splits_stay(spark, monkeypatch, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(session, "SPREAD_BYTES", 0)
    assert sizes(session.dealt(rows)) == [1000]
    assert session.dealt(rows.limit(0)).count() == 0
