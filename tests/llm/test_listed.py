"""Joins behind a filter give what plain joins give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import listed
from daybook.llm.common import BATCHES, bounded_batches


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("bits", [listed.FILTER_BITS, 64])
def test_as_plain_joins(spark, monkeypatch, how, bits):
    monkeypatch.setattr(listed, "FILTER_BITS", bits)
    rows = spark.createDataFrame([(i % 50 if i % 11 else None, str(i % 7), f"wide {i}") for i in range(300)], "a long, b string, text string").repartition(3)
    few = spark.createDataFrame([(i, str(i % 7), i * 10) for i in range(0, 80, 3)] + [(None, "1", 5)], "a long, b string, n int")
    want = sorted(map(repr, rows.join(few, ["a", "b"], how).collect()))
    assert want and want == sorted(map(repr, listed.joined(rows, few, ["a", "b"], how, 1000).collect()))
    got = listed.joined(rows, few, ["a", "b"], how, 0)
    assert got.columns == rows.join(few, ["a", "b"], how).columns and sorted(map(repr, got.collect())) == want


def test_a_filter_stops_most_and_loses_none(spark):
    hashes = spark.range(2000).select(F.xxhash64("id").alias("hash"))
    filter_ = listed.filter_of(hashes, 2000)
    assert len(filter_) * 64 == 1 << 16
    own = np.array([r[0] for r in hashes.collect()], np.int64).view(np.uint64)
    others = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert listed.passes(filter_, own).all() and listed.passes(filter_, others).mean() < 0.02
    assert not listed.passes(listed.filter_of(hashes.limit(0), 0), own).any()


def test_settings_come_back(spark):
    key = next(iter(BATCHES))
    before = dict(spark.conf.getAll)
    with pytest.raises(ValueError), bounded_batches(spark):
        assert spark.conf.get(key) == BATCHES[key]
        raise ValueError
    assert dict(spark.conf.getAll) == before
    spark.conf.set(key, "77")
    with bounded_batches(spark):
        assert spark.conf.get(key) == BATCHES[key]
    assert spark.conf.get(key) == "77"
    spark.conf.unset(key)
