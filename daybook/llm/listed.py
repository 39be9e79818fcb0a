"""Joins of wide rows with a list of keys, without shuffling the rows that the list doesn't concern.

A list that a count proves small is broadcast. For a longer one, a Bloom filter of its keys goes to all tasks: rows that
it stops are surely not listed and stay where they are; only the others, listed ones and a few more, are shuffled. The
filter has FILTER_BITS bits at most, however long the list: past that more rows pass it, and the result is the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.scratch import is_at_most

#: Bits of a filter: so many for each key, rounded up to a power of two, between the two bounds.
BITS_EACH, LEAST_BITS, FILTER_BITS = 32, 1 << 16, 1 << 28
#: The two parts of a hash that are its places.
_SHIFTS = (0, 32)


def filter_of(hashes: DataFrame, count: int, most: int | None = None) -> np.ndarray:
    """A Bloom filter of about `count` hashes (column hash, 64 bits), as words of 64 bits."""
    bits = min(most or FILTER_BITS, max(LEAST_BITS, 1 << (BITS_EACH * max(count, 1) - 1).bit_length()))
    mask = F.lit(bits - 1).cast("long")
    place = F.explode(F.array(*(F.shiftrightunsigned("hash", s).bitwiseAND(mask) for s in _SHIFTS))).alias("place")
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    words = hashes.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("set"))
    # Two numbers for each word of the filter at most.
    found = words.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return out


def passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets pass: all that it was made of, and few others."""
    mask = np.uint64(64 * len(filter_) - 1)
    out = np.ones(len(hashes), bool)
    for shift in _SHIFTS:
        place = hashes >> np.uint64(shift) & mask
        out &= (filter_[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def joined(rows: DataFrame, listed: DataFrame, keys: list[str], how: str, most: int) -> DataFrame:
    """rows.join(listed, keys, how) for how in inner, left, left_semi and left_anti; `most` rows of the list may be broadcast.

    Null keys are equal to nothing. listed is read several times: it should be a written table.
    """
    if is_at_most(listed, most):
        return rows.join(F.broadcast(listed), keys, how)
    hashes = listed.select(F.xxhash64(*keys).alias("hash"))
    shared = rows.sparkSession.sparkContext.broadcast(filter_of(hashes, listed.count()))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(passes(shared.value, h.to_numpy().view(np.uint64)))

    passed = maybe(F.xxhash64(*keys))
    met = rows.where(passed).join(listed, keys, how)
    if how in ("inner", "left_semi"):
        return met
    others = [c for c in listed.columns if c not in keys] if how == "left" else []
    kind = {f.name: f.dataType for f in listed.schema}
    return rows.where(~passed).select("*", *(F.lit(None).cast(kind[c]).alias(c) for c in others)).unionByName(met)
