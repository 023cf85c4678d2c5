"""Counter-based randomness.

Every draw is a pure function of (seed, keys, slot), so a re-run task, another
partition count or another engine gives the same value. ``rand(seed)`` would
depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 13
SCALE = 16**DIGITS  # the range of keyed_int, exact as DOUBLE


def keyed_int(seed: int, slot: str | Column, *keys: Column) -> Column:
    """52-bit draw as BIGINT: the first 13 hex digits of md5('seed|key..|slot').

    Every value has an exact double, so a draw scaled to 0..size-1 stays below
    size and reaches all of it up to billions of rows.
    """
    slot_col = F.lit(slot) if isinstance(slot, str) else slot.cast("string")
    parts = [F.lit(str(seed)), *[k.cast("string") for k in keys], slot_col]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS), 16, 10).cast("bigint")


def keyed_uniform(seed: int, slot: str | Column, *keys: Column) -> Column:
    """Draw in [0, 1)."""
    return keyed_int(seed, slot, *keys) / F.lit(float(SCALE))


def keyed_bucket(draw: Column, buckets: int) -> Column:
    """Part 0..buckets-1 of a ``keyed_int``; it does not decrease with the draw."""
    return F.floor(draw / F.lit(float(SCALE)) * buckets).cast("bigint")


def keyed_index(seed: int, slot: str | Column, size: Column, *keys: Column) -> Column:
    """Draw in 0..size-1."""
    return F.floor(keyed_uniform(seed, slot, *keys) * size).cast("bigint")


def keyed_pick(seed: int, slot: str, values: Column, *keys: Column) -> Column:
    """One element of an array column; NULL for an empty array."""
    return F.get(values, keyed_index(seed, slot, F.size(values), *keys).cast("int"))


def keyed_subset(seed: int, size: Column, total: Column, *keys: Column) -> Column:
    """Array of ``size`` distinct positions out of 0..total-1, every subset equally likely.

    Draws without replacement by Floyd's method, so a query needs ``size`` draws
    and never a scan of the ``total`` candidates.
    """
    start = F.array().cast("array<bigint>")

    def step(chosen: Column, j: Column) -> Column:
        drawn = keyed_index(seed, F.concat(F.lit("s"), j.cast("string")), j + F.lit(1), *keys)
        return F.when(
            F.array_contains(chosen, drawn), F.concat(chosen, F.array(j))
        ).otherwise(F.concat(chosen, F.array(drawn)))

    draws = F.sequence((total - size).cast("bigint"), (total - F.lit(1)).cast("bigint"))
    return F.when(size > 0, F.aggregate(draws, start, step)).otherwise(start)
