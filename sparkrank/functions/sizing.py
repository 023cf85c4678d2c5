"""Sizes that are measured before they are relied on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 128 * 1024 * 1024
SALTS = 32


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(16)
    for field in df.schema.fields:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(name), F.lit(0)) + 8
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            total = total + F.coalesce(F.size(name), F.lit(0)) * 16
        else:
            total = total + 16
    return total.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, from one distributed aggregate."""
    return df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()["b"]


def broadcast_if_within(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within ``limit``.

    Beyond it no hint is given and the join that uses ``df`` shuffles both sides.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def join_small(
    rows: DataFrame,
    small: DataFrame,
    on: list[str],
    spread_by: str,
    limit: int = BROADCAST_BYTES,
    bound: int | None = None,
) -> DataFrame:
    """Inner join of a large table with a side that is mostly small.

    Within ``limit`` the small side is broadcast and ``rows`` stay where they
    are. Beyond it both sides are shuffled by ``on`` and a salt made of
    ``spread_by``, so that a value held by most of ``rows`` is split over
    ``SALTS`` tasks; the other side is repeated once per salt. ``bound`` is an
    upper bound of the size of ``small`` that the caller has measured.
    """
    if (measured_bytes(small) if bound is None else bound) <= limit:
        return rows.join(F.broadcast(small), on)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*on, "_salt"]).drop("_salt")
