"""What several operators need: reading tables, written intermediate tables, Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.functions.sizing import broadcast_if_within
from sparkrank.sources.scratch import scratch_root, write_table

Batches = Iterator[pa.RecordBatch]
#: Rows of text in an Arrow batch, and rows that a Python worker unpacks at a time.
BATCH, ROWS = 1000, 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_recording: list[list[DataFrame]] = []


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    made = write_table(df, scratch_root(df.sparkSession))
    for tables in _recording:
        tables.append(made)
    return made


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The tables that ``kept`` makes meanwhile."""
    tables: list[DataFrame] = []
    _recording.append(tables)
    try:
        yield tables
    finally:
        _recording.remove(tables)


def _folders(df: DataFrame) -> set[str]:
    return {file.rsplit("/", 1)[0] for file in df.inputFiles()}


def forget(*tables: DataFrame, but: DataFrame | None = None) -> None:
    """Remove the folders of tables made by ``kept`` that nothing reads any more.

    Only folders below ``spark.checkpoint.dir`` go, and none that ``but`` reads.
    """
    for df in tables:
        spark = df.sparkSession
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            continue
        hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        root = hadoop.Path(base)
        system = root.getFileSystem(conf)
        below = system.makeQualified(root).toString().rstrip("/") + "/"
        for folder in _folders(df) - (_folders(but) if but is not None else set()):
            path = system.makeQualified(hadoop.Path(folder))
            if path.toString().startswith(below):
                system.delete(path, True)


def only(df: DataFrame, rows: DataFrame, at: Column, name: str = "_row") -> DataFrame:
    """The rows of ``df`` whose number ``at`` is one of the longs in ``rows``.

    Numbers become bitmaps of 64 rows. These are written and measured: as long
    as they are small they go to ``df``, whose rows stay where they are, beyond
    that both sides are shuffled.
    """
    block = F.shiftright(F.col(name), 6).alias("_block")
    bit = F.expr(f"shiftleft(1L, cast({name} & 63 as int))")
    bits = kept(rows.groupBy(block).agg(F.bit_or(bit).alias("_bits")))
    joined = df.join(broadcast_if_within(bits), F.shiftright(at, 6) == F.col("_block"))
    own = F.call_function("shiftright", F.col("_bits"), at.bitwiseAND(F.lit(63)).cast("int"))
    return joined.where(own.bitwiseAND(F.lit(1)) == 1).select(*[df[f"`{c}`"] for c in df.columns])


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names``, with underscores in front where ``columns`` has such a name."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered_rows(docs: DataFrame) -> DataFrame:
    """(_row, _doc), written: a number per row, and the row as it is, so that no name can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    return kept(docs.select(F.monotonically_increasing_id().alias("_row"), whole))


def rows_of(numbered: DataFrame, rows: DataFrame) -> DataFrame:
    """The given rows of ``numbered_rows`` whose _row is in ``rows``."""
    return only(numbered, rows, numbered["_row"]).select("_doc.*")


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def per_batch(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType) -> DataFrame:
    """Apply ``make`` to the rows where they lie, ``ROWS`` at a time."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield make(batch.slice(at, ROWS))

    return in_batches(df).mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """Values as Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def in_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on the session hands rows to Python in batches of at most ``BATCH``.

    The usual 10,000 rows are too many where a row holds a whole document.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH:
        conf.set(name, BATCH)
    return df


def smallest(rows: DataFrame, n: int, name: str = "h") -> DataFrame:
    """The ``n`` rows with the smallest 64-bit hash in ``name``, all if fewer.

    Rows far above the expected cut are left out first, so that the task that
    sorts what remains gets little more than ``n`` rows, however many there are.
    """
    total = rows.count()
    wanted = n + 8 * math.isqrt(n) + 100
    if total > wanted:
        cut = -(1 << 63) + (1 << 64) * wanted // total
        near = rows.where(F.col(name) < F.lit(cut))
        rows = near if near.count() >= n else rows
    return rows.orderBy(name).limit(n)


def replaced(batch: pa.RecordBatch, name: str, values: list[str | None]) -> pa.RecordBatch:
    """``batch`` with other strings in one column."""
    at = batch.schema.get_field_index(name)
    field = batch.schema.field(at)
    return batch.set_column(at, field, pa.array(values, field.type))
