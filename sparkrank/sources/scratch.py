"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import json
import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parquet files that make one bucket, and its rows at most. A task that builds
#: postings holds some forty times these bytes: each token is a row of its own.
BUCKET_BYTES = 8 * 1024 * 1024
BUCKET_ROWS = 50_000
#: Spark allows 100,000; beyond this number buckets grow instead.
MAX_BUCKETS = 50_000


def scratch_root(spark: SparkSession) -> str:
    """New folder below ``spark.checkpoint.dir``.

    Only a local master may go without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sparkrank-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write and read back: cuts the lineage, survives the loss of executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_facts(spark: SparkSession, path: str, **facts: Column) -> None:
    """One row of constants that describes a written table."""
    row = spark.range(1).select(*[value.alias(name) for name, value in facts.items()])
    row.coalesce(1).write.mode("overwrite").parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_bucketed(
    df: DataFrame, path: str, sort: list[str], buckets: int | None = None, partition: str | None = None
) -> DataFrame:
    """Write hash-bucketed by ``id``; groupings that contain ``id`` then need no shuffle.

    ``partition`` names a column whose values get a folder each, so that a filter
    on it reads only those.

    Every write goes to a folder of its own, named by ``<path>/current`` once it
    is complete, so a failed or repeated write harms no reader.
    """
    spark = df.sparkSession
    n = buckets or shuffle_width(spark)
    build = uuid.uuid4().hex
    name = f"sr_{build}"
    writer = df.repartition(n, "id").write.bucketBy(n, "id").sortBy(*sort)
    if partition:
        writer = writer.partitionBy(partition)
    writer.option("path", f"{path}/{build}").saveAsTable(name)
    write_facts(
        spark, f"{path}/current", build=F.lit(build), buckets=F.lit(n), sort=F.lit(sort),
        partition=F.lit(partition).cast("string"), schema=F.lit(df.schema.json()),
    )
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The last complete write of ``write_bucketed``, also of another session."""
    current = spark.read.parquet(f"{path}/current").first()
    location = f"{path}/{current['build']}"
    name = f"sr_{uuid.uuid4().hex}"
    schema = T.StructType.fromJson(json.loads(current["schema"]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parted = f"PARTITIONED BY ({current['partition']})" if current["partition"] else ""
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet {parted} CLUSTERED BY (id) SORTED BY "
        f"({', '.join(current['sort'])}) INTO {current['buckets']} BUCKETS LOCATION '{location}'"
    )
    if parted:
        spark.catalog.recoverPartitions(name)
    opened = spark.table(name)
    for field in schema.fields:
        if field.metadata:
            opened = opened.withMetadata(field.name, field.metadata)
    return opened


def bucket_count(spark: SparkSession, path: str) -> int:
    """Buckets for the table at ``path`` and all that is derived from it: one per core, or more if it is large.

    The size is that of its files and the rows that they name; no row is read.
    """
    files = spark.read.format("binaryFile").load(path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    by_size = math.ceil(files.first()["bytes"] / BUCKET_BYTES)
    by_rows = math.ceil(spark.read.parquet(path).count() / BUCKET_ROWS)
    return min(MAX_BUCKETS, max(spark.sparkContext.defaultParallelism, by_size, by_rows))


def spread(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Rebalance rows after a scan: one large row group otherwise lands in one task.

    No shuffle happens if ``df`` comes from a table bucketed by ``keys`` into as
    many buckets.
    """
    n = partitions or shuffle_width(df.sparkSession)
    return df.repartition(n, *[F.col(k) for k in keys])
