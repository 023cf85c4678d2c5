"""Readers and writers of catalogs, query sets and their ground truth."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.sources.schema import EMBEDDED_PRODUCT, PRODUCT, QUERY


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, multi_line: bool) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "json_array":
        return load_json_array(spark, path, schema)
    if fmt == "json":
        # Over many lines one file is one task; "json_array" splits an indented array.
        return reader.option("multiLine", multi_line).json(path)
    return reader.format(fmt).load(path)


def _border(indent: int) -> str:
    """What stands between two objects of an array printed with ``indent`` blanks per level."""
    margin = "\n" + " " * indent
    return margin + "}," + margin + "{"


def load_json_array(spark: SparkSession, path: str, schema: T.StructType, indent: int = 2) -> DataFrame:
    """Objects of files that hold one JSON array each, many tasks to a file.

    The array is printed over lines with ``indent`` blanks per level. The text
    scan takes the lines between two objects as its record separator: valid
    JSON has no raw line break inside a string, and deeper objects have wider
    margins, so a separator is always a border of two objects. Each piece is
    put in brackets again and parsed as an array of whatever it holds, so
    a file of another layout is read as well, in fewer and larger pieces down
    to one. A separator inside an object would leave a piece with open brackets,
    which fails the read instead of losing rows. Missing keys are NULL.
    """
    separator = _border(indent)
    pieces = spark.read.option("lineSep", separator).text(path)
    margin, tail = rf"\n {{{indent}}}", r"\]\s*$"
    first = F.regexp_like("value", F.lit(r"^\s*\["))
    indented = F.regexp_like("value", F.lit(rf"^\s*\[{margin}\{{"))
    last = F.regexp_like("value", F.lit(rf"{margin}\}}\s*{tail}"))
    # an indented first object may end in an inner array, any other first piece is the whole file
    ends = last | (first & ~indented & F.regexp_like("value", F.lit(tail)))
    opened = F.when(first, F.col("value")).otherwise(F.concat(F.lit("[{"), F.col("value")))
    closed = F.when(ends, opened).otherwise(F.concat(opened, F.lit("}]")))
    records = F.from_json(closed, T.ArrayType(schema), {"mode": "FAILFAST"})
    return pieces.where(F.trim("value") != "").select(F.inline(records))


def _brackets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The objects of a task as the lines of one array."""
    before = None
    for batch in batches:
        texts = batch.column(0).to_pylist()
        if not texts:
            continue
        lines = ["["] if before is None else [before + ","]
        before = texts.pop()
        yield pa.RecordBatch.from_pydict({"value": lines + [t + "," for t in texts]})
    if before is not None:
        yield pa.RecordBatch.from_pydict({"value": [before, "]"]})


def save_json_array(df: DataFrame, path: str, indent: int = 2) -> None:
    """Files that each hold one JSON array, printed over lines as ``load_json_array`` splits them."""
    printed: Column = F.to_json(F.struct("*"), {"pretty": "true"})
    margin = " " * indent
    text = F.concat(F.lit(margin), F.replace(printed, F.lit("\n"), F.lit("\n" + margin)))
    df.select(text.alias("value")).mapInArrow(_brackets, "value string").write.mode("overwrite").text(path)


def load_products(
    spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False,
    schema: T.StructType = PRODUCT,
) -> DataFrame:
    return _read(spark, path, schema, fmt, multi_line)


def load_queries(
    spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False,
    schema: T.StructType = QUERY,
) -> DataFrame:
    return _read(spark, path, schema, fmt, multi_line)


def load_embedded_products(
    spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False,
    schema: T.StructType = EMBEDDED_PRODUCT,
) -> DataFrame:
    """Only the rows that carry an embedding; see ``embedding_coverage`` for the rest."""
    return embedded_only(_read(spark, path, schema, fmt, multi_line))


def save(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "json_array":
        return save_json_array(df, path)
    df.write.mode("overwrite").format(fmt).save(path)


def embedded_only(products: DataFrame) -> DataFrame:
    return products.where(F.col("embedding").isNotNull())


def embedding_coverage(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("embedding").alias("embedded"),
        F.count_if(F.col("embedding").isNull()).alias("missing"),
    )


def split_queries(query_set: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Query set with id arrays -> queries(query_id, query, query_type), qrels(query_id, id)."""
    queries = query_set.select(F.col("id").alias("query_id"), "query", "query_type")
    qrels = query_set.select(
        F.col("id").alias("query_id"), F.explode("relevant_product_ids").alias("id")
    )
    return queries, qrels


def query_type_counts(queries: DataFrame) -> DataFrame:
    kind = F.coalesce("query_type", F.lit("unknown")).alias("query_type")
    return queries.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
