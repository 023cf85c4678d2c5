"""Embeddings: plug-in batch encoders and the built-in hashed bag of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.functions.text import tokens
from sparkrank.sources.scratch import spread

HASH_DIM = 64
BATCH_SIZE = 32


def combined_text(title: str = "title", description: str = "description") -> Column:
    """Title and description in one text; a missing one counts as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.coalesce(description, F.lit("")))


def embed(
    df: DataFrame,
    text_col: str,
    open_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``df`` plus an ``embedding`` column from a user's encoder.

    ``open_encoder`` runs once per task and returns a function from a list of
    texts to a matrix; the vectors are attached in the same pass, without a join.
    """
    schema = T.StructType(
        [*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = open_encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                part = batch.slice(at, batch_size)
                rows = np.asarray(encoder(part.column(text_col).to_pylist()), dtype=np.float32)
                vectors = pa.array(list(rows), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, vectors], names=[*part.schema.names, "embedding"]
                )

    return df.mapInArrow(encode, schema)


def hashed_embedding(
    df: DataFrame, id_col: str, text_col: str, dim: int = HASH_DIM, partitions: int | None = None
) -> DataFrame:
    """(id_col, embedding): signed token counts folded into ``dim`` slots, unit length.

    The md5 of a token gives its slot (hex digits 1-8) and its sign (digit 9). A
    text without tokens gets the zero vector. It carries word overlap only, no
    meaning. The rows are spread by id once, or not at all if they come from a
    table bucketed by id; every grouping then stays in its partition.
    """
    rows = spread(df.select(id_col, text_col), id_col, partitions=partitions).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    digests = rows.select("id", F.explode_outer(tokens(F.col("text"))).alias("tok")).select(
        "id", F.md5("tok").alias("digest")
    )
    slot = F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint"), F.lit(dim))
    sign = F.when(F.substring("digest", 9, 1) < "8", 1).when(F.col("digest").isNotNull(), -1)
    slots = (
        digests.select("id", slot.alias("slot"), sign.alias("part"))
        .groupBy("id", "slot")
        .agg(F.sum("part").alias("value"))
    )
    filled = slots.groupBy("id").agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "value")))
        ).alias("values"),
        F.sqrt(F.sum(F.col("value") * F.col("value")).cast("double")).alias("length"),
    )
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.coalesce(
            F.try_divide(F.try_element_at("values", i.cast("bigint")).cast("double"), F.col("length")),
            F.lit(0.0),
        ),
    )
    return filled.select(F.col("id").alias(id_col), dense.alias("embedding"))


def attach_embeddings(products: DataFrame, vectors: DataFrame) -> DataFrame:
    """Precomputed vectors joined by id; products without a vector keep NULL."""
    return products.join(vectors, "id", "left")


def embedding_stats(vectors: DataFrame) -> DataFrame:
    size = F.size("embedding").cast("bigint")
    return vectors.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(size).alias("min_dim"),
        F.max(size).alias("max_dim"),
        F.sum(size).alias("total_values"),
    )


def embedding_preview(vectors: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` values of the vector of the lowest id."""
    first = vectors.agg(F.min_by("embedding", "id").alias("embedding"), F.min("id").alias("id"))
    return first.select("id", F.posexplode(F.slice("embedding", 1, n)).alias("pos", "value"))
