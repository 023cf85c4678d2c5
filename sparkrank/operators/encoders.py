"""Encoders with a name, vectors that remember theirs, and search from query text.

The name and the dimension are kept as metadata of the ``embedding`` column, so
they are in the schema of every table it is written to. A search from text uses
the encoder it is given only if the vectors were made by the same one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.operators.embedding import BATCH_SIZE, HASH_DIM, embed, hashed_embedding
from sparkrank.operators.nearest import assert_dimension, search_vector

KEY = "encoder"


class EncoderMismatch(ValueError):
    """Raised when vectors and queries would come from different encoders."""


@dataclass(frozen=True)
class Encoder:
    """``run(df, id_col, text_col)`` returns (id_col, embedding) with vectors of length ``dim``.

    Two encoders are the same if name and dimension are; give a model with
    other weights another name.
    """

    name: str
    dim: int
    run: Callable[[DataFrame, str, str], DataFrame]

    def encode(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return stamp(assert_dimension(self.run(df, id_col, text_col), self.dim), self)


def hashed(dim: int = HASH_DIM, partitions: int | None = None) -> Encoder:
    """The built-in hashed bag of words."""
    return Encoder("hashed words", dim, lambda df, i, t: hashed_embedding(df, i, t, dim, partitions))


def model(
    name: str,
    dim: int,
    open_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = BATCH_SIZE,
) -> Encoder:
    """A user's batch encoder, opened once per task; see ``embedding.embed``. A null text counts as empty."""

    def run(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        texts = df.select(id_col, F.coalesce(text_col, F.lit("")).alias(text_col))
        return embed(texts, text_col, open_encoder, batch_size).select(id_col, "embedding")

    return Encoder(name, dim, run)


def stamp(vectors: DataFrame, encoder: Encoder) -> DataFrame:
    """The same rows, with the encoder noted on ``embedding``."""
    facts = {KEY: {"name": encoder.name, "dim": encoder.dim}}
    return vectors.withMetadata("embedding", {**vectors.schema["embedding"].metadata, **facts})


def stamped(vectors: DataFrame) -> tuple[str | None, int | None]:
    """(name, dimension) noted on the vectors, or two times None."""
    facts = vectors.schema["embedding"].metadata.get(KEY, {})
    return facts.get("name"), facts.get("dim")


def check_encoder(vectors: DataFrame, encoder: Encoder) -> None:
    if stamped(vectors) != (encoder.name, encoder.dim):
        name, dim = stamped(vectors)
        made = f"made by {name!r} of dimension {dim}" if name else "of an unknown encoder, see stamp"
        raise EncoderMismatch(f"vectors are {made}, the queries ask by {encoder.name!r} of dimension {encoder.dim}")


def search_text(vectors: DataFrame, queries: DataFrame, encoder: Encoder, top_k: int = 10, digits: int = 6) -> DataFrame:
    """(query_id, id, score, rank): ``queries(query_id, query)`` encoded and searched in one call.

    Fails before any job if ``vectors(id, embedding)`` are not of ``encoder``. A
    query whose vector is zero finds nothing.
    """
    check_encoder(vectors, encoder)
    return search_vector(vectors, encoder.encode(queries, "query_id", "query"), top_k, digits)
