"""Schemas. Nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_D = T.DoubleType()

PRODUCT = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("title", _S),
        T.StructField("description", _S),
        T.StructField("category", _S),
        T.StructField("price", _D),
        T.StructField("brand", _S),
        T.StructField("rating", _D),
        T.StructField("attributes", T.MapType(_S, _S)),
        T.StructField("product_type", _S),
    ]
)

EMBEDDED_PRODUCT = T.StructType(
    [*PRODUCT.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))]
)

QUERY = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField("query", _S),
        T.StructField("query_type", _S),
        T.StructField("relevant_product_ids", T.ArrayType(_S)),
    ]
)

# Columns of a hit that come from the document.
HIT_FIELDS = ["title", "description", "category", "brand", "price", "rating"]
