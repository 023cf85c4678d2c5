"""The given tables seen as catalogs, queries, ground truth and templates.

Every view covers its whole table: a document is split at its first line break
into title and body, and each item of ``benchmark`` is one query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkrank.functions.sizing import BROADCAST_BYTES, broadcast_if_within, measured_bytes
from sparkrank.functions.keyed import keyed_bucket, keyed_int
from sparkrank.functions.ranking import number_rows
from sparkrank.functions.text import tokens, without_stop_words
from sparkrank.operators.domains import ATTRIBUTE, BRAND, LIST_VALUES, VARIATION, split_lists
from sparkrank.operators.index import Index
from sparkrank.sources.scratch import scratch_root, shuffle_width, write_table

#: Text of short queries that one pass looks for; every task holds them as an automaton some hundred times larger.
SHORT_BYTES = 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_products(documents: DataFrame) -> DataFrame:
    """Documents in the product shape, without rating; ids stay BIGINT."""
    title = F.substring_index("text", "\n", 1)
    return documents.select(
        F.col("doc_id").alias("id"),
        title.alias("title"),
        F.substr("text", F.length(title) + 2).alias("description"),
        F.col("lang").alias("category"),
        (F.col("n_chars") / 100.0).alias("price"),
        F.col("source").alias("brand"),
        F.create_map(
            F.lit("source"), F.col("source"), F.lit("lang"), F.col("lang")
        ).alias("attributes"),
        F.lit(None).cast("string").alias("product_type"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without a rating: no join, so a scan reads only what is asked for."""
    return as_products(table(spark, sf_dir, "documents")).withColumn("rating", F.lit(None).cast("double"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog of all documents; the rating is the quality label, where there is one."""
    ratings = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("rating")
    )
    return as_products(table(spark, sf_dir, "documents")).join(ratings, "id", "left")


def embedded_products(spark: SparkSession, sf_dir: str, rated: bool = True) -> DataFrame:
    """Catalog with the precomputed vectors; NULL where a document has none."""
    docs = products(spark, sf_dir) if rated else catalog(spark, sf_dir)
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return docs.join(vectors, "id", "left")


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per benchmark item; a single-line item without comma has no type."""
    kind = F.when(F.contains("text", F.lit("\n")), "multi_concept").when(
        F.contains("text", F.lit(",")), "natural"
    )
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"), kind.alias("query_type")
    )


def _containing(body: DataFrame, asked: DataFrame) -> DataFrame:
    """(query_id, id) of the texts that contain a query of ``asked``, in one pass over them.

    ``asked`` is one block: it goes to every task. A text is read once, however
    many queries there are. The empty query is in every text.
    """
    ids: dict[str, list] = {}
    for row in asked.collect():
        ids.setdefault(row["query"], []).append(row["query_id"])
    everywhere = ids.pop("", [])
    types = [to_arrow_type(asked.schema["query_id"].dataType), to_arrow_type(body.schema["id"].dataType)]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = ahocorasick.Automaton()
        for text in ids:
            words.add_word(text, text)
        words.make_automaton()
        for batch in batches:
            found, where = [], []
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                held = {word for _, word in words.iter(text)} if ids else ()
                hits = everywhere + [q for word in held for q in ids[word]]
                found += hits
                where += [doc] * len(hits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, types[0]), pa.array(where, types[1])], names=["query_id", "id"]
            )

    schema = f"query_id {asked.schema['query_id'].dataType.simpleString()}, id {body.schema['id'].dataType.simpleString()}"
    return body.select("id", "body").mapInArrow(search, schema)


def _short_hits(body: DataFrame, short: DataFrame) -> DataFrame | None:
    """(query_id, id) for queries looked up in all texts: one pass for each ``SHORT_BYTES`` of them.

    Each block is written before the next is read, so no plan grows with their
    number. None without such queries.
    """
    spark, folder = short.sparkSession, scratch_root(short.sparkSession)
    kept = write_table(short, f"{folder}/short")
    blocks = math.ceil(measured_bytes(kept) / SHORT_BYTES)
    found = None
    for block in range(blocks):
        part = _containing(body, kept.where(F.pmod(F.xxhash64("query_id", "query"), F.lit(blocks)) == block))
        part.write.mode("overwrite").parquet(f"{folder}/hits/block={block}")
        found = part.schema
    if found is None:
        return None
    return spark.read.schema(found).parquet(f"{folder}/hits").select("query_id", "id")


def passage_qrels(docs: DataFrame, queries: DataFrame, index: Index) -> DataFrame:
    """(query_id, id) where the text of the document contains the text of the query.

    ``index`` holds the unstemmed tokens of ``docs``. A document that contains a
    text has all its inner tokens, so the rarest of them is looked up in the
    postings and only the documents found there are compared in full. The outer
    tokens are left out: they may be parts of longer words of the document. A
    query without an inner token that is no stop word is looked for in all
    texts, many in a pass, see ``_short_hits``.
    """
    inner = tokens(F.col("query"))
    inner = without_stop_words(F.slice(inner, 2, F.greatest(F.size(inner) - 2, F.lit(0))))
    body = docs.select("id", F.concat_ws("\n", "title", "description").alias("body"))
    short = queries.where(F.col("query").isNotNull() & (F.size(inner) == 0)).select("query_id", "query")
    queries = queries.where(F.size(inner) > 0)
    checked = inner
    # a query of n bytes has at most n / 2 words of some 32 bytes with their id
    small = measured_bytes(queries) * 16 <= BROADCAST_BYTES
    hint = F.broadcast if small else lambda df: df
    words = queries.select("query_id", F.explode(F.array_distinct(checked)).alias("tok"))
    known = index.term_stats.join(hint(words), "tok").groupBy("query_id", "tok").agg(
        F.sum("df").alias("df")
    )
    rarest = (
        words.join(known, ["query_id", "tok"], "left")
        .groupBy("query_id")
        .agg(F.min_by("tok", F.struct(F.coalesce("df", F.lit(0)), "tok")).alias("tok"))
    )
    candidates = (
        index.postings.select("id", "tok").join(hint(rarest), "tok")
        .select("query_id", "id").distinct().persist()
    )
    found = (
        body.join(broadcast_if_within(candidates), "id")
        .join(hint(queries.select("query_id", "query")), "query_id")
        .where(F.contains("body", F.col("query")))
        .select("query_id", "id")
    )
    more = _short_hits(body, short)
    return found if more is None else found.unionByName(more)


def product_templates(
    spark: SparkSession, sf_dir: str, limit: int = LIST_VALUES
) -> tuple[DataFrame, DataFrame]:
    """Template table of the generator, the attribute domains of ``part`` per type, and its long lists.

    Lists of more than ``limit`` values are empty in the template and come as
    rows (see ``operators.domains``). A part without a type or a noun belongs to
    no template.
    """
    words = F.split("p_name", " ")
    part = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("category"),
        F.get(words, F.lit(1)).alias("product_type"),
        F.get(words, F.lit(0)).alias("finish"),
        "p_name", "p_brand", "p_size", "p_retailprice",
    ).dropna(subset=["category", "product_type"])
    named = {
        VARIATION: F.col("p_name"), BRAND: F.col("p_brand"),
        f"{ATTRIBUTE}size": F.concat(F.lit("size "), F.col("p_size")), f"{ATTRIBUTE}finish": F.col("finish"),
    }
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), value.alias("value")) for name, value in named.items()])
    lists, long_values = split_lists(part.select("category", "product_type", F.inline(pairs)), limit)
    prices = part.groupBy("category", "product_type").agg(
        F.min("p_retailprice").alias("price_lo"), F.max("p_retailprice").alias("price_hi")
    )

    def values(name: str) -> Column:
        return F.coalesce(F.try_element_at("lists", F.lit(name)), F.array().cast("array<string>"))

    templates = prices.join(lists, ["category", "product_type"], "left").select(
        "category", "product_type", values(VARIATION).alias("variations"), values(BRAND).alias("brands"),
        F.create_map(
            F.lit("size"), values(f"{ATTRIBUTE}size"), F.lit("finish"), values(f"{ATTRIBUTE}finish")
        ).alias("attributes"),
        F.lit("size").alias("key_attr"),
        "price_lo", "price_hi",
        F.array(
            F.lit("A {variation} in {finish} finish, {size}."),
            F.lit("This {variation} comes as {size}. Choose {finish}."),
        ).alias("description_templates"),
    )
    return templates, long_values


def query_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates (stage, template_no, query, category, target_products, query_type).

    Stage 0 asks for a part name within a type, stage 1 for a brand's nouns. The
    region rows name a category without products, and each brand row also
    targets the product type ``gift`` that no product has.
    """
    part = table(spark, sf_dir, "part")
    noun = F.get(F.split("p_name", " "), F.lit(1))
    names = part.select(
        F.lit(0).alias("stage"),
        F.lower(F.concat_ws(" ", "p_type", "p_name")).alias("query"),
        F.col("p_type").alias("category"),
        F.array(noun).alias("target_products"),
        F.lit("keyword").alias("query_type"),
    ).distinct()
    brands = (
        part.select("p_type", "p_brand", noun.alias("noun"))
        .groupBy("p_type", "p_brand")
        .agg(F.sort_array(F.collect_set("noun")).alias("nouns"))
        .select(
            F.lit(1).alias("stage"),
            F.concat(F.lit("anything "), F.lower("p_type"), F.lit(" by "), F.lower("p_brand")).alias("query"),
            F.col("p_type").alias("category"),
            F.concat("nouns", F.array(F.lit("gift"))).alias("target_products"),
            F.lit("natural").alias("query_type"),
        )
    )
    regions = table(spark, sf_dir, "region").select(
        F.lit(1).alias("stage"),
        F.concat(F.lit("goods of "), F.lower("r_name")).alias("query"),
        F.col("r_name").alias("category"),
        F.array(F.lit("ring")).alias("target_products"),
        F.lit("synonym").alias("query_type"),
    )
    hashed = names.unionByName(brands).unionByName(regions).withColumn(
        "_h", keyed_int(42, "template", F.col("query"), F.col("category"))
    )
    bucket = keyed_bucket(F.col("_h"), max(64, 4 * shuffle_width(spark)))
    return number_rows(hashed, ["stage"], ["_h", "query"], bucket, "template_no").drop("_h")
