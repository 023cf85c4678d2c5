"""Index tables of a catalog: postings by document, statistics, filters and facets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.functions.sizing import broadcast_if_within
from sparkrank.functions.text import analyze
from sparkrank.operators.encoders import stamped
from sparkrank.sources.scratch import (
    open_bucketed, spread, write_bucketed, write_facts, write_table,
)

FIELD_WEIGHTS = {"title": 2.0, "description": 1.0}
#: Folders of the postings, by the hash of the token; a search reads those of its tokens.
SHARDS = 16


@dataclass(frozen=True)
class Index:
    """postings(id, field, tok, tf, dl, shard), term_stats(field, tok, df), field_stats(field, n, avgdl)."""

    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    stem: bool = True
    stop: tuple[str, ...] | None = None
    weights: dict[str, float] = field(default_factory=lambda: dict(FIELD_WEIGHTS))
    shards: int = SHARDS
    path: str | None = None
    #: Postings of earlier builds, newest first, each with the ids (id) that were replaced or removed since.
    older: tuple[tuple[DataFrame, DataFrame], ...] = ()

    def postings_of(self, tokens: DataFrame) -> list[DataFrame]:
        """Postings that count, per build, in the folders of ``tokens(tok)``.

        The folders' numbers, at most ``shards``, become a partition filter.
        """
        found = tokens.select(shard_of(F.col("tok"), self.shards).alias("shard")).distinct().collect()
        asked = F.col("shard").isin(sorted(r["shard"] for r in found))
        return [self.postings.where(asked)] + [
            postings.where(asked).join(broadcast_if_within(gone), "id", "left_anti") for postings, gone in self.older
        ]


def shard_of(tok: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(tok), F.lit(shards)).cast("int")


def token_rows(docs: DataFrame, text_col: str, stop: list[str] | None = None, stem: bool = False) -> DataFrame:
    """(id, pos, tok) of one text column; ``stop=[]`` keeps every token."""
    toks = analyze(F.col(text_col), stem, stop)
    return docs.select("id", F.posexplode(toks).alias("pos", "tok"))


def build_postings(
    docs: DataFrame,
    fields: list[str],
    stem: bool = True,
    stop: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Term frequencies per document and field, with the field length on each row.

    The documents are spread by id once; all further grouping is by a key that
    contains id and stays in the partition.
    """
    rows = spread(docs.select("id", *fields), "id", partitions=partitions)
    toked = rows.select(
        "id", *[analyze(F.col(f), stem, stop).alias(f) for f in fields]
    )
    per_field = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("toks")) for f in fields])
    return (
        toked.select("id", F.inline(per_field))
        .select("id", "field", F.size("toks").cast("bigint").alias("dl"), F.explode("toks").alias("tok"))
        .groupBy("id", "field", "dl", "tok")
        .agg(F.count(F.lit(1)).alias("tf"))
        .select("id", "field", "tok", "tf", "dl")
    )


def build_term_stats(postings: DataFrame) -> DataFrame:
    return postings.groupBy("field", "tok").agg(F.count(F.lit(1)).alias("df"))


def build_field_stats(postings: DataFrame) -> DataFrame:
    """Over documents with at least one token in the field."""
    lengths = postings.groupBy("id", "field").agg(F.max("dl").alias("dl"))
    return lengths.groupBy("field").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("dl").cast("double")).alias("avgdl")
    )


def build_index(
    docs: DataFrame,
    path: str,
    weights: dict[str, float] | None = None,
    stem: bool = True,
    stop: list[str] | None = None,
    buckets: int | None = None,
    shards: int = SHARDS,
) -> Index:
    """Write the three index tables below ``path``; postings are bucketed by id within folders by token hash."""
    weights = dict(weights or FIELD_WEIGHTS)
    rows = build_postings(docs, list(weights), stem, stop, buckets).withColumn("shard", shard_of(F.col("tok"), shards))
    postings = write_bucketed(rows, f"{path}/postings", ["field", "tok"], buckets, "shard")
    write_facts(
        docs.sparkSession, f"{path}/settings",
        stem=F.lit(stem),
        stop=F.lit(stop).cast("array<string>") if stop else F.lit(None).cast("array<string>"),
        no_stop=F.lit(stop == []),
        weights=F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]),
        shards=F.lit(shards),
    )
    return Index(
        postings,
        write_table(build_term_stats(postings), f"{path}/term_stats"),
        write_table(build_field_stats(postings), f"{path}/field_stats"),
        stem,
        tuple(stop) if stop is not None else None,
        weights,
        shards,
        path,
    )


def open_index(spark: SparkSession, path: str) -> Index:
    """An index written earlier, also by another session."""
    kept = spark.read.parquet(f"{path}/settings").first()
    older = []
    if "older" in kept:
        older = [(open_bucketed(spark, f"{at}/postings"), spark.read.parquet(gone)) for at, gone in kept["older"]]
    return Index(
        open_bucketed(spark, f"{path}/postings"),
        spark.read.parquet(f"{path}/term_stats"),
        spark.read.parquet(f"{path}/field_stats"),
        kept["stem"],
        () if kept["no_stop"] else tuple(kept["stop"]) if kept["stop"] else None,
        kept["weights"],
        kept["shards"],
        path,
        tuple(older),
    )


def update_index(index: Index, old: DataFrame, new: DataFrame, path: str, buckets: int | None = None) -> Index:
    """The index after a batch of upserts and removals, below ``path``, without reading the documents that stay.

    ``new`` are added or replacing documents, ``old`` the indexed versions of
    those they replace and of those to remove (id and the fields). The batch
    becomes postings of its own; earlier postings stay as they are, with the ids
    that no longer count. Document frequencies, numbers and lengths of fields
    are the stored ones plus signed counts of the batch, so scores are those of
    a rebuild. Every search reads one build more per batch: rebuild now and then.
    """
    spark, fields = new.sparkSession, list(index.weights)
    stop = list(index.stop) if index.stop is not None else None
    ids = old.select("id").unionByName(new.select("id")).distinct()
    gone = write_table(ids, f"{path}/gone")
    made = build_postings(new, fields, index.stem, stop, buckets).withColumn("shard", shard_of(F.col("tok"), index.shards))
    postings = write_bucketed(made, f"{path}/postings", ["field", "tok"], buckets, "shard")
    lost = write_table(build_postings(old, fields, index.stem, stop, buckets), f"{path}/lost")
    terms = index.term_stats.select("field", "tok", "df")
    lengths = index.field_stats.select("field", "n", F.round(F.col("n") * F.col("avgdl")).cast("bigint").alias("total"))
    for rows, sign in ((postings, 1), (lost, -1)):
        terms = terms.unionByName(
            build_term_stats(rows).select("field", "tok", (F.col("df") * sign).alias("df"))
        )
        per_field = rows.groupBy("id", "field").agg(F.max("dl").alias("dl")).groupBy("field")
        lengths = lengths.unionByName(
            per_field.agg((F.count(F.lit(1)) * sign).alias("n"), (F.sum("dl") * sign).alias("total"))
        )
    terms = terms.groupBy("field", "tok").agg(F.sum("df").alias("df")).where(F.col("df") > 0)
    lengths = lengths.groupBy("field").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where(F.col("n") > 0)
    lengths = lengths.select("field", "n", (F.col("total").cast("double") / F.col("n")).alias("avgdl"))
    folders, older = [], []
    for number, (earlier, dead) in enumerate([(index.postings, None), *index.older]):
        folder = f"{path}/gone_{number}"
        both = gone if dead is None else gone.unionByName(dead).distinct()
        older.append((earlier, write_table(both, folder)))
        folders.append(folder)
    paths = [index.path] if index.path else []
    if index.older:
        kept = spark.read.parquet(f"{index.path}/settings").first()
        paths += [at for at, _ in kept["older"]]
    facts = spark.read.parquet(f"{index.path}/settings").drop("older")
    pairs = [F.struct(F.lit(a).alias("path"), F.lit(b).alias("gone")) for a, b in zip(paths, folders, strict=True)]
    facts.withColumn("older", F.array(*pairs)).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
    return Index(
        postings, write_table(terms, f"{path}/term_stats"), write_table(lengths, f"{path}/field_stats"),
        index.stem, index.stop, index.weights, index.shards, path, tuple(older),
    )


def idf(n: Column, df: Column) -> Column:
    return F.ln(1 + (n - df + 0.5) / (df + 0.5))


def term_idf(index: Index, digits: int = 6) -> DataFrame:
    return index.term_stats.join(F.broadcast(index.field_stats), "field").select(
        "field", "tok", "df", F.round(idf(F.col("n"), F.col("df")), digits).alias("idf")
    )


def index_stats(index: Index, vectors: DataFrame) -> DataFrame:
    """One row per field: documents, distinct terms, mean length; and the vectors beside."""
    terms = index.term_stats.groupBy("field").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("df").alias("postings")
    )
    dims = vectors.agg(
        F.count(F.lit(1)).alias("vectors"),
        F.max(F.size("embedding")).cast("bigint").alias("dim"),
    ).first()
    return (
        index.field_stats.join(terms, "field")
        .select("field", F.col("n").alias("docs"), "terms", "postings", F.round("avgdl", 6).alias("avgdl"))
        .withColumn("vectors", F.lit(dims["vectors"]).cast("bigint"))
        .withColumn("dim", F.lit(dims["dim"]).cast("bigint"))
    )


def _kind(of: T.DataType) -> str:
    if isinstance(of, T.MapType):
        return "object"
    return "keyword" if isinstance(of, T.StringType) else of.simpleString()


def index_mapping(index: Index, docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row per field of the written tables: what it is, how it is searched, in how many rows it is filled.

    Text fields have analyser and weight as the index was built, ``embedding``
    the dimension and the encoder noted in the schema of ``vectors``; all other
    columns of ``docs`` are stored for filters, sorting and facets.
    """
    steps = ["words"] + ["stop words"] * (index.stop is None or len(index.stop) > 0) + ["stems"] * index.stem

    def row(name: str, kind: str, analyser=None, weight=None, dim=None, encoder=None) -> Column:
        facts = {
            "field": (name, "string"), "kind": (kind, "string"), "analyser": (analyser, "string"),
            "weight": (weight, "double"), "dim": (dim, "bigint"), "encoder": (encoder, "string"),
        }
        filled = F.count(F.col(f"`{name}`")).alias("filled")
        return F.struct(*[F.lit(v).cast(t).alias(k) for k, (v, t) in facts.items()], filled)

    stored = [
        row(f.name, "text", ", ".join(steps), index.weights[f.name])
        if f.name in index.weights else row(f.name, _kind(f.dataType))
        for f in docs.schema.fields if f.name != "embedding"
    ]
    encoder, dim = stamped(vectors)
    rows = [(docs, stored), (vectors, [row("embedding", "vector", dim=dim, encoder=encoder)])]
    fields, embedding = [df.agg(F.array(*of).alias("rows")).select(F.inline("rows")) for df, of in rows]
    return fields.unionByName(embedding)


def filter_keyword(docs: DataFrame, **equals: str) -> DataFrame:
    """Exact match on keyword columns."""
    for name, value in equals.items():
        docs = docs.where(F.col(name) == value)
    return docs


def filter_range(docs: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Inclusive bounds on a numeric column; None leaves a side open."""
    if low is not None:
        docs = docs.where(F.col(column) >= low)
    if high is not None:
        docs = docs.where(F.col(column) <= high)
    return docs


def facet_counts(docs: DataFrame, *columns: str) -> DataFrame:
    """(facet, value, n) for each of the keyword columns, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in columns])
    return (
        docs.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("facet", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def title_keyword(docs: DataFrame, ignore_above: int = 256) -> DataFrame:
    """Untokenised title for sorting; longer titles have none."""
    title = F.when(F.length("title") <= ignore_above, F.col("title"))
    return docs.withColumn("title_keyword", title)


def attribute_facets(docs: DataFrame) -> DataFrame:
    """(attribute, value, n) over all entries of the attribute maps."""
    return (
        docs.select(F.explode("attributes").alias("attribute", "value"))
        .groupBy("attribute", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def filter_attribute(docs: DataFrame, key: str, value: str) -> DataFrame:
    return docs.where(F.try_element_at("attributes", F.lit(key)) == value)
