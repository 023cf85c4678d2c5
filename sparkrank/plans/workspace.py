"""Written tables that searches and reports share: catalog, index, vectors, hits, metrics."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.operators import approximate, cells, embedding, encoders, fusion, generation, keyword, metrics, nearest
from sparkrank.operators import index as indexing
from sparkrank.operators.reports import tag
from sparkrank.plans.flow import run_flow
from sparkrank.sources import standin
from sparkrank.sources.scratch import bucket_count, scratch_root, write_bucketed, write_table

WINDOW = 100


class Workspace:
    """Each table is built once, on first use, and read back from the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, stem: bool = False):
        self.spark, self.sf_dir, self.stem = spark, sf_dir, stem
        self.root = scratch_root(spark)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{self.root}/{name}")

    @cached_property
    def buckets(self) -> int:
        return bucket_count(self.spark, f"{self.sf_dir.rstrip('/')}/documents.parquet")

    def _keep_bucketed(self, df: DataFrame, name: str) -> DataFrame:
        return write_bucketed(df, f"{self.root}/{name}", ["id"], self.buckets)

    @cached_property
    def docs(self) -> DataFrame:
        """Bucketed by id like all that is derived from it, so index builds need no shuffle."""
        return self._keep_bucketed(standin.products(self.spark, self.sf_dir), "docs")

    @cached_property
    def queries(self) -> DataFrame:
        return self._keep(standin.queries(self.spark, self.sf_dir), "queries")

    @cached_property
    def qrels(self) -> DataFrame:
        return self._keep(
            standin.passage_qrels(self.docs, self.queries, self.index), "qrels"
        )

    @cached_property
    def index(self) -> indexing.Index:
        return indexing.build_index(
            self.docs, f"{self.root}/index", stem=self.stem, buckets=self.buckets
        )

    @cached_property
    def vectors(self) -> DataFrame:
        """Hashed embeddings; a document without a token cannot be found by vector."""
        text = self.docs.select("id", embedding.combined_text().alias("text"))
        dense = encoders.hashed(partitions=self.buckets).encode(text, "id", "text")
        findable = dense.where(F.exists("embedding", lambda x: x != 0))
        return self._keep_bucketed(findable, "vectors")

    @cached_property
    def query_vectors(self) -> DataFrame:
        dense = embedding.hashed_embedding(self.queries, "query_id", "query")
        return self._keep(dense, "query_vectors")

    @cached_property
    def centre(self) -> list[float]:
        return approximate.centre(self.vectors, embedding.HASH_DIM)

    @cached_property
    def bands(self) -> DataFrame:
        codes = approximate.band_codes(self.vectors, embedding.HASH_DIM, origin=self.centre)
        return self._keep_bucketed(codes, "bands")

    @cached_property
    def query_bands(self) -> DataFrame:
        codes = approximate.band_codes(
            self.query_vectors, embedding.HASH_DIM, key="query_id", origin=self.centre
        )
        return self._keep(codes, "query_bands")

    @cached_property
    def cells(self) -> cells.CellIndex:
        return cells.build_cells(self.vectors, f"{self.root}/cells")

    @cached_property
    def bm25(self) -> DataFrame:
        return self._keep(keyword.search_keyword(self.index, self.queries, WINDOW), "bm25")

    @cached_property
    def nearest(self) -> DataFrame:
        return self._keep(nearest.search_vector(self.vectors, self.query_vectors, WINDOW), "nearest")

    @cached_property
    def hybrid(self) -> DataFrame:
        return self._keep(fusion.search_hybrid(self.index, self.queries, self.nearest), "hybrid")

    @cached_property
    def rrf(self) -> DataFrame:
        return self._keep(fusion.fuse_rrf(self.bm25, self.nearest), "rrf")

    @cached_property
    def hits(self) -> DataFrame:
        """Ten hits per query of each of the four methods."""
        lists = {
            "bm25": self.bm25, "vector": self.nearest,
            "hybrid": self.hybrid, "hybrid_rrf": self.rrf,
        }
        tagged = [tag(h.where(F.col("rank") <= 10), m) for m, h in lists.items()]
        union = tagged[0]
        for t in tagged[1:]:
            union = union.unionByName(t)
        return self._keep(union, "hits")

    @cached_property
    def _template_tables(self) -> tuple[DataFrame, DataFrame | None]:
        templates, long_values = standin.product_templates(self.spark, self.sf_dir)
        long_values = self._keep(long_values, "template_values")
        return self._keep(templates, "templates"), None if long_values.isEmpty() else long_values

    @property
    def templates(self) -> DataFrame:
        return self._template_tables[0]

    @property
    def template_values(self) -> DataFrame | None:
        """Values of the lists that are too long for a row of ``templates``, if there are any."""
        return self._template_tables[1]

    @cached_property
    def query_templates(self) -> DataFrame:
        return self._keep(standin.query_templates(self.spark, self.sf_dir), "query_templates")

    @cached_property
    def made_products(self) -> DataFrame:
        """As many generated products as ``part`` has rows."""
        n = standin.table(self.spark, self.sf_dir, "part").count()
        return self._keep(generation.generate_products(self.templates, n, long_values=self.template_values), "made_products")

    @cached_property
    def product_index(self) -> DataFrame:
        return self._keep(generation.product_index(self.made_products), "product_index")

    @cached_property
    def filled_queries(self) -> int:
        """A third more queries than templates."""
        n = self.query_templates.count()
        return n + n // 3 + 1

    @cached_property
    def flow(self) -> dict[str, DataFrame]:
        """All stages on the generated catalog, with as many products as ``part`` has rows."""
        n = standin.table(self.spark, self.sf_dir, "part").count()
        return run_flow(
            self.spark, f"{self.root}/flow", self.templates, self.query_templates, n,
            self.filled_queries, stem=False, long_values=self.template_values,
        )

    @cached_property
    def metrics(self) -> DataFrame:
        return self._keep(metrics.evaluate(self.hits, self.qrels, self.queries), "metrics")


INPUTS = ("documents", "benchmark", "labels", "part", "region")
_OPEN: dict[tuple[str, str, bool], tuple[tuple[str, ...], Workspace]] = {}


def _files(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """Names of the input files: a listing, which opens none of them."""
    paths = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in INPUTS]
    return tuple(sorted(spark.read.format("binaryFile").load(paths).inputFiles()))


def workspace(spark: SparkSession, sf_dir: str, stem: bool = False) -> Workspace:
    """The workspace of this application and data folder, a new one if its files have changed.

    Files are told apart by name: writers give new ones with every write.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), stem)
    files = _files(spark, sf_dir)
    if key not in _OPEN or _OPEN[key][0] != files:
        _OPEN[key] = (files, Workspace(spark, sf_dir, stem))
    return _OPEN[key][1]
