"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrank.llm import divergence, hidden, hnsw, lines, packing, pieces, pii, quality, simhash, topk, toxicity, urls, variants
from sparkrank.llm.shared import table
from sparkrank.llm.vectors import divisible


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.search(table(spark, sf_dir, "embeddings"), divisible(20), k=20)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), divisible(50), k=5, scale=256)


def op5_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_nbest(table(spark, sf_dir, "documents"), packed=True)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lines.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return docs.select("doc_id", "n_lines", "n_dropped", digest)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    found = pii.find_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind.isin(*pii.BASE_KINDS))
    counts = [
        F.expr(f"size(filter(spans, s -> s.kind = '{kind}'))").cast("bigint").alias(f"n_{kind}")
        for kind in pii.BASE_KINDS
    ]
    scores = F.array_join(F.transform("spans", lambda s: s.score.cast("string")), ",")
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        scores.alias("scores"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden.score_documents(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_hnsw": op3_hnsw,
    "op4_topk": op4_topk,
    "op5_nbest_pieces": op5_nbest_pieces,
    "op6_simhash": op6_simhash,
    "op7_url_filter": op7_url_filter,
    "op8_line_dedup": op8_line_dedup,
    "op9_pii": op9_pii,
    "op10_packing": op10_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_hidden_markov": op12_hidden_markov,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op4_topk": """
WITH v AS (
    SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id,
           CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
""",
    "op8_line_dedup": r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs)
),
held AS (
    SELECT key, max(doc_id) AS largest FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
    SELECT l.doc_id, l.pos, l.line, h.key IS NOT NULL AND l.doc_id <> h.largest AS dropped
    FROM lines l LEFT JOIN held h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_source_divergence": r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
words AS (
    SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
terms AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
counts AS (
    SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n
    FROM words JOIN terms USING (lang, term) GROUP BY lang, source, term
),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS own,
           (SELECT count(*) FROM terms t WHERE t.lang = g.lang) AS v
    FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY g.lang, g.source
),
shares AS (
    SELECT s.lang, s.source, t.term, coalesce(c.n, 0) AS n,
           CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.own + 5 * s.v) AS BIGINT) AS p
    FROM sizes s JOIN terms t USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
whole AS (
    SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (sum(n) + 5))
        // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS BIGINT) AS q
    FROM shares GROUP BY lang, term
),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
                     WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    UNION ALL
    SELECT s.lang, s.source, 'term', s.term, s.p - w.q FROM shares s JOIN whole w USING (lang, term)
    WHERE s.n > 0 AND s.p > w.q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 50
""",
}
