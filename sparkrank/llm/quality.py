"""Quality of documents by a regularised quadratic discriminant over text statistics.

Every text becomes a short vector of statistics, transformed to be roughly
normal. Each class has a mean and a covariance, shrunk towards the pooled
covariance and towards a multiple of the identity. A score is the difference of
the two Mahalanobis log densities plus the log prior odds, as a probability; the
Cholesky factor of each covariance is computed once and kept in the model.

Defined cases: a null text counts as empty; an empty text has all statistics at
their value for no words and gets a score like any other; null labels are left
out; equal rows of (label, statistics) train once, so a large group of copies
does not bend a class; without examples of both classes every score is the
smoothed share of label 1 among the examples.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.llm.shared import kept, per_batch, remainder, texts

FEATURES = (
    "characters", "words", "word_length", "symbols", "bars", "capitals", "digits", "shouts",
    "distinct", "top_word", "top_pair", "short_words", "ends", "line_length", "repeated_lines",
)
#: Shares are mapped by log(share + FLOOR), which spreads the small ones.
FLOOR = 1e-3
TO_POOLED, TO_IDENTITY = 0.05, 0.001
PLAIN = np.zeros(256, bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b" \t\r\n.,;:'\"-()?!"]] = True


def _share(part: float, whole: float) -> float:
    return float(np.log(part / max(whole, 1) + FLOOR))


def statistics(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for the whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, capitals = len(data), int(counts[65:91].sum())
    letters = capitals + int(counts[97:123].sum()) + int(counts[128:].sum())
    words = data.lower().split()
    n = len(words)
    seen, pairs = Counter(words), Counter(zip(words, words[1:], strict=False))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(np.log1p(size / max(n, 1))),
        _share(size - int(counts[PLAIN].sum()), size),
        _share(int(counts[124]), size),
        _share(capitals, letters),
        _share(int(counts[48:58].sum()), size),
        _share(int(counts[33]), size),
        float(np.log(len(seen) + 1) / np.log(n + 2)),
        _share(max(seen.values(), default=0), n),
        _share(max(pairs.values(), default=0), n - 1),
        _share(sum(len(w) <= 3 for w in words), n),
        _share(sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines), len(lines)),
        float(np.log1p(size / max(len(lines), 1))),
        _share(len(lines) - len(set(lines)), len(lines)),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row of ``docs``."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = pa.array([statistics(t) for t in texts(batch.column(1))], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), x], names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), make, f"doc_id {kind}, x array<double>")


class Discriminant(NamedTuple):
    """Means and Cholesky factors of class 0 and 1, the log prior odds, or a constant ``share``."""

    means: np.ndarray | None
    factors: np.ndarray | None
    bias: float
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 per row of ``x``."""
        if self.means is None:
            return np.full(len(x), self.share)
        logs = []
        for mean, factor in zip(self.means, self.factors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(-0.5 * (z * z).sum(axis=0) - np.log(np.diag(factor)).sum())
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + self.bias, -500, 500)))


def fit(examples: DataFrame, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Discriminant:
    """The discriminant of ``examples(label, x)``, from sums over all of them.

    Only one row of sums per class comes to the driver.
    """
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    at = [F.col("x")[i] for i in range(d)]
    rows = (
        examples.where(F.col("label").isin(0, 1))
        .select("label", "x")
        .distinct()
        .groupBy("label")
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(a) for a in at]).alias("s"),
            F.array(*[F.sum(at[i] * at[j]) for i, j in pairs]).alias("p"),
        )
        .collect()
    )
    sums = {int(r["label"]): r for r in rows}
    n = [sums[c]["n"] if c in sums else 0 for c in (0, 1)]
    share = (n[1] + 1) / (sum(n) + 2)
    if min(n) < 2:
        return Discriminant(None, None, 0.0, share)
    means, scatter = np.zeros((2, d)), np.zeros((2, d, d))
    for c in (0, 1):
        means[c] = np.asarray(sums[c]["s"]) / n[c]
        for (i, j), v in zip(pairs, sums[c]["p"], strict=True):
            scatter[c, i, j] = scatter[c, j, i] = v
        scatter[c] -= n[c] * np.outer(means[c], means[c])
    pooled = scatter.sum(axis=0) / (sum(n) - 2)
    factors = []
    for c in (0, 1):
        own = (1 - to_pooled) * scatter[c] / (n[c] - 1) + to_pooled * pooled
        level = max(np.trace(own) / d, 1e-9)
        factors.append(np.linalg.cholesky((1 - to_identity) * own + to_identity * level * np.eye(d)))
    return Discriminant(means, np.array(factors), float(np.log(n[1] / n[0])), share)


def apply(rows: DataFrame, model: Discriminant) -> DataFrame:
    """``rows`` (with ``x``) plus ``score``."""

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(x.tolist(), float).reshape(-1, len(FEATURES))))

    return rows.withColumn("score", score("x"))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return remainder(doc_id, 3) == 1


def _examples(x: DataFrame, labels: DataFrame) -> DataFrame:
    learned = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    return x.join(learned, "doc_id")


def score_documents(docs: DataFrame, labels: DataFrame, **shrinkage: float) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Learns from ``labels(doc_id, quality)`` of documents that are not held out,
    all of them; scores depend on the text alone.
    """
    x = kept(document_statistics(docs))
    model = fit(_examples(x, labels), **shrinkage)
    return apply(x, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **shrinkage: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``threshold``.

    Texts are read twice, once to learn and once to decide, and never shuffled.
    """
    model = fit(_examples(document_statistics(docs), labels), **shrinkage)

    at = docs.columns.index("text")

    def good(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(t) for t in texts(batch.column(at))])
        return batch.filter(pa.array(model.scores(x) >= threshold))

    return per_batch(docs, good, docs.schema)
