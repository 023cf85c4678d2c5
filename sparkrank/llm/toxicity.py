"""Toxicity from confirmed toxic documents and unlabelled text.

Non-negative positive-unlabelled learning: with the share p of toxic documents
known, the risk on clean documents is the risk of calling unlabelled text toxic
minus p times that of calling toxic text toxic. That difference cannot be
negative; once it is on the sample, a step is taken back up its slope instead
(Kiryo et al., 2017). Classifiers are linear over the set of words of a text,
trained by numpy in tasks, one per bag of the sample; a score is the mean of
their probabilities.

Only label 1 of documents that are not held out names an example; label 0 only
enters the share p. Defined cases: a null text counts as empty and scores like a
text without a known word; null labels are left out; equal texts train once;
without a toxic example every score is p, which is then 0.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.shared import kept, per_batch, remainder, smallest, texts

WORD = re.compile(r"\w+")
#: Bounds of the training sample: distinct texts, those with the smallest hashes.
POSITIVES, UNLABELLED, BAGS = 6_000, 18_000, 3
#: Words that a classifier looks at, examples they must occur in, and standard
#: errors by which their shares must differ.
VOCABULARY, LEAST, ERRORS = 4_096, 3, 4.0
STEPS, RATE, DECAY = 400, 0.1, 1e-5
SEED = 1


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the different words of the whole text, lower-cased."""
    words = set(WORD.findall(text.lower()))
    return np.fromiter(
        (xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint32, len(words)
    )


class Member(NamedTuple):
    """Sorted word hashes, their weights and the constant term."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


def _choose(rows: np.ndarray, words: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Hashes whose share among toxic examples differs most from that in unlabelled text."""
    known, at = np.unique(words, return_inverse=True)
    toxic = np.bincount(at, positive[rows], len(known))
    other = np.bincount(at, ~positive[rows], len(known))
    n, m = max(positive.sum(), 1), max((~positive).sum(), 1)
    share = (toxic + other + 1) / (n + m + 2)
    distance = np.abs(toxic / n - other / m) / np.sqrt(share * (1 - share) * (1 / n + 1 / m))
    distance[toxic + other < LEAST] = -1
    best = np.argsort(-distance, kind="stable")[:VOCABULARY]
    return known[np.sort(best[distance[best] > ERRORS])]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(examples: list[np.ndarray], positive: np.ndarray, prior: float) -> Member:
    """One classifier by full-batch steps (Adam) on the non-negative risk with logistic loss."""
    rows = np.repeat(np.arange(len(examples)), [len(e) for e in examples])
    words = np.concatenate([*examples, np.zeros(0, np.uint32)])
    chosen = _choose(rows, words, positive)
    if not len(chosen):
        return Member(chosen, np.zeros(0), float(np.log(prior / (1 - prior))))
    at = np.minimum(np.searchsorted(chosen, words), len(chosen) - 1)
    inside = chosen[at] == words
    rows, at = rows[inside], at[inside]
    n, d = len(examples), len(chosen)
    p, u = positive / max(positive.sum(), 1), ~positive / max((~positive).sum(), 1)
    theta = np.zeros(d + 1)
    theta[d] = np.log(prior / (1 - prior))
    slow, fast = np.zeros(d + 1), np.zeros(d + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, theta[at], n) + theta[d]
        toxic = _sigmoid(z)
        as_toxic = np.logaddexp(0, z)  # the loss of z where the truth is clean
        clean_risk = u @ as_toxic - prior * (p @ as_toxic)
        down = u * toxic - prior * p * toxic
        slope = down - prior * p * (1 - toxic) if clean_risk >= 0 else -down
        gradient = np.append(np.bincount(at, slope[rows], d), slope.sum()) + DECAY * np.append(theta[:d], 0)
        slow, fast = 0.9 * slow + 0.1 * gradient, 0.999 * fast + 0.001 * gradient**2
        theta -= RATE * (slow / (1 - 0.9**step)) / (np.sqrt(fast / (1 - 0.999**step)) + 1e-8)
    return Member(chosen, theta[:d], float(theta[d]))


def probabilities(members: list[Member], words: np.ndarray) -> float:
    total = 0.0
    for m in members:
        at = np.minimum(np.searchsorted(m.words, words), max(len(m.words) - 1, 0))
        z = m.bias + (m.weights[at][m.words[at] == words].sum() if len(m.words) and len(words) else 0.0)
        total += float(_sigmoid(np.float64(z)))
    return total / len(members)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return remainder(doc_id, 5) == 0


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, bags: int = BAGS) -> tuple[list[Member], float]:
    """Members (none without a toxic example) and the share of toxic documents.

    The share is that of all labels that are not held out. The sample is bounded
    by ``positives`` and ``unlabelled`` texts; its words go to one task per bag,
    and of it only the members come to the driver.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    counted = known.agg(F.avg("toxic").alias("p")).first()["p"]
    prior = float(min(max(counted or 0.0, 0.0), 0.95))
    if prior == 0:
        return [], 0.0
    narrow = kept(docs.where(~held_out(F.col("doc_id"))).select("doc_id", F.xxhash64("text", F.lit(SEED)).alias("h")))
    toxic_ids = known.where("toxic = 1").select("doc_id").distinct()

    def drawn(rows: DataFrame, n: int, positive: bool) -> DataFrame:
        once = rows.groupBy("h").agg(F.min("doc_id").alias("doc_id"))
        return smallest(kept(once), n).select("doc_id", F.lit(positive).alias("positive"))

    chosen = drawn(narrow.join(toxic_ids, "doc_id", "left_semi"), positives, True).unionByName(
        drawn(narrow, unlabelled, False)
    )
    chosen = kept(chosen)  # at most positives + unlabelled rows, so it may be broadcast
    sample = docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").dropDuplicates(["doc_id"])

    def featurise(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = [word_hashes(t).tobytes() for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    words = per_batch(sample.select("doc_id", "text"), featurise, f"doc_id {kind}, words binary")
    bagged = words.join(chosen, "doc_id").withColumn("bag", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(bags)))

    def fit_bag(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["positive", "doc_id"])
        examples = [np.frombuffer(w, np.uint32) for w in frame["words"]]
        m = train(examples, frame["positive"].to_numpy(bool), prior)
        return pd.DataFrame({"words": [m.words.tobytes()], "weights": [m.weights.tobytes()], "bias": [m.bias]})

    members = bagged.groupBy("bag").applyInPandas(fit_bag, "words binary, weights binary, bias double").collect()
    made = [Member(np.frombuffer(m["words"], np.uint32), np.frombuffer(m["weights"]), m["bias"]) for m in members]
    return sorted(made, key=lambda m: (m.bias, len(m.words))), prior


def score_documents(docs: DataFrame, labels: DataFrame, **sample: int) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``; see ``fit``."""
    members, prior = fit(docs.select("doc_id", "text"), labels, **sample)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [probabilities(members, word_hashes(t)) if members else prior for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), make, f"doc_id {kind}, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
