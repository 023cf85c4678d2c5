"""URL filter: rules decide first, gradient-boosted trees over lexical features the rest.

The labelled URLs are those that a rule fits: its verdict is their label. Trees
are grown on a bounded sample of them, from features of the URL's text alone and
statistics of its suffix (the last label of the host) among the examples.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is judged by the trees like any other; repeated URLs train
once; with examples of one verdict only everything else gets that verdict, and
without any example ``allow``.
"""

from __future__ import annotations

from collections import Counter
from math import log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.shared import kept, per_batch, smallest

#: (verdict, rule): host, then the start of the path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Labelled URLs to learn from, those with the smallest hashes.
SAMPLE = 50_000
TREES, DEPTH, RATE, BINS, LEAST = 40, 3, 0.2, 32, 20
#: Examples a suffix needs for statistics of its own.
SUFFIX_LEAST = 20
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FEATURES = (
    "length", "host_length", "path_length", "labels", "depth", "digits", "digits_in_host", "entropy",
    "host_entropy", "parameters", "hyphens", "fragment", "longest_label", "secure",
)


def split(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z lower-cased), path, and the rest."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", ""
    ends = [at for c in "/?#" if (at := rest.find(c)) >= 0]
    host_end = min(ends, default=len(rest))
    after = rest[host_end:]
    path_end = min((at for c in "?#" if (at := after.find(c)) >= 0), default=len(after))
    return rest[:host_end].translate(LOWER), after[:path_end], after[path_end:]


class Rules:
    """Looks up the longest fitting rule by the suffixes of a host."""

    def __init__(self, rules: tuple[tuple[str, str], ...] = RULES):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))
        self.labels = max((host.count(".") + 1 for host in self.by_host), default=0)

    def fit(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict); of two of the same length the first in order of text.

        Only as many labels at the end of the host are looked at as a rule has.
        """
        found, labels = [], host.rsplit(".", self.labels)
        for count in range(1, min(len(labels), self.labels) + 1):
            for start, rule, verdict in self.by_host.get(".".join(labels[-count:]), ()):
                if path.startswith(start):
                    found.append((-len(rule), rule, verdict))
        return min(found)[1:] if found else None


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * log2(c / n) for c in Counter(text).values())


def features(url: str | None) -> list[float]:
    """The values of ``FEATURES`` for a whole URL."""
    url = url or ""
    host, path, rest = split(url)
    labels = host.split(".")
    query = rest.partition("#")[0].removeprefix("?")
    digits = sum(c.isdigit() for c in url)
    return [
        float(len(url)), float(len(host)), float(len(path)), float(len(labels)),
        float(sum(bool(p) for p in path.split("/"))), digits / max(len(url), 1),
        sum(c.isdigit() for c in host) / max(len(host), 1), entropy(url), entropy(host),
        float(sum(bool(p) for p in query.split("&"))), float(url.count("-")), float("#" in rest),
        float(max(map(len, labels))), float(url[:6].lower() == "https:"),
    ]


def suffix(host: str) -> str:
    return host.rpartition(".")[2]


class Tree(NamedTuple):
    """A full binary tree: feature and threshold per inner node, value per leaf; right if above."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def values(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[np.arange(len(x)), self.feature[at]] > self.threshold[at])
        return self.value[at - len(self.feature)]


class Trees(NamedTuple):
    """Boosted trees on the features and two suffix statistics; ``bias`` alone without trees."""

    bias: float
    trees: list[Tree]
    suffixes: dict[str, tuple[float, float]]
    other: tuple[float, float]

    def inputs(self, x: list[list[float]], suffixes: list[str]) -> np.ndarray:
        known = [self.suffixes.get(s, self.other) for s in suffixes]
        return np.hstack([np.array(x, float).reshape(-1, len(FEATURES)), np.array(known, float).reshape(-1, 2)])

    def allowed(self, x: list[list[float]], suffixes: list[str]) -> np.ndarray:
        """Probability of ``allow``."""
        inputs = self.inputs(x, suffixes)
        z = np.full(len(inputs), self.bias) + RATE * sum(t.values(inputs) for t in self.trees)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _grow(binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray) -> Tree:
    """One tree by the largest gain of second order at every node, level by level."""
    inner, d = 2**DEPTH - 1, binned.shape[1]
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    at = np.zeros(len(binned), np.int64)
    for level in range(DEPTH):
        first, nodes = 2**level - 1, 2**level
        cells = (at - first) * (BINS + 1)
        best = np.zeros(nodes)
        for f in range(d):
            where = cells + binned[:, f]
            g, h, n = (
                np.bincount(where, w, nodes * (BINS + 1)).reshape(nodes, BINS + 1).cumsum(axis=1)
                for w in (gradient, hessian, None)
            )
            total_g, total_h, total_n = g[:, -1:], h[:, -1:], n[:, -1:]
            gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
            gain[(n < LEAST) | (total_n - n < LEAST)] = -1
            gain[:, len(edges[f]) :] = -1
            cut = gain.argmax(axis=1)
            for node in np.flatnonzero(gain[np.arange(nodes), cut] > best + 1e-9):
                best[node] = gain[node, cut[node]]
                feature[first + node], threshold[first + node] = f, edges[f][cut[node]]
        f = feature[at]
        bins = np.array([np.searchsorted(edges[k], t) if np.isfinite(t) else BINS + 1 for k, t in zip(feature, threshold, strict=True)])
        at = 2 * at + 1 + (binned[np.arange(len(binned)), f] > bins[at])
    leaf = at - inner
    g, h = (np.bincount(leaf, w, inner + 1) for w in (gradient, hessian))
    return Tree(feature, threshold, g / (h + 1))


def grow(x: list[list[float]], suffixes: list[str], allow: np.ndarray) -> Trees:
    """Boosted trees with logistic loss; features are cut at quantiles of the sample."""
    n, good = Counter(suffixes), Counter(s for s, a in zip(suffixes, allow, strict=True) if a)
    share = (allow.sum() + 1) / (len(allow) + 2)
    bias = float(np.log(share / (1 - share)))
    known = {s: ((good[s] + share) / (c + 1), float(np.log1p(c))) for s, c in n.items() if c >= SUFFIX_LEAST}
    model = Trees(bias, [], known, (share, 0.0))
    if not len(allow) or allow.all() or not allow.any():
        return Trees(9.0 if not len(allow) or allow.all() else -9.0, [], {}, (share, 0.0))
    inputs = model.inputs(x, suffixes)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in inputs.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, inputs.T, strict=True)], axis=1)
    z = np.full(len(inputs), bias)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        tree = _grow(binned, edges, allow - p, p * (1 - p))
        model.trees.append(tree)
        z += RATE * tree.values(inputs)
    return model


def fit(pages: DataFrame, rules: Rules, sample: int = SAMPLE) -> Trees:
    """Trees from at most ``sample`` different URLs that a rule fits; only their features reach the driver."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for url in batch.column(0).to_pylist():
            host, path, _ = split(url)
            if found := rules.fit(host, path):
                key = xxhash.xxh64_intdigest(url.encode("utf-8", "surrogatepass")) - (1 << 63)
                rows.append((key, found[1] == "allow", suffix(host), features(url)))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["h", "allow", "suffix", "x"]
        )

    labelled = per_batch(pages.select("url"), make, "h bigint, allow boolean, suffix string, x array<double>")
    chosen = smallest(kept(labelled.dropDuplicates(["h"])), sample).toPandas()
    return grow([list(v) for v in chosen["x"]], list(chosen["suffix"]), chosen["allow"].to_numpy(bool))


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and allowed (the trees' probability) per row of ``pages``.

    A rule fits its host and all hosts below it if the path starts with the
    rule's; the longest rule wins, and its verdict stands. ``allowed`` is null
    where a rule decided.
    """
    look_up = Rules(rules)
    trees = fit(pages, look_up, sample)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        urls = batch.column(1).to_pylist()
        parts = [split(u) for u in urls]
        found = [look_up.fit(host, path) for host, path, _ in parts]
        open_ = [i for i, f in enumerate(found) if f is None]
        p = dict(zip(open_, trees.allowed([features(urls[i]) for i in open_], [suffix(parts[i][0]) for i in open_]).tolist(), strict=True))
        verdicts = [f[1] if f else ("allow" if p[i] >= 0.5 else "block") for i, f in enumerate(found)]
        columns = [
            [h for h, _, _ in parts], [q for _, q, _ in parts], [f and f[0] for f in found], verdicts,
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.string()) for c in columns), pa.array([p.get(i) for i in range(len(urls))], pa.float64())],
            names=["page_id", "host", "path", "rule", "verdict", "allowed"],
        )

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, host string, path string, rule string, verdict string, allowed double"
    return per_batch(pages.select("page_id", "url"), make, schema)
