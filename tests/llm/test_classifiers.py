"""Toxicity, quality and URL verdicts: held-out accuracy and edge cases."""

import time
import math
import zlib

import numpy as np
import pytest

from sparkrank.llm import quality, toxicity, urls

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.mark.parametrize(
    ("operator", "label", "parts", "held", "least"),
    [(toxicity, "toxic", 5, 0, 0.97), (quality, "quality", 3, 1, 0.97)],
)
def test_held_out_accuracy(tables, operator, label, parts, held, least):
    docs, labels = tables
    scored = operator.score_documents(docs, labels).toPandas()
    assert len(scored) == docs.count()
    assert scored["score"].between(0, 1).all() and ((scored["score"] >= 0.5) == scored["predicted"].astype(bool)).all()
    expected = [zlib.crc32(str(i).encode()) % parts == held for i in scored["doc_id"]]
    assert scored["held_out"].tolist() == expected
    judged = scored[scored["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (judged["predicted"] == judged[label]).mean() >= least
    worse = judged["score"][judged[label] == 0].to_numpy()
    better = judged["score"][judged[label] == 1].to_numpy()
    assert (better[:, None] > worse[None, :]).mean() >= 0.92


@pytest.mark.parametrize(("operator", "label"), [(toxicity, "toxic"), (quality, "quality")])
def test_odd_documents(spark, operator, label):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "word " * 100_000), (4, "same"), (4, "same"), (5, "\ud7ff🙂")]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], "doc_id long, text string, score double, x string")
    for given in ([], [(1, 1), (2, None), (None, 1)], [(1, 1), (3, 0), (4, 0), (5, 1), (2, 1), (4, 1)]):
        labels = spark.createDataFrame(given, f"doc_id long, {label} int")
        scored = operator.score_documents(docs, labels).collect()
        assert len(scored) == len(rows)
        assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in scored)
    assert operator.score_documents(docs.limit(0), labels).count() == 0


def test_discriminant_equals_plain_densities():
    rng = np.random.default_rng(0)
    d = len(quality.FEATURES)
    means, roots = rng.normal(size=(2, d)), rng.normal(size=(2, d, d))
    covariances = roots @ roots.transpose(0, 2, 1) + np.eye(d)
    model = quality.Discriminant(means, np.linalg.cholesky(covariances), 0.3, 0.5)
    x = rng.normal(size=(20, d))
    for row, score in zip(x, model.scores(x), strict=True):
        logs = [-0.5 * ((row - m) @ np.linalg.solve(c, row - m) + np.linalg.slogdet(c)[1]) for m, c in zip(means, covariances, strict=True)]
        assert score == pytest.approx(1 / (1 + math.exp(-(logs[1] - logs[0] + 0.3))), rel=1e-6)


def test_fit_uses_sums_of_all_examples(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] > 0).astype(int)
    frame = spark.createDataFrame([(int(c), row.tolist()) for c, row in zip(y, x, strict=True)], "label int, x array<double>")
    model = quality.fit(frame, 0.0, 0.0)
    assert np.allclose(model.means[1], x[y == 1].mean(axis=0))
    assert np.allclose(model.factors[0] @ model.factors[0].T, np.cov(x[y == 0].T))


def test_keep_good_keeps_all_columns(tables):
    docs, labels = tables
    kept = quality.keep_good(docs, labels, 0.2)
    assert kept.columns == docs.columns
    judged = kept.select("doc_id").toPandas().merge(labels.toPandas(), on="doc_id")
    good = labels.where("quality = 1").count()
    assert (judged["quality"] == 1).sum() >= 0.98 * good and (judged["quality"] == 0).sum() <= 0.06 * (labels.count() - good)


def test_non_negative_risk_learns_from_positives_only():
    rng = np.random.default_rng(2)
    signal, noise = np.arange(5, dtype=np.uint32), np.arange(100, 400, dtype=np.uint32)
    toxic = [np.concatenate([rng.choice(signal, 2, False), rng.choice(noise, 20, False)]) for _ in range(300)]
    clean = [rng.choice(noise, 20, False) for _ in range(1700)]
    unlabelled = clean[:900] + toxic[200:]
    member = toxicity.train(toxic[:200] + unlabelled, np.array([True] * 200 + [False] * 1000), 0.1)
    score = lambda w: toxicity.probabilities([member], w.astype(np.uint32))
    assert np.mean([score(w) >= 0.5 for w in toxic[200:]]) > 0.95
    assert np.mean([score(w) >= 0.5 for w in clean[900:]]) < 0.02


URLS = [
    ("https://a.example.com/en/1?x=2#y", "a.example.com", "/en/1", "example.com/en/"),
    ("http://WWW.Example.COM/en/", "www.example.com", "/en/", "www.example.com/en/"),
    ("x://example.com/de", "example.com", "/de", "com/"),
    ("http://example.com?en", "example.com", "", None),
    ("http://a.net/es/1", "a.net", "/es/1", "net/es/"),
    ("http://internet/es/1", "internet", "/es/1", None),
    ("http://com/", "com", "/", "com/"),
    ("no scheme", "", "", None),
    (None, "", "", None),
    ("://", "", "", None),
    ("http://ÄB.org/Ä#://", "Äb.org", "/Ä", None),
    ("http://a.org/" + "x" * 100_000, "a.org", "/" + "x" * 100_000, None),
]


def test_urls_follow_the_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, (u, *_) in enumerate(URLS)] + [(0, URLS[0][0], "h")], "page_id long, url string, host string")
    made = urls.judge(pages).collect()
    assert len(made) == len(URLS) + 1
    verdicts = {rule: verdict for verdict, rule in urls.RULES}
    for r in made:
        _, host, path, rule = URLS[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdicts[rule] if rule else r["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0)).count() == 0


def test_trees_learn_what_lexical_features_tell():
    rng = np.random.default_rng(0)
    made = [f"https://{'bad-' * int(bad)}host{rng.integers(1000)}.org/{rng.integers(10**6)}" for bad in rng.random(3000) < 0.4]
    allow = np.array(["bad-" not in u for u in made])
    model = urls.grow([urls.features(u) for u in made[:2000]], [urls.suffix(urls.split(u)[0]) for u in made[:2000]], allow[:2000])
    p = model.allowed([urls.features(u) for u in made[2000:]], ["org"] * 1000)
    assert ((p >= 0.5) == allow[2000:]).mean() > 0.99
    one_sided = urls.grow([urls.features("a")] * 3, ["x"] * 3, np.array([False] * 3))
    assert one_sided.allowed([urls.features("b")], ["y"])[0] < 0.5


def test_rules_by_every_suffix_and_long_hosts():
    rules = urls.Rules((("allow", "com/"), ("block", "b.com/x/"), ("allow", "a.b.com/x/"), ("block", "c/")))
    hosts = ["", "com", ".com", "b.com", "a.b.com", "z.a.b.com", "ab.com", "com.", "x.c", "c.", "..", "a..b.com", "b.com.c"]
    plain = {"com": ("/", "com/", "allow"), "b.com": ("/x/", "b.com/x/", "block"), "a.b.com": ("/x/", "a.b.com/x/", "allow"), "c": ("/", "c/", "block")}
    for host in hosts:
        for path in ("/", "/x/", "/x", ""):
            fits = [(len(r), r, v) for h, (p, r, v) in plain.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
            assert rules.fit(host, path) == (max(fits)[1:] if fits else None)
    started = time.process_time()
    rules.fit("a." * 200_000 + "com", "/")
    assert time.process_time() - started < 0.1


@pytest.mark.parametrize("prior", [0.1, 0.6])
def test_steps_follow_the_risk_by_finite_differences(monkeypatch, prior):
    """The training again with a dense matrix, the risk as written and its slope by differences."""
    steps, d = 12, 9
    monkeypatch.setattr(toxicity, "STEPS", steps)
    monkeypatch.setattr(toxicity, "_choose", lambda rows, words, positive: np.arange(d, dtype=np.uint32))
    rng = np.random.default_rng(5)
    x = (rng.random((60, d)) < 0.4).astype(float)
    positive = np.arange(60) < 20
    x[positive, :3] = rng.random((20, 3)) < 0.8
    member = toxicity.train([np.flatnonzero(row).astype(np.uint32) for row in x], positive, prior)

    def parts(theta):
        z = x @ theta[:d] + theta[d]
        as_clean, as_toxic = np.log1p(np.exp(-z)), np.log1p(np.exp(z))
        clean = as_toxic[~positive].mean() - prior * as_toxic[positive].mean()
        return prior * as_clean[positive].mean() + clean, clean

    def slope(value, theta):
        shifts = 1e-5 * np.eye(d + 1)
        return np.array([(value(theta + s) - value(theta - s)) / 2e-5 for s in shifts])

    theta = np.append(np.zeros(d), np.log(prior / (1 - prior)))
    mean, square, negative = np.zeros(d + 1), np.zeros(d + 1), 0
    for step in range(1, steps + 1):
        if parts(theta)[1] >= 0:
            g = slope(lambda t: parts(t)[0], theta)
        else:
            negative += 1
            g = slope(lambda t: -parts(t)[1], theta)
        g[:d] += toxicity.DECAY * theta[:d]
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        theta = theta - toxicity.RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    assert np.allclose(member.weights, theta[:d], atol=1e-4) and abs(member.bias - theta[d]) < 1e-4
    assert (negative > 0) == (prior > 0.5)


def test_every_split_is_the_best_of_all(monkeypatch):
    monkeypatch.setattr(urls, "LEAST", 4)
    rng = np.random.default_rng(11)
    values = np.round(rng.random((300, 4)) * 12)
    edges = [np.unique(c)[:-1] for c in values.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, values.T, strict=True)], axis=1)
    hessian = rng.random(300) * 0.25
    gradient = np.where(values[:, 0] * values[:, 1] > 30, 0.5, -0.5) + rng.normal(0, 0.2, 300)
    tree = urls._grow(binned, edges, gradient, hessian)

    def gain(rows, feature, threshold):
        left = rows[values[rows, feature] <= threshold]
        right = rows[values[rows, feature] > threshold]
        if min(len(left), len(right)) < urls.LEAST:
            return 0.0
        worth = [gradient[r].sum() ** 2 / (hessian[r].sum() + 1) for r in (left, right, rows)]
        return worth[0] + worth[1] - worth[2]

    nodes, split = {0: np.arange(300)}, 0
    for node in range(len(tree.feature)):
        rows = nodes[node]
        best = max(gain(rows, f, t) for f in range(4) for t in edges[f])
        f, t = tree.feature[node], tree.threshold[node]
        if np.isfinite(t):
            split += 1
            assert abs(gain(rows, f, t) - best) < 1e-7 and best > 0
        else:
            assert best < 1e-7
        above = values[rows, f] > t
        nodes[2 * node + 1], nodes[2 * node + 2] = rows[~above], rows[above]
    assert split > 3
    for leaf, value in enumerate(tree.value):
        rows = nodes[len(tree.feature) + leaf]
        assert abs(value - gradient[rows].sum() / (hessian[rows].sum() + 1)) < 1e-9
    assert np.allclose(tree.values(values), [tree.value[next(i for i in range(len(tree.value)) if r in nodes[len(tree.feature) + i])] for r in range(300)])
