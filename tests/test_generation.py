"""Generated products, queries and ground truth."""

import collections
import json
import math

import pytest
from pyspark.sql import functions as F

from sparkrank.functions import keyed
from sparkrank.functions.keyed import keyed_subset, keyed_uniform
from sparkrank.functions.ranking import number_rows
from sparkrank.operators import domains, generation
from sparkrank.operators.metrics import METRICS
from sparkrank.plans.flow import run_flow
from sparkrank.sources import catalog, standin
from sparkrank.sources.schema import PRODUCT, QUERY
from sparkrank.sources.scratch import scratch_root

PRODUCT_TEMPLATES = [
    ("shoes", "sneaker", ["running shoe", "t-shirt shoe"], ["Nike", "Puma"], {"color": ["red", "blue"], "size": ["9"]}, "color", 10.0, 20.0,
     ["A {variation} in {color}, size {size}.", "{color} {variation}"]),
    ("shoes", "boot", ["hiker"], ["Nike"], {"color": ["black"]}, "color", 30.0, 30.0, ["{variation}!"]),
    ("kitchen", "blender", ["mixer"], ["Acme"], {}, "color", 5.0, 6.0, ["Mixes."]),
]
PT_SCHEMA = (
    "category string, product_type string, variations array<string>, brands array<string>, "
    "attributes map<string,array<string>>, key_attr string, price_lo double, price_hi double, "
    "description_templates array<string>"
)
QUERY_TEMPLATES = [
    (0, 0, "trail footwear", "shoes", ["sneaker", "boot"], "synonym"),
    (0, 1, "nothing there", "garden", ["rake"], "natural"),
    (0, 2, "fruit drinks", "kitchen", ["blender", "sneaker"], "natural"),
    (1, 0, "snow boots", "shoes", ["boot"], "keyword"),
    (1, 1, "mix it", "kitchen", ["blender"], "keyword"),
]
QT_SCHEMA = (
    "stage int, template_no bigint, query string, category string, target_products array<string>, query_type string"
)


def templates(spark):
    return (
        spark.createDataFrame(PRODUCT_TEMPLATES, PT_SCHEMA),
        spark.createDataFrame(QUERY_TEMPLATES, QT_SCHEMA),
    )


def test_uniform_draws_are_spread(spark):
    u = spark.range(20000).select(keyed_uniform(42, "x", F.col("id")).alias("u"))
    facts = u.agg(F.min("u"), F.max("u"), F.avg("u"), F.stddev("u")).first()
    assert facts[0] >= 0 and facts[1] < 1
    assert abs(facts[2] - 0.5) < 0.01 and abs(facts[3] - math.sqrt(1 / 12)) < 0.01


def test_draws_reach_beyond_32_bits_and_buckets_follow_them(spark):
    rows = spark.range(20_000).select(keyed.keyed_int(7, "x", F.col("id")).alias("h"))
    top = F.lit(keyed.SCALE - 1).cast("bigint")
    size = 10**12
    found = rows.unionByName(spark.range(1).select(top.alias("h"))).select(
        "h", F.floor(F.col("h") / F.lit(float(keyed.SCALE)) * size).cast("bigint").alias("at"),
        keyed.keyed_bucket(F.col("h"), 50_000).alias("bucket"),
    ).orderBy("h").collect()
    assert len({r["at"] for r in found}) == 20_001 and found[-1]["at"] < size and found[-1]["bucket"] == 49_999
    assert any(r["at"] % 2**32 != r["at"] for r in found) and min(r["bucket"] for r in found) >= 0
    assert [r["bucket"] for r in found] == sorted(r["bucket"] for r in found)


def test_categories_are_numbered_in_name_order(spark):
    names = ["b", "", "a", "ab", "é", "a\u0000", "Zoo", "zoo", "日本", "ab", None]
    rows = spark.createDataFrame([(c, f"t{i}") for i, c in enumerate(names)], "category string, product_type string")
    got = {r["category"]: r["cat_no"] for r in generation.number_templates(rows).collect()}
    wanted = sorted({c for c in names if c is not None}, key=lambda c: c.encode())
    assert got == {c: i for i, c in enumerate(wanted)}


def test_late_template_numbers_stay_in_their_stage(spark):
    products, _ = templates(spark)
    index = generation.product_index(generation.generate_products(products, 30))
    kind = index.first()
    asked = spark.createDataFrame(
        [(s, n, f"q{s}-{n}", kind["category"], [kind["product_type"]], "t") for s in (0, 1, 2) for n in (0, 3 * 10**10)],
        "stage int, template_no bigint, query string, category string, target_products array<string>, query_type string",
    )
    queries, _ = generation.template_queries(asked, index, 100)
    got = [r["query"] for r in queries.orderBy("query_id").collect()]
    assert got == [f"q{s}-{n}" for s in (0, 1, 2) for n in (0, 3 * 10**10)]


def test_subsets_have_no_repeats_and_cover_evenly(spark):
    drawn = spark.range(3000).select(
        keyed_subset(7, F.lit(4), F.lit(10), F.col("id")).alias("s")
    )
    counts = collections.Counter()
    for r in drawn.collect():
        assert len(set(r["s"])) == 4 and all(0 <= x < 10 for x in r["s"])
        counts.update(r["s"])
    assert all(abs(n - 1200) < 150 for n in counts.values())
    edge = spark.range(1).select(
        keyed_subset(7, F.lit(3), F.lit(3), F.col("id")).alias("all"),
        keyed_subset(7, F.lit(0), F.lit(3), F.col("id")).alias("none"),
    ).first()
    assert sorted(edge["all"]) == [0, 1, 2] and edge["none"] == []


@pytest.mark.parametrize("buckets", [1, 7])
def test_numbers_are_consecutive_in_each_group(spark, buckets):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 700, "hot").otherwise("cold"))
    rows = number_rows(df.repartition(5), ["g"], ["id"], F.floor(F.col("id") * buckets / 1000)).collect()
    for g, first, n in (("hot", 0, 700), ("cold", 700, 300)):
        got = sorted((r["pos"], r["id"]) for r in rows if r["g"] == g)
        assert got == [(i, first + i) for i in range(n)]


def test_rating_curve(spark):
    row = spark.range(1).select(*[
        generation.triangular_rating(F.lit(u)).alias(f"r{i}") for i, u in enumerate((0.0, 0.75, 1.0))
    ]).first()
    assert tuple(row) == (3.0, 4.5, 5.0)


@pytest.mark.parametrize("n", [1, 2, 7, 31, 100])
def test_quotas(spark, n):
    products, _ = templates(spark)
    rows = generation.generate_products(products, n).collect()
    assert sorted(r["id"] for r in rows) == [f"prod_{i:05d}" for i in range(1, n + 1)]
    per_category = n // 2
    counts = collections.Counter((r["category"], r["product_type"]) for r in rows)
    assert counts[("kitchen", "blender")] >= per_category
    assert min(counts[("shoes", t)] for t in ("sneaker", "boot")) >= per_category // 2


def test_product_fields(spark):
    products, _ = templates(spark)
    one = generation.generate_products(products, 200)
    rows = one.collect()
    other = generation.generate_products(products.repartition(5), 200).collect()
    assert sorted(map(str, rows)) == sorted(map(str, other))
    for r in rows:
        if r["product_type"] == "sneaker":
            base = r["title"].removeprefix(r["brand"] + " ").split(" - ")[0]
            assert base in {"Sneaker", "Running Shoe", "T-Shirt Shoe"}
            assert r["title"].endswith(r["attributes"]["color"])
            assert "{" not in r["description"] and r["attributes"]["color"] in r["description"]
            assert 10 <= r["price"] <= 20 and r["price"] == round(r["price"], 2)
        if r["product_type"] == "blender":
            assert r["title"] in {"Acme Blender", "Acme Mixer"} and r["attributes"] == {}
        if r["product_type"] == "boot":
            assert r["price"] == 30.0
        assert 3.0 <= r["rating"] <= 5.0
    assert len({r["title"] for r in rows}) > 8
    assert {tuple(r) for r in generation.generate_products(products, 200, seed=1).select("title").collect()}


def test_shuffled_keeps_all(spark):
    products, _ = templates(spark)
    made = generation.generate_products(products, 50)
    ids = [r["id"] for r in generation.shuffled(made).collect()]
    assert ids != sorted(ids) and len(set(ids)) == 50


def label(spark, num_queries, n_products=90):
    products, asked = templates(spark)
    made = generation.generate_products(products, n_products).persist()
    index = generation.product_index(made).persist()
    queries, qrels = generation.generate_queries(products, asked, index, num_queries)
    return made, queries.collect(), qrels.collect()


def test_template_queries(spark):
    made, queries, qrels = label(spark, 3)
    assert [(q["query_id"], q["query"]) for q in sorted(queries)] == [
        ("query_001", "trail footwear"), ("query_002", "fruit drinks"), ("query_003", "snow boots"),
    ]
    kinds = {r["id"]: r["product_type"] for r in made.collect()}
    per = collections.Counter((r["query_id"], kinds[r["id"]]) for r in qrels)
    assert set(per) == {
        ("query_001", "sneaker"), ("query_001", "boot"), ("query_002", "blender"), ("query_003", "boot"),
    }
    assert all(5 <= n <= 15 for n in per.values())
    assert len({(r["query_id"], r["id"]) for r in qrels}) == len(qrels)


def test_first_stage_is_never_cut(spark):
    _, queries, _ = label(spark, 1)
    assert len(queries) == 2


def test_few_products_give_them_all(spark):
    made, _, qrels = label(spark, 3, n_products=8)
    kinds = {r["id"]: r["product_type"] for r in made.collect()}
    stock = collections.Counter(kinds.values())
    per = collections.Counter((r["query_id"], kinds[r["id"]]) for r in qrels)
    assert all(n == min(stock[t], n) and n >= min(5, stock[t]) for (_, t), n in per.items())


def test_fillers(spark):
    made, queries, qrels = label(spark, 60)
    assert sorted(q["query_id"] for q in queries) == [f"query_{i:03d}" for i in range(1, 61)]
    filled = [q["query"] for q in queries if q["query_type"] == "generated"]
    assert len(filled) == 56
    assert {q["query_id"] for q in queries} == {r["query_id"] for r in qrels}
    assert any(q.startswith("best ") for q in filled) and any(q.startswith(("Nike", "Puma", "Acme")) for q in filled)


def test_unmatched_targets(spark):
    products, asked = templates(spark)
    index = generation.product_index(generation.generate_products(products, 30))
    rows = {tuple(r) for r in generation.unmatched_targets(asked, index).collect()}
    assert rows == {("nothing there", "garden", "rake"), ("fruit drinks", "kitchen", "sneaker")}


def test_json_array_files(spark, tmp_path):
    """The file form of the catalog: one indented JSON array."""
    product = {
        "id": "prod_00001", "title": "T", "description": "D", "category": "c", "price": 1.5,
        "brand": "b", "rating": 4.5, "attributes": {"k": "v"}, "product_type": "p",
    }
    query = {"id": "query_001", "query": "q", "query_type": "natural", "relevant_product_ids": ["prod_00001", "x"]}
    (tmp_path / "products.json").write_text(json.dumps([product, {**product, "id": "prod_00002"}], indent=2))
    (tmp_path / "queries.json").write_text(json.dumps([query], indent=2))
    rows = catalog.load_products(spark, str(tmp_path / "products.json"), "json", multi_line=True)
    assert rows.schema == PRODUCT and rows.count() == 2
    assert rows.first()["attributes"] == {"k": "v"}
    query_set = catalog.load_queries(spark, str(tmp_path / "queries.json"), "json", multi_line=True)
    assert query_set.schema == QUERY
    queries, qrels = catalog.split_queries(query_set)
    assert queries.count() == 1 and {r["id"] for r in qrels.collect()} == {"prod_00001", "x"}
    catalog.save(rows, str(tmp_path / "out"), "json")
    again = catalog.load_products(spark, str(tmp_path / "out"), "json")
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.collect()))


def test_coverage(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "id int, embedding array<float>")
    assert tuple(catalog.embedding_coverage(df).first()) == (2, 1, 1)
    assert catalog.embedded_only(df).count() == 1


def test_flow_and_reuse_of_stages(spark):
    products, asked = templates(spark)
    root = scratch_root(spark)
    first = run_flow(spark, root, products, asked, 60, 12)
    def means(run):
        return sorted((r["method"], *(round(r[m], 9) for m in METRICS)) for r in run["by_method"].collect())

    by_method = means(first)
    assert [r[0] for r in by_method] == ["bm25", "hybrid", "hybrid_rrf", "vector"]
    assert first["metrics"].count() == 12 * 4
    again = run_flow(spark, root, skip=("generate", "embed", "ingest", "index"))
    assert means(again) == by_method
    rebuilt = run_flow(spark, root, skip=("generate", "embed"))
    assert means(rebuilt) == by_method
    with pytest.raises(ValueError, match="unknown stages"):
        run_flow(spark, root, skip=("coffee",))


def as_rows(templates):
    """(category, product_type, name, value) of all lists of ``templates``."""
    lists = F.map_concat(
        F.create_map(F.lit("variation"), F.col("variations"), F.lit("brand"), F.col("brands")),
        F.transform_keys("attributes", lambda k, _: F.concat(F.lit("attr:"), k)),
    )
    rows = templates.select("category", "product_type", F.explode(lists).alias("name", "list"))
    return rows.select("category", "product_type", "name", F.explode("list").alias("value"))


def only_short(templates, limit):
    def cut(values):
        return F.when(F.size(values) <= limit, F.array_sort(values)).otherwise(F.array().cast("array<string>"))

    return templates.withColumns(
        {
            "variations": cut(F.col("variations")), "brands": cut(F.col("brands")),
            "attributes": F.transform_values("attributes", lambda _, v: cut(v)),
        }
    )


@pytest.mark.parametrize("limit", [0, 1])
def test_long_lists_give_the_same_rows(spark, limit):
    products, asked = templates(spark)
    lists = only_short(products, 100).persist()
    _, long_values = domains.split_lists(as_rows(products), limit)
    long_values = long_values.persist()
    short = only_short(products, limit)
    whole = generation.generate_products(lists, 120)
    rowed = generation.generate_products(short, 120, long_values=long_values)
    assert sorted(map(str, rowed.collect())) == sorted(map(str, whole.collect()))
    index = generation.product_index(whole).persist()
    expected = generation.generate_queries(lists, asked, index, 60)
    got = generation.generate_queries(short, asked, index, 60, long_values=long_values)
    for mine, other in zip(got, expected, strict=True):
        assert sorted(map(str, mine.collect())) == sorted(map(str, other.collect()))


def test_split_lists(spark):
    rows = [("a", "x", "brand", v) for v in ["é", "b", "Z", "b", None]] + [("a", "x", "variation", "one"), (None, "x", "brand", "q")]
    rows += [("b", "x", "brand", f"v{i % 7}") for i in range(30)]
    values = spark.createDataFrame(rows, "category string, product_type string, name string, value string")
    lists, long_values = domains.split_lists(values, 3)
    assert {(r["category"], r["product_type"]): r["lists"] for r in lists.collect()} == {
        ("a", "x"): {"brand": ["Z", "b", "é"], "variation": ["one"]}
    }
    assert sorted(map(tuple, long_values.collect())) == [("b", "x", "brand", i, f"v{i}") for i in range(7)]
    lists, long_values = domains.split_lists(values.limit(0), 3)
    assert lists.isEmpty() and long_values.isEmpty()


def test_twenty_thousand_values_in_one_list(spark):
    n = 20_000
    names = spark.range(n).select(
        F.lit("tools").alias("category"), F.lit("saw").alias("product_type"), F.lit("variation").alias("name"),
        F.format_string("saw %05d", "id").alias("value"),
    )
    lists, long_values = domains.split_lists(names)
    long_values = long_values.persist()
    assert lists.isEmpty()
    assert long_values.where(F.col("value") != F.format_string("saw %05d", "pos")).isEmpty()
    template = spark.createDataFrame(
        [("tools", "saw", [], ["Acme"], {}, "", 1.0, 2.0, ["{variation}"])], PT_SCHEMA
    )
    made = generation.generate_products(template, 2 * n, long_values=long_values)
    index = keyed.keyed_index(generation.SEED, "base", F.lit(n + 1), F.col("id"))
    expected = spark.range(1, 2 * n + 1).select(
        F.when(index == 0, "saw").otherwise(F.format_string("saw %05d", index - 1)).alias("description")
    )
    assert made.count() == 2 * n
    assert made.select("description").exceptAll(expected).isEmpty()


def test_templates_of_parts_with_long_lists(spark):
    sf_dir = "/root/testdata/sf0.001"
    short, none = standin.product_templates(spark, sf_dir)
    cut, long_values = standin.product_templates(spark, sf_dir, limit=1)
    assert none.isEmpty() and not long_values.isEmpty()
    whole = generation.generate_products(short, 300)
    assert sorted(map(str, generation.generate_products(cut, 300, long_values=long_values).collect())) == sorted(
        map(str, whole.collect())
    )
