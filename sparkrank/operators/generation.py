"""Labelled retrieval data from templates: products, queries, ground truth.

All draws are keyed by row (see ``functions.keyed``): the same seed gives the
same rows on any cluster. Lists of a template too long for its row are rows of
their own (see ``operators.domains``) and give the same draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrank.functions.keyed import (
    keyed_bucket, keyed_index, keyed_int, keyed_pick, keyed_subset, keyed_uniform,
)
from sparkrank.functions.ranking import number_rows
from sparkrank.functions.sizing import broadcast_if_within
from sparkrank.functions.text import title_case
from sparkrank.operators.domains import ATTRIBUTE, BRAND, VARIATION, found_value, look_up, with_long_sizes
from sparkrank.sources.scratch import scratch_root, shuffle_width, write_table

SEED = 42
MIN_RELEVANT, MAX_RELEVANT = 5, 15
INDEX_BUCKETS = 256


def number_templates(templates: DataFrame) -> DataFrame:
    """Templates plus cat_no, type_no (from 0, in name order) and types per category.

    Categories are numbered in parallel, in parts by their first two bytes.
    """
    in_category = Window.partitionBy("category")
    categories = templates.select("category").where(F.col("category").isNotNull()).distinct()
    head = F.rpad(F.hex(F.substring(F.encode("category", "utf-8"), 1, 2)), 4, "0")
    numbered = number_rows(categories, [], ["category"], F.conv(head, 16, 10).cast("bigint"), "cat_no")
    return templates.join(broadcast_if_within(numbered), "category").withColumns(
        {
            "type_no": (F.row_number().over(in_category.orderBy("product_type")) - 1).cast("bigint"),
            "types": F.count(F.lit(1)).over(in_category),
        }
    )


def _once(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder: what several steps read is computed once."""
    return write_table(df, scratch_root(df.sparkSession))


def _category_sizes(numbered: DataFrame) -> tuple[DataFrame, int]:
    sizes = numbered.groupBy("cat_no").agg(F.max("types").alias("types"))
    return broadcast_if_within(sizes), sizes.count()


def quota_slots(templates: DataFrame, n: int, seed: int = SEED, numbered: DataFrame | None = None) -> DataFrame:
    """(slot 1..n, cat_no, type_no): equal shares per category and per type inside it.

    The rest of a category goes to random types of it, the rest of n to random
    categories and types. ``numbered`` are the templates as ``number_templates``
    numbers them, where the caller has them.
    """
    sizes, n_categories = _category_sizes(_once(number_templates(templates)) if numbered is None else numbered)
    share = n // n_categories
    slots = templates.sparkSession.range(1, n + 1).withColumnRenamed("id", "slot")
    at = F.col("slot") - 1
    shared = at < share * n_categories
    by_quota = F.floor(at / F.lit(max(share, 1))).cast("bigint")
    random_cat = keyed_index(seed, "category", F.lit(n_categories), F.col("slot"))
    placed = slots.withColumn("cat_no", F.when(shared, by_quota).otherwise(random_cat)).join(sizes, "cat_no")
    inside = at % F.lit(max(share, 1))
    per_type = F.floor(F.lit(share) / F.col("types")).cast("bigint")
    type_quota = F.floor(inside / F.greatest(per_type, F.lit(1))).cast("bigint")
    random_type = keyed_index(seed, "type", F.col("types"), F.col("slot"))
    return placed.select(
        "slot", "cat_no",
        F.when(shared & (inside < per_type * F.col("types")), type_quota).otherwise(random_type).alias("type_no"),
    )


def triangular_rating(u: Column) -> Column:
    """Inverse distribution of a triangle over 3..5 with its peak at 4.5."""
    return F.when(u <= 0.75, 3 + F.sqrt(3 * u)).otherwise(5 - F.sqrt(1 - u))


def fill_slots(template: Column, values: Column) -> Column:
    """Replace every ``{key}`` by the value of the map."""
    return F.aggregate(
        F.map_entries(values), template,
        lambda text, e: F.replace(text, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]),
    )


def _product_position(seed: int, row: Column):
    """Position of a product in a long list; the product type itself, before all variations, is -1."""

    def position(name: Column, size: Column) -> Column:
        base = keyed_index(seed, "base", size + 1, row) - 1
        return F.when(name == VARIATION, base).otherwise(keyed_index(seed, name, size, row))

    return position


def generate_products(
    templates: DataFrame, n: int, seed: int = SEED, long_values: DataFrame | None = None
) -> DataFrame:
    """n products after the templates, without any shuffle of the product rows.

    ``long_values`` are the lists that are not in ``templates``, as
    ``domains.split_lists`` makes them. With them, the products of such a
    template are shuffled for their values and once more to get them back.
    """
    numbered = _once(with_long_sizes(number_templates(templates), long_values))
    rows = quota_slots(templates, n, seed, numbered).join(broadcast_if_within(numbered), ["cat_no", "type_no"])
    slot = F.col("slot")
    rows = look_up(rows, "slot", long_values, _product_position(seed, slot))
    named = rows.withColumns(
        {
            "variation": F.coalesce(
                found_value(F.lit(VARIATION)),
                keyed_pick(seed, "base", F.concat(F.array("product_type"), F.col("variations")), slot),
            ),
            "brand": F.coalesce(found_value(F.lit(BRAND)), keyed_pick(seed, "brand", F.col("brands"), slot)),
            "chosen": F.transform_values(
                "attributes",
                lambda k, v: F.coalesce(
                    found_value(F.concat(F.lit(ATTRIBUTE), k)),
                    F.get(v, keyed_index(seed, F.concat(F.lit(ATTRIBUTE), k), F.size(v), slot).cast("int")),
                ),
            ),
            "template": keyed_pick(seed, "description", F.col("description_templates"), slot),
        }
    )
    key_value = F.coalesce(F.try_element_at("chosen", F.col("key_attr")), F.lit(""))
    title = F.concat(F.col("brand"), F.lit(" "), title_case(F.col("variation")), F.lit(" - "), key_value)
    values = F.map_concat("chosen", F.create_map(F.lit("variation"), F.col("variation")))
    price = F.col("price_lo") + keyed_uniform(seed, "price", slot) * (F.col("price_hi") - F.col("price_lo"))
    return named.select(
        F.format_string("prod_%05d", slot).alias("id"),
        F.btrim(title, F.lit(" -")).alias("title"),
        fill_slots(F.col("template"), values).alias("description"),
        "category",
        F.round(price, 2).alias("price"),
        "brand",
        F.round(triangular_rating(keyed_uniform(seed, "rating", slot)), 1).alias("rating"),
        F.col("chosen").alias("attributes"),
        "product_type",
    )


def shuffled(products: DataFrame, seed: int = SEED) -> DataFrame:
    return products.orderBy(keyed_int(seed, "shuffle", F.col("id")), "id")


def product_index(products: DataFrame, seed: int = SEED, buckets: int | None = None) -> DataFrame:
    """(category, product_type, pos, id): products of a type numbered in hash order.

    A long table instead of one id list per type, so that a type with most of
    the catalog is spread over ``buckets`` parts. Their number changes no position.
    """
    buckets = buckets or max(INDEX_BUCKETS, 4 * shuffle_width(products.sparkSession))
    hashed = products.select(
        "category", "product_type", "id", keyed_int(seed, "index", F.col("id")).alias("_h")
    )
    bucket = keyed_bucket(F.col("_h"), buckets)
    return number_rows(hashed, ["category", "product_type"], ["_h", "id"], bucket).select(
        "category", "product_type", "pos", "id"
    )


def type_sizes(index: DataFrame) -> DataFrame:
    return index.groupBy("category", "product_type").agg(F.count(F.lit(1)).alias("n_products"))


def draw_relevant(
    targets: DataFrame, index: DataFrame, seed: int = SEED, sizes: DataFrame | None = None
) -> DataFrame:
    """(query_id, id): 5 to 15 products of each target type, without replacement.

    ``targets`` is (query_id, category, product_type). Positions are drawn, then
    looked up in the index; products that are not drawn never meet a query.
    ``sizes`` are the ``type_sizes`` of the index, where the caller has them.
    """
    keys = [F.col("query_id"), F.col("product_type")]
    spread = MAX_RELEVANT - MIN_RELEVANT + 1
    size = F.least(
        MIN_RELEVANT + keyed_index(seed, "relevant", F.lit(spread), *keys), F.col("n_products")
    )
    sizes = _once(type_sizes(index)) if sizes is None else sizes
    drawn = _once(
        targets.join(broadcast_if_within(sizes), ["category", "product_type"])
        .withColumn("size", size)
        .select(
            "query_id", "category", "product_type",
            F.explode(keyed_subset(seed, F.col("size"), F.col("n_products"), *keys)).alias("pos"),
        )
    )
    return index.join(
        broadcast_if_within(drawn), ["category", "product_type", "pos"]
    ).select("query_id", "id")


def query_name(number: Column) -> Column:
    return F.format_string("query_%03d", number)


def template_queries(
    templates: DataFrame, index: DataFrame, num_queries: int, sizes: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Queries and (query_id, category, product_type) targets of the templates.

    A target type without products adds nothing and a query without any target
    left is dropped. Stage 0 is taken whole; later stages only up to
    ``num_queries``, counted over what was kept.
    """
    keys = ["stage", "template_no"]
    sizes = type_sizes(index) if sizes is None else sizes
    # a template comes back as one row with the targets that are left
    kept = (
        templates.select(*keys, "query", "query_type", "category", F.explode("target_products").alias("product_type"))
        .join(broadcast_if_within(sizes), ["category", "product_type"], "left_semi")
        .groupBy(*keys, "query", "query_type", "category")
        .agg(F.collect_list("product_type").alias("found"))
    )
    bucket = F.col("stage").cast("bigint") * F.lit(1 << 40) + F.floor(F.col("template_no") / 10_000).cast("bigint")
    numbered = _once(
        number_rows(kept, [], keys, bucket, "query_no")
        .where((F.col("stage") == 0) | (F.col("query_no") < num_queries))
        .withColumn("query_id", query_name(F.col("query_no") + 1))
    )
    return (
        numbered.select("query_id", "query", "query_type"),
        numbered.select("query_id", "category", F.explode("found").alias("product_type")),
    )


def unmatched_targets(templates: DataFrame, index: DataFrame) -> DataFrame:
    """(query, category, product_type) of targets that no product has."""
    return templates.select(
        "query", "category", F.explode("target_products").alias("product_type")
    ).join(broadcast_if_within(type_sizes(index)), ["category", "product_type"], "left_anti").select(
        "query", "category", "product_type"
    )


def filler_queries(
    templates: DataFrame, index: DataFrame, first: int, count: int, seed: int = SEED, sizes: DataFrame | None = None,
    long_values: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``count`` generated queries numbered from ``first``, with their targets.

    Drawn from the product types that have products, in three styles: brand and
    variation, "best" variation, variation and an attribute value.
    """
    sizes = type_sizes(index) if sizes is None else sizes
    stocked = templates.join(broadcast_if_within(sizes), ["category", "product_type"], "left_semi")
    numbered = _once(with_long_sizes(number_templates(stocked), long_values))
    types, n_categories = _category_sizes(numbered)
    no = F.col("no")
    rows = (
        templates.sparkSession.range(first, first + count).withColumnRenamed("id", "no")
        .withColumn("cat_no", keyed_index(seed, "q-category", F.lit(n_categories), no))
        .join(types, "cat_no")
        .withColumn("type_no", keyed_index(seed, "q-type", F.col("types"), no))
        .drop("types")
        .join(broadcast_if_within(numbered), ["cat_no", "type_no"])
    )
    attribute = keyed_pick(seed, "q-attribute", F.array_sort(F.map_keys("attributes")), no)

    def position(name: Column, size: Column) -> Column:
        drawn = F.when(name.startswith(ATTRIBUTE), F.lit("q-value")).otherwise(F.concat(F.lit("q-"), name))
        return keyed_index(seed, drawn, size, no)

    value = keyed_pick(seed, "q-value", F.try_element_at("attributes", attribute), no)
    parts = look_up(rows, "no", long_values, position).withColumns(
        {
            "variation": F.coalesce(
                found_value(F.lit(VARIATION)), keyed_pick(seed, "q-variation", F.col("variations"), no)
            ),
            "brand": F.coalesce(found_value(F.lit(BRAND)), keyed_pick(seed, "q-brand", F.col("brands"), no)),
            "style": keyed_index(seed, "q-style", F.lit(3), no),
            "value": F.coalesce(found_value(F.concat(F.lit(ATTRIBUTE), attribute)), value),
        }
    )
    text = (
        F.when(F.col("style") == 0, F.concat_ws(" ", "brand", "variation"))
        .when(F.col("style") == 1, F.concat_ws(" ", F.lit("best"), "variation"))
        .otherwise(F.concat_ws(" ", "variation", "value"))
    )
    named = parts.withColumn("query_id", query_name(no))
    return (
        named.select("query_id", text.alias("query"), F.lit("generated").alias("query_type")),
        named.select("query_id", "category", "product_type"),
    )


def generate_queries(
    product_templates: DataFrame,
    query_templates: DataFrame,
    index: DataFrame,
    num_queries: int,
    seed: int = SEED,
    long_values: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(queries, qrels): template queries filled up to ``num_queries``."""
    sizes = _once(type_sizes(index))
    queries, targets = template_queries(query_templates, index, num_queries, sizes)
    have = queries.count()
    if have < num_queries:
        more, more_targets = filler_queries(
            product_templates, index, have + 1, num_queries - have, seed, sizes, long_values
        )
        queries, targets = queries.unionByName(more), targets.unionByName(more_targets)
    return queries, draw_relevant(targets, index, seed, sizes)
