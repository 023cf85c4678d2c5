"""Value lists of templates, of any length.

A list of up to ``LIST_VALUES`` values stays in the row of its template, which
is broadcast; a longer one becomes numbered rows (category, product_type, name,
pos, value) that are looked up by position. As a long list has many positions,
none of them draws a large share of the look-ups. ``name`` is ``VARIATION``,
``BRAND`` or ``ATTRIBUTE`` followed by the key of the attribute.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrank.functions.ranking import number_rows
from sparkrank.functions.sizing import broadcast_if_within
from sparkrank.sources.scratch import scratch_root, write_table

LIST_VALUES = 1_000
VARIATION, BRAND, ATTRIBUTE = "variation", "brand", "attr:"
TEMPLATE = ["category", "product_type"]
LONG_SIZES = "map<string,bigint>"


def split_lists(values: DataFrame, limit: int = LIST_VALUES) -> tuple[DataFrame, DataFrame]:
    """Lists and long values of ``values`` (category, product_type, name, value).

    The lists are (category, product_type, lists): a map of name to its sorted
    values, at most ``limit`` each; the long values are numbered in the order of
    the value by parts of a range partitioning, so no task sees a whole list.
    Repeated values count once; a row with a null does not count, nor does a
    template of which all lists are long have a row of lists.
    """
    spark, keys = values.sparkSession, [*TEMPLATE, "name"]
    distinct = write_table(values.select(*keys, "value").dropna().distinct(), scratch_root(spark))
    wide = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).drop("_n")
    wide = broadcast_if_within(write_table(wide, scratch_root(spark)))
    short = distinct.join(wide, keys, "left_anti").groupBy(*keys).agg(F.sort_array(F.collect_list("value")).alias("list"))
    lists = short.groupBy(*TEMPLATE).agg(F.map_from_entries(F.collect_list(F.struct("name", "list"))).alias("lists"))
    ranged = distinct.join(wide, keys, "left_semi").repartitionByRange(*keys, "value")
    ranged = write_table(ranged.withColumn("_part", F.spark_partition_id()), scratch_root(spark))
    numbered = number_rows(ranged, keys, ["value"], F.col("_part"))
    return lists, numbered.select(*keys, "pos", "value")


def with_long_sizes(templates: DataFrame, long_values: DataFrame | None) -> DataFrame:
    """``templates`` plus long_sizes, a map of name to length of the lists that are not in the row."""
    if long_values is None:
        return templates.withColumn("long_sizes", F.lit(None).cast(LONG_SIZES))
    sizes = long_values.groupBy(*TEMPLATE, "name").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy(*TEMPLATE).agg(F.map_from_entries(F.collect_list(F.struct("name", "n"))).alias("long_sizes"))
    return templates.join(broadcast_if_within(sizes), TEMPLATE, "left")


def look_up(
    rows: DataFrame, key: str, long_values: DataFrame | None, position: Callable[[Column, Column], Column]
) -> DataFrame:
    """``rows`` plus found, a map of name to value for the long lists of their templates.

    ``position`` gives the place to look at from the name and the length of a
    list; nothing is found at one that the list does not have.
    """
    if long_values is None:
        return rows.withColumn("found", F.lit(None).cast("map<string,string>"))
    asked = rows.select(key, *TEMPLATE, F.explode("long_sizes").alias("name", "_n")).select(
        key, *TEMPLATE, "name", position(F.col("name"), F.col("_n")).alias("pos")
    )
    found = (
        asked.join(broadcast_if_within(long_values), [*TEMPLATE, "name", "pos"])
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("found"))
    )
    return rows.join(found, key, "left")


def found_value(name: Column) -> Column:
    return F.try_element_at(F.col("found"), name)
