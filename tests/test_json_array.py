"""Reading one JSON array in many tasks."""

from __future__ import annotations

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Row

from sparkrank.sources import catalog
from sparkrank.sources.schema import PRODUCT, QUERY

AWKWARD = [
    {"id": "a", "title": "plain", "attributes": {"k": "v", "brace": "},\n  {"}},
    {"id": "b", "title": "ends ]", "description": "\n  }\n]", "price": 1.5},
    {},
    {"id": "c", "title": None, "attributes": {}},
    {"id": "d", "title": "[", "brand": "ünï \"quoted\" \\  "},
    {"id": "e", "rating": 4, "extra": [{"x": 1}, {"y": [1, 2]}]},
]


def _file(folder, records, **how) -> str:
    path = str(folder / "records.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(records, f, ensure_ascii=False, **how)
    return path


def _rows(df) -> list:
    return sorted(df.collect(), key=repr)


@pytest.mark.parametrize("how", [{"indent": 2}, {"indent": 4}, {"indent": 0}, {}, {"separators": (",", ":")}])
@pytest.mark.parametrize("size", [0, 1, 2, len(AWKWARD)])
def test_any_layout_gives_all_records(spark, tmp_path, how, size):
    path = _file(tmp_path, AWKWARD[:size], **how)
    whole = spark.read.schema(PRODUCT).option("multiLine", True).json(path)
    assert _rows(catalog.load_json_array(spark, path, PRODUCT)) == _rows(whole)


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    records = [
        {"id": f"q{i}", "query": "word " * (i % 50), "query_type": "t", "relevant_product_ids": [str(j) for j in range(i % 7)]}
        for i in range(3000)
    ]
    path = _file(tmp_path, records, indent=2)
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_011)
    try:
        read = catalog.load_queries(spark, path, "json_array")
        assert read.rdd.getNumPartitions() > 10
        got = _rows(read)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)
    assert got == sorted((Row(**r) for r in records), key=repr)
    assert read.schema == QUERY


def test_split_inside_an_object_fails(spark, tmp_path):
    path = str(tmp_path / "odd.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write('[{"id": "a", "relevant_product_ids": ["x"], "n": [\n  {"y": 1\n  },\n  {"y": 2}]}]')
    with pytest.raises((PySparkException, Py4JJavaError)):
        catalog.load_json_array(spark, path, QUERY).collect()


def test_round_trip_over_several_files(spark, tmp_path):
    rows = [
        Row(id=str(i), title="t\n  },\n  {" if i % 2 else None, description="]", category="c", price=i / 3,
            brand="b", rating=None, attributes={"a": "\n"}, product_type="")
        for i in range(50)
    ]
    df = spark.createDataFrame(rows, PRODUCT).repartition(3)
    catalog.save(df, str(tmp_path / "out"), "json_array")
    assert _rows(catalog.load_products(spark, str(tmp_path / "out"), "json_array")) == _rows(df)
    for part in (tmp_path / "out").glob("part-*"):
        assert isinstance(json.loads(part.read_text(encoding="utf-8")), list)
    catalog.save(df.limit(0), str(tmp_path / "none"), "json_array")
    assert _rows(catalog.load_products(spark, str(tmp_path / "none"), "json_array")) == []
