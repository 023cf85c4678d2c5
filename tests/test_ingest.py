"""Validation, upsert, error accounting and the stream."""

import pytest
from pyspark.sql import functions as F

from sparkrank.operators import ingest
from sparkrank.sources.scratch import scratch_root
from sparkrank.streaming.ingest_stream import start_ingest

SCHEMA = (
    "id string, title string, description string, category string, price double, brand string, "
    "rating double, attributes map<string,string>, product_type string, embedding array<float>, seq bigint"
)


def row(i, title="t", vector=(1.0, 2.0), seq=1, attributes=None):
    return (i, title, "d", "c", 1.0, "b", 4.0, attributes, None, list(vector) if vector is not None else None, seq)


def bad_rows():
    return [
        row(None), row("none", vector=None), row("short", vector=(1.0,)),
        row("zero", vector=(0.0, 0.0)), row("nan", vector=(float("nan"), 1.0)),
    ]


def test_upsert_rejects_and_stats(spark):
    target = scratch_root(spark)
    first = spark.createDataFrame(
        [row("a", "old"), row("a", "newer", seq=2), row("b", attributes={"k": "v"}), *bad_rows()], SCHEMA
    )
    stats = ingest.ingest(first, target, 1, dim=2).first()
    assert (stats["total"], stats["success"], stats["failed"]) == (8, 3, 5)
    ingest.ingest(spark.createDataFrame([row("b", "again"), row("c"), row("a", vector=None, seq=9)], SCHEMA), target, 2, 2)
    log = ingest.read_log(spark, target)
    current = {r["id"]: r for r in ingest.current_catalog(log).collect()}
    assert {i: r["title"] for i, r in current.items()} == {"a": "newer", "b": "again", "c": "t"}
    assert current["c"]["attributes"] == {} and current["c"]["product_type"] == ""
    assert {(r["id"], r["reason"]) for r in ingest.rejects(log).where("batch = 1").collect()} == {
        (None, "missing id"), ("none", "missing embedding"), ("short", "wrong dimension"),
        ("zero", "zero vector"), ("nan", "not a number"),
    }
    assert ingest.reject_sample(log, 5).count() == 5


def test_a_batch_written_again_replaces_itself(spark):
    target = scratch_root(spark)
    for title in ("one", "two"):
        ingest.ingest(spark.createDataFrame([row("a", title), row("b", title)], SCHEMA), target, 4, 2)
    log = ingest.read_log(spark, target)
    assert log.count() == 2
    assert {r["title"] for r in ingest.current_catalog(log).collect()} == {"two"}


def test_raise_on_error_writes_nothing(spark):
    target = scratch_root(spark)
    with pytest.raises(ingest.RejectedRows):
        ingest.ingest(spark.createDataFrame([row("a"), *bad_rows()], SCHEMA), target, 1, 2, raise_on_error=True)
    stats = ingest.ingest(spark.createDataFrame([row("a")], SCHEMA), target, 1, 2, raise_on_error=True)
    assert stats.first()["success"] == 1
    assert ingest.read_log(spark, target).count() == 1


def test_hot_id_is_cut_before_the_shuffle(spark):
    target = scratch_root(spark)
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias("id"),
        F.concat(F.lit("v"), F.col("id")).alias("title"), F.lit("d").alias("description"),
        F.lit("c").alias("category"), F.lit(1.0).alias("price"), F.lit("b").alias("brand"),
        F.lit(1.0).alias("rating"), F.lit(None).cast("map<string,string>").alias("attributes"),
        F.lit("x").alias("product_type"), F.array(F.lit(1.0).cast("float")).alias("embedding"),
        F.col("id").alias("seq"),
    )
    ingest.ingest(rows, target, 0, 1)
    current = ingest.current_catalog(ingest.read_log(spark, target))
    assert current.count() == 2001
    assert current.where("id = 'hot'").first()["title"] == "v2997"
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_compact_keeps_the_current_rows(spark):
    target, packed = scratch_root(spark), scratch_root(spark)
    ingest.ingest(spark.createDataFrame([row("a", "old"), *bad_rows()], SCHEMA), target, 1, 2)
    ingest.ingest(spark.createDataFrame([row("a", "new"), row("b")], SCHEMA), target, 2, 2)
    ingest.compact(ingest.read_log(spark, target), packed)
    log = ingest.read_log(spark, packed)
    assert log.count() == 2
    assert {r["id"]: r["title"] for r in ingest.current_catalog(log).collect()} == {"a": "new", "b": "t"}


def jobs_of(spark, work):
    group = scratch_root(spark)
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_stats_cost_no_second_job(spark):
    rows = spark.createDataFrame([row("a"), row("b"), *bad_rows()], SCHEMA)
    for batch, wanted in ((rows, (7, 2, 5)), (rows.limit(0), (0, 0, 0)), (rows.where("false"), (0, 0, 0))):
        target = scratch_root(spark)
        batch = batch.repartition(2)
        stats, jobs = jobs_of(spark, lambda: ingest.ingest(batch, target, 1, 2))  # noqa: B023
        plain, alone = jobs_of(spark, lambda: batch.write.parquet(scratch_root(spark)))  # noqa: B023
        assert jobs <= alone
        assert tuple(stats.first()) == wanted


def test_facts_of_the_packed_catalog_need_no_pass(spark):
    target, packed = scratch_root(spark), scratch_root(spark)
    ingest.ingest(spark.createDataFrame([row("a"), row("a", seq=2), row("b", vector=(3.0, 1.0)), *bad_rows()], SCHEMA), target, 1, 2)
    facts = ingest.compact(ingest.read_log(spark, target), packed)
    assert tuple(facts.first()) == (2, 0, 2, 2)
    docs = ingest.read_log(spark, packed)
    assert ingest.verify_ingest(docs, 2, facts=facts).collect() == ingest.verify_ingest(docs, 2).collect()
    assert ingest.verify_ingest(docs, 2, facts=facts).first()["ok"]
    empty = ingest.compact(docs.where("false"), scratch_root(spark))
    assert tuple(empty.first()) == (0, 0, None, None)


def test_verify(spark):
    docs = spark.createDataFrame([row(f"p{i}", vector=(i + 1.0, 1.0)) for i in range(5)], SCHEMA)
    good = ingest.verify_ingest(docs, 5).first()
    assert good["ok"] and good["self_score"] == 1.0 and good["min_dim"] == 2
    assert not ingest.verify_ingest(docs, 6).first()["ok"]
    assert ingest.verify_ingest(docs).first()["ok"]


def test_stream_equals_batch(spark):
    folder, checkpoint = scratch_root(spark), scratch_root(spark)
    streamed, batched = scratch_root(spark), scratch_root(spark)
    for n in range(3):
        part = spark.createDataFrame(
            [row("a", f"v{n}", seq=n), row(f"only{n}", seq=n), row(f"bad{n}", vector=None, seq=n)], SCHEMA
        )
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    for _ in range(2):  # the second start finds nothing new
        start_ingest(stream, streamed, 2, checkpoint).awaitTermination()
    ingest.ingest(spark.read.schema(SCHEMA).parquet(folder), batched, 0, 2)
    logs = [ingest.read_log(spark, t) for t in (streamed, batched)]
    assert logs[0].select("batch").distinct().count() == 3
    assert [ingest.ingest_stats(log).first() for log in logs][0] == ingest.ingest_stats(logs[1]).first()
    ids = [{r["id"] for r in ingest.current_catalog(log).collect()} for log in logs]
    assert ids[0] == ids[1] == {"a", "only0", "only1", "only2"}
