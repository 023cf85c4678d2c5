"""Analyser, stemmer, postings and filters."""

import pytest
from pyspark.sql import functions as F

from sparkrank.functions import text
from sparkrank.functions.porter2 import stem_word
from sparkrank.operators import index as indexing
from sparkrank.sources.scratch import scratch_root

# Published stems of the English algorithm.
STEMS = dict(
    pair.split("=") for pair in (
        "consign=consign consigned=consign consigning=consign consignment=consign consist=consist "
        "consisted=consist consistency=consist consistent=consist consistently=consist consisting=consist "
        "consists=consist consolation=consol consolations=consol consolatory=consolatori console=consol "
        "consoled=consol consoles=consol consolidate=consolid consolidated=consolid consoling=consol "
        "consolingly=consol consols=consol consonant=conson consort=consort consorted=consort "
        "conspicuous=conspicu conspicuously=conspicu conspiracy=conspiraci conspirator=conspir "
        "conspirators=conspir conspire=conspir conspired=conspir conspiring=conspir constable=constabl "
        "constables=constabl constance=constanc constancy=constanc constant=constant "
        "knack=knack knackeries=knackeri knacks=knack knag=knag knave=knave knaves=knave knavish=knavish "
        "kneaded=knead kneading=knead knee=knee kneel=kneel kneeled=kneel kneeling=kneel kneels=kneel "
        "knees=knee knell=knell knelt=knelt knew=knew knick=knick knif=knif knife=knife knight=knight "
        "knightly=knight knights=knight knit=knit knits=knit knitted=knit knitting=knit knives=knive "
        "knob=knob knobs=knob knock=knock knocked=knock knocker=knocker knockers=knocker knocking=knock "
        "knocks=knock knopp=knopp knot=knot knots=knot skis=ski dying=die news=news exceed=exceed "
        "generate=generat generic=generic communism=communism arsenal=arsenal hopping=hop hoping=hope "
        "luxuriated=luxuri cries=cri ties=tie gas=gas gaps=gap kiwis=kiwi cry=cri by=by say=say "
        "rational=ration activity=activ sensibility=sensibl apology=apolog happiness=happi "
        "controlling=control agreed=agre feed=feed running=run shoes=shoe youth=youth boyish=boyish"
    ).split()
)


@pytest.mark.parametrize("word", sorted(STEMS))
def test_published_stems(word):
    assert stem_word(word) == STEMS[word]


def test_possessives():
    assert [stem_word(w) for w in ("dog's", "dogs'", "'quoted", "levi’s")] == ["dog", "dog", "quot", "levi"]


def analysed(spark, value, **kw):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(text.analyze(F.col("t"), **kw).alias("a")).first()["a"]


def test_tokens(spark):
    df = spark.createDataFrame([("Levi's 12.9 inch 99.97% t-shirt",)], "t string")
    got = df.select(text.tokens(F.col("t")).alias("a")).first()["a"]
    assert got == ["levi's", "12.9", "inch", "99.97", "t", "shirt"]


def test_analyser_chain(spark):
    assert analysed(spark, "The RUNNING Shoes of the dog's") == ["run", "shoe", "dog"]
    assert analysed(spark, "The RUNNING Shoes", stem=False) == ["running", "shoes"]
    assert analysed(spark, "the of", stop=[]) == ["the", "of"]
    assert analysed(spark, "") == [] and analysed(spark, None) == [] and analysed(spark, "the of and") == []


def test_stems_in_many_batches(spark):
    words = [w for w in STEMS for _ in range(3)]
    df = spark.createDataFrame([(w,) for w in words], "t string").repartition(3)
    arrays = df.select("t", text.stem_tokens(F.array("t", "t")).alias("s"), text.stem_words("t").alias("w"))
    for r in arrays.collect():
        assert r["s"] == [STEMS[r["t"]]] * 2 and r["w"] == STEMS[r["t"]]


def test_title_case(spark):
    df = spark.createDataFrame([("t-shirt men's 4k tv",)], "t string")
    assert df.select(text.title_case(F.col("t")).alias("a")).first()["a"] == "t-shirt men's 4k tv".title()


DOCS = [
    (1, "red shoe red", "the shoe", "x", 5.0), (2, "", "the of", "x", 7.0), (3, "blue", "", "y", None),
]


def docs(spark):
    return spark.createDataFrame(DOCS, "id int, title string, description string, category string, price double")


def test_index_tables(spark):
    built = indexing.build_index(docs(spark), scratch_root(spark), stem=False)
    rows = {(r["id"], r["field"], r["tok"]): (r["tf"], r["dl"]) for r in built.postings.collect()}
    assert rows == {
        (1, "title", "red"): (2, 3), (1, "title", "shoe"): (1, 3),
        (1, "description", "shoe"): (1, 1), (3, "title", "blue"): (1, 1),
    }
    stats = {r["field"]: (r["n"], r["avgdl"]) for r in built.field_stats.collect()}
    assert stats == {"title": (2, 2.0), "description": (1, 1.0)}


def test_index_opens_again(spark):
    path = scratch_root(spark)
    for _ in range(2):  # a second build replaces the first
        built = indexing.build_index(docs(spark), path, {"title": 3.0, "description": 1.0}, stem=False, stop=["red"], buckets=3)
    again = indexing.open_index(spark, path)
    assert (again.stem, again.stop, again.weights) == (False, ("red",), {"title": 3.0, "description": 1.0})
    assert sorted(again.postings.collect()) == sorted(built.postings.collect())
    plan = again.postings.groupBy("id", "tok").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_filters_and_facets(spark):
    d = docs(spark)
    assert [r["id"] for r in indexing.filter_keyword(d, category="x").collect()] == [1, 2]
    assert [r["id"] for r in indexing.filter_range(d, "price", 5.0, 6.0).collect()] == [1]
    assert [r["id"] for r in indexing.filter_range(d, "price", high=7.0).collect()] == [1, 2]
    facets = {(r["facet"], r["value"]): r["n"] for r in indexing.facet_counts(d, "category", "title").collect()}
    assert facets[("category", "x")] == 2 and facets[("title", "blue")] == 1
    long_title = spark.createDataFrame([(1, "x" * 257), (2, "y" * 256)], "id int, title string")
    assert [r["title_keyword"] for r in indexing.title_keyword(long_title).collect()] == [None, "y" * 256]
    maps = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"a": "1"})], "id int, attributes map<string,string>")
    counts = {(r["attribute"], r["value"]): r["n"] for r in indexing.attribute_facets(maps).collect()}
    assert counts == {("a", "1"): 2, ("b", "2"): 1}
    assert [r["id"] for r in indexing.filter_attribute(maps, "b", "2").collect()] == [1]


def test_filters_reach_the_scan(spark):
    path = scratch_root(spark)
    docs(spark).write.parquet(path)
    found = indexing.filter_range(indexing.filter_keyword(spark.read.parquet(path), category="x"), "price", 6.0)
    plan = found.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(category,x)" in plan and "GreaterThanOrEqual(price,6.0)" in plan
    assert "description" not in plan.split("ReadSchema")[1]
