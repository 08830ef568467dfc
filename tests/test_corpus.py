import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from topicloom.operators import corpus as co
from topicloom.runtime import lookup_join, number_rows, salted_join, top_per_group

SCHEMA = "id string, published timestamp, categories array<string>"


def make_papers(n=400, seed=1, hot=0.5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        cats = ["a"] if rng.random() < hot else rng.sample(["a", "b", "c", "d"], rng.randint(1, 3))
        rows.append((f"http://x/{i:04d}", datetime(2015, 1, 1) + timedelta(days=rng.randint(0, 3000)), cats))
    return rows


def one_page_per_category(rows, categories, max_results, min_year, page_limit):
    """The collector, one category after another."""
    share = max_results // len(categories)
    taken = {}
    for c in categories:
        page = min(2 * share, max_results - len(taken), page_limit)
        if page <= 0:
            break
        newest = sorted((r for r in rows if c in r[2]), key=lambda r: (-r[1].timestamp(), r[0]))[:page]
        for r in newest:
            if r[0] not in taken and r[1].year >= min_year:
                taken[r[0]] = c
    return taken


def test_assemble_corpus(spark):
    rows = make_papers()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for max_results, min_year in ((60, 2016), (200, 2019), (7, 2015), (2, 2015)):
        want = one_page_per_category(rows, ["a", "b", "c", "d"], max_results, min_year, 2000)
        got = co.assemble_corpus(df, ["a", "b", "c", "d"], max_results, min_year).collect()
        assert {r["id"]: r["collected_for"] for r in got} == want
        assert all(r["year"] == r["published"].year for r in got)


def test_old_papers_use_up_the_quota(spark):
    rows = [("1", datetime(2020, 1, 1), ["a"]), ("2", datetime(2010, 1, 1), ["a"]), ("3", datetime(2009, 1, 1), ["a"])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r["id"] for r in co.assemble_corpus(df, ["a"], 2, 2009).collect()] == ["1", "2"]
    assert [r["id"] for r in co.assemble_corpus(df, ["a"], 2, 2015).collect()] == ["1"]


def test_keep_first_and_short_id(spark):
    df = spark.createDataFrame([("k", 2, "x"), ("k", 1, "y"), ("m", 5, None)], "id string, place int, v string")
    got = {r["id"]: r["v"] for r in co.keep_first(df, "id", [F.col("place")]).collect()}
    assert got == {"k": "y", "m": None}
    assert df.select(co.short_id(F.lit("http://a/b/1234.5v2"))).first()[0] == "1234.5v2"
    assert co.ensure_categories(df).columns == ["id", "place", "v", "categories", "primary_category"]


def test_top_per_group_with_a_hot_group(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 10)).alias("g"))
    got = top_per_group(df, ["g"], [F.desc("id")], 100, spread="id")
    best = {}
    for r in df.collect():
        best.setdefault(r["g"], []).append(r["id"])
    want = {(g, i + 1, x) for g, xs in best.items() for i, x in enumerate(sorted(xs, reverse=True)[:100])}
    assert {(r["g"], r["rank"], r["id"]) for r in got.collect()} == want


def test_lookups_agree_beyond_the_broadcast_bound(spark):
    facts = spark.range(3000).select("id", (F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7)).alias("k"))
    lookup = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k long, name string")
    for how in ("left", "inner"):
        small = lookup_join(facts, lookup, "k", how).collect()
        large = lookup_join(facts, lookup, "k", how, broadcast_rows=2).collect()
        assert sorted(map(str, small)) == sorted(map(str, large))
        assert sorted(map(str, salted_join(facts, lookup, ["k"], how).collect())) == sorted(map(str, small))


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    assert all(r["v"] == r["n"] for r in number_rows(df, [F.asc("v")], "n").collect())


def test_unlisted_categories_never_win(spark):
    listed = spark.createDataFrame([("a", "zzz"), ("a", "x"), ("b", "zzz"), ("c", None)], "id string, category string")
    assert [tuple(r) for r in co.first_category(listed, ["x", "y"]).collect()] == [("a", "x")]


def test_repeated_ids_are_collected_once(spark):
    rows = [("a", "2020-01-01", "old"), ("a", "2021-01-01", "new"), ("b", "2020-06-01", "b"), ("c", "2019-01-01", "c")]
    papers = spark.createDataFrame(rows, "id string, day string, note string").selectExpr(
        "id", "to_timestamp(day) AS published", "note", "array('x') AS categories"
    )
    got = co.assemble_corpus(papers, ["x"], max_results=2, min_year=2018)
    assert sorted((r.id, r.note) for r in got.collect()) == [("a", "new"), ("b", "b")]
