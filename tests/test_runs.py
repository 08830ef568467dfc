from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from planted import topic_corpus
from topicloom.config import TopicConfig
from topicloom.operators.corpus import from_raw
from topicloom.plans import runs
from topicloom.sources import tables as ta

CONFIG = TopicConfig(
    categories=("a", "b", "c"), max_results=300, min_year=2018, lda_topics=(2, 3), lda_passes=5, nmf_topics=(2, 3), nmf_max_iter=20,
    cluster_topics=(2, 3), reduced_dims=2, min_topic_size=10, min_category_count=5,
)


@pytest.fixture(scope="module")
def papers(spark):
    rows = [
        (f"http://x/{i}", " ".join(tokens), datetime(2019 + i % 3, 1, 1), ["abc"[t]], "abc"[t])
        for i, tokens, t in topic_corpus(k=3, docs=60)
    ]
    return spark.createDataFrame(
        rows, "id string, abstract string, published timestamp, categories array<string>, primary_category string"
    )


def test_whole_run(spark, papers, tmp_path):
    base = str(tmp_path / "run")
    out = runs.run_all(spark, papers, base, CONFIG)
    methods = {r["method"]: r["accuracy"] for r in out["method_rows"].collect()}
    assert set(methods) >= {"lda", "nmf"} and methods["nmf"] >= 0.9
    assert out["best_method"].first()["accuracy"] == max(methods.values())
    assert out["nmf.sweep"].where("is_optimal").first()["k"] == 3
    words = ta.read_topic_words_json(spark, f"{base}/models/nmf/topic_words_json")
    assert words.count() == out["nmf.topic_words"].count()
    report = runs.run_report(out["processed"], out["nmf.document_topics"], out["nmf.topic_words"], 3, "nmf", CONFIG, out["nmf.sweep"])
    assert report["run_summary"].first()["optimal_topics"] == 3
    assert report["topic_trend"].count() == 9

    assert out["report.topic_trend"].count() == 9
    stored = ta.load_results(spark, f"{base}/report", ["overall", "topic_summary", "confusion", "gone"])
    assert set(stored) == {"overall", "topic_summary", "confusion"} and stored["overall"].count() == 1


def _written(base, name):
    return sorted((f.name, f.stat().st_mtime_ns) for f in (base / name).glob("part-*"))


def test_stages_follow_their_settings_and_inputs(spark, papers, tmp_path, monkeypatch):
    source = str(tmp_path / "papers")
    papers.write.parquet(source)
    base, names = tmp_path / "f", ("processed", "vocabulary", "features", "vocabulary_bow", "bow")
    read = spark.read.parquet(source)
    first = runs.run_features(read, str(base), CONFIG)
    before = {n: _written(base, n) for n in names}

    def never(*_, **__):
        raise AssertionError("built again")

    with monkeypatch.context() as m:
        m.setattr(runs, "build_features", never)
        m.setattr(runs, "preprocess_abstracts", never)
        again = runs.run_features(spark.read.parquet(source), str(base), CONFIG)
    assert {n: _written(base, n) for n in names} == before
    assert again["vocabulary"].collect() == first["vocabulary"].collect()

    grams = replace(CONFIG, ngram_range=(2, 2), min_df=3)
    changed = runs.run_features(read, str(base), grams)
    assert _written(base, "processed") == before["processed"] and _written(base, "vocabulary") != before["vocabulary"]
    assert all(" " in r["term"] and r["df"] >= 3 for r in changed["vocabulary"].collect())

    papers.limit(90).write.mode("overwrite").parquet(source)
    assert runs.run_features(spark.read.parquet(source), str(base), CONFIG)["processed"].count() == 90


def test_a_stage_that_broke_off_is_built_again(spark, tmp_path):
    path = str(tmp_path / "s")
    ta.stage(spark, path, lambda: spark.range(3), "a")

    def broken():
        raise ValueError("lost")

    with pytest.raises(ValueError):
        ta.stage(spark, path, broken, "b")
    assert ta.read_manifest(spark, path) is None
    assert ta.stage(spark, path, lambda: spark.range(5), "a").count() == 5
    empty = ta.stage(spark, str(tmp_path / "e"), lambda: spark.range(0), "a")
    assert empty.columns == ta.stage(spark, str(tmp_path / "e"), broken, "a").columns


def test_word_pairs_reach_every_method(spark, papers, tmp_path):
    """With pairs as terms the sweep scores pairs, and the hashed vectors come from pairs."""
    config = replace(CONFIG, ngram_range=(2, 2), min_df=2, lda_passes=2)
    features = runs.run_features(papers, str(tmp_path / "f"), config)
    found = runs.run_lda(features, str(tmp_path / "lda"), config)
    assert all(r["score"] != 0.0 for r in found["sweep"].collect())
    runs.run_clusters(features, str(tmp_path / "c"), config)
    vectors = ta.load_table(spark, str(tmp_path / "c" / "embeddings")).collect()
    assert any(any(r["embedding"]) for r in vectors)


def test_raw_papers(spark):
    rows = [("1", "cs.AI, cs.LG,", None), ("2", None, "x"), ("3", "", ""), ("4", "cs.CV", "cs.RO")]
    raw = spark.createDataFrame(rows, "id string, categories string, primary_category string")
    got = {r["id"]: (r["categories"], r["primary_category"]) for r in from_raw(raw).collect()}
    assert got == {"1": (["cs.AI", "cs.LG"], "cs.AI"), "2": ([], "x"), "3": ([], None), "4": (["cs.CV"], "cs.RO")}
    lists = spark.createDataFrame([("1", ["a", "b"])], "id string, categories array<string>")
    assert from_raw(lists).first()["primary_category"] == "a"


def test_one_failing_method_does_not_stop_the_others(spark, papers, tmp_path):
    features = runs.run_features(papers, str(tmp_path / "f"), CONFIG)
    found = runs.run_methods(features, str(tmp_path / "m"), CONFIG, methods=("unknown", "nmf"), find_optimal=False)
    assert isinstance(found["unknown"], KeyError) and found["nmf"]["document_topics"].count() == 180


def test_clusters_merge_down_without_a_sweep(spark, papers, tmp_path):
    features = runs.run_features(papers, str(tmp_path / "f"), CONFIG)
    label = F.ascii("primary_category") - 97
    vectors = papers.select(
        "id", F.array(*[F.when(label == i, 10.0).otherwise(0.0) + (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100)) / 400) for i in range(3)]).alias("embedding")
    )
    config = TopicConfig(cluster_topics=(2,), reduced_dims=2)
    found = runs.run_clusters(features, str(tmp_path / "c"), config, find_optimal=False, embeddings=vectors)
    assert found["detected"].first()["k_detected"] == 2
    assert found["topic_words"].select("topic_id").distinct().count() == 2


def test_csv_and_json_round_trips(spark, tmp_path):
    rows = [("1", 'say "hi", then\nleave', "null", ""), ("2", "tab\tand, comma", "NA", None)]
    df = spark.createDataFrame(rows, "id string, a string, b string, c string")
    back = ta.read_csv(spark, ta.write_csv(df, str(tmp_path / "c")), df.schema)
    assert [r["a"] for r in back.orderBy("id").collect()] == [r[1] for r in rows]
    assert [r["b"] for r in back.orderBy("id").collect()] == ["null", "NA"]
    again = ta.read_json(spark, ta.write_json(df, str(tmp_path / "j")), df.schema)
    assert again.orderBy("id").collect() == df.orderBy("id").collect()


def test_topic_words_with_quotes_survive_json(spark, tmp_path):
    words = spark.createDataFrame(
        [(10, 1, 'q"uote', 0.5), (10, 2, "b", 0.25), (2, 1, "é", 0.75)], "topic_id int, rank int, word string, weight double"
    )
    back = ta.read_topic_words_json(spark, ta.write_topic_words_json(words, str(tmp_path / "w")))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, words.collect()))


def test_missing_results_are_left_out(spark, tmp_path):
    ta.save_table(spark.range(3), str(tmp_path / "there"))
    assert set(ta.load_results(spark, str(tmp_path), ["there", "gone"])) == {"there"}
    assert not ta.is_complete(spark, str(tmp_path / "gone"))
