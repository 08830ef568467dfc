import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from planted import adjusted_rand
from topicloom.config import TopicConfig
from topicloom.operators import alignment as al, comparison as cm, metrics as me, report as re
from topicloom.plans.runs import run_report

# one tie, one empty topic (3), one missing category, one rare predicted label
ROWS = [
    (1, "a", "a, b", 0), (2, "b", "b", 0), (3, "a", "a", 1), (4, "a", "a,c ", 1), (5, "b", "b", 1),
    (6, None, None, 1), (7, "c", "c", 2), (8, "b", "b, a", 4), (9, "a", "", 4), (10, "a", "a", 0),
]
K = 5


@pytest.fixture(scope="module")
def analysis(spark):
    return spark.createDataFrame(ROWS, "id long, primary_category string, categories string, dominant_topic int")


@pytest.fixture(scope="module")
def table(analysis):
    return al.contingency(analysis)


def test_shares_and_purity(table):
    shares = {(r["dominant_topic"], r["category"]): r["share"] for r in al.category_shares(table).collect()}
    assert math.isclose(shares[1, "a"], 2 / 3)  # the missing category is no part of the denominator
    purity = {r["dominant_topic"]: r["purity"] for r in al.topic_purity(table, K).collect()}
    assert purity == {0: 2 / 3, 1: 0.5, 2: 1.0, 3: 0.0, 4: 0.5}  # but it counts for the topic size
    assert math.isclose(al.average_purity(table, K).first()[0], sum(purity.values()) / K)


def test_all_categories(analysis):
    counts = {r["category"]: r["n"] for r in al.all_category_counts(analysis).collect()}
    assert counts == {"a": 5, "b": 4, "c": 2, "": 1}


def test_ties_go_to_the_smaller_category(table):
    predicted = {r["dominant_topic"]: r["predicted_category"] for r in al.predicted_by_topic(table, K).collect()}
    assert predicted == {0: "a", 1: "a", 2: "c", 3: "Unknown", 4: "a"}


def test_topic_accuracy_ends_at_the_last_topic_seen(table):
    predicted = al.predicted_by_topic(table, K + 3)
    rows = {r["topic"]: r for r in me.topic_accuracy(table, predicted).collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4]
    assert rows[1]["correct"] == 2 and rows[1]["total"] == 4 and rows[3]["predicted_category"] == "Unknown"


def brute_scores(pairs):
    """Per-label scores, macro and weighted averages, accuracy."""
    labels = sorted({x for p in pairs for x in p})
    scores = {}
    for c in labels:
        tp = sum(t == p == c for t, p in pairs)
        support, predicted = sum(t == c for t, _ in pairs), sum(p == c for _, p in pairs)
        pr, rc = (tp / predicted if predicted else 0.0), (tp / support if support else 0.0)
        scores[c] = (pr, rc, 2 * pr * rc / (pr + rc) if pr + rc else 0.0, support)
    macro = [sum(s[i] for s in scores.values()) / len(scores) for i in range(3)]
    weighted = [sum(s[i] * s[3] for s in scores.values()) / len(pairs) for i in range(3)]
    return scores, macro, weighted, sum(t == p for t, p in pairs) / len(pairs)


def test_scores_by_brute_force(spark):
    rng = random.Random(5)
    pairs = [(rng.choice("aaabbcd"), rng.choice("aabbbxe")) for _ in range(300)]
    df = spark.createDataFrame(pairs, "primary_category string, predicted_category string")
    counted = me.pairs_of(df)
    scores, macro, weighted, accuracy = brute_scores(pairs)
    got = {r["category"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in me.label_scores(counted).collect()}
    assert set(got) == set(scores)
    for c in scores:
        assert got[c] == pytest.approx(scores[c])
    row = me.overall_scores(counted).first()
    assert [row[f"{c}_macro"] for c in ("precision", "recall", "f1")] == pytest.approx(macro)
    assert [row[f"{c}_weighted"] for c in ("precision", "recall", "f1")] == pytest.approx(weighted)
    assert row["accuracy"] == pytest.approx(accuracy) == me.accuracy(counted).first()[0]


def test_minimum_support_keeps_rare_predictions_in_the_macro_average(spark):
    pairs = [("a", "a")] * 6 + [("b", "z")] * 5 + [("c", "a")]
    counted = me.pairs_of(spark.createDataFrame(pairs, "primary_category string, predicted_category string"))
    found = me.classification(counted, min_support=5)
    _, macro, _, accuracy = brute_scores(pairs[:11])
    row = found["overall"].first()
    assert row["f1_macro"] == pytest.approx(macro[2]) and row["accuracy"] == pytest.approx(accuracy)
    assert {r["category"] for r in found["per_category"].collect()} == {"a", "b"}
    cells = {(r["true_category"], r["predicted_category"]): r["n"] for r in found["confusion"].collect()}
    assert cells == {("a", "a"): 6, ("a", "b"): 0, ("b", "a"): 0, ("b", "b"): 0}  # z is outside
    shares = {(r["true_category"], r["predicted_category"]): r["share"] for r in re.normalised_confusion(found["confusion"]).collect()}
    assert shares["a", "a"] == 1.0 and shares["b", "b"] == 0.0


def test_no_category_reaches_the_support(spark):
    counted = me.pairs_of(spark.createDataFrame([("a", "b")], "primary_category string, predicted_category string"))
    found = me.classification(counted, min_support=50)
    assert found["per_category"].count() == 0 and found["confusion"].count() == 0
    assert found["overall"].first()["accuracy"] is None


def entropy(counts, n):
    return -sum(c / n * math.log(c / n) for c in counts)


@pytest.mark.parametrize("labels", [3, 1])
def test_agreement_by_brute_force(spark, labels):
    rng = random.Random(labels)
    rows = [(i, rng.choice("xyz"[:labels]), rng.randrange(4 if labels > 1 else 1)) for i in range(80)]
    cells = al.contingency(spark.createDataFrame(rows, "id long, primary_category string, dominant_topic int"))
    a, b = [r[1] for r in rows], [r[2] for r in rows]
    assert al.adjusted_rand(cells).first()[0] == pytest.approx(adjusted_rand(a, b))
    h = [entropy(Counter(x).values(), len(rows)) for x in (a, b, list(zip(a, b)))]
    want = 1.0 if h[0] + h[1] == 0 else (h[0] + h[1] - h[2]) / ((h[0] + h[1]) / 2)
    assert al.normalized_mutual_info(cells).first()[0] == pytest.approx(want)


def topic_matrix(spark):
    dist = [(i, [1.0 if j == t else 0.0 for j in range(K)]) for i, _, _, t in ROWS]
    return spark.createDataFrame(dist + [(99, [1.0] * K)], "id long, topic_dist array<double>")


def test_methods_are_compared_and_missing_ones_skipped(spark, analysis):
    docs = analysis.drop("dominant_topic")
    config = TopicConfig(min_category_count=1)
    good, poor = topic_matrix(spark), topic_matrix(spark).withColumn("topic_dist", F.array(*[F.lit(1.0)] * K))
    rows = cm.compare_methods(docs, {"poor": (poor, K), "none": None, "good": (good, K), "same": (good, K)}, config)
    assert cm.best_method(rows).first()["method"] == "good"
    assert [r["method"] for r in cm.method_rows(rows).collect()] == ["poor", "good", "same"]
    with pytest.raises(ValueError):
        cm.compare_methods(docs, {"none": None})


def test_report_tables(spark, analysis):
    docs = analysis.drop("dominant_topic").withColumn("year", (2018 + F.col("id") % 2).cast("int"))
    words = spark.createDataFrame([(0, 1, "w", 0.5), (0, 2, "v", 0.25)], "topic_id int, rank int, word string, weight double")
    found = run_report(docs, topic_matrix(spark), words, K, config=TopicConfig(min_category_count=1))
    assert found["top_words"].first()["words"] == "w (0.500), v (0.250)"
    trend = found["topic_trend"].collect()
    for year in (2018, 2019):
        assert sum(r["share"] for r in trend if r["year"] == year) == pytest.approx(1.0)
    summary = {r["dominant_topic"]: r["top_list"] for r in found["topic_summary"].collect()}
    assert summary[0] == "a(66.7%), b(33.3%)" and 3 not in summary
    with pytest.raises(KeyError):
        re.topic_trend(analysis)


def test_repeatable_sample(spark):
    df = spark.range(2000)
    first = [r["id"] for r in re.repeatable_sample(df, 100).collect()]
    assert first == [r["id"] for r in re.repeatable_sample(df.repartition(7), 100).collect()] == sorted(first)
    assert first != [r["id"] for r in re.repeatable_sample(df, 100, seed=1).collect()]
