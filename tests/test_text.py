import re

import pytest
from pyspark.sql import functions as F

from topicloom.functions import text
from topicloom.functions.arrays import argmax, ngrams, one_hot, row_normalise, run_lengths
from topicloom.operators.normalise import build_lemma_table, lemmatize_with, preprocess_abstracts
from topicloom.streaming.text_stream import preprocess_stream

TEXTS = [
    None,
    "",
    "   ",
    "See http://a.b/c?d=e&f today, www.x.org/y and https://z.",
    "xhttps://glued tail",
    "Mail me@example.org now a@b c @ d",
    "Deep LEARNING Models, analyses of mice!",
    "Café naïve résumé",
    "non breaking spaces\tand\nlines me you@x.org",
    "x" * 30 + " " + "y" * 31 + " zz z",
    "the and of is",
    "cannot gonna wannabe wanna 2023 gpt4 4gpt ab12",
    "null nan NA",
]


def python_clean(t):
    t = (t or "").lower()
    t = re.sub(r"http\S+|www\S+|https\S+", "", t)
    t = re.sub(r"\S+@\S+", "", t)
    t = re.sub(r"[^a-zA-Z0-9\s]", " ", t)
    return re.sub(r"\s+", " ", t).strip()


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id long, abstract string")


def test_clean_text_equals_the_steps_and_python(spark):
    steps = text.squeeze_spaces(text.drop_symbols(text.drop_emails(text.drop_urls(F.lower(text.fill_missing("abstract"))))))
    rows = docs(spark).select("id", text.clean_text("abstract").alias("one"), steps.alias("steps")).collect()
    for r in rows:
        assert r["one"] == r["steps"] == python_clean(TEXTS[r["id"]])


def test_unicode_letters_are_kept_on_request(spark):
    row = docs(spark, ["Café naïve!"]).select(text.clean_text("abstract", unicode=True).alias("t")).first()
    assert row["t"] == "café naïve"


def test_tokens(spark):
    cleaned = text.tokenize(text.clean_text("abstract"))
    rows = {r["id"]: r["t"] for r in docs(spark).select("id", cleaned.alias("t")).collect()}
    assert rows[0] == rows[1] == rows[2] == []
    assert rows[11][:6] == ["can", "not", "gon", "na", "wannabe", "wan"]


def test_lemma_comes_before_the_stopword_filter(spark):
    tokens = docs(spark, ["models proposals networks"]).select(text.preprocess_tokens("abstract").alias("t")).first()["t"]
    # models -> model and proposals -> proposal are stopwords only after lemmatising
    assert tokens == ["network"]


def test_filter_rules(spark):
    rows = {r["id"]: r["t"] for r in docs(spark).select("id", text.preprocess_tokens("abstract").alias("t")).collect()}
    assert rows[9] == ["x" * 30, "zz"]
    assert rows[10] == []
    assert "gpt4" not in rows[11] and "ab12" not in rows[11]
    assert rows[6] == ["deep", "analysis", "mouse"]


def test_empty_documents_are_dropped_once(spark):
    out = preprocess_abstracts(docs(spark))
    assert {r["id"] for r in out.collect()}.isdisjoint({0, 1, 2, 10})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 4, "the tokens must be computed once"


def test_lemma_table(spark):
    terms = spark.createDataFrame([(t,) for t in ("boxes", "box", "men", "man", "gas", "skies", "sky", "data")], "term string")
    nouns = spark.createDataFrame([(t,) for t in ("box", "man", "gas", "sky")], "noun string")
    exceptions = spark.createDataFrame([("data", "datum"), ("absent", "x")], "token string, lemma string")
    found = {r["token"]: r["lemma"] for r in build_lemma_table(terms, nouns, exceptions).collect()}
    assert found == {"boxes": "box", "men": "man", "skies": "sky", "data": "datum"}


def test_lemma_join_keeps_order_with_and_without_broadcast(spark):
    rows = [(1, ["b", "a", "b", "c"]), (2, []), (3, ["c", "c"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    table = spark.createDataFrame([("b", "B"), ("c", "C")], "token string, lemma string")
    for bound in (100, 0):
        out = {r["id"]: r["tokens"] for r in lemmatize_with(df, table, broadcast_rows=bound).collect()}
        assert out == {1: ["B", "a", "B", "C"], 2: [], 3: ["C", "C"]}


def test_array_expressions(spark):
    df = spark.createDataFrame([(["b", "a", "b"], [0.2, 0.4, 0.4], -1), ([], [0.0, 0.0, 0.0], 1)], "t array<string>, d array<double>, k int")
    first, second = df.select(
        run_lengths("t").alias("r"), ngrams("t", 1, 2).alias("g"), argmax("d").alias("m"),
        one_hot("k", 3).alias("o"), row_normalise("d").alias("n"),
    ).collect()
    assert [tuple(x) for x in first["r"]] == [("a", 1), ("b", 2)] and second["r"] == []
    assert first["g"] == ["b", "a", "b", "b a", "a b"] and second["g"] == []
    assert first["m"] == 1 and second["m"] == 0
    assert first["o"] == [0.0, 0.0, 0.0] and second["o"] == [0.0, 1.0, 0.0]
    assert second["n"] == [0.0, 0.0, 0.0]


def test_stream_gives_the_same_tokens(spark, tmp_path):
    source = str(tmp_path / "in")
    docs(spark).write.parquet(source)
    stream = preprocess_stream(spark.readStream.schema("id long, abstract string").parquet(source))
    job = stream.writeStream.format("memory").queryName("stream_tokens").option("checkpointLocation", str(tmp_path / "c")).start()
    job.processAllAvailable()
    job.stop()
    got = {r["id"]: r["tokens"] for r in spark.table("stream_tokens").collect()}
    assert got == {r["id"]: r["tokens"] for r in preprocess_abstracts(docs(spark)).collect()}


def test_nouns_that_only_look_plural(spark):
    want = {
        "bias": "bias", "biases": "bias", "series": "series", "lens": "lens", "canvas": "canvas", "news": "news",
        "caches": "cache", "mathematics": "mathematics", "models": "model", "studies": "study",
    }
    rows = spark.createDataFrame([(list(want),)], "tokens array<string>")
    from topicloom.functions.text import lemmatize

    assert rows.select(lemmatize("tokens")).first()[0] == list(want.values())


def test_the_noun_rule_on_words_it_has_no_entry_for(spark):
    want = {
        "viruses": "virus", "statuses": "status", "choruses": "chorus", "causes": "cause", "houses": "house", "excuses": "excuse",
        "thermodynamics": "thermodynamics", "biophysics": "biophysics", "proteomics": "proteomics", "biostatistics": "biostatistics",
        "whereas": "whereas", "always": "always", "perhaps": "perhaps", "pancreas": "pancreas", "ideas": "idea", "areas": "area",
        "videos": "video", "topics": "topic", "metrics": "metric", "boxes": "box",
    }
    rows = spark.createDataFrame([(list(want),)], "tokens array<string>")
    from topicloom.functions.text import lemmatize

    assert rows.select(lemmatize("tokens")).first()[0] == list(want.values())


@pytest.mark.parametrize("bound", [100, 0])
def test_lemma_table_keeps_rows_of_any_id(spark, bound):
    rows = [(1, ["cats", "dogs"], "x"), (1, ["dogs"], "y"), (None, ["cats"], "z"), (2, None, ""), (3, [], ""), (4, ["a", None, "cats"], "")]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, lemma string").repartition(3)
    table = spark.createDataFrame([("cats", "cat"), ("cats", "cut"), ("dogs", "dog"), (None, "x")], "token string, lemma string")
    got = sorted(map(repr, (tuple(r) for r in lemmatize_with(df, table, broadcast_rows=bound).collect())))
    want = [(1, ["cat", "dog"], "x"), (1, ["dog"], "y"), (None, ["cat"], "z"), (2, None, ""), (3, [], ""), (4, ["a", None, "cat"], "")]
    assert got == sorted(map(repr, want))
    assert lemmatize_with(df.limit(0), table, broadcast_rows=bound).count() == 0


def test_lemma_table_moves_no_text(spark):
    df = spark.createDataFrame([(1, ["cats"])], "id long, tokens array<string>")
    table = spark.createDataFrame([("cats", "cat")], "token string, lemma string")
    assert "Exchange" not in lemmatize_with(df, table)._jdf.queryExecution().executedPlan().toString()


def test_words_are_split_where_they_are_cleaned(spark):
    """Preparing a text in one go gives the tokens of its single steps, and splits it without writing a cleaned copy."""
    texts = [
        "", None, "...", " --Cells, cells; GENES!! ", "cannot stop: the cannots gotta go", "we saw a2b and 42 x9s, http://cannot.org",
        "mail me@cannot.org now", "Été naïve İstanbul", "tab\tand\nline", "gonna-wanna (lemme)",
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, t string")
    for unicode in (False, True):
        steps = text.filter_tokens(text.lemmatize(text.tokenize(text.clean_text("t", unicode))))
        whole = df.select("id", text.preprocess_tokens("t", unicode=unicode).alias("got"), steps.alias("want"))
        assert all(r["got"] == r["want"] for r in whole.collect())
    plan = df.select(text.preprocess_tokens("t"))._jdf.queryExecution().analyzed().toString()
    assert r"\P{Alnum}+, -1)" in plan and "translate(" not in plan
