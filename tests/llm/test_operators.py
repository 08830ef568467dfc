"""The operators against brute force, exact round trips, planted cases and held-out labels."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_samples import SMALL
from oracle import connect, differences
from topicloom.llm import katz, labelled, licences, near_duplicates, nearest, quality_rules, url_trust
from topicloom.llm import queries as q
from topicloom.llm.common import table


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("how", [near_duplicates.NearDuplicates(), near_duplicates.FIVE_WORDS])
def test_near_duplicates(spark, texts, how):
    base = [t for t in texts.values() if len(words(t)) > 120][:3]
    planted = dict(texts)
    for i in range(40):  # near copies in a chain: each drops some more words at the end
        w = base[i % 3].split()
        planted[100_000 + i] = " ".join(w[: len(w) - (i // 3) * max(1, len(w) // 30)])
    sets = {i: shingles(t, how.width) for i, t in planted.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= how.percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(list(planted.items()), "doc_id bigint, text string")
    for r in near_duplicates.near_duplicates(docs, how).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_large_buckets_are_dealt_again(spark):
    """Texts of one template that aren't linked with each other, but for some planted pairs, in buckets above the block."""
    chance = np.random.default_rng(11)
    rows = {}
    for i in range(240):
        own = [f"own{i}x{j}" for j in range(30)]
        base = [f"base{j}" for j in range(70)]
        at = np.sort(chance.choice(70, 30, replace=False)) if i % 2 else np.arange(40, 70)
        rows[i] = base[: at[0]] + own[:15] + base[at[0] :] + own[15:]
        if i % 12 == 0:
            rows[1000 + i] = [*rows[i][:-1], "other"]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], "doc_id bigint, text string")
    sets = {i: shingles(" ".join(w), 3) for i, w in rows.items()}
    how = near_duplicates.NearDuplicates(whole=8)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, how).collect()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in sets}
    assert sum(find(i) != i for i in sets) >= 20


def test_no_link_depends_on_the_size_of_a_bucket(spark):
    """Dealing large buckets again may part any pair; the links are those of whole buckets."""
    base = [f"base{j}" for j in range(88)]
    rows = {}
    for i in range(60):  # 86 shared shingles of 110; 95 of 101 in a planted pair
        rows[i] = [*base, *(f"own{i}x{j}" for j in range(12))]
        if i % 5 == 0:
            rows[1000 + i] = [*rows[i][:-3], *(f"other{i}x{j}" for j in range(3))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], "doc_id bigint, text string")
    for whole in (4, 4096):
        how = near_duplicates.NearDuplicates(bands=4, rows=1, whole=whole, again=1, again_rows=40)
        got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, how).collect()}
        assert got == {i: i % 1000 for i in rows}


def test_repeated_ids_join_what_their_texts_are_linked_with(spark):
    one, two = (" ".join(f"{w}{j}" for j in range(20)) for w in ("one", "two"))
    docs = spark.createDataFrame([(3, one), (5, one), (5, two), (9, two), (9, None), (11, "three")], "doc_id bigint, text string")
    rows = near_duplicates.near_duplicates(docs).collect()
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows}
    assert got == {(3, 18): (3, True), (5, 18): (3, False), (9, 18): (3, False), (9, 0): (9, True), (11, 1): (11, True)}


def test_dealing_again_is_linear(spark):
    """A bucket dealt again holds a fixed number of copies a member, whatever its size."""
    how = near_duplicates.NearDuplicates()
    for n in (300, 1200):
        texts = spark.createDataFrame(
            [(i, " ".join([f"base{j}" for j in range(40)] + [f"own{i}x{j}" for j in range(20)])) for i in range(n)],
            "doc_id bigint, text string",
        )
        members = texts.select(F.lit(7).cast("long").alias("band"), F.col("doc_id").alias("rep"))
        dealt = near_duplicates.dealt_again(members, texts, how, 0)
        assert dealt.count() <= how.again * n
        assert dealt.groupBy("band").count().agg(F.max("count")).first()[0] < 0.8 * n


def test_sketches_estimate_similarity():
    how = near_duplicates.NearDuplicates()
    chance = np.random.default_rng(3)
    common, counts = chance.integers(0, 2**63, 900, dtype=np.uint64), []
    for own in (0, 25, 50, 75, 100):
        sets = [np.unique(np.concatenate([common, chance.integers(0, 2**63, own, dtype=np.uint64)])) for _ in range(2)]
        sketch = near_duplicates.odd_sketches(near_duplicates.min_hashes(sets, how.samples), how.bits).view(np.uint64)
        counts.append(int(np.bitwise_count(sketch[0] ^ sketch[1]).sum()))
        if 900 / (900 + 2 * own) >= 0.85:
            assert counts[-1] <= how.most_bits()
    assert counts[0] == 0 and counts == sorted(counts)


def test_katz(spark, texts):
    rows = q.op2_katz_backoff(spark, SMALL).collect()
    docs = {d: [*words(t), "end"] for d, t in texts.items()}
    learn = [d for d in docs if zlib.crc32(str(d).encode()) % 5 != 1]
    c = Counter(w for d in learn for w in docs[d])
    pairs = Counter(x for d in learn for x in zip(["start", *docs[d][:-1]], docs[d]))
    total, kinds = sum(c.values()), len(c)
    low, high = katz.discounts(Counter(c.values()), 5), katz.discounts(Counter(pairs.values()), 5)
    cut = lambda n, d: n * d[n - 1] if n <= 5 else n
    unknown = 1 - sum(cut(n, low) for n in c.values()) / total
    p1 = lambda w: cut(c[w], low) / total if c[w] else unknown
    after, mass, below = Counter(), defaultdict(float), defaultdict(float)
    for (h, w), n in pairs.items():
        after[h] += n
        mass[h] += cut(n, high)
        below[h] += p1(w)

    def p2(h, w):
        if h not in after:
            return p1(w)
        keep = 1 if 1 - mass[h] / after[h] > 1e-12 else after[h] / (after[h] + 1)
        if (h, w) in pairs:
            return keep * cut(pairs[h, w], high) / after[h]
        return (1 - keep * mass[h] / after[h]) / (1 - below[h]) * p1(w)

    for h in ("start", *list(after)[:50]):
        assert math.isclose(sum(p2(h, w) for w in c) + p2(h, "unseen"), 1, abs_tol=1e-9)
    for r in rows:
        d = docs[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(d), sum(c[w] > 0 for w in d), total)
        assert math.isclose(r.score, sum(math.log10(p2(h, w)) for h, w in zip(["start", *d[:-1]], d)), rel_tol=1e-9)
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in d)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)


def test_katz_asks_for_the_counts_of_many_pairs_at_once(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    chunks = katz._chunks(docs.withColumn("learn", F.lit(True)))
    asks = katz._asks(chunks, 24, True)
    # a row for each chunk and part, where a row for each pair of a document took several times the input
    assert asks.count() <= 3 * 24
    tokens = sum(len(words(t)) + 1 for t in texts.values())
    assert asks.agg(F.sum(F.octet_length("keys"))).first()[0] < 8 * tokens
    values = np.array([0, 5, 2**40, 2**64 - 1], np.uint64)
    assert katz.unpacked(katz.packed(values), 4).tolist() == values.tolist()


def test_katz_scores_by_a_stored_model(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    model = katz.train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 1).select("text"))
    assert model.tokens == katz.fold_scores(docs).first()["train_tokens"]
    found = {r.doc_id: r for r in katz.score(docs, model).collect()}
    for r in katz.fold_scores(docs).collect():
        same = found[r.doc_id]
        assert (same.n_tokens, same.n_known) == (r.n_tokens, r.n_known)
        assert math.isclose(same.score, r.score, rel_tol=1e-9) and math.isclose(same.base_score, r.base_score, rel_tol=1e-9)


def test_quality_rules_match_sql(spark):
    name = "op7_quality_rules"
    assert differences(spark, connect(SMALL), q.QUERIES[name], q.ORACLES[name], SMALL) == []


def test_binomial_tail(spark):
    for k, n, p in [(0, 10, 0.1), (3, 50, 0.1), (0, 50, 0.02), (20, 400, 0.08), (19, 1000, 0.02), (5, 1000, 0.02)]:
        got = spark.range(1).select(quality_rules.lower_tail(F.lit(k), F.lit(n), p)).first()[0]
        assert math.isclose(got, sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), rel_tol=1e-9)


def test_binomial_tail_of_many_labels(spark):
    """Against a plain sum of the 40,000 largest terms, each by log-gamma."""
    n, p = 250_000_000, 0.02
    sd = math.sqrt(n * p * (1 - p))
    for z in (-6.0, -2.0, -0.5):
        k = math.floor(n * p + z * sd)
        ways = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
        want = math.fsum(math.exp(ways(i) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k - 40_000, k + 1))
        got = spark.range(1).select(quality_rules.lower_tail(F.lit(k), F.lit(n), p)).first()[0]
        assert math.isclose(got, want, rel_tol=1e-5)


def test_cutoffs_bound_false_rejection(spark):
    """300 good documents with few symbols and 100 bad ones with many; too few good ones certify nothing."""
    good = [(i, "en", 100, 500, i % 5, 0, 0, False) for i in range(300)]
    bad = [(1000 + i, "en", 100, 500, 150, 0, 0, False) for i in range(100)]
    few = [(2000 + i, "xx", 100, 500, 150 * (i % 2), 0, 0, False) for i in range(40)]
    names = "doc_id bigint, stratum string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean"
    stats = spark.createDataFrame(good + bad + few, names)
    labels = stats.select("doc_id", (F.col("n_symbols") < 100).cast("int").alias("quality"))
    cutoffs = {r.stratum: r.cutoffs for r in quality_rules.choose_cutoffs(stats, labels).collect()}
    assert cutoffs == {"en": {"symbols_per_word": 1.0}}
    judged = quality_rules.judge(stats, quality_rules.choose_cutoffs(stats, labels)).collect()
    assert {r.doc_id for r in judged if not r.kept} == {1000 + i for i in range(100)}


def test_classifiers_on_held_out_labels(spark):
    larger = "/root/testdata/sf0.01"
    labels = table(spark, larger, "labels")
    quality = q.op3_factorisation_machine(spark, larger).join(labels, "doc_id").where("held_out").toPandas()
    assert (quality.predicted == quality.quality).mean() >= 0.95
    toxic = q.op9_toxicity(spark, larger).join(labels, "doc_id").where("held_out").toPandas()
    assert (toxic.predicted == toxic.toxic).mean() >= 0.85
    assert toxic[toxic.toxic == 0].predicted.mean() <= 0.02


def test_repeated_ids_do_not_grow_the_sample(spark):
    made = spark.range(5000).select(
        (F.col("id") % 3).alias("doc_id"), F.lit(1).alias("y"), F.col("id").cast("string").cast("binary").alias("features")
    )
    rows = sorted((r.doc_id, r.y, bytes(r.features)) for r in labelled.one_row(made, "features").collect())
    assert rows == [(0, 1, b"0"), (1, 1, b"1"), (2, 1, b"1001")]


def test_pieces_match_the_library(spark, texts):
    import hashlib

    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in q.op5_piece_encoding(spark, SMALL).collect():
        ids = [1, *model.encode(texts[r.doc_id] or ""), 2]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_nearest_recall(spark):
    rows = table(spark, SMALL, "embeddings").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    found = defaultdict(dict)
    for r in q.op6_nearest(spark, SMALL).collect():
        found[r.query_id][r["rank"]] = (r.vec_id, r.score)
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(axis=1)
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        got = found[ids[i]]
        assert sorted(got) == list(range(1, 21))
        assert all(math.isclose(s, score[np.flatnonzero(ids == v)[0]], rel_tol=1e-12) for v, s in got.values())
        hits.append(len({v for v, _ in got.values()} & set(best)) / 20)
    assert np.mean(hits) >= 0.9


def brute_nearest(ids, x, query, k=20):
    """The first ``k`` ids by inner product, each with the best of its rows."""
    best = {}
    for v, s in zip(ids.tolist(), x @ x[query]):
        if v != ids[query]:
            best[v] = max(s, best.get(v, -math.inf))
    return sorted(best, key=lambda v: (-best[v], v))[:k]


def recall_of(spark, ids, x, every=20, k=20):
    """Recall of each query's neighbours, of which there must be ``k`` or all there are."""
    rows = spark.createDataFrame(list(zip(ids.tolist(), x.tolist())), "vec_id bigint, embedding array<double>")
    found = defaultdict(list)
    for r in nearest.nearest(rows, F.col("vec_id") % every == 0, k).collect():
        found[r.query_id].append(r.vec_id)
    hits = []
    for i in np.unique(ids, return_index=True)[1]:
        if ids[i] % every == 0:
            want, got = brute_nearest(ids, x, i, k), found[ids[i]]
            assert len(set(got)) == len(got) == len(want), (ids[i], len(got))
            hits.append(len(set(got) & set(want)) / max(1, len(want)))
    return np.mean(hits)


def test_nearest_in_tight_clusters(spark):
    chance = np.random.default_rng(3)
    centres = np.repeat(chance.normal(size=(120, 64)), 40, axis=0)
    x = centres + 0.002 * chance.normal(size=centres.shape)
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert recall_of(spark, np.arange(len(x)), x) >= 0.99


def test_nearest_with_repeated_rows(spark):
    chance = np.random.default_rng(4)
    x = np.repeat(chance.normal(size=(150, 64)), 32, axis=0) + 0.02 * chance.normal(size=(4800, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.concatenate([np.arange(len(x)), np.repeat(np.arange(1, len(x), 8), 25)])
    assert recall_of(spark, ids, np.concatenate([x, np.repeat(x[1::8], 25, axis=0)])) >= 0.99


def test_nearest_of_few_rows(spark):
    x = np.random.default_rng(5).normal(size=(12, 64))
    assert recall_of(spark, np.arange(12), x, every=2) == 1


@pytest.mark.parametrize("skew", ["one long", "lognormal"])
def test_nearest_with_skewed_norms(spark, skew):
    chance = np.random.default_rng(6)
    x = chance.normal(size=(12_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= chance.lognormal(size=(len(x), 1)) if skew == "lognormal" else 1
    x[777] *= 1000
    assert recall_of(spark, np.arange(len(x)), x, every=100) >= 0.95


def test_nearest_completes_short_lists(spark):
    chance = np.random.default_rng(7)
    x = np.ones((3_000, 64)) + 0.01 * chance.normal(size=(3_000, 64))
    x[::100] *= -1  # the queries lie opposite to all but each other
    assert recall_of(spark, np.arange(len(x)), x, every=100, k=40) >= 0.95


def test_packing_matches_the_tokenizer(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(q.BYTE_BPE.tokenizer)
    pieces = defaultdict(list)
    rows = q.op10_packing(spark, SMALL).collect()
    for r in rows:
        pieces[r.doc_id].append(r)
        assert r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc, text in texts.items():
        ids, at = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)


def test_components_take_no_round_for_stars_and_go_on_from_known_ones(spark, monkeypatch):
    from topicloom.llm import components as co

    written, stored = [], co.stored
    monkeypatch.setattr(co, "stored", lambda df, name: written.append(name) or stored(df, name))
    links = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    stars = [(1, 5), (7, 1), (2, 9), (9, 2), (3, 4)]
    roots = co.components(links(stars))
    assert {(r.node, r.root) for r in roots.collect()} == {(5, 1), (7, 1), (9, 2), (4, 3)}
    assert "star_round" not in written
    more = [(9, 7), (4, 20), (30, 31), (31, 32), (5, 1)]
    joined = {(r.node, r.root) for r in co.with_links(roots, links(more)).collect()}
    assert joined == {(2, 1), (5, 1), (7, 1), (9, 1), (4, 3), (20, 3), (31, 30), (32, 30)}
    assert joined == {(r.node, r.root) for r in co.components(links(stars + more)).collect()}
    assert co.with_links(roots, links([])).count() == 4 and co.components(links([])).count() == 0


def test_packing_takes_white_space_of_any_length():
    from tokenizers import Tokenizer

    from topicloom.llm import packing

    tokenizer, ids = Tokenizer.from_file(q.BYTE_BPE.tokenizer), packing._encoder(q.BYTE_BPE)
    for text in ("a  b", "\n\nb", " \t\r\n 's  ", "a \n\n1 \n", "a" + " " * 1_500_000 + "b" + "\n" * 1_500_000):
        assert ids(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_trust_follows_links_and_distrust_comes_back(spark):
    pages = spark.createDataFrame(
        [(1, "http://good.org/a", '<a href="https://Friend.net/x">'), (2, "http://friend.net/", "<img src=//pal.net/i>"),
         (3, "http://spam.net/", '<a HREF = http://bad.com/de/1>'), (4, "http://bad.com/de/2", ""),
         (5, "http://pal.net/z", None), (6, "http://lone.net/", "<a href=/home>")],
        "page_id bigint, url string, html string",
    )
    got = {r.host: r for r in url_trust.url_verdicts(pages, q.URL_RULES).collect()}
    assert {h: r.verdict for h, r in got.items()} == {
        "good.org": "allow", "friend.net": "allow", "pal.net": "allow", "spam.net": "block", "bad.com": "block", "lone.net": "allow",
    }
    assert got["good.org"].trust > got["friend.net"].trust > got["pal.net"].trust > 0
    assert got["bad.com"].distrust > got["spam.net"].distrust > 0


def test_licences_are_inherited_from_the_nearest_folder(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License.", True), (2, "a/x/y.py", "code", False),
        (3, "a/b/LICENSE", "Licensed under the Apache License, Version 2.0.", True), (4, "a/b/c/d.py", "more", False),
        (5, "a/b/c/e.py", "text\n# This work is licensed under the GNU General Public License, version 3.\n", False),
        (6, "z.py", "nothing", False), (7, "q/r.py", "my driving licence was lost", False),
    ]
    files = spark.createDataFrame(rows, "file_id bigint, path string, text string, is_licence_file boolean")
    got = {r.file_id: (r.own, r.licence, r.inherited_from) for r in licences.scanned(files).collect()}
    assert got == {
        1: ("MIT", "MIT", None), 2: (None, "MIT", "a"), 3: ("Apache-2.0", "Apache-2.0", None),
        4: (None, "Apache-2.0", "a/b"), 5: ("GPL-3.0", "GPL-3.0", None), 6: (None, None, None), 7: (None, None, None),
    }


def test_pipeline(spark, texts):
    out = corpus_pipeline.run(spark, SMALL)
    docs = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    verdicts = {r.doc_id: r for r in q.op7_quality_rules(spark, SMALL).collect()}
    assert docs and docs <= {d for d, r in verdicts.items() if r.kept}
    groups = defaultdict(set)
    for d in docs:
        groups[frozenset(shingles(texts[d], 5))].add(d)
    assert all(len(g) == 1 for g in groups.values())
