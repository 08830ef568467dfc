"""The density tree, merging in rounds and sparse topic weights."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicloom.operators import clusters as cl, density


def coords_of(spark, x):
    n, d = x.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, d * n + 1, d, dtype=np.int32)), pa.array(x.ravel()))
    return spark.createDataFrame(pa.table({"id": np.arange(n), "coords": lists})).repartition(8)


def topics_of(coords, **how):
    return cl.density_topics(coords, **how).toPandas().sort_values("id")["topic"].to_numpy()


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_topics_of_unequal_size_and_density(spark, n):
    """Four large groups, four tight ones of 10 to 50 documents close to each other, and a tenth of noise."""
    chance, small = np.random.default_rng(1), (10, 14, 40, 50)
    noise = n // 10
    group = np.concatenate([np.arange(n - noise - sum(small)) % 4, np.full(noise, -1), np.repeat([4, 5, 6, 7], small)])
    large = np.array([[8.0 if i >> j % 2 & 1 else -8.0 for j in range(5)] for i in range(4)])
    tight = 2.0 * np.eye(4, 5) * np.array([1, -1, 1, -1])[:, None]
    x = np.vstack([large, tight, np.zeros((1, 5))])[group] + chance.normal(size=(n, 5)) * np.where(group < 4, 1.0, 0.1)[:, None]
    x[group == -1] = chance.uniform(-14, 14, size=(noise, 5))
    topic = topics_of(coords_of(spark, x), dims=5)
    main = [np.bincount(topic[group == g] + 1).argmax() - 1 for g in range(8)]
    assert sorted(main) == list(range(8)) == sorted(set(topic) - {-1})
    assert all(np.mean(topic[group == g] == main[g]) >= 0.95 for g in range(8))
    assert np.mean(topic[group == -1] == -1) >= 0.9


def test_even_noise_holds_no_topic(spark):
    x = np.random.default_rng(3).uniform(0, 1, size=(3000, 2))
    found = topics_of(coords_of(spark, x), dims=2)
    assert np.mean(found == -1) >= 0.95


def test_equal_documents_and_odd_coordinates(spark):
    x = np.vstack([np.tile([[1.0, 5.0]], (12, 1)), np.tile([[9.0, 5.0]], (30, 1)), np.tile([[4.0, 5.0]], (6, 1))])
    assert list(topics_of(coords_of(spark, x), dims=2)) == [1] * 12 + [0] * 30 + [-1] * 6
    odd = spark.createDataFrame([(1, None), (2, [0.0])], "id long, coords array<double>")
    assert {r["topic"] for r in cl.density_topics(odd).collect()} == {-1}
    assert cl.density_topics(odd.limit(0), dims=1).count() == 0
    with pytest.raises(ValueError, match="reduce"):
        cl.density_topics(spark.createDataFrame([(1, [0.0] * 9)], "id long, coords array<double>"))


def joined_by_hand(heights, saddles, background, least):
    """Hills joined one round at a time with plain dictionaries."""
    owner, settled = {p: p for p in heights}, set()
    edges = {pair: low for pair, low in saddles.items()}

    def stands(count, expected):
        return (count * np.log(count / expected) - count + expected if count > expected else 0.0) >= least

    while True:
        rank = lambda p: (heights[p], p)
        edges = {
            (a, b): low for (a, b), low in edges.items()
            if not (a in settled and rank(b) > rank(a)) and not (b in settled and rank(a) > rank(b))
        }
        joins, settles = {}, set()
        for a in {a for a, _ in edges}:
            around = [(low, rank(b), b) for (x, b), low in edges.items() if x == a]
            higher = [e for e in around if e[1] > rank(a)]
            if higher:
                low, _, to = max(higher)
                if not stands(heights[a], max(low, background)):
                    joins[a] = to
                elif stands(heights[a], max(max(around)[0], background)):
                    settles.add(a)
        if not joins and not settles:
            return owner
        settled |= settles

        def end(p):
            while p in joins:
                p = joins[p]
            return p

        owner = {p: end(t) for p, t in owner.items()}
        after = defaultdict(int)
        for (a, b), low in edges.items():
            if end(a) != end(b):
                after[end(a), end(b)] = max(after[end(a), end(b)], low)
        edges = dict(after)


@pytest.mark.parametrize("seed,n", [(1, 40), (2, 200)])
def test_hills_join_as_by_hand(spark, seed, n):
    chance = np.random.default_rng(seed)
    heights = {int(i): int(h) for i, h in enumerate(chance.integers(6, 300, n))}
    saddles = {}
    for _ in range(3 * n):
        a, b = map(int, chance.integers(0, n, 2))
        if a != b:
            saddles[a, b] = saddles[b, a] = int(chance.integers(5, min(heights[a], heights[b]) + 1))
    peaks = spark.createDataFrame([(p, h, 2.0) for p, h in heights.items()], "peak long, height long, background double")
    rows = spark.createDataFrame([(a, b, low) for (a, b), low in saddles.items()], "a long, b long, low long")
    got = {r["peak"]: r["top"] for r in density.join_hills(peaks, rows, 9.0).collect()}
    want = joined_by_hand(heights, saddles, 2.0, 9.0)
    assert got == want and 1 < len(set(want.values())) < n


# -- merging ------------------------------------------------------------------------


def test_500_planted_topics_merge_in_few_rounds(spark, monkeypatch):
    """A hundred families of five topics that share most of their words."""
    rows = [
        (5 * f + i, f"f{f}w{w}", 20 + (7 * f + 3 * i + w) % 11) for f in range(100) for i in range(5) for w in range(12)
    ] + [(5 * f + i, f"own{f}x{i}", 5) for f in range(100) for i in range(5)]
    rows += [(t, "common", 30) for t in range(500)] + [(-1, "common", 99), (-1, "f0w0", 50)]
    counts = spark.createDataFrame(rows, "topic int, term string, tf long")
    sizes = spark.createDataFrame([(t, 10 + t % 7) for t in range(500)] + [(-1, 70)], "topic int, size long")
    rounds, plain = [], cl.nearest_partners
    monkeypatch.setattr(cl, "nearest_partners", lambda w: rounds.append(1) or plain(w))
    got = {r["topic"]: r["merged"] for r in cl.merge_nearest(counts, sizes, 100).collect()}
    assert got.pop(-1) == -1 and len(got) == 500 and len(set(got.values())) == 100
    assert all(got[t] // 5 == t // 5 for t in got)
    assert len(rounds) <= 12


def one_by_one(counts, sizes, k):
    """The closest pair of topics joined again and again, with weights made anew."""
    counts = {t: dict(ws) for t, ws in counts.items()}
    sizes, merged = dict(sizes), {t: t for t in sizes}
    while len(sizes) > k:
        words = {t: sum(ws.values()) for t, ws in counts.items()}
        mean, total = np.floor(np.mean(list(words.values()))), defaultdict(int)
        for ws in counts.values():
            for w, n in ws.items():
                total[w] += n
        weight = {t: {w: n / words[t] * np.log(1 + mean / total[w]) for w, n in ws.items()} for t, ws in counts.items()}
        norm = {t: np.sqrt(sum(x * x for x in ws.values())) for t, ws in weight.items()}
        pairs = [
            (-round(sum(x * weight[b].get(w, 0) for w, x in weight[a].items()) / norm[a] / norm[b], 12), a, b)
            for a in counts for b in counts if a < b
        ]
        _, a, b = min(pairs)
        gone, into = (b, a) if sizes[a] >= sizes[b] else (a, b)
        for w, n in counts.pop(gone).items():
            counts[into][w] = counts[into].get(w, 0) + n
        sizes[into] += sizes.pop(gone)
        merged = {t: into if m == gone else m for t, m in merged.items()}
    return merged


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_equal_one_merge_at_a_time(spark, seed):
    chance = np.random.default_rng(seed)
    shapes = chance.dirichlet(np.full(60, 0.08), 6)
    counts = {
        t: {f"w{w}": int(n) for w, n in enumerate(chance.multinomial(3000, 0.9 * shapes[t % 6] + 0.1 / 60)) if n} for t in range(24)
    }
    sizes = {t: int(n) for t, n in enumerate(chance.permutation(np.arange(20, 44)))}
    rows = spark.createDataFrame([(t, w, n) for t, ws in counts.items() for w, n in ws.items()], "topic int, term string, tf long")
    sized = spark.createDataFrame(list(sizes.items()), "topic int, size long")
    got = {r["topic"]: r["merged"] for r in cl.merge_nearest(rows, sized, 6).collect()}
    parts = lambda m: {frozenset(t for t in m if m[t] == v) for v in m.values()}
    assert parts(got) == parts(one_by_one(counts, sizes, 6))


def test_partners_over_several_blocks(spark, monkeypatch):
    chance = np.random.default_rng(5)
    rows = [(t, f"w{w}", float(x)) for t in range(30) for w, x in enumerate(chance.random(25)) if x > 0.5]
    weights = spark.createDataFrame(rows, "topic long, term string, weight double")
    whole = {tuple(r) for r in cl.nearest_partners(weights).collect()}
    monkeypatch.setattr(cl, "BLOCK_TOPICS", 8)
    assert {tuple(r) for r in cl.nearest_partners(weights).collect()} == whole and len(whole) == 30


# -- topic weights ------------------------------------------------------------------


def test_nearest_topics_are_the_dense_ones(spark):
    chance = np.random.default_rng(4)
    centres = np.round(chance.normal(size=(9, 3)), 1)
    centres[4] = centres[2]  # a tie
    df = coords_of(spark, chance.normal(size=(50, 3)))
    dense = {r["id"]: r["topic_dist"] for r in cl.soft_topics(df, centres.tolist()).collect()}
    for m in (3, 9, 20):
        for r in cl.nearest_topics(df, centres.tolist(), m).collect():
            want = sorted(range(9), key=lambda t: (-dense[r["id"]][t], t))[:m]
            assert [t["topic"] for t in r["topics"]] == want
            assert [t["weight"] for t in r["topics"]] == pytest.approx([dense[r["id"]][t] for t in want])
    assert cl.nearest_topics(df, [], 3).first()["topics"] == []


def test_fifty_thousand_centroids(spark):
    chance = np.random.default_rng(6)
    centres = chance.normal(size=(50_000, 4))
    x = centres[chance.permutation(50_000)[:300]]
    rows = cl.nearest_topics(coords_of(spark, x), centres.tolist(), 5).collect()
    assert all(np.allclose(centres[r["topics"][0]["topic"]], x[r["id"]]) and len(r["topics"]) == 5 for r in rows)


def test_nearest_partners_in_shares_of_terms(spark, monkeypatch):
    """Terms are dealt into shares, none of which gets all rows of a pair of blocks; partners stay the same."""
    rng = np.random.default_rng(5)
    rows = [(t, f"w{w}", float(rng.random())) for t in range(12) for w in rng.choice(400, 60, replace=False)]
    rows += [(20, "alone", 1.0)]
    weights = spark.createDataFrame(rows, "topic long, term string, weight double")
    whole = {tuple(r) for r in cl.nearest_partners(weights).collect()}
    names = sorted({t for t, _, _ in rows})
    dense = np.zeros((len(names), 401))
    for t, w, x in rows:
        dense[names.index(t), int(w[1:]) if w != "alone" else 400] = x
    unit = dense / np.linalg.norm(dense, axis=1, keepdims=True)
    cosine = np.round(unit @ unit.T, 12)
    np.fill_diagonal(cosine, -2)
    assert {(t, names[int(cosine[i].argmax())], round(float(cosine[i].max()), 10)) for i, t in enumerate(names)} == {
        (t, p, round(c, 10)) for t, p, c in whole
    }
    sizes = spark.sparkContext.accumulator(0)
    plain = cl._block_products

    def counted(part):
        assert part.num_rows < len(rows)
        sizes.add(1)
        return plain(part)

    monkeypatch.setattr(cl, "BLOCK_ROWS", 100)
    monkeypatch.setattr(cl, "_block_products", counted)
    assert {(t, p, round(c, 10)) for t, p, c in cl.nearest_partners(weights).collect()} == {(t, p, round(c, 10)) for t, p, c in whole}
    assert sizes.value > 5
