"""SimHash links, spelling variants and bisector clusters against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_samples import SMALL
from topicloom.llm import bisector_clusters as bc, queries, segment_simhash as sh, spelling_variants as sv

DOCS = "doc_id bigint, text string"


# -- SimHash -----------------------------------------------------------------------


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """``{id: smallest id reachable}`` of ``[(id, print)]``, where an id may come more than once."""
    above = list(range(len(prints)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i, (a, p) in enumerate(prints):
        for j, (b, q) in enumerate(prints[:i]):
            if a == b or (p ^ q).bit_count() <= 3:
                above[top(i)] = top(j)
    least = {}
    for i, (a, _) in enumerate(prints):
        least[top(i)] = min(a, least.get(top(i), a))
    return {a: least[top(i)] for i, (a, _) in enumerate(prints)}


def test_simhash_query_is_the_plain_one(spark):
    rows = queries.op11_segment_simhash(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == plain_components(sorted(prints.items()))


def crowded_prints(seed, n=900):
    """Fingerprints in chains and round a few centres, so that many links matter."""
    chance = random.Random(seed)
    out = {0}
    centres = [chance.getrandbits(64) for _ in range(6)]
    while len(out) < n:
        x = chance.choice(centres) if chance.random() < 0.7 else chance.choice(sorted(out)[:50])
        for _ in range(chance.choice((1, 2, 3, 4, 5, 9))):
            x ^= 1 << chance.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("cell_rows", [16_384, 40, 2])
def test_simhash_links_at_every_cell_bound(spark, cell_rows):
    """Cells compared whole, dealt again by bits, and joined by flipped bits."""
    prints = crowded_prints(cell_rows)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = sh.print_links(spark.createDataFrame(signed, "print bigint"), sh.SegmentSimHash(cell_rows=cell_rows)).collect()
    links = {(r.a % 2**64, r.b % 2**64) for r in found}
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    at = {p: i for i, p in enumerate(prints)}
    above = list(range(len(prints)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        above[top(at[a])] = top(at[b])
    want = plain_components([(i, p) for i, p in enumerate(prints)])
    groups = {}
    for i in range(len(prints)):
        groups.setdefault(top(i), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_manhattan_distance_never_exceeds_differing_bits():
    x = np.random.default_rng(5).integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = x[:2000], x[2000:]
    bound = np.bitwise_count(sh.segment_counts(a) ^ sh.segment_counts(b))
    apart = [sum(abs((int(p) >> i & 3).bit_count() - (int(q) >> i & 3).bit_count()) for i in range(0, 64, 2)) for p, q in zip(a, b)]
    assert list(bound) == apart and (bound <= np.bitwise_count(a ^ b)).all()


def test_simhash_edges(spark, odd_docs):
    rows = sh.near_duplicates(odd_docs).collect()
    at = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs.count()
    assert {at[i].fingerprint for i in (1, 2, 3)} == {"0" * 16} and {at[i].component_id for i in (1, 2, 3)} == {1}
    assert at[None].component_id is None
    assert at[4].component_id == at[10].component_id == 4
    assert at[6].component_id == at[7].component_id == at[8].component_id == 6
    assert sh.near_duplicates(odd_docs.limit(0)).count() == 0


# -- spelling variants --------------------------------------------------------------


def plain_words(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [x for x in words if abs(len(x) - len(w)) <= 1 and is_near(w, x)] for w in words}
    best = {w: min(xs, key=lambda x: (-words[x], x)) for w, xs in near.items() if xs}
    form = {w: x for w, x in best.items() if words[x] >= 10 * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out


def test_variants_query_is_the_plain_one(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = queries.op12_spelling_variants(spark, SMALL).collect()
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(rows) == len(got) and got == plain_variants(plain_words(docs))
    assert any(r.form for r in rows)


@pytest.mark.parametrize("how", [
    sv.SpellingVariants(), sv.SpellingVariants(list_rows=3), sv.SpellingVariants(shortest=5, longest=7, share=10),
], ids=["lists", "long lists", "no certain gram"])
def test_variants_by_every_way(spark, how):
    """Words that differ at either end and in the middle, and a chain of forms."""
    chance = random.Random(11)
    words = ["".join(chance.choice("abé") for _ in range(chance.randint(7, 10))) for _ in range(300)]
    words += ["aaaaaaa", "aaaaaaaa", "baaaaaa", "aaaaaab", "y" * 90, "y" * 91, "y" * 45 + "z" + "y" * 45]
    rows = [(w, 2 + 30 ** chance.randint(0, 3)) for w in sorted(set(words))]
    counted = spark.createDataFrame(rows, "word string, n bigint").repartition(3)
    got = {(r.a, r.b) for r in sv.word_pairs(counted, how).collect()}
    names = sorted(w for w, _ in rows)
    assert got == {(a, b) for a in names for b in names if a < b and is_near(a, b)}


def test_affected_grams_are_a_bound():
    """What an edit leaves alone is at least all grams but the bound."""
    chance, how = random.Random(3), sv.SpellingVariants()
    extended = {g: 9 for g in ("ab", "ba", "aa", "aba", "bab")}
    for _ in range(400):
        w = "".join(chance.choice("ab") for _ in range(chance.randint(7, 12)))
        at, kind = chance.randrange(len(w) + 1), chance.randrange(3)
        other = w[:at] + ("" if kind == 1 else chance.choice("abc")) + w[at + (kind > 0) :]
        named = []
        for x in (w, other):
            ends, affected = sv.decomposed(x, extended, how)
            front = Counter((x[a:b], a) for a, b in enumerate(ends))
            back = Counter((x[a:b], len(x) - a) for a, b in enumerate(ends))
            named.append((front, back, len(ends) - affected))
        common = sum((named[0][0] & named[1][0]).values()) + sum((named[0][1] & named[1][1]).values())
        assert common >= max(named[0][2], named[1][2])


def test_variants_edges(spark, odd_docs):
    rows = sv.variants(odd_docs).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert got == plain_variants(plain_words(docs))
    assert sv.variants(odd_docs.limit(0)).count() == 0
    ties = [(i, "abcdefx " * 2 + "abcdefy " * 40 + "abcdefz " * 40) for i in range(3)]
    found = {r.word: r for r in sv.variants(spark.createDataFrame(ties, DOCS)).collect()}
    if "abcdefx" in found:
        assert found["abcdefx"].form == "abcdefy"


# -- bisector clusters --------------------------------------------------------------


def plain_clusters(rows, k=16, dims=64, rounds=3):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))
    centres = [v for _, v in named[:k]]

    def place():
        out = []
        for i, v in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((i, v, apart.index(min(apart)), min(apart)))
        return out

    for _ in range(rounds):
        placed = place()
        for c in range(len(centres)):
            own = [v for _, v, at, _ in placed if at == c]
            if own:
                centres[c] = [sum(col) // len(own) for col in zip(*own)]
    placed = place() if centres else []
    inertia = Counter()
    for _, _, c, d in placed:
        inertia[c] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), name[c]) for i, _, c, d in placed), key=lambda r: (r[0] is None, r)
    )


def clustered(rows):
    found = bc.clustered(rows).withColumn("name", bc.centroid_name())
    return sorted(
        ((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.name) for r in found.collect()),
        key=lambda r: (r[0] is None, r),
    )


def test_clusters_are_the_plain_ones(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert clustered(rows) == plain_clusters([(r.vec_id, r.embedding) for r in rows.collect()])


def test_ties_go_to_the_smaller_number():
    planes = bc.Tournament(np.array([[4, 0], [0, 0], [4, 0], [0, 4]]))
    x = np.array([[4, 0], [2, 0], [0, 2], [2, 2], [-1, -1], [9, 9]])
    apart = ((x[:, None] - planes.centroids[None]) ** 2).sum(axis=2)
    won = planes.nearest(x)
    assert list(won) == list(apart.argmin(axis=1)) and list(planes.distances(x, won)) == list(apart.min(axis=1))


def test_clusters_edges(spark):
    chance = np.random.default_rng(2)
    good = [(i, chance.normal(size=64).round(1).tolist()) for i in range(40)]
    odd = [
        (100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [None] + [0.5] * 63),
        (105, [math.nan] + [0.5] * 63), (106, [math.inf] + [0.5] * 63), (None, [0.1] * 64), (7, [-0.1] * 64), (7, good[7][1]),
    ]
    rows = good + odd
    schema = "vec_id bigint, embedding array<double>"
    df = spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ("x", "cluster", "n", "name", "distance")})
    assert clustered(df) == plain_clusters(rows)
    assert clustered(df.limit(0)) == []
    few = [(3, [1.0] * 64), (4, [1.0] * 64), (5, [-2.0] * 64)]
    assert clustered(spark.createDataFrame(few, schema)) == plain_clusters(few)
    far = spark.createDataFrame(few + [(6, [3e30] * 64)], schema)
    assert clustered(far) == plain_clusters(few)
