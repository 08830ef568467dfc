import math
import random
from itertools import combinations

import pytest

from topicloom.operators import coherence as ch, topics as tp

E = 1e-12


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    rows = [(i, [rng.choice("abcdefghij") for _ in range(rng.choice([1, 5, 30, 150]))]) for i in range(120)]
    rows.append((999, [rng.choice("abcdefghij") for _ in range(3000)]))
    lists = {0: ["a", "c", "b", "h"], 1: ["b", "d", "zz"], 7: ["e", "f", "a", "j"]}  # zz never occurs; 7 distinct words among the first 3 of each
    words = [(t, r, w, 1.0 / r) for t, ws in lists.items() for r, w in enumerate(ws, 1)]
    return (
        rows,
        lists,
        spark.createDataFrame(rows, "id long, tokens array<string>").repartition(5),
        spark.createDataFrame(words, "topic_id int, rank int, word string, weight double"),
    )


def brute(rows, lists, measure):
    size = {"c_v": 110, "c_uci": 10, "c_npmi": 10}.get(measure)
    units = []
    for _, t in rows:
        units += [set(t)] if size is None else [set(t[s : s + size]) for s in range(max(1, len(t) - size + 1))]
    n = len(units)

    def p(*ws):
        return sum(all(w in u for w in ws) for u in units) / n

    def npmi(a, b):
        if not p(a) or not p(b):
            return 0.0
        joint = p(a, b) + E
        return 1.0 if abs(math.log(joint)) < E else math.log(joint / (p(a) * p(b))) / -math.log(joint)

    out = {}
    for t, ws in lists.items():
        if measure == "c_v":
            m = [[npmi(a, b) for b in ws] for a in ws]
            total = [sum(col) for col in zip(*m)]
            scale = math.sqrt(sum(x * x for x in total))
            cosines = []
            for row in m:
                own = math.sqrt(sum(x * x for x in row))
                cosines.append(sum(x * y for x, y in zip(row, total)) / (own * scale) if own * scale else 0.0)
            out[t] = sum(cosines) / len(ws)
            continue
        values = []
        for a, b in combinations(ws, 2):
            if not p(a) or not p(b):
                values.append(0.0)
            elif measure == "u_mass":
                values.append(math.log((p(a, b) + E) / p(a)))
            else:
                values.append(npmi(a, b) if measure == "c_npmi" else math.log((p(a, b) + E) / (p(a) * p(b))))
        out[t] = sum(values) / len(values)
    return out


@pytest.mark.parametrize("measure", ["c_v", "c_npmi", "c_uci", "u_mass"])
def test_against_written_out_windows(corpus, measure, monkeypatch):
    rows, lists, docs, words = corpus
    monkeypatch.setattr(ch, "SLICE_HITS", 60)
    got = {r["topic_id"]: r["coherence"] for r in ch.topic_coherence(docs, words, measure).collect()}
    want = brute(rows, lists, measure)
    assert got.keys() == want.keys()
    for t in want:
        assert got[t] == pytest.approx(want[t], rel=1e-9)
    mean = ch.model_coherence(docs, words, measure).first()[0]
    assert mean == pytest.approx(sum(want.values()) / len(want))


def test_unknown_measure(corpus):
    with pytest.raises(ValueError):
        ch.topic_coherence(corpus[2], corpus[3], "other")


def test_diversity(corpus):
    assert tp.topic_diversity(corpus[3], 3).first()[0] == pytest.approx(7 / 9)
