"""Propagated trust against a dense power iteration, and along long ways."""

import numpy as np
import pytest

from topicloom.llm import queries as q, url_trust


def pages_of(spark, links, extra=()):
    """A page for every host with the links it has."""
    hosts = sorted({h for pair in links for h in pair})
    rows = [(i, f"http://{h}/x", " ".join(f'<a href="http://{b}/">' for a, b in links if a == h)) for i, h in enumerate(hosts)]
    rows += [(len(rows) + i, f"http://{h}/de/", "") for i, h in enumerate(extra)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.mark.parametrize("others", [0, 250])
def test_distrust_reaches_the_end_of_a_chain(spark, others):
    """Thirty hosts, each linking to the next, the last one to a blocked one; other seeds elsewhere."""
    names = [f"h{i:02d}.test" for i in range(30)] + ["bad.test"]
    pages = pages_of(spark, list(zip(names, names[1:])), [f"s{i}.other" for i in range(others)])
    rules = [("block", "bad.test/"), *(("allow", f"s{i}.other/") for i in range(others))]
    got = {r.host: r.verdict for r in url_trust.url_verdicts(pages, rules).collect()}
    assert {got[n] for n in names} == {"block"} and all(got[f"s{i}.other"] == "allow" for i in range(others))


def dense_ranks(hosts, links, trust, distrust, damping):
    """Both ranks by dense matrices, iterated until they stand still."""
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for a, b in links:
        m[at[a], at[b]] += 1
    ahead = np.divide(m, m.sum(1, keepdims=True), out=np.zeros_like(m), where=m.sum(1, keepdims=True) > 0)
    back = np.divide(m.T, m.sum(0)[:, None], out=np.zeros_like(m), where=m.sum(0)[:, None] > 0)
    out = []
    for step, seed in ((ahead, trust), (back, distrust)):
        start = np.array([seed.get(h, 0.0) for h in hosts])
        start = start / start.sum()
        x = start
        for _ in range(400):
            x = damping * x @ step + (1 - damping) * start
        out.append(x / x.sum())
    return out


def test_ranks_equal_a_dense_power_iteration(spark):
    chance = np.random.default_rng(8)
    hosts = [f"n{i:02d}.test" for i in range(25)]
    links = [(hosts[a], hosts[b]) for a, b in chance.integers(0, 25, (70, 2)) if a != b]
    pages = pages_of(spark, links)
    rules = [("allow", "n00.test/"), ("allow", "n01.test/"), ("block", "n02.test/"), ("block", "n03.test/")]
    how = url_trust.Spread(tolerance=1e-9)
    rows = {r.host: r for r in url_trust.url_verdicts(pages, rules, how).collect()}
    named = sorted(rows)
    links = [(a, b) for a, b in links]
    trust, distrust = dense_ranks(named, links, {"n00.test": 1, "n01.test": 1}, {"n02.test": 1, "n03.test": 1}, how.damping)
    assert [rows[h].trust for h in named] == pytest.approx(trust, abs=1e-7)
    assert [rows[h].distrust for h in named] == pytest.approx(distrust, abs=1e-7)
    decided = {"n00.test", "n01.test", "n02.test", "n03.test"}
    for h, t, d in zip(named, trust, distrust):
        if h not in decided and abs(d - how.limit * (t + d)) > 1e-6:
            assert rows[h].verdict == ("block" if d > how.limit * (t + d) else "allow")


def test_all_urls_of_the_small_table_get_a_verdict(spark):
    from llm_samples import SMALL

    assert {r.verdict for r in q.op4_url_trust(spark, SMALL).collect()} <= {"allow", "block"}
