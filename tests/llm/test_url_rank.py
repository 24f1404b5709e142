"""Rank over long chains of hosts, against the fixed point."""

import pytest

from roomtide.llm import urls


def test_long_chain(spark):
    """Each host links to the next; the last one is blocked, 20 links from the first."""
    rows = [(i, f"http://h{i}.net/", f'<a href="http://h{i + 1}.net/">') for i in range(20)] + [(20, "http://h20.net/bad", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge_urls(pages, (urls.Rule("block", "net", "/bad"),)).collect()}
    whole = sum(0.85**k for k in range(21))
    for i in range(21):
        assert got[i].verdict == "block"
        assert got[i].distrust == pytest.approx(0.85 ** (20 - i) / whole, abs=1e-6)


def test_edges_of_ancestors_and_schemeless_links(spark):
    html = '<a href="//other.net/x"><img src=https://img.net/i.png><a href="/local/path">'
    rows = [("a.b.example.org", html), ("..odd.com", ""), ("example.org", "")]
    got = {(r.src, r.dst): r.weight for r in urls.host_edges(spark.createDataFrame(rows, "host string, html string")).collect()}
    one = {("a.b.example.org", "b.example.org"), ("a.b.example.org", "example.org")}
    assert set(got) == one | {(b, a) for a, b in one} | {("a.b.example.org", "other.net"), ("a.b.example.org", "img.net")}
    assert set(got.values()) == {1}


def test_verdicts_of_a_mixed_graph(spark):
    """Trust and distrust over a random graph with both kinds of seeds, against dense power iteration."""
    import random

    import numpy as np

    r, n = random.Random(12), 40
    rows, links, seeds = [], np.zeros((n, n)), {"allow": np.zeros(n), "block": np.zeros(n)}
    for i in range(n):
        out = [r.randrange(n) for _ in range(r.randint(0, 5))]
        html = "".join(f'<a href="http://h{j}.net/x">' for j in out)
        kind = {0: "ok", 1: "bad"}.get(r.randrange(6), "x")
        rows.append((i, f"http://h{i}.net/{kind}", html))
        for j in out:
            links[i, j] += i != j
        if kind != "x":
            seeds["allow" if kind == "ok" else "block"][i] += 1
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = (urls.Rule("allow", "net", "/ok"), urls.Rule("block", "net", "/bad"))
    got = {x.page_id: x for x in urls.judge_urls(pages, rules).collect()}

    def rank(w, seed):
        share = w / np.maximum(w.sum(axis=1, keepdims=True), 1)
        seed = seed / seed.sum()
        p = seed
        for _ in range(400):
            p = (1 - urls.DAMPING) * seed + urls.DAMPING * p @ share
        return p / p.sum()

    trust, distrust = rank(links, seeds["allow"]), rank(links.T, seeds["block"])
    assert {x.verdict for x in got.values()} == {"allow", "block"}
    for i in range(n):
        assert got[i].trust == pytest.approx(trust[i], abs=2e-6) and got[i].distrust == pytest.approx(distrust[i], abs=2e-6)
        if got[i].rule is None and abs(trust[i] - distrust[i]) > 1e-5:
            assert got[i].verdict == ("block" if distrust[i] > trust[i] else "allow")
