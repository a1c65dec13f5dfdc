"""URL filters: rules, host edges, and both PageRanks against plain iteration."""

from __future__ import annotations

from starmart.llm import url_filter
from starmart.llm.url_filter import TrustParams

PAGES = "page_id long, url string, html string"


def judged(spark, rows, params=TrustParams()):
    return {r["page_id"]: r.asDict() for r in url_filter.judge(spark.createDataFrame(rows, PAGES), params).collect()}


def test_rules(spark):
    got = judged(
        spark,
        [
            (1, "http://Shop.Example.COM/en/7?x#y", None),
            (2, "https://www.example.com/en/1", None),
            (3, "https://a.www.example.com/en/1", ""),
            (4, "http://x.net/es/1", ""),
            (5, "http://xcom/en/", ""),
            (6, "no scheme", ""),
            (7, None, None),
            (8, "http://example.com", ""),
            (9, "http://example.com?q=/en/", ""),
            (10, "ftp://x.org/a//b://c", ""),
        ],
    )
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("shop.example.com", "/en/7", "example.com/en/", "block")
    assert got[2]["rule"] == got[3]["rule"] == "www.example.com/en/" and got[3]["verdict"] == "allow"
    assert (got[4]["rule"], got[4]["verdict"]) == ("net/es/", "block")
    assert got[5]["rule"] is None
    assert (got[6]["host"], got[6]["path"], got[6]["verdict"]) == ("", "", "allow")
    assert (got[7]["host"], got[7]["path"], got[7]["verdict"]) == ("", "", "allow")
    assert got[8]["path"] == "" and got[8]["rule"] is None and got[9]["path"] == ""
    assert (got[10]["host"], got[10]["path"]) == ("x.org", "/a//b://c")


def test_links_between_hosts(spark):
    html = "<a href='http://B.org/x'>b</a><a class=q href=//c.org>c</a><img src=\"/own.png\"><a href=\"https://a.org/z\">self</a><a href='http://b.org'>b</a>"
    edges = url_filter.host_edges(spark.createDataFrame([(1, "http://a.org/", html), (2, None, html), (3, "http://a.org/2", None)], PAGES))
    assert {(r["src"], r["dst"], r["links"]) for r in edges.collect()} == {("a.org", "b.org", 2), ("a.org", "c.org", 1)}


def plain_rank(seed, edges, damping, steps):
    hosts = set(seed) | {h for a, b, _ in edges for h in (a, b)}
    out = {}
    for a, _, n in edges:
        out[a] = out.get(a, 0) + n
    rank = {h: seed.get(h, 0.0) for h in hosts}
    for _ in range(steps):
        new = {h: (1 - damping) * seed.get(h, 0.0) + damping * (0.0 if h in out else rank[h]) for h in hosts}
        for a, b, n in edges:
            new[b] += damping * rank[a] * n / out[a]
        rank = new
    return rank


def test_spread_against_plain_iteration(spark):
    edges = [("a", "b", 3), ("a", "c", 1), ("b", "c", 1), ("c", "a", 2), ("d", "bad", 5), ("e", "d", 1), ("e", "a", 1)]
    seeds = {"a": (1.0, 0.0), "b": (0.5, 0.0), "bad": (0.0, 1.0), "d": (0.0, 0.0), "lone": (0.0, 0.25)}
    frame = spark.createDataFrame([(h, t, d) for h, (t, d) in seeds.items()], "host string, trust double, distrust double")
    params = TrustParams(tolerance=1e-9, steps=40, per_cut=20)
    got = {r["host"]: r for r in url_filter.spread(frame, spark.createDataFrame(edges, "src string, dst string, links long"), params).collect()}
    trust = plain_rank({h: t for h, (t, _) in seeds.items()}, edges, 0.85, 40)
    distrust = plain_rank({h: d for h, (_, d) in seeds.items()}, [(b, a, n) for a, b, n in edges], 0.85, 40)
    assert got.keys() == trust.keys()
    for host in trust:
        assert abs(got[host]["trust"] - trust[host]) < 1e-6
        assert abs(got[host]["distrust"] - distrust[host]) < 1e-6
    assert got["lone"]["distrust"] == 0.25


def test_hosts_that_link_to_blocked_hosts_are_blocked(spark):
    params = TrustParams(rules=(("allow", "good.org", "/"), ("block", "bad.org", "/")), threshold=0.3)
    rows = [(i, f"http://bad.org/{i}", None) for i in range(3)]
    rows += [(10, "http://fan.org/1", "<a href='http://bad.org/1'>x</a>"), (11, "http://good.org/1", "<a href='http://ok.org/'>y</a>"), (12, "http://ok.org/1", "")]
    got = judged(spark, rows, params)
    assert [got[i]["verdict"] for i in (0, 10, 11, 12)] == ["block", "block", "allow", "allow"]
    assert got[10]["rule"] is None


def test_links_of_tags_that_never_close(spark):
    """The pattern is linear: a megabyte of open tags takes no longer than other text."""
    html = "<a " * 350_000 + "<a href" + " " * 100_000 + "<a\thref = 'http://x.org/1'>" + "<img src=//y.org/2 >"
    rows = spark.createDataFrame([(1, "http://a.com/", html)], PAGES)
    assert sorted((r["dst"], r["links"]) for r in url_filter.host_edges(rows).collect()) == [("x.org", 1), ("y.org", 1)]


def plain_blame(seeds, edges, damping, steps):
    blame = dict(seeds)
    for _ in range(steps):
        out = {}
        for a, _, n in edges:
            out[a] = out.get(a, 0) + n
        new = dict(seeds)
        for a in out:
            mean = sum(n * blame.get(b, 0.0) for x, b, n in edges if x == a) / out[a]
            new[a] = max(seeds.get(a, 0.0), damping * mean)
        blame = new
    return {h: b for h, b in blame.items() if b > 0}


def test_blame_against_plain_iteration(spark):
    edges = [("a", "b", 3), ("a", "bad", 1), ("b", "c", 1), ("c", "a", 2), ("d", "bad", 5), ("e", "d", 1), ("e", "half", 1), ("bad", "a", 1), ("p", "q", 1)]
    seeds = {"bad": 1.0, "half": 0.5, "c": 0.0}
    frame = spark.createDataFrame([(h, 0.0, b) for h, b in seeds.items()], "host string, trust double, distrust double")
    params = TrustParams(tolerance=1e-9, steps=30)
    got = {r["host"]: r["blame"] for r in url_filter.blamed(frame, spark.createDataFrame(edges, "src string, dst string, links long"), params).collect()}
    want = plain_blame(seeds, edges, 0.85, 30)
    assert {h for h, b in got.items() if b > 0} == want.keys()
    assert all(abs(got[h] - b) < 1e-6 for h, b in want.items())


def test_empty_repeated_and_extra_columns(spark):
    empty = spark.createDataFrame([], PAGES)
    assert url_filter.judge(empty).collect() == []
    rows = spark.createDataFrame([(1, "http://a.com/", ""), (1, "http://a.com/", ""), (None, "http://a.com/", "")], PAGES)
    rows = rows.selectExpr("*", "1 as host", "2 as verdict", "3 as rule", "4 as trust")
    assert [r["verdict"] for r in url_filter.judge(rows).collect()] == ["allow"] * 3


def test_blame_does_not_depend_on_the_number_of_linkers(spark):
    """Production parameters; pages of net hosts under /es/ are blocked, com hosts are allowed."""
    to = lambda *hosts: "".join(f"<a href='http://{h}/es/1'>x</a>" for h in hosts)
    blocked = {"one.net": "", "two.net": "", "many.net": "", "end.net": "", "out.net": to("else.org")}
    linkers = {"l1.org": to("one.net"), "l2a.org": to("two.net"), "l2b.org": to("two.net"), "lout.org": to("out.net")}
    linkers |= {f"m{k}.org": to("many.net") for k in range(30)} | {"far.org": to("fan.org"), "fan.org": to("end.net")}
    allowed = {"mostly.org": to("one.net", "p.org", "q.org", "r.org"), "good.com": to("one.net"), "p.org": ""}
    pages = [(f"http://{h}/es/1", html) for h, html in {**blocked, **linkers}.items()] + [(f"http://{h}/1", html) for h, html in allowed.items()]
    pages += [("http://half.net/es/1", ""), ("http://half.net/other", ""), ("http://h1.org/1", to("half.net")), ("http://h2.org/1", to("half.net"))]
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    got = judged(spark, rows)
    verdict = {r["host"] + r["path"]: r["verdict"] for r in got.values()}
    assert {verdict[f"{h}/es/1"] for h in (*blocked, *linkers)} == {"block"}
    assert verdict["half.net/other"] == "block" and verdict["h1.org/1"] == verdict["h2.org/1"] == "allow"  # 0.5 of its pages, 0.85 of that
    assert {verdict[f"{h}/1"] for h in allowed} == {"allow"}
