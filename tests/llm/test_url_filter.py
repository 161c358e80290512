import random

import pytest

from lookout.llm import url_filter as U
from lookout.llm.catalog import ORACLE
from lookout.llm.queries import URL_RULES, op13
from tests.conftest import SF01

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut].translate(LOWER), rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return host, rest[:cut]


def node(url):
    if "://" not in url.split("#", 1)[0]:
        return None
    url = url.split("#", 1)[0]
    at = url.index("://") + 3
    end = min([url.find(c, at) for c in "/?" if c in url[at:]], default=len(url))
    return url[:end].translate(LOWER) + url[end:]


def rule(url, rules):
    host, path = parts(url)
    fit = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None) if url is not None and "://" in url else None
    return (best[2], best[3]) if best else (None, None)


def brute(urls, edges, rules):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            parent[root(a)] = root(b)
    bad = {root(n) for n in list(parent) if rule(n, rules)[1] == "block"}
    out = []
    for i, u in urls:
        name, verdict = rule(u, rules)
        n = node(u) if u is not None else None
        if verdict is None:
            verdict = "block" if n in parent and root(n) in bad else "allow"
        out.append((i, *parts(u), name, verdict))
    return sorted(out, key=repr)


def judged(spark, urls, edges, rules):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in urls], "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    links = spark.createDataFrame(edges, "source string, target string")
    got = U.judge(pages.repartition(3), "url", table, links)
    assert sorted(got.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=repr)


def test_random_rules_and_links(spark):
    rng = random.Random(2)
    hosts = ["a.org", "b.a.org", "c.b.a.org", "org", "xa.org", "B.com", "b.com", "com", "", "a.org:80"]
    paths = ["", "/", "/x", "/x/y", "/xy", "/x?q=/x/y", "?q", "#f", "/x#f"]
    every = [f"{s}://{h}{p}" for s in ("http", "HTTPS") for h in hosts for p in paths]
    urls = list(enumerate(every)) + [(900, None), (901, "no scheme"), (902, "http:/one"), (0, every[0])]
    edges = [(node(rng.choice(every)), node(rng.choice(every))) for _ in range(60)] + [(None, "http://a.org/x"), ("http://a.org/x", None)]
    rules = [("org", "/", "allow"), ("a.org", "/x", "block"), ("b.a.org", "/x", "allow"), ("com", "", "allow"), ("b.com", "/x/y", "block"),
             ("a.org", "", "allow"), ("a.org", "", "block")]
    assert judged(spark, urls, edges, rules) == brute(urls, edges, [r for r in rules if r != ("a.org", "", "block")])


def test_explicit_allow_holds_against_the_class(spark):
    rules = [("bad.net", "/", "block"), ("good.net", "/", "allow")]
    edges = [("http://bad.net/1", "http://alias.net/1"), ("http://alias.net/1", "http://good.net/1"), ("http://far.net/", "http://good.net/1")]
    urls = [(1, "http://bad.net/1"), (2, "http://alias.net/1"), (3, "http://good.net/1"), (4, "http://far.net/"), (5, "http://none.net/"), (6, "http://alias.net/1#top")]
    got = {r[0]: r[4] for r in judged(spark, urls, edges, rules)}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "block"}


def test_long_chains_and_a_hot_target(spark):
    edges = [(f"http://c.net/{i}", f"http://c.net/{i + 1}") for i in range(60)]
    edges += [(f"http://s.net/{i}", "http://hub.net/") for i in range(500)] * 2
    rules = [("c.net", "/60", "block"), ("s.net", "/499", "block")]
    urls = [(i, f"http://c.net/{i}") for i in range(61)] + [(1000 + i, f"http://s.net/{i}") for i in range(500)]
    got = judged(spark, urls, edges, rules)
    assert got == brute(urls, edges, rules) and all(r[4] == "block" for r in got)


def test_empty_tables(spark):
    urls = [(1, "http://a.org/")]
    assert judged(spark, urls, [], []) == [(1, "a.org", "/", None, "allow")]
    assert judged(spark, [], [("http://a.org/", "http://b.org/")], URL_RULES) == []


PAGES = [
    ("http://a.net/d/p?q", '<LINK rel="canonical" href="https://Example.org/es/1?a=1&amp;b=2">', "https://example.org/es/1?a=1&b=2"),
    ("http://a.net/d/p", "<link href='//x.net/y' rel='alternate canonical'>", "http://x.net/y"),
    ("http://a.net/d/p?q", "<link rel=canonical href=/top>", "http://a.net/top"),
    ("http://a.net/d/p", '<link rel="canonical" href=" near#part ">', "http://a.net/d/near"),
    ("http://a.net?x", '<link rel="canonical" href="near">', "http://a.net/near"),
    ("http://a.net/d/p?q", '<link rel="canonical" href="?z">', "http://a.net/d/p?z"),
    ("http://a.net/d/p", "<meta http-equiv='refresh' content=\"0; URL='http://b.net/r'\">", "http://b.net/r"),
    ("http://a.net/d/p", '<meta content="5;url=http://b.net/r" http-equiv=Refresh>', "http://b.net/r"),
    ("http://a.net/d/p", '<!-- <link rel="canonical" href="http://no.net/"> -->', None),
    ("http://a.net/d/p", "<script>x = '<link rel=canonical href=http://no.net/>'</script>", None),
    ("http://a.net/d/p", '<link rel="stylesheet" href="http://no.net/canonical">', None),
    ("http://a.net/d/p", '<meta http-equiv="content-type" content="text/html; url=http://no.net/">', None),
    (None, '<link rel="canonical" href="http://b.net/">', None),
    ("no scheme", '<link rel="canonical" href="http://b.net/">', None),
    ("http://a.net/", None, None),
    ("http://a.net/", "", None),
]


@pytest.mark.parametrize("url, html, target", PAGES)
def test_links_of_pages(spark, url, html, target):
    df = spark.createDataFrame([(url, html)], "url string, html string")
    got = [(r.source, r.target) for r in U.page_links(df, "url", "html").collect()]
    assert got == ([] if target is None else [(node(url), target)])


def test_query_and_sql_agree_on_pages_with_links(spark, tmpdir_fresh):
    """The tables' pages have no links; these are given some."""
    import duckdb

    pages = spark.read.parquet(f"{SF01}/pages.parquet").collect()
    rng = random.Random(4)
    blocked = [p.url for p in pages if rule(p.url, URL_RULES)[1] == "block"]
    rows, edges = [], []
    for p in pages:
        html, url = p.html, p.url
        if rng.random() < 0.3:
            url = url.replace("example.org", "free.net").replace("example.com", "free.net")
        if rng.random() < 0.5:
            target = rng.choice([rng.choice(blocked), rng.choice(pages).url, "/en/5", "http://elsewhere.net/de/"])
            html = html.replace("</title>", f'</title><link rel="canonical" href="{target}">')
            if target.startswith("/"):
                target = url[: url.index("/", url.index("://") + 3)] + target
            edges.append((node(url), node(target)))
        rows.append((p.page_id, url, html))
    rows += [(9000, None, "<link rel=canonical href=http://x.org/es/>"), (9001, "none", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmpdir_fresh}/pages.parquet")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in op13(spark, tmpdir_fresh).collect()), key=repr)
    want = brute([(i, u) for i, u, _ in rows], edges, URL_RULES)
    assert got == want
    plain = brute([(i, u) for i, u, _ in rows], [], URL_RULES)
    assert sum(a != b for a, b in zip(got, plain, strict=True)) > 5  # the aliases matter
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS FROM read_parquet('{tmpdir_fresh}/pages.parquet/*.parquet')")
    cur = con.execute(ORACLE["op13_url_filter"])
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in ("page_id", "host", "path", "rule", "verdict")]
    assert sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=repr) == want
