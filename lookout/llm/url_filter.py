"""URL filters by redirect equivalence (operator 13).

*Rules* are (host, path, verdict) rows. A rule fits a URL whose host is the
rule's or a subdomain of it and whose path begins with the rule's path; of
several that fit the longest (host and path together) holds, an allow before a
block of the same length. Rules are found by equality joins: the pairs (labels
of the host, letters of the path) that occur among the rules say which ends of
a URL's host and beginnings of its path are looked up, so a host with many
rules or many pages is no group.

*Equivalence.* Redirects and canonical links say that two URLs are the same
page. Connected components over these edges (alternating stars, minima only)
give classes of aliases. A URL that a rule fits keeps the rule's verdict. Of
the others those are blocked that share a class with a URL which a rule
blocks; the rest are allowed. So an explicit allow holds against a block of
the class, and a block of the class against the default.

A URL without its fragment is a node; scheme and host are lower-cased. Links
are taken from pages: ``<link rel=canonical href=...>`` and
``<meta http-equiv=refresh content="...; url=...">`` outside comments and
scripts, each with an absolute, scheme-relative (``//``), root-relative
(``/``), query (``?``) or relative target; ``&amp;`` is undone, dot segments
are left as they are. Other redirects can be given as a table of edges.

All of it is DataFrame functions; page texts go through one scan and are not
shuffled.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
no rule and no aliases, and is allowed; a null or empty page has no links;
repeated rows and URLs get equal verdicts; empty tables of pages, rules or
edges are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.components import components
from lookout.llm.frames import OWN, col, joinable, prepare

ALLOW, BLOCK = "allow", "block"
# Rules, and nodes with an edge, up to which they are broadcast.
BROADCAST_RULES = 50_000
BROADCAST_NODES = 100_000

# Patterns that Java and RE2 read alike.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
LINK_TAG = r"(?is)<link\b[^>]*>"
META_TAG = r"(?is)<meta\b[^>]*>"
CANONICAL = r"""(?is)(?:\s|["'])rel\s*=\s*(?:canonical(?:\s|/|>)|"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|'(?:[^']*\s)?canonical(?:\s[^']*)?')"""
HREF = r"""(?is)(?:\s|["'])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFRESH = r"""(?is)(?:\s|["'])http-equiv\s*=\s*["']?refresh(?:\s|["'/>])"""
REFRESH_URL = r"""(?is)(?:\s|["'])content\s*=\s*(?:"[^"]*\burl\s*=\s*'?([^"']*)|'[^']*\burl\s*=\s*"?([^"']*))"""
AUTHORITY = r"(?s)^(.*?://[^/?#]*)"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ``://`` (empty without one)."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The URL without its fragment, scheme and host lower-cased; null if it
    is none."""
    whole = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    front = F.regexp_extract(whole, AUTHORITY, 1)
    return F.when(front != "", F.concat(lower_ascii(front), F.substring(whole, F.length(front) + 1, F.length(whole))))


def resolve(links: DataFrame) -> DataFrame:
    """(source, target): the URL that link ``l`` of the page ``u`` names. In
    steps, so that no pattern is worked out more than once."""
    parts = links.select(
        "u",
        F.replace(F.regexp_replace("l", r"^\s+|\s+$", ""), F.lit("&amp;"), F.lit("&")).alias("t"),
        F.regexp_extract("u", AUTHORITY, 1).alias("front"),
        F.regexp_extract("u", r"(?s)^(.*?:)//", 1).alias("scheme"),
        F.regexp_extract("u", r"(?s)^(.*?://[^?#]*)", 1).alias("file"),
        F.regexp_extract("u", r"(?s)^.*?://[^/?#]*([^?#]*/)", 1).alias("folder"),
    )
    t = F.col("t")
    target = (
        F.when(t.contains("://"), t)
        .when(t.startswith("//"), F.concat("scheme", "t"))
        .when(t.startswith("/"), F.concat("front", "t"))
        .when(t.startswith("?"), F.concat("file", "t"))
        .when((t == "") | t.startswith("#"), F.col("u"))
        .otherwise(F.concat("front", F.when(F.col("folder") == "", "/").otherwise(F.col("folder")), "t"))
    )
    return parts.select(F.col("u").alias("source"), target.alias("target"))


def page_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(source, target) nodes of the canonical links and redirects in pages."""
    prepare(pages.sparkSession)
    rows = pages.select(col(url_col).alias("u"), col(html_col).alias("h")).where(F.col("u").contains("://"))
    # One plain search keeps most pages out of the pattern steps.
    rows = rows.where(F.col("h").rlike("(?i)canonical|http-equiv"))
    shown = rows.select("u", F.regexp_replace("h", HIDDEN, " ").alias("h"))

    def tags(tag: str, which: str, link: str, groups: int) -> DataFrame:
        found = shown.select("u", F.explode(F.regexp_extract_all("h", F.lit(tag), F.lit(0))).alias("t"))
        part = [F.nullif(F.regexp_extract("t", link, i + 1), F.lit("")) for i in range(groups)]
        return found.where(F.col("t").rlike(which)).select("u", F.coalesce(*part).alias("l"))

    links = tags(LINK_TAG, CANONICAL, HREF, 3).unionByName(tags(META_TAG, REFRESH, REFRESH_URL, 2))
    whole = resolve(links.where(F.col("l").isNotNull()))
    return whole.select(node_of(F.col("source")).alias("source"), node_of(F.col("target")).alias("target"))


def _shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """(labels of the host, letters of the path) of the rules."""
    return sorted(
        (r.a, r.b) for r in rules.select(F.size(F.split("h", r"\.")).alias("a"), F.length("p").alias("b")).distinct().collect()
    )


def rule_of(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) for the distinct values of column ``url`` that a
    rule (host, path, verdict) fits."""
    rules = rules.select(
        lower_ascii(F.col("host")).alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v")
    ).where("h IS NOT NULL AND p IS NOT NULL AND v IS NOT NULL")
    rules = rules.groupBy("h", "p").agg(F.min("v").alias("v")).checkpoint()  # allow is the smaller word
    shapes = _shapes(rules)
    schema = "array<struct<a:int,b:int>>"
    each = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in shapes]).cast(schema)
    keys = (
        urls.select("url")
        .distinct()
        .select("url", host_of(F.col("url")).alias("hh"), path_of(F.col("url")).alias("pp"), F.explode(each).alias("s"))
        .where(F.length("pp") >= F.col("s.b"))
        .select(
            "url",
            F.expr("substring_index(hh, '.', -s.a)").alias("h"),
            F.expr("substring(pp, 1, s.b)").alias("p"),
        )
        .distinct()  # a host of fewer labels gives one key more than once
    )
    fits = keys.join(joinable(rules, BROADCAST_RULES), ["h", "p"])
    text = F.concat("h", "p")
    best = F.max(F.struct(F.length(text).alias("n"), (F.col("v") == ALLOW).alias("a"), text.alias("rule"), "v"))
    return fits.groupBy("url").agg(best.alias("b")).select("url", F.col("b.rule").alias("rule"), F.col("b.v").alias("verdict"))


def _classes(edges: DataFrame) -> DataFrame:
    """(node, class) for every node with an edge. Nodes are numbered, so that
    the rounds compare whole numbers and not texts."""
    # Filtered behind the cut: a filter moved into the steps that make a node
    # would repeat them.
    edges = edges.select("source", "target").distinct().checkpoint()
    edges = edges.where("source IS NOT NULL AND target IS NOT NULL AND source <> target")
    nodes = edges.select(F.explode(F.array("source", "target")).alias("node")).distinct().checkpoint()
    numbered = nodes.select("node", F.monotonically_increasing_id().alias("i")).checkpoint()
    small = joinable(numbered, BROADCAST_NODES)
    by_number = edges.join(small.select(F.col("node").alias("source"), F.col("i").alias("u")), "source").join(
        small.select(F.col("node").alias("target"), F.col("i").alias("v")), "target"
    )
    found = components(by_number.select("u", "v"))
    return numbered.join(found.select(F.col("node").alias("i"), F.col("comp").alias("class")), "i").select("node", "class")


def blocked_nodes(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """The nodes with an edge whose class holds a URL that a rule blocks."""
    classes = _classes(edges).checkpoint()
    ruled = rule_of(classes.select(F.col("node").alias("url")), rules).where(F.col("verdict") == BLOCK)
    bad = classes.join(ruled.select(F.col("url").alias("node")), "node", "left_semi").select("class").distinct().checkpoint()
    return classes.join(joinable(bad, BROADCAST_NODES), "class", "left_semi").select("node")


def judge(pages: DataFrame, url_col: str, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """All rows and columns with ``host``, ``path``, ``rule`` (its host and
    path, null if none fits) and ``verdict``. ``edges`` has (source, target)
    nodes, as from :func:`page_links` or :func:`node_of`."""
    prepare(pages.sparkSession)
    out = ("host", "path", "rule", "verdict")
    u, n, r, v, b = (OWN + x for x in ("url", "node", "rule", "verdict", "bad"))
    rows = pages.withColumns({OWN + "host": host_of(col(url_col)), OWN + "path": path_of(col(url_col))})
    # Rules see host and path only: pages of one host and path share a row.
    key = F.when(col(url_col).contains("://"), F.concat(F.lit("://"), OWN + "host", OWN + "path"))
    rows = rows.withColumns({u: key, n: node_of(col(url_col))})
    named = rows.where(F.col(u).isNotNull()).select(F.col(u).alias("url"))
    ruled = rule_of(named, rules).select(F.col("url").alias(u), F.col("rule").alias(r), F.col("verdict").alias(v))
    bad = blocked_nodes(edges, rules).select(F.col("node").alias(n), F.lit(True).alias(b)).checkpoint()
    joined = rows.join(ruled, u, "left").join(joinable(bad, BROADCAST_NODES), n, "left")
    verdict = F.coalesce(F.col(v), F.when(F.col(b), BLOCK).otherwise(ALLOW))
    return joined.select(
        *[col(c) for c in pages.columns if c not in out],
        F.col(OWN + "host").alias("host"),
        F.col(OWN + "path").alias("path"),
        F.col(r).alias("rule"),
        verdict.alias("verdict"),
    )
