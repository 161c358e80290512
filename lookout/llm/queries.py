"""One thin query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lookout.llm import (
    backoff_lm,
    bpe,
    collision_ann,
    mil_quality,
    mixing,
    ordinal_toxicity,
    probminhash,
    rules,
    spelling,
    substring_dedup,
    url_filter,
    vector_codes,
    warc_zip,
)
from lookout.llm.catalog import register
from lookout.llm.frames import documents, work_dir
from lookout.llm.samples import crc_of


def _table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(column: str, mod: int, rest: int) -> Column:
    return F.pmod(crc_of(F.col(column)), F.lit(mod)) == rest


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op1_bpe")
def op1(spark, sf_dir):
    """Operator 1: token ids of every document, and the text they decode to."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return bpe.encode_decode(docs, "text", tokenizer_path()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op2_warc_zip")
def op2(spark, sf_dir):
    """Operator 2: a WARC record per page, written to packages and read back."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    packages = warc_zip.write_packages(pages, "page_id", "url", "html", work_dir(spark, "warc"))
    return warc_zip.read_packages(packages).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@register("op3_rule_ledger")
def op3(spark, sf_dir):
    """Operator 3: measurements, failed rules and verdicts of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    book = rules.ledger(docs, "text").drop("text")
    return book.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        rules.rejected_by(rules.BASE).alias("base_failed"),
        (~rules.rejected_by(rules.STRICT)).alias("kept"),
        "failed",
    )


@register("op4_collision_ann")
def op4(spark, sf_dir):
    """Operator 4: the 20 nearest vectors of every query vector."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return collision_ann.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 20 == 0)


LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}


def tree() -> dict[str, tuple[Column, Column]]:
    """Domain (sources by a hash of their name), language, source."""
    lang = F.lit(1)
    for name, weight in LANG_WEIGHTS.items():
        lang = F.when(F.col("lang") == name, weight).otherwise(lang)
    return {
        "domain": (F.concat(F.lit("d"), F.substring(F.md5("source"), 1, 1)), F.lit(1)),
        "lang": (F.col("lang"), lang),
        "source": (F.col("source"), F.lit(1)),
    }


def _share_sql(before: str, above: list[str], level: str, weight: str, out: str) -> str:
    """CTEs that give the nodes of one level their budgets."""
    keys = ", ".join([*above, level])
    part = f"PARTITION BY {', '.join(above)}" if above else ""
    run = f"({part} ORDER BY CAST(cap AS DOUBLE) / w NULLS FIRST, {level} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
{out}_g AS (SELECT {keys}, CAST(max(b) AS HUGEINT) AS b, CAST({weight} AS HUGEINT) AS w, CAST(sum(cap) AS HUGEINT) AS cap
  FROM {before} GROUP BY {keys}),
{out}_s AS (SELECT *, coalesce(sum(cap) OVER {run}, 0) AS cap_before,
  sum(w) OVER ({part}) - coalesce(sum(w) OVER {run}, 0) AS w_left FROM {out}_g),
{out}_t AS (SELECT *, cap_before * w + cap * w_left <= b * w AS gives_all FROM {out}_s),
{out}_u AS (SELECT {keys}, CASE WHEN gives_all THEN cap ELSE
    ((b - coalesce(sum(CASE WHEN gives_all THEN cap END) OVER ({part}), 0)) * w)
    // nullif(coalesce(sum(CASE WHEN NOT gives_all THEN w END) OVER ({part}), 0), 0) END AS nb FROM {out}_t),
{out} AS (SELECT l.* EXCLUDE (b), CAST(u.nb AS HUGEINT) AS b FROM {before} l JOIN {out}_u u USING ({keys})),"""


_LANG_CASE = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANG_WEIGHTS.items()) + " ELSE 1 END"

MIX_SQL = f"""WITH d AS (SELECT doc_id, 'd' || substr(md5(source), 1, 1) AS domain, lang, source,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(n) AS HUGEINT) AS tokens,
    CAST(4 * sum(n) AS HUGEINT) AS cap, CAST(sum(sum(n)) OVER () AS HUGEINT) AS b FROM d GROUP BY domain, lang, source),
{_share_sql("leaves", [], "domain", "1", "l1")}{_share_sql("l1", ["domain"], "lang", _LANG_CASE, "l2")}{
    _share_sql("l2", ["domain", "lang"], "source", "1", "l3")}
p AS (SELECT domain, lang, source, b // tokens AS whole, b % tokens AS rest FROM l3 WHERE tokens > 0),
k AS (SELECT d.*, whole, rest, md5('42:' || CAST(whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)) AS key
    FROM d JOIN p USING (domain, lang, source)),
r AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM k),
c AS (SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, domain, lang, source, CAST(n AS BIGINT) AS n_tokens, CAST(unnest(range(CAST(copies AS BIGINT))) AS INTEGER) AS epoch
FROM c WHERE copies > 0"""


@register("op5_hierarchical_mix", MIX_SQL)
def op5(spark, sf_dir):
    """Operator 5: documents mixed to the weights of a domain, language, source tree."""
    docs = documents(spark, sf_dir).select("doc_id", "lang", "source", "text")
    narrow = docs.withColumn("n_tokens", mixing.word_count("text")).drop("text")
    mixed = mixing.mix(narrow, "doc_id", F.col("n_tokens"), tree())
    return mixed.select("doc_id", tree()["domain"][0].alias("domain"), "lang", "source", "n_tokens", "epoch")


@register("op6_ordinal_toxicity")
def op6(spark, sf_dir):
    """Operator 6: expected severity of toxic language of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    out = held_out("doc_id", 3, 1)
    model = ordinal_toxicity.train(docs, labels, "doc_id", "text", "toxic", ~out)
    return (
        ordinal_toxicity.score(docs, "text", model)
        .drop("text")
        .withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))
        .withColumn("held_out", out)
    )


@register("op7_probminhash_dedup")
def op7(spark, sf_dir):
    """Operator 7: class of near-duplicates of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = probminhash.near_duplicate_classes(docs, "doc_id", "text")
    return found.select(F.col("id").alias("doc_id"), "class_id")


@register("op8_debruijn_dedup")
def op8(spark, sf_dir):
    """Operator 8: words outside repeated 35-word windows of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = substring_dedup.remove_repeated(docs, "doc_id", "text")
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op9_backoff_lm")
def op9(spark, sf_dir):
    """Operator 9: language-model score of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = held_out("doc_id", 7, 2)
    return backoff_lm.score(docs, "doc_id", "text", ~out).withColumn("held_out", out)


@register("op10_mil_quality")
def op10(spark, sf_dir):
    """Operator 10: quality score of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels")
    out = held_out("doc_id", 3, 1)
    model = mil_quality.train(docs, labels, "doc_id", "text", "quality", ~out)
    return (
        mil_quality.score(docs, "text", model)
        .drop("text")
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .withColumn("held_out", out)
    )


@register("op11_spelling_variants")
def op11(spark, sf_dir):
    """Operator 11: spelling variants of every word of the documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return spelling.variants(spelling.vocabulary(docs, "doc_id", "text"))


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Codes, errors and codebooks by comparing every part with every entry."""
    nearest = """SELECT rn, k, min(struct_pack(d := d, e := e)) AS m FROM (
  SELECT rn, p.k, c.e, list_sum(list_transform(range(1, len(p.y) + 1), lambda i: (p.y[i] - c.y[i]) ** 2))::HUGEINT AS d
  FROM p JOIN {books} c ON p.k = c.k) GROUP BY rn, k"""
    steps = f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id) AS rn FROM kept),
p AS MATERIALIZED (SELECT rn, k, x[k * (len(x) // {parts}) + 1 : (k + 1) * (len(x) // {parts})] AS y
  FROM v, (SELECT unnest(range({parts})) AS k)),
c0 AS MATERIALIZED (SELECT k, rn - 1 AS e, y FROM p WHERE rn <= {entries}),"""
    for i in range(1, rounds + 1):
        steps += f"""
a{i} AS MATERIALIZED ({nearest.format(books=f"c{i - 1}")}),
s{i} AS (SELECT k, e, j, floor(sum(y[j])::DOUBLE / count(*))::HUGEINT AS z FROM (
  SELECT p.k, a.m.e AS e, p.y, unnest(range(1, len(p.y) + 1)) AS j FROM p JOIN a{i} a USING (rn, k)) GROUP BY k, e, j),
c{i} AS MATERIALIZED (SELECT k, e, coalesce(n.y, o.y) AS y FROM c{i - 1} o
  LEFT JOIN (SELECT k, e, list(z ORDER BY j) AS y FROM s{i} GROUP BY k, e) n USING (k, e)),"""
    return (
        steps
        + f"""
f AS MATERIALIZED ({nearest.format(books=f"c{rounds}")}),
w AS (SELECT rn, string_agg(printf('%02x', m.e), '' ORDER BY k) AS code, sum(m.d)::BIGINT AS error FROM f GROUP BY rn),
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY k, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN w USING (rn), h"""
    )


@register("op12_vector_codes", _codes_sql())
def op12(spark, sf_dir):
    """Operator 12: code and error of every vector, and the codebooks' hash."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.train(vectors, "vec_id", "embedding")
    if books is None:
        coded = vectors.where(F.lit(False)).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = vector_codes.encode(vectors, "embedding", books).drop("embedding")
    return vector_codes.error_by_label(coded, "label").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256")
    )


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _lower_sql(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _node_sql(x: str) -> str:
    front = f"regexp_extract({x}, '(?s)^([^#]*?://[^/?#]*)', 1)"
    return f"""CASE WHEN {front} <> '' THEN {_lower_sql(front)} || substr(regexp_extract({x}, '(?s)^([^#]*)', 1), len({front}) + 1) END"""


def _tags_sql(tag: str, which: str, link: str, groups: int) -> str:
    part = ", ".join(f"nullif(regexp_extract(t, {_sql_text(link)}, {i + 1}), '')" for i in range(groups))
    return f"""SELECT u, coalesce({part}) AS l FROM (SELECT u, unnest(regexp_extract_all(h, {_sql_text(tag)})) AS t FROM shown)
  WHERE regexp_matches(t, {_sql_text(which)})"""


URL_SQL = f"""WITH RECURSIVE rules(h, p, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
pg AS (SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
shown AS (SELECT url AS u, regexp_replace(html, {_sql_text(url_filter.HIDDEN)}, ' ', 'g') AS h FROM pg
  WHERE contains(url, '://') AND regexp_matches(html, '(?i)canonical|http-equiv')),
links AS ({_tags_sql(url_filter.LINK_TAG, url_filter.CANONICAL, url_filter.HREF, 3)}
  UNION ALL {_tags_sql(url_filter.META_TAG, url_filter.REFRESH, url_filter.REFRESH_URL, 2)}),
parts AS (SELECT u, replace(regexp_replace(l, '^\\s+|\\s+$', '', 'g'), '&amp;', '&') AS t,
    regexp_extract(u, '(?s)^(.*?://[^/?#]*)', 1) AS front, regexp_extract(u, '(?s)^(.*?:)//', 1) AS scheme,
    regexp_extract(u, '(?s)^(.*?://[^?#]*)', 1) AS file,
    regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*/)', 1) AS folder FROM links WHERE l IS NOT NULL),
targets AS (SELECT u, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN scheme || t
    WHEN starts_with(t, '/') THEN front || t WHEN starts_with(t, '?') THEN file || t
    WHEN t = '' OR starts_with(t, '#') THEN u
    ELSE front || CASE WHEN folder = '' THEN '/' ELSE folder END || t END AS t FROM parts),
e AS (SELECT DISTINCT {_node_sql("u")} AS a, {_node_sql("t")} AS b FROM targets),
both_ways AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
judged AS (SELECT n, {_lower_sql("regexp_extract(rest, '(?s)^([^/?#]*)', 1)")} AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM (
  SELECT n, CASE WHEN contains(n, '://') THEN substr(n, position('://' IN n) + 3) ELSE '' END AS rest FROM (
    SELECT a AS n FROM both_ways UNION SELECT url FROM pg WHERE url IS NOT NULL))),
ruled AS (SELECT n, host, path, arg_max(h || p, struct_pack(l := len(h || p), a := v = 'allow')) AS rule,
    arg_max(v, struct_pack(l := len(h || p), a := v = 'allow')) AS v
  FROM judged LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n, host, path),
bad AS (SELECT DISTINCT r.a FROM reach r JOIN ruled ON r.b = ruled.n WHERE ruled.v = 'block')
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(v, CASE WHEN {_node_sql("url")} IN (SELECT a FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM pg LEFT JOIN ruled ON pg.url = ruled.n"""


@register("op13_url_filter", URL_SQL)
def op13(spark, sf_dir):
    """Operator 13: verdict of every page's URL, by rules and by its aliases."""
    pages = _table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    edges = url_filter.page_links(pages, "url", "html")
    return url_filter.judge(pages.select("page_id", "url"), "url", rules, edges)[
        ["page_id", "host", "path", "rule", "verdict"]
    ]
