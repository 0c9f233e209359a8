"""Registered queries of the numbered operators, with DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.llm import (byte_bpe, decontamination, hard_negatives, jaccard_join, language_id, packing, sharding, suffix_dedup, token_counts,
                          url_filter, vector_search, warc, whitening)
from cartlens.llm.common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# FIXED VALUES: the host rules of the contract, then two globs for known junk hosts.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
URL_GLOBS = [("*cheap-pills.*", "block"), ("*spam-farm.*", "block")]


def _url_sql() -> str:
    values = ", ".join("('{0}', '/{1}', '{2}', '{3}')".format(*r.partition("/")[::2], r, v) for r, v in URL_RULES)
    globs = ", ".join(f"('{r}', '{r.strip('*')}', '{v}')" for r, v in URL_GLOBS)
    return f"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN coalesce(position('://' IN url), 0) = 0 THEN '' ELSE substr(url, position('://' IN url) + 3) END AS rest
  FROM pages),
split AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM parts),
host_rules(rule_host, rule_path, rule, verdict) AS (VALUES {values}),
globs(pattern, literal, verdict) AS (VALUES {globs}),
by_host AS (
  SELECT r, arg_max(h.rule, length(h.rule)) AS rule, arg_max(h.verdict, length(h.rule)) AS verdict
  FROM split JOIN host_rules h ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r),
by_glob AS (
  SELECT r, arg_max(g.pattern, length(g.pattern)) AS pattern, arg_max(g.verdict, length(g.pattern)) AS verdict
  FROM split JOIN globs g ON contains(host || path, literal) GROUP BY r)
SELECT page_id, host, path, b.rule AS rule, CASE WHEN b.rule IS NULL THEN g.pattern END AS pattern,
  coalesce(b.verdict, g.verdict, 'allow') AS verdict
FROM split LEFT JOIN by_host b USING (r) LEFT JOIN by_glob g USING (r)"""


@register("op1_url_filter", _url_sql())
def op1_url_filter(spark, sf):
    return url_filter.filter_urls(table(spark, sf, "pages"), URL_RULES + URL_GLOBS)


BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@register("op5_byte_bpe")
def op5_byte_bpe(spark, sf):
    return byte_bpe.encode(table(spark, sf, "documents"), BPE_RANKS, public_tokenizers.PATTERN)


SHARDS = [f"shard-{i:02d}" for i in range(32)]
SHARD_SLOTS = 4099


@register("op6_sharding", f"""
WITH t AS (SELECT {sharding.lookup_table(SHARDS, SHARD_SLOTS)} AS slots),
d AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, chr(0) || 'null')), 1, 15))::BIGINT % {SHARD_SLOTS})::INTEGER AS slot FROM documents)
SELECT doc_id, slot, format('shard-{{:02d}}', slots[slot + 1]) AS shard FROM d, t""")
def op6_sharding(spark, sf):
    return sharding.place(table(spark, sf, "documents"), SHARDS, SHARD_SLOTS)


@register("op8_token_counts")
def op8_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op2_language_id")
def op2_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    out = language_id.identify(docs, language_id.fit(docs))
    return out.select(F.col("c0").alias("doc_id"), language_id.hold_out("c0").alias("held_out"), "lang_pred", "score", "n_spans")


@register("op3_decontamination")
def op3_decontamination(spark, sf):
    return decontamination.find(table(spark, sf, "documents"), table(spark, sf, "benchmark"), short=True)


@register("op9_exact_topk", """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND NOT list_bool_or([x IS NULL OR NOT isfinite(x::DOUBLE) for x in embedding])),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op9_exact_topk(spark, sf):
    return vector_search.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op7_jaccard_join", """
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS g FROM w),
t AS (SELECT r, len(g) AS n, unnest(g) AS g FROM s),
l AS (
  SELECT a.r AS a, b.r AS b FROM t a JOIN t b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
c AS (SELECT r AS a, r AS b FROM s UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, m.component_id
FROM s JOIN (SELECT c.a AS r, min(d.doc_id) AS component_id FROM c JOIN s d ON d.r = c.b GROUP BY c.a) m USING (r)""")
def op7_jaccard_join(spark, sf):
    return jaccard_join.join(table(spark, sf, "documents"))


@register("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf):
    return suffix_dedup.dedup(table(spark, sf, "documents"), passages=suffix_dedup.PASSAGE).withColumnRenamed("c0", "doc_id")


def page_records(pages: DataFrame) -> DataFrame:
    """Captures of every page: a response, and up to three later (or earlier) revisits whose URL is
    spelled differently and whose validators agree, differ or are missing, by the page's id."""
    i, etag = F.col("page_id"), F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    modified = F.concat(F.lit("day "), (i % 97).cast("string"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + (i % 5000) * 600)

    def h(name, value):
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    def record(n, kind, url, hours, status, headers, digest):
        return F.struct((i * 4 + n).alias("record_id"), F.lit(kind).alias("kind"), url.alias("url"),
                        (at + F.make_interval(hours=F.lit(hours))).alias("at"), F.lit(status).alias("status"),
                        headers.cast(warc.HEADERS).alias("headers"), digest.cast("string").alias("digest"))

    server = h("Server", F.lit("a"))
    respelled = F.concat(F.regexp_replace("url", "^https://([^/]*)/", "HTTPS://$1:443/"), F.lit("#again"))
    response = record(0, "response", F.col("url"), 0, 200, F.array(
        h("ETag", F.when(i % 5 != 0, etag)), h("Last-Modified", modified), server, h("Content-Length", F.octet_length("html"))), F.md5("html"))
    same = record(1, "revisit", respelled, 30, 304, F.array(
        h("etag", F.concat(F.lit("W/"), etag)), h("Date", F.lit("later")), h("Content-Length", F.lit(0))), F.lit(None))
    other = record(2, "revisit", F.col("url"), 5, 304, F.array(
        h("ETag", F.when(i % 3 == 0, F.lit('"other"'))), h("last-modified", F.when(i % 3 != 1, modified)), h("server", F.lit("b"))), F.lit(None))
    early = record(3, "revisit", F.col("url"), -700, 304, F.array(h("ETag", etag)), F.lit(None))
    every = F.filter(F.array(response, same, other, early), lambda r: (r["kind"] == "response") | (i % 4 < 3) | (r["record_id"] % 4 != 3))
    return pages.select(F.inline(every))


def _revisit_sql() -> str:
    def canonical(url: str) -> str:
        text, parts = f"regexp_replace(trim({url}), '#.*$', '')", r"'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\?.*)?$'"
        scheme, host = f"lower(regexp_extract({text}, {parts}, 1))", f"lower(regexp_extract({text}, {parts}, 2))"
        args = f"array_to_string(list_sort(list_filter(string_split(substr(regexp_extract({text}, {parts}, 4), 2), '&'), lambda a: a <> '')), '&')"
        return f"""CASE WHEN regexp_matches({text}, {parts}) THEN {scheme} || '://' ||
  CASE {scheme} WHEN 'http' THEN regexp_replace({host}, ':80$', '') WHEN 'https' THEN regexp_replace({host}, ':443$', '') ELSE {host} END ||
  CASE regexp_extract({text}, {parts}, 3) WHEN '' THEN '/' ELSE regexp_extract({text}, {parts}, 3) END ||
  CASE coalesce({args}, '') WHEN '' THEN '' ELSE '?' || {args} END ELSE {text} END"""

    def header(headers: str, name: str) -> str:
        return f"nullif(trim(list_filter({headers}, lambda h: lower(h.name) = '{name}')[1].value), '')"

    def h(name: str, value: str) -> str:
        return f"{{'name': '{name}', 'value': CAST({value} AS VARCHAR)}}"

    no = ", ".join(f"'{x}'" for x in warc.NOT_MERGED)
    return f"""
WITH p AS (
  SELECT page_id, url, md5(html) AS d, '"' || md5(html) || '"' AS etag, 'day ' || (page_id % 97) AS modified, strlen(html) AS size,
    TIMESTAMP '1970-01-01' + to_seconds(1700000000 + (page_id % 5000) * 600) AS ts FROM pages),
records AS (
  SELECT page_id * 4 AS record_id, 'response' AS kind, url, ts, 200 AS status, d AS digest,
    [{h('ETag', 'CASE WHEN page_id % 5 <> 0 THEN etag END')}, {h('Last-Modified', 'modified')}, {h('Server', "'a'")}, {h('Content-Length', 'size')}] AS headers FROM p
  UNION ALL SELECT page_id * 4 + 1, 'revisit', regexp_replace(url, '^https://([^/]*)/', 'HTTPS://\\1:443/') || '#again', ts + INTERVAL 30 HOUR, 304, NULL,
    [{h('etag', "'W/' || etag")}, {h('Date', "'later'")}, {h('Content-Length', '0')}] FROM p
  UNION ALL SELECT page_id * 4 + 2, 'revisit', url, ts + INTERVAL 5 HOUR, 304, NULL,
    [{h('ETag', "CASE WHEN page_id % 3 = 0 THEN chr(34) || 'other' || chr(34) END")}, {h('last-modified', 'CASE WHEN page_id % 3 <> 1 THEN modified END')}, {h('server', "'b'")}] FROM p
  UNION ALL SELECT page_id * 4 + 3, 'revisit', url, ts - INTERVAL 700 HOUR, 304, NULL, [{h('ETag', 'etag')}] FROM p WHERE page_id % 4 < 3),
c AS (SELECT * REPLACE ({canonical('url')} AS url) FROM records),
based AS (
  SELECT r.record_id, arg_max(b.record_id, (b.ts, b.record_id)) AS base_id
  FROM c r JOIN c b ON b.kind = 'response' AND b.url = r.url AND b.ts < r.ts WHERE r.kind = 'revisit' GROUP BY r.record_id),
j AS (
  SELECT r.*, s.base_id, b.digest AS base_digest, b.headers AS base_headers,
    list_filter(r.headers, lambda h: lower(h.name) NOT IN ({no})) AS new,
    {header('r.headers', 'etag')} AS e1, {header('b.headers', 'etag')} AS e2,
    {header('r.headers', 'last-modified')} AS m1, {header('b.headers', 'last-modified')} AS m2
  FROM c r LEFT JOIN based s USING (record_id) LEFT JOIN c b ON b.record_id = s.base_id WHERE r.kind = 'revisit'),
o AS (
  SELECT *, CASE WHEN base_id IS NULL THEN 'no_earlier_response'
    WHEN e1 IS NOT NULL AND e2 IS NOT NULL THEN CASE WHEN regexp_replace(e1, '^W/', '') = regexp_replace(e2, '^W/', '') THEN 'resolved' ELSE 'validator_mismatch' END
    WHEN m1 IS NOT NULL AND m2 IS NOT NULL THEN CASE WHEN m1 = m2 THEN 'resolved' ELSE 'validator_mismatch' END
    ELSE 'no_validator' END AS outcome FROM j),
m AS (
  SELECT *, CASE WHEN outcome = 'resolved' THEN list_concat(
      list_filter(base_headers, lambda x: NOT list_contains(list_transform(new, lambda n: lower(n.name)), lower(x.name))), new) ELSE headers END AS merged FROM o)
SELECT record_id, url, ts AS "at", base_id, outcome, CASE WHEN outcome = 'resolved' THEN 200 ELSE status END AS status,
  CASE WHEN outcome = 'resolved' THEN base_digest ELSE digest END AS digest, CAST(len(merged) AS INTEGER) AS n_headers,
  sha256(array_to_string(list_transform(merged, lambda h: h.name || ': ' || coalesce(h.value, '')), chr(10))) AS headers_sha256
FROM m"""


@register("op10_warc_revisits", _revisit_sql())
def op10_warc_revisits(spark, sf):
    out = warc.resolve_revisits(page_records(table(spark, sf, "pages")))
    text = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), F.coalesce(h["value"], F.lit("")))), "\n")
    return out.select("record_id", "url", F.col("at").cast("timestamp_ntz").alias("at"), "base_id", "outcome", "status", "digest",
                      F.size("headers").alias("n_headers"), F.sha2(text, 256).alias("headers_sha256"))


@register("op11_best_fit_packing")
def op11_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op12_whitening")
def op12_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


@register("op13_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND NOT list_bool_or([x IS NULL OR NOT isfinite(x::DOUBLE) for x in embedding])),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.v) = len(a.v) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""")
def op13_hard_negatives(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), F.col("id") % 50 == 0, label_col=moved)
