"""URL filters, top-k search, WARC revisits, suffix sorting, components and the pipeline."""

import datetime as dt
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartlens.llm import components, induced_sort, jaccard_join, queries, url_filter, vector_search, warc

SMALL = "/root/testdata/sf0.001"


def brute_verdict(url, rules, globs):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(r), v == "allow", r, v) for r, v in rules
           if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    if fit:
        return host, path, max(fit)[2], max(fit)[3]
    fit = [(len(r), v == "allow", r, v) for r, v in globs if r.strip("*") in host + path]
    return host, path, None, max(fit)[3] if fit else "allow"


def test_url_filter(spark, monkeypatch):
    rules, globs = queries.URL_RULES + [("a.b.net/x", "allow"), ("ex-ample.com/a.b/", "block")], queries.URL_GLOBS + [("*track*", "block")]
    hosts = ["net", "a.net", "Example.NET", "m.example.net", "notexample.net", "example.com", "x.org", "org", "a.b.net", "cheap-pills.org", "ex-ample.com", "net:80", ""]
    paths = ["", "/", "/en/1", "/en", "/de/x?q=/en/", "/fr/#x", "/x", "/xy", "/a.b/c", "/a_b/c", "?a", "#b", "/tracker/é", "/EN/1"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "a://b://net/", "http://a.net/\nen", "http://" + "a." * 5000 + "net/" + "y" * 20000]
    rows = [(i, u, "h", "r") for i, u in enumerate(urls)] + [(None, "http://a.net/", "h", "r"), (0, urls[0], "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    want = Counter((i, *brute_verdict(u, rules, globs)) for i, u, _, _ in rows)
    for size in (4096, 2):  # one block of rules, several blocks
        monkeypatch.setattr(url_filter, "RULES_PER_BLOCK", size)
        got = url_filter.filter_urls(pages, rules + globs)
        assert Counter((x["page_id"], x["host"], x["path"], x["rule"], x["verdict"]) for x in got.collect()) == want
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []
    assert {x["verdict"] for x in url_filter.filter_urls(pages, []).collect()} == {"allow"}


def test_url_filter_runs_no_python(spark):
    plan = queries.QUERIES["op1_url_filter"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rule_tokens_stand_whole():
    assert url_filter.rule_tokens("net/") == ["net"]
    assert url_filter.rule_tokens("example.com/de/x") == ["com", "de", "example"]
    assert url_filter.rule_tokens("*cheap-pills.*") == ["pills"]
    assert url_filter.rule_tokens("*ads*") == []


def brute_top(rows, k):
    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v)
    vectors = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for qi, q in {(i, tuple(v)) for i, v in vectors if i % 50 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in vectors if i != qi and len(v) == len(q))
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return Counter(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "STEP", 8)
    r = random.Random(2)
    rows = [(i, [round(r.gauss(0, 1), 2) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(8)] + [(i, rows[i][1]) for i in (0, 3, 3)]  # ties, repeated rows
    rows += [(600, None), (601, []), (602, [None] * 6), (603, [float("nan")] * 6), (650, [float("inf")] * 6), (None, rows[1][1]),
             (700, [1.0, 2.0]), (701, [3.0, -1.0]), (750, [5.0, 5.0, 5.0]), (800, [1e7] * 6), (801, [-3e6] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, rank int").repartition(3)
    got = vector_search.top_k(df, F.col("vec_id") % 50 == 0)
    assert Counter(tuple(x) for x in got.collect()) == brute_top(rows, 5)
    assert vector_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_bounds_are_bounds():
    r = np.random.default_rng(1)
    x, q, p = (r.integers(-500, 500, (n, 16)) for n in (200, 9, 5))
    c = vector_search.Candidates(np.arange(200), x, p)
    assert (c.bounds(q) >= q @ x.T).all()


def brute_revisits(rows):
    def head(h, name):
        for n, v in h or []:
            if n.lower() == name:
                return (v or "").strip() or None
    full = [r for r in rows if r[1] == "response" and r[4] == 200 and r[2] is not None and r[3] is not None]
    out = Counter()
    for rid, kind, url, at, _, headers, _ in rows:
        if kind != "revisit":
            continue
        earlier = [f for f in full if at is not None and url is not None and f[2] == url and f[3] < at]
        if not earlier:
            out[(rid, None, "no_earlier_response")] += 1
            continue
        base = max(earlier, key=lambda f: (f[3], f[0]))
        a, b = head(headers, "etag"), head(base[5], "etag")
        c, d = head(headers, "last-modified"), head(base[5], "last-modified")
        if a and b:
            said = "resolved" if a.removeprefix("W/") == b.removeprefix("W/") else "validator_mismatch"
        elif c and d:
            said = "resolved" if c == d else "validator_mismatch"
        else:
            said = "no_validator"
        out[(rid, base[0], said)] += 1
    return out


def test_revisits(spark):
    r = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        url = r.choice(["http://a.org/", "http://a.org/", "http://b.org/x?a=1&b=2", None, "plain"])
        at = r.choice([None] + [start + dt.timedelta(hours=r.randrange(200)) for _ in range(20)])
        headers = r.choice([None, [], [("ETag", r.choice(['"1"', 'W/"1"', '"2"', "", None]))], [("Last-Modified", r.choice(["x", "y"])), ("A", "b")],
                            [("etag", '"1"'), ("last-modified", "x")]])
        rows.append((i, r.choice(["response", "revisit"]), url, at, r.choice([200, 200, 404]), headers, f"d{i}"))
    rows += [rows[0], rows[1]]
    schema = f"record_id long, kind string, url string, at timestamp, status int, headers {warc.HEADERS}, digest string"
    df = spark.createDataFrame(rows, schema).withColumn("base_id", F.lit(1)).withColumn("outcome", F.lit("x"))
    got = warc.resolve_revisits(df).collect()
    assert Counter((x["record_id"], x["base_id"], x["outcome"]) for x in got) == brute_revisits(rows)
    assert warc.resolve_revisits(df.limit(0)).collect() == []


def test_revisit_headers_and_urls(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(1, "response", "HTTP://Ex.org:80?b=2&a=1#f", at, 200, [("ETag", '"v"'), ("Date", "old"), ("Content-Length", "10"), ("Set-Cookie", "1"), ("Set-Cookie", "2")], "d"),
            (2, "revisit", "http://ex.org/?a=1&b=2", at + dt.timedelta(days=40), 304, [("etag", 'W/"v"'), ("date", "new"), ("content-length", "0"), ("Connection", "x")], None)]
    schema = f"record_id long, kind string, url string, at timestamp, status int, headers {warc.HEADERS}, digest string"
    x = warc.resolve_revisits(spark.createDataFrame(rows, schema)).first()
    assert (x["url"], x["base_id"], x["outcome"], x["digest"], x["status"]) == ("http://ex.org/?a=1&b=2", 1, "resolved", "d", 200)
    assert [tuple(h) for h in x["headers"]] == [("Content-Length", "10"), ("Set-Cookie", "1"), ("Set-Cookie", "2"), ("etag", 'W/"v"'), ("date", "new")]


def brute_suffixes(x):
    return sorted(range(len(x)), key=lambda i: x[i:])


@pytest.mark.parametrize("memory", [1 << 24, 10])
def test_suffix_array(monkeypatch, memory):
    monkeypatch.setattr(induced_sort, "MEMORY", memory)  # beyond it the queues lie on disk
    r = random.Random(1)
    for it in range(150):
        n, k = r.randrange(1, 80), r.choice([1, 2, 3, 20])
        x = [r.randrange(1, k + 1) for _ in range(n)]
        x = (x[:max(1, n // 8)] * 8 if it % 3 == 0 else x) + [0]
        assert induced_sort.suffix_array(np.array(x), k + 1).tolist() == brute_suffixes(x)


@pytest.mark.parametrize("span, short", [(1 << 10, 1 << 16), (1 << 10, 4), (0, 4), (0, 1 << 16)])
def test_suffix_array_by_either_naming_and_any_depth(monkeypatch, span, short):
    monkeypatch.setattr(induced_sort, "SPAN", span)  # below it substrings are compared by keys, else by an induction
    monkeypatch.setattr(induced_sort, "SHORT", short)  # above it the reduced text is induced again
    r = random.Random(12)
    for n, k in [(3, 1), (400, 1), (700, 2), (900, 70000), (1500, 3)]:
        x = [r.randrange(1, k + 1) for _ in range(n)]
        x = x + x[:n // 2] + [1] * 50 + x[n // 4:] + [0]
        assert induced_sort.suffix_array(np.array(x), max(x) + 1).tolist() == brute_suffixes(x)


def test_repetitive_text_is_induced_in_few_batches(monkeypatch):
    """Near copies of a text need many levels of names; short ones are not induced level by level."""
    calls = []
    scan = induced_sort._scan
    monkeypatch.setattr(induced_sort, "_scan", lambda *a: (calls.append(len(a[0])), scan(*a)))
    r = random.Random(13)
    one = [r.randrange(1, 20) for _ in range(1000)]
    x = [s if r.randrange(500) else 20 for _ in range(20) for s in one] + [0]
    assert induced_sort.suffix_array(np.array(x), 21).tolist() == brute_suffixes(x)
    assert len(calls) == 2


def test_reduced_text_with_many_small_buckets_is_not_induced_again(monkeypatch):
    """An induction over buckets of a few entries goes in tiny batches: two of them here, not four."""
    calls = []
    scan = induced_sort._scan
    monkeypatch.setattr(induced_sort, "_scan", lambda *a: (calls.append(len(a[0])), scan(*a)))
    rnd = np.random.default_rng(17)
    half = rnd.integers(1, 100_000, 140_000)
    x = np.concatenate([half, half, [0]])
    got = induced_sort.suffix_array(x, 100_000)
    rank = np.empty(len(x) + 1, np.int64)
    rank[got], rank[-1] = np.arange(len(x)), -1
    a, b = got[:-1], got[1:]  # neighbours: the first symbol decides, or the order of what follows it
    assert sorted(got.tolist()) == list(range(len(x)))
    assert ((x[a] < x[b]) | (x[a] == x[b]) & (rank[a + 1] < rank[b + 1])).all()
    assert calls == [len(x)] * 2


def test_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(5001, 5100)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if find(x) != x}


def rows_of(df):
    return sorted(map(repr, (tuple(x) for x in df.collect())))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    at = [names.index(c) for c in got.columns]
    assert rows_of(got) == sorted(repr(tuple(x[i] for i in at)) for x in want.fetchall())


def test_warc_groups_are_bounded_for_a_hot_url(spark, monkeypatch):
    r = random.Random(2)
    stored, groups = warc.stored, []

    def watched(df, name):
        out = stored(df, name)
        if name == "instants":
            groups.append(out.groupBy([c for c in ("url", "day", "group") if c in out.columns]).count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(warc, "stored", watched)
    day, times = 1_700_006_400 * 10**6, sorted(r.sample(range(86_400 * 10**6), 25_000))
    rows = [(i, "response" if i % 7 == 0 else "revisit", "http://a.net/", day + t) for i, t in enumerate(times)]
    rows += [(30_000 + i, "revisit", "http://a.net/", x) for i, x in enumerate((day - 1, -1, day + 10**13, day + times[0] + 1))]
    records = spark.createDataFrame(rows, "record_id long, kind string, url string, micros long").select(
        "record_id", "kind", "url", F.timestamp_micros("micros").alias("at"), F.when(F.col("kind") == "response", 200).otherwise(304).alias("status"),
        F.array(F.struct(F.lit("ETag").alias("name"), F.lit("x").alias("value"))).alias("headers"), F.lit("d").alias("digest"))
    want, latest = {}, None
    for i, kind, _, _ in sorted(rows, key=lambda x: x[3]):
        if kind == "response":
            latest = i
        else:
            want[i] = latest
    assert {x["record_id"]: x["base_id"] for x in warc.resolve_revisits(records).collect()} == want
    assert max(groups) <= 10_000


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    leak = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first()["text"]
    r = random.Random(3)
    clean = " ".join(x for _ in range(60) for x in [r.choice(first["text"].split()) for _ in range(5)])
    extra = [(10**6, None, None, None, 0), (10**6 + 1, "12 34 !!", "en", "s", 8), (10**6 + 2, first["text"], "en", "s", 5), (None, clean, None, None, None),
             (10**6 + 4, clean[::-1] + " " + leak, "en", "s", 5), (10**6 + 5, clean[200:] + " fin", None, "s", 5)]
    all_docs = docs.unionAll(spark.createDataFrame(extra, docs.schema))
    now = all_docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SMALL)
        path = str(tmp_path / name)
        out.write.parquet(path)
        now = spark.read.parquet(path)
        kept[name] = {x["doc_id"] for x in now.select("doc_id").collect()}
        if name != "byte_bpe":
            assert now.columns == docs.columns
    assert not {10**6, 10**6 + 1} & kept["language_id"]
    assert 10**6 + 2 in kept["language_id"] and 10**6 + 2 not in kept["jaccard_join"] and first["doc_id"] in kept["jaccard_join"]
    assert 10**6 + 4 in kept["suffix_dedup"] and 10**6 + 4 not in kept["decontamination"]
    assert kept["byte_bpe"] == kept["decontamination"]
    # Each stage is its operator's decision: the near-duplicate stage keeps one row per component.
    before = spark.read.parquet(str(tmp_path / "language_id"))
    groups = {x["component_id"] for x in jaccard_join.join(before).collect()}
    assert len(groups) == spark.read.parquet(str(tmp_path / "jaccard_join")).count()
    # All stages on an empty table.
    now = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SMALL)
    assert now.count() == 0
