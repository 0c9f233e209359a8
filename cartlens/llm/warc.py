"""Operator 10: resolving WARC not-modified revisits.

A revisit record (status 304) has no body of its own. It is joined as of its
capture time, by canonical URL, to the latest full response captured earlier;
its validators must agree with that response's, and the headers that a 304 may
update are merged into the response's headers.

The as-of join is made of aggregates and windows over bounded groups: captures
are first reduced to one row per URL and instant (a hot URL's copies meet
already in the map tasks), the latest response is found within each URL and 10 ms,
then over one row per URL and 10 ms within 100 s, over one per 100 s within 10^6 s
(``LEVELS``), and over one row per URL and 10^6 s. At microseconds a group has at
most 10,000 rows, on the last level 2,000 in 60 years. Only then do the revisits
and the responses' headers join, on keys that adaptive execution may split.

Records have: record_id (long), kind (``response`` or ``revisit``), url, at
(timestamp), status (int), headers (array of name and value) and digest (of the
payload). Responses count as full with status 200 and a non-null URL and time.

Outcomes: ``resolved``; ``no_earlier_response`` (also for a null URL or time);
``no_validator`` (the revisit names none, or the response has none to compare);
``validator_mismatch``. An entity tag decides where both sides have one (weak
comparison), else Last-Modified does (equal text). Only the latest earlier
response is tried.

Defined cases: captures at the same instant are not earlier; of several
responses at one instant the one with the largest record_id counts; rows that
repeat a record_id: as a response the smallest of them stands for all, as a
revisit each is resolved for itself; null or empty headers are no headers; a
null digest stays null; an empty table gives an empty result; other columns are
not read, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import stored

#: Microseconds of the groups of instants, each 10,000 of the ones before.
LEVELS = (10**4, 10**8, 10**12)
HEADERS = "array<struct<name:string,value:string>>"

# FIXED VALUES: fields of a 304 that do not update the stored response: those that
# describe its body, and those that belong to one connection.
NOT_MERGED = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, no fragment, ``/`` for an empty
    path, query arguments in order; a text without ``://`` only loses white space."""
    text = F.regexp_replace(F.trim(url), "#.*$", "")
    parts = "^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\\?.*)?$"
    scheme, host = F.lower(F.regexp_extract(text, parts, 1)), F.lower(F.regexp_extract(text, parts, 2))
    port = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path, query = F.regexp_extract(text, parts, 3), F.substring(F.regexp_extract(text, parts, 4), 2, 1 << 30)
    args = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda a: a != "")), "&")
    built = F.concat(scheme, F.lit("://"), port, F.when(path == "", "/").otherwise(path), F.when(args != "", F.concat(F.lit("?"), args)).otherwise(""))
    return F.when(F.rlike(text, F.lit(parts)), built).otherwise(text)


def header(headers: Column, name: str) -> Column:
    """The first value of a header, white space trimmed; null where it has none."""
    found = F.filter(headers, lambda h: F.lower(h["name"]) == name)
    value = F.trim(F.get(found, F.lit(0))["value"])
    return F.when(value != "", value)


def merged_headers(stored_headers: Column, update: Column) -> Column:
    """The response's headers with those of the 304 in place of their namesakes, as far as they may be."""
    new = F.filter(update, lambda h: ~F.lower(h["name"]).isin(NOT_MERGED) & h["name"].isNotNull())
    names = F.transform(new, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored_headers, lambda h: ~F.array_contains(names, F.lower(h["name"])) & h["name"].isNotNull()), new)


def _etag(value: Column) -> Column:
    return F.regexp_replace(value, "^W/", "")


def latest_before(instants: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Rows of url, t (microseconds, one row each) and own: url, t and base, the last non-null own of an earlier t."""
    by, rows = ["url"], instants
    if levels:
        by, rows = ["url", "group"], instants.withColumn("group", F.col("t") - F.pmod("t", F.lit(levels[0])))
    within = Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("base", F.last("own", ignorenulls=True).over(within))
    if not levels:
        return rows.select("url", "t", "base")
    rows = stored(rows, "instants")
    heads = rows.groupBy(*by).agg(F.max(F.when(F.col("own").isNotNull(), F.struct("t", "own"))).alias("latest"))
    above = latest_before(heads.select("url", F.col("group").alias("t"), F.col("latest.own").alias("own")), levels[1:])
    above = above.select(F.col("url").alias("u"), F.col("t").alias("g"), F.col("base").alias("carried"))
    return (rows.join(above, (F.col("url") == F.col("u")) & (F.col("group") == F.col("g")))
            .select("url", "t", F.coalesce("base", "carried").alias("base")))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, url (canonical), at, base_id, outcome, and for resolved
    ones the response's digest, status and merged headers (else the revisit's own)."""
    rows = stored(records.select(
        "record_id", "kind", canonical_url(F.col("url")).alias("url"), "at", "status",
        F.coalesce(F.col("headers").cast(HEADERS), F.array().cast(HEADERS)).alias("headers"), "digest"), "records")
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    timed = rows.where(F.col("url").isNotNull() & F.col("at").isNotNull())
    instant = F.unix_micros(F.col("at").cast("timestamp"))
    instants = timed.groupBy("url", instant.alias("t")).agg(F.max(F.when(full, F.col("record_id"))).alias("own"))
    asof = stored(latest_before(instants).select(F.col("url").alias("u"), "t", F.col("base").alias("base_id")), "as-of")

    # A null URL or time never equals a key; such rows get one of their own, so they do not meet in one task.
    revisits = rows.where(F.col("kind") == "revisit").withColumn(
        "k", F.when(F.col("url").isNotNull(), F.col("url")).otherwise(F.concat(F.lit("\0"), F.coalesce(F.col("record_id").cast("string"), F.lit("")))))
    found = revisits.join(asof, (F.col("k") == F.col("u")) & (instant == F.col("t")), "left").drop("k", "u", "t")
    base = (rows.where(full).groupBy("record_id").agg(F.min(F.struct("digest", "headers")).alias("r"))
            .select(F.col("record_id").alias("b"), "r"))
    base = stored(base, "responses")
    found = found.withColumn("k", F.coalesce("base_id", -F.abs(F.xxhash64("record_id", "at", "url")) - 1))
    found = found.join(base, F.col("k") == F.col("b"), "left").drop("k", "b")

    etag, base_etag = header(F.col("headers"), "etag"), header(F.col("r.headers"), "etag")
    changed, base_changed = header(F.col("headers"), "last-modified"), header(F.col("r.headers"), "last-modified")
    outcome = (F.when(F.col("base_id").isNull(), "no_earlier_response")
               .when(etag.isNotNull() & base_etag.isNotNull(), F.when(_etag(etag) == _etag(base_etag), "resolved").otherwise("validator_mismatch"))
               .when(changed.isNotNull() & base_changed.isNotNull(), F.when(changed == base_changed, "resolved").otherwise("validator_mismatch"))
               .otherwise("no_validator"))
    found = found.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    return found.select(
        "record_id", "url", "at", "base_id", "outcome",
        F.when(ok, F.col("r.digest")).otherwise(F.col("digest")).alias("digest"),
        F.when(ok, F.lit(200)).otherwise(F.col("status")).cast("int").alias("status"),
        F.when(ok, merged_headers(F.col("r.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"))
