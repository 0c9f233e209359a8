"""Operator 1: URL filters by pattern rules indexed under their rarest literal token.

A rule is ``host/path`` (fits the host and its subdomains when the url's path
starts with the rule's) or, with ``*``, a glob searched anywhere in host + path.
Every rule is filed under one literal token that any url it fits must hold as a
whole token: the one that the fewest rows hold. A url's tokens fetch the rules
filed under them, and only those rules run their regular expression. Rules
without such a token are tried on every url.

Everything on the rows is built-in expressions in one pass without a shuffle:
the index is a one-row table of hash buckets, at most ``RULES_PER_BLOCK`` rules
each (its size bound); longer rule lists are applied block after block.

Defined cases: a null url and a url without ``://`` have empty host and path;
repeated rows are judged each for itself; an empty table gives an empty result;
only the url and the named key columns are read, so other columns (also ones
named like the results) cannot clash. Equal rules: ``allow`` wins over ``block``.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES_PER_BLOCK = 4096
_TOKEN = re.compile("[a-z0-9]+")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _lower(s: str) -> str:
    return s.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def _escape(s: str) -> str:
    return "".join("\\" + c if c in string.punctuation else c for c in s)


def rule_regex(rule: str) -> str:
    """Regular expression of a rule over lower-cased host followed by path."""
    if "*" in rule:
        return ".*".join(_escape(p) for p in rule.strip("*").split("*"))
    host, slash, path = rule.partition("/")
    end = _escape(slash + path) if slash else "(?=/|$)"
    return rf"^(?:[^/]*\.)?{_escape(_lower(host))}{end}"


def rule_tokens(rule: str) -> list[str]:
    """Literal tokens that stand whole in every url that the rule fits."""
    pieces = rule.split("*") if "*" in rule else ["." + rule + ("" if "/" in rule else "/")]
    found = set()
    for p in map(_lower, pieces):
        found |= {m.group() for m in _TOKEN.finditer(p) if m.start() > 0 and m.end() < len(p)}
    return sorted(found)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    parts = "^([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(rest, parts, 1)), F.regexp_extract(rest, parts, 2)


def _tokens(target: Column) -> Column:
    return F.array_union(F.array_distinct(F.split(ascii_lower(target), "[^a-z0-9]+")), F.array(F.lit("")))


def _index(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """One row: an array of hash buckets of the rules, filed by rarest token."""
    spark = urls.sparkSession
    literal = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(rule_regex(r)).alias("regex"),
                                 F.array(*map(F.lit, rule_tokens(r) or [""])).alias("tokens")) for r, v in rules])
    table = spark.range(1).select(F.inline(literal))
    held = table.select(F.explode("tokens").alias("token")).distinct()
    counts = (urls.select(F.explode(_tokens(F.col("target"))).alias("token"))
              .join(F.broadcast(held), "token").groupBy("token").agg(F.count("*").alias("n")))
    filed = (table.select("rule", "verdict", "regex", F.explode("tokens").alias("token"))
             .join(counts, "token", "left")
             .groupBy("rule", "verdict", "regex")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).getField("token").alias("token")))
    size = 2 * len(rules)
    buckets = (filed.groupBy(F.pmod(F.xxhash64("token"), F.lit(size)).alias("bucket"))
               .agg(F.collect_list(F.struct("token", "rule", "verdict", "regex")).alias("entries")))
    return (spark.range(size).withColumnRenamed("id", "bucket").join(buckets, "bucket", "left")
            .agg(F.array_sort(F.collect_list(F.struct("bucket", "entries"))).alias("b"))
            .select(F.transform("b", lambda x: x["entries"]).alias("buckets"), F.lit(size).alias("n_buckets")))


def _hits(tokens: Column, target: Column, buckets: Column, size: Column) -> Column:
    """The rules that fit, as sortable structs: host rules first, then longer ones, then allow."""
    bucket = F.transform(tokens, lambda t: F.filter(
        F.coalesce(F.get(buckets, F.pmod(F.xxhash64(t), size).cast("int")), F.array()),
        lambda e: e["token"] == t))
    fits = F.filter(F.flatten(bucket), lambda e: F.regexp_like(target, e["regex"]))
    return F.transform(fits, lambda e: F.struct(
        (F.instr(e["rule"], "*") == 0).alias("by_host"), F.length(e["rule"]).alias("length"),
        (e["verdict"] == "allow").alias("allow"), e["rule"].alias("rule"), e["verdict"].alias("verdict")))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], keys: Sequence[str] = ("page_id",),
                url: str = "url", default: str = "allow") -> DataFrame:
    """``keys``, host, path, rule (the host rule that decided, else null), pattern
    (the glob that decided, else null) and verdict of every row of ``pages``."""
    if clash := {"host", "path", "rule", "pattern", "verdict"} & {k.lower() for k in keys}:
        raise ValueError(f"a key has the name of a result column: {', '.join(sorted(clash))}")
    host, path = host_and_path(F.col(url))
    out = pages.select(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)], host.alias("host"), path.alias("path"))
    out = out.withColumn("target", F.concat("host", "path"))
    best = []
    for k in range(0, len(rules), RULES_PER_BLOCK):
        index = _index(out, rules[k:k + RULES_PER_BLOCK])
        out = (out.crossJoin(F.broadcast(index))
               .withColumn(f"best_{len(best)}", F.array_max(_hits(_tokens(F.col("target")), F.col("target"),
                                                                  F.col("buckets"), F.col("n_buckets"))))
               .drop("buckets", "n_buckets"))
        best.append(F.col(f"best_{len(best)}"))
    if best:
        won = F.greatest(*best) if len(best) > 1 else best[0]
    else:
        won = F.lit(None).cast("struct<by_host:boolean,length:int,allow:boolean,rule:string,verdict:string>")
    out = out.withColumn("won", won)
    return out.select(*[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)], "host", "path",
                      F.when(F.col("won.by_host"), F.col("won.rule")).alias("rule"),
                      F.when(~F.col("won.by_host"), F.col("won.rule")).alias("pattern"),
                      F.coalesce(F.col("won.verdict"), F.lit(default)).alias("verdict"))
