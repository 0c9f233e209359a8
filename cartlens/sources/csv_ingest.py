"""CSV sources and sinks for the shop entities.

The typed scan reads every column as a string by header name (never by
position), maps the NA tokens to null, renames dotted/camelCase headers,
then converts each declared column with the strict or coercing parser.
Columns not declared in :data:`cartlens.schema.ENTITY_COLUMNS` stay strings
under a rule-derived name. A file is split by size and scanned in parallel; for
the entities with free text, whose quoted fields may hold line breaks, by
:mod:`cartlens.sources.quoted_csv`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions.parse import (TimestampForm, na_to_null, parse_boolean, parse_double, parse_integer,
                                      parse_ts_coerce, parse_ts_strict, timestamp_form)
from cartlens.schema import ENTITY_COLUMNS, FREE_TEXT_ENTITIES, PATTERN_COLUMNS
from cartlens.sources.quoted_csv import read_quoted_csv

_CSV_OPTIONS = {"header": "true", "inferSchema": "false", "escape": '"', "mode": "FAILFAST"}


def spark_name(header: str) -> str:
    """``user.uid`` -> ``user_uid``; ``createdAtTime`` -> ``created_at_time``."""
    for _, pattern, name, _ in PATTERN_COLUMNS:
        if re.fullmatch(pattern, header):
            return name
    s = header.replace(".", "_")
    s = re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", s)
    return s.lower()


#: Where a row stands in the files it was read from.
POSITION = "_position"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False, position: bool = False) -> DataFrame:
    """A2: every column a string; an empty field stays ``''`` (nothing is null). ``multi_line``: quoted
    fields may hold line breaks. With ``position``, ``_position`` orders the rows by file and offset."""
    df = spark.read.options(**_CSV_OPTIONS, multiLine=str(multi_line).lower()).csv(path)
    columns = df.columns
    if multi_line:
        df = read_quoted_csv(spark, path, columns).withColumnRenamed("position", POSITION)
    elif position:
        df = df.withColumn(POSITION, F.struct("_metadata.file_path", "_metadata.file_block_start",
                                              F.monotonically_increasing_id().alias("nth")))
    # The CSV reader returns null for an unquoted empty field; in a raw string
    # scan an empty field is the empty string.
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns], *[POSITION] * position)


def _convert(col, kind: str, name: str, ts_format: str | TimestampForm | None):
    if kind == "boolean":
        return parse_boolean(col, name)
    if kind == "integer":
        return parse_integer(col, name)
    if kind == "double":
        return parse_double(col, name)
    if kind == "ts_strict":
        return parse_ts_strict(col, ts_format, name)
    if kind == "ts_coerce":
        return parse_ts_coerce(col, ts_format)
    return col


def first_forms(raw: DataFrame, headers: list[str], position: Column | None = None) -> dict[str, TimestampForm | None]:
    """The form of each column's first value that is not missing, by ``position`` (else in the order of the
    partitions): one pass for all columns, one value of each reaches the driver."""
    if not headers:
        return {}
    at = F.monotonically_increasing_id() if position is None else position
    rows = raw.select(at.alias("at"), *[na_to_null(F.col(f"`{h}`")).alias(f"c{i}") for i, h in enumerate(headers)])
    first = rows.agg(*[F.min(F.when(F.col(f"c{i}").isNotNull(), F.struct("at", F.col(f"c{i}").alias("v")))).alias(f"c{i}")
                       for i in range(len(headers))]).first()
    return {h: timestamp_form(first[f"c{i}"]["v"]) if first[f"c{i}"] else None for i, h in enumerate(headers)}


def typed_from_raw(raw: DataFrame, entity: str, ts_format: str | None = None,
                   key_types: dict[str, str] | None = None) -> DataFrame:
    """A1 + A3-A7 on an all-string frame whose columns are the CSV headers. With ``ts_format``
    ``infer``, each timestamp column has the form of its first value, and values in
    another form become null (or raise, in a strict column)."""
    declared = {src: (dst, kind) for src, dst, kind in ENTITY_COLUMNS[entity]}
    sources = [c for c in raw.columns if c != POSITION]
    timed = [c for c in sources if declared.get(c, ("", ""))[1].startswith("ts_")]
    forms = first_forms(raw, timed, F.col(POSITION) if POSITION in raw.columns else None) if ts_format == "infer" else {}
    out = []
    for src in sources:
        dst, kind = declared.get(src, (spark_name(src), "string"))
        c = _convert(na_to_null(F.col(f"`{src}`")), kind, src, forms.get(src) if ts_format == "infer" else ts_format)
        if key_types and dst in key_types:
            c = c.cast(key_types[dst])
        out.append(c.alias(dst))
    return raw.select(*out)


def read_typed_csv(spark: SparkSession, path: str, entity: str, ts_format: str | None = None,
                   key_types: dict[str, str] | None = None) -> DataFrame:
    """A1: typed scan of one entity's CSV."""
    raw = read_raw_csv(spark, path, entity in FREE_TEXT_ENTITIES, position=ts_format == "infer")
    return typed_from_raw(raw, entity, ts_format, key_types)


def write_csv(df: DataFrame, path: str, headers: dict[str, str] | None = None) -> None:
    """A10 (and test fixtures): header CSV, columns renamed to ``headers``."""
    headers = headers or {}
    out = df.select(*[F.col(f"`{c}`").alias(headers.get(c, c)) for c in df.columns])
    (out.write.mode("overwrite")
     .options(header="true", escape='"', quoteAll="true",
              timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
     .csv(path))


def source_headers(entity: str) -> dict[str, str]:
    """Spark name -> CSV header for an entity (inverse of the ingest rename)."""
    return {dst: src for src, dst, _ in ENTITY_COLUMNS[entity]}
