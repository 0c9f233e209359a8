"""CSV round trip: raw entities written as header CSV (original header names)
then typed scan + ETL give the same clean tables as the Parquet path."""

import csv
import io
import random
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartlens.functions.parse import parse_ts_coerce, timestamp_form
from cartlens.plans.etl import run_etl, shop_clean, shop_raw
from cartlens.sources import quoted_csv, versions
from cartlens.sources.csv_ingest import read_raw_csv, read_typed_csv, source_headers, spark_name, typed_from_raw, write_csv

from conftest import SMALL

KEYS = {"user_uid": "bigint", "profile_uid": "bigint", "order_uid": "bigint", "item_uid": "int",
        "card_uid": "bigint", "event_id": "bigint", "review_uid": "bigint",
        "labelled_review_uid": "bigint", "product_uid": "bigint"}


def test_spark_name_rule():
    assert spark_name("user.uid") == "user_uid"
    assert spark_name("createdAtTime") == "created_at_time"
    assert spark_name("referral.medium") == "referral_medium"


def test_raw_scan_keeps_empty_strings(spark):
    d = tempfile.mkdtemp(prefix="cartlens-csv-")
    with open(f"{d}/t.csv", "w") as f:
        f.write('a,b\n"",x\n,"NA"\n')
    rows = read_raw_csv(spark, f"{d}/t.csv").collect()
    assert [(r.a, r.b) for r in rows] == [("", "x"), ("", "NA")]


def test_csv_etl_matches_parquet_path(spark):
    src = tempfile.mkdtemp(prefix="cartlens-csv-in-")
    out = tempfile.mkdtemp(prefix="cartlens-csv-out-")
    raw = shop_raw(spark, SMALL)
    for name in raw.keys():
        write_csv(raw[name], f"{src}/{name}", source_headers(name))
    got = run_etl(spark, src, out, key_types=KEYS)
    want = shop_clean(spark, SMALL)
    for name in want.keys():
        w = want[name]
        g = got[name].select(*[F.col(c).cast(w.schema[c].dataType) for c in w.columns])
        assert g.count() == w.count(), name
        assert g.exceptAll(w).count() == 0 and w.exceptAll(g).count() == 0, name


def test_plain_csv_splits_and_free_text_keeps_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n" + "".join(f"{i},x\n" for i in range(40000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        assert read_raw_csv(spark, str(tmp_path / "t.csv")).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "r.csv").write_text('review.uid,user.uid,text\n1,2,"two\nlines"\n')
    assert read_typed_csv(spark, str(tmp_path / "r.csv"), "reviews").first()["text"] == "two\nlines"


def test_card_number_column_is_known_by_its_pattern():
    assert spark_name("item.shopcardNumber") == "item_card_number"


def test_one_timestamp_form_per_column(spark):
    raw = spark.createDataFrame([("1", "2024-01-01", "valid"), ("2", "2024-01-02 10:00:00", "valid"), ("3", "2024-01-03", "x")],
                                "`card.uid` string, assignedAt string, status string")
    got = [r.assigned_at is None for r in typed_from_raw(raw, "cards", "infer").orderBy("card_uid").collect()]
    assert got == [False, True, False]


def messy(n, seed):
    r = random.Random(seed)
    parts = ["plain", "a,b", 'say ""hi""', "two\nlines", "\n", "", ",", '""', "é日本", "\r\nx", "tail ", " lead", '"",""', "x" * 300]
    return [(str(i), str(r.randrange(9)), "".join(r.choice(parts) for _ in range(r.randrange(5)))) for i in range(n)]


@pytest.mark.parametrize("split", [83, 1000, 1 << 20])
def test_quoted_csv_is_the_same_for_any_split(spark, tmp_path, split):
    """One file with line breaks in quotes, cut at any byte: the csv module's rows."""
    rows = messy(120, split)
    body = "".join(f'{a},{b},"{t}"\n' + "\n" * (i % 7 == 0) for i, (a, b, t) in enumerate(rows))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_bytes(("review.uid,user.uid,text\n" + body).encode())
    (tmp_path / "in" / "two.csv").write_bytes(b'review.uid,user.uid,text\r\nz1,1,"a\r\nb"\r\nz2,,no quotes')
    want = {tuple(x) for x in csv.reader(io.StringIO(body, newline="")) if x} | {("z1", "1", "a\r\nb"), ("z2", "", "no quotes")}
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        raw = read_raw_csv(spark, str(tmp_path / "in"), multi_line=True, position=True)
        got = raw.orderBy("_position").collect()
        lines = quoted_csv._lines(spark, str(tmp_path / "in"))
        assert lines.rdd.getNumPartitions() > (8 if split < 1000 else 3 if split == 1000 else 1)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {(r["review.uid"], r["user.uid"], r["text"]) for r in got} == want and len(got) == len(rows) + 2
    assert [r["review.uid"] for r in got] == [a for a, _, _ in rows] + ["z1", "z2"]


def test_lines_carry_a_number_in_place_of_their_file():
    """Records and fragments of two ranges, a batch at a time: a line travels with its range's number only."""
    def batch(number, odd, lines):
        return pa.record_batch([pa.array([number] * len(lines), pa.int64()), pa.array([odd] * len(lines)), pa.array(lines)], names=["range", "odd", "line"])
    batches = [batch(7, True, ['end"', '1,"a']), batch(7, True, ["", "b"]), batch(7, True, ['c"', '2,x', '3,"open']), batch(9, True, ["still", "in"])]
    got = [tuple(x.values()) for b in quoted_csv._join_lines(iter(batches)) for x in b.to_pylist()]
    assert got == [(7, 0, quoted_csv.TAIL, 'end"'), (7, 1, quoted_csv.WHOLE, '1,"a\n\nb\nc"'), (7, 2, quoted_csv.WHOLE, "2,x"),
                   (7, 3, quoted_csv.HEAD, '3,"open'), (9, 0, quoted_csv.MIDDLE, "still\nin")]


def test_quoted_csv_refuses_an_open_quote(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="odd number of quotes"):
        quoted_csv.read_records(spark, str(tmp_path / "bad.csv"))


def test_timestamp_forms(spark):
    values = ["2024-01-31", "2024-01-31 10:11:12", "2024-01-31T10:11:12", "2024-01-31 10:11", "2024-01-31 10:11:12.250",
              "31/01/2024", "01/31/2024", "31/01/2024 10:11", "01/31/2024T10:11:12", "2024", "soon", "99/99/2024"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for v in values[:9]:
        got = {r[0] for r in df.where(parse_ts_coerce("v", timestamp_form(v)).isNotNull()).collect()}
        assert got == {v}, v
    assert timestamp_form("2024") is None and timestamp_form("soon") is None


def test_first_form_is_the_earliest_by_file_and_offset(spark, tmp_path):
    (tmp_path / "b.csv").write_text("card.uid,assignedAt,birthday\n1,2024-01-01,\n2,2024-01-02 10:00:00,01/02/1990\n")
    (tmp_path / "a.csv").write_text("card.uid,assignedAt,birthday\n3,NaN,\n4,2024-01-03 10:00:00,\n5,2024-01-04,25/02/1990\n")
    got = {r.card_uid: (r.assigned_at is not None, r.birthday is not None)
           for r in read_typed_csv(spark, str(tmp_path), "cards", "infer").collect()}
    assert got == {"1": (False, False), "2": (True, True), "3": (False, False), "4": (True, False), "5": (False, True)}


def test_a_failed_write_leaves_the_old_tables(spark, tmp_path):
    folder = str(tmp_path / "clean")
    with pytest.raises(versions.NoTables):
        versions.read_set(spark, folder)
    one = {"a": spark.range(3), "b": spark.range(4)}
    versions.write_set(one, folder)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        versions.write_set({"a": spark.range(9), "b": broken}, folder)
    assert {n: t.count() for n, t in versions.read_set(spark, folder).items()} == {"a": 3, "b": 4}
    versions.write_set({"a": spark.range(9)}, folder)
    assert {n: t.count() for n, t in versions.read_set(spark, folder).items()} == {"a": 9}
    with pytest.raises(versions.NoTables):
        versions.read_set(spark, folder, ["b"])
    assert versions.drop_old(spark, folder) == 2 and versions.read_set(spark, folder, ["a"])["a"].count() == 9
