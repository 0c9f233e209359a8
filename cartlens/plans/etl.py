"""Raw entities -> clean, repaired entities (the reference's ETL notebook).

Dependency order: users -> profiles, cards, orders; repaired orders -> order
details. Each step is a lazy DataFrame; ``write_clean_tables`` is the action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlens.functions.text import (canonical_sex, clean_str, normalize_label,
                                     normalize_whitespace, parse_list_string)
from cartlens.operators import repair
from cartlens.schema import CARD_NOT_ASSIGNED, ITEM_STATUSES
from cartlens.sources import shop_tables as st
from cartlens.sources import versions


def clean_users(raw: DataFrame) -> DataFrame:
    out = raw.withColumn("city", clean_str("city", "lower"))
    for c in ("referral_medium", "referral_source"):
        if c in raw.columns:
            out = out.withColumn(c, clean_str(c, "lower"))
    if "favourite_zones" in raw.columns:
        out = out.withColumn("favourite_zones", parse_list_string("favourite_zones"))
    return out


def clean_profiles(raw: DataFrame, users: DataFrame) -> DataFrame:
    out = (raw.withColumn("sex", canonical_sex("sex"))
           .withColumn("city", clean_str("city", "lower")))
    if "types" in raw.columns:
        out = out.withColumn("types", parse_list_string("types"))
    return repair.fk_keep_null(out, users, "user_uid", "user_uid")


def clean_cards(raw: DataFrame, users: DataFrame, tiebreak: str = "event_id") -> DataFrame:
    out = raw.withColumn("status", clean_str("status", "lower"))
    out = repair.latest_per_key(out, "card_uid", "assigned_at", tiebreak)
    out = repair.fk_conditional(out, users, "user_uid", "user_uid", "status", CARD_NOT_ASSIGNED)
    return repair.drop_empty_rows(out, "status", CARD_NOT_ASSIGNED, "user_uid",
                                  ["assigned_at", "birthday"])


def clean_orders(raw: DataFrame, users: DataFrame) -> DataFrame:
    out = raw
    for c in ("payment_gateway", "payment_brand", "source"):
        if c in raw.columns:
            out = out.withColumn(c, clean_str(c, "lower"))
    return repair.fk_strict(out, users, "user_uid", "user_uid")


def clean_order_details(raw: DataFrame, orders: DataFrame) -> DataFrame:
    out = raw.withColumn("item_status", clean_str("item_status", "lower"))
    for c in ("product_type", "item_zone_name"):
        if c in raw.columns:
            out = out.withColumn(c, clean_str(c, "lower"))
    out = repair.domain_filter(out, "item_status", ITEM_STATUSES)
    out = repair.fk_strict(out, orders, "order_uid", "order_uid")
    return repair.non_negative(out, "item_amount")


def clean_reviews(raw: DataFrame) -> DataFrame:
    return raw.withColumn("text", normalize_whitespace("text"))


def clean_reviews_labelled(raw: DataFrame) -> DataFrame:
    return (raw.withColumn("text", normalize_whitespace("text"))
            .withColumn("sentiment_label", normalize_label("sentiment_label")))


class _Tables(dict):
    """Entity name -> DataFrame, built on first access (in dependency order)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, name):
        df = self._builders[name](self)
        self[name] = df
        return df

    def __contains__(self, name):
        return name in self._builders

    def keys(self):
        return self._builders.keys()

    def items(self):
        return [(n, self[n]) for n in self._builders]


def clean_tables(raw) -> dict[str, DataFrame]:
    """Clean entities of ``raw`` (a dict or a lazy table map) in dependency order.

    The result is lazy: an entity and its dependencies are built when first
    used, so a query touching two entities plans only those.
    """
    b = {
        "users": lambda t: clean_users(raw["users"]),
        "profiles": lambda t: clean_profiles(raw["profiles"], t["users"]),
        "cards": lambda t: clean_cards(raw["cards"], t["users"]),
        "orders": lambda t: clean_orders(raw["orders"], t["users"]),
        "order_details": lambda t: clean_order_details(raw["order_details"], t["orders"]),
        "reviews": lambda t: clean_reviews(raw["reviews"]),
        "reviews_labelled": lambda t: clean_reviews_labelled(raw["reviews_labelled"]),
    }
    return _Tables({k: v for k, v in b.items() if k in raw})


def shop_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw shop entities over the supplied test tables (built on first access)."""
    return _Tables({
        "users": lambda t: st.raw_users(spark, sf_dir),
        "profiles": lambda t: st.raw_profiles(spark, sf_dir),
        "cards": lambda t: st.raw_cards(spark, sf_dir),
        "orders": lambda t: st.raw_orders(spark, sf_dir),
        "order_details": lambda t: st.raw_order_details(spark, sf_dir),
        "reviews": lambda t: st.raw_reviews(spark, sf_dir),
        "reviews_labelled": lambda t: st.raw_reviews_labelled(spark, sf_dir),
    })


def shop_clean(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Clean shop entities over the supplied test tables (lazy)."""
    return clean_tables(shop_raw(spark, sf_dir))


def write_clean_tables(tables: dict[str, DataFrame], out_dir: str) -> None:
    """One Parquet table per entity, all replaced at once when the last is complete."""
    versions.write_set(dict(tables.items()), out_dir)


def read_clean_tables(spark: SparkSession, in_dir: str, names: list[str]) -> dict[str, DataFrame]:
    """Load persisted clean tables."""
    return versions.read_set(spark, in_dir, names)


def with_product_type(details: DataFrame, products: DataFrame) -> DataFrame:
    """Attach ``product_type`` from the product dimension (left join on product)."""
    return details.join(products.select("product_uid", "product_type"), "product_uid", "left")



def read_shop_csv(spark: SparkSession, in_dir: str, ts_format: str | None = None,
                  key_types: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Typed scan of the seven entity CSVs under ``in_dir/<entity>``."""
    from cartlens.sources.csv_ingest import read_typed_csv
    names = ["users", "profiles", "cards", "orders", "order_details", "reviews", "reviews_labelled"]
    return {n: read_typed_csv(spark, f"{in_dir}/{n}", n, ts_format, key_types) for n in names}


def run_etl(spark: SparkSession, in_dir: str, out_dir: str, ts_format: str | None = None,
            key_types: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """CSV -> typed -> cleaned and repaired -> one Parquet table per entity.

    Returns the persisted tables read back (A9), so later steps start from
    the written copy rather than re-running the cleaning lineage.
    """
    raw = read_shop_csv(spark, in_dir, ts_format, key_types)
    cards = raw["cards"]
    own_order = "event_id" in cards.columns
    if not own_order:
        # The latest-row rule needs a tie-break that does not change with the split of the files:
        # the whole row's text.
        raw["cards"] = cards.withColumn("event_id", F.to_json(F.struct(*[F.col(c) for c in cards.columns])))
    clean = clean_tables(raw)
    if not own_order:
        clean["cards"] = clean["cards"].drop("event_id")
    write_clean_tables(clean, out_dir)
    return read_clean_tables(spark, out_dir, list(clean.keys()))
