"""Star-schema tables for purchases and visits (CAT-1) and their checks.

The DDL of the source declares five tables with keys, defaults and NOT NULL
columns. Parquet tables do not enforce constraints, so the constraints are
kept here as data: ``KEYS``, ``FOREIGN_KEYS``, ``NOT_NULL`` and ``DEFAULTS``
drive the checks of ``operators.quality`` (DQ-1..4) when a table is loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .operators import quality

_AUDIT = [T.StructField("created_at", T.TimestampType()),
          T.StructField("updated_at", T.TimestampType())]

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.IntegerType(), False),
    T.StructField("customer_name", T.StringType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("email_address", T.StringType()),
    T.StructField("country", T.StringType()),
    *_AUDIT])

PRODUCTS = T.StructType([
    T.StructField("product_sku", T.IntegerType(), False),
    T.StructField("product_name", T.StringType()),
    T.StructField("unit_price", T.DoubleType()),
    *_AUDIT])

CHANNELS = T.StructType([
    T.StructField("channel_id", T.IntegerType(), False),
    T.StructField("channel_name", T.StringType()),
    *_AUDIT])

PURCHASE_HISTORY = T.StructType([
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("product_sku", T.IntegerType()),
    T.StructField("channel_id", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("order_date", T.TimestampNTZType(), False),
    *_AUDIT])

VISIT_HISTORY = T.StructType([
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("channel_id", T.IntegerType()),
    T.StructField("visit_timestamp", T.TimestampType(), False),
    T.StructField("bounce_timestamp", T.TimestampType()),
    *_AUDIT])

TABLES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "channels": CHANNELS,
    "purchase_history": PURCHASE_HISTORY,
    "visit_history": VISIT_HISTORY,
}

KEYS = {"customers": ["customer_id"], "products": ["product_sku"], "channels": ["channel_id"]}

FOREIGN_KEYS = {
    "purchase_history": [("channel_id", "channels", "channel_id"),
                         ("customer_id", "customers", "customer_id"),
                         ("product_sku", "products", "product_sku")],
    "visit_history": [("channel_id", "channels", "channel_id"),
                      ("customer_id", "customers", "customer_id")],
}

NOT_NULL = {"purchase_history": ["order_date"], "visit_history": ["visit_timestamp"]}

DEFAULTS = {"purchase_history": {"discount": 0.0}}

# Columns stamped with the load time when missing; ``visit_timestamp``
# defaults to the time of the insert.
AUDIT_COLUMNS = {name: ["created_at", "updated_at"] for name in TABLES}
AUDIT_COLUMNS["visit_history"] = ["visit_timestamp", "created_at", "updated_at"]


def create_tables(spark: SparkSession, location: str, database: str | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION`` for all five,
    in ``database`` or the current one."""
    qualified = f"`{database}`." if database else ""
    created = []
    for name, schema in TABLES.items():
        cols = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified}{name} ({cols}) USING parquet "
                  f"LOCATION '{location.rstrip('/')}/{name}'")
        created.append(name)
    return created


def load_checks(name: str, df: DataFrame, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """DQ-1..3 for one table: key violations, orphans per foreign key, NULLs."""
    out: dict[str, DataFrame] = {}
    if name in KEYS:
        out["pk_violations"] = quality.pk_violations(df, KEYS[name])
    for fk, dim, pk in FOREIGN_KEYS.get(name, []):
        if dim in dims:
            out[f"fk_orphans:{fk}"] = quality.fk_orphans(df, fk, dims[dim], pk)
    if name in NOT_NULL:
        out["not_null_violations"] = quality.not_null_violations(df, NOT_NULL[name])
    return out


def with_defaults(name: str, df: DataFrame, load_time=None) -> DataFrame:
    """DQ-4: defaults and audit stamps of one table."""
    return quality.fill_defaults(df, DEFAULTS.get(name, {}), load_time=load_time,
                                 audit_columns=AUDIT_COLUMNS.get(name, []))
