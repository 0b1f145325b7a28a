"""Extraction from the operational database and landing as Parquet.

SRC-1..7 and SNK-1..3. The source pulls a table or query through one
cursor in 50 000-row chunks into one file. Here the read is a DataFrame:
over JDBC the column list and the ``where`` filter are pushed into the
database query, the read is split into parallel range or predicate
partitions (by ``modified`` unless told otherwise), and the write is a
parallel Parquet dataset under a dated partition directory. No chunk loop
runs in Python.
"""

from __future__ import annotations

import datetime as dt
import decimal
import logging
import os
import re
from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import union_all

log = logging.getLogger(__name__)

DEFAULT_FETCHSIZE = 50_000
SPLIT_COLUMN = "modified"
SPLIT_FROM = "2015-01-01"


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------

@dataclass
class JdbcSource:
    """SRC-7: connection settings of the operational (MariaDB/MySQL) database.

    The url has the ``mysql`` scheme, which selects Spark's MySQL dialect
    (column names in back quotes); Spark has none for ``mariadb`` and would
    quote names with double quotes, which the database reads as strings. The
    MariaDB driver accepts the scheme with ``permitMysqlScheme``; with MySQL's
    own driver a cursor is needed for ``fetchsize`` to bound memory.
    """

    host: str
    user: str
    password: str = field(repr=False)
    port: int = 3306
    database: str = "erpnext"
    driver: str = "org.mariadb.jdbc.Driver"
    fetchsize: int = DEFAULT_FETCHSIZE
    extra: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls, prefix: str = "ERP_DB_", environ: Mapping[str, str] | None = None
                 ) -> "JdbcSource":
        """Settings from ``{prefix}HOST``, ``USER``, ``PASSWORD`` (required),
        ``PORT`` (default 3306) and ``NAME`` (default ``erpnext``)."""
        env = os.environ if environ is None else environ
        return cls(host=env[f"{prefix}HOST"], user=env[f"{prefix}USER"],
                   password=env[f"{prefix}PASSWORD"],
                   port=int(env.get(f"{prefix}PORT", 3306)),
                   database=env.get(f"{prefix}NAME", "erpnext"))

    @property
    def url(self) -> str:
        flag = "permitMysqlScheme" if "mariadb" in self.driver else "useCursorFetch=true"
        return f"jdbc:mysql://{self.host}:{self.port}/{self.database}?{flag}"

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "user": self.user,
                "password": self.password, "fetchsize": str(self.fetchsize), **self.extra}


@dataclass
class ParquetSource:
    """Operational tables already exported as one Parquet dataset per table."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def quote_table(table: str) -> str:
    """Back-quoted table name (ERP table names contain spaces)."""
    return "`" + table.replace("`", "``") + "`"


def _predicate_read(spark: SparkSession, source: JdbcSource, table: str,
                    predicates: Sequence[str]) -> DataFrame:
    props = {k: v for k, v in source.options().items() if k != "url"}
    return spark.read.jdbc(source.url, table, predicates=list(predicates), properties=props)


def read_table(spark: SparkSession, source: JdbcSource | ParquetSource, table: str,
               columns: Sequence[str] | None = None, where: str | Column | None = None,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None,
               predicates: Sequence[str] | None = None,
               split_column: str | None = SPLIT_COLUMN, split_from: str = SPLIT_FROM,
               split_to: str | None = None, splits: int | None = None,
               split_by: Sequence[str] | None = None) -> DataFrame:
    """SRC-1..4, SRC-6: read a whole table, some columns, or some rows.

    ``columns`` and ``where`` are applied on the DataFrame; the JDBC and
    Parquet sources push both into the scan (``ReadSchema`` /
    ``PushedFilters``). A JDBC read is always split: by a numeric/date
    ``partition_column`` with bounds and a number of partitions, by explicit
    ``predicates`` (one partition each), into ``splits`` parts of equal row
    count over the columns ``split_by`` (see ``splits``; a text ``where`` is
    respected), or by default by months of ``split_column``, rows without one
    included. A table that offers none of these is refused instead of being
    read through one cursor.
    """
    if isinstance(source, ParquetSource):
        df = spark.read.parquet(source.path(table))
    elif partition_column is not None:
        if num_partitions is None or lower_bound is None or upper_bound is None:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        df = (spark.read.format("jdbc").options(**source.options())
              .option("dbtable", quote_table(table)).option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions)).load())
    else:
        if not predicates and splits is not None:
            from .splits import plan_splits

            predicates = plan_splits(spark, source, quote_table(table),
                                     split_by or [split_column or SPLIT_COLUMN], splits,
                                     where if isinstance(where, str) else None)
        if not predicates and split_column is None:
            raise ValueError(f"{table}: name a split_column, a partition_column or predicates")
        df = _predicate_read(spark, source, quote_table(table), predicates or modified_ranges(
            split_from, split_to or dt.date.today().isoformat(), column=split_column))
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*[F.col(quote_table(c)) for c in columns])
    return df


def sql_literal(value) -> str:
    """A Python value as a MySQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"'{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"'{value.isoformat()}'"
    if isinstance(value, (list, tuple)):
        return "(" + ", ".join(sql_literal(v) for v in value) + ")"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"
    raise TypeError(f"no literal for {type(value).__name__}")


# Quoted texts and names are passed over; ``:name`` elsewhere is a parameter.
_PARAMETER = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|:([A-Za-z_]\w*)")


def bind_parameters(query: str, params: Mapping[str, object]) -> str:
    """``query`` with its ``:name`` parameters replaced by literals."""
    def value(m: re.Match) -> str:
        return m[0] if m[1] is None else sql_literal(params[m[1]])
    return _PARAMETER.sub(value, query)


def read_query(spark: SparkSession, source: JdbcSource | None, query: str,
               params: Mapping[str, object] | None = None,
               predicates: Sequence[str] | None = None) -> DataFrame:
    """SRC-5: an arbitrary query with ``:name`` bind parameters.

    Over JDBC the query runs in the database, parameters bound as literals;
    ``predicates`` over its result columns split the read, one task each (the
    database runs the query once for each of them).
    With ``source=None`` it runs over registered views, bound by Spark.
    """
    if source is None:
        args = dict(params or {})
        parts = [spark.sql(f"SELECT * FROM ({query}) AS q WHERE {p}", args=args) for p in predicates or ()]
        return union_all(parts) if parts else spark.sql(query, args=args)
    bound = bind_parameters(query, params or {})
    if predicates:
        return _predicate_read(spark, source, f"({bound}) AS q", predicates)
    return spark.read.format("jdbc").options(**source.options()).option("query", bound).load()


def modified_ranges(start: str, end: str, months: int = 1, column: str = SPLIT_COLUMN) -> list[str]:
    """Predicates splitting a timestamp into month ranges (half-open), with
    everything before, after and without a timestamp."""
    s = dt.date.fromisoformat(start).replace(day=1)
    e = dt.date.fromisoformat(end)
    name = quote_table(column)
    out = [f"{name} < '{s.isoformat()}' OR {name} IS NULL"]
    while s <= e:
        y, m = divmod(s.month - 1 + months, 12)
        nxt = dt.date(s.year + y, m + 1, 1)
        out.append(f"{name} >= '{s.isoformat()}' AND {name} < '{nxt.isoformat()}'")
        s = nxt
    out.append(f"{name} >= '{s.isoformat()}'")
    return out


# ---------------------------------------------------------------------------
# Landing (sinks)
# ---------------------------------------------------------------------------

def safe_table_name(table: str) -> str:
    """Lower case with spaces as underscores (``tabSales Invoice`` ->
    ``tabsales_invoice``)."""
    return table.replace(" ", "_").lower()


def landing_path(output_dir: str, table: str, ds: str | None = None) -> str:
    """SNK-2: ``{output_dir}/{safe table}/ds={ds or manual_run}``."""
    return f"{output_dir.rstrip('/')}/{safe_table_name(table)}/ds={ds or 'manual_run'}"


def write_parquet(df: DataFrame, path: str, compression: str = "snappy",
                  mode: str = "overwrite", partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = (), max_rows_per_file: int | None = None,
                  replace_partitions: bool = False,
                  also: Mapping[str, Column] | None = None) -> int | dict:
    """SNK-1 / SNK-3: write a Parquet dataset and return its row count.

    The count is an ``Observation`` collected by the write itself (no second
    pass). An empty result still writes a schema-bearing dataset and logs a
    warning. ``replace_partitions`` overwrites only the partitions present in
    ``df`` (dynamic partition overwrite), so re-running a load is idempotent.
    With ``also`` (named aggregates over the rows) the write observes these too
    and returns everything observed, the count as ``rows``.
    """
    obs = Observation("rows_written")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                          *[c.alias(n) for n, c in (also or {}).items()])
    if sort_within:
        observed = observed.sortWithinPartitions(*sort_within)
    writer = observed.write.mode(mode).option("compression", compression)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_rows_per_file))
    if replace_partitions:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    seen = obs.get
    rows = int(seen.get("rows", 0))
    if rows == 0:
        log.warning("no rows written to %s", path)
    else:
        log.info("wrote %s rows to %s", rows, path)
    return {**{n: seen.get(n) for n in also}, "rows": rows} if also else rows


def extract_query_to_landing(spark: SparkSession, source: JdbcSource | None, query: str,
                             output_path: str, params: Mapping[str, object] | None = None,
                             compression: str = "snappy",
                             predicates: Sequence[str] | None = None,
                             split_by: Sequence[str] | None = None,
                             splits: int | None = None) -> tuple[str, int]:
    """SRC-5 + SNK-1/3: land the result of an arbitrary query; returns
    (path, rows written). An empty result still leaves a readable dataset.

    The read is split by ``predicates`` over the result's columns, or into
    ``splits`` parts of equal row count over the columns ``split_by``: the
    bounds come from the query's own result and are pushed as predicates. A row
    that changes between the parts' queries is read as each of them finds it.
    """
    if not predicates and splits is not None:
        from .splits import plan_splits

        if not split_by:
            raise ValueError("name the columns to split the result by")
        predicates = plan_splits(spark, source, f"({bind_parameters(query, params or {})}) AS q",
                                 split_by, splits)
    df = read_query(spark, source, query, params, predicates)
    return output_path, write_parquet(df, output_path, compression=compression)


def extract_to_landing(spark: SparkSession, source: JdbcSource | ParquetSource, table: str,
                       output_dir: str, ds: str | None = None,
                       columns: Sequence[str] | None = None,
                       where: str | Column | None = None,
                       compression: str = "snappy", **read_options) -> tuple[str, int]:
    """SRC-1..4 + SNK-1..3: land one table (or its increment) under a dated
    path; returns (path, rows written)."""
    df = read_table(spark, source, table, columns=columns, where=where, **read_options)
    path = landing_path(output_dir, table, ds)
    return path, write_parquet(df, path, compression=compression)


def laid_out(df: DataFrame, layout: tuple[str, Sequence[str]] | None
             ) -> tuple[DataFrame, list[str]]:
    """A table dealt for its landing, and the columns to sort its files by.

    * ``("range", columns)``: range-partitioned and sorted on the columns (a
      date, then a unique name), so every file covers a contiguous date range
      and a period filter skips whole files and row groups through the Parquet
      min/max statistics; the unique second column lets a very busy day be
      split over several partitions instead of landing in one task;
    * ``("spread", ())``: rebalanced, so files are even whatever the key
      distribution (a document with a third of all lines does not make one
      task write a third of the table);
    * none: written as it comes.

    No number of partitions is given: adaptive execution sizes them by the
    data.
    """
    kind, cols = layout or (None, ())
    if kind == "range":
        return df.repartitionByRange(*cols), list(cols)
    if kind == "spread":
        return df.hint("rebalance"), []
    return df, []


def land_tables(tables, root: str, names: Sequence[str], parallel: int = 8,
                layout: Mapping[str, tuple[str, Sequence[str]]] | None = None,
                max_rows_per_file: int = 20_000_000) -> dict[str, int]:
    """Land several derived tables (``tables.<name>``) under ``root/<name>``
    with their ``layout`` (see ``laid_out``); returns the rows of each.

    Files are capped at ``max_rows_per_file`` rows. The writes are independent
    Spark jobs, submitted a few at a time from driver threads so small tables
    do not leave executor slots idle.
    """
    from concurrent.futures import ThreadPoolExecutor

    def land(n: str) -> tuple[str, int]:
        df, order = laid_out(getattr(tables, n), (layout or {}).get(n))
        return n, write_parquet(df, f"{root.rstrip('/')}/{n}", sort_within=order,
                                max_rows_per_file=max_rows_per_file)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(land, names))


# ---------------------------------------------------------------------------
# From landed pulls to report tables
# ---------------------------------------------------------------------------

# Source table of every report table.
SOURCE_TABLES = {
    "gl_entry": "tabGL Entry",
    "account": "tabAccount",
    "supplier": "tabSupplier",
    "customer": "tabCustomer",
    "company": "tabCompany",
    "item": "tabItem",
    "party_account": "tabParty Account",
    "sales_invoice": "tabSales Invoice",
    "sales_invoice_item": "tabSales Invoice Item",
    "delivery_note": "tabDelivery Note",
    "sales_team": "tabSales Team",
    "sales_order": "tabSales Order",
    "sales_order_item": "tabSales Order Item",
    "purchase_invoice": "tabPurchase Invoice",
    "purchase_invoice_item": "tabPurchase Invoice Item",
    "journal_entry": "tabJournal Entry",
    "journal_entry_account": "tabJournal Entry Account",
    "payment_entry": "tabPayment Entry",
    "payment_entry_reference": "tabPayment Entry Reference",
}
