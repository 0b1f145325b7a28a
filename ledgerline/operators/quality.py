"""Data-quality checks re-aimed from declared table constraints (DQ-1..4).

The source declares primary keys, foreign keys, NOT NULL and defaults in
DDL; a warehouse on Parquet does not enforce them, so a Spark user runs them
as checks on load. Each check is one aggregate or one join: no row is
pulled to the driver.
"""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import missing_from


def pk_violations(df: DataFrame, keys: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """DQ-1: key values held by more than one row, or with a NULL part.

    A partial aggregate per task counts rows per key before the shuffle, so a
    heavily repeated key costs one row per task, not one row per copy.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
              .where((F.col(count_name) > 1) | any_null))


def fk_orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """DQ-2: fact rows whose non-NULL foreign key has no row in the dimension."""
    rows = fact.where(F.col(fk).isNotNull())
    out = missing_from(rows, dim, fk, pk)
    return out if columns is None else out.select(*columns)


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-3: number of NULLs per NOT NULL column, in one pass.

    Output: column_name, null_rows (one row per column, zeros included).
    """
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, null_rows)")


def fill_defaults(df: DataFrame, defaults: Mapping[str, object],
                  load_time: _dt.datetime | Column | None = None,
                  audit_columns: Sequence[str] = ()) -> DataFrame:
    """DQ-4: column defaults on load.

    ``defaults`` replaces NULLs with a constant; ``audit_columns`` (such as
    created_at / updated_at) are stamped with ``load_time``, or with the
    current timestamp when no load time is given.
    """
    stamp = (F.current_timestamp() if load_time is None
             else load_time if isinstance(load_time, Column) else F.lit(load_time))
    cols = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    cols.update({c: F.coalesce(F.col(c), stamp) if c in df.columns else stamp
                 for c in audit_columns})
    return df.withColumns(cols)
