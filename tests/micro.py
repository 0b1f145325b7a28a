"""Hand-made micro tables with the ERP table schemas of the test bed."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.sources.testbed import ERP_TABLES, landed_testbed

SCHEMA_SF = "/root/testdata/sf0.001"


def schemas(spark: SparkSession) -> dict[str, T.StructType]:
    t = landed_testbed(spark, SCHEMA_SF)
    return {n: getattr(t, n).schema for n in ERP_TABLES}


def _coerce(v, dtype):
    if v is None:
        return None
    if isinstance(dtype, T.DecimalType):
        return Decimal(str(v))
    if isinstance(dtype, T.DateType) and isinstance(v, str):
        return dt.date.fromisoformat(v)
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        return int(v)
    return v


def table(spark: SparkSession, schema: T.StructType, rows: list[dict]) -> DataFrame:
    data = [tuple(_coerce(r.get(f.name), f.dataType) for f in schema.fields) for r in rows]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(data, nullable)


def tables(spark: SparkSession, **rows: list[dict]) -> SimpleNamespace:
    """A namespace with every ERP table; tables not given are empty."""
    sch = schemas(spark)
    return SimpleNamespace(**{n: table(spark, sch[n], rows.get(n, [])) for n in ERP_TABLES})
