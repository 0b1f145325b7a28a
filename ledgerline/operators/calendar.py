"""SET-3: the calendar of one month, one row per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import DateLike, date_lit


def month_calendar(spark: SparkSession, day: DateLike) -> DataFrame:
    """Every date from the first to the last day of ``day``'s month.

    The recursive CTE of the source (``d -> d + 1 day`` until month end) is a
    ``sequence`` exploded on one row: 28 to 31 rows, built in one task.
    """
    d = date_lit(day)
    return spark.range(1).select(
        F.explode(F.sequence(F.trunc(d, "MM"), F.last_day(d))).alias("posting_date"))


def calendar_of(df: DataFrame, date_col: str) -> DataFrame:
    """Month calendars for every month in which ``df`` has a date.

    Months are found with a distinct over the data (a small aggregate), then
    each month is expanded with ``sequence``; used to gap-fill daily series.
    """
    months = df.select(F.trunc(F.col(date_col), "MM").alias("m")).where(F.col("m").isNotNull())
    months = months.distinct()
    return months.select(F.explode(F.sequence(F.col("m"), F.last_day(F.col("m"))))
                         .alias(date_col))
