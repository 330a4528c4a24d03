"""Calendar arithmetic on plain dates and date filters that prune fact partitions."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.schemas import PARTITION


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def days_in_month(day: dt.date) -> int:
    return calendar.monthrange(day.year, day.month)[1]


def month_before(day: dt.date) -> dt.date:
    """Same day of the previous month, moved back to its last day where it is shorter."""
    last = month_start(day) - dt.timedelta(days=1)
    return last.replace(day=min(day.day, last.day))


def in_days(df: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Rows with first <= date <= last. Literal bounds, so they reach the scan; on a stored fact the
    month folders outside the range are not listed at all."""
    columns = [("date", first, last)]
    if PARTITION in df.columns:
        columns.append((PARTITION, first and month_start(first), last))
    for name, low, high in columns:
        if low is not None:
            df = df.where(F.col(name) >= F.lit(low))
        if high is not None:
            df = df.where(F.col(name) <= F.lit(high))
    return df


def last_date(df: DataFrame) -> dt.date | None:
    """Latest date of a fact. The newest month comes from the folder names alone; only that month's
    date column is read after that."""
    return _edge(df, F.max)


def first_date(df: DataFrame) -> dt.date | None:
    return _edge(df, F.min)


def _edge(df: DataFrame, which) -> dt.date | None:
    if PARTITION in df.columns:
        month = df.agg(which(PARTITION)).first()[0]
        if month is None:
            return None
        df = df.where(F.col(PARTITION) == F.lit(month))
    return df.agg(which("date")).first()[0]


def by_month(df: DataFrame) -> DataFrame:
    """Adds month_start, the one key a monthly group needs."""
    return df.withColumn("month_start", F.trunc("date", "month"))


def month_parts() -> list[Column]:
    """Year, month and quarter of month_start, worked out once per group."""
    m = F.col("month_start")
    return [F.year(m).alias("year"), F.month(m).alias("month"), F.quarter(m).alias("quarter")]
