"""Calendar and monthly plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.functions.dates import first_date
from shelfline.functions.measures import monthly
from shelfline.schemas import BOOK_FORMATS, BOOK_GENRES, COST_PERCENT, DIM_DATE, FACT_PLAN, HOLIDAYS, PARTITION
from shelfline.star import Star


def build_calendar(spark: SparkSession, first: dt.date, last: dt.date, holidays=HOLIDAYS) -> DataFrame:
    """One row per day with year, month, quarter, weekend and fixed-date holiday flags."""
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
    d = F.col("date")
    is_holiday = F.lit(False)
    for month, day in holidays:
        is_holiday = is_holiday | ((F.month(d) == month) & (F.dayofmonth(d) == day))
    parts = days.select(
        d, F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        (F.weekday(d) >= 5).alias("is_weekend"), is_holiday.alias("is_holiday_ru"),
    )
    return parts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DIM_DATE])


def month_grid(spark: SparkSession, first: dt.date, last: dt.date,
               genres=BOOK_GENRES, formats=BOOK_FORMATS) -> DataFrame:
    """Every month x genre x format; the vocabularies are exploded on each month row."""
    months = (last.year - first.year) * 12 + last.month - first.month + 1
    month = F.add_months(F.lit(first.replace(day=1)), F.col("id").cast("int"))
    return (
        spark.range(months)
        .select(F.year(month).alias("year"), F.month(month).alias("month"),
                F.explode(F.array(*map(F.lit, genres))).alias("genre"))
        .withColumn("format", F.explode(F.array(*map(F.lit, formats))))
    )


def monthly_actuals(star: Star, formats=BOOK_FORMATS) -> DataFrame:
    """Net quantity and revenue by year, month, genre and format."""
    month = F.col(PARTITION)
    return (
        star.months().where(F.col("format").isin(formats))
        .groupBy(F.year(month).alias("year"), F.month(month).alias("month"), "genre", "format")
        .agg(*monthly(fact_qty="net_qty", fact_amount="net_revenue"))
    )


def plan_grid(star: Star, first: dt.date | None = None) -> DataFrame:
    """Every month x genre x format with its actuals, 0 where nothing was sold.

    Starts in January of the first sales year, ends in the month of the report day.
    """
    first = first or star.first_sale.replace(month=1, day=1)
    keys = ["year", "month", "genre", "format"]
    return (
        month_grid(star.spark, first, star.today)
        .join(monthly_actuals(star), keys, "left")
        .select(*keys, F.coalesce("fact_qty", F.lit(0)).alias("fact_qty"),
                F.coalesce("fact_amount", F.lit(0).cast("decimal(20,2)")).alias("fact_amount"))
    )


def plan_from_history(grid: DataFrame, first_year: int, first_factor: float = 1.0,
                      growth: float = 1.05, uplift: float = 0.015) -> DataFrame:
    """Plan from the same month of the year before times `growth`; the first year uses its own actuals.

    Quantity is rounded half to even, amount to cents half away from zero; a month without sales a
    year earlier gets a zero plan. The margin target is one minus the cost share plus `uplift`.
    """
    # The grid has every month, so the previous row of a (month, genre, format) is the year before.
    years = Window.partitionBy("month", "genre", "format").orderBy("year")
    is_first = F.col("year") == first_year
    factor = F.when(is_first, F.lit(first_factor)).otherwise(F.lit(growth))
    based = grid.select(
        "year", "month", "genre", "format", "fact_qty", "fact_amount",
        F.lag("fact_qty").over(years).alias("last_qty"),
        F.lag("fact_amount").over(years).alias("last_amount"),
    )
    known = is_first | F.coalesce(F.col("last_qty") > 0, F.lit(False))
    basis_qty = F.when(is_first, F.col("fact_qty")).otherwise(F.col("last_qty"))
    basis_amount = F.when(is_first, F.col("fact_amount")).otherwise(F.col("last_amount"))
    qty = F.greatest(F.lit(0), F.rint(basis_qty * factor).cast("bigint"))
    amount = F.greatest(F.lit(0), F.round(basis_amount * factor.cast("decimal(6,4)"), 2))
    cost_share = F.lit(0.5)
    for name, percent in COST_PERCENT.items():
        cost_share = F.when(F.col("format") == name, F.lit(percent / 100)).otherwise(cost_share)
    genre_at = F.array_position(F.array(*map(F.lit, BOOK_GENRES)), F.col("genre"))
    format_at = F.array_position(F.array(*map(F.lit, BOOK_FORMATS)), F.col("format"))
    month_at = (F.col("year") - first_year) * 12 + F.col("month") - 1
    rows = based.select(
        (month_at * len(BOOK_GENRES) * len(BOOK_FORMATS)
         + (genre_at - 1) * len(BOOK_FORMATS) + format_at).alias("plan_id"),
        "genre", "format", "year", "month",
        F.when(known, qty).otherwise(0).alias("plan_qty"),
        F.when(known, amount).otherwise(0).alias("plan_amount"),
        F.round(1 - cost_share + F.lit(uplift), 4).alias("plan_margin_target"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_PLAN])
