"""Plan versus fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import days_in_month, month_start
from shelfline.functions.measures import exact, margin, measures, monthly, ratio
from shelfline.plans.daily import SALES_MEASURES, two_days
from shelfline.plans.planning import monthly_actuals
from shelfline.schemas import BOOK_FORMATS
from shelfline.star import Star

KEYS = ["genre", "format", "year", "month"]


def month_progress(star: Star) -> DataFrame:
    today = star.today
    return star.spark.range(1).select(
        F.lit(today).alias("today"), F.lit(today.day).alias("days_passed"),
        F.lit(days_in_month(today)).alias("days_in_month"))


def plan_to_date(star: Star) -> DataFrame:
    """The current month's plan, and its share due by the report day."""
    today = star.today
    passed, days = exact(F.lit(today.day)), exact(F.lit(days_in_month(today)))
    plan = star.plan.where((F.col("year") == today.year) & (F.col("month") == today.month))
    return plan.select(
        *KEYS, "plan_qty", "plan_amount", "plan_margin_target",
        F.round(exact(F.col("plan_qty")) * passed / days, 0).cast("bigint").alias("plan_qty_to_date"),
        F.round(F.col("plan_amount") * passed / days, 2).cast("decimal(20,2)").alias("plan_amount_to_date"))


def mart_plan_fact(star: Star) -> DataFrame:
    """Month-to-date actuals beside the plan due, with a straight-line forecast of the month."""
    today = star.today
    current = star_month(star)
    zero = F.lit(0)
    rows = plan_to_date(star).join(current, KEYS, "left").select(
        *KEYS,
        *[F.coalesce(c, zero).alias(c) for c in (
            "plan_qty", "plan_amount", "plan_qty_to_date", "plan_amount_to_date", "plan_margin_target",
            "fact_qty", "fact_amount")])
    pct = F.when(F.col("plan_amount_to_date") > 0,
                 ratio(F.col("fact_amount") * 100, F.col("plan_amount_to_date"), 1))
    forecast = ratio(F.col("fact_amount") * days_in_month(today), exact(F.lit(today.day)), 2)
    return rows.select(
        "*", pct.alias("pct_of_plan_to_date"),
        (F.col("fact_amount") - F.col("plan_amount_to_date")).alias("delta_amount_to_date"),
        forecast.alias("forecast_month_amount"), F.lit(today).alias("report_date"))


def star_month(star: Star) -> DataFrame:
    """Book actuals of the current month by genre and format."""
    rows = star.months([month_start(star.today)])
    sums = rows.where(F.col("format").isin(BOOK_FORMATS)).groupBy("genre", "format").agg(
        *monthly(fact_qty="net_qty", fact_amount="net_revenue"))
    return sums.select(
        "*", F.lit(star.today.year).alias("year"), F.lit(star.today.month).alias("month"))


def mart_daily_breakdown(star: Star) -> DataFrame:
    """Report day and the day before by genre and book format."""
    lines = two_days(star, "genre", "format", "cost_rub").where(F.col("format").isin(BOOK_FORMATS))
    return lines.groupBy("day_type", "genre", "format").agg(*measures(*SALES_MEASURES))


def mart_daily_format_pulse(star: Star) -> DataFrame:
    """Report day and the day before by format, subscriptions included."""
    sums = two_days(star, "format", "cost_rub").groupBy("day_type", "format").agg(*measures(*SALES_MEASURES))
    return sums.withColumn("gross_margin", margin())


def mart_plan_fact_history(star: Star) -> DataFrame:
    """Every planned month beside its actuals."""
    today = star.today
    zero = F.lit(0)
    actual = monthly_actuals(star)
    rows = star.plan.where(F.col("format").isin(BOOK_FORMATS)).join(actual, KEYS, "left").select(
        *KEYS, "plan_qty", "plan_amount", "plan_margin_target",
        F.coalesce("fact_qty", zero).alias("fact_qty"),
        F.coalesce("fact_amount", zero.cast("decimal(20,2)")).alias("fact_amount"))
    is_closed = (F.col("year") < today.year) | (
        (F.col("year") == today.year) & (F.col("month") < today.month))
    pct = F.when(F.col("plan_amount") > 0, ratio(F.col("fact_amount") * 100, F.col("plan_amount"), 1))
    return rows.select(
        "*", pct.alias("pct_of_plan"),
        (F.col("fact_amount") - F.col("plan_amount")).alias("delta_amount"),
        F.when(is_closed, "closed").otherwise("current").alias("month_status"))
