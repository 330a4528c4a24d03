"""Parameterised ad-hoc queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import in_days
from shelfline.functions.measures import beside, cents, exact, measures, money, monthly, ratio
from shelfline.operators.monthly import distinct_orders, order_words
from shelfline.plans.plan_fact import mart_plan_fact_history
from shelfline.plans.sales import (
    mart_abc, mart_margin_by_publisher, mart_sales_trends, mart_subscriptions_monthly,
)
from shelfline.schemas import PHYSICAL_FORMATS, SUBSCRIPTION
from shelfline.star import Star


def last_dates(star: Star) -> DataFrame:
    """Latest date of each fact."""
    days = {"fact_sales": star.last_sale, "fact_inventory": star.stock_day}
    return _stacked([
        star.spark.range(1).select(F.lit(name).alias("tbl"), F.lit(day).cast("date").alias("last_date"))
        for name, day in days.items()])


def row_counts(star: Star) -> DataFrame:
    """Rows per table; Parquet footers answer it without reading a column, or the months and runs that tables are
    derived by."""
    count = F.count("*").alias("n")
    counts = {"dim_product": star.product.agg(count), "fact_sales": star.sales_rows(),
              "fact_inventory": star.stock_rows(), "fact_plan": star.plan.agg(count)}
    return _stacked([df.select(F.lit(name).alias("tbl"), "n") for name, df in counts.items()])


def _stacked(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def channel_daily_30d(star: Star, days: int = 30) -> DataFrame:
    """Orders and revenue per day and channel, from `days` before the report day."""
    lines = star.few_lines(star.today - dt.timedelta(days=days), None, "channel")
    return lines.groupBy("date", "channel").agg(*measures("orders", "net_revenue")).orderBy(
        F.desc("date"), F.desc("net_revenue"), "channel")


def genre_margin_period(star: Star, first: dt.date, last: dt.date) -> DataFrame:
    """Revenue and margin by genre between two days; the margin is NULL without revenue."""
    sums = in_days(star.lines("genre", "cost_rub"), first, last).groupBy("genre").agg(
        *measures("net_revenue", "gross_profit"))
    return sums.withColumn(
        "gross_margin", ratio(F.col("gross_profit"), F.col("net_revenue"), 4)
    ).orderBy(F.desc("net_revenue"), "genre")


def top_products_abc(star: Star, n: int = 20) -> DataFrame:
    return star.mart(mart_abc).select(
        "revenue_rank", "product_id", "title", "format", "genre", "total_net_revenue", "product_margin", "abc_class",
    ).orderBy("revenue_rank", "product_id").limit(n)


def promo_effectiveness(star: Star, first: dt.date) -> DataFrame:
    """Orders, revenue and average order with and without promotion."""
    lines = in_days(star.sales, first, None)
    sums = lines.groupBy("is_promo").agg(*measures("net_revenue"))
    orders = distinct_orders(order_words(lines, ["is_promo"]), ["is_promo"])
    sums = beside(sums, orders, ["is_promo"]).withColumn("orders", F.coalesce("orders", F.lit(0).cast("bigint")))
    return sums.withColumn("avg_order", ratio(F.col("net_revenue"), exact(F.col("orders")), 2))


def lost_sales_top(star: Star, n: int = 10) -> DataFrame:
    """Titles with the highest estimated loss from shortages."""
    rows = star.months().where(F.col("format").isin(PHYSICAL_FORMATS))
    return rows.groupBy("title", "format").agg(
        *monthly(total_lost_qty="lost_sales_qty", lost_revenue_est="lost_revenue"),
    ).orderBy(F.desc_nulls_last("lost_revenue_est"), "title", "format").limit(n)


def stock_history(star: Star, product_id: int) -> DataFrame:
    """Daily stock of one product."""
    return star.inventory.where(F.col("product_id") == product_id).select(
        "date", "opening_stock", "sold_qty", "replenishment_qty", "closing_stock", "is_low_stock").orderBy("date")


def zero_stock_now(star: Star) -> DataFrame:
    """Products out of stock on the last inventory day."""
    empty = star.stock(star.stock_day, star.stock_day).where(F.col("closing_stock") == 0)
    named = empty.join(star.product.select("product_id", "title", "format", "publisher"), "product_id")
    return named.select(
        "product_id", "title", "format", "publisher", "closing_stock", F.col("date").alias("stock_date")
    ).orderBy("title", "product_id")


def replenishment_frequency(star: Star) -> DataFrame:
    """How often and how much each title was restocked.

    Summed per product first: the daily rows shrink to one row per product before the title is joined.
    """
    per_product = star.inventory.groupBy("product_id").agg(
        F.count_if(F.col("replenishment_qty") > 0).alias("times"), F.sum("replenishment_qty").alias("qty"))
    return per_product.join(star.product.select("product_id", "title", "format"), "product_id").groupBy(
        "title", "format").agg(
        F.sum("times").alias("replenishments"), F.sum("qty").alias("total_replenished"),
    ).orderBy(F.desc("replenishments"), "title", "format")


def plan_closed_summary(star: Star) -> DataFrame:
    """Plan and fact of each closed month."""
    closed = star.mart(mart_plan_fact_history).where(F.col("month_status") == "closed")
    sums = closed.groupBy("year", "month").agg(
        money(F.sum(cents("plan_amount"))).alias("total_plan"), money(F.sum(cents("fact_amount"))).alias("total_fact"))
    return sums.withColumn(
        "pct", ratio(F.col("total_fact") * 100, F.col("total_plan"), 1)).orderBy("year", "month")


def missed_plan_genres(star: Star, below: float = 80, at_least: int = 2) -> DataFrame:
    """Genres whose closed plan rows stayed under `below` per cent at least `at_least` times."""
    missed = star.mart(mart_plan_fact_history).where(
        (F.col("month_status") == "closed") & (F.col("pct_of_plan") < below))
    return missed.groupBy("genre").agg(F.count("*").alias("missed_months")).where(
        F.col("missed_months") >= at_least).orderBy(F.desc("missed_months"), "genre")


def format_margin_yoy(star: Star) -> DataFrame:
    """Margin of each format by year, subscriptions left out."""
    trends = star.mart(mart_sales_trends).where(F.col("format") != SUBSCRIPTION)
    sums = trends.groupBy("format", "year").agg(
        money(F.sum(cents("gross_profit"))).alias("profit"), money(F.sum(cents("net_revenue"))).alias("revenue"))
    return sums.select(
        "format", "year", ratio(F.col("profit"), F.col("revenue"), 4).alias("gross_margin")).orderBy("format", "year")


def weak_margin_publishers(star: Star, below: float = 0.30) -> DataFrame:
    """Publishers with a thin margin and above-average revenue."""
    mart = star.mart(mart_margin_by_publisher)
    average = mart.agg((F.sum("net_revenue") / F.count("*")).alias("average")).scalar()
    return mart.where((F.col("gross_margin") < below) & (F.col("net_revenue") > average)).select(
        "publisher", "format", "gross_margin", "net_revenue", "rank_overall").orderBy("gross_margin", "rank_overall")


def subscription_churn(star: Star) -> DataFrame:
    """Cancellations against new subscriptions by month and type."""
    mart = star.mart(mart_subscriptions_monthly)
    return mart.select(
        "year", "month", "subscription_type", "new_subscriptions", "cancellations",
        ratio(exact(F.col("cancellations") * 100), exact(F.col("new_subscriptions")), 1).alias("churn_pct"),
    ).orderBy("year", "month", "subscription_type")


def basket_size(star: Star) -> DataFrame:
    """Lines per order over the whole period."""
    orders = distinct_orders(star.order_months(), [])
    sums = star.months().agg(F.coalesce(F.sum("lines"), F.lit(0).cast("bigint")).alias("lines"))
    return sums.select(F.coalesce(orders.scalar(), F.lit(0).cast("bigint")).alias("orders"), "lines").select(
        "orders", ratio(exact(F.col("lines")), exact(F.col("orders")), 4).alias("basket_size"), "lines")
