"""Data behind the KPI tiles and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import days_in_month
from shelfline.functions.measures import cents, exact, money, monthly, ratio
from shelfline.plans.daily import mart_daily_pulse, mart_mtd_pulse
from shelfline.plans.plan_fact import mart_plan_fact, mart_plan_fact_history
from shelfline.plans.adhoc import plan_closed_summary, stock_history
from shelfline.plans.sales import (
    mart_abc, mart_margin_by_format, mart_margin_by_publisher, mart_sales_trends,
    mart_subscriptions, mart_subscriptions_monthly,
)
from shelfline.plans.stock import mart_inventory_alerts
from shelfline.schemas import LOW_STOCK, PARTITION, PHYSICAL_FORMATS
from shelfline.star import Star


def _sum_money(name: str) -> Column:
    return money(F.sum(cents(name))).alias(name)


def _change(now: Column, then: Column, name: str, points: bool = False) -> list[Column]:
    delta = [(now - then).alias(f"{name}_delta")]
    if points:
        return delta
    return delta + [ratio((now - then).cast("decimal(20,2)"), then.cast("decimal(20,2)"), 4).alias(f"{name}_delta_pct")]


def kpi_day_delta(star: Star) -> DataFrame:
    """Report day against the day before: revenue, orders, average order, margin in points."""
    mart = mart_daily_pulse(star)
    tiles = {"revenue": "total_revenue", "orders": "total_orders", "avg_order": "avg_order_value", "margin": "gross_margin"}
    wide = mart.agg(*[
        F.max(F.when(F.col("day_type") == day, F.col(column))).alias(f"{name}_{day}")
        for name, column in tiles.items() for day in ("today", "yesterday")])
    deltas = [c for name in tiles for c in _change(
        F.col(f"{name}_today"), F.col(f"{name}_yesterday"), name, points=name == "margin")]
    return wide.select("*", *deltas)


def kpi_mtd_delta(star: Star) -> DataFrame:
    """Month to date against the same days of the previous month."""
    mart = mart_mtd_pulse(star)
    names = ["revenue", "orders", "gross_profit", "gross_margin", "avg_order_value"]
    shown = [F.col(f"{p}_{n}") for n in names for p in ("mtd", "prev_mtd")]
    deltas = [c for n in names for c in _change(
        F.col(f"mtd_{n}"), F.col(f"prev_mtd_{n}"), n, points=n == "gross_margin")]
    return mart.select(*shown, *deltas)


def _due_sums(star: Star, *keys: str) -> DataFrame:
    return star.mart(mart_plan_fact).groupBy(*keys).agg(
        _sum_money("fact_amount"), _sum_money("plan_amount_to_date"), _sum_money("delta_amount_to_date"))


def _pct_due() -> Column:
    return ratio(F.col("fact_amount") * 100, F.col("plan_amount_to_date"), 1)


def plan_kpi_total(star: Star) -> DataFrame:
    """Overall share of plan, forecast of the month and deviation."""
    today = star.today
    forecast = ratio(F.col("fact_amount") * days_in_month(today), exact(F.lit(today.day)), 2)
    return _due_sums(star).select(
        "fact_amount", "plan_amount_to_date", _pct_due().alias("pct_of_plan_to_date"),
        forecast.alias("forecast_month_amount"), "delta_amount_to_date")


def plan_by(star: Star, key: str) -> DataFrame:
    return _due_sums(star, key).select(
        key, "fact_amount", "plan_amount_to_date", _pct_due().alias("pct_of_plan_to_date"))


def plan_by_genre(star: Star) -> DataFrame:
    return plan_by(star, "genre")


def plan_by_format(star: Star) -> DataFrame:
    return plan_by(star, "format")


def plan_pct_monthly(star: Star) -> DataFrame:
    """Share of plan reached in each closed month."""
    return plan_closed_summary(star).select("year", "month", "pct")


def plan_heatmap(star: Star) -> DataFrame:
    """Genre x calendar month, share of plan over all years and formats."""
    sums = star.mart(mart_plan_fact_history).groupBy("genre").pivot("month", list(range(1, 13))).agg(
        _sum_money("fact_amount").alias("fact"), _sum_money("plan_amount").alias("plan"))
    return sums.select("genre", *[
        ratio(F.col(f"{m}_fact") * 100, F.col(f"{m}_plan"), 1).alias(f"m{m:02d}") for m in range(1, 13)])


def _trend_sums(star: Star, keys: list[str], *columns: str) -> DataFrame:
    return star.mart(mart_sales_trends).groupBy(*keys).agg(*[_sum_money(c) for c in columns])


def revenue_by_month(star: Star) -> DataFrame:
    return _trend_sums(star, ["month_start"], "net_revenue")


def revenue_by_format(star: Star) -> DataFrame:
    return _trend_sums(star, ["month_start", "format"], "net_revenue")


def revenue_by_genre(star: Star) -> DataFrame:
    return _trend_sums(star, ["month_start", "genre"], "net_revenue")


def return_share_monthly(star: Star) -> DataFrame:
    """Returned share of gross revenue."""
    sums = _trend_sums(star, ["month_start"], "return_revenue", "gross_revenue")
    return sums.withColumn("return_share", ratio(F.col("return_revenue"), F.col("gross_revenue"), 4))


def promo_vs_organic(star: Star) -> DataFrame:
    sums = _trend_sums(star, ["month_start"], "promo_revenue", "net_revenue")
    return sums.select("month_start", "promo_revenue", (F.col("net_revenue") - F.col("promo_revenue")).alias("organic_revenue"))


def lost_sales_monthly(star: Star) -> DataFrame:
    """Quantity lost to shortages of physical formats."""
    trends = star.mart(mart_sales_trends).where(F.col("format").isin(PHYSICAL_FORMATS))
    return trends.groupBy("month_start").agg(F.sum("lost_sales_qty").alias("lost_sales_qty"))


def margin_scatter(star: Star) -> DataFrame:
    return star.mart(mart_margin_by_format).select("month_start", "format", "net_revenue", "gross_margin", "net_qty")


def top_publishers(star: Star, n: int = 20) -> DataFrame:
    return star.mart(mart_margin_by_publisher).select(
        "publisher", "format", "gross_profit", "gross_margin", "rank_overall",
    ).orderBy("rank_overall", "publisher", "format").limit(n)


def genre_margin_heatmap(star: Star) -> DataFrame:
    """Genre x calendar month, margin from the summed profit and revenue."""
    sums = star.mart(mart_sales_trends).groupBy("genre").pivot("month", list(range(1, 13))).agg(
        _sum_money("gross_profit").alias("profit"), _sum_money("net_revenue").alias("revenue"))
    return sums.select("genre", *[
        ratio(F.col(f"{m}_profit"), F.col(f"{m}_revenue"), 4).alias(f"m{m:02d}") for m in range(1, 13)])


def alerts_by_level(star: Star) -> DataFrame:
    return star.mart(mart_inventory_alerts).groupBy("alert_level").agg(F.count("*").alias("products"))


def stockout_histogram(star: Star) -> DataFrame:
    """Alerts by days left: 0, 1-7, 8-30, 30+; products without sales are unknown."""
    days = F.col("days_until_stockout")
    bucket = (F.when(days.isNull(), "unknown").when(days <= 0, "0").when(days <= 7, "1-7")
              .when(days <= 30, "8-30").otherwise("30+"))
    return star.mart(mart_inventory_alerts).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("products"))


def reorder_value(star: Star) -> DataFrame:
    """Value of the recommended orders at the sales price, and at cost beside it."""
    order = F.col("recommended_order_qty") * cents("price_rub")
    return star.mart(mart_inventory_alerts).agg(
        F.sum("recommended_order_qty").alias("reorder_qty"), money(F.sum(order)).alias("value_at_price"),
        money(F.sum(cents("recommended_order_cost"))).alias("value_at_cost"))


def low_stock_widget(star: Star) -> DataFrame:
    return star.mart(mart_inventory_alerts).select(
        "product_id", "title", "format", "closing_stock", "days_until_stockout", "recommended_order_qty", "alert_level")


def reorder_list(star: Star) -> DataFrame:
    """Products to order, emptiest first, with the publisher to contact."""
    return star.mart(mart_inventory_alerts).orderBy(
        "closing_stock", F.desc_nulls_last("avg_daily_sales_30d"), "product_id")


def stock_vs_threshold(star: Star, product_id: int) -> DataFrame:
    return stock_history(star, product_id).select(
        "date", "closing_stock", F.lit(LOW_STOCK).alias("threshold"))


def abc_summary(star: Star) -> DataFrame:
    """Products, revenue, share of revenue and lost quantity per class."""
    sums = star.mart(mart_abc).groupBy("abc_class").agg(
        F.count("*").alias("products"), _sum_money("total_net_revenue"),
        F.sum("total_lost_qty").alias("lost_qty"), F.max("grand_total_revenue").alias("grand"))
    return sums.select(
        "abc_class", "products", "total_net_revenue",
        ratio(F.col("total_net_revenue") * 100, F.col("grand"), 2).alias("revenue_pct"), "lost_qty")


def abc_margin_box(star: Star) -> DataFrame:
    """Minimum, quartiles and maximum of the product margin per class.

    The exact percentile keeps a count per distinct value, and a margin has four decimals, so its
    state does not grow with the catalogue.
    """
    points = F.percentile("product_margin", [0.0, 0.25, 0.5, 0.75, 1.0]).alias("p")
    box = star.mart(mart_abc).groupBy("abc_class").agg(points)
    names = ["min_margin", "q1_margin", "median_margin", "q3_margin", "max_margin"]
    return box.select("abc_class", *[F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(names)])


def abc_table_with_history(star: Star) -> DataFrame:
    """ABC rows with the product's monthly revenue as `yyyy-mm=amount` in month order."""
    by_month = star.months().groupBy("product_id", F.date_format(PARTITION, "yyyy-MM").alias("month")).agg(
        *monthly("net_revenue"))
    series = by_month.groupBy("product_id").agg(F.array_sort(F.collect_list(
        F.concat("month", F.lit("="), F.col("net_revenue").cast("string")))).alias("series"))
    return star.mart(mart_abc).join(series, "product_id").select(
        "product_id", "title", "format", "genre", "abc_class", "total_net_revenue", "product_margin",
        "revenue_rank", F.array_join("series", ";").alias("revenue_series"))


def subscription_counts(star: Star) -> DataFrame:
    return star.mart(mart_subscriptions_monthly).select("month_start", "subscription_type", "net_qty", "cancellations")


def subscription_revenue(star: Star) -> DataFrame:
    return star.mart(mart_subscriptions_monthly).select("month_start", "subscription_type", "net_revenue")


def subscription_card(star: Star) -> DataFrame:
    return star.mart(mart_subscriptions).select(
        "subscription_type", "unit_price", "net_subscriptions", "total_revenue", "cancellation_rate_pct",
        "avg_ltv", "gross_margin")


def subscription_promo_share(star: Star) -> DataFrame:
    return star.mart(mart_subscriptions_monthly).select("month_start", "subscription_type", "promo_pct")
