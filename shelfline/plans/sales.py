"""Sales trends, ABC classes, margins and subscriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import month_parts
from shelfline.functions.measures import (
    average_order, beside, cents, exact, margin, money, monthly, ratio, ratio_or_zero,
)
from shelfline.operators.monthly import distinct_orders
from shelfline.operators.ordered import running_rank
from shelfline.schemas import PARTITION, SUBSCRIPTION
from shelfline.star import Star


def _month() -> Column:
    return F.col(PARTITION).alias("month_start")


def mart_sales_trends(star: Star, months: list | None = None) -> DataFrame:
    """Month x genre x format x language; of the given months only, if any are given."""
    keys = ["month_start", "genre", "format", "language"]
    group = [_month(), "genre", "format", F.coalesce("language", F.lit("N/A")).alias("language")]
    rows = star.months(months)
    sums = rows.select(*group, *[c for c in rows.columns if c not in keys]).groupBy(*keys).agg(*monthly(
        "gross_qty", "return_qty", "net_qty", "gross_revenue", "net_revenue", "total_cost",
        "gross_profit", "promo_orders", "promo_revenue", "lost_sales_qty", return_revenue="return_amount"))
    orders = distinct_orders(star.order_months(months).select(*group, "word", "bits"), keys)
    return beside(sums, orders, keys).withColumn("orders", F.coalesce("orders", F.lit(0).cast("bigint"))).select(
        *month_parts(), "*", margin().alias("gross_margin"), average_order().alias("avg_order_value"))


def product_totals(star: Star) -> DataFrame:
    """Totals per product sold, subscriptions left out.

    A product's months are brought together once; its days and its totals are then summed where they are,
    and its orders, counted from their bits, come to the same place.
    """
    books = F.col("format") != SUBSCRIPTION
    rows = star.months().where(books).repartition("product_id")
    # a month stands in several rows where the product's attributes changed in between
    per_month = rows.groupBy("product_id", PARTITION).agg(
        F.bit_or("days").alias("days"), *[F.sum(n).alias(n) for n in ("net_qty", "net_cents", "lost_sales_qty")])
    totals = per_month.groupBy("product_id").agg(
        *monthly(total_net_qty="net_qty", total_net_revenue="net_revenue", total_lost_qty="lost_sales_qty"),
        F.sum(F.bit_count("days")).cast("bigint").alias("active_days"))
    orders = distinct_orders(star.order_months().where(books), ["product_id"], "total_orders")
    return totals.join(orders, "product_id", "left").withColumn(
        "total_orders", F.coalesce("total_orders", F.lit(0).cast("bigint")))


def mart_abc(star: Star, partitions: int | None = None) -> DataFrame:
    """Products by falling revenue with their running share: A up to 80 %, B up to 95 %, C the rest.

    The share includes the product itself; equal revenues are taken in product order.
    """
    ranked = running_rank(
        product_totals(star).withColumn("_cents", cents("total_net_revenue")),
        by="_cents", tie="product_id", total="_cents", rank="revenue_rank", partitions=partitions)
    share = F.col("running") * 100
    described = ranked.join(star.product, "product_id")
    profit = F.col("total_net_revenue") - F.col("total_net_qty") * F.col("cost_rub")
    return described.select(
        "product_id", "title", "author", "publisher", "genre", "format", "language", "price_rub",
        "cost_rub", "avg_rating", "review_count", "total_net_qty", "total_net_revenue", "active_days",
        "total_orders", "total_lost_qty",
        money(F.col("grand")).alias("grand_total_revenue"),
        ratio(exact(F.col("_cents") * 100), exact(F.col("grand")), 2).alias("revenue_pct"),
        (F.col("running").cast("double") / F.nullif("grand", F.lit(0)).cast("double") * 100).alias("cumulative_pct"),
        "revenue_rank",
        F.when(share <= F.col("grand") * 80, "A").when(share <= F.col("grand") * 95, "B").otherwise("C").alias("abc_class"),
        ratio_or_zero(profit.cast("decimal(20,2)"), F.col("total_net_revenue"), 4).alias("product_margin"))


def mart_margin(star: Star) -> DataFrame:
    """One row per format over the whole period; the rating is weighted by lines sold."""
    sums = star.months().groupBy("format").agg(
        *monthly("net_qty", "net_revenue", "total_cost", "gross_profit", unique_products="products"), *_rating_sums())
    return sums.withColumn("gross_margin", margin()).withColumn("avg_rating", _rating()).drop("_tenths", "_rated")


def _rating_sums() -> list:
    tenths = (F.col("avg_rating") * 10).cast("bigint") * F.col("lines")
    rated = F.when(F.col("avg_rating").isNotNull(), F.col("lines")).otherwise(0)
    return [F.sum(tenths).alias("_tenths"), F.sum(rated).alias("_rated")]


def _rating():
    return ratio(exact(F.col("_tenths")), exact(F.col("_rated") * 10), 2)


def mart_margin_by_format(star: Star, months: list | None = None) -> DataFrame:
    sums = star.months(months).groupBy(_month(), "format").agg(
        *monthly("net_qty", "net_revenue", "total_cost", "gross_profit", unique_products="products"))
    return sums.select(*month_parts(), "*", margin().alias("gross_margin"))


def mart_margin_by_publisher(star: Star) -> DataFrame:
    """Publisher x format, ranked by gross profit within the format and overall."""
    sums = star.months().where(F.col("publisher").isNotNull()).groupBy("publisher", "format").agg(
        *monthly("net_qty", "net_revenue", "total_cost", "gross_profit", product_count="products"), *_rating_sums())
    named = sums.withColumn("_name", F.concat_ws("\u0001", "publisher", "format"))
    ranked = running_rank(named, by="gross_profit", tie="_name", rank="rank_overall")
    ranked = running_rank(ranked, by="gross_profit", tie="publisher", within=["format"], rank="rank_by_format")
    return ranked.select(
        "publisher", "format", "product_count", "net_qty", "net_revenue", "total_cost", "gross_profit",
        margin().alias("gross_margin"), _rating().alias("avg_product_rating"),
        "rank_by_format", "rank_overall")


def mart_subscriptions(star: Star) -> DataFrame:
    """One row per subscription type (title, price and cost)."""
    keys, sold = ["subscription_type", "price_rub", "cost_rub"], F.col("format") == SUBSCRIPTION
    sums = star.months().where(sold).withColumnRenamed("title", "subscription_type").groupBy(*keys).agg(
        *monthly("gross_profit", net_subscriptions="net_qty", total_revenue="net_revenue",
                 total_cancellations="return_qty", promo_count="promo_orders"),
        F.min("first_day").alias("first_sale_date"), F.max("last_day").alias("last_sale_date"))
    words = star.order_months().where(sold).withColumnRenamed("title", "subscription_type")
    by_type = beside(sums, distinct_orders(words, keys, "total_orders"), keys).withColumn(
        "total_orders", F.coalesce("total_orders", F.lit(0).cast("bigint")))
    per_order = {"cancellation_rate_pct": "total_cancellations", "promo_rate_pct": "promo_count"}
    unit_profit = F.col("price_rub") - F.col("cost_rub")
    return by_type.select(
        "subscription_type", "total_orders", "net_subscriptions", "total_revenue", "gross_profit",
        margin(revenue="total_revenue").alias("gross_margin"), "total_cancellations", "promo_count",
        *[ratio_or_zero(exact(F.col(n) * 100), exact(F.col("total_orders")), 1).alias(a)
          for a, n in per_order.items()],
        "first_sale_date", "last_sale_date",
        F.col("price_rub").alias("unit_price"), F.col("cost_rub").alias("unit_cost"),
        ratio(unit_profit, F.col("price_rub"), 4).alias("unit_margin"),
        average_order("total_revenue", "net_subscriptions").alias("avg_ltv"))


def mart_subscriptions_monthly(star: Star, months: list | None = None) -> DataFrame:
    keys, sold = ["month_start", "subscription_type"], F.col("format") == SUBSCRIPTION
    group = [_month(), F.col("title").alias("subscription_type")]
    sums = star.months(months).where(sold).groupBy(*group).agg(
        *monthly("net_qty", "net_revenue", "gross_profit", cancellations="return_qty",
                 cancelled_revenue="return_amount", _promo="promo_orders", _lines="lines"))
    orders = distinct_orders(star.order_months(months).where(sold).select(*group, "word", "bits"), keys, "new_subscriptions")
    sums = beside(sums, orders, keys).withColumn("new_subscriptions", F.coalesce("new_subscriptions", F.lit(0).cast("bigint")))
    return sums.select(
        *month_parts(), "*", margin().alias("gross_margin"),
        ratio(exact(F.col("_promo") * 100), exact(F.col("_lines")), 1).alias("promo_pct"),
        average_order("net_revenue", "net_qty").alias("avg_subscription_price"),
    ).drop("_promo", "_lines")
