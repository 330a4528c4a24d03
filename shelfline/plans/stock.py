"""Stock marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import in_days
from shelfline.functions.measures import exact, measures
from shelfline.schemas import COVER_DAYS, LOW_STOCK, PHYSICAL_FORMATS, SALES_WINDOW_DAYS, URGENT_STOCK
from shelfline.star import Star


def latest_stock(star: Star) -> DataFrame:
    """Stock rows of the last inventory day."""
    return star.stock(star.stock_day, star.stock_day).select(
        "product_id", "closing_stock", "is_low_stock", F.col("date").alias("stock_date"))


def avg_daily_sales_30d(star: Star) -> DataFrame:
    """Net quantity per day over the 30 days up to the last inventory day."""
    last = star.stock_day
    first = last and last - dt.timedelta(days=SALES_WINDOW_DAYS - 1)
    window = in_days(star.few_sales, first, last) if last else star.few_sales.where(F.lit(False))
    sold = window.groupBy("product_id").agg(*measures("net_qty"))
    return sold.select(
        "product_id",
        F.round(exact(F.col("net_qty")) / SALES_WINDOW_DAYS, 1).cast("decimal(12,1)").alias("avg_daily_sales_30d"))


def alert_level(stock: Column) -> Column:
    return (F.when(stock == 0, "critical").when(stock < URGENT_STOCK, "urgent")
            .when(stock < LOW_STOCK, "warning").otherwise("ok"))


def mart_inventory_alerts(star: Star) -> DataFrame:
    """Physical products below the stock threshold, with days left and the quantity to reorder."""
    low = latest_stock(star).where(F.col("closing_stock") < LOW_STOCK)
    books = star.product.where(F.col("format").isin(PHYSICAL_FORMATS)).select(
        "product_id", "title", "format", "genre", "publisher", "price_rub", "cost_rub")
    rows = low.join(books, "product_id").join(avg_daily_sales_30d(star), "product_id", "left")
    rate = F.coalesce("avg_daily_sales_30d", F.lit(0).cast("decimal(12,1)"))
    stock = F.col("closing_stock")
    order = F.greatest(F.lit(0), (F.ceil(rate * COVER_DAYS) - stock).cast("bigint"))
    left = F.when(rate > 0, F.round(stock.cast("decimal(12,1)") / F.nullif(rate, F.lit(0)), 0).cast("bigint"))
    return rows.select(
        "product_id", "title", "format", "genre", "publisher", "price_rub", "closing_stock",
        "is_low_stock", "stock_date", rate.alias("avg_daily_sales_30d"),
        left.alias("days_until_stockout"), order.alias("recommended_order_qty"),
        (order * F.col("cost_rub")).cast("decimal(20,2)").alias("recommended_order_cost"),
        alert_level(stock).alias("alert_level"))
