"""Raw extracts, every column text, shaped from the driver tables for the quality rules.

The faults come from the data: order numbers that repeat, prices before discount, days beyond the
period, identifiers of zero, and spellings that differ by the order's priority.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.rules import POSITION
from shelfline.schemas import BOOK_GENRES, COST_PERCENT, PHYSICAL_FORMATS, SUBSCRIPTION
from shelfline.sources.driver_star import FORMAT_OF_TYPE, _lookup, _pick

# --- parameters of the registered checks, repeated in the checking SQL ---
START = dt.date(1996, 1, 1)
AS_OF = dt.date(2001, 6, 30)
PLAN_YEARS = (1996, 2000)
# --- end of parameters ---


def _text(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(POSITION, *[c.cast("string").alias(n) for n, c in columns.items()])


def _placed(df: DataFrame, *columns: str | Column) -> DataFrame:
    """These columns with their place in file order, taken at the scan. The driver's files are few and may be small:
    where they make fewer tasks than there are cores, rows are dealt out in this short form, before they become text."""
    placed = df.select(F.monotonically_increasing_id().alias(POSITION), *columns)
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return placed.repartition(tasks) if placed.rdd.getNumPartitions() < tasks else placed


def _cents(value: Column) -> Column:
    return (value.cast("decimal(20,0)") / 100).cast("decimal(20,2)")


def _by_priority(urgent, high, medium, unspecified, low) -> Column:
    p = F.col("o_orderpriority")
    return (F.when(p == "1-URGENT", urgent).when(p == "2-HIGH", high).when(p == "3-MEDIUM", medium)
            .when(p == "4-NOT SPECIFIED", unspecified).otherwise(low))


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per order date as written on the order, repeats included."""
    d = F.to_date("o_orderdate")
    iso = F.date_format(d, "yyyy-MM-dd")
    written = _by_priority(iso, F.date_format(d, "yyyyMMdd"), iso, F.date_format(d, "yyyy-M-d"), F.concat(F.lit("  "), iso))
    weekend = F.when(F.weekday(d) >= 5, 1).otherwise(0)
    return _text(
        _placed(orders, "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"), date=written,
        year=F.year(d) + F.when(F.col("o_orderkey") % 10 == 0, 1).otherwise(0),
        month=F.month(d), quarter=F.quarter(d),
        is_weekend=F.when(F.col("o_orderstatus") == "F", F.lit("True")).otherwise(weekend.cast("string")),
        is_holiday_ru=F.when(F.col("o_orderstatus") == "F", "0").when(F.col("o_orderstatus") == "O", "1").otherwise(" "))


def dim_product(part: DataFrame) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    df = _placed(part, "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice").withColumn("format", _lookup(FORMAT_OF_TYPE, F.col("p_type"))).withColumns({
        "price": F.round(F.col("p_retailprice") * 100).cast("bigint"),
        "percent": _lookup(COST_PERCENT, F.col("format"))})
    genre = F.when(size % 12 < 10, _pick(BOOK_GENRES, size % 12)).when(size % 12 == 10, SUBSCRIPTION).otherwise("Other")
    return _text(
        df, product_id=key,
        isbn=F.concat(F.lit("978-"), F.lpad(key.cast("string"), 9, "0"), F.lit("-"), (size % 10).cast("string")),
        title=F.concat(F.lit(" "), F.col("p_name")),
        author=F.when(size % 7 != 0, F.concat(F.lit("Author "), size.cast("string"))),
        publisher=F.when(size % 11 != 0, F.col("p_brand")).otherwise(""),
        published_date=F.lit("2020-01-31"), language=F.lit("English"),
        page_count=F.when(size % 5 != 0, 100 + size), genre=genre, format=F.col("format"),
        price_rub=_cents(F.col("price")), cost_rub=_cents(F.expr("price * percent div 100") + size * 1000),
        avg_rating=(size.cast("decimal(4,0)") / 8).cast("decimal(6,3)"), review_count=key % 500,
        stock_initial=key % 60, is_physical=(F.col("p_type") == "LARGE"))


def fact_plan(plan: DataFrame) -> DataFrame:
    df = plan.withColumn(POSITION, F.col("plan_id"))
    return _text(df, **{c: F.col(c) for c in plan.columns})


def fact_sales(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines at list price before discount, in file order."""
    line = _placed(
        lineitem, "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("list_price"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("discount"))
    df = line.join(orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    amount = F.expr("(list_price * (100 - discount) + 50) div 100")
    returned = F.col("l_returnflag") == "R"
    return _text(
        df, sales_id=F.col("l_orderkey") * 10 + F.col("l_linenumber"), order_id=F.col("l_orderkey"),
        product_id=F.col("l_partkey"), date=F.date_format("l_shipdate", "yyyy-MM-dd"), sales_qty=F.col("qty"),
        return_qty=F.when(returned, F.col("qty")).otherwise(0),
        unit_price=_cents(F.expr("(2 * list_price + qty) div (2 * qty)")), sales_amount=_cents(amount),
        return_amount=F.when(returned, _cents(amount)).otherwise(F.lit(0)),
        discount_percent=F.col("discount"), is_promo=(F.col("discount") >= 5).cast("int"),
        promo_code=F.when(F.col("discount") < 10, F.concat(F.lit("D"), F.col("discount").cast("string"))),
        channel=_by_priority(F.lit("Web"), F.lit("Mobile App"), F.lit("API Partner"), F.lit(""), F.lit(" Web ")),
        lost_sales_qty=F.lit(0))


def fact_inventory(ledger: DataFrame) -> DataFrame:
    """Stock rows of the days on which something moved; net returns show as negative sales."""
    df = ledger.withColumn(POSITION, F.struct("product_id", "date"))
    closing = F.col("closing_stock")
    return _text(
        df, inventory_id=F.xxhash64("product_id", "date"), product_id=F.col("product_id"), date=F.col("date"),
        opening_stock=F.col("opening_stock"), sold_qty=F.col("net_sold"),
        replenishment_qty=F.col("replenishment_qty"), closing_stock=closing,
        is_low_stock=F.when(closing < 10, "1").otherwise("0"))
