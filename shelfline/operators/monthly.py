"""Maintained aggregates of sales: totals by product and month, and order numbers as bits.

Both are mergeable: totals add up, days and order numbers are sets of bits that are or-ed, so a batch is
aggregated on its own and merged into the months it touches, and any coarser group follows from the stored
rows without going back to the lines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.measures import cents, cost_cents, net_cents, net_qty
from shelfline.schemas import LINE_ATTRIBUTES, PARTITION

#: stored lines carry the attributes of their product as of their load, so these belong to the key
KEY = [PARTITION, "product_id", *LINE_ATTRIBUTES]


def _sums() -> dict[str, Column]:
    promo = F.when(F.col("is_promo") == 1, net_cents()).otherwise(0)
    return {
        "lines": F.lit(1), "net_qty": net_qty(), "gross_qty": F.col("sales_qty"), "return_qty": F.col("return_qty"),
        "lost_sales_qty": F.col("lost_sales_qty"), "gross_cents": cents("sales_amount"), "return_cents": cents("return_amount"),
        "net_cents": net_cents(), "cost_cents": cost_cents(), "profit_cents": net_cents() - cost_cents(),
        "promo_orders": F.col("is_promo").cast("bigint"), "promo_cents": promo,
        "lost_cents": F.col("lost_sales_qty").cast("bigint") * cents("unit_price"),
    }


SUMS = ["lines", "net_qty", "gross_qty", "return_qty", "lost_sales_qty", "gross_cents", "return_cents", "net_cents",
        "cost_cents", "profit_cents", "promo_orders", "promo_cents", "lost_cents"]


def _day() -> Column:
    return F.expr("shiftleft(1L, dayofmonth(date))")


def with_month(df: DataFrame) -> DataFrame:
    return df if PARTITION in df.columns else df.withColumn(PARTITION, F.trunc("date", "month"))


def product_months(lines: DataFrame) -> DataFrame:
    """One row per month and product sold: sums, the days with sales as bits, first and last day."""
    return with_month(lines).groupBy(*KEY).agg(
        *[F.sum(c.cast("bigint")).alias(n) for n, c in _sums().items()], F.bit_or(_day()).alias("days"),
        F.min("date").alias("first_day"), F.max("date").alias("last_day"))


#: of the descriptions of a product, how many are like this one, and how many there are
SAME, TIMES = "_same", "_times"


def descriptions(product: DataFrame) -> DataFrame:
    """The distinct descriptions of each product, as a rule one."""
    like = product.groupBy("product_id", *LINE_ATTRIBUTES).agg(F.count("*").alias(SAME))
    return like.withColumn(TIMES, F.sum(SAME).over(Window.partitionBy("product_id")))


def described_months(lines: DataFrame, product: DataFrame, how: str = "inner") -> DataFrame:
    """`product_months` of lines without attributes: summed by product and month first, then described, so that
    lines travel with their numbers alone. A product described twice has its sums in two rows; a `left` join keeps
    those of unknown products. With `descriptions` as the product table, lines are taken to stand once per description
    of their product, of which each gets its part."""
    net = F.when(net_qty().isNotNull() & net_cents().isNotNull(), 1)
    sums = {n: c for n, c in _sums().items() if n not in ("cost_cents", "profit_cents")}
    sums |= {"_qty": net * net_qty(), "_cents": net * net_cents()}
    narrow = with_month(lines).groupBy(PARTITION, "product_id").agg(
        *[F.sum(c.cast("bigint")).alias(n) for n, c in sums.items()], F.bit_or(_day()).alias("days"),
        F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    cost = cents("cost_rub")
    shared = [c for c in (SAME, TIMES) if c in product.columns]
    described = narrow.join(product.select("product_id", *LINE_ATTRIBUTES, *shared), "product_id", how)
    if shared:
        described = described.withColumns({n: F.expr(f"{n} * coalesce({SAME}, 1) div coalesce({TIMES}, 1)") for n in sums})
    return described.withColumns(
        {"cost_cents": F.col("net_qty") * cost, "profit_cents": F.col("_cents") - F.col("_qty") * cost}).select(
        *KEY, *SUMS, "days", "first_day", "last_day")


def described_words(lines: DataFrame, product: DataFrame, how: str = "inner") -> DataFrame:
    """`order_words` by product and month of lines without attributes."""
    return order_words(with_month(lines), [PARTITION, "product_id"]).join(
        product.select("product_id", *LINE_ATTRIBUTES), "product_id", how).select(*KEY, "word", "bits")


def merged_months(parts: DataFrame) -> DataFrame:
    """Rows of `product_months` from several sources, put together by key."""
    return parts.groupBy(*KEY).agg(
        *[F.sum(n).alias(n) for n in SUMS], F.bit_or("days").alias("days"),
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")).select(parts.columns)


def order_words(lines: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """The distinct order numbers of each group, 64 to a row: `word` holds their leading bits, `bits` which
    of the 64 numbers below it occur. Lines without order number are in no group."""
    held = lines.where(F.col("order_id").isNotNull())
    bit = F.expr("shiftleft(1L, cast(order_id & 63 as int))")
    return held.groupBy(*keys, F.shiftright("order_id", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def merged_words(parts: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    return parts.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits")).select(parts.columns)


def distinct_orders(words: DataFrame, keys: Sequence[str], name: str = "orders") -> DataFrame:
    """Exact number of distinct orders per group of `keys`, from words of any finer groups."""
    count = F.sum(F.bit_count("bits")).cast("bigint").alias(name)
    return words.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits")).groupBy(*keys).agg(count)


def in_months(df: DataFrame, months: Iterable[dt.date]) -> DataFrame:
    """Rows of the given months: literals, so that other folders are not listed."""
    return df.where(F.col(PARTITION).isin(sorted(months)))
