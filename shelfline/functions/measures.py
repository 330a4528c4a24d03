"""Shared measures. Money is summed as whole cents in 64-bit integers.

A sum over decimal(14,2) cannot use the long fast path of the aggregation (its buffer is wider than
18 digits), and profit would multiply decimals on every row. Whole cents keep the per-row work in
primitive longs and the sums exact; the decimal is rebuilt once per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cents(name: str) -> Column:
    return (F.col(name) * 100).cast("bigint")


def money(total_cents: Column) -> Column:
    return (total_cents.cast("decimal(20,0)") / 100).cast("decimal(20,2)")


def exact(value: Column) -> Column:
    """A whole number as a decimal, so that a quotient is rounded from exact digits."""
    return value.cast("decimal(20,0)")


def ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Quotient rounded half away from zero; NULL when the denominator is 0."""
    return F.round(numerator / F.nullif(denominator, F.lit(0)), places)


def ratio_or_zero(numerator: Column, denominator: Column, places: int) -> Column:
    return F.when(denominator > 0, ratio(numerator, denominator, places)).otherwise(F.lit(0))


# --- per-line expressions ---

def net_qty() -> Column:
    return F.col("sales_qty").cast("bigint") - F.col("return_qty")


def net_cents() -> Column:
    return cents("sales_amount") - cents("return_amount")


def cost_cents() -> Column:
    return net_qty() * cents("cost_rub")


# --- aggregates by name ---

_AGGREGATES = {
    "orders": lambda: F.count_distinct("order_id"),
    "net_qty": lambda: F.sum(net_qty()),
    "gross_qty": lambda: F.sum("sales_qty"),
    "return_qty": lambda: F.sum("return_qty"),
    "lost_sales_qty": lambda: F.sum("lost_sales_qty"),
    "gross_revenue": lambda: money(F.sum(cents("sales_amount"))),
    "return_amount": lambda: money(F.sum(cents("return_amount"))),
    "net_revenue": lambda: money(F.sum(net_cents())),
    "total_cost": lambda: money(F.sum(cost_cents())),
    "gross_profit": lambda: money(F.sum(net_cents() - cost_cents())),
    "promo_orders": lambda: F.sum(F.col("is_promo").cast("bigint")),
    "promo_revenue": lambda: money(F.sum(F.when(F.col("is_promo") == 1, net_cents()).otherwise(0))),
    "basket_size": lambda: ratio(exact(F.count("*")), exact(F.count_distinct("order_id")), 4),
}


_MONTHLY = {
    **{n: (lambda n=n: F.sum(n)) for n in ("net_qty", "gross_qty", "return_qty", "lost_sales_qty", "promo_orders", "lines")},
    "gross_revenue": lambda: money(F.sum("gross_cents")),
    "return_amount": lambda: money(F.sum("return_cents")),
    "net_revenue": lambda: money(F.sum("net_cents")),
    "total_cost": lambda: money(F.sum("cost_cents")),
    "gross_profit": lambda: money(F.sum("profit_cents")),
    "promo_revenue": lambda: money(F.sum("promo_cents")),
    "lost_revenue": lambda: money(F.sum("lost_cents")),
    "products": lambda: F.count_distinct("product_id"),
}


def measures(*names: str, **renamed: str) -> list[Column]:
    """Aggregate columns: positional names keep their own name, keywords give `alias=measure`."""
    plain = [_AGGREGATES[n]().alias(n) for n in names]
    return plain + [_AGGREGATES[m]().alias(alias) for alias, m in renamed.items()]


def margin(profit: str = "gross_profit", revenue: str = "net_revenue") -> Column:
    return ratio_or_zero(F.col(profit), F.col(revenue), 4)


def average_order(revenue: str = "net_revenue", orders: str = "orders") -> Column:
    return ratio_or_zero(F.col(revenue), exact(F.col(orders)), 2)


def monthly(*names: str, **renamed: str) -> list[Column]:
    """The same aggregates over stored product months (see operators.monthly)."""
    plain = [_MONTHLY[n]().alias(n) for n in names]
    return plain + [_MONTHLY[m]().alias(alias) for alias, m in renamed.items()]


def beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two aggregates of the same groups put together by key; a NULL key is a key like any other."""
    other = right.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return left.join(other, same, "left").drop(*[f"_key{i}" for i in range(len(keys))])
