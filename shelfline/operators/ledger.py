"""Running stock per product without a loop.

Closing stock floors at zero: closing = max(0, opening - sold + replenished). With S the initial stock
plus the running sum of (replenished - sold), closing = S - least(0, running minimum of S), and what
could not be served on a day is the fall of that running minimum. Both are windows over the days on
which something moved, so a product holds at most one row per calendar day however many lines it sold.

Two numbers per product are all that later days need: S and its minimum so far. A ledger goes on from them
without the days before (`ledger_state`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.schemas import FACT_INVENTORY, LOW_STOCK, PARTITION, PHYSICAL_FORMATS


def daily_net_sold(lines: DataFrame) -> DataFrame:
    """Net quantity per physical product and day."""
    return (
        lines.where(F.col("format").isin(PHYSICAL_FORMATS))
        .groupBy("product_id", "date")
        .agg(
            F.sum("sales_qty").alias("gross_sold"),
            F.sum(F.col("sales_qty").cast("bigint") - F.col("return_qty")).alias("net_sold"),
        )
    )


def dense_daily_net_sold(lines: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Same, with a zero row for each selling product and day without sales.

    Gaps are filled from each row up to the product's next row, so the dense rows are made where
    their product already is and are never shuffled.
    """
    sold = daily_net_sold(lines).select("product_id", "date", "net_sold")
    edge = sold.select("product_id").distinct().select(
        "product_id", F.lit(first).alias("date"), F.lit(0).cast("bigint").alias("net_sold"))
    daily = sold.unionByName(edge).groupBy("product_id", "date").agg(F.sum("net_sold").alias("net_sold"))
    gaps = daily.withColumn("next_date", _next_date(last))
    return _fill_days(gaps).select(
        "product_id", F.col("day").alias("date"),
        F.when(F.col("day") == F.col("date"), F.col("net_sold")).otherwise(0).alias("net_sold"),
    )


def _by_day() -> Window:
    return Window.partitionBy("product_id").orderBy("date")


def _next_date(last: dt.date) -> Column:
    return F.coalesce(F.lead("date").over(_by_day()), F.date_add(F.lit(last), 1))


def _fill_days(df: DataFrame) -> DataFrame:
    days = F.sequence(F.col("date"), F.date_sub("next_date", 1))
    return df.withColumn("day", F.explode(days))


def movements(sold: DataFrame, stock: DataFrame, replenished: DataFrame, first: dt.date,
              tasks: int | None = None) -> DataFrame:
    """One row per product and day on which stock moved, plus each product's first day.

    `stock` gives product_id and stock_initial, `replenished` product_id, date, replenishment_qty. Products are dealt
    among that many `tasks`, or as many as the session chooses.
    """
    zero = F.lit(0).cast("bigint")
    parts = [
        sold.select("product_id", "date", "gross_sold", "net_sold",
                    zero.alias("replenishment_qty"), zero.alias("initial")),
        replenished.select("product_id", "date", zero.alias("gross_sold"), zero.alias("net_sold"),
                           F.col("replenishment_qty").cast("bigint"), zero.alias("initial")),
        stock.select("product_id", F.lit(first).alias("date"), zero.alias("gross_sold"),
                     zero.alias("net_sold"), zero.alias("replenishment_qty"),
                     F.coalesce(F.col("stock_initial").cast("bigint"), zero).alias("initial")),
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    totals = ["gross_sold", "net_sold", "replenishment_qty", "initial"]
    # brought together by product once: days are summed and, later, put in order where they are
    dealt = every.repartition(tasks, "product_id") if tasks else every.repartition("product_id")
    return dealt.groupBy("product_id", "date").agg(*[F.sum(c).alias(c) for c in totals])


def later_movements(sold: DataFrame, stock: DataFrame, replenished: DataFrame, state: DataFrame, first: dt.date) -> DataFrame:
    """Movements from `first` on of products with a state, who get a row on that day even if nothing moved,
    and of new ones, who begin with their initial stock."""
    begun = stock.join(state.select("product_id"), "product_id", "left_anti")
    known = state.select("product_id", F.lit(0).alias("stock_initial"))
    return movements(sold, begun.select("product_id", "stock_initial").unionByName(known), replenished, first)


def ledger_state(ledger: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """What a later ledger goes on from: per product the running level and how far it fell below zero so far.

    Follows from the last closing stock and the shortages; a product without rows keeps its state `before`.
    """
    new = ledger.groupBy("product_id").agg(
        F.max_by("closing_stock", "date").alias("closing"), F.sum("shortage").alias("short"))
    if before is None:
        return new.select("product_id", (F.col("closing") - F.col("short")).alias("level"), F.col("short").alias("owed"))
    owed = F.coalesce("owed", F.lit(0)) + F.coalesce("short", F.lit(0))
    return before.join(new, "product_id", "full").select(
        "product_id", F.coalesce(F.col("closing") - owed, "level").alias("level"), owed.alias("owed"))


def stock_ledger(moves: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Adds opening_stock, closing_stock and shortage to each movement day, from nothing or from a state."""
    so_far = _by_day().rowsBetween(Window.unboundedPreceding, 0)
    before = _by_day().rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    if state is None:
        moves = moves.withColumns({"_level": zero, "_owed": zero})
    else:
        held = state.select("product_id", F.col("level").alias("_level"), F.col("owed").alias("_owed"))
        moves = moves.join(held, "product_id", "left").withColumns(
            {"_level": F.coalesce("_level", zero), "_owed": F.coalesce("_owed", zero)})
    level = moves.withColumn(
        "level",
        F.col("_level") + F.sum(F.col("initial") + F.col("replenishment_qty") - F.col("net_sold")).over(so_far),
    )
    owed = level.withColumn("owed", F.greatest("_owed", -F.min("level").over(so_far)))
    owed = owed.withColumn("owed_before", F.greatest("_owed", F.coalesce(-F.min("level").over(before), zero)))
    closing = F.col("level") + F.col("owed")
    return owed.select(
        "product_id", "date", "gross_sold", "net_sold", "replenishment_qty",
        (F.col("level") + F.col("owed_before") - F.col("replenishment_qty") + F.col("net_sold")).alias("opening_stock"),
        closing.alias("closing_stock"),
        (F.col("owed") - F.col("owed_before")).alias("shortage"),
    )


def stock_runs(ledger: DataFrame, last: dt.date) -> DataFrame:
    """One row per movement, with the day `until` which its closing stock holds: all that the daily rows up to
    `last` are made of (`days_of_runs`), at the size of the movements. `until_year` is meant as the folder."""
    runs = ledger.withColumn("until", F.date_sub(_next_date(last), 1)).where(F.col("date").isNotNull())
    return runs.select(
        "product_id", "date", "until", "opening_stock", "net_sold", "replenishment_qty", "closing_stock",
        F.year("until").alias("until_year"))


def days_of_runs(runs: DataFrame, first: dt.date, last: dt.date, since: dt.date | None = None,
                 until: dt.date | None = None) -> DataFrame:
    """The inventory rows of `stock_runs` on the days from `since` to `until`, numbered by the calendar from `first`
    to `last`. Days are made where a run is read: nothing is stored or shuffled but runs."""
    low, high = F.col("date"), F.col("until")
    if since is not None:
        runs = runs.where((F.col("until_year") >= since.year) & (F.col("until") >= F.lit(since)))
        low = F.greatest(low, F.lit(since))
    if until is not None:
        runs = runs.where(F.col("date") <= F.lit(until))
        high = F.least(high, F.lit(until))
    return _inventory_rows(runs.withColumn("day", F.explode(F.sequence(low, high))), first, last)


def repeated_days(runs: DataFrame) -> DataFrame:
    """Rows that repeat a product and day (`days`) or a row number (`ids`), from the runs: of each run the days that
    an earlier one of its product covers. A product without id has no row numbers either, which all are alike."""
    before = _by_day().rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("until").over(before), F.date_sub("date", 1))
    again = F.greatest(F.lit(0), F.date_diff(F.least(covered, F.col("until")), F.col("date")) + 1)
    per_product = runs.select("product_id", (F.date_diff("until", F.col("date")) + 1).alias("n"), again.alias("again")).groupBy(
        "product_id").agg(F.sum("n").alias("n"), F.sum("again").alias("again"))
    ids = F.when(F.col("product_id").isNull(), F.col("n") - 1).otherwise(F.col("again"))
    return per_product.agg(F.coalesce(F.sum("again"), F.lit(0)).alias("days"), F.coalesce(F.sum(ids), F.lit(0)).alias("ids"))


def daily_inventory(ledger: DataFrame, first: dt.date, last: dt.date, since: dt.date | None = None) -> DataFrame:
    """One inventory row per product and calendar day; a quiet day carries the last closing stock. Rows are
    numbered by product and day of the calendar from `first` to `last`; `since` tells the day a ledger that goes
    on from a state begins, and with it the rows.

    The table is stored by month, and the dense rows outnumber the movements by far. So the gaps are
    cut at month ends, these pieces are brought together by month, and only then become days: what is
    shuffled grows with products and months, not with days.
    """
    if since is not None:
        ledger = ledger.where(F.col("date") >= F.lit(since))
    until = F.date_sub("next_date", 1)
    months = F.sequence(F.trunc("date", "month"), F.trunc(until, "month"), F.expr("interval 1 month"))
    pieces = ledger.withColumn("next_date", _next_date(last)).withColumn(PARTITION, F.explode(months))
    placed = pieces.select("*", F.greatest("date", PARTITION).alias("piece_first"),
                           F.least(until, F.last_day(PARTITION)).alias("piece_last")).hint("rebalance", PARTITION)
    filled = placed.withColumn("day", F.explode(F.sequence("piece_first", "piece_last")))
    return _inventory_rows(filled, first, last, PARTITION)


def _inventory_rows(filled: DataFrame, first: dt.date, last: dt.date, *more: str) -> DataFrame:
    """Rows of movements and the quiet days after them (`day`) as inventory rows."""
    calendar_days = (last - first).days + 1
    moved = F.col("day") == F.col("date")
    kinds = {f.name: f.dataType for f in FACT_INVENTORY}
    rows = filled.select(
        (F.col("product_id") * calendar_days + F.date_diff("day", F.lit(first)) + 1).alias("inventory_id"),
        "product_id",
        F.col("day").alias("date"),
        F.when(moved, F.col("opening_stock")).otherwise(F.col("closing_stock")).alias("opening_stock"),
        F.when(moved, F.greatest(F.lit(0), "net_sold")).otherwise(0).alias("sold_qty"),
        F.when(moved, F.col("replenishment_qty")).otherwise(0).alias("replenishment_qty"),
        "closing_stock",
        (F.col("closing_stock") < LOW_STOCK).cast("int").alias("is_low_stock"),
        *more,
    )
    return rows.select(*[F.col(n).cast(k).alias(n) for n, k in kinds.items()], *more)


def allocate_shortage(sales: DataFrame, ledger: DataFrame) -> DataFrame:
    """Scales the lines of a short day down to what stock could serve.

    Quantities shrink by the day's ratio and are rounded half to even, amounts follow at the unit
    price, returns cannot exceed what was sold, and the cut is recorded as lost. Days that fell short
    are few, so the join side is small in practice; its size is measured, not assumed.
    """
    joined = sales.join(short_days(ledger), ["product_id", "date"], "left")
    return cut_to_served(joined).select(sales.columns)


def short_days(ledger: DataFrame) -> DataFrame:
    """The days that fell short, and the share of what was ordered that was served."""
    return ledger.where(F.col("shortage") > 0).select(
        "product_id", "date",
        ((F.col("gross_sold") - F.col("shortage")).cast("double") / F.nullif("gross_sold", F.lit(0))).alias("_served"),
    )


def cut_to_served(joined: DataFrame) -> DataFrame:
    """Sales lines with the share of their day that was served in `_served`, NULL on days that did not fall short."""
    is_short = F.col("_served").isNotNull()
    kept = F.greatest(F.lit(0), F.rint(F.col("sales_qty") * F.col("_served")).cast("int"))
    qty = F.when(is_short, kept).otherwise(F.col("sales_qty"))
    returned = F.least("return_qty", qty)
    amount = {
        "sales_amount": F.when(is_short, qty * F.col("unit_price")).otherwise(F.col("sales_amount")),
        "return_amount": F.when(
            F.col("return_qty") > qty, qty * F.col("unit_price")).otherwise(F.col("return_amount")),
    }
    lost = F.coalesce(F.col("lost_sales_qty"), F.lit(0)) + F.col("sales_qty") - qty
    changed = {
        "sales_qty": qty.cast("int"),
        "return_qty": returned.cast("int"),
        **{n: a.cast("decimal(14,2)") for n, a in amount.items()},
        "lost_sales_qty": lost.cast("int"),
    }
    return joined.select(*[
        changed[c].alias(c) if c in changed else F.col(c) for c in joined.columns if c != "_served"
    ])
