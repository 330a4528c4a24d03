"""The star schema derived from order-line tables (lineitem, orders, part).

Ship date is the sale date. All money is computed in whole cents, so that no result depends on how
an engine rounds a binary fraction.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators import ledger
from shelfline.operators.monthly import described_months, described_words
from shelfline.plans import planning
from shelfline.schemas import (
    BOOK_GENRES, COST_PERCENT, DIM_PRODUCT, FACT_SALES, LANGUAGES, LINE_ATTRIBUTES,
    PARTITION, PHYSICAL_FORMATS, SUBSCRIPTION,
)
from shelfline.star import Star

# --- fixed values of the mapping, repeated in the checking SQL ---
FORMAT_OF_TYPE = {
    "ECONOMY": "eBook", "SMALL": "Audiobook", "MEDIUM": "Paperback",
    "STANDARD": "Paperback", "LARGE": "Hardcover", "PROMO": "Subscription",
}
PLAN_GROWTH = 1.05
# --- end of fixed values ---

#: lines brought together by product in one task, on average at most: what a task sorts and sums does not grow with the
#: table, whatever the session makes of small partitions
TASK_LINES = 500_000
#: below this many lines a task of its own is not worth while
FEW_LINES = 10_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _as_money(cents: Column) -> Column:
    return cents.cast("decimal(20,0)") / 100


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _lookup(mapping: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def products(part: DataFrame) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    fmt = _lookup(FORMAT_OF_TYPE, F.col("p_type"))
    shaped = part.select("*", fmt.alias("format")).select(
        "*",
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"),
        _lookup(COST_PERCENT, F.col("format")).alias("percent"),
        F.col("format").isin(PHYSICAL_FORMATS).alias("physical"),
        (F.col("format") == SUBSCRIPTION).alias("subscription"),
    )
    book = ~F.col("subscription")
    return _typed(shaped.select(
        key.alias("product_id"),
        F.when(book, F.concat(F.lit("978"), F.lpad((key % 1000000000).cast("string"), 9, "0"),
                              (size % 10).cast("string"))).alias("isbn"),
        F.col("p_name").alias("title"),
        F.when(book, F.concat(F.lit("Author "), size.cast("string"))).alias("author"),
        F.when(book, F.col("p_brand")).alias("publisher"),
        F.date_add(F.lit(dt.date(1985, 1, 1)), (key % 3650).cast("int")).alias("published_date"),
        F.when(size % 7 != 0, _pick(LANGUAGES, size % 3)).alias("language"),
        F.when(F.col("physical"), 100 + size * 10).alias("page_count"),
        F.when(book, _pick(BOOK_GENRES, size % 10)).otherwise(SUBSCRIPTION).alias("genre"),
        "format",
        _as_money(F.col("price")).alias("price_rub"),
        _as_money(F.expr("(price * percent + 50) div 100")).alias("cost_rub"),
        ((size % 50).cast("decimal(3,0)") / 10).alias("avg_rating"),
        (key % 500).alias("review_count"),
        F.when(F.col("physical"), 20 + key % 60).alias("stock_initial"),
        F.col("physical").cast("int").alias("is_physical"),
    ), DIM_PRODUCT)


def order_lines(lineitem: DataFrame) -> DataFrame:
    """What a sales line is worked out from, in few short columns: lines are shuffled in this form."""
    return lineitem.select(
        F.col("l_linenumber").alias("line"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("list_price"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("discount"),
        (F.col("l_returnflag") == "R").cast("bigint").alias("returned"),
    )


def sales_lines(line: DataFrame, *more: str) -> DataFrame:
    """Lines of `order_lines` as sales before shortages are allocated; without a channel it is NULL."""
    line = line.withColumn("amount", F.expr("(list_price * (100 - discount) + 50) div 100"))
    if "channel" not in line.columns:
        line = line.withColumn("channel", F.lit(None))
    amounts = {
        "sales_id": F.col("order_id") * 10 + F.col("line"),
        "sales_qty": F.col("qty"),
        "return_qty": F.col("qty") * F.col("returned"),
        "unit_price": _as_money(F.expr("(2 * amount + qty) div (2 * qty)")),
        "sales_amount": _as_money(F.col("amount")),
        "return_amount": _as_money(F.col("amount") * F.col("returned")),
        "discount_percent": F.col("discount"),
        "is_promo": (F.col("discount") > 0).cast("int"),
        "promo_code": F.when(F.col("discount") > 0, F.concat(F.lit("D"), F.col("discount").cast("string"))),
        "lost_sales_qty": F.lit(0),
    }
    return line.select(*[amounts.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in FACT_SALES], *more)


def replenishments(product: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Every 60 to 120 days each physical product receives 10 to 40 copies, by key arithmetic."""
    every = (F.lit(60) + F.col("product_id") % 61).cast("int")
    start = F.date_add(F.lit(first), every - 1)
    days = F.when(start <= F.lit(last), F.sequence(start, F.lit(last), F.make_dt_interval(every)))
    return product.where(F.col("is_physical") == 1).select(
        "product_id", F.explode(days).alias("date"),
        (10 + F.col("product_id") % 31).alias("replenishment_qty"))


def line_tasks(lines: int, cores: int) -> int:
    """Tasks among which lines are dealt by product: all cores where there is enough for them, and more as lines grow."""
    return max(1, min(cores, lines // FEW_LINES), -(-lines // TASK_LINES))


class DriverTables:
    """Lazily derived tables of one data folder. `kept` writes a small table once, by name, and reads it back."""

    def __init__(self, spark: SparkSession, sf_dir: str, kept: Callable[[str, Callable[[], DataFrame]], DataFrame]):
        self.spark, self.sf_dir, self.kept = spark, sf_dir, kept
        self.product = products(read(spark, sf_dir, "part"))
        self.lineitem = read(spark, sf_dir, "lineitem")
        self.orders = read(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("channel"))
        self.first, self.last, lines = self.lineitem.agg(
            F.to_date(F.min("l_shipdate")), F.to_date(F.max("l_shipdate")), F.count("*")).first()
        self.tasks = line_tasks(lines, spark.sparkContext.defaultParallelism)

    def ledger(self, sales: DataFrame) -> DataFrame:
        """Stock ledger of sales that name their product's format."""
        physical = self.product.where(F.col("is_physical") == 1)
        sold = ledger.daily_net_sold(sales)
        moves = ledger.movements(
            sold, physical, replenishments(self.product, self.first, self.last), self.first, self.tasks)
        return ledger.stock_ledger(moves)

    def calendar(self) -> DataFrame:
        return planning.build_calendar(self.spark, self.first, self.last)

    def shortages(self) -> DataFrame:
        """Per product its days that fell short, as a map from the day to the share served: at most the days of
        the calendar. A line then finds its day where it meets its product, without being shuffled by day.

        The ledger is that of the sales as ordered."""
        def build() -> DataFrame:
            ordered = sales_lines(order_lines(self.lineitem)).select("product_id", "date", "sales_qty", "return_qty")
            physical = self.product.where(F.col("is_physical") == 1)
            short = ledger.short_days(self.ledger(ordered.join(physical.select("product_id", "format"), "product_id")))
            days = F.map_from_entries(F.collect_list(F.struct("date", "_served")))
            return short.where(F.col("date").isNotNull()).groupBy("product_id").agg(days.alias("short"))
        return self.kept("short_days", build)

    def _cut(self, lines: DataFrame, *more: str) -> DataFrame:
        """Lines that carry their product's `short` days as sales after shortages."""
        return ledger.cut_to_served(sales_lines(lines.withColumn("_served", F.col("short")[F.col("date")]), "_served", *more))

    def wide_sales(self) -> DataFrame:
        """Sales after shortages, each line carrying its channel, its month and its product's attributes. What can be
        worked out from a line is, after its last shuffle."""
        described = self.product.select("product_id", *LINE_ATTRIBUTES).join(self.shortages(), "product_id", "left")
        lines = order_lines(self.lineitem).join(self.orders, "order_id", "left").join(described, "product_id")
        return self._cut(lines.withColumn(PARTITION, F.trunc("date", "month")), *LINE_ATTRIBUTES, PARTITION)

    def _repeated_orders(self) -> DataFrame:
        """Orders that stand in the table more than once, and how often: so often a line counts. There are few,
        if any, so that lines need not be shuffled to meet their orders."""
        times = self.orders.groupBy("order_id").agg(F.count("*").cast("int").alias("times"))
        return self.kept("repeated_orders", lambda: times.where((F.col("times") > 1) & F.col("order_id").isNotNull()))

    def sums_lines(self, channel: bool = False) -> DataFrame:
        """Sales after shortages without attributes, for what sums them: brought together by product once, in few
        short columns, and neither written nor described. Lines of unknown products are still there. Without a
        `channel`, lines need not meet their orders."""
        lines = order_lines(self.lineitem)
        if channel:
            lines = lines.join(self.orders, "order_id", "left")
        else:
            lines = lines.join(self._repeated_orders(), "order_id", "left")
            lines = lines.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.coalesce("times", F.lit(1))))).drop("times", "_copy")
        short = self.shortages().repartition(self.tasks, "product_id")
        return self._cut(lines.repartition(self.tasks, "product_id").join(short, "product_id", "left"))

    def narrow_sales(self, channel: bool = False) -> DataFrame:
        """The same with their product's attributes; lines of unknown products are left out."""
        return self.sums_lines(channel).join(self.product.select("product_id", *LINE_ATTRIBUTES), "product_id")

    def months(self) -> DataFrame:
        return described_months(self.sums_lines(), self.product)

    def order_months(self) -> DataFrame:
        return described_words(self.sums_lines(), self.product)

    def span(self) -> tuple[dt.date | None, dt.date | None]:
        """First and last day on which a known product was sold. As a rule one was on the first and last day of
        all lines, and those are all that is read; else all lines are."""
        day = F.to_date("l_shipdate")
        known = self.lineitem.join(self.product.select(F.col("product_id").alias("l_partkey")), "l_partkey", "left_semi")

        def edge(of: dt.date | None, which: Callable) -> dt.date | None:
            there = of is not None and known.where(day == F.lit(of)).limit(1).count()
            return of if there else known.agg(which(day)).first()[0]
        return edge(self.first, F.min), edge(self.last, F.max)

    def plan(self, star: Star) -> DataFrame:
        return planning.plan_from_history(planning.plan_grid(star), self.first.year, growth=PLAN_GROWTH)

    def stock_ledger(self) -> DataFrame:
        return self.ledger(self.narrow_sales())

    def stock_runs(self) -> DataFrame:
        return ledger.stock_runs(self.stock_ledger(), self.last)
