"""The five star-schema tables, handed to every mart as one object."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.dates import first_date, in_days, last_date
from shelfline.operators.monthly import in_months, order_words, product_months, with_month
from shelfline.schemas import LINE_ATTRIBUTES, PARTITION
from shelfline.sources.files import written

Table = DataFrame | Callable[[], DataFrame]


class Star:
    """Tables are DataFrames, or functions called when a table is first needed."""

    def __init__(self, spark: SparkSession, as_of: dt.date | None = None, **tables: Table):
        self.spark = spark
        self._as_of = as_of
        self._tables = dict(tables)
        self.work: str | None = None  # folder for written intermediates
        self.memo: dict = {}
        #: inventory rows between two days, where they are made from `stock_runs` when they are read
        self.inventory_days: Callable[[dt.date | None, dt.date | None], DataFrame] | None = None

    def __getitem__(self, name: str) -> DataFrame:
        table = self._tables[name]
        if callable(table):
            table = self._tables[name] = table()
        return table

    def at(self, as_of: dt.date) -> Star:
        """The same tables as they stood on a day. Both share what has been derived so far, and derive
        each further table once."""
        other = Star(self.spark, as_of)
        other._tables, other.inventory_days = self._tables, self.inventory_days
        return other

    def mart(self, build: Callable[[Star], DataFrame]) -> DataFrame:
        """A mart as its readers see it: written once and read, where this Star has a work folder;
        otherwise computed in place."""
        if self.work is None:
            return build(self)
        name = build.__name__
        if name not in self.memo:
            self.memo[name] = written(build(self), f"{self.work}/marts/{name}")
        return self.memo[name]

    @property
    def calendar(self) -> DataFrame:
        return self["dim_date"]

    @property
    def product(self) -> DataFrame:
        return self["dim_product"]

    @property
    def plan(self) -> DataFrame:
        return self["fact_plan"]

    @property
    def sales(self) -> DataFrame:
        """Sales up to the report day asked for; every mart reads them here."""
        return in_days(self["fact_sales"], None, self._as_of)

    def months(self, only: list[dt.date] | None = None) -> DataFrame:
        """Sales by product and month (see operators.monthly), up to the report day asked for: the stored
        months where there are any, with the month of that day summed from its lines."""
        return self._maintained("sales_months", product_months, only)

    def order_months(self, only: list[dt.date] | None = None) -> DataFrame:
        """Order numbers by product and month, as bits."""
        return self._maintained("order_months", lambda lines: order_words(with_month(lines)), only)

    def _maintained(self, name: str, build: Callable[[DataFrame], DataFrame], only: list[dt.date] | None) -> DataFrame:
        if name not in self._tables:
            rows = build(self.lines(*LINE_ATTRIBUTES))
        elif self._as_of is None:
            rows = self[name]
        else:
            month = self._as_of.replace(day=1)
            lines = self._described(in_days(self.few_sales, month, self._as_of), LINE_ATTRIBUTES)
            rows = self[name].where(F.col(PARTITION) < F.lit(month)).unionByName(build(lines).select(self[name].columns))
        return rows if only is None else in_months(rows, only)

    @property
    def few_sales(self) -> DataFrame:
        """Sales up to the report day asked for, of which only a few days are read; without a channel where they
        are not read from the stored table."""
        return in_days(self._unless_stored("narrow_sales"), None, self._as_of)

    def _unless_stored(self, name: str) -> DataFrame:
        """The sales as `name` derives them where nothing has asked for the stored table yet, which is not built for
        them then; else that table."""
        derived = callable(self._tables.get("fact_sales")) and name in self._tables
        return self[name if derived else "fact_sales"]

    def few_lines(self, first: dt.date | None, last: dt.date | None, *attributes: str) -> DataFrame:
        """Sales lines of a few days, up to the report day, with product attributes; with the channel if it is
        named among them."""
        name = "channel_sales" if "channel" in attributes else "narrow_sales"
        return self._described(in_days(in_days(self._unless_stored(name), None, self._as_of), first, last), attributes)

    def sales_rows(self) -> DataFrame:
        """The number of sales up to the report day (n), from their months where the lines are derived."""
        if callable(self._tables.get("fact_sales")) and "narrow_sales" in self._tables:
            return self.months().agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("n"))
        return self.sales.agg(F.count("*").alias("n"))

    def stock_rows(self) -> DataFrame:
        """The number of inventory rows up to the report day (n), from the runs where there are any."""
        if self.inventory_days is None:
            return self.inventory.agg(F.count("*").alias("n"))
        runs = self["stock_runs"]
        until = F.col("until")
        if self._as_of is not None:
            runs, until = runs.where(F.col("date") <= F.lit(self._as_of)), F.least(until, F.lit(self._as_of))
        return runs.agg(F.coalesce(F.sum(F.date_diff(until, F.col("date")) + 1), F.lit(0)).alias("n"))

    @property
    def inventory(self) -> DataFrame:
        return self.stock(None, None)

    def stock(self, first: dt.date | None, last: dt.date | None) -> DataFrame:
        """Inventory rows of these days, up to the report day asked for."""
        if self._as_of is not None:
            last = min(last or self._as_of, self._as_of)
        if self.inventory_days is not None:
            return self.inventory_days(first, last)
        return in_days(self["fact_inventory"], first, last)

    @cached_property
    def today(self) -> dt.date | None:
        """Report day: the one asked for, else the latest sale. One scalar, read once per Star, so
        that every mart filters by a literal."""
        return self._as_of or self._sales_span()[1]

    @cached_property
    def last_sale(self) -> dt.date | None:
        return self._sales_span()[1] if self._as_of is None else last_date(self.sales)

    @cached_property
    def first_sale(self) -> dt.date | None:
        return self._sales_span()[0] if self._as_of is None else first_date(self.sales)

    def _sales_span(self) -> tuple[dt.date | None, dt.date | None]:
        """First and last day of all sales, without building a stored table where the Star knows them otherwise."""
        if "sales_span" in self._tables:
            return self["sales_span"]
        return first_date(self["fact_sales"]), last_date(self["fact_sales"])

    @property
    def yesterday(self) -> dt.date | None:
        return self.today and self.today - dt.timedelta(days=1)

    @cached_property
    def stock_day(self) -> dt.date | None:
        if "stock_runs" not in self._tables:
            return last_date(self.inventory)
        runs, last = self["stock_runs"], F.col("until")
        if self._as_of is not None:
            runs, last = runs.where(F.col("date") <= F.lit(self._as_of)), F.least(last, F.lit(self._as_of))
        return runs.agg(F.max(last)).first()[0]

    def lines(self, *attributes: str, whole: bool = False) -> DataFrame:
        """Sales lines with product attributes, up to the report day or of the `whole` table. Attributes
        stored on the line cost nothing; the rest come from one join, broadcast or shuffled as the measured
        size of the product table decides."""
        return self._described(self["fact_sales"] if whole else self.sales, attributes)

    def _described(self, sales: DataFrame, attributes: Sequence[str]) -> DataFrame:
        missing = [a for a in attributes if a not in sales.columns]
        if not missing:
            return sales
        return sales.join(self.product.select("product_id", *missing), "product_id")
