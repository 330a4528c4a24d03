"""The star schema of one data folder, written once per application and then read by every mart."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.operators import ledger
from shelfline.schemas import PARTITION
from shelfline.session import shared_dir
from shelfline.sources import driver_extracts
from shelfline.sources.driver_star import DriverTables, read
from shelfline.sources.files import COMPRESSION
from shelfline.star import Star

_stars: dict[tuple[str, str], Star] = {}


def open_star(spark: SparkSession, sf_dir: str) -> Star:
    """Star over written tables. Each table is derived and written the first time it is asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stars:
        _stars[key] = _star(spark, sf_dir)
    return _stars[key]


def _star(spark: SparkSession, sf_dir: str) -> Star:
    app = spark.sparkContext.applicationId
    folder = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
    root = f"{shared_dir(spark)}/shelfline/{app}/{folder}"
    star = Star(spark)
    star.work = root

    made: dict[str, DataFrame] = {}

    def kept(name: str, build: Callable[[], DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
        """A table written the first time it is asked for."""
        if name not in made:
            df, path = build(), f"{root}/{name}"
            df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*by).parquet(path)
            made[name] = spark.read.schema(df.schema).parquet(path)
        return made[name]

    derived = DriverTables(spark, sf_dir, kept)

    def by_month(build: Callable[[], DataFrame], then: str = "product_id") -> Callable[[], DataFrame]:
        """Rows made product by product stay where they are: sorted by month in each file, they are found by
        the footers without being shuffled into folders."""
        return lambda: build().sortWithinPartitions(PARTITION, then)

    star._tables = {
        "dim_date": derived.calendar,
        "dim_product": lambda: kept("dim_product", lambda: derived.product),
        "fact_sales": lambda: kept("fact_sales", by_month(derived.wide_sales, "date")),
        "fact_plan": lambda: kept("fact_plan", lambda: derived.plan(star)),
        "sales_span": derived.span,
        "narrow_sales": derived.narrow_sales,
        "channel_sales": lambda: derived.narrow_sales(channel=True),
        "sales_months": lambda: kept("sales_months", by_month(derived.months)),
        "order_months": lambda: kept("order_months", by_month(derived.order_months)),
        "stock_ledger": derived.stock_ledger,
        "stock_runs": lambda: kept("stock_runs", derived.stock_runs, ("until_year",)),
        "fact_inventory": lambda: star.inventory_days(None, None),
    }
    star.inventory_days = lambda since, until: ledger.days_of_runs(
        star["stock_runs"], derived.first, derived.last, since, until)

    source = functools.partial(read, spark, sf_dir)
    star._tables |= {name: lambda name=name: source(name) for name in ("part", "orders")}
    # raw extracts are text made where they are read, and not landed: positions are taken at the scan or from keys,
    # so they are the same in every pass
    star._tables |= {
        "raw_dim_date": lambda: driver_extracts.dim_date(source("orders")),
        "raw_dim_product": lambda: driver_extracts.dim_product(source("part")),
        "raw_fact_plan": lambda: driver_extracts.fact_plan(star.plan),
        "raw_fact_sales": lambda: driver_extracts.fact_sales(source("lineitem"), source("orders")),
        "raw_fact_inventory": lambda: driver_extracts.fact_inventory(star["stock_ledger"]),
    }
    return star
