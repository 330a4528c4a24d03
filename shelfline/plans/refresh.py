"""Building all marts."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.plans import daily, plan_fact, sales, stock
from shelfline.star import Star

# Groups in the order they are built. The daily group follows the latest day as views.
DAILY = [daily.mart_daily_pulse, daily.mart_daily_channels, daily.mart_mtd_pulse,
         daily.mart_daily_revenue_mtd, daily.mart_daily_top5]
GROUPS: dict[str, list[Callable[[Star], DataFrame]]] = {
    "daily_pulse": DAILY,
    "plan_fact": [plan_fact.mart_plan_fact, plan_fact.mart_daily_breakdown,
                  plan_fact.mart_daily_format_pulse, plan_fact.mart_plan_fact_history],
    "inventory_alerts": [stock.mart_inventory_alerts],
    "sales_trends": [sales.mart_sales_trends],
    "abc": [sales.mart_abc],
    "margin": [sales.mart_margin, sales.mart_margin_by_format, sales.mart_margin_by_publisher],
    "subscriptions": [sales.mart_subscriptions, sales.mart_subscriptions_monthly],
}
VIEWS = {"daily_pulse"}

#: marts with rows of their own for every month; a batch changes those of its months only
MONTHLY = {sales.mart_sales_trends, sales.mart_margin_by_format, sales.mart_subscriptions_monthly}

STATUS = "step int, mart_group string, marts int, ok boolean, error string"
_MANIFEST = "run string, mart string, path string, columns string, months array<date>"
_RUN = "_run"


def materialise(mart: DataFrame, path: str, months: bool = False) -> None:
    writer = mart.hint("rebalance", "month_start").write.partitionBy("month_start") if months else mart.write
    writer.parquet(path)


def _runs(spark: SparkSession, folder: str) -> list:
    """Entries of the marts published so far, oldest first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return []
    return sorted(spark.read.schema(_MANIFEST).json(f"{folder}/manifest").collect(), key=lambda r: r.run)


def published_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart as the runs that completed its group left it: of a monthly mart, each month as the last run
    that brought it up to date did."""
    runs = [r for r in _runs(spark, folder) if r.mart == name]
    if not runs:
        raise ValueError(f"no run has published {name}")
    whole = max(i for i, r in enumerate(runs) if r.months is None)
    schema = T.StructType.fromJson(json.loads(runs[-1].columns))
    if whole == len(runs) - 1:
        return spark.read.schema(schema).parquet(runs[-1].path)
    changed: set = set()
    paths, tests = [], []
    for r in reversed(runs[whole:]):
        month, own = F.col("month_start"), set(r.months or ()) - changed
        in_run = month.isin(sorted(own)) if r.months is not None else ~month.isin(sorted(changed)) if changed else F.lit(True)
        tests.append((F.col(_RUN) == r.run) & in_run)
        paths.append(r.path)
        changed |= own
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(_RUN, T.StringType())])).option("basePath", f"{folder}/{name}").parquet(*paths)
    return rows.where(reduce(lambda a, b: a | b, tests)).select(schema.names)


def refresh_all_marts(star: Star, folder: str, groups: dict = GROUPS, months: list[dt.date] | None = None) -> DataFrame:
    """Builds every group; one that fails is reported and the rest go on.

    The marts of a group are written beside earlier runs and published together by one small manifest
    write: a group that fails half way leaves what readers see untouched. With `months` (those in which
    sales changed since the last run) the monthly marts are built and replaced in these months alone.
    """
    run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}"
    known = {r.mart for r in _runs(star.spark, folder)} if months is not None else set()
    status = []
    for step, (group, marts) in enumerate(groups.items(), 1):
        try:
            made = []
            for mart in marts:
                name = mart.__name__
                partly = mart in MONTHLY and name in known
                built = mart(star, months) if partly else mart(star)
                if group in VIEWS:
                    built.createOrReplaceTempView(name)
                else:
                    path = f"{folder}/{name}/{_RUN}={run}"
                    materialise(built, path, mart in MONTHLY)
                    made.append((run, name, path, built.schema.json(), months if partly else None))
            if made:
                star.spark.createDataFrame(made, _MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")
            status.append((step, group, len(marts), True, None))
        except Exception as failure:  # any failure of one group must not stop the others
            status.append((step, group, len(marts), False, str(failure).splitlines()[0]))
    return star.spark.createDataFrame(status, STATUS)
