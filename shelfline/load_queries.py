"""Registered queries that exercise files, the store, loads and the update stream."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.measures import monthly
from shelfline.operators.monthly import distinct_orders
from shelfline.plans import loading, validators
from shelfline.plans.refresh import MONTHLY, published_mart, refresh_all_marts
from shelfline.schemas import DIM_PRODUCT, FACT_SALES, PARTITION
from shelfline.sources import driver_extracts, files
from shelfline.sources.store import Store
from shelfline.star import Star
from shelfline.streaming.updates import stream_updates

# --- parameter of the registered queries, repeated in the checking SQL ---
CUTOFF = dt.date(2001, 6, 1)
# --- end of parameter ---


def _folder(star: Star, name: str) -> str:
    """A folder of its own for every run."""
    return f"{star.work}/{name}-{uuid.uuid4().hex[:8]}"


def csv_round_trip(star: Star) -> DataFrame:
    """The product table written as CSV, read back as text and cast to its types."""
    path = _folder(star, "csv")
    files.write_csv(star.product, path)
    return files.cast_types(files.read_csv(star.spark, path), "dim_product").select(*DIM_PRODUCT.names)


def csv_fallback_charset(star: Star) -> DataFrame:
    """Products written in the fallback charset beside a file in UTF-8, and read back."""
    path, key = _folder(star, "charsets"), F.col("p_partkey")
    rows = star["part"].select(
        key.alias("product_id"), F.concat(F.lit("Книга "), key).alias("title"),
        F.when(key % 2 == 0, F.concat("p_brand", F.lit(" «Ё»"))).alias("publisher"))
    star.spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    for charset, rest in ((files.FALLBACK_CHARSET, 0), ("UTF-8", 1)):
        rows.where(F.col("product_id") % 3 % 2 == rest).write.option("header", True).option("encoding", charset).csv(f"{path}/{rest}")
    return files.read_csv(star.spark, f"{path}/*").drop("_pos")


def history_update_split(star: Star) -> DataFrame:
    """Sales split at the last day into history and update files, each read back and counted."""
    paths = files.split_history_update(
        star.sales.select(*FACT_SALES.names), _folder(star, "split"), "sales", star.today)
    parts = [
        files.cast_types(files.read_csv(star.spark, path), "fact_sales").agg(
            F.count("*").alias("rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
            F.sum("sales_qty").alias("qty")).select(F.lit(part).alias("part"), "*")
        for part, path in paths.items()]
    return parts[0].unionByName(parts[1])


def _sales_store(star: Star) -> Store:
    """A store holding the products and the sales before the cutoff."""
    store = Store(star.spark, _folder(star, "store"))
    history = star.sales.where(F.col("date") < F.lit(CUTOFF)).select(*FACT_SALES.names)
    store.full_load({"dim_product": star.product, "fact_sales": history}, load_id=1)
    return store


def _from_cutoff(df: DataFrame) -> DataFrame:
    return df.where(F.col("date") >= F.lit(CUTOFF))


def full_load(star: Star) -> DataFrame:
    """Tables replaced twice: readers see the second load only."""
    store = _sales_store(star)
    store.full_load({"dim_product": star.product, "fact_sales": _from_cutoff(star.sales).select(*FACT_SALES.names)}, load_id=2)
    counts = [store.table(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("tbl"), "rows")
              for n in ("dim_product", "fact_sales")]
    return counts[0].unionByName(counts[1])


def load_dim_product(star: Star) -> DataFrame:
    return _sales_store(star).load_dim_product()


def insert_rows(star: Star) -> DataFrame:
    """Sales from the cutoff appended twice, and what was on their days before each time."""
    store, batch = _sales_store(star), _from_cutoff(star.sales).select(*FACT_SALES.names)
    runs = []
    for run in (1, 2):
        existing = store.existing_on_dates(batch, "fact_sales")
        done = store.insert_rows(batch, "fact_sales")
        runs.append((run, existing, done.received, done.inserted, done.skipped))
    return star.spark.createDataFrame(runs, "run int, existing bigint, received bigint, inserted bigint, skipped bigint")


def _checked_history(star: Star, store: Store, product: DataFrame) -> None:
    raw = star["raw_fact_sales"].where(F.col("date") < F.lit(str(CUTOFF)))
    history = validators.validate_fact_sales(
        raw, product, driver_extracts.START, driver_extracts.AS_OF, stage=loading.staged(f"{store.root}/stage_history"))
    settled = loading.settle(history, f"{store.root}/checked_history")
    store.full_load({"dim_product": product, "fact_sales": settled.clean}, load_id=1)


def _stored(store: Store) -> DataFrame:
    return store.table("fact_sales").groupBy(F.trunc("date", "month").alias("month_start")).agg(
        F.count("*").alias("rows"), F.sum("sales_qty").alias("qty"))


def _product(star: Star) -> DataFrame:
    stage = loading.staged(_folder(star, "stage_product"))
    return validators.validate_dim_product(star["raw_dim_product"], stage).clean.checkpoint()


def incremental_load(star: Star) -> DataFrame:
    """Raw history loaded, the raw update validated and appended twice; the table by month."""
    store, product = Store(star.spark, _folder(star, "incremental")), _product(star)
    _checked_history(star, store, product)
    batch = star["raw_fact_sales"].where(F.col("date") >= F.lit(str(CUTOFF)))
    for run in (1, 2):
        loading.daily_update(star.spark, store, {"fact_sales": batch}, f"{store.root}/run{run}",
                             driver_extracts.START, driver_extracts.AS_OF, CUTOFF)
    return _stored(store)


def stream_load(star: Star) -> DataFrame:
    """The same update arriving as CSV files on a stream."""
    store, product = Store(star.spark, _folder(star, "stream")), _product(star)
    _checked_history(star, store, product)
    incoming = f"{store.root}/incoming"
    update = star["raw_fact_sales"].where(F.col("date") >= F.lit(str(CUTOFF)))
    files.write_csv(update.sort("_pos").drop("_pos"), incoming)
    query = stream_updates(star.spark, store, "fact_sales", incoming, f"{store.root}/work",
                           driver_extracts.START, driver_extracts.AS_OF, CUTOFF)
    query.awaitTermination()
    return _stored(store)


def _renumbered(lines: DataFrame, sign: int) -> DataFrame:
    """Lines with ids of their own: those of the driver table repeat."""
    return lines.withColumn("sales_id", sign * (F.monotonically_increasing_id() + 1)).select(*FACT_SALES.names)


def _updated_store(star: Star, marts: str | None = None) -> Store:
    """Sales before the cutoff loaded, those from it appended in two batches; with a folder, marts built after
    the load and brought up to date after each batch in the months it touched."""
    store = Store(star.spark, _folder(star, "maintained"))
    store.full_load({"dim_product": star.product, "fact_sales": _renumbered(star.sales.where(F.col("date") < F.lit(CUTOFF)), 1)}, 1)
    groups = {f.__name__: [f] for f in MONTHLY}
    if marts:
        refresh_all_marts(store.star(), marts, groups)
    late = _renumbered(_from_cutoff(star.sales), -1).checkpoint()
    for batch, rows in (("odd", late.where("sales_id % 2 <> 0")), ("even", late.where("sales_id % 2 = 0"))):
        store.insert({"fact_sales": rows}, batch)
        if marts:
            refresh_all_marts(store.star(), marts, groups, store.touched(batch))
    return store


def maintained_months(star: Star) -> DataFrame:
    """Totals and distinct orders by month, from the aggregates the store kept up to date."""
    kept = _updated_store(star).star()
    month = F.col(PARTITION).alias("month_start")
    sums = kept.months().groupBy(month).agg(*monthly("lines", "net_qty", "net_revenue", "gross_profit", "products"))
    orders = distinct_orders(kept.order_months().select(month, "word", "bits"), ["month_start"])
    return sums.join(orders, "month_start")


def trends_of_touched_months(star: Star) -> DataFrame:
    """Sales trends as published after two batches, each of which rewrote the months it touched."""
    marts = _folder(star, "touched_marts")
    _updated_store(star, marts)
    return published_mart(star.spark, marts, "mart_sales_trends")


def refresh_status(star: Star) -> DataFrame:
    """Every mart built and written; one status row per group."""
    return refresh_all_marts(star, _folder(star, "marts"))


LOADING: dict[str, Callable[[Star], DataFrame]] = {
    "csv_round_trip": csv_round_trip,
    "csv_fallback_charset": csv_fallback_charset,
    "history_update_split": history_update_split,
    "full_load": full_load,
    "load_dim_product": load_dim_product,
    "insert_rows": insert_rows,
    "incremental_load": incremental_load,
    "stream_load": stream_load,
    "refresh_all_marts": refresh_status,
    "maintained_months": maintained_months,
    "trends_of_touched_months": trends_of_touched_months,
}
