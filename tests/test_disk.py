"""What is written and shuffled on the way, and that the shorter forms hold the same."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.operators.monthly import order_words, product_months
from shelfline.plans import loading, validators
from shelfline.schemas import DIM_PRODUCT, FACT_SALES, LINE_ATTRIBUTES
from shelfline.sources import driver_extracts
from shelfline.sources.store import Store

DAY = dt.date(2024, 3, 5)


def raw_sales(spark, *rows):
    columns = ["sales_id", "order_id", "product_id", "sales_qty", "return_qty", "lost_sales_qty"]
    given = spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in columns))
    return given.select(
        F.monotonically_increasing_id().alias("_pos"), "*", F.lit(str(DAY)).alias("date"), F.lit("10.5").alias("unit_price"),
        (F.col("sales_qty") * 10.5).cast("string").alias("sales_amount"), F.lit("0").alias("return_amount"),
        F.lit("0").alias("discount_percent"), F.lit("0").alias("is_promo"), F.lit(None).cast("string").alias("promo_code"),
        F.lit("Web").alias("channel"))


def sales(spark):
    return raw_sales(
        spark, ("1", "1", "1", "2", "0", "0"), ("1", "2", "2", "3", "0", "0"), ("3", "3", "64", "1", "1", "0"),
        ("4", "4", "9", "1", "0", "0"), ("5", "5", "1", "0", "0", "0"), ("6", "1", "1", "2", "0", "0"),
        ("7", "7", "2", "1", "0", "4"), ("8", None, "x", "1", "0", "0"), ("9", "9", "-1", "1", "0", "0"))


def checked(spark, products, folder):
    stage = loading.staged(str(folder)) if folder else None
    result = validators.validate_fact_sales(sales(spark), products, DAY, DAY, stage=stage)
    return loading.settle(result, f"{folder}/checked") if folder else result


def products(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id bigint, format string")


def found(result):
    return sorted(tuple(r) for r in result.details().collect()), sorted(tuple(r) for r in result.clean.drop("promo_code").collect())


@pytest.mark.parametrize("described", [
    [(1, "Paperback"), (2, "eBook"), (64, "Audiobook"), (-1, "Hardcover")],
    [(1, "Paperback"), (1, "Paperback"), (2, "eBook"), (2, "Hardcover"), (64, "Audiobook")],
    [(1, "Scroll"), (2, None), (None, "eBook"), (64, "Subscription")]])
def test_formats_as_bits_find_what_the_products_say(spark, tmp_path, described):
    table = products(spark, *described)
    assert found(checked(spark, table, tmp_path)) == found(checked(spark, table, None))


def test_rows_are_staged_and_settled_in_the_types_of_the_table(spark, tmp_path):
    result = checked(spark, products(spark, (1, "Paperback"), (2, "eBook"), (64, "Audiobook"), (-1, "Hardcover")), tmp_path)
    kinds = {f.name: f.dataType for f in FACT_SALES}
    settled, staged = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("checked", "parsed"))
    assert settled.columns == ["_pos", "_reject", *kinds]
    for rows in (settled, staged):
        assert {f.name: f.dataType for f in rows.schema if f.name in kinds} == kinds
        assert [f.name for f in rows.schema if f.name.startswith("_raw_")] == []
    assert {r["_reject"] for r in settled.collect()} == {
        None, "S-01 repeated id", "S-04 unknown product", "S-08 quantity not positive", "S-03 repeated product in an order"}


def test_raw_lines_are_dealt_before_they_become_text(spark, tmp_path):
    lines = spark.createDataFrame([(k, 1, k, dt.datetime(2000, 1, 1), "N", 1.0, 10.0, 0.0) for k in range(9)], (
        "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate timestamp, l_returnflag string, l_quantity double, "
        "l_extendedprice double, l_discount double")).coalesce(1)
    orders = spark.createDataFrame([(k, "1-URGENT") for k in range(9)], "o_orderkey long, o_orderpriority string")
    raw = driver_extracts.fact_sales(lines, orders)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression" if "RepartitionByExpression" in plan else "Repartition") > plan.index("sales_amount")
    assert [r.order_id for r in raw.sort("_pos").collect()] == [str(k) for k in range(9)]


def test_months_of_lines_described_more_than_once(spark, tmp_path):
    def product(key, title, price=10):
        return {f.name: {"product_id": key, "title": title, "genre": "Poetry", "format": "eBook", "is_physical": 0}.get(f.name) for f in DIM_PRODUCT}

    lines = [{f.name: None for f in FACT_SALES} | dict(
        sales_id=k, order_id=k % 3, product_id=p, date=dt.date(2024, 1 + k % 2, 5), sales_qty=k, return_qty=0, is_promo=0, lost_sales_qty=0)
        for k, p in enumerate([1, 1, 2, 2, 3, 3, 9, None, 1], 1)]
    store = Store(spark, str(tmp_path / "store"))
    dim = spark.createDataFrame([product(1, "a"), product(2, "b"), product(2, "c"), product(3, "d"), product(3, "d"), product(3, "e")], DIM_PRODUCT)
    store.full_load({"dim_product": dim, "fact_sales": spark.createDataFrame(lines, FACT_SALES)}, 1)
    late = [x | dict(sales_id=100 + x["sales_id"], order_id=200) for x in lines if x["date"].month == 2]
    store.insert({"fact_sales": spark.createDataFrame(late, FACT_SALES)}, "late")
    star, stored = store.star(), store.table("fact_sales")
    key = lambda df: sorted(map(repr, map(tuple, df.collect())))
    for kept, summed in ((star.months(), product_months(stored)), (star.order_months(), order_words(stored))):
        assert key(kept.select(summed.columns)) == key(summed)
    assert set(LINE_ATTRIBUTES) <= set(star.months().columns)
    folders = [p.name for p in (tmp_path / "store/sales_months/_commit=1").iterdir() if p.is_dir()]
    assert folders == []  # sums of a full load are not shuffled by month


def test_negative_stock_counts_rows_of_any_day(spark, tmp_path):
    from shelfline.plans import checks
    from shelfline.schemas import FACT_INVENTORY
    from shelfline.star import Star
    from shelfline.sources.files import written

    days = [dt.date(2019, 1, 1), DAY, dt.date(2030, 1, 1)]
    rows = [(k, p, day, 0, 0, 0, closing, 1) for k, (p, day, closing) in enumerate(
        (p, day, closing) for p in (1, 2, 64, 9) for day in days for closing in (-3, 0, 5))]
    stock = written(spark.createDataFrame(rows, FACT_INVENTORY), str(tmp_path / "stock"))
    star = Star(spark, DAY, dim_product=products(spark, (1, "Paperback"), (2, "eBook"), (64, "Hardcover")), fact_inventory=stock)
    assert checks.negative_stock(star).first().violations == 6
