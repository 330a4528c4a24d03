"""Commits, key files and maintained months of the store, and marts refreshed from them."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from shelfline.operators.monthly import distinct_orders, order_words, product_months
from shelfline.plans import refresh, sales
from shelfline.schemas import DIM_PRODUCT, FACT_INVENTORY, FACT_SALES
from shelfline.sources.store import Store
from shelfline.star import Star
from test_marts import sale, table

JAN, FEB, MAR = dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 3, 5)


def line(i, order, product, day, qty=1, **more):
    return sale(i, order, product, day, qty, 10.0, **more)


def stock(i, product, day, closing=5):
    return dict(inventory_id=i, product_id=product, date=day, opening_stock=9, sold_qty=0, replenishment_qty=0,
                closing_stock=closing, is_low_stock=1)


@pytest.fixture()
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"))
    products = table(spark, DIM_PRODUCT, [dict(product_id=i, title=f"t{i}", genre="Fiction", format="eBook" if i % 2 else "Paperback",
                                               price_rub=20, cost_rub=4, publisher="p") for i in range(1, 6)])
    history = [line(i, i // 2, 1 + i % 5, JAN if i % 3 else dt.date(2024, 1, 2)) for i in range(1, 31)]
    history += [line(100 + i, 50 + i % 4, 1 + i % 3, FEB) for i in range(12)]
    made.full_load({"dim_product": products, "fact_sales": table(spark, FACT_SALES, history),
                    "fact_inventory": table(spark, FACT_INVENTORY, [stock(i, i, JAN) for i in range(1, 6)])}, 1)
    return made


def frame(spark, schema, rows):
    return table(spark, schema, rows)


def plain(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def recomputed(store):
    lines = store.table("fact_sales")
    return plain(product_months(lines)), plain(order_words(lines))


def kept(store):
    star = store.star()
    return plain(star.months()), plain(star.order_months())


def test_taken_keys_are_found_without_reading_the_table(spark, store):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = frame(spark, FACT_SALES, [line(5, 1, 1, MAR), line(900, 1, 1, MAR)]).withColumn("_pos", F.monotonically_increasing_id())
        new = store.new_rows(batch, "fact_sales")
        assert [r.sales_id for r in new.collect()] == [900]
        plan = new._jdf.queryExecution().executedPlan().toString()
        plan = plan[:plan.find("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "keys_fact_sales_0" in plan and "Bucketed: true" in plan
    assert f"{store.root}/fact_sales" not in plan and "/fact_sales/" not in plan
    # above the stored keys nothing is exchanged: from their scan up to the join there are only a filter, a projection and a sort
    lines = plan.splitlines()
    at = next(i for i, text in enumerate(lines) if "keys_fact_sales_0" in text)
    depth = lambda text: len(re.match(r"[\s:+*()\-|]*", text).group())
    above, level = [], depth(lines[at])
    for text in reversed(lines[:at]):
        if depth(text) < level:
            above.append(text)
            level = depth(text)
            if "Join" in text:
                break
    assert "Join" in above[-1] and not any("Exchange" in t or "Shuffle" in t for t in above)


def test_both_facts_appear_together_or_not_at_all(spark, store):
    sold = frame(spark, FACT_SALES, [line(500, 9, 1, MAR)])
    broken = frame(spark, FACT_INVENTORY, [stock(500, 2, MAR)]).withColumn(
        "closing_stock", F.raise_error(F.lit("stop")).cast("int"))
    before = kept(store)
    with pytest.raises(Exception):
        store.insert({"fact_sales": sold, "fact_inventory": broken}, "day-1")
    assert store.table("fact_sales").count() == 42 and store.table("fact_inventory").count() == 5 and kept(store) == before
    assert store.existing_on_dates(sold, "fact_sales") == 0 and store.touched("day-1") is None
    # what the failed commit left behind neither blocks nor doubles the next one
    good = frame(spark, FACT_INVENTORY, [stock(500, 2, MAR)])
    done = store.insert({"fact_sales": sold, "fact_inventory": good}, "day-1")
    assert {n: i.inserted for n, i in done.items()} == {"fact_sales": 1, "fact_inventory": 1}
    assert store.table("fact_sales").count() == 43 and store.table("fact_inventory").count() == 6
    assert kept(store) == recomputed(store) and store.touched("day-1") == [dt.date(2024, 3, 1)]
    again = store.insert({"fact_sales": sold, "fact_inventory": good}, "day-1")
    assert {n: (i.received, i.inserted) for n, i in again.items()} == {"fact_sales": (1, 0), "fact_inventory": (1, 0)}
    unnamed = store.insert({"fact_sales": sold, "fact_inventory": good})
    assert {n: i.inserted for n, i in unnamed.items()} == {"fact_sales": 0, "fact_inventory": 0}
    assert store.existing_on_dates(sold, "fact_sales") == 1 and kept(store) == recomputed(store)


def test_both_unique_keys_of_stock(spark, store):
    rows = [stock(1, 9, MAR), stock(77, 1, JAN), stock(78, 1, MAR), stock(78, 2, MAR), stock(79, 1, MAR)]
    assert store.insert_rows(frame(spark, FACT_INVENTORY, rows), "fact_inventory").inserted == 1


def test_a_batch_touches_its_months_only(spark, store, tmp_path):
    marts = str(tmp_path / "marts")
    groups = {"trends": [sales.mart_sales_trends], "margin": [sales.mart_margin, sales.mart_margin_by_format],
              "subscriptions": [sales.mart_subscriptions, sales.mart_subscriptions_monthly]}
    refresh.refresh_all_marts(store.star(), marts, groups)
    store.insert({"fact_sales": frame(spark, FACT_SALES, [line(600, 50, 1, FEB), line(601, 51, 5, MAR), line(602, 51, 5, MAR)])}, "b")
    written = {f for name in ("sales_months", "order_months") for f in os.listdir(tmp_path / "store" / name / "_commit=2") if "=" in f}
    assert written == {"part_month=2024-02-01", "part_month=2024-03-01"}
    assert kept(store) == recomputed(store)
    state = store.star().months()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in state and "fact_sales" not in state
    status = refresh.refresh_all_marts(store.star(), marts, groups, store.touched("b")).collect()
    assert all(r.ok for r in status)
    runs = sorted(os.listdir(tmp_path / "marts" / "mart_sales_trends"))
    assert {f for f in os.listdir(tmp_path / "marts" / "mart_sales_trends" / runs[1]) if "=" in f} == {
        "month_start=2024-02-01", "month_start=2024-03-01"}
    star = Star(spark, None, **{n: store.table(n) for n in ("dim_product", "fact_sales")})
    for mart in (m for group in groups.values() for m in group):
        assert plain(refresh.published_mart(spark, marts, mart.__name__)) == plain(mart(star)), mart.__name__


def test_history_marts_read_no_lines(store):
    star = store.star()
    for mart in (sales.mart_sales_trends, sales.mart_abc, sales.mart_margin, sales.mart_margin_by_format,
                 sales.mart_margin_by_publisher, sales.mart_subscriptions, sales.mart_subscriptions_monthly):
        plan = mart(star)._jdf.queryExecution().executedPlan().toString()
        assert "/fact_sales" not in plan and "count(distinct order_id" not in plan, mart.__name__


def test_months_up_to_a_day(spark, store):
    store.insert({"fact_sales": frame(spark, FACT_SALES, [line(700, 60, 1, dt.date(2024, 2, 20)), line(701, 61, 1, MAR)])})
    for day in (dt.date(2024, 1, 2), JAN, dt.date(2024, 2, 10), MAR):
        lines = store.table("fact_sales").where(F.col("date") <= F.lit(day))
        star = store.star(day)
        assert (plain(star.months()), plain(star.order_months())) == (plain(product_months(lines)), plain(order_words(lines)))


def test_distinct_orders_of_any_numbers(spark):
    numbers = [0, 63, 64, 65, -1, -64, 1 << 62, -(1 << 62), (1 << 62) + 63, None, 5, 5]
    rows = [(g, n) for g in ("a", "b", None) for n in numbers] + [("c", None), ("b", 99)]
    words = order_words(spark.createDataFrame(rows, "g string, order_id bigint"), ["g"])
    assert {r.g: r.orders for r in distinct_orders(words, ["g"]).collect()} == {"a": 10, "b": 11, None: 10}
    assert distinct_orders(words, []).first().orders == 11


def test_compacting_keeps_everything(spark, store):
    for day in range(1, 4):
        store.insert({"fact_sales": frame(spark, FACT_SALES, [line(800 + day, 70, 1, dt.date(2024, 4, day))])}, f"day-{day}")
    before = plain(store.table("fact_sales")), kept(store)
    store.compact()
    gone = store.vacuum()
    assert "fact_sales/_commit=2" in gone and "sales_months/_commit=3" in gone and "keys_fact_sales_0/from=1" in gone
    assert (plain(store.table("fact_sales")), kept(store)) == before
    replay = frame(spark, FACT_SALES, [line(802, 70, 1, dt.date(2024, 4, 2)), line(990, 70, 1, dt.date(2024, 4, 2))])
    assert store.insert({"fact_sales": replay}, "day-2")["fact_sales"].inserted == 0
    assert store.insert({"fact_sales": replay}, "day-4")["fact_sales"].inserted == 1
    assert store.existing_on_dates(replay, "fact_sales") == 2 and store.latest_load() == 1
    assert store.vacuum() == []
