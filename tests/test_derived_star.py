"""The star derived from the driver tables: what is written for a query, and rows made when they are read."""

import datetime as dt
import os

from pyspark.sql import functions as F

from shelfline.operators import ledger
from shelfline.operators.monthly import described_months, described_words, order_words, product_months, with_month
from shelfline.plans import adhoc, daily, loading, refresh, sales, stock, validators
from shelfline.schemas import LINE_ATTRIBUTES
from shelfline.sources import driver_star
from shelfline.sources.warehouse import open_star

START = dt.date(2024, 1, 1)


def _tables(spark, folder):
    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
    spark.createDataFrame(
        [(k, f"part {k}", "Brand", t, 5 + k, 10.0 + k) for k, t in enumerate(["MEDIUM", "LARGE", "ECONOMY", "PROMO", "MEDIUM"])],
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    ).coalesce(1).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(i, "1-URGENT") for i in range(40)] + [(7, "2-HIGH")], "o_orderkey bigint, o_orderpriority string"
                          ).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(i % 40, i % 5 if i % 50 else 99, 1 + i % 7, 8.0 + i % 9, 100.0 + i, (i % 3) / 10, "R" if i % 11 == 0 else "N", day(i % 150))
         for i in range(400)] + [(1, 2, 1, None, 5.0, 0.1, "N", day(3)), (2, 2, 1, 4.0, 5.0, 0.1, None, day(3))],
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_returnflag string, l_shipdate timestamp").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return open_star(spark, str(folder))


def _rows(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


def test_inventory_is_stored_as_runs(spark, tmp_path):
    star = _tables(spark, tmp_path)
    moves = star["stock_ledger"].count()
    days = star.inventory.count()
    stock.mart_inventory_alerts(star).collect()
    stored = {name: spark.read.parquet(f"{star.work}/{name}").count() for name in os.listdir(star.work)}
    assert stored["stock_runs"] == moves < days == 3 * 150
    # alerts look at the last days only: neither daily stock nor sales lines are written for them
    assert not {"fact_inventory", "fact_sales"} & set(stored)
    last = star.stock_day
    assert _rows(star.stock(last, last)) == _rows(star.inventory.where(F.col("date") == F.lit(last)))


def test_monthly_marts_leave_the_lines_where_they_are(spark, tmp_path):
    star = _tables(spark, tmp_path)
    sales.mart_sales_trends(star).collect()
    assert "fact_sales" not in os.listdir(star.work)
    few = star.few_sales.select(star["fact_sales"].drop("part_month", "channel").columns)
    assert _rows(few) == _rows(star["fact_sales"].drop("part_month", "channel"))
    keys = [*star["fact_sales"].select(*LINE_ATTRIBUTES).columns, "product_id", "part_month"]
    assert _rows(star["sales_months"]) == _rows(product_months(star["fact_sales"]))
    assert _rows(star["order_months"]) == _rows(order_words(star["fact_sales"], keys))


def test_months_of_lines_without_attributes(spark, tmp_path):
    star = _tables(spark, tmp_path)
    lines = star["fact_sales"]
    bare = with_month(lines.drop(*LINE_ATTRIBUTES))
    assert _rows(described_months(bare, star.product)) == _rows(product_months(lines))
    assert _rows(described_words(bare, star.product)) == _rows(order_words(lines))


def test_repeated_days_of_runs(spark):
    day = lambda d: START + dt.timedelta(days=d)
    runs = spark.createDataFrame(
        [(1, day(0), day(4)), (1, day(5), day(9)), (2, day(0), day(9)), (2, day(3), day(5)), (2, day(8), day(9)), (2, day(8), day(8)),
         (None, day(0), day(2)), (None, day(2), day(3))], "product_id bigint, date date, until date").select(
        "*", F.year("until").alias("until_year"), *[F.lit(0).alias(c) for c in (
            "opening_stock", "net_sold", "replenishment_qty", "closing_stock")])
    rows = ledger.days_of_runs(runs, day(0), day(9))
    expected = [rows.groupBy(*keys).count().agg(F.sum(F.col("count") - 1)).first()[0] for keys in (["product_id", "date"], ["inventory_id"])]
    assert list(ledger.repeated_days(runs).first()) == expected


def test_rules_run_in_methods_the_jvm_compiles(spark, tmp_path, monkeypatch):
    name = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(name), []
    write = loading.written
    monkeypatch.setattr(loading, "written", lambda df, path: (seen.append(int(spark.conf.get(name))), write(df, path))[1])
    raw = spark.createDataFrame([("2024-01-01", "2024", "1", "1", "0", "0")], "date string, year string, month string, quarter string, "
                                "is_weekend string, is_holiday_ru string")
    checked = loading.settle(validators.validate_dim_date(raw, loading.staged(f"{tmp_path}/stage")), f"{tmp_path}/checked")
    assert checked.clean.count() == 1
    assert len(seen) == 3 and max(seen) <= 8000
    assert spark.conf.get(name) == before


def test_reports_of_a_few_days_and_counts_do_not_build_the_sales(spark, tmp_path):
    star = _tables(spark, tmp_path)
    status = refresh.refresh_all_marts(star, str(tmp_path / "marts")).collect()
    assert all(r.ok for r in status)
    few = {f: _rows(f(star)) for f in (
        daily.mart_daily_pulse, daily.mart_daily_channels, daily.mart_mtd_pulse, daily.mart_daily_revenue_mtd,
        daily.mart_daily_top5, adhoc.channel_daily_30d, adhoc.row_counts)}
    assert "fact_sales" not in os.listdir(star.work)
    # the stored table has neither been brought together by month nor read for them, and gives the same
    assert star["fact_sales"].count() == {r.tbl: r.n for r in adhoc.row_counts(star).collect()}["fact_sales"]
    assert star.inventory.count() == {r.tbl: r.n for r in adhoc.row_counts(star).collect()}["fact_inventory"]
    assert few == {f: _rows(f(star)) for f in few}


def test_rows_up_to_a_day_are_counted_without_them(spark, tmp_path):
    star = _tables(spark, tmp_path).at(dt.date(2024, 3, 9))
    assert star.stock_rows().first().n == star.inventory.count()
    assert star.sales_rows().first().n == star.sales.count() == star.sales_rows().first().n


def test_lines_of_a_task_are_bounded(spark, tmp_path, monkeypatch):
    assert [driver_star.line_tasks(n, 8) for n in (0, 400, 30_000, 600_000, 36_000_000)] == [1, 1, 3, 8, 72]
    whole = _tables(spark, tmp_path / "whole")
    monkeypatch.setattr(driver_star, "TASK_LINES", 50)
    dealt = _tables(spark, tmp_path / "dealt")
    for name in ("sales_months", "order_months", "stock_runs"):
        assert _rows(dealt[name]) == _rows(whole[name])
        # 402 lines in nine tasks: what is sorted and written together is what one of them was dealt, however little
        written = spark.read.parquet(f"{dealt.work}/{name}").withColumn("file", F.input_file_name())
        task = F.pmod(F.hash("product_id"), F.lit(9))
        assert written.groupBy("file").agg(F.count_distinct(task).alias("n")).agg(F.max("n")).first()[0] == 1
        assert written.select(task).distinct().count() > 1
