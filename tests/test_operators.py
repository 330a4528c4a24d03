"""Operators against plain Python on small data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators import ledger
from shelfline.operators.ordered import running_rank, top_ranked

START = dt.date(2024, 1, 1)


@pytest.mark.parametrize("values", [
    [5] * 200, list(range(200)), [i // 60 for i in range(200)], [0] * 150 + list(range(50)), [7], [-3, 0, -3, 1]])
@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_running_rank(spark, values, partitions):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "id bigint, v bigint").repartition(7)
    got = {r.id: (r["rank"], r.running, r.grand) for r in running_rank(df, "v", "id", total="v", partitions=partitions).collect()}
    total, expected = 0, {}
    for key, value in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += value
        expected[key] = (1 + sum(o > value for o in values), total, sum(values))
    assert got == expected


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_rank_within_groups(spark, partitions):
    random.seed(3)
    rows = [(i, random.choice("ab"), random.choice([1, 2, 3, 50])) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, g string, v bigint")
    ranked = running_rank(df, "v", "id", within=["g"], partitions=partitions)
    for r in ranked.collect():
        assert r["rank"] == 1 + sum(g == r.g and v > r.v for _, g, v in rows)


def test_top_keeps_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 8, 8, 7, 6, 6, 6, 1, None])], "id int, v int")
    assert sorted((r.id, r.rnk) for r in top_ranked(df, "v", 5).collect()) == [
        (0, 1), (1, 2), (2, 2), (3, 4), (4, 5), (5, 5), (6, 5)]
    assert top_ranked(df.limit(0), "v", 5).count() == 0
    assert top_ranked(df, "v", 50).count() == 8


def _loop(initial, days, sold, restocked):
    stock, out = initial, {}
    for day in range(days):
        opening, net, added = stock, sold.get(day, 0), restocked.get(day, 0)
        stock = max(0, opening - net + added)
        out[day] = (opening, max(0, net), added, stock, int(stock < 15), max(0, net - opening - added))
    return out


def test_ledger_equals_loop(spark):
    random.seed(11)
    days, products = 40, 60
    sold = {p: {d: random.randint(-6, 25) for d in random.sample(range(days), random.randint(0, 20))} for p in range(products)}
    added = {p: {d: random.randint(1, 60) for d in random.sample(range(days), 3)} for p in range(products)}
    initial = {p: random.choice([None, 0, 5, 80]) for p in range(products)}
    date = lambda d: START + dt.timedelta(days=d)
    sales = spark.createDataFrame(
        [(p, date(d), max(n, 0), n) for p, row in sold.items() for d, n in row.items()],
        "product_id bigint, date date, gross_sold bigint, net_sold bigint")
    stock = spark.createDataFrame(list(initial.items()), "product_id bigint, stock_initial int")
    restock = spark.createDataFrame(
        [(p, date(d), n) for p, row in added.items() for d, n in row.items()],
        "product_id bigint, date date, replenishment_qty int")
    book = ledger.stock_ledger(ledger.movements(sales, stock, restock, START))
    dense = ledger.daily_inventory(book, START, date(days - 1))
    got = {(r.product_id, (r.date - START).days): (
        r.opening_stock, r.sold_qty, r.replenishment_qty, r.closing_stock, r.is_low_stock) for r in dense.collect()}
    expected = {(p, d): row for p in range(products) for d, row in _loop(initial[p] or 0, days, sold[p], added[p]).items()}
    assert got == {k: row[:5] for k, row in expected.items()}
    shortage = {(r.product_id, (r.date - START).days): r.shortage for r in book.collect()}
    assert all(expected[k][5] == n for k, n in shortage.items())
    assert dense.select("inventory_id").distinct().count() == days * products


def test_shortage_allocation(spark):
    sales = spark.createDataFrame(
        [(1, START, 6, 0, 0), (1, START, 4, 4, 0), (2, START, 3, 0, 1)],
        "product_id bigint, date date, sales_qty int, return_qty int, lost_sales_qty int",
    ).select("*", F.lit(2.50).cast("decimal(10,2)").alias("unit_price"),
             (F.col("sales_qty") * F.lit(2.50)).cast("decimal(14,2)").alias("sales_amount"),
             (F.col("return_qty") * F.lit(2.50)).cast("decimal(14,2)").alias("return_amount"))
    book = spark.createDataFrame(
        [(1, START, 10, 5), (2, START, 3, 0)], "product_id bigint, date date, gross_sold bigint, shortage bigint")
    rows = sorted((r.product_id, -r.sales_qty, r.return_qty, float(r.sales_amount), float(r.return_amount), r.lost_sales_qty)
                  for r in ledger.allocate_shortage(sales, book).collect())
    assert rows == [(1, -3, 0, 7.5, 0.0, 3), (1, -2, 2, 5.0, 5.0, 2), (2, -3, 0, 7.5, 0.0, 1)]


def test_dense_daily_net_sold(spark):
    lines = spark.createDataFrame(
        [(1, START, 5, 1, "Paperback"), (1, START + dt.timedelta(days=2), 2, 0, "Paperback"), (2, START, 9, 0, "eBook")],
        "product_id bigint, date date, sales_qty int, return_qty int, format string")
    dense = ledger.dense_daily_net_sold(lines, START, START + dt.timedelta(days=3))
    assert sorted((r.product_id, (r.date - START).days, r.net_sold) for r in dense.collect()) == [
        (1, 0, 4), (1, 1, 0), (1, 2, 2), (1, 3, 0)]


def test_a_ledger_goes_on_from_its_state(spark):
    rng, days = random.Random(8), 60
    moves = [(p, START + dt.timedelta(days=d), rng.randrange(0, 6), rng.randrange(-2, 6), rng.choice([0, 0, 0, 4]), 10 if d == 0 else 0)
             for p in range(12) for d in range(days) if d == 0 or rng.random() < 0.3]
    moves += [(50, START + dt.timedelta(days=45), 3, 3, 0, 1), (51, START, 0, 0, 0, 0)]      # one that begins late, one that never moves
    df = spark.createDataFrame(moves, "product_id bigint, date date, gross_sold bigint, net_sold bigint, replenishment_qty bigint, initial bigint")
    whole = sorted(map(tuple, ledger.stock_ledger(df).collect()))
    state, got = None, []
    for a, b in ((0, 20), (20, 21), (21, 50), (50, days)):
        part = df.where(F.col("date").between(START + dt.timedelta(days=a), START + dt.timedelta(days=b - 1)))
        book = ledger.stock_ledger(part, state)
        got += map(tuple, book.collect())
        state = spark.createDataFrame(
            ledger.ledger_state(book, state).collect(), "product_id bigint, level bigint, owed bigint")
    assert sorted(got) == whole
    assert {r.product_id for r in state.collect()} == set(range(12)) | {50, 51}
