"""Each quality rule with rows that break it and rows that do not."""

import datetime as dt

import pytest

from shelfline.operators.rules import POSITION
from shelfline.plans import validators as v
from shelfline.schemas import DIM_DATE, DIM_PRODUCT, FACT_INVENTORY, FACT_PLAN, FACT_SALES

DATE = dict(date="2024-01-06", year="2024", month="1", quarter="1", is_weekend="1", is_holiday_ru="0")
PRODUCT = dict(
    product_id="1", isbn="978-0-306-40615-7", title="A", author="B", publisher="C", published_date="2020-1-2",
    language="English", page_count="10", genre="Fiction", format="Paperback", price_rub="10.00", cost_rub="5.00",
    avg_rating="4.5", review_count="3", stock_initial="7", is_physical="1")
PLAN = dict(plan_id="1", genre="Fiction", format="eBook", year="2024", month="1", plan_qty="5",
            plan_amount="50.00", plan_margin_target="0.8")
SALE = dict(
    sales_id="1", order_id="1", product_id="1", date="2024-01-01", sales_qty="2", return_qty="0", unit_price="10.00",
    sales_amount="20.00", return_amount="0", discount_percent="0", is_promo="0", promo_code=None, channel="Web",
    lost_sales_qty="0")
STOCK = dict(inventory_id="1", product_id="1", date="2024-01-01", opening_stock="20", sold_qty="2",
             replenishment_qty="0", closing_stock="18", is_low_stock="0")
AS_OF = dt.date(2024, 12, 31)


def raw(spark, schema, rows):
    names = schema.names
    text = ", ".join(f"{n} string" for n in names)
    values = [(i, *[r.get(n) for n in names]) for i, r in enumerate(rows)]
    return spark.createDataFrame(values, f"{POSITION} bigint, {text}")


def found(checked):
    return sorted((r.code, r.level, r.n) for r in checked.details().collect())


@pytest.fixture(scope="module")
def product(spark):
    return v.validate_dim_product(raw(spark, DIM_PRODUCT, [
        PRODUCT, PRODUCT | dict(product_id="2", title="E", format="eBook", is_physical="0", stock_initial=None)])).clean


def variants(base, key, changes):
    """A good row, then one per change, each with its own key."""
    return [base] + [base | {key: str(i + 2)} | c for i, c in enumerate(changes)]


def test_dim_date(spark):
    days = [DATE, DATE | dict(date="2024-1-7"), DATE | dict(date="2024-02-30"), DATE | dict(date="20240108"),
            DATE | dict(date="2024-01"), DATE | dict(date=None), DATE,
            DATE | dict(date="2024-01-13", year="2023"), DATE | dict(date="2024-01-15", month="x", is_weekend="0"),
            DATE | dict(date="2024-01-20", is_weekend="0"), DATE | dict(date="2024-01-21", is_holiday_ru="True"),
            DATE | dict(date=" 2024-01-27 ", is_holiday_ru=" "), {}]
    checked = v.validate_dim_date(raw(spark, DIM_DATE, days))
    assert found(checked) == sorted([
        ("G-03", "fix", 1), ("G-04", "fix", 2), ("G-05", "reject", 1), ("D-01/D-02", "reject", 4), ("D-03", "reject", 1),
        ("D-04", "fix", 2), ("D-05", "fix", 1), ("D-06", "reject", 2)])
    clean = {r.date: r for r in checked.clean.collect()}
    assert sorted(clean) == [dt.date(2024, 1, d) for d in (6, 7, 13, 15, 20)]
    assert (clean[dt.date(2024, 1, 13)].year, clean[dt.date(2024, 1, 15)].month) == (2024, 1)
    assert clean[dt.date(2024, 1, 20)].is_weekend == 1
    row = checked.summary().first()
    assert row.rows_received == row.rows_rejected + row.rows_loaded == 13


def test_dim_product(spark):
    changes = [
        dict(product_id="0"), dict(product_id="x"), dict(product_id="1"), dict(product_id="0"),
        dict(title="  "), dict(format="Scroll"), dict(genre=None), dict(price_rub="-1"), dict(price_rub="1,5"),
        dict(cost_rub="0"), dict(avg_rating="5.1"), dict(avg_rating=None), dict(review_count="-1"),
        dict(title="t1", author=None), dict(title="t2", publisher=None), dict(title="t3", isbn="INVALID_ISBN"),
        dict(title="t4", isbn="9780306406158"), dict(title="t5", isbn=None), dict(title="t6", cost_rub="11"),
        dict(title="t7", page_count=None), dict(title="t8", format="eBook", is_physical="False"),
        dict(title="t9", is_physical="0"), dict(title="t10", is_physical="TRUE"),
        dict(title="t11", format="Subscription", genre="Subscription", author=None, publisher=None, isbn="bad",
             is_physical="0", stock_initial=None),
        dict()]
    checked = v.validate_dim_product(raw(spark, DIM_PRODUCT, variants(PRODUCT, "product_id", changes)))
    assert found(checked) == sorted([
        ("G-03", "fix", 1), ("G-04", "fix", 1), ("P-01", "reject", 3), ("P-01", "reject", 1), ("P-02", "reject", 1),
        ("P-05", "reject", 1), ("P-06", "reject", 1), ("P-08", "reject", 2), ("P-09", "reject", 1), ("P-13", "reject", 2),
        ("P-14", "reject", 1), ("P-03", "warn", 1), ("P-04", "warn", 1), ("P-07", "warn", 2), ("P-10", "warn", 1),
        ("P-11", "warn", 1), ("P-12", "fix", 1), ("P-15", "fix", 1), ("P-16", "reject", 1)])
    clean = {r.title: r for r in checked.clean.collect()}
    assert clean["t8"].stock_initial is None and clean["t9"].is_physical == 1
    assert clean["A"].published_date == dt.date(2020, 1, 2)
    row = checked.summary().first()
    assert row.rows_received - row.rows_rejected == row.rows_loaded == 12


def test_fact_plan(spark):
    changes = [dict(plan_id="1"), dict(genre="Subscription"), dict(format="Subscription"), dict(year="2027"),
               dict(year=None), dict(month="13"), dict(plan_qty="-1"), dict(plan_qty="1e1", month="2"),
               dict(plan_amount="-0.01"), dict(plan_margin_target="1.1"), dict(plan_qty="0", month="3"),
               dict(plan_amount="0", month="4"), dict(plan_qty="0", plan_amount="0", month="5"), dict()]
    checked = v.validate_fact_plan(raw(spark, FACT_PLAN, variants(PLAN, "plan_id", changes)))
    assert found(checked) == sorted([
        ("PL-01", "reject", 1), ("PL-02", "reject", 1), ("PL-03", "reject", 1), ("PL-04", "reject", 2),
        ("PL-05", "reject", 1), ("PL-06", "reject", 1), ("PL-07", "reject", 1), ("PL-09", "reject", 1),
        ("PL-08", "warn", 2), ("PL-10", "reject", 1)])
    assert {r.month: r.plan_qty for r in checked.clean.collect()} == {1: 5, 2: 10, 3: 0, 4: 5, 5: 0}


def test_fact_sales(spark, product):
    changes = [
        dict(sales_id="1"), dict(order_id=None), dict(order_id=None), dict(product_id="9"), dict(date="2024-13-01"),
        dict(date="2023-12-31"), dict(date="2025-01-01"), dict(sales_qty="0"), dict(unit_price=None),
        dict(discount_percent="101"), dict(channel="Fax"), dict(order_id="1"),
        dict(order_id="20", sales_amount="20.3"), dict(order_id="21", sales_amount="20.1"),
        dict(order_id="22", product_id="2", return_qty="1", return_amount="10"),
        dict(order_id="23", return_qty="3", return_amount="30"), dict(order_id="24", return_qty="1", return_amount="5"),
        dict(order_id="25", return_amount="1"), dict(order_id="26", is_promo="1", discount_percent="10"),
        dict(order_id="27", is_promo="1", discount_percent="0", promo_code="P"),
        dict(order_id="28", is_promo="1", discount_percent="5", promo_code="P"), dict(order_id="29", discount_percent="5"),
        dict(order_id="30", product_id="2", lost_sales_qty="1"), dict(order_id="31", lost_sales_qty="-1"),
        dict(order_id="32", date="2024-1-5"), dict(order_id="33", return_qty=None, lost_sales_qty=None),
        dict(order_id="34", sales_id=None), dict(order_id="35", sales_id=None)]
    checked = v.validate_fact_sales(raw(spark, FACT_SALES, variants(SALE, "sales_id", changes)), product, as_of=AS_OF)
    assert found(checked) == sorted([
        ("S-01", "reject", 2), ("S-02", "warn", 2), ("S-04", "reject", 1), ("S-05", "reject", 1), ("S-06", "reject", 2),
        ("S-08", "reject", 1), ("S-09", "reject", 1), ("S-14", "reject", 1), ("S-17", "reject", 1), ("S-03", "reject", 2),
        ("S-07", "warn", 3), ("S-10", "warn", 1), ("S-11", "warn", 1), ("S-12", "warn", 1), ("S-13", "warn", 3),
        ("S-15", "warn", 2), ("S-16", "warn", 1), ("S-18", "warn", 1), ("S-19", "warn", 1),
        ("X-01", "reject", 1), ("X-02", "fix", 1), ("X-02", "fix", 1)])
    row = checked.summary().first()
    assert row.rows_received - row.rows_rejected == row.rows_loaded
    by_order = {r.order_id: r for r in checked.clean.collect()}
    assert by_order[33].return_qty == 0 and by_order[32].date == dt.date(2024, 1, 5)
    days = v.missing_sales_days(checked.clean, dt.date(2024, 1, 1)).collect()
    assert sorted(r.date.day for r in days) == [2, 3, 4]


def test_one_day_batch_counts_missing_days_from_its_start(spark, product):
    rows = raw(spark, FACT_SALES, [SALE | dict(date="2024-06-01")])
    whole = v.validate_fact_sales(rows, product, as_of=AS_OF)
    batch = v.validate_fact_sales(rows, product, as_of=AS_OF, days_from=dt.date(2024, 6, 1))
    assert found(whole) == [("S-07", "warn", 152)] and found(batch) == []


def test_fact_inventory(spark, product):
    changes = [
        dict(product_id="9"), dict(product_id="2"), dict(date="x", product_id="1"), dict(date="2023-01-01"),
        dict(opening_stock="-1"), dict(sold_qty=None), dict(replenishment_qty="-2"), dict(closing_stock="-5"), dict(),
        dict(date="2024-01-02", closing_stock="10", is_low_stock="1"),
        dict(date="2024-01-03", closing_stock="17"), dict(date="2024-01-04", is_low_stock="1"),
        dict(date="2024-01-05", inventory_id=None)]
    checked = v.validate_fact_inventory(raw(spark, FACT_INVENTORY, variants(STOCK, "inventory_id", changes)), product, as_of=AS_OF)
    assert found(checked) == sorted([
        ("I-01", "reject", 1), ("I-02", "reject", 1), ("I-03", "reject", 1), ("I-04", "reject", 1), ("I-06", "reject", 1),
        ("I-07", "reject", 1), ("I-08", "reject", 1), ("I-09", "reject", 1), ("I-05", "reject", 1), ("I-10", "warn", 1),
        ("I-11", "fix", 1), ("X-01", "reject", 1)])
    assert {r.date.day: r.is_low_stock for r in checked.clean.collect()} == {1: 0, 2: 1, 3: 0, 4: 0}


def test_hot_key_keeps_the_first(spark, product):
    """Most rows share one order, product and id-less key; exactly the first of each survives."""
    rows = [SALE | dict(sales_id=str(i), order_id=None) for i in range(500)]
    checked = v.validate_fact_sales(raw(spark, FACT_SALES, rows), product, as_of=AS_OF)
    assert [r.sales_id for r in checked.clean.collect()] == [0]
    assert ("S-03", "reject", 499) in found(checked)


def test_totals(spark, product):
    checked = [v.validate_dim_date(raw(spark, DIM_DATE, [DATE, DATE])),
               v.validate_fact_inventory(raw(spark, FACT_INVENTORY, [STOCK | dict(closing_stock="9")]), product, as_of=AS_OF)]
    assert v.total_issues(checked).first().issues == 2
    assert {r.table_name for r in v.quality_details(checked).collect()} == {"dim_date", "fact_inventory"}


def test_ids_above_double_precision_stay_apart(spark):
    big = 2 ** 53
    product = spark.createDataFrame([(big, "eBook"), (big + 2, "eBook")], "product_id bigint, format string")
    rows = [dict(sales_id=str(big + i), order_id=str(big + i), product_id=str(big + p), date="2024-01-05", sales_qty="1", return_qty="0",
                 unit_price="2", sales_amount="2", return_amount="0", discount_percent="0", is_promo="0", promo_code=None,
                 channel="Web", lost_sales_qty="0") for i, p in ((0, 0), (1, 0), (2, 1))]
    names = list(rows[0])
    raw = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    checked = v.validate_fact_sales(raw, product, dt.date(2024, 1, 1), dt.date(2024, 12, 31), dt.date(2024, 1, 5))
    assert sorted(r.sales_id for r in checked.clean.collect()) == [big, big + 1]
    assert {r.code: r.n for r in checked.details().collect()} == {"S-04": 1}
