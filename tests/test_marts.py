"""Mart edge cases on hand-made stars: ties, zero revenue, orders without a number, month ends."""

import datetime as dt

import pytest

from shelfline.functions.dates import month_before
from shelfline.plans import adhoc, checks, daily, plan_fact, planning, sales, stock
from shelfline.schemas import DIM_PRODUCT, FACT_INVENTORY, FACT_PLAN, FACT_SALES
from shelfline.star import Star

DAY = dt.date(2024, 3, 31)


def table(spark, schema, rows):
    frame = spark.createDataFrame(
        [tuple(str(r[n]) if r.get(n) is not None else None for n in schema.names) for r in rows],
        ", ".join(f"{n} string" for n in schema.names))
    return frame.select(*[frame[f.name].cast(f.dataType).alias(f.name) for f in schema])


def product(key, fmt="Paperback", genre="Fiction", cost=5, **more):
    return dict(product_id=key, title=f"T{key}", publisher=f"P{key % 2}", genre=genre, format=fmt, price_rub=10,
                cost_rub=cost, avg_rating=4, review_count=1, is_physical=int(fmt in ("Paperback", "Hardcover"))) | more


def sale(key, order, item, day, qty=1, amount=10.0, returned=0, **more):
    return dict(sales_id=key, order_id=order, product_id=item, date=day, sales_qty=qty, return_qty=returned, unit_price=10,
                sales_amount=amount, return_amount=returned * 10.0, discount_percent=0, is_promo=0, channel="Web",
                lost_sales_qty=0) | more


@pytest.fixture(scope="module")
def star(spark):
    products = [product(1), product(2, "eBook", "Poetry"), product(3, "Subscription", "Subscription", publisher=None),
                product(4), product(5), product(6), product(7)]
    lines = [
        sale(1, 1, 1, DAY, 2, 20.0), sale(2, 1, 2, DAY), sale(3, None, 1, DAY), sale(4, 2, 3, DAY, returned=1),
        sale(5, 3, 4, DAY), sale(6, 3, 5, DAY), sale(7, 4, 6, DAY), sale(8, 5, 7, DAY),
        sale(9, 6, 1, DAY - dt.timedelta(days=1)), sale(10, 7, 1, dt.date(2024, 2, 29)), sale(11, 8, 1, dt.date(2024, 2, 1)),
        sale(12, 9, 2, dt.date(2024, 1, 31))]
    plans = [dict(plan_id=i, genre=g, format=f, year=2024, month=m, plan_qty=q, plan_amount=a, plan_margin_target=0.5)
             for i, (g, f, m, q, a) in enumerate([
                 ("Fiction", "Paperback", 3, 10, 100), ("Poetry", "eBook", 3, 0, 0), ("Poetry", "eBook", 1, 1, 40),
                 ("Fiction", "Paperback", 4, 5, 50)])]
    stocks = [dict(inventory_id=i, product_id=p, date=d, opening_stock=9, sold_qty=0, replenishment_qty=r, closing_stock=c, is_low_stock=1)
              for i, (p, d, c, r) in enumerate([(1, DAY, 0, 3), (4, DAY, 4, 0), (5, DAY, 14, 0), (6, DAY, 15, 0),
                                                (1, DAY - dt.timedelta(days=1), 3, 0)])]
    return Star(spark, dim_product=table(spark, DIM_PRODUCT, products), fact_sales=table(spark, FACT_SALES, lines),
                fact_plan=table(spark, FACT_PLAN, plans), fact_inventory=table(spark, FACT_INVENTORY, stocks),
                dim_date=planning.build_calendar(spark, dt.date(2024, 1, 1), DAY))


def rows(df, *names):
    return sorted(tuple(float(r[n]) if hasattr(r[n], "as_tuple") else r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("day, before", [
    ((2024, 3, 31), (2024, 2, 29)), ((2023, 3, 29), (2023, 2, 28)), ((2024, 5, 31), (2024, 4, 30)), ((2024, 1, 15), (2023, 12, 15))])
def test_month_before(day, before):
    assert month_before(dt.date(*day)) == dt.date(*before)


def test_pulse_counts_orders_per_group_or_once(star):
    grouped = {r.day_type: r for r in daily.mart_daily_pulse(star).collect()}
    once = {r.day_type: r for r in daily.mart_daily_pulse(star, exact_orders=True).collect()}
    assert (grouped["today"].total_orders, once["today"].total_orders) == (6, 5)
    assert grouped["today"].total_revenue == once["today"].total_revenue == 80
    assert grouped["yesterday"].prev_date == DAY - dt.timedelta(days=2)


def test_zero_revenue_gives_zero_margin(star):
    card = sales.mart_subscriptions(star).first()
    assert (card.total_revenue, card.gross_margin, card.avg_ltv, card.total_orders) == (0, 0, 0, 1)
    assert rows(adhoc.genre_margin_period(star, DAY, DAY), "genre", "gross_margin")[-1] == ("Subscription", None)


def test_month_to_date_reaches_the_shorter_month_end(star):
    pulse = daily.mart_mtd_pulse(star).first()
    assert (pulse.mtd_revenue, pulse.prev_mtd_revenue, pulse.prev_mtd_orders) == (90, 20, 2)
    assert star.at(dt.date(2024, 1, 31)).today == dt.date(2024, 1, 31)
    empty = daily.mart_mtd_pulse(star.at(dt.date(2024, 1, 31))).first()
    assert (empty.prev_mtd_revenue, empty.prev_mtd_orders, empty.prev_mtd_gross_margin) == (None, 0, 0)


def test_top_five_keeps_ties(star):
    top = rows(daily.mart_daily_top5(star), "rnk", "product_id")
    assert top == [(1, 1), (2, 2), (2, 4), (2, 5), (2, 6), (2, 7)]


def test_last_day_equals_the_pulse(star):
    last = {r.date: r.net_revenue for r in daily.mart_daily_revenue_mtd(star).collect()}
    assert last[DAY] == 80
    by_format = plan_fact.mart_daily_format_pulse(star).where("day_type = 'today'")
    assert sum(r.net_revenue for r in by_format.collect()) == 80


def test_plan_fact(star):
    mart = {(r.genre, r.format): r for r in plan_fact.mart_plan_fact(star).collect()}
    book, poem = mart["Fiction", "Paperback"], mart["Poetry", "eBook"]
    assert (book.plan_amount_to_date, book.fact_amount, float(book.pct_of_plan_to_date)) == (100, 80, 80.0)
    assert (poem.pct_of_plan_to_date, poem.fact_amount, poem.forecast_month_amount) == (None, 10, 10)
    status = {(r.month, r.genre): r.month_status for r in plan_fact.mart_plan_fact_history(star).collect()}
    assert status == {(3, "Fiction"): "current", (3, "Poetry"): "current", (1, "Poetry"): "closed", (4, "Fiction"): "current"}


def test_abc_shares_reach_one_hundred(star):
    for partitions in (1, 3, 8):
        mart = sales.mart_abc(star, partitions).collect()
        assert max(r.cumulative_pct for r in mart) == 100
        assert sorted((r.revenue_rank, r.product_id) for r in mart) == [(1, 1), (2, 2), (3, 4), (3, 5), (3, 6), (3, 7)]
        assert {r.product_id: r.abc_class for r in mart}[7] == "C"


def test_alert_levels(star):
    alerts = rows(stock.mart_inventory_alerts(star), "product_id", "alert_level", "days_until_stockout", "recommended_order_qty")
    assert alerts == [(1, "critical", 0, 5), (4, "urgent", None, 0), (5, "warning", None, 0)]
    assert rows(adhoc.zero_stock_now(star), "product_id") == [(1,)]


def test_plan_from_history(spark, star):
    grid = planning.plan_grid(star.at(dt.date(2025, 1, 31)), dt.date(2024, 1, 1))
    plan = planning.plan_from_history(grid, 2024, growth=1.5)
    got = {(r.year, r.month): (r.plan_qty, float(r.plan_amount)) for r in plan.where("genre = 'Poetry' and format = 'eBook'").collect()}
    assert got[2024, 1] == (1, 10.0) and got[2025, 1] == (2, 15.0) and got[2024, 2] == (0, 0.0)
    assert plan.select("plan_id").distinct().count() == plan.count() == 13 * 40


def test_checks_find_what_is_wrong(spark, star):
    assert checks.orphan_products(star).count() == 0
    assert checks.digital_returns(star).first().violations == 1
    assert checks.missing_plan_combos(star).count() == 3 * 40 - 3
    broken = Star(spark, DAY, **{n: star[n] for n in ("dim_product", "dim_date", "fact_plan")},
                  fact_sales=table(spark, FACT_SALES, [
                      sale(1, 1, 99, DAY, 1, 10.5, returned=2), sale(1, 1, 1, dt.date(2030, 1, 1), 0, channel=None)]),
                  fact_inventory=table(spark, FACT_INVENTORY, [
                      dict(inventory_id=1, product_id=2, date=DAY, opening_stock=1, sold_qty=0, replenishment_qty=0, closing_stock=-5, is_low_stock=2)]))
    assert [r.product_id for r in checks.orphan_products(broken).collect()] == [99]
    assert checks.returns_exceed_sales(broken).first().violations == 1
    assert checks.amount_mismatch(broken).first().violations == 2
    assert checks.digital_in_inventory(broken).first().violations == 1
    assert checks.negative_stock(broken).first().violations == 0
    assert not checks.dates_within_calendar(broken).first().ends_inside
    found = {(r.tbl, r.rule) for r in checks.declared_constraints(broken).where("violations > 0").collect()}
    assert found == {
        ("fact_sales", "qty > 0"), ("fact_sales", "channel present"), ("fact_sales", "unique (sales_id)"),
        ("fact_sales", "product_id known"), ("fact_sales", "date known"),
        ("fact_inventory", "closing_stock >= 0"), ("fact_inventory", "is_low_stock 0/1")}
