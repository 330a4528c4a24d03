"""SQL text for ad-hoc queries, charts, alerts, checks and the stock and plan operators."""

from oracle.marts import (
    ABC, ALERTS, HISTORY_COLUMNS, MARGIN, NET, ORDERS, PROFIT, PUBLISHER_COLUMNS, SUBS_COLUMNS,
    agg, alert_columns, query,
)
from oracle.star import BOOKS, PHYSICAL, guarded, money, quotient, whole

PERIOD = ("1998-01-01", "1999-06-30")
PROMO_FROM = "2000-01-01"
PRODUCT_ID = 40

SUM_NET = money(NET, "net_revenue")
SEVERITY = "CASE level WHEN 'critical' THEN 1 WHEN 'urgent' THEN 2 ELSE 3 END"
RANKED_ALERTS = f"SELECT * FROM alerts ORDER BY {SEVERITY}, closing, product_id LIMIT 50"
ROLES = """(VALUES ('floor@shop.example', 'Shop floor', ['warning']),
  ('orders@shop.example', 'Ordering', ['critical','urgent','warning']), ('duty@shop.example', 'On duty', ['critical'])) r(email, name, roles)"""
ROUTED = f"(SELECT a.*, email, name FROM alerts a JOIN {ROLES} ON list_contains(roles, level))"
EMAIL_COLUMNS = ("product_id", "title", "format", "genre", "publisher", "closing_stock", "avg_daily_sales_30d",
                 "days_until_stockout", "recommended_order_qty", "alert_level", "stock_date")
LEVELS = ", ".join(f"count(*) FILTER (WHERE level = '{n}') AS {n}" for n in ("critical", "urgent", "warning"))


def _by(keys, cols, where="", source="lines"):
    return f"SELECT {keys}, {cols} FROM {source} {where} GROUP BY {keys}"


def _months(expr_of):
    return ", ".join(f"{expr_of(m)} AS m{m:02d}" for m in range(1, 13))


def _at(col, m):
    return f"sum(CASE WHEN month = {m} THEN {col} END)"


def _delta(now, then, name, pct=True):
    cols = f"({now} - {then})"
    return cols, name, pct


def _count(name, rule, table, test):
    return f"SELECT '{table}' AS tbl, '{rule}' AS rule, count(*) FILTER (WHERE {test}) AS violations FROM {name}"


def _repeats(name, table, keys):
    cols = ", ".join(keys)
    shown = ", ".join({"low": "is_low_stock"}.get(k, k) for k in keys)
    return (f"SELECT '{table}', 'unique ({shown})', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
            f"FROM (SELECT count(*) AS n FROM {name} GROUP BY {cols})")


def _unknown(name, table, key, dim):
    return f"SELECT '{table}', '{key} known', count(*) FROM {name} WHERE {key} NOT IN (SELECT {key} FROM {dim})"


CALENDAR = """(
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month,
         CAST(quarter(d) AS BIGINT) AS quarter, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN (month(d) = 1 AND day(d) <= 8) OR (month(d) = 2 AND day(d) = 23) OR (month(d) = 3 AND day(d) = 8)
                OR (month(d) = 5 AND day(d) IN (1, 9)) THEN 1 ELSE 0 END AS is_holiday_ru
  FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM span))"""

CONSTRAINTS = " UNION ALL ".join([
    _count(CALENDAR, "month 1..12", "dim_date", "month NOT BETWEEN 1 AND 12"),
    _count(CALENDAR, "quarter 1..4", "dim_date", "quarter NOT BETWEEN 1 AND 4"),
    _count(CALENDAR, "is_weekend 0/1", "dim_date", "is_weekend NOT IN (0, 1)"),
    _count(CALENDAR, "is_holiday_ru 0/1", "dim_date", "is_holiday_ru NOT IN (0, 1)"),
    _count("product", "price > 0", "dim_product", "price_c IS NULL OR price_c <= 0"),
    _count("product", "cost > 0", "dim_product", "cost_c IS NULL OR cost_c <= 0"),
    _count("product", "rating 0..5", "dim_product", "rating_t NOT BETWEEN 0 AND 50"),
    _count("product", "reviews >= 0", "dim_product", "review_count < 0"),
    _count("product", "is_physical 0/1", "dim_product", "is_physical NOT IN (0, 1)"),
    _count("plan", "month 1..12", "fact_plan", "month NOT BETWEEN 1 AND 12"),
    _count("plan", "qty >= 0", "fact_plan", "plan_q < 0"),
    _count("plan", "amount >= 0", "fact_plan", "plan_c < 0"),
    _count("plan", "margin 0..1", "fact_plan", "target NOT BETWEEN 0 AND 1"),
    _count("sales", "qty > 0", "fact_sales", "qty <= 0"),
    _count("sales", "returns >= 0", "fact_sales", "ret < 0"),
    _count("sales", "price > 0", "fact_sales", "unit_c <= 0"),
    _count("sales", "discount 0..100", "fact_sales", "disc NOT BETWEEN 0 AND 100"),
    _count("sales", "is_promo 0/1", "fact_sales", "promo NOT IN (0, 1)"),
    _count("sales", "lost >= 0", "fact_sales", "lost < 0"),
    _count("inventory", "opening_stock >= 0", "fact_inventory", "opening < 0"),
    _count("inventory", "sold_qty >= 0", "fact_inventory", "sold < 0"),
    _count("inventory", "replenishment_qty >= 0", "fact_inventory", "repl < 0"),
    _count("inventory", "closing_stock >= 0", "fact_inventory", "closing < 0"),
    _count("inventory", "is_low_stock 0/1", "fact_inventory", "low NOT IN (0, 1)"),
    *[_count(source, f"{name} present", table, f"{column or name} IS NULL") for source, table, columns in (
        (CALENDAR, "dim_date", {"date": "", "year": "", "month": "", "quarter": "", "is_weekend": "", "is_holiday_ru": ""}),
        ("product", "dim_product", {"product_id": "", "title": "", "genre": "", "format": "", "price_rub": "price_c",
                                    "cost_rub": "cost_c", "is_physical": ""}),
        ("plan", "fact_plan", {"plan_id": "", "genre": "", "format": "", "year": "", "month": "", "plan_qty": "plan_q",
                               "plan_amount": "plan_c"}),
        ("sales", "fact_sales", {"sales_id": "", "product_id": "", "date": "", "sales_qty": "qty", "return_qty": "ret",
                                 "unit_price": "unit_c", "sales_amount": "amt_c", "return_amount": "ramt_c",
                                 "discount_percent": "disc", "is_promo": "promo", "channel": "", "lost_sales_qty": "lost"}),
        ("inventory", "fact_inventory", {"inventory_id": "", "product_id": "", "date": "", "opening_stock": "opening",
                                         "sold_qty": "sold", "replenishment_qty": "repl", "closing_stock": "closing",
                                         "is_low_stock": "low"}),
    ) for name, column in columns.items()],
    _repeats(CALENDAR, "dim_date", ["date"]),
    _repeats("product", "dim_product", ["product_id"]),
    _repeats("plan", "fact_plan", ["plan_id"]),
    _repeats("plan", "fact_plan", ["genre", "format", "year", "month"]),
    _repeats("sales", "fact_sales", ["sales_id"]),
    _repeats("inventory", "fact_inventory", ["inventory_id"]),
    _repeats("inventory", "fact_inventory", ["product_id", "date"]),
    _unknown("sales", "fact_sales", "product_id", "product"),
    _unknown("sales", "fact_sales", "date", CALENDAR),
    _unknown("inventory", "fact_inventory", "product_id", "product"),
    _unknown("inventory", "fact_inventory", "date", CALENDAR),
])

DAY_TILES = f"""
  SELECT date = today AS is_today, sum(nc) AS rev, sum(o) AS ord, sum(pc) AS prof,
         CASE WHEN sum(o) > 0 THEN {quotient('sum(nc)', 'sum(o) * 100', 2)} ELSE 0 END AS aov,
         CASE WHEN sum(nc) > 0 THEN {quotient('sum(pc)', 'sum(nc)', 4)} ELSE 0 END AS mar
  FROM (SELECT date, genre, format, {NET} AS nc, {PROFIT} AS pc, {ORDERS} AS o
        FROM lines, anchor WHERE date BETWEEN yesterday AND today GROUP BY date, genre, format), anchor
  GROUP BY date, today"""


def _tiles(name, cents_expr, unit):
    """today, yesterday, delta and relative delta of one tile held in whole units of 1/unit."""
    t, y = f"max({cents_expr}) FILTER (WHERE is_today)", f"max({cents_expr}) FILTER (WHERE NOT is_today)"
    return _pair(name, t, y, unit, "today", "yesterday", prefix=False)


def _pair(name, t, y, unit, now, then, prefix):
    shown = [(f"{now}_{name}", t), (f"{then}_{name}", y)] if prefix else [(f"{name}_{now}", t), (f"{name}_{then}", y)]
    cast = (lambda e: f"CAST({e} AS BIGINT)") if unit == 1 else (lambda e: f"CAST({e} AS BIGINT) / {unit}.0::DOUBLE")
    cols = [f"{cast(e)} AS {a}" for a, e in shown]
    cols.append(f"{cast(f'({t}) - ({y})')} AS {name}_delta")
    if unit != 10000:
        cols.append(f"{quotient(f'(({t}) - ({y}))', f'({y})', 4)} AS {name}_delta_pct")
    return cols


DAY_KPI = ", ".join(sum([
    _tiles("revenue", "rev", 100), _tiles("orders", "ord", 1),
    _tiles("avg_order", "CAST(round(aov * 100) AS BIGINT)", 100),
    _tiles("margin", "CAST(round(mar * 10000) AS BIGINT)", 10000)], []))

MTD_SIDE = f"""
  SELECT {NET} AS revenue, {ORDERS} AS orders, {PROFIT} AS gross_profit,
         CAST(round(CASE WHEN {NET} > 0 THEN {quotient(PROFIT, NET, 4)} ELSE 0 END * 10000) AS BIGINT) AS gross_margin,
         CAST(round(CASE WHEN {ORDERS} > 0 THEN {quotient(NET, ORDERS + ' * 100', 2)} ELSE 0 END * 100) AS BIGINT) AS avg_order_value
  FROM lines, anchor WHERE date BETWEEN """
MTD_KPI = ", ".join(sum([
    _pair(n, f"n.{n}", f"t.{n}", u, "mtd", "prev_mtd", prefix=True)
    for n, u in (("revenue", 100), ("orders", 1), ("gross_profit", 100), ("gross_margin", 10000), ("avg_order_value", 100))], []))

DUE = "sum(fc) AS fc, sum(due_c) AS due_c FROM plan_fact"
DUE_COLUMNS = (money("fc", "fact_amount") + ", " + money("due_c", "plan_amount_to_date") + ", "
               + quotient("fc * 100", "due_c", 1) + " AS pct_of_plan_to_date")
CLOSED = (f"SELECT year, month, sum(plan_c) AS pc, sum(fc) AS fc FROM history WHERE status = 'closed' GROUP BY year, month")
CLASS_SUMS = """SELECT cls, count(*) AS n, sum(rev) AS rev, any_value(total) AS total, sum(lost) AS lost FROM classed GROUP BY cls"""
MARGIN_OF = guarded("(rev - q * cost_c)", "rev", 4, "product_margin")

SQL = {
    "last_dates": query(["lines", "inventory"], """
SELECT 'fact_sales' AS tbl, max(date) AS last_date FROM lines UNION ALL SELECT 'fact_inventory', max(date) FROM inventory"""),
    "row_counts": query(["product", "sales", "inventory", "plan"], " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, count(*) AS n FROM {n}" for t, n in
        (("dim_product", "product"), ("fact_sales", "sales"), ("fact_inventory", "inventory"), ("fact_plan", "plan")))),
    "channel_daily_30d": query(["lines", "anchor"], f"""
SELECT date, channel, {agg(["orders", "net_revenue"])} FROM lines, anchor WHERE date >= today - 30 GROUP BY date, channel"""),
    "genre_margin_period": query(["lines"], f"""
SELECT genre, {agg(["net_revenue", "gross_profit"])}, {quotient(PROFIT, NET, 4)} AS gross_margin
FROM lines WHERE date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' GROUP BY genre"""),
    "top_products_abc": query(["classed"], f"""
SELECT rnk AS revenue_rank, product_id, title, format, genre, {money("rev", "total_net_revenue")}, {MARGIN_OF}, cls AS abc_class
FROM classed ORDER BY rnk, product_id LIMIT 20"""),
    "promo_effectiveness": query(["lines"], f"""
SELECT CAST(promo AS BIGINT) AS is_promo, {agg(["orders", "net_revenue"])}, {quotient(NET, ORDERS + " * 100", 2)} AS avg_order
FROM lines WHERE date >= DATE '{PROMO_FROM}' GROUP BY promo"""),
    "lost_sales_top": query(["lines"], f"""
SELECT title, format, {agg([], total_lost_qty="lost_sales_qty")}, {money("sum(lost * unit_c)", "lost_revenue_est")}
FROM lines WHERE format IN {PHYSICAL} GROUP BY title, format ORDER BY sum(lost * unit_c) DESC NULLS LAST, title, format LIMIT 10"""),
    "stock_history": query(["inventory"], f"""
SELECT date, opening AS opening_stock, CAST(sold AS BIGINT) AS sold_qty, CAST(repl AS BIGINT) AS replenishment_qty,
       closing AS closing_stock, CAST(low AS BIGINT) AS is_low_stock FROM inventory WHERE product_id = {PRODUCT_ID}"""),
    "zero_stock_now": query(["inventory", "product"], """
SELECT product_id, title, format, publisher, closing AS closing_stock, date AS stock_date
FROM inventory JOIN product USING (product_id) WHERE date = (SELECT last_day FROM span) AND closing = 0"""),
    "replenishment_frequency": query(["inventory", "product"], """
SELECT title, format, count(*) FILTER (WHERE repl > 0) AS replenishments, CAST(sum(repl) AS BIGINT) AS total_replenished
FROM inventory JOIN product USING (product_id) GROUP BY title, format"""),
    "plan_closed_summary": query(["history"], f"""
SELECT year, month, {money("pc", "total_plan")}, {money("fc", "total_fact")}, {quotient("fc * 100", "pc", 1)} AS pct FROM ({CLOSED})"""),
    "missed_plan_genres": query(["history"], f"""
SELECT genre, count(*) AS missed_months FROM (SELECT {HISTORY_COLUMNS} FROM history)
WHERE month_status = 'closed' AND pct_of_plan < 80 GROUP BY genre HAVING count(*) >= 2"""),
    "format_margin_yoy": query(["lines"], f"""
SELECT format, year, {quotient(PROFIT, NET, 4)} AS gross_margin FROM lines WHERE format <> 'Subscription' GROUP BY format, year"""),
    "weak_margin_publishers": query(["publishers"], f"""
SELECT publisher, format, gross_margin, net_revenue, rank_overall FROM (SELECT {PUBLISHER_COLUMNS}, nc FROM publishers)
WHERE gross_margin < 0.75 AND nc * (SELECT count(*) FROM publishers) > (SELECT sum(nc) FROM publishers)"""),
    "subscription_churn": query(["subs_monthly"], f"""
SELECT year, month, title AS subscription_type, orders AS new_subscriptions, {whole("rq", "cancellations")},
       {quotient("rq * 100", "orders", 1)} AS churn_pct FROM subs_monthly"""),
    "basket_size": query(["lines"], f"""
SELECT {ORDERS} AS orders, {quotient("count(*)", ORDERS, 4)} AS basket_size, count(*) AS lines FROM lines"""),
    # charts
    "kpi_day_delta": query(["lines", "anchor"], f"SELECT {DAY_KPI} FROM ({DAY_TILES})"),
    "kpi_mtd_delta": query(["lines", "anchor"], f"SELECT {MTD_KPI} FROM ({MTD_SIDE} m0 AND today) n, ({MTD_SIDE} p0 AND p1) t"),
    "plan_kpi_total": query(["plan_fact", "anchor"], f"""
SELECT {DUE_COLUMNS}, {quotient("fc * days", "passed * 100", 2)} AS forecast_month_amount,
       {money("fc - due_c", "delta_amount_to_date")} FROM (SELECT {DUE}), anchor"""),
    "plan_by_genre": query(["plan_fact"], f"SELECT genre, {DUE_COLUMNS} FROM (SELECT genre, {DUE} GROUP BY genre)"),
    "plan_by_format": query(["plan_fact"], f"SELECT format, {DUE_COLUMNS} FROM (SELECT format, {DUE} GROUP BY format)"),
    "plan_pct_monthly": query(["history"], f"SELECT year, month, {quotient('fc * 100', 'pc', 1)} AS pct FROM ({CLOSED})"),
    "plan_heatmap": query(["history"], "SELECT genre, " + _months(
        lambda m: quotient(f"{_at('fc', m)} * 100", _at("plan_c", m), 1)) + " FROM history GROUP BY genre"),
    "revenue_by_month": query(["lines"], _by("month_start", SUM_NET)),
    "revenue_by_format": query(["lines"], _by("month_start, format", SUM_NET)),
    "revenue_by_genre": query(["lines"], _by("month_start, genre", SUM_NET)),
    "return_share_monthly": query(["lines"], _by("month_start", ", ".join([
        money("sum(ramt_c)", "return_revenue"), money("sum(amt_c)", "gross_revenue"),
        quotient("sum(ramt_c)", "sum(amt_c)", 4) + " AS return_share"]))),
    "promo_vs_organic": query(["lines"], _by("month_start", ", ".join([
        money("sum(CASE WHEN promo = 1 THEN net_c ELSE 0 END)", "promo_revenue"),
        money("sum(CASE WHEN promo = 1 THEN 0 ELSE net_c END)", "organic_revenue")]))),
    "lost_sales_monthly": query(["lines"], _by("month_start", whole("sum(lost)", "lost_sales_qty"), f"WHERE format IN {PHYSICAL}")),
    "margin_scatter": query(["lines"], _by("month_start, format", f"{SUM_NET}, {MARGIN}, {whole('sum(net_q)', 'net_qty')}")),
    "top_publishers": query(["publishers"], f"""
SELECT publisher, format, gross_profit, gross_margin, rank_overall FROM (SELECT {PUBLISHER_COLUMNS} FROM publishers)
ORDER BY rank_overall, publisher, format LIMIT 20"""),
    "genre_margin_heatmap": query(["lines"], "SELECT genre, " + _months(
        lambda m: quotient(_at("profit_c", m), _at("net_c", m), 4)) + " FROM lines GROUP BY genre"),
    "alerts_by_level": query(["alerts"], "SELECT level AS alert_level, count(*) AS products FROM alerts GROUP BY level"),
    "stockout_histogram": query(["alerts"], """
SELECT CASE WHEN days_left IS NULL THEN 'unknown' WHEN days_left <= 0 THEN '0' WHEN days_left <= 7 THEN '1-7'
            WHEN days_left <= 30 THEN '8-30' ELSE '30+' END AS bucket, count(*) AS products FROM alerts GROUP BY 1"""),
    "reorder_value": query(["alerts"], f"""
SELECT {whole("sum(reorder)", "reorder_qty")}, {money("sum(reorder * price_c)", "value_at_price")},
       {money("sum(reorder * cost_c)", "value_at_cost")} FROM alerts"""),
    "low_stock_widget": query(["alerts"], "SELECT " + alert_columns(
        "product_id", "title", "format", "closing_stock", "days_until_stockout", "recommended_order_qty", "alert_level") + " FROM alerts"),
    "reorder_list": query(["alerts"], f"SELECT {alert_columns()} FROM alerts"),
    "stock_vs_threshold": query(["inventory"], f"""
SELECT date, closing AS closing_stock, CAST(15 AS BIGINT) AS threshold FROM inventory WHERE product_id = {PRODUCT_ID}"""),
    "abc_summary": query(["classed"], f"""
SELECT cls AS abc_class, n AS products, {money("rev", "total_net_revenue")}, {quotient("rev * 100", "total", 2)} AS revenue_pct,
       {whole("lost", "lost_qty")} FROM ({CLASS_SUMS})"""),
    "abc_margin_box": query(["classed"], "SELECT abc_class, " + ", ".join(
        f"round(quantile_cont(product_margin, {q}), 6) AS {n}_margin" for n, q in
        (("min", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1.0)))
        + f" FROM (SELECT cls AS abc_class, {MARGIN_OF} FROM classed) GROUP BY abc_class"),
    "abc_table_with_history": query(["classed", "lines"], f"""
SELECT c.product_id, title, format, genre, cls AS abc_class, {money("rev", "total_net_revenue")}, {MARGIN_OF},
       rnk AS revenue_rank, revenue_series
FROM classed c JOIN (
  SELECT product_id, string_agg(month || '=' || CAST(CAST(nc AS DECIMAL(20, 0)) * 0.01 AS DECIMAL(20, 2))::VARCHAR, ';' ORDER BY month) AS revenue_series
  FROM (SELECT product_id, strftime(date, '%Y-%m') AS month, sum(net_c) AS nc FROM lines GROUP BY ALL) GROUP BY product_id) h
USING (product_id)"""),
    "subscription_counts": query(["subs_monthly"], f"SELECT month_start, subscription_type, net_qty, cancellations FROM (SELECT {SUBS_COLUMNS} FROM subs_monthly)"),
    "subscription_revenue": query(["subs_monthly"], f"SELECT month_start, subscription_type, net_revenue FROM (SELECT {SUBS_COLUMNS} FROM subs_monthly)"),
    "subscription_card": query(["lines"], f"""
SELECT title AS subscription_type, price_c / 100.0::DOUBLE AS unit_price, {agg([], net_subscriptions="net_qty", total_revenue="net_revenue")},
  {guarded("(sum(ret) * 100)", ORDERS, 1, "cancellation_rate_pct")}, {guarded(NET, "(sum(net_q) * 100)", 2, "avg_ltv")}, {MARGIN}
FROM lines WHERE format = 'Subscription' GROUP BY title, price_c, cost_c"""),
    "subscription_promo_share": query(["subs_monthly"], f"SELECT month_start, subscription_type, promo_pct FROM (SELECT {SUBS_COLUMNS} FROM subs_monthly)"),
    # alerts
    "alerts_ranked": query(["alerts"], f"SELECT {alert_columns(*EMAIL_COLUMNS)} FROM ({RANKED_ALERTS})"),
    "alerts_for_recipients": query(["alerts"], f"SELECT {alert_columns(*EMAIL_COLUMNS)}, email, name FROM {ROUTED}"),
    "alert_gate": query(["alerts"], f"SELECT coalesce(bool_or(level IN ('critical', 'urgent')), false) AS send FROM alerts"),
    "alert_subject": query(["alerts"], f"""
SELECT '[Stock] low stock: ' || concat_ws(', ', CASE WHEN critical > 0 THEN critical || ' critical' END,
  CASE WHEN urgent > 0 THEN urgent || ' urgent' END, CASE WHEN warning > 0 THEN warning || ' warning' END)
  || strftime((SELECT last_day FROM span), ' - %d.%m.%Y') AS subject FROM (SELECT {LEVELS} FROM alerts)"""),
    "alert_log": query(["alerts"], f"""
SELECT CAST((SELECT last_day FROM span) AS VARCHAR) AS report_date, email AS recipient, count(*) AS rows_sent, {LEVELS},
       true AS success, CAST(NULL AS VARCHAR) AS error FROM {ROUTED} GROUP BY email"""),
    "alert_run": query(["alerts"], f"""
SELECT CAST((SELECT last_day FROM span) AS VARCHAR) AS report_date, email AS recipient, count(*) AS rows_sent, {LEVELS},
       true AS success, CAST(NULL AS VARCHAR) AS error
FROM {ROUTED} WHERE (SELECT bool_or(level IN ('critical', 'urgent')) FROM alerts) GROUP BY email"""),
    # checks
    "orphan_products": query(["sales", "product"], "SELECT DISTINCT product_id FROM sales WHERE product_id NOT IN (SELECT product_id FROM product)"),
    "negative_stock": query(["inventory"], "SELECT count(*) AS violations FROM inventory WHERE closing < 0"),
    "digital_in_inventory": query(["inventory", "product"], f"""
SELECT count(*) AS violations FROM inventory JOIN product USING (product_id) WHERE format NOT IN {PHYSICAL}"""),
    "dates_within_calendar": query(["sales"], """
SELECT min(date) AS first_sale, max(date) AS last_sale, min(date) >= (SELECT first_day FROM span) AS starts_inside,
       max(date) <= (SELECT last_day FROM span) AS ends_inside FROM sales"""),
    "missing_plan_combos": query(["grid", "plan"], """
SELECT genre, format, month, year FROM (SELECT genre, format, month, year FROM grid)
EXCEPT SELECT genre, format, month, year FROM plan"""),
    "returns_exceed_sales": query(["sales"], "SELECT count(*) AS violations FROM sales WHERE ret > qty"),
    "digital_returns": query(["lines"], f"SELECT count(*) AS violations FROM lines WHERE format NOT IN {PHYSICAL} AND ret <> 0"),
    "amount_mismatch": query(["sales"], """
SELECT count(*) AS violations FROM (SELECT amt_c / 100.0::DOUBLE AS a, qty::DOUBLE * (unit_c / 100.0::DOUBLE) AS b FROM sales)
WHERE abs(a - b) > 0.02::DOUBLE + 1e-5::DOUBLE * abs(b)"""),
    "declared_constraints": query(["product", "plan", "sales", "inventory"], CONSTRAINTS),
    # calendar, plan and stock operators
    "build_calendar": query(["span"], "SELECT date, year, month, quarter, CAST(is_weekend AS BIGINT) AS is_weekend, "
                            f"CAST(is_holiday_ru AS BIGINT) AS is_holiday_ru FROM {CALENDAR}"),
    "plan_grid": query(["grid"], f"SELECT year, month, genre, format, {whole('fq', 'fact_qty')}, {money('fc', 'fact_amount')} FROM grid"),
    "plan_from_history": query(["plan"], f"""
SELECT plan_id, genre, format, year, month, {whole("plan_q", "plan_qty")}, {money("plan_c", "plan_amount")},
       target AS plan_margin_target FROM plan"""),
    "daily_net_sold": query(["lines"], f"""
SELECT product_id, date, {whole("sum(qty)", "gross_sold")}, {whole("sum(net_q)", "net_sold")}
FROM lines WHERE format IN {PHYSICAL} GROUP BY product_id, date"""),
    "dense_daily_net_sold": query(["lines", "span"], f"""
SELECT product_id, (SELECT last_day - first_day + 1 FROM span) AS days, {whole("sum(net_q)", "net_sold")}
FROM lines WHERE format IN {PHYSICAL} GROUP BY product_id"""),
    "stock_ledger": query(["book2"], """
SELECT product_id, date, CAST(gross AS BIGINT) AS gross_sold, CAST(net AS BIGINT) AS net_sold,
       CAST(repl AS BIGINT) AS replenishment_qty, opening AS opening_stock, closing AS closing_stock, shortage FROM book2"""),
    "resumed_ledger": query(["book2"], """
SELECT product_id, date, CAST(gross AS BIGINT) AS gross_sold, CAST(net AS BIGINT) AS net_sold,
       CAST(repl AS BIGINT) AS replenishment_qty, opening AS opening_stock, closing AS closing_stock, shortage FROM book2
WHERE date < DATE '2001-07-01' OR gross <> 0 OR net <> 0 OR repl <> 0"""),
    "resumed_inventory": query(["inventory"], """
SELECT inventory_id, product_id, date, opening AS opening_stock, CAST(sold AS BIGINT) AS sold_qty, CAST(repl AS BIGINT) AS replenishment_qty,
       closing AS closing_stock, CAST(low AS BIGINT) AS is_low_stock FROM inventory WHERE date >= DATE '2001-07-01'"""),
    "shortage_allocation": query(["sales"], f"""
SELECT order_id, product_id, date, qty AS sales_qty, ret AS return_qty, {money("unit_c", "unit_price")},
       {money("amt_c", "sales_amount")}, {money("ramt_c", "return_amount")}, disc AS discount_percent, lost AS lost_sales_qty
FROM sales"""),
}
