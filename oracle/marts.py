"""SQL text for the marts and their helper views."""

from oracle.star import BOOKS, guarded, money, quotient, whole, with_tables

# name -> aggregate over lines, in cents where it is money
NET, PROFIT, ORDERS = "sum(net_c)", "sum(profit_c)", "count(DISTINCT order_id)"
PROMO_NET = "sum(CASE WHEN promo = 1 THEN net_c ELSE 0 END)"

AGG = {
    "orders": whole(ORDERS, "orders"),
    "net_qty": whole("sum(net_q)", "net_qty"),
    "net_revenue": money(NET, "net_revenue"),
    "gross_profit": money(PROFIT, "gross_profit"),
    "return_qty": whole("sum(ret)", "return_qty"),
    "return_amount": money("sum(ramt_c)", "return_amount"),
    "promo_orders": whole("sum(promo)", "promo_orders"),
    "promo_revenue": money(PROMO_NET, "promo_revenue"),
    "lost_sales_qty": whole("sum(lost)", "lost_sales_qty"),
    "gross_qty": whole("sum(qty)", "gross_qty"),
    "gross_revenue": money("sum(amt_c)", "gross_revenue"),
    "total_cost": money("sum(net_q * cost_c)", "total_cost"),
}
MARGIN = guarded(PROFIT, NET, 4, "gross_margin")
AOV = guarded(NET, f"({ORDERS} * 100)", 2, "avg_order_value")
NINE = ["orders", "net_qty", "net_revenue", "gross_profit", "return_qty", "return_amount",
        "promo_orders", "promo_revenue", "lost_sales_qty"]


def agg(names, **renamed):
    cols = [AGG[n] for n in names]
    cols += [AGG[m].rsplit(" AS ", 1)[0] + f" AS {a}" for a, m in renamed.items()]
    return ", ".join(cols)


DAY = "CASE WHEN date = today THEN 'today' ELSE 'yesterday' END AS day_type"
TWO_DAYS = "lines, anchor WHERE date BETWEEN yesterday AND today"
MTD = {n: n for n in ("net_qty", "gross_profit", "return_qty", "return_amount", "orders")} | {"revenue": "net_revenue"}
MTD_MORE = {n: n for n in ("promo_orders", "promo_revenue", "lost_sales_qty")}


def _mtd(prefix, extra=()):
    names = MTD | {n: n for n in extra}
    return agg([], **{prefix + a: m for a, m in names.items()})


def _rates(prefix):
    return (guarded(PROFIT, NET, 4, f"{prefix}gross_margin") + ", "
            + guarded(NET, f"({ORDERS} * 100)", 2, f"{prefix}avg_order_value"))


NOW_LINES = "lines, anchor WHERE date BETWEEN m0 AND today"
THEN_LINES = "lines, anchor WHERE date BETWEEN p0 AND p1"

CURRENT_FACT = f"""
  SELECT genre, format, CAST(sum(net_q) AS BIGINT) AS fq, CAST(sum(net_c) AS BIGINT) AS fc
  FROM {NOW_LINES} AND format IN {BOOKS} GROUP BY ALL"""

TO_DATE = """
  SELECT p.*, passed, days, today, (2 * plan_q * passed + days) // (2 * days) AS due_q,
         (2 * plan_c * passed + days) // (2 * days) AS due_c
  FROM plan p, anchor WHERE p.year = year(today) AND p.month = month(today)"""

PLAN_FACT = """
  SELECT d.*, coalesce(f.fq, 0) AS fq, coalesce(f.fc, 0) AS fc FROM due d LEFT JOIN now_fact f USING (genre, format)"""

HISTORY = f"""
  SELECT p.*, coalesce(a.fq, 0) AS fq, coalesce(a.fc, 0) AS fc,
         CASE WHEN p.year * 12 + p.month < year(today) * 12 + month(today) THEN 'closed' ELSE 'current' END AS status
  FROM plan p LEFT JOIN actual a USING (year, month, genre, format), anchor"""

ABC = """
  SELECT *, sum(rev) OVER (ORDER BY rev DESC, product_id ROWS UNBOUNDED PRECEDING) AS run,
         rank() OVER (ORDER BY rev DESC) AS rnk, sum(rev) OVER () AS total
  FROM (SELECT product_id, sum(net_q) AS q, sum(net_c) AS rev, count(DISTINCT date) AS days,
               count(DISTINCT order_id) AS orders, sum(lost) AS lost
        FROM lines WHERE format <> 'Subscription' GROUP BY product_id)"""
CLASSED = """
  SELECT a.*, p.* EXCLUDE (product_id),
         CASE WHEN run * 100 <= total * 80 THEN 'A' WHEN run * 100 <= total * 95 THEN 'B' ELSE 'C' END AS cls
  FROM abc a JOIN product p USING (product_id)"""

PUBLISHERS = """
  SELECT publisher, format, count(DISTINCT product_id) AS products, sum(net_q) AS nq, sum(net_c) AS nc,
         sum(net_q * cost_c) AS cc, sum(profit_c) AS pc, sum(rating_t) AS rt, count(rating_t) AS rn
  FROM lines WHERE publisher IS NOT NULL GROUP BY publisher, format"""

SUBS_MONTHLY = """
  SELECT year, month, quarter, month_start, title, count(DISTINCT order_id) AS orders, sum(net_q) AS nq,
         sum(net_c) AS nc, sum(profit_c) AS pc, sum(ret) AS rq, sum(ramt_c) AS rc, sum(promo) AS pr, count(*) AS n
  FROM lines WHERE format = 'Subscription' GROUP BY ALL"""

ALERTS = """
  SELECT i.product_id, p.title, p.format, p.genre, p.publisher, p.price_c, p.cost_c, i.closing, i.low, i.date,
         coalesce(rate, 0) AS rate_t,
         CASE WHEN closing = 0 THEN 'critical' WHEN closing < 5 THEN 'urgent' ELSE 'warning' END AS level,
         CASE WHEN rate > 0 THEN (2 * closing * 10 + rate) // (2 * rate) END AS days_left,
         greatest(0, (coalesce(rate, 0) * 45 + CASE WHEN coalesce(rate, 0) > 0 THEN 9 ELSE 0 END) // 10 - closing) AS reorder
  FROM inventory i JOIN product p USING (product_id)
  LEFT JOIN (SELECT product_id, sign(sum(net_q)) * ((2 * abs(sum(net_q)) * 10 + 30) // 60) AS rate
             FROM lines, span WHERE date > last_day - 30 AND date <= last_day GROUP BY product_id) r USING (product_id)
  WHERE i.date = (SELECT last_day FROM span) AND closing < 15 AND p.format IN ('Paperback', 'Hardcover')"""

# name -> needed tables for the derived CTEs above
DERIVED = {
    "now_fact": (["lines", "anchor"], CURRENT_FACT, []),
    "due": (["plan", "anchor"], TO_DATE, []),
    "plan_fact": ([], PLAN_FACT, ["now_fact", "due"]),
    "history": (["plan", "actual", "anchor"], HISTORY, []),
    "abc": (["lines"], ABC, []),
    "classed": (["product"], CLASSED, ["abc"]),
    "publishers": (["lines"], PUBLISHERS, []),
    "subs_monthly": (["lines"], SUBS_MONTHLY, []),
    "alerts": (["inventory", "product", "lines", "span"], ALERTS, []),
}


def query(names, body):
    base, extra = [], {}

    def add(name):
        if name in DERIVED:
            needs, text, derived = DERIVED[name]
            for d in derived:
                add(d)
            base.extend(needs)
            extra[name] = text
        else:
            base.append(name)

    for n in names:
        add(n)
    return with_tables(base, body, extra)


PUBLISHER_COLUMNS = (
    "publisher, format, " + whole("products", "product_count") + ", " + whole("nq", "net_qty") + ", "
    + money("nc", "net_revenue") + ", " + money("cc", "total_cost") + ", " + money("pc", "gross_profit") + ", "
    + guarded("pc", "nc", 4, "gross_margin") + ", " + quotient("rt", "rn * 10", 2) + " AS avg_product_rating, "
    "rank() OVER (PARTITION BY format ORDER BY pc DESC) AS rank_by_format, rank() OVER (ORDER BY pc DESC) AS rank_overall")

ALERT_COLUMNS = {
    "product_id": "product_id", "title": "title", "format": "format", "genre": "genre", "publisher": "publisher",
    "price_rub": "price_c / 100.0::DOUBLE", "closing_stock": "closing", "is_low_stock": "CAST(low AS BIGINT)",
    "stock_date": "date", "avg_daily_sales_30d": "rate_t / 10.0::DOUBLE",
    "days_until_stockout": "CAST(days_left AS BIGINT)", "recommended_order_qty": "CAST(reorder AS BIGINT)",
    "recommended_order_cost": "CAST(reorder * cost_c AS BIGINT) / 100.0::DOUBLE", "alert_level": "level",
}


def alert_columns(*names):
    return ", ".join(f"{ALERT_COLUMNS[n]} AS {n}" for n in (names or ALERT_COLUMNS))


HISTORY_COLUMNS = (
    "genre, format, year, month, plan_q AS plan_qty, " + money("plan_c", "plan_amount")
    + ", target AS plan_margin_target, " + whole("fq", "fact_qty") + ", " + money("fc", "fact_amount")
    + f", CASE WHEN plan_c > 0 THEN {quotient('fc * 100', 'plan_c', 1)} END AS pct_of_plan, "
    + money("fc - plan_c", "delta_amount") + ", status AS month_status")

SUBS_COLUMNS = (
    "year, month, quarter, month_start, title AS subscription_type, orders AS new_subscriptions, "
    + ", ".join([whole("nq", "net_qty"), money("nc", "net_revenue"), money("pc", "gross_profit"),
                 guarded("pc", "nc", 4, "gross_margin"), whole("rq", "cancellations"),
                 money("rc", "cancelled_revenue"), quotient("pr * 100", "n", 1) + " AS promo_pct",
                 guarded("nc", "(nq * 100)", 2, "avg_subscription_price")]))

TRENDS = ["orders", "gross_qty", "return_qty", "net_qty", "gross_revenue", "net_revenue", "total_cost",
          "gross_profit", "promo_orders", "promo_revenue", "lost_sales_qty"]

SQL = {
    "dates": query(["anchor"], "SELECT today, yesterday FROM anchor"),
    "daily_sales": query(["lines", "anchor"],
                         f"SELECT date, {DAY}, genre, format, {agg(NINE)} FROM {TWO_DAYS} GROUP BY date, today, genre, format"),
    "daily_channels": query(["lines", "anchor"], f"""
SELECT date, {DAY}, channel, {agg(["orders", "net_qty", "net_revenue", "gross_profit", "promo_orders", "promo_revenue"])}
FROM {TWO_DAYS} GROUP BY date, today, channel"""),
    "mtd_current": query(["lines", "anchor"], f"SELECT {_mtd('mtd_', MTD_MORE)} FROM {NOW_LINES}"),
    "mtd_previous": query(["lines", "anchor"], f"SELECT {_mtd('prev_mtd_')} FROM {THEN_LINES}"),
    "mart_daily_pulse": query(["lines", "anchor"], f"""
SELECT {DAY}, date AS report_date, date - 1 AS prev_date, {money("sum(nc)", "total_revenue")},
  {whole("sum(o)", "total_orders")}, {guarded("sum(nc)", "(sum(o) * 100)", 2, "avg_order_value")},
  {money("sum(pc)", "total_gross_profit")}, {guarded("sum(pc)", "sum(nc)", 4, "gross_margin")},
  {whole("sum(rq)", "return_qty")}, {money("sum(rc)", "return_amount")}, {whole("sum(pr)", "promo_orders")},
  {money("sum(pn)", "promo_revenue")}, {whole("sum(lo)", "lost_sales_qty")}
FROM (SELECT date, genre, format, {ORDERS} AS o, {NET} AS nc, {PROFIT} AS pc, sum(ret) AS rq, sum(ramt_c) AS rc,
             sum(promo) AS pr, {PROMO_NET} AS pn, sum(lost) AS lo
      FROM {TWO_DAYS} GROUP BY date, genre, format), anchor
GROUP BY date, today"""),
    "mart_daily_pulse_exact_orders": query(["lines", "anchor"], f"""
SELECT {DAY}, date AS report_date, date - 1 AS prev_date,
  {agg(["return_qty", "return_amount", "promo_orders", "promo_revenue", "lost_sales_qty"],
       total_revenue="net_revenue", total_orders="orders", total_gross_profit="gross_profit")},
  {AOV}, {MARGIN}
FROM {TWO_DAYS} GROUP BY date, today"""),
    "mart_daily_channels": query(["lines", "anchor"], f"""
SELECT {DAY}, date AS report_date, channel, {agg(["orders", "net_qty", "net_revenue", "gross_profit", "promo_orders", "promo_revenue"])}, {MARGIN}
FROM {TWO_DAYS} GROUP BY date, today, channel"""),
    "mart_mtd_pulse": query(["lines", "anchor"], f"""
SELECT m0 AS month_start, today AS month_to_date, n.*, t.* FROM anchor,
  (SELECT {_mtd('mtd_', MTD_MORE)}, {_rates('mtd_')} FROM {NOW_LINES}) n,
  (SELECT {_mtd('prev_mtd_')}, {_rates('prev_mtd_')} FROM {THEN_LINES}) t"""),
    "mart_daily_revenue_mtd": query(["lines", "anchor", "plan"], f"""
SELECT date, {agg(["net_revenue", "gross_profit", "orders", "return_qty", "return_amount"])},
  any_value(target) AS daily_plan_target
FROM lines, anchor, (SELECT {quotient("sum(plan_c)", "any_value(days) * 100", 2)} AS target
                     FROM plan, anchor WHERE year = year(today) AND month = month(today)) x
WHERE date BETWEEN m0 AND today GROUP BY date"""),
    "mart_daily_top5": query(["lines", "anchor"], f"""
SELECT product_id, title, format, genre, {money("nc", "revenue")}, {whole("nq", "net_qty")}, rnk
FROM (SELECT product_id, title, format, genre, sum(net_c) AS nc, sum(net_q) AS nq,
             rank() OVER (ORDER BY sum(net_c) DESC) AS rnk
      FROM lines, anchor WHERE date = today GROUP BY ALL) WHERE rnk <= 5"""),
    "month_progress": query(["anchor"], "SELECT today, passed AS days_passed, days AS days_in_month FROM anchor"),
    "plan_to_date": query(["due"], f"""
SELECT genre, format, year, month, plan_q AS plan_qty, {money("plan_c", "plan_amount")}, target AS plan_margin_target,
  {whole("due_q", "plan_qty_to_date")}, {money("due_c", "plan_amount_to_date")} FROM due"""),
    "mart_plan_fact": query(["plan_fact"], f"""
SELECT genre, format, year, month, plan_q AS plan_qty, {money("plan_c", "plan_amount")}, target AS plan_margin_target,
  {whole("due_q", "plan_qty_to_date")}, {money("due_c", "plan_amount_to_date")}, {whole("fq", "fact_qty")},
  {money("fc", "fact_amount")}, CASE WHEN due_c > 0 THEN {quotient("fc * 100", "due_c", 1)} END AS pct_of_plan_to_date,
  {money("fc - due_c", "delta_amount_to_date")}, {quotient("fc * days", "passed * 100", 2)} AS forecast_month_amount,
  today AS report_date FROM plan_fact"""),
    "mart_daily_breakdown": query(["lines", "anchor"], f"""
SELECT {DAY}, genre, format, {agg(NINE)} FROM {TWO_DAYS} AND format IN {BOOKS} GROUP BY date, today, genre, format"""),
    "mart_daily_format_pulse": query(["lines", "anchor"], f"""
SELECT {DAY}, format, {agg(NINE)}, {MARGIN} FROM {TWO_DAYS} GROUP BY date, today, format"""),
    "mart_plan_fact_history": query(["history"], f"SELECT {HISTORY_COLUMNS} FROM history"),
    "latest_stock": query(["inventory"], """
SELECT product_id, closing AS closing_stock, CAST(low AS BIGINT) AS is_low_stock, date AS stock_date
FROM inventory WHERE date = (SELECT last_day FROM span)"""),
    "avg_daily_sales_30d": query(["lines", "span"], f"""
SELECT product_id, {quotient("sum(net_q)", "30", 1)} AS avg_daily_sales_30d
FROM lines, span WHERE date > last_day - 30 GROUP BY product_id"""),
    "mart_inventory_alerts": query(["alerts"], f"SELECT {alert_columns()} FROM alerts"),
    "mart_sales_trends": query(["lines"], f"""
SELECT year, month, quarter, month_start, genre, format, coalesce(language, 'N/A') AS language,
  {agg(TRENDS, return_revenue="return_amount")}, {MARGIN}, {AOV}
FROM lines GROUP BY year, month, quarter, month_start, genre, format, coalesce(language, 'N/A')"""),
    "mart_abc": query(["classed"], f"""
SELECT product_id, title, author, publisher, genre, format, language, price_c / 100.0::DOUBLE AS price_rub,
  cost_c / 100.0::DOUBLE AS cost_rub, rating_t / 10.0::DOUBLE AS avg_rating, review_count,
  {whole("q", "total_net_qty")}, {money("rev", "total_net_revenue")}, days AS active_days, orders AS total_orders,
  {whole("lost", "total_lost_qty")}, {money("total", "grand_total_revenue")},
  {quotient("rev * 100", "total", 2)} AS revenue_pct,
  CAST(run AS BIGINT)::DOUBLE / CAST(total AS BIGINT)::DOUBLE * 100 AS cumulative_pct, rnk AS revenue_rank,
  cls AS abc_class, {guarded("(rev - q * cost_c)", "rev", 4, "product_margin")} FROM classed"""),
    "mart_margin": query(["lines"], f"""
SELECT format, count(DISTINCT product_id) AS unique_products, {agg(["net_qty", "net_revenue", "total_cost", "gross_profit"])},
  {MARGIN}, {quotient("sum(rating_t)", "count(rating_t) * 10", 2)} AS avg_rating FROM lines GROUP BY format"""),
    "mart_margin_by_format": query(["lines"], f"""
SELECT year, month, quarter, month_start, format, count(DISTINCT product_id) AS unique_products,
  {agg(["net_qty", "net_revenue", "total_cost", "gross_profit"])}, {MARGIN}
FROM lines GROUP BY year, month, quarter, month_start, format"""),
    "mart_margin_by_publisher": query(["publishers"], f"SELECT {PUBLISHER_COLUMNS} FROM publishers"),
    "mart_subscriptions": query(["lines"], f"""
SELECT title AS subscription_type, {agg([], total_orders="orders", net_subscriptions="net_qty", total_revenue="net_revenue",
       gross_profit="gross_profit", total_cancellations="return_qty", promo_count="promo_orders")}, {MARGIN},
  {guarded("(sum(ret) * 100)", ORDERS, 1, "cancellation_rate_pct")},
  {guarded("(sum(promo) * 100)", ORDERS, 1, "promo_rate_pct")},
  min(date) AS first_sale_date, max(date) AS last_sale_date, price_c / 100.0::DOUBLE AS unit_price,
  cost_c / 100.0::DOUBLE AS unit_cost, {quotient("(price_c - cost_c)", "price_c", 4)} AS unit_margin,
  {guarded(NET, "(sum(net_q) * 100)", 2, "avg_ltv")}
FROM lines WHERE format = 'Subscription' GROUP BY title, price_c, cost_c"""),
    "mart_subscriptions_monthly": query(["subs_monthly"], f"SELECT {SUBS_COLUMNS} FROM subs_monthly"),
}
