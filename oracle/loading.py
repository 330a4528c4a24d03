"""SQL text for the loading queries."""

from oracle import marts, reports
from oracle.marts import agg, query
from oracle.quality import AS_OF, PARTS, START
from oracle.star import with_tables

CUTOFF = "DATE '2001-06-01'"
PAST_DAY = "DATE '2000-05-17'"

PRODUCT = """
SELECT product_id, CASE WHEN format <> 'Subscription' THEN '978' || lpad(CAST(product_id % 1000000000 AS VARCHAR), 9, '0') || p_size % 10 END AS isbn,
       title, author, publisher, DATE '1985-01-01' + CAST(product_id % 3650 AS INTEGER) AS published_date, language,
       CASE WHEN is_physical = 1 THEN CAST(100 + p_size * 10 AS BIGINT) END AS page_count, genre, format,
       price_c / 100.0::DOUBLE AS price_rub, cost_c / 100.0::DOUBLE AS cost_rub, rating_t / 10.0::DOUBLE AS avg_rating,
       review_count, stock_initial, CAST(is_physical AS BIGINT) AS is_physical FROM product"""

FRESH = f"""(SELECT count(DISTINCT sales_id) FROM sales WHERE date >= {CUTOFF}
   AND sales_id NOT IN (SELECT sales_id FROM sales WHERE date < {CUTOFF}))"""
BATCH = f"(SELECT count(*) FROM sales WHERE date >= {CUTOFF})"

# History and update are validated apart, so repeats are judged within each.
_HALF = """
  SELECT *, coalesce(r1, CASE WHEN row_number() OVER (PARTITION BY r1 IS NULL, oid, pid ORDER BY pos) > 1 THEN 'S-03' END) AS r2 FROM (
    SELECT *, CASE WHEN copy THEN 'S-01' WHEN fmt IS NULL THEN 'S-04' WHEN d < {start} OR d > {as_of} THEN 'S-06'
                   WHEN pri = '4-NOT SPECIFIED' THEN 'S-17' END AS r1
    FROM (SELECT s.*, o_orderpriority AS pri, k.format AS fmt, row_number() OVER (PARTITION BY s.id ORDER BY s.pos) > 1 AS copy
          FROM raw_sales s LEFT JOIN orders ON o_orderkey = oid
          LEFT JOIN (SELECT id, format FROM kept_product WHERE r1 IS NULL) k ON k.id = pid WHERE d {side} {cutoff}))"""
_HALVES = {
    name: _HALF.format(start=START, as_of=AS_OF, cutoff=CUTOFF, side=side)
    for name, side in (("history_half", "<"), ("update_half", ">="))}
STORED = with_tables([], """
SELECT CAST(date_trunc('month', d) AS DATE) AS month_start, count(*) AS rows, CAST(sum(qty) AS BIGINT) AS qty
FROM (SELECT d, qty FROM history_half WHERE r2 IS NULL
      UNION ALL SELECT d, qty FROM update_half WHERE r2 IS NULL AND id NOT IN (SELECT id FROM history_half WHERE r2 IS NULL))
GROUP BY 1""", {**{n: PARTS[n] for n in ("raw_product", "kept_product", "raw_sales")}, **_HALVES})

GROUPS = [("daily_pulse", 5), ("plan_fact", 4), ("inventory_alerts", 1), ("sales_trends", 1), ("abc", 1), ("margin", 3), ("subscriptions", 2)]

_LINES = "FROM sales s JOIN product p USING (product_id)"


def _past(text: str) -> str:
    """The same text over the lines up to a past day."""
    assert _LINES in text
    return text.replace(_LINES, f"FROM (SELECT * FROM sales WHERE date <= {PAST_DAY}) s JOIN product p USING (product_id)")


SQL = {
    **{f"{name}_as_of": _past(marts.SQL[name]) for name in ("mart_sales_trends", "mart_abc", "mart_margin", "mart_subscriptions")},
    "dates_within_calendar_as_of": reports.SQL["dates_within_calendar"],
    "maintained_months": query(["lines"], f"""
SELECT month_start, count(*) AS lines, {agg(["net_qty", "net_revenue", "gross_profit", "orders"])},
       count(DISTINCT product_id) AS products FROM lines GROUP BY month_start"""),
    "trends_of_touched_months": marts.SQL["mart_sales_trends"],
    "csv_round_trip": query(["product"], PRODUCT),
    "load_dim_product": query(["product"], PRODUCT),
    "history_update_split": query(["sales", "span"], """
SELECT CASE WHEN date < last_day THEN 'history' ELSE 'update' END AS part, count(*) AS rows, min(date) AS first_day,
       max(date) AS last_day, CAST(sum(qty) AS BIGINT) AS qty FROM sales, span GROUP BY 1"""),
    "full_load": query(["sales", "product"], f"""
SELECT 'dim_product' AS tbl, count(*) AS rows FROM product UNION ALL SELECT 'fact_sales', {BATCH}"""),
    "insert_rows": query(["sales"], f"""
SELECT 1::BIGINT AS run, 0::BIGINT AS existing, {BATCH} AS received, {FRESH} AS inserted, {BATCH} - {FRESH} AS skipped
UNION ALL SELECT 2, {FRESH}, {BATCH}, 0, {BATCH}"""),
    "incremental_load": STORED,
    "stream_load": STORED,
    "refresh_all_marts": " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS step, '{g}' AS mart_group, {n}::BIGINT AS marts, true AS ok, NULL::VARCHAR AS error"
        for i, (g, n) in enumerate(GROUPS, 1)),
}
