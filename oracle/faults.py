"""SQL text for the extracts with planted faults: which rows of each table break which rule."""

from oracle.star import with_tables

FIRST_DAY = "DATE '1995-01-01'"


def _rule(table: str, code: str, level: str, what: str, count: str, source: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{code}' AS code, '{level}' AS level, '{what}' AS what, "
            f"CAST({count} AS BIGINT) AS n FROM {source}")


def _planted(table: str, source: str, key: str, rules: list[tuple]) -> str:
    """A rule counts the rows whose key leaves its remainder, or what is written out."""
    parts = [_rule(table, code, level, what, f"count(*) FILTER ({key} % 20 = {n})" if isinstance(n, int) else n, source)
             for code, level, what, n in rules]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n > 0"


_PLAN = [
    ("G-05", "reject", "empty row", 13), ("PL-01", "reject", "repeated id", 2), ("PL-02", "reject", "unknown genre", 3),
    ("PL-03", "reject", "unknown format", 4), ("PL-05", "reject", "month outside 1..12", 5), ("PL-06", "reject", "quantity negative", 6),
    ("PL-07", "reject", "amount negative", 7), ("PL-09", "reject", "margin outside 0..1", 8),
    ("PL-08", "warn", "quantity and amount disagree", 9), ("PL-10", "reject", "repeated genre, format and month", 10),
]
#: rows of the sales extract that no rule has rejected before the days are counted
_KEPT = "o_orderkey % 20 NOT IN (2, 3, 4, 5, 9)"
#: days of the kept rows without an order number: copies of a product among them go, whatever their day
_SOLD = f"""(SELECT CAST(o_orderdate AS DATE) AS d FROM (
    SELECT *, o_orderkey % 20 = 1 AND row_number() OVER (PARTITION BY o_orderkey % 20 = 1, o_orderkey % 100 ORDER BY o_orderkey) > 1 AS copy
    FROM orders) WHERE {_KEPT} AND NOT copy)"""

SQL = {
    "faults_dim_product": _planted("dim_product", "part", "p_partkey", [
        ("G-05", "reject", "empty row", 10), ("P-01", "reject", "repeated id", 2), ("P-02", "reject", "no title", 3),
        ("P-05", "reject", "unknown format", 4), ("P-08", "reject", "price not positive", 5), ("P-09", "reject", "cost not positive", 6),
        ("P-14", "reject", "reviews negative", 7), ("P-16", "reject", "copy under another id", 9)]),
    "faults_fact_plan": with_tables(["plan"], _planted("fact_plan", "plan", "plan_id", _PLAN)),
    "faults_in_files": with_tables(["plan"], _planted("fact_plan", "plan", "plan_id", [("G-01", "reject", "over-long line", 14), *_PLAN])),
    "faults_fact_sales": _planted("fact_sales", "orders", "o_orderkey", [
        ("G-05", "reject", "empty row", 9), ("S-02", "warn", "no order", 1), ("S-05", "reject", "not a date", 2),
        ("S-08", "reject", "quantity not positive", 3), ("S-09", "reject", "price not positive", 4),
        ("S-14", "reject", "discount outside 0..100", 5), ("S-12", "warn", "more returned than sold", 6),
        ("S-03", "reject", "repeated product in an order",
         "count(*) FILTER (o_orderkey % 20 = 1) - count(DISTINCT o_orderkey % 100) FILTER (o_orderkey % 20 = 1)"),
        ("S-18", "warn", "lost sales of a digital format", 7), ("S-19", "warn", "lost sales negative", 8),
        ("S-07", "warn", "days without sales",
         f"(SELECT greatest(0, max(d) - {FIRST_DAY} + 1 - count(DISTINCT d)) FROM {_SOLD})")]).replace(
             f"(SELECT greatest(0, max(d) - {FIRST_DAY} + 1 - count(DISTINCT d)) FROM {_SOLD}) AS BIGINT) AS n FROM orders",
             f"(SELECT greatest(0, max(d) - {FIRST_DAY} + 1 - count(DISTINCT d)) FROM {_SOLD}) AS BIGINT) AS n"),
    "faults_fact_inventory": _planted("fact_inventory", "orders", "o_orderkey", [
        ("G-05", "reject", "empty row", 9), ("I-02", "reject", "not a physical product", 1), ("I-03", "reject", "not a date", 2),
        ("I-06", "reject", "opening stock negative", 3), ("I-07", "reject", "sold quantity negative", 4),
        ("I-08", "reject", "replenishment negative", 5), ("I-09", "reject", "closing stock negative", 6),
        ("I-05", "reject", "repeated product and day", 8)]),
    # rows that survive, with the values the rules leave
    "clean_dim_date": """
SELECT d AS date, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month, CAST(quarter(d) AS BIGINT) AS quarter,
       CASE WHEN isodow(d) >= 6 THEN 1::BIGINT ELSE 0::BIGINT END AS is_weekend, CASE WHEN st = 'O' THEN 1::BIGINT ELSE 0::BIGINT END AS is_holiday_ru
FROM (SELECT *, row_number() OVER (PARTITION BY d ORDER BY pos) AS n FROM (
        SELECT row_number() OVER () AS pos, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS st, o_orderpriority AS pri FROM orders)
      WHERE pri <> '2-HIGH') WHERE n = 1 AND st IN ('F', 'O')""",
    "clean_fact_plan": with_tables(["plan"], """
SELECT plan_id, genre, format, year, month, plan_q AS plan_qty, plan_c / 100.0::DOUBLE AS plan_amount, target AS plan_margin_target
FROM plan WHERE year BETWEEN 1996 AND 2000"""),
    "csv_fallback_charset": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'Книга ' || p_partkey AS title, CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' «Ё»' END AS publisher
FROM part""",
}
