"""SQL text for the quality rules over the raw extracts."""

from oracle.star import with_tables

START, AS_OF = "DATE '1996-01-01'", "DATE '2001-06-30'"

_BAD_ISBN = "list_sum([CAST(substr(digits, i, 1) AS INTEGER) * (CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END) FOR i IN range(1, 14)]) % 10 <> 0"

# raw columns as already parsed values, with how many values were trimmed and blanked
RAW_DATE = """
  SELECT row_number() OVER () AS pos, CAST(o_orderdate AS DATE) AS d, o_orderpriority = '2-HIGH' AS bad,
         CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS off, o_orderstatus AS st, isodow(o_orderdate) >= 6 AS we,
         (CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) + (CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 1 ELSE 0 END) AS trimmed,
         CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 1 ELSE 0 END AS blanked
  FROM orders"""
KEPT_DATE = """
  SELECT *, CASE WHEN bad THEN 'D-01' WHEN row_number() OVER (PARTITION BY bad, d ORDER BY pos) > 1 THEN 'D-03' END AS r1
  FROM raw_date"""

RAW_PRODUCT = """
  SELECT row_number() OVER () AS pos, p_partkey AS id, p_size AS sz, format, price_c, price_c * pct // 100 + p_size * 1000 AS cost,
         p_size / 8.0::DOUBLE AS rating, p_size % 12 AS g, p_type = 'LARGE' AS claimed,
         regexp_replace('978-' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '-' || p_size % 10, '[^0-9]', '', 'g') AS digits,
         p_name, CASE WHEN p_size % 11 <> 0 THEN p_brand END AS publisher
  FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN 'eBook' WHEN 'SMALL' THEN 'Audiobook' WHEN 'LARGE' THEN 'Hardcover'
                 WHEN 'PROMO' THEN 'Subscription' ELSE 'Paperback' END AS format,
               CASE p_type WHEN 'ECONOMY' THEN 20 WHEN 'SMALL' THEN 35 WHEN 'LARGE' THEN 55 WHEN 'PROMO' THEN 15 ELSE 60 END AS pct,
               CAST(round(p_retailprice * 100) AS BIGINT) AS price_c FROM part)"""
KEPT_PRODUCT = """
  SELECT *, CASE WHEN id <= 0 THEN 'P-01' WHEN g = 11 THEN 'P-06' WHEN rating > 5 THEN 'P-13' END AS r1,
         format IN ('Paperback', 'Hardcover') AS physical, format = 'Subscription' AS sub
  FROM raw_product"""

RAW_SALES = """
  SELECT row_number() OVER () AS pos, l_orderkey * 10 + l_linenumber AS id, l_orderkey AS oid, l_partkey AS pid,
         CAST(l_shipdate AS DATE) AS d, CAST(l_quantity AS BIGINT) AS qty, l_returnflag = 'R' AS ret,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS list_c, CAST(round(l_discount * 100) AS BIGINT) AS disc
  FROM lineitem"""
STEP1_SALES = f"""
  SELECT *, CASE WHEN copy THEN 'S-01' WHEN fmt IS NULL THEN 'S-04' WHEN d < {START} OR d > {AS_OF} THEN 'S-06'
                 WHEN pri = '4-NOT SPECIFIED' THEN 'S-17' END AS r1,
         amt_c / 100.0::DOUBLE AS amount, unit_c / 100.0::DOUBLE AS unit
  FROM (
    SELECT s.*, o_orderpriority AS pri, k.format AS fmt,
           row_number() OVER (PARTITION BY s.id ORDER BY s.pos) > 1 AS copy,
           (list_c * (100 - disc) + 50) // 100 AS amt_c, (2 * list_c + qty) // (2 * qty) AS unit_c
    FROM raw_sales s LEFT JOIN orders ON o_orderkey = oid
    LEFT JOIN (SELECT id, format FROM kept_product WHERE r1 IS NULL) k ON k.id = pid)"""
STEP2_SALES = """
  SELECT *, coalesce(r1, CASE WHEN row_number() OVER (PARTITION BY r1 IS NULL, oid, pid ORDER BY pos) > 1 THEN 'S-03' END) AS r2,
         fmt IN ('eBook', 'Audiobook', 'Subscription') AS digital,
         CASE WHEN ret THEN qty ELSE 0 END AS rq, CASE WHEN ret THEN amount ELSE 0 END AS ra
  FROM step1_sales"""

RAW_INVENTORY = f"""
  SELECT b.*, k.format AS fmt, CASE WHEN k.id IS NULL THEN 'I-01' WHEN date < {START} OR date > {AS_OF} THEN 'I-04'
         WHEN net < 0 THEN 'I-07' END AS r1
  FROM book2 b LEFT JOIN (SELECT id, format FROM kept_product WHERE r1 IS NULL) k ON k.id = product_id"""

PARTS = {
    "raw_date": RAW_DATE, "kept_date": KEPT_DATE, "raw_product": RAW_PRODUCT, "kept_product": KEPT_PRODUCT,
    "raw_sales": RAW_SALES, "step1_sales": STEP1_SALES, "step2_sales": STEP2_SALES, "raw_inventory": RAW_INVENTORY,
}

# table -> (base tables, own CTEs, from, [(code, level, what, count expression)])
TABLES = {
    "dim_date": ([], ["raw_date", "kept_date"], "kept_date", [
        ("G-04", "fix", "trimmed values", "sum(trimmed)"), ("G-03", "fix", "blank values", "sum(blanked)"),
        ("D-01/D-02", "reject", "not a date", "count(*) FILTER (WHERE r1 = 'D-01')"),
        ("D-03", "reject", "repeated date", "count(*) FILTER (WHERE r1 = 'D-03')"),
        ("D-04", "fix", "date parts recomputed", "count(*) FILTER (WHERE r1 IS NULL AND off = 1)"),
        ("D-05", "fix", "weekend recomputed", "count(*) FILTER (WHERE r1 IS NULL AND st = 'F')"),
        ("D-06", "reject", "holiday flag not 0/1", "count(*) FILTER (WHERE r1 IS NULL AND st NOT IN ('F', 'O'))"),
    ]),
    "dim_product": ([], ["raw_product", "kept_product"], "kept_product", [
        ("G-04", "fix", "trimmed values", "count(*)"),
        ("G-03", "fix", "blank values", "count(*) FILTER (WHERE publisher IS NULL)"),
        ("P-01", "reject", "id not positive", "count(*) FILTER (WHERE r1 = 'P-01')"),
        ("P-06", "reject", "unknown genre", "count(*) FILTER (WHERE r1 = 'P-06')"),
        ("P-13", "reject", "rating outside 0..5", "count(*) FILTER (WHERE r1 = 'P-13')"),
        ("P-03", "warn", "book without author", "count(*) FILTER (WHERE r1 IS NULL AND NOT sub AND sz % 7 = 0)"),
        ("P-04", "warn", "book without publisher", "count(*) FILTER (WHERE r1 IS NULL AND NOT sub AND publisher IS NULL)"),
        ("P-07", "warn", "invalid ISBN", f"count(*) FILTER (WHERE r1 IS NULL AND NOT sub AND {_BAD_ISBN})"),
        ("P-10", "warn", "cost above price", "count(*) FILTER (WHERE r1 IS NULL AND cost > price_c)"),
        ("P-11", "warn", "paper book without pages", "count(*) FILTER (WHERE r1 IS NULL AND physical AND sz % 5 = 0)"),
        ("P-12", "fix", "stock of a digital format cleared", "count(*) FILTER (WHERE r1 IS NULL AND NOT physical)"),
        ("P-15", "fix", "physical flag recomputed", "count(*) FILTER (WHERE r1 IS NULL AND physical <> claimed)"),
    ]),
    "fact_plan": (["plan"], [], "plan", [
        ("PL-04", "reject", "year out of range", "count(*) FILTER (WHERE year NOT BETWEEN 1996 AND 2000)"),
        ("PL-08", "warn", "quantity and amount disagree",
         "count(*) FILTER (WHERE year BETWEEN 1996 AND 2000 AND (plan_q = 0) <> (plan_c = 0))"),
    ]),
    "fact_sales": ([], ["raw_product", "kept_product", "raw_sales", "step1_sales", "step2_sales"], "step2_sales", [
        ("G-04", "fix", "trimmed values", "count(*) FILTER (WHERE pri = '5-LOW')"),
        ("G-03", "fix", "blank values", "count(*) FILTER (WHERE pri = '4-NOT SPECIFIED')"),
        ("S-01", "reject", "repeated id", "count(*) FILTER (WHERE r2 = 'S-01')"),
        ("S-04", "reject", "unknown product", "count(*) FILTER (WHERE r2 = 'S-04')"),
        ("S-06", "reject", "outside the project period", "count(*) FILTER (WHERE r2 = 'S-06')"),
        ("S-17", "reject", "unknown channel", "count(*) FILTER (WHERE r2 = 'S-17')"),
        ("S-03", "reject", "repeated product in an order", "count(*) FILTER (WHERE r2 = 'S-03')"),
        ("S-07", "warn", "days without sales",
         f"greatest(0, max(d) FILTER (WHERE r2 IS NULL) - {START} + 1 - count(DISTINCT d) FILTER (WHERE r2 IS NULL))"),
        ("S-10", "warn", "amount off quantity x price",
         "count(*) FILTER (WHERE r2 IS NULL AND NOT abs(amount - qty::DOUBLE * unit) <= 1e-8::DOUBLE + 0.01::DOUBLE * abs(qty::DOUBLE * unit))"),
        ("S-11", "warn", "return of a digital format", "count(*) FILTER (WHERE r2 IS NULL AND digital AND rq > 0)"),
        ("S-13", "warn", "return amount off quantity x price",
         "count(*) FILTER (WHERE r2 IS NULL AND NOT abs(ra - rq::DOUBLE * unit) <= 1e-8::DOUBLE + 0.01::DOUBLE * abs(rq::DOUBLE * unit))"),
        ("S-15", "warn", "promotion without discount or code", "count(*) FILTER (WHERE r2 IS NULL AND disc >= 10)"),
        ("S-16", "warn", "discount without promotion", "count(*) FILTER (WHERE r2 IS NULL AND disc BETWEEN 1 AND 4)"),
    ]),
    "fact_inventory": (["book2"], ["raw_product", "kept_product", "raw_inventory"], "raw_inventory", [
        ("I-01", "reject", "unknown product", "count(*) FILTER (WHERE r1 = 'I-01')"),
        ("I-04", "reject", "outside the project period", "count(*) FILTER (WHERE r1 = 'I-04')"),
        ("I-07", "reject", "sold quantity negative", "count(*) FILTER (WHERE r1 = 'I-07')"),
        ("I-10", "warn", "stock does not balance",
         "count(*) FILTER (WHERE r1 IS NULL AND NOT abs(closing - (opening - net + repl)) <= 1.0::DOUBLE + 1e-5::DOUBLE * abs(opening - net + repl))"),
        ("I-11", "fix", "low-stock flag recomputed", "count(*) FILTER (WHERE r1 IS NULL AND closing BETWEEN 10 AND 14)"),
    ]),
}


def _with(names, body):
    base, own = [], []
    for n in names:
        base += TABLES[n][0]
        own += [c for c in TABLES[n][1] if c not in own]
    return with_tables(base, body, {c: PARTS[c] for c in own})


def _details(name):
    _, _, source, counts = TABLES[name]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{code}' AS code, '{level}' AS level, '{what}' AS what, CAST({expr} AS BIGINT) AS n FROM {source}"
        for code, level, what, expr in counts)


ALL = " UNION ALL ".join(_details(n) for n in TABLES)
SIZES = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS received FROM {t[2]}" for n, t in TABLES.items())
SUMMARY = f"""
SELECT table_name, received AS rows_received, CAST(rej AS BIGINT) AS rows_rejected, CAST(fix AS BIGINT) AS rows_fixed,
       CAST(warn AS BIGINT) AS warnings, CAST(received - rej AS BIGINT) AS rows_loaded
FROM ({SIZES}) JOIN (
  SELECT table_name, coalesce(sum(n) FILTER (WHERE level = 'reject'), 0) AS rej, coalesce(sum(n) FILTER (WHERE level = 'fix'), 0) AS fix,
         coalesce(sum(n) FILTER (WHERE level = 'warn'), 0) AS warn FROM ({ALL}) GROUP BY table_name) USING (table_name)"""

SQL = {f"dq_{n}": _with([n], f"SELECT * FROM ({_details(n)}) WHERE n > 0") for n in TABLES}
SQL["dq_summary"] = _with(list(TABLES), SUMMARY)
SQL["dq_details"] = _with(list(TABLES), f"SELECT * FROM ({ALL}) WHERE n > 0")
SQL["dq_total_issues"] = _with(list(TABLES), f"SELECT CAST(sum(rows_rejected + warnings) AS BIGINT) AS issues FROM ({SUMMARY})")
SQL["missing_sales_days"] = _with(["fact_sales"], f"""
SELECT CAST(x AS DATE) AS date FROM (SELECT unnest(generate_series({START}, max(d), INTERVAL 1 DAY)) AS x FROM step2_sales WHERE r2 IS NULL)
WHERE CAST(x AS DATE) NOT IN (SELECT d FROM step2_sales WHERE r2 IS NULL)""")
SQL["clean_dim_product"] = _with(["dim_product"], """
SELECT id AS product_id, '978-' || lpad(CAST(id AS VARCHAR), 9, '0') || '-' || sz % 10 AS isbn, p_name AS title,
       CASE WHEN sz % 7 <> 0 THEN 'Author ' || sz END AS author, publisher, DATE '2020-01-31' AS published_date, 'English' AS language,
       CASE WHEN sz % 5 <> 0 THEN CAST(100 + sz AS BIGINT) END AS page_count,
       CASE WHEN g = 10 THEN 'Subscription' ELSE list_extract(
         ['Fiction','Fantasy','Mystery','Romance','Science','Biography','Business','Children','History','Poetry'], g + 1) END AS genre,
       format, price_c / 100.0::DOUBLE AS price_rub, cost / 100.0::DOUBLE AS cost_rub,
       CAST((2 * sz * 10 + 8) // 16 AS BIGINT) / 10.0::DOUBLE AS avg_rating, CAST(id % 500 AS BIGINT) AS review_count,
       CASE WHEN physical THEN CAST(id % 60 AS BIGINT) END AS stock_initial, CASE WHEN physical THEN 1::BIGINT ELSE 0::BIGINT END AS is_physical
FROM kept_product WHERE r1 IS NULL""")
SQL["clean_fact_sales"] = _with(["fact_sales"], """
SELECT id AS sales_id, oid AS order_id, pid AS product_id, d AS date, qty AS sales_qty, CAST(rq AS BIGINT) AS return_qty, unit AS unit_price,
       amount AS sales_amount, ra AS return_amount, disc AS discount_percent, CASE WHEN disc >= 5 THEN 1::BIGINT ELSE 0::BIGINT END AS is_promo,
       CASE WHEN disc < 10 THEN 'D' || disc END AS promo_code,
       CASE pri WHEN '2-HIGH' THEN 'Mobile App' WHEN '3-MEDIUM' THEN 'API Partner' ELSE 'Web' END AS channel, 0::BIGINT AS lost_sales_qty
FROM step2_sales WHERE r2 IS NULL""")
