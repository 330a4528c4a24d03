"""The star schema as SQL text over the driver tables, for checking on a second engine.

Money is kept in whole cents (column names end in _c) and turned into a DOUBLE at the very end.
"""

PHYSICAL = "('Paperback', 'Hardcover')"
BOOKS = "('eBook', 'Paperback', 'Hardcover', 'Audiobook')"

# Each entry: name -> (tables it needs, text)
_PARTS = {
    "product": ([], """
  SELECT *, (2 * price_c * pct + 100) // 200 AS cost_c,
         CASE WHEN format IN ('Paperback', 'Hardcover') THEN 1 ELSE 0 END AS is_physical
  FROM (
    SELECT p_partkey AS product_id, p_name AS title, p_size, p_brand,
           CAST(round(p_retailprice * 100) AS BIGINT) AS price_c,
           CASE p_type WHEN 'ECONOMY' THEN 'eBook' WHEN 'SMALL' THEN 'Audiobook'
                       WHEN 'LARGE' THEN 'Hardcover' WHEN 'PROMO' THEN 'Subscription'
                       ELSE 'Paperback' END AS format,
           CASE p_type WHEN 'ECONOMY' THEN 20 WHEN 'SMALL' THEN 35 WHEN 'LARGE' THEN 55
                       WHEN 'PROMO' THEN 15 ELSE 60 END AS pct,
           CASE WHEN p_type = 'PROMO' THEN 'Subscription' ELSE list_extract(
             ['Fiction','Fantasy','Mystery','Romance','Science','Biography','Business','Children','History','Poetry'],
             p_size % 10 + 1) END AS genre,
           CASE WHEN p_type <> 'PROMO' THEN p_brand END AS publisher,
           CASE WHEN p_type <> 'PROMO' THEN 'Author ' || p_size END AS author,
           CASE WHEN p_size % 7 <> 0 THEN list_extract(['Russian','English','Other'], p_size % 3 + 1) END AS language,
           p_size % 50 AS rating_t, p_partkey % 500 AS review_count,
           CASE WHEN p_type IN ('MEDIUM', 'STANDARD', 'LARGE') THEN 20 + p_partkey % 60 END AS stock_initial
    FROM part)"""),
    "span": ([], """
  SELECT CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem"""),
    "ordered": ([], """
  SELECT *, CASE WHEN returned THEN qty ELSE 0 END AS ret, CASE WHEN returned THEN amt_c ELSE 0 END AS ramt_c,
         (2 * amt_c + qty) // (2 * qty) AS unit_c
  FROM (
    SELECT l_orderkey * 10 + l_linenumber AS sales_id, l_orderkey AS order_id, l_partkey AS product_id,
           CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS BIGINT) AS qty,
           CAST(round(l_discount * 100) AS BIGINT) AS disc, l_returnflag = 'R' AS returned,
           (CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 50) // 100 AS amt_c,
           o_orderpriority AS channel
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey)"""),
    "supply": (["product", "span"], """
  SELECT product_id, CAST(unnest(generate_series(
           first_day + CAST(59 + product_id % 61 AS INTEGER), last_day,
           to_days(CAST(60 + product_id % 61 AS INTEGER)))) AS DATE) AS date,
         10 + product_id % 31 AS repl
  FROM product, span WHERE is_physical = 1"""),
    "book1": (["ordered", "supply"], """
  {ledger:ordered}"""),
    "sales": (["book1"], """
  SELECT sales_id, order_id, product_id, date, disc, channel, unit_c,
         CASE WHEN disc > 0 THEN 1 ELSE 0 END AS promo,
         new_qty AS qty, least(ret, new_qty) AS ret,
         CASE WHEN served IS NULL THEN amt_c ELSE new_qty * unit_c END AS amt_c,
         CASE WHEN ret > new_qty THEN new_qty * unit_c ELSE ramt_c END AS ramt_c,
         qty - new_qty AS lost
  FROM (
    SELECT o.*, served, CASE WHEN served IS NULL THEN qty
           ELSE greatest(0, CAST(round_even(qty * served, 0) AS BIGINT)) END AS new_qty
    FROM ordered o LEFT JOIN (
      SELECT product_id, date, CAST(gross - shortage AS DOUBLE) / CAST(gross AS DOUBLE) AS served
      FROM book1 WHERE shortage > 0) USING (product_id, date))"""),
    "lines": (["sales", "product"], """
  SELECT s.*, p.title, p.genre, p.format, p.publisher, p.language, p.price_c, p.cost_c, p.rating_t,
         s.amt_c - s.ramt_c AS net_c, s.qty - s.ret AS net_q,
         s.amt_c - s.ramt_c - (s.qty - s.ret) * p.cost_c AS profit_c,
         CAST(year(s.date) AS BIGINT) AS year, CAST(month(s.date) AS BIGINT) AS month,
         CAST(quarter(s.date) AS BIGINT) AS quarter, CAST(date_trunc('month', s.date) AS DATE) AS month_start
  FROM sales s JOIN product p USING (product_id)"""),
    "anchor": (["span"], """
  SELECT last_day AS today, last_day - 1 AS yesterday, CAST(date_trunc('month', last_day) AS DATE) AS m0,
         CAST(date_trunc('month', last_day) - INTERVAL 1 MONTH AS DATE) AS p0,
         CAST(last_day - INTERVAL 1 MONTH AS DATE) AS p1,
         CAST(day(last_day) AS BIGINT) AS passed, CAST(day(last_day(last_day)) AS BIGINT) AS days
  FROM span"""),
    "actual": (["lines"], f"""
  SELECT year, month, genre, format, CAST(sum(net_q) AS BIGINT) AS fq, CAST(sum(net_c) AS BIGINT) AS fc
  FROM lines WHERE format IN {BOOKS} GROUP BY ALL"""),
    "grid": (["actual", "span"], """
  SELECT g.*, coalesce(a.fq, 0) AS fq, coalesce(a.fc, 0) AS fc
  FROM (
    SELECT CAST(year(m) AS BIGINT) AS year, CAST(month(m) AS BIGINT) AS month, genre, gi, format, fi
    FROM (SELECT unnest(generate_series(date_trunc('year', first_day), last_day, INTERVAL 1 MONTH)) AS m FROM span),
         (VALUES ('Fiction',0),('Fantasy',1),('Mystery',2),('Romance',3),('Science',4),('Biography',5),
                 ('Business',6),('Children',7),('History',8),('Poetry',9)) AS gs(genre, gi),
         (VALUES ('eBook',1),('Paperback',2),('Hardcover',3),('Audiobook',4)) AS fs(format, fi)) g
  LEFT JOIN actual a USING (year, month, genre, format)"""),
    "plan": (["grid"], """
  SELECT CAST((year - y0) * 480 + (month - 1) * 40 + gi * 4 + fi AS BIGINT) AS plan_id, genre, format, year, month,
         CASE WHEN year = y0 THEN greatest(0, fq)
              WHEN lq > 0 THEN greatest(0, CAST(round_even(lq * 1.05::DOUBLE, 0) AS BIGINT)) ELSE 0 END AS plan_q,
         CASE WHEN year = y0 THEN greatest(0, fc)
              WHEN lq > 0 THEN greatest(0, (2 * lc * 105 + 100) // 200) ELSE 0 END AS plan_c,
         CASE format WHEN 'eBook' THEN 0.815 WHEN 'Paperback' THEN 0.415 WHEN 'Hardcover' THEN 0.465
                     ELSE 0.665 END::DOUBLE AS target
  FROM (SELECT *, min(year) OVER () AS y0, lag(fq) OVER w AS lq, lag(fc) OVER w AS lc
        FROM grid WINDOW w AS (PARTITION BY month, genre, format ORDER BY year))"""),
    "book2": (["sales", "supply"], """
  {ledger:sales}"""),
    "inventory": (["book2", "span"], """
  SELECT product_id * ((SELECT last_day - first_day FROM span) + 1) + (d - (SELECT first_day FROM span)) + 1 AS inventory_id,
         product_id, d AS date,
         CASE WHEN d = date THEN opening ELSE closing END AS opening,
         CASE WHEN d = date THEN greatest(0, net) ELSE 0 END AS sold,
         CASE WHEN d = date THEN repl ELSE 0 END AS repl, closing,
         CASE WHEN closing < 15 THEN 1 ELSE 0 END AS low
  FROM (
    SELECT *, CAST(unnest(generate_series(date, upto, INTERVAL 1 DAY)) AS DATE) AS d
    FROM (SELECT *, coalesce(lead(date) OVER (PARTITION BY product_id ORDER BY date) - 1,
                             (SELECT last_day FROM span)) AS upto FROM book2))"""),
}

_LEDGER = """
  SELECT product_id, date, gross, net, repl, CAST(level + owed0 - repl + net AS BIGINT) AS opening,
         CAST(level + owed AS BIGINT) AS closing, CAST(owed - owed0 AS BIGINT) AS shortage
  FROM (
    SELECT *, -least(0, min(level) OVER u) AS owed,
           -least(0, coalesce(min(level) OVER (PARTITION BY product_id ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS owed0
    FROM (
      SELECT *, sum(start + repl - net) OVER (PARTITION BY product_id ORDER BY date
                ROWS UNBOUNDED PRECEDING) AS level
      FROM (
        SELECT product_id, date, sum(gross) AS gross, sum(net) AS net, sum(repl) AS repl, sum(start) AS start
        FROM (
          SELECT product_id, date, qty AS gross, qty - ret AS net, 0 AS repl, 0 AS start
          FROM {source} WHERE product_id IN (SELECT product_id FROM product WHERE is_physical = 1)
          UNION ALL SELECT product_id, date, 0, 0, repl, 0 FROM supply
          UNION ALL SELECT product_id, (SELECT first_day FROM span), 0, 0, 0, stock_initial
          FROM product WHERE is_physical = 1)
        GROUP BY product_id, date))
    WINDOW u AS (PARTITION BY product_id ORDER BY date ROWS UNBOUNDED PRECEDING))"""


def with_tables(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """`body` behind the CTEs it needs, in order of need."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        needs, text = _PARTS[name]
        for need in needs:
            add(need)
        for source in ("ordered", "sales"):
            text = text.replace("{ledger:%s}" % source, _LEDGER.replace("{source}", source))
        done[name] = text

    for name in names:
        add(name)
    done.update(extra or {})
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({t}\n)" for n, t in done.items())
    return f"WITH {ctes}\n{body}"


def money(expr: str, alias: str) -> str:
    return f"CAST({expr} AS BIGINT) / 100.0::DOUBLE AS {alias}"


def whole(expr: str, alias: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias}"


def quotient(num: str, den: str, places: int) -> str:
    """num / den for whole numbers, rounded half away from zero at `places`, exactly; NULL if den is 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    scaled = f"(2 * abs({n}) * {10 ** places} + abs({d})) // nullif(2 * abs({d}), 0)"
    return f"(sign({n}) * sign({d}) * ({scaled}))::DOUBLE / {10 ** places}::DOUBLE"


def guarded(num: str, den: str, places: int, alias: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {quotient(num, den, places)} ELSE 0 END AS {alias}"
