"""Table schemas, closed vocabularies and thresholds.

Identifiers are 64-bit: at the target volume a 32-bit line id would overflow.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# --- fixed values: vocabularies, thresholds and lookups that results depend on ---
BOOK_GENRES = [
    "Fiction", "Fantasy", "Mystery", "Romance", "Science",
    "Biography", "Business", "Children", "History", "Poetry",
]
SUBSCRIPTION = "Subscription"
GENRES = BOOK_GENRES + [SUBSCRIPTION]
BOOK_FORMATS = ["eBook", "Paperback", "Hardcover", "Audiobook"]
FORMATS = BOOK_FORMATS + [SUBSCRIPTION]
PHYSICAL_FORMATS = ["Paperback", "Hardcover"]
DIGITAL_FORMATS = ["eBook", "Audiobook", SUBSCRIPTION]
CHANNELS = ["Web", "Mobile App", "API Partner"]
LANGUAGES = ["Russian", "English", "Other"]
LOW_STOCK = 15
URGENT_STOCK = 5
COVER_DAYS = 45
SALES_WINDOW_DAYS = 30
PROJECT_START = dt.date(2024, 1, 1)
PLAN_YEARS = (2024, 2026)
ALERT_LEVELS = ["critical", "urgent", "warning"]
# cost as a percentage of the price, by format
COST_PERCENT = {"eBook": 20, "Paperback": 60, "Hardcover": 55, "Audiobook": 35, "Subscription": 15}
# fixed-date holidays as (month, day)
HOLIDAYS = [(1, d) for d in range(1, 9)] + [(2, 23), (3, 8), (5, 1), (5, 9)]
# text tokens a CSV reader takes for a missing value
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# --- end of fixed values ---

# The column facts are partitioned by on disk: first day of the row's month.
PARTITION = "part_month"

_long, _int, _short = T.LongType(), T.IntegerType(), T.ShortType()
_text, _date = T.StringType(), T.DateType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DIM_DATE = _struct(
    date=_date, year=_short, month=_short, quarter=_short, is_weekend=_short, is_holiday_ru=_short,
)
DIM_PRODUCT = _struct(
    product_id=_long, isbn=_text, title=_text, author=_text, publisher=_text,
    published_date=_date, language=_text, page_count=_short, genre=_text, format=_text,
    price_rub=T.DecimalType(10, 2), cost_rub=T.DecimalType(10, 2), avg_rating=T.DecimalType(3, 1),
    review_count=_int, stock_initial=_int, is_physical=_short,
)
FACT_PLAN = _struct(
    plan_id=_long, genre=_text, format=_text, year=_short, month=_short, plan_qty=_long,
    plan_amount=T.DecimalType(14, 2), plan_margin_target=T.DecimalType(6, 4),
)
FACT_SALES = _struct(
    sales_id=_long, order_id=_long, product_id=_long, date=_date, sales_qty=_int, return_qty=_int,
    unit_price=T.DecimalType(10, 2), sales_amount=T.DecimalType(14, 2),
    return_amount=T.DecimalType(14, 2), discount_percent=_short, is_promo=_short,
    promo_code=_text, channel=_text, lost_sales_qty=_int,
)
FACT_INVENTORY = _struct(
    inventory_id=_long, product_id=_long, date=_date, opening_stock=_int, sold_qty=_int,
    replenishment_qty=_int, closing_stock=_int, is_low_stock=_short,
)

TABLES = {
    "dim_date": DIM_DATE,
    "dim_product": DIM_PRODUCT,
    "fact_plan": FACT_PLAN,
    "fact_sales": FACT_SALES,
    "fact_inventory": FACT_INVENTORY,
}
FACTS = ("fact_sales", "fact_inventory")

# Primary and unique keys, in the order an insert checks them.
KEYS = {
    "dim_date": [["date"]],
    "dim_product": [["product_id"]],
    "fact_plan": [["plan_id"], ["genre", "format", "year", "month"]],
    "fact_sales": [["sales_id"]],
    "fact_inventory": [["inventory_id"], ["product_id", "date"]],
}

# Product attributes stored on every sales line at load time, so that marts need no product join.
LINE_ATTRIBUTES = [
    "title", "publisher", "language", "genre", "format", "price_rub", "cost_rub", "avg_rating",
]
