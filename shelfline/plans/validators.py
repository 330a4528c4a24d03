"""The rules of each table, and the validators that apply them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.parsing import day, flag, isbn13_ok, number, number_flag, whole_number
from shelfline.operators.rules import (
    POSITION, Checked, Fix, MissingDays, Reject, Stage, Unique, Warn, apply_rules, general_rules,
)
from shelfline.schemas import (
    BOOK_FORMATS, BOOK_GENRES, CHANNELS, DIGITAL_FORMATS, DIM_DATE, DIM_PRODUCT, FACT_INVENTORY,
    FACT_PLAN, FACT_SALES, FORMATS, GENRES, LOW_STOCK, PHYSICAL_FORMATS, PLAN_YEARS, PROJECT_START,
    SUBSCRIPTION,
)


def _prepared(raw: DataFrame, schema: T.StructType, text_flags: tuple[str, ...] = ()) -> DataFrame:
    """General rules, then ids as 64-bit integers and other numbers as doubles beside their text, and the
    day as a date. Ids never pass through a double, in which those above 2^53 would run together."""
    if POSITION not in raw.columns:
        raw = raw.withColumn(POSITION, F.monotonically_increasing_id())
    df = general_rules(raw, schema)
    parsed = {}
    for field in schema:
        if isinstance(field.dataType, T.NumericType) and field.name not in text_flags:
            parsed[f"_raw_{field.name}"] = F.col(field.name)
            value = whole_number if field.name.endswith("_id") else number
            parsed[field.name] = value(F.col(field.name))
        elif field.name == "date":
            parsed["date"] = day(F.col("date"))
    return df.withColumns(parsed)


# --- tests; each is true or false, never NULL ---

def _yes(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _unless(test: Column) -> Column:
    """True where `test` fails or cannot be told."""
    return ~F.coalesce(test, F.lit(False))


def _null(name: str) -> Column:
    return F.col(name).isNull()


def _not_positive(name: str) -> Column:
    return _unless(F.col(name) > 0)


def _negative(name: str) -> Column:
    return _unless(F.col(name) >= 0)


def _outside(name: str, low, high) -> Column:
    return _unless(F.col(name).between(low, high))


def _not_in(name: str, values: list[str]) -> Column:
    return _unless(F.col(name).isin(values))


def _far(value: Column, expected: Column, relative: float, absolute: float) -> Column:
    return _unless(F.abs(value - expected) <= absolute + relative * F.abs(expected))


def _defaults(names: list[str]) -> list[Fix]:
    """Columns the schema fills with 0 when they are absent."""
    return [Fix("X-02", f"{n} defaulted", _null(n), {n: F.coalesce(F.col(n), F.lit(0.0))}) for n in names]


def _required(names: list[str]) -> list[Reject]:
    return [Reject("X-01", f"{n} missing", _null(n)) for n in names]


def validate_dim_date(raw: DataFrame, stage: Stage | None = None) -> Checked:
    d = F.col("date")
    parts = {"year": F.year(d), "month": F.month(d), "quarter": F.quarter(d)}
    same = F.lit(True)
    for name, value in parts.items():
        same = same & _yes(F.col(name).cast("int") == value)
    weekend = (F.weekday(d) >= 5).cast("int")
    return apply_rules("dim_date", _prepared(raw, DIM_DATE), DIM_DATE, [
        Reject("D-01/D-02", "not a date", _null("date")),
        Unique("D-03", "repeated date", ["date"]),
        Fix("D-04", "date parts recomputed", ~same, parts),
        Fix("D-05", "weekend recomputed", _unless(number_flag(F.col("is_weekend")) == weekend), {"is_weekend": weekend}),
        Reject("D-06", "holiday flag not 0/1", _unless(F.col("is_holiday_ru").isin(0, 1))),
    ], stage)


def validate_dim_product(raw: DataFrame, stage: Stage | None = None) -> Checked:
    fmt = F.col("format")
    book = fmt != SUBSCRIPTION
    physical = fmt.isin(PHYSICAL_FORMATS)
    is_physical = physical.cast("int")
    digital_stock = fmt.isin(DIGITAL_FORMATS) & F.col("stock_initial").isNotNull()
    prepared = _prepared(raw, DIM_PRODUCT, text_flags=("is_physical",))
    everything_else = [f.name for f in DIM_PRODUCT if f.name != "product_id"]
    return apply_rules("dim_product", prepared, DIM_PRODUCT, [
        Reject("P-01", "id not positive", _not_positive("product_id")),
        Unique("P-01", "repeated id", ["product_id"]),
        Reject("P-02", "no title", _null("title")),
        Reject("P-05", "unknown format", _not_in("format", FORMATS)),
        Reject("P-06", "unknown genre", _not_in("genre", GENRES)),
        Reject("P-08", "price not positive", _not_positive("price_rub")),
        Reject("P-09", "cost not positive", _not_positive("cost_rub")),
        Reject("P-13", "rating outside 0..5", _outside("avg_rating", 0, 5)),
        Reject("P-14", "reviews negative", _negative("review_count")),
        Warn("P-03", "book without author", book & _null("author")),
        Warn("P-04", "book without publisher", book & _null("publisher")),
        Warn("P-07", "invalid ISBN", book & F.col("isbn").isNotNull() & ~isbn13_ok(F.col("isbn"))),
        Warn("P-10", "cost above price", _yes(F.col("cost_rub") > F.col("price_rub"))),
        Warn("P-11", "paper book without pages", physical & _null("page_count")),
        Fix("P-12", "stock of a digital format cleared", digital_stock,
            {"stock_initial": F.when(~fmt.isin(DIGITAL_FORMATS), F.col("stock_initial"))}),
        Fix("P-15", "physical flag recomputed", _unless(flag(F.col("is_physical")) == is_physical),
            {"is_physical": is_physical}),
        Unique("P-16", "copy under another id", everything_else),
    ], stage)


def validate_fact_plan(raw: DataFrame, years: tuple[int, int] = PLAN_YEARS, stage: Stage | None = None) -> Checked:
    qty, amount = F.col("plan_qty"), F.col("plan_amount")
    return apply_rules("fact_plan", _prepared(raw, FACT_PLAN), FACT_PLAN, [
        Unique("PL-01", "repeated id", ["plan_id"]),
        Reject("PL-02", "unknown genre", _not_in("genre", BOOK_GENRES)),
        Reject("PL-03", "unknown format", _not_in("format", BOOK_FORMATS)),
        Reject("PL-04", "year out of range", _outside("year", *years)),
        Reject("PL-05", "month outside 1..12", _outside("month", 1, 12)),
        Reject("PL-06", "quantity negative", _negative("plan_qty")),
        Reject("PL-07", "amount negative", _negative("plan_amount")),
        Reject("PL-09", "margin outside 0..1", _outside("plan_margin_target", 0, 1)),
        Warn("PL-08", "quantity and amount disagree", (qty == 0) != (amount == 0)),
        Unique("PL-10", "repeated genre, format and month", ["genre", "format", "year", "month"]),
        *_required(["plan_id"]),
    ], stage)


def _with_format(prepared: DataFrame, dim_product: DataFrame, stage: Stage | None) -> DataFrame:
    """Adds `_known_id` and `_format`, NULL for an unknown product. Broadcast only if it measures small.

    With a `stage` the products are written first as bits, 64 ids to a row and a word per format, at a fraction of
    their size, so that rows still meet a large dimension where they are read. Products that are described
    twice, or in other formats, are joined as they are.
    """
    known = dim_product.select(F.col("product_id").cast("bigint").alias("_known_id"), F.col("format").alias("_format"))
    words = _format_words(known, stage) if stage else None
    if words is None:
        return prepared.join(known, F.col("product_id") == F.col("_known_id"), "left")
    place = F.expr("cast(product_id & 63 as int)")
    fmt = F.coalesce(*[F.when(F.getbit(f"_bits{i}", place) == 1, name) for i, name in enumerate(FORMATS)])
    joined = prepared.join(words, F.shiftright("product_id", 6) == F.col("_word"), "left").withColumn("_format", fmt)
    return joined.withColumn("_known_id", F.when(F.col("_format").isNotNull(), F.col("product_id"))).drop(*words.columns)


def _format_words(known: DataFrame, stage: Stage) -> DataFrame | None:
    """The ids of each format as bits; None where this would lose a repeated id or a format that is not on the list."""
    bit = F.expr("shiftleft(1L, cast(_known_id & 63 as int))")
    words = stage(known.groupBy(F.shiftright("_known_id", 6).alias("_word")).agg(
        *[F.bit_or(F.when(F.col("_format") == name, bit)).alias(f"_bits{i}") for i, name in enumerate(FORMATS)],
        F.count("*").alias("_n")), "formats")
    every = F.lit(0).cast("bigint")
    for i in range(len(FORMATS)):
        every = every.bitwiseOR(F.coalesce(f"_bits{i}", F.lit(0).cast("bigint")))
    lossy = F.col("_word").isNull() | (F.bit_count(every) != F.col("_n"))
    return words.drop("_n") if words.where(lossy).isEmpty() else None


def validate_fact_sales(raw: DataFrame, dim_product: DataFrame, start: dt.date = PROJECT_START,
                        as_of: dt.date | None = None, days_from: dt.date | None = None,
                        stage: Stage | None = None) -> Checked:
    """`as_of` is the last acceptable day (today); `days_from` where the search for missing days begins."""
    qty, price, returned = F.col("sales_qty"), F.col("unit_price"), F.col("return_qty")
    discount, promo = F.col("discount_percent"), F.col("is_promo")
    digital = F.col("_format").isin(DIGITAL_FORMATS)
    return_amount = F.col("return_amount")
    prepared = _with_format(_prepared(raw, FACT_SALES), dim_product, stage)
    return apply_rules("fact_sales", prepared, FACT_SALES, [
        Unique("S-01", "repeated id", ["sales_id"]),
        Warn("S-02", "no order", _null("order_id")),
        Reject("S-04", "unknown product", _null("_known_id")),
        Reject("S-05", "not a date", _null("date")),
        Reject("S-06", "outside the project period", _outside("date", F.lit(start), F.lit(as_of or dt.date.today()))),
        Reject("S-08", "quantity not positive", _not_positive("sales_qty")),
        Reject("S-09", "price not positive", _not_positive("unit_price")),
        Reject("S-14", "discount outside 0..100", _outside("discount_percent", 0, 100)),
        Reject("S-17", "unknown channel", _not_in("channel", CHANNELS)),
        Unique("S-03", "repeated product in an order", ["order_id", "product_id"]),
        MissingDays("S-07", "days without sales", days_from or start),
        Warn("S-10", "amount off quantity x price", _far(F.col("sales_amount"), qty * price, 0.01, 1e-8)),
        Warn("S-11", "return of a digital format", digital & _yes(returned > 0)),
        Warn("S-12", "more returned than sold", _yes(returned > qty)),
        Warn("S-13", "return amount off quantity x price",
             _far(return_amount, returned * price, 0.01, 1e-8) | _yes((returned == 0) & (return_amount != 0))),
        Warn("S-15", "promotion without discount or code", _yes(promo == 1) & ((discount == 0) | _null("promo_code"))),
        Warn("S-16", "discount without promotion", _yes(promo == 0) & (discount > 0)),
        Warn("S-18", "lost sales of a digital format", digital & _yes(F.col("lost_sales_qty") > 0)),
        Warn("S-19", "lost sales negative", _yes(F.col("lost_sales_qty") < 0)),
        *_required(["sales_id", "sales_amount"]),
        *_defaults(["return_qty", "return_amount", "is_promo", "lost_sales_qty"]),
    ], stage)


def validate_fact_inventory(raw: DataFrame, dim_product: DataFrame, start: dt.date = PROJECT_START,
                            as_of: dt.date | None = None, stage: Stage | None = None) -> Checked:
    closing = F.col("closing_stock")
    balance = F.col("opening_stock") - F.col("sold_qty") + F.col("replenishment_qty")
    low = (closing < LOW_STOCK).cast("int")
    prepared = _with_format(_prepared(raw, FACT_INVENTORY), dim_product, stage)
    return apply_rules("fact_inventory", prepared, FACT_INVENTORY, [
        Reject("I-01", "unknown product", _null("_known_id")),
        Reject("I-02", "not a physical product", _not_in("_format", PHYSICAL_FORMATS)),
        Reject("I-03", "not a date", _null("date")),
        Reject("I-04", "outside the project period", _outside("date", F.lit(start), F.lit(as_of or dt.date.today()))),
        Reject("I-06", "opening stock negative", _negative("opening_stock")),
        Reject("I-07", "sold quantity negative", _negative("sold_qty")),
        Reject("I-08", "replenishment negative", _negative("replenishment_qty")),
        Reject("I-09", "closing stock negative", _negative("closing_stock")),
        Unique("I-05", "repeated product and day", ["product_id", "date"]),
        Warn("I-10", "stock does not balance", _far(closing, balance, 1e-5, 1.0)),
        Fix("I-11", "low-stock flag recomputed", _unless(number_flag(F.col("is_low_stock")) == low), {"is_low_stock": low}),
        *_required(["inventory_id"]),
    ], stage)


def missing_sales_days(sales: DataFrame, start: dt.date) -> DataFrame:
    """The days behind S-07: from `start` to the last sale, those without one."""
    sold = sales.select("date").distinct()
    last = sold.agg(F.max("date")).scalar()
    days = sold.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start), F.greatest(last, F.lit(start)))).alias("date"))
    return days.join(sold, "date", "left_anti").where(F.col("date") <= last)


def quality_summary(checked: list[Checked]) -> DataFrame:
    return _stacked([c.summary() for c in checked])


def quality_details(checked: list[Checked]) -> DataFrame:
    return _stacked([c.details() for c in checked])


def total_issues(checked: list[Checked]) -> DataFrame:
    """Rejected rows plus warnings over all tables."""
    return quality_summary(checked).agg(F.sum(F.col("rows_rejected") + F.col("warnings")).alias("issues"))


def _stacked(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
