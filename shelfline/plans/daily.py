"""Daily and month-to-date marts. All are lazy: they follow the report day of the Star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import days_in_month, month_before, month_start
from shelfline.functions.measures import average_order, exact, margin, measures, ratio
from shelfline.operators.ordered import top_ranked
from shelfline.schemas import BOOK_FORMATS
from shelfline.star import Star

SALES_MEASURES = [
    "orders", "net_qty", "net_revenue", "gross_profit", "return_qty", "return_amount",
    "promo_orders", "promo_revenue", "lost_sales_qty",
]


def dates(star: Star) -> DataFrame:
    """Report day and the day before."""
    return star.spark.range(1).select(
        F.lit(star.today).alias("today"), F.lit(star.yesterday).alias("yesterday"))


def two_days(star: Star, *attributes: str) -> DataFrame:
    """Lines of the report day and the day before, labelled."""
    return star.few_lines(star.yesterday, star.today, *attributes).withColumn("day_type", _day_type(star))


def _day_type(star: Star) -> Column:
    return F.when(F.col("date") == F.lit(star.today), "today").otherwise("yesterday")


def daily_sales(star: Star) -> DataFrame:
    """Both days by genre and format."""
    lines = two_days(star, "genre", "format", "cost_rub")
    return lines.groupBy("date", "day_type", "genre", "format").agg(*measures(*SALES_MEASURES))


def daily_channels(star: Star) -> DataFrame:
    """Both days by channel."""
    names = ["orders", "net_qty", "net_revenue", "gross_profit", "promo_orders", "promo_revenue"]
    return two_days(star, "channel", "cost_rub").groupBy("date", "day_type", "channel").agg(*measures(*names))


_MTD = ["revenue", "orders", "net_qty", "gross_profit", "return_qty", "return_amount"]
_MTD_ONLY = ["promo_orders", "promo_revenue", "lost_sales_qty"]


def _month_lines(star: Star, previous: bool) -> DataFrame:
    last = month_before(star.today) if previous else star.today
    return star.few_lines(month_start(last), last, "cost_rub")


def _mtd(star: Star, previous: bool) -> DataFrame:
    prefix = "prev_mtd_" if previous else "mtd_"
    names = _MTD if previous else _MTD + _MTD_ONLY
    named = {prefix + n: "net_revenue" if n == "revenue" else n for n in names}
    return _month_lines(star, previous).agg(*measures(**named))


def mtd_current(star: Star) -> DataFrame:
    """The month up to the report day, one row."""
    return _mtd(star, previous=False)


def mtd_previous(star: Star) -> DataFrame:
    """The previous month up to the same day, moved back to the month's end where that is earlier."""
    return _mtd(star, previous=True)


def mart_daily_pulse(star: Star, exact_orders: bool = False) -> DataFrame:
    """KPIs of the report day and the day before.

    An order that spans genres or formats counts once per group, as the breakdown shows it;
    `exact_orders` counts it once.
    """
    if exact_orders:
        days = two_days(star, "cost_rub").groupBy("date", "day_type").agg(*measures(*SALES_MEASURES))
        summed = days.withColumnsRenamed({
            "net_revenue": "total_revenue", "orders": "total_orders", "gross_profit": "total_gross_profit"})
    else:
        carried = ["return_qty", "return_amount", "promo_orders", "promo_revenue", "lost_sales_qty"]
        total = {"total_revenue": "net_revenue", "total_orders": "orders", "total_gross_profit": "gross_profit",
                 **{n: n for n in carried}}
        summed = daily_sales(star).groupBy("date", "day_type").agg(*[
            _total(column).alias(name) for name, column in total.items()])
    return summed.select(
        "day_type", F.col("date").alias("report_date"), F.date_sub("date", 1).alias("prev_date"),
        "total_revenue", "total_orders",
        average_order("total_revenue", "total_orders").alias("avg_order_value"),
        "total_gross_profit", margin("total_gross_profit", "total_revenue").alias("gross_margin"),
        "return_qty", "return_amount", "promo_orders", "promo_revenue", "lost_sales_qty",
    )


def _total(column: str) -> Column:
    money = column in ("net_revenue", "gross_profit", "return_amount", "promo_revenue")
    return F.sum(column).cast("decimal(20,2)") if money else F.sum(column)


def mart_daily_channels(star: Star) -> DataFrame:
    return daily_channels(star).select(
        "day_type", F.col("date").alias("report_date"), "channel", "orders", "net_qty", "net_revenue",
        "gross_profit", margin().alias("gross_margin"), "promo_orders", "promo_revenue")


def mart_mtd_pulse(star: Star) -> DataFrame:
    """Month to date beside the same days of the previous month, one row.

    The two periods do not overlap, so one scan labels each line with its period, one aggregation
    serves both and a pivot over the two labels lays them side by side.
    """
    now = _month_lines(star, previous=False).withColumn("period", F.lit("mtd"))
    then = _month_lines(star, previous=True).withColumn("period", F.lit("prev_mtd"))
    named = {n: "net_revenue" if n == "revenue" else n for n in _MTD + _MTD_ONLY}
    sums = now.unionByName(then).groupBy("period").agg(*measures(**named))

    def of(period: str, name: str) -> Column:
        picked = F.max(F.when(F.col("period") == period, F.col(name)))
        return F.coalesce(picked, F.lit(0)) if name == "orders" else picked

    wide = sums.agg(
        *[of("mtd", n).alias(f"mtd_{n}") for n in _MTD + _MTD_ONLY],
        *[of("prev_mtd", n).alias(f"prev_mtd_{n}") for n in _MTD])
    rates = []
    for p in ("mtd", "prev_mtd"):
        rates += [
            margin(f"{p}_gross_profit", f"{p}_revenue").alias(f"{p}_gross_margin"),
            average_order(f"{p}_revenue", f"{p}_orders").alias(f"{p}_avg_order_value")]
    return wide.select(
        F.lit(month_start(star.today)).alias("month_start"), F.lit(star.today).alias("month_to_date"),
        "*", *rates)


def mart_daily_revenue_mtd(star: Star) -> DataFrame:
    """Each day of the current month beside the daily share of the month's plan."""
    today = star.today
    plan = star.plan.where(
        (F.col("year") == today.year) & (F.col("month") == today.month)
        & F.col("format").isin(BOOK_FORMATS)).agg(F.sum("plan_amount").cast("decimal(20,2)"))
    names = ["net_revenue", "gross_profit", "orders", "return_qty", "return_amount"]
    days = _month_lines(star, previous=False).groupBy("date").agg(*measures(*names))
    target = ratio(plan.scalar(), exact(F.lit(days_in_month(today))), 2)
    return days.withColumn("daily_plan_target", target)


def mart_daily_top5(star: Star, n: int = 5) -> DataFrame:
    """Products of the report day ranked by net revenue; ties may give more than n rows."""
    lines = star.few_lines(star.today, star.today, "title", "format", "genre")
    sold = lines.groupBy("product_id", "title", "format", "genre").agg(
        *measures("net_qty", revenue="net_revenue"))
    return top_ranked(sold, "revenue", n).select(
        "product_id", "title", "format", "genre", "revenue", "net_qty", "rnk")
