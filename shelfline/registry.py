"""Every query by name: a function of a Star."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dates import in_days
from shelfline.load_queries import LOADING
from shelfline.operators import ledger
from shelfline.operators.rules import Checked
from shelfline.plans import adhoc, alerts, charts, checks, daily, loading, plan_fact, planning, sales, stock, validators
from shelfline.schemas import PARTITION
from shelfline.sources import driver_extracts, driver_faults, driver_star
from shelfline.sources.files import written
from shelfline.star import Star

MARTS: dict[str, Callable[[Star], DataFrame]] = {
    "mart_daily_pulse": daily.mart_daily_pulse,
    "mart_daily_channels": daily.mart_daily_channels,
    "mart_mtd_pulse": daily.mart_mtd_pulse,
    "mart_daily_revenue_mtd": daily.mart_daily_revenue_mtd,
    "mart_daily_top5": daily.mart_daily_top5,
    "mart_plan_fact": plan_fact.mart_plan_fact,
    "mart_daily_breakdown": plan_fact.mart_daily_breakdown,
    "mart_daily_format_pulse": plan_fact.mart_daily_format_pulse,
    "mart_plan_fact_history": plan_fact.mart_plan_fact_history,
    "mart_inventory_alerts": stock.mart_inventory_alerts,
    "mart_sales_trends": sales.mart_sales_trends,
    "mart_abc": sales.mart_abc,
    "mart_margin": sales.mart_margin,
    "mart_margin_by_format": sales.mart_margin_by_format,
    "mart_margin_by_publisher": sales.mart_margin_by_publisher,
    "mart_subscriptions": sales.mart_subscriptions,
    "mart_subscriptions_monthly": sales.mart_subscriptions_monthly,
}

VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "dates": daily.dates,
    "daily_sales": daily.daily_sales,
    "daily_channels": daily.daily_channels,
    "mtd_current": daily.mtd_current,
    "mtd_previous": daily.mtd_previous,
    "month_progress": plan_fact.month_progress,
    "plan_to_date": plan_fact.plan_to_date,
    "latest_stock": stock.latest_stock,
    "avg_daily_sales_30d": stock.avg_daily_sales_30d,
    "mart_daily_pulse_exact_orders": lambda s: daily.mart_daily_pulse(s, exact_orders=True),
}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and all integers as 64-bit, so that results compare across engines."""
    def cast(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(field.name)
        return column
    return df.select(*[cast(f) for f in df.schema])


# --- parameters of the registered queries, repeated in the checking SQL ---
PERIOD = (dt.date(1998, 1, 1), dt.date(1999, 6, 30))
PROMO_FROM = dt.date(2000, 1, 1)
PRODUCT_ID = 40
WEAK_MARGIN = 0.75
# --- end of parameters ---

ADHOC: dict[str, Callable[[Star], DataFrame]] = {
    "last_dates": adhoc.last_dates,
    "row_counts": adhoc.row_counts,
    "channel_daily_30d": adhoc.channel_daily_30d,
    "genre_margin_period": lambda s: adhoc.genre_margin_period(s, *PERIOD),
    "top_products_abc": adhoc.top_products_abc,
    "promo_effectiveness": lambda s: adhoc.promo_effectiveness(s, PROMO_FROM),
    "lost_sales_top": adhoc.lost_sales_top,
    "stock_history": lambda s: adhoc.stock_history(s, PRODUCT_ID),
    "zero_stock_now": adhoc.zero_stock_now,
    "replenishment_frequency": adhoc.replenishment_frequency,
    "plan_closed_summary": adhoc.plan_closed_summary,
    "missed_plan_genres": adhoc.missed_plan_genres,
    "format_margin_yoy": adhoc.format_margin_yoy,
    "weak_margin_publishers": lambda s: adhoc.weak_margin_publishers(s, WEAK_MARGIN),
    "subscription_churn": adhoc.subscription_churn,
    "basket_size": adhoc.basket_size,
}

CHARTS: dict[str, Callable[[Star], DataFrame]] = {
    f.__name__: f for f in (
        charts.kpi_day_delta, charts.kpi_mtd_delta, charts.plan_kpi_total, charts.plan_by_genre,
        charts.plan_by_format, charts.plan_pct_monthly, charts.plan_heatmap, charts.revenue_by_month,
        charts.revenue_by_format, charts.revenue_by_genre, charts.return_share_monthly,
        charts.promo_vs_organic, charts.lost_sales_monthly, charts.margin_scatter,
        charts.top_publishers, charts.genre_margin_heatmap, charts.alerts_by_level,
        charts.stockout_histogram, charts.reorder_value, charts.low_stock_widget, charts.reorder_list,
        charts.abc_summary, charts.abc_margin_box, charts.abc_table_with_history,
        charts.subscription_counts, charts.subscription_revenue, charts.subscription_card,
        charts.subscription_promo_share)
} | {"stock_vs_threshold": lambda s: charts.stock_vs_threshold(s, PRODUCT_ID)}


# --- example recipients, repeated in the checking SQL ---
RECIPIENTS = [
    ("floor@shop.example", "Shop floor", ["warning"]),
    ("orders@shop.example", "Ordering", ["critical", "urgent", "warning"]),
    ("duty@shop.example", "On duty", ["critical"]),
]
# --- end of example recipients ---


def _people(star: Star) -> DataFrame:
    return alerts.recipients(star, RECIPIENTS)


def _routed(star: Star) -> DataFrame:
    return alerts.alerts_for_recipients(alerts.all_alerts(star), _people(star))


def _alert_run(star: Star) -> DataFrame:
    path = f"{star.work}/alert-log-{uuid.uuid4().hex[:8]}"
    return alerts.alert_run(alerts.all_alerts(star), _people(star), star.today, path, "urgent")


ALERTS: dict[str, Callable[[Star], DataFrame]] = {
    "alerts_ranked": alerts.alerts_ranked,
    "alerts_for_recipients": _routed,
    "alert_gate": lambda s: alerts.alert_gate(alerts.all_alerts(s), "urgent"),
    "alert_subject": lambda s: alerts.alert_subject(alerts.all_alerts(s), s.today),
    "alert_log": lambda s: alerts.alert_log(_routed(s), s.today),
    "alert_run": _alert_run,
}

CHECKS: dict[str, Callable[[Star], DataFrame]] = {
    f.__name__: f for f in (
        checks.orphan_products, checks.negative_stock, checks.digital_in_inventory,
        checks.dates_within_calendar, checks.missing_plan_combos, checks.returns_exceed_sales,
        checks.digital_returns, checks.amount_mismatch, checks.declared_constraints)
}


def _dense_net_sold(star: Star) -> DataFrame:
    first = star.calendar.agg(F.min("date")).first()[0]
    daily_rows = ledger.dense_daily_net_sold(star.lines("format"), first, star.today)
    return daily_rows.groupBy("product_id").agg(F.count("*").alias("days"), F.sum("net_sold").alias("net_sold"))


# --- first day of the ledger that goes on from a state, repeated in the checking SQL ---
RESUMED_FROM = dt.date(2001, 7, 1)
# --- end of parameter ---


def _resumed(star: Star) -> tuple[DataFrame, DataFrame]:
    """The ledger up to a day, and the one that goes on from its state and reads later sales only."""
    stock = star.product.where(F.col("is_physical") == 1).select("product_id", "stock_initial")
    first, last = star.calendar.agg(F.min("date"), F.max("date")).first()
    restock = driver_star.replenishments(star.product, first, last)
    until = RESUMED_FROM - dt.timedelta(days=1)
    sold = lambda a, b: ledger.daily_net_sold(in_days(star.lines("format"), a, b))
    early = ledger.stock_ledger(ledger.movements(sold(None, until), stock, in_days(restock, None, until), first))
    state = written(ledger.ledger_state(early), f"{star.work}/ledger-state-{uuid.uuid4().hex[:8]}")
    moves = ledger.later_movements(sold(RESUMED_FROM, None), stock, in_days(restock, RESUMED_FROM, None), state, RESUMED_FROM)
    return early, ledger.stock_ledger(moves, state)


def resumed_ledger(star: Star) -> DataFrame:
    early, later = _resumed(star)
    moved = F.greatest(F.col("gross_sold"), F.abs("net_sold"), "replenishment_qty") > 0
    return early.unionByName(later.where(moved))


def resumed_inventory(star: Star) -> DataFrame:
    first, last = star.calendar.agg(F.min("date"), F.max("date")).first()
    return ledger.daily_inventory(_resumed(star)[1], first, last, RESUMED_FROM).drop(PARTITION)


def _allocated(star: Star) -> DataFrame:
    return star.sales.select(
        "order_id", "product_id", "date", "sales_qty", "return_qty", "unit_price", "sales_amount",
        "return_amount", "discount_percent", "lost_sales_qty")


STOCK_AND_PLAN: dict[str, Callable[[Star], DataFrame]] = {
    "build_calendar": lambda s: s.calendar,
    "plan_grid": planning.plan_grid,
    "plan_from_history": lambda s: s.plan,
    "daily_net_sold": lambda s: ledger.daily_net_sold(s.lines("format")),
    "dense_daily_net_sold": _dense_net_sold,
    "stock_ledger": lambda s: s["stock_ledger"],
    "resumed_ledger": resumed_ledger,
    "resumed_inventory": resumed_inventory,
    "shortage_allocation": _allocated,
}


_VALIDATORS: dict[str, Callable[..., Checked]] = {
    "dim_date": lambda s, **k: validators.validate_dim_date(s["raw_dim_date"], **k),
    "dim_product": lambda s, **k: validators.validate_dim_product(s["raw_dim_product"], **k),
    "fact_plan": lambda s, **k: validators.validate_fact_plan(s["raw_fact_plan"], driver_extracts.PLAN_YEARS, **k),
    "fact_sales": lambda s, **k: validators.validate_fact_sales(
        s["raw_fact_sales"], _checked(s, "dim_product").clean, driver_extracts.START, driver_extracts.AS_OF, **k),
    "fact_inventory": lambda s, **k: validators.validate_fact_inventory(
        s["raw_fact_inventory"], _checked(s, "dim_product").clean, driver_extracts.START, driver_extracts.AS_OF, **k),
}


def _checked(star: Star, table: str) -> Checked:
    """Flagged rows of a raw extract, written once per application."""
    if table not in star.memo:
        stage = loading.staged(f"{star.work}/stage_{table}")
        star.memo[table] = loading.settle(_VALIDATORS[table](star, stage=stage), f"{star.work}/checked_{table}")
    return star.memo[table]


def _all_checked(star: Star) -> list[Checked]:
    return [_checked(star, table) for table in _VALIDATORS]


QUALITY: dict[str, Callable[[Star], DataFrame]] = {
    **{f"dq_{table}": (lambda s, table=table: _checked(s, table).details()) for table in _VALIDATORS},
    "dq_summary": lambda s: validators.quality_summary(_all_checked(s)),
    "dq_details": lambda s: validators.quality_details(_all_checked(s)),
    "dq_total_issues": lambda s: validators.total_issues(_all_checked(s)),
    "missing_sales_days": lambda s: validators.missing_sales_days(_checked(s, "fact_sales").clean, driver_extracts.START),
    "clean_dim_date": lambda s: _checked(s, "dim_date").clean,
    "clean_dim_product": lambda s: _checked(s, "dim_product").clean,
    "clean_fact_plan": lambda s: _checked(s, "fact_plan").clean,
    "clean_fact_sales": lambda s: _checked(s, "fact_sales").clean,
}

def _faults(name: str, build: Callable[[Star, Callable], Checked]) -> Callable[[Star], DataFrame]:
    """Counters of an extract with planted faults."""
    def query(star: Star) -> DataFrame:
        folder = f"{star.work}/{name}-{uuid.uuid4().hex[:8]}"
        return loading.settle(build(star, folder), f"{folder}/checked").details()
    return query


FAULTS: dict[str, Callable[[Star], DataFrame]] = {name: _faults(name, build) for name, build in {
    "faults_dim_product": lambda s, f: validators.validate_dim_product(
        driver_faults.dim_product(s["part"]), loading.staged(f)),
    "faults_fact_plan": lambda s, f: validators.validate_fact_plan(
        driver_faults.fact_plan(s.plan), driver_faults.YEARS, loading.staged(f)),
    "faults_in_files": lambda s, f: validators.validate_fact_plan(
        driver_faults.plan_as_files(s.plan, f"{f}/files"), driver_faults.YEARS, loading.staged(f)),
    "faults_fact_sales": lambda s, f: validators.validate_fact_sales(
        driver_faults.fact_sales(s["orders"]), driver_faults.products_of_two_kinds(s["part"]), driver_faults.FIRST_DAY,
        driver_faults.LAST_DAY, stage=loading.staged(f)),
    "faults_fact_inventory": lambda s, f: validators.validate_fact_inventory(
        driver_faults.fact_inventory(s["orders"]), driver_faults.products_of_two_kinds(s["part"]), driver_faults.FIRST_DAY,
        driver_faults.LAST_DAY, loading.staged(f)),
}.items()}

# --- report day of the registered queries on a past day, repeated in the checking SQL ---
PAST_DAY = dt.date(2000, 5, 17)
# --- end of parameter ---

PAST: dict[str, Callable[[Star], DataFrame]] = {
    "mart_sales_trends_as_of": lambda s: sales.mart_sales_trends(s.at(PAST_DAY)),
    "mart_abc_as_of": lambda s: sales.mart_abc(s.at(PAST_DAY)),
    "mart_margin_as_of": lambda s: sales.mart_margin(s.at(PAST_DAY)),
    "mart_subscriptions_as_of": lambda s: sales.mart_subscriptions(s.at(PAST_DAY)),
    # checks read the whole tables whatever the report day
    "dates_within_calendar_as_of": lambda s: checks.dates_within_calendar(s.at(PAST_DAY)),
}

QUERIES: dict[str, Callable[[Star], DataFrame]] = {
    **PAST, **FAULTS, **MARTS, **VIEWS, **ADHOC, **CHARTS, **ALERTS, **CHECKS, **STOCK_AND_PLAN, **QUALITY, **LOADING,
}
