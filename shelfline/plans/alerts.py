"""Who is told about which low stock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.plans.stock import mart_inventory_alerts
from shelfline.schemas import ALERT_LEVELS
from shelfline.sources.files import append_log
from shelfline.star import Star

RECIPIENT_SCHEMA = "email string, name string, roles array<string>"
LOG_SCHEMA = ("report_date string, recipient string, rows_sent bigint, critical bigint, urgent bigint, warning bigint, "
              "success boolean, error string")


def severity(level: Column | None = None) -> Column:
    level = F.col("alert_level") if level is None else level
    return F.when(level == "critical", 1).when(level == "urgent", 2).otherwise(3)


def all_alerts(star: Star) -> DataFrame:
    """Every alert, with the columns that are sent."""
    return star.mart(mart_inventory_alerts).select(
        "product_id", "title", "format", "genre", "publisher", "closing_stock", "avg_daily_sales_30d",
        "days_until_stockout", "recommended_order_qty", "alert_level", "stock_date")


def alerts_ranked(star: Star, max_rows: int = 50) -> DataFrame:
    """The most pressing alerts: by level, then by stock. A report; routing starts from all alerts."""
    return all_alerts(star).orderBy(severity(), "closing_stock", "product_id").limit(max_rows)


def recipients(star: Star, rows: Sequence[tuple]) -> DataFrame:
    """Recipients with their roles; without roles one gets every level."""
    df = star.spark.createDataFrame(list(rows), RECIPIENT_SCHEMA)
    every = F.array(*map(F.lit, ALERT_LEVELS))
    return df.select("email", F.coalesce("name", "email").alias("name"), F.coalesce("roles", every).alias("roles"))


def alerts_for_recipients(alerts: DataFrame, people: DataFrame) -> DataFrame:
    """Each alert once per recipient whose roles include its level: an equi-join on the level."""
    by_role = people.select("email", "name", F.explode(F.array_distinct("roles")).alias("alert_level"))
    return alerts.join(by_role, "alert_level")


def alert_gate(alerts: DataFrame, min_level: str = "warning") -> DataFrame:
    """Whether any alert is at least as severe as `min_level`; an unknown level means critical only."""
    rank = ALERT_LEVELS.index(min_level) + 1 if min_level in ALERT_LEVELS else 1
    known = F.col("alert_level").isin(ALERT_LEVELS)
    return alerts.agg(F.coalesce(F.bool_or(known & (severity() <= rank)), F.lit(False)).alias("send"))


def level_counts() -> list[Column]:
    return [F.count_if(F.col("alert_level") == level).alias(level) for level in ALERT_LEVELS]


def alert_subject(alerts: DataFrame, report_date: dt.date, prefix: str = "[Stock]",
                  topic: str = "low stock") -> DataFrame:
    """Subject line with the levels that occur."""
    parts = [F.when(F.col(n) > 0, F.concat(F.col(n).cast("string"), F.lit(f" {n}"))) for n in ALERT_LEVELS]
    summary = F.concat_ws(", ", *parts)
    return alerts.agg(*level_counts()).select(
        F.concat(F.lit(f"{prefix} {topic}: "), summary, F.lit(report_date.strftime(" - %d.%m.%Y"))).alias("subject"))


def alert_log(routed: DataFrame, report_date: dt.date, sent_at: dt.datetime | None = None,
              success: bool = True, error: str | None = None) -> DataFrame:
    """One record per recipient with the rows sent per level, ready to append as JSON lines."""
    counts = routed.groupBy(F.col("email").alias("recipient")).agg(F.count("*").alias("rows_sent"), *level_counts())
    stamp = [] if sent_at is None else [F.lit(sent_at.isoformat(timespec="seconds")).alias("ts")]
    return counts.select(
        *stamp, F.lit(report_date).cast("string").alias("report_date"), "recipient", "rows_sent",
        *ALERT_LEVELS, F.lit(success).alias("success"), F.lit(error).cast("string").alias("error"))


def alert_run(alerts: DataFrame, people: DataFrame, report_date: dt.date, path: str, min_level: str = "warning") -> DataFrame:
    """One run: if any alert is severe enough, each recipient's share is logged to `path`, where earlier
    runs stay. Recipients without a matching alert get no record. Returns the log as it stands after."""
    if alert_gate(alerts, min_level).first().send:
        append_log(alert_log(alerts_for_recipients(alerts, people), report_date), path)
    elif not log_exists(alerts.sparkSession, path):
        return alerts.sparkSession.createDataFrame([], LOG_SCHEMA)
    return alerts.sparkSession.read.schema(LOG_SCHEMA).json(path)


def log_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(LOG_SCHEMA).json(path)
    except AnalysisException:
        return False
    return True
