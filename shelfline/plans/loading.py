"""Historical load and daily update: read, validate, load, report."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession

from shelfline.operators.rules import Checked, Stage
from shelfline.plans import validators
from shelfline.plans.refresh import refresh_all_marts
from shelfline.schemas import FACTS, PLAN_YEARS, PROJECT_START
from shelfline.session import shared_dir
from shelfline.sources.files import read_csv, written
from shelfline.sources.store import Inserted, Store


@dataclass(frozen=True)
class Loaded:
    summary: DataFrame
    details: DataFrame
    inserted: dict[str, Inserted]
    existing: dict[str, int]
    marts: DataFrame | None = None


#: bytes of a generated method up to which the JVM compiles it by default; a longer one is interpreted
COMPILED_METHOD = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def _compiled(spark: SparkSession) -> Iterator[None]:
    """Rules over all columns of a table make one generated method that the JVM no longer compiles. Spark is told
    to split such a stage into small methods, for the writes done in here."""
    before = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, str(COMPILED_METHOD))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


def settle(checked: Checked, path: str) -> Checked:
    """Writes the flagged rows once, in the types of the table, and counts them on the way; clean rows are then read
    from there."""
    seen = Observation()
    counted = replace(checked, flagged=checked.flagged.observe(seen, *[c.alias(n) for n, c in checked.counters().items()]))
    with _compiled(checked.flagged.sparkSession):
        flagged = written(counted.settled(), path)
    return replace(checked, flagged=flagged, observed=seen.get)


def staged(folder: str) -> Stage:
    """Writes the frames a validator reads more than once below `folder`."""
    def stage(df: DataFrame, name: str) -> DataFrame:
        with _compiled(df.sparkSession):
            return written(df, f"{folder}/{name}")
    return stage


def historical_load(spark: SparkSession, store: Store, sources: dict[str, str], load_id: int,
                    start: dt.date = PROJECT_START, as_of: dt.date | None = None,
                    plan_years: tuple[int, int] = PLAN_YEARS, work: str | None = None,
                    marts: str | None = None, charset: str | None = None) -> Loaded:
    """Replaces the whole store from five extracts. Nothing is published until all five are written.
    Naming the `charset` of the extracts saves a pass over them.

    With a `marts` folder, all marts are then built from the new tables.
    """
    work = work or f"{shared_dir(spark)}/load-{load_id}"
    done: dict[str, Checked] = {}

    def check(name: str, validate, *arguments) -> None:
        raw = read_csv(spark, sources[name], flag_overlong=True, charset=charset)
        checked = validate(raw, *arguments, stage=staged(f"{work}/stage/{name}"))
        done[name] = settle(checked, f"{work}/checked/{name}")

    check("dim_date", validators.validate_dim_date)
    check("dim_product", validators.validate_dim_product)
    check("fact_plan", validators.validate_fact_plan, plan_years)
    product = done["dim_product"].clean
    check("fact_sales", validators.validate_fact_sales, product, start, as_of)
    check("fact_inventory", validators.validate_fact_inventory, product, start, as_of)
    store.full_load({name: checked.clean for name, checked in done.items()}, load_id)
    checked = list(done.values())
    return Loaded(validators.quality_summary(checked), validators.quality_details(checked), {}, {},
                  _refreshed(store, marts))


def _refreshed(store: Store, folder: str | None, months: list[dt.date] | None = None) -> DataFrame | None:
    return refresh_all_marts(store.star(), folder, months=months) if folder else None


def daily_update(spark: SparkSession, store: Store, batches: dict[str, DataFrame], work: str,
                 start: dt.date = PROJECT_START, as_of: dt.date | None = None,
                 days_from: dt.date | None = None, marts: str | None = None, batch: str | None = None) -> Loaded:
    """Validates raw batches of the facts and appends what is new, all facts in one commit. Repeating it
    changes nothing; a batch that is named is known again by its name.

    With a `marts` folder the marts are brought up to date afterwards: monthly ones in the months the batch
    touched, the others whole. `days_from` limits the search for days without sales; without it a one-day
    batch is measured against the whole calendar.
    """
    batch = batch or uuid.uuid4().hex
    product = store.load_dim_product()
    done = {}
    for name in FACTS:
        if name not in batches:
            continue
        if name == "fact_sales":
            checked = validators.validate_fact_sales(
                batches[name], product, start, as_of, days_from, stage=staged(f"{work}/stage/{name}"))
        else:
            checked = validators.validate_fact_inventory(
                batches[name], product, start, as_of, stage=staged(f"{work}/stage/{name}"))
        done[name] = settle(checked, f"{work}/checked/{name}")
    existing = {name: store.existing_on_dates(c.clean, name) for name, c in done.items()}
    inserted = store.insert({name: c.placed for name, c in done.items()}, batch)
    checked = list(done.values())
    return Loaded(validators.quality_summary(checked), validators.quality_details(checked), inserted, existing,
                  _refreshed(store, marts, store.touched(batch) or []))
