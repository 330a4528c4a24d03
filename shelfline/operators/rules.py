"""Data-quality rules over a raw table, as one flagged frame.

A table's rules are a list of steps in the order they apply. A row is charged to the first rule that
rejects it; warnings and fixes count only rows still kept when their step is reached.

What a row's own values decide is worked out where its text is parsed: the step that rejects it (`_at`),
the warnings and fixes it would count for as bits (`_flags`), and its values in the types of the table. Rows
are staged, searched for copies and, if need be, shuffled in this short form. A row that repeats a key is
charged to that step instead if it comes first, so one aggregation yields every counter and one filter the
clean rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.parsing import day, trimmed, typed

POSITION = "_pos"
#: set by the reader on lines with more fields than the header
OVERLONG = "_overlong"
DETAILS = "table_name string, code string, level string, what string, n bigint"


@dataclass(frozen=True)
class Reject:
    """Rows for which `test` is true are dropped. `test` must not be NULL."""
    code: str
    what: str
    test: Column


@dataclass(frozen=True)
class Unique:
    """Of the kept rows sharing these keys only the first stays; NULL keys are equal to each other."""
    code: str
    what: str
    keys: Sequence[str]


@dataclass(frozen=True)
class Warn:
    code: str
    what: str
    test: Column


@dataclass(frozen=True)
class Fix:
    """Counts rows for which `test` is true and sets `values` on every row."""
    code: str
    what: str
    test: Column
    values: dict[str, Column]


@dataclass(frozen=True)
class MissingDays:
    """Counts the days from `start` to the last kept date on which no kept row falls."""
    code: str
    what: str
    start: dt.date


Step = Reject | Unique | Warn | Fix | MissingDays


@dataclass(frozen=True)
class Checked:
    """A validated table: typed clean rows and the counters behind the report."""
    table: str
    flagged: DataFrame
    schema: T.StructType
    counted: list[tuple[str, str, str, Column]]
    days_from: MissingDays | None
    #: counters taken while the flagged rows were written
    observed: dict[str, int] | None = None

    @property
    def clean(self) -> DataFrame:
        return self.placed.drop(POSITION)

    @property
    def placed(self) -> DataFrame:
        """Clean rows with their position in the extract."""
        kept = self.flagged.where(F.col("_reject").isNull())
        return kept.select(POSITION, *[f.name for f in self.schema])

    def counters(self) -> dict[str, Column]:
        """What is counted over the flagged rows: received, kept, and one counter per step."""
        kept = F.col("_reject").isNull()
        return {"received": F.count("*"), "loaded": F.count_if(kept),
                **{f"n{i}": test for i, (_, _, _, test) in enumerate(self.counted)}}

    def settled(self) -> DataFrame:
        """The flagged rows as they are stored: position, why a row was rejected, values in the types of the table."""
        return self.flagged.select(POSITION, "_reject", *[f.name for f in self.schema])

    def _counters(self) -> DataFrame:
        """One row of all counters. Those observed while writing are not counted again: then only the days
        of the kept rows are read, where a rule asks for them."""
        counters = self.counters()
        if self.observed is not None:
            known = [F.lit(self.observed[n] or 0).cast("bigint").alias(n) for n in counters]
            if self.days_from is None:
                return self.flagged.sparkSession.range(1).select(*known)
            days = self.flagged.where(F.col("_reject").isNull()).groupBy("date").agg(F.lit(1).alias("loaded"))
            return days.agg(self._missing()).select(*known, "missing")
        if self.days_from is None:
            return self.flagged.agg(*[c.alias(n) for n, c in counters.items()])
        # By day first: the days without a kept row come out of the same pass, and no distinct
        # count widens the rows.
        by_day = self.flagged.groupBy("date").agg(*[c.alias(n) for n, c in counters.items()])
        return by_day.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counters], self._missing())

    def _missing(self) -> Column:
        """Days from the start to the last kept row on which no row was kept."""
        start = F.lit(self.days_from.start)
        present = (F.col("loaded") > 0) & (F.col("date") >= start)
        span = F.date_diff(F.max(F.when(F.col("loaded") > 0, F.col("date"))), start) + 1
        return F.greatest(F.lit(0), F.coalesce(span - F.count_if(present), F.lit(0))).cast("bigint").alias("missing")

    def details(self) -> DataFrame:
        """Rows per rule, for the rules that found something."""
        found = [
            F.struct(F.lit(self.table).alias("table_name"), F.lit(code).alias("code"), F.lit(level).alias("level"),
                     F.lit(what).alias("what"), F.col(f"n{i}").cast("bigint").alias("n"))
            for i, (code, level, what, _) in enumerate(self.counted)]
        if self.days_from is not None:
            found.append(F.struct(
                F.lit(self.table).alias("table_name"), F.lit(self.days_from.code).alias("code"),
                F.lit("warn").alias("level"), F.lit(self.days_from.what).alias("what"), F.col("missing").alias("n")))
        rows = self._counters().select(F.explode(F.array(*found)).alias("r")).select("r.*")
        return rows.where(F.col("n") > 0)

    def summary(self) -> DataFrame:
        def total(level: str) -> Column:
            parts = [F.col(f"n{i}") for i, (_, l, _, _) in enumerate(self.counted) if l == level]
            if level == "warn" and self.days_from is not None:
                parts.append(F.col("missing"))
            return sum(parts, F.lit(0)).cast("bigint")

        return self._counters().select(
            F.lit(self.table).alias("table_name"), F.col("received").alias("rows_received"),
            total("reject").alias("rows_rejected"), total("fix").alias("rows_fixed"),
            total("warn").alias("warnings"), F.col("loaded").alias("rows_loaded"))


def _output(field: T.StructField, columns: list[str]) -> Column:
    """A column in its table type: read from its text where no fix has set it."""
    name, raw = field.name, f"_raw_{field.name}"
    if raw in columns:
        column = typed(F.col(raw), F.col(name), field.dataType)
    elif isinstance(field.dataType, T.DateType) and name != "date":
        column = F.coalesce(day(F.col(name)), F.col(name).try_cast("date"))
    else:
        column = F.col(name).cast(field.dataType)
    return column.alias(name)


def general_rules(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Trimmed text columns with blanks as NULL, and per row how many values that changed."""
    given = [f.name for f in schema if f.name in raw.columns]
    # Trimmed once, in a projection of their own; everything after refers to the result.
    overlong = F.col(OVERLONG) if OVERLONG in raw.columns else F.lit(False)
    both = raw.select(POSITION, overlong.alias(OVERLONG), *given, *[trimmed(F.col(c)).alias(f"_t_{c}") for c in given])

    def count(tests: list[Column]) -> Column:
        found = sum([F.coalesce(t, F.lit(False)).cast("int") for t in tests], F.lit(0))
        return F.when(F.col(OVERLONG), 0).otherwise(found)

    text = [
        (F.nullif(F.col(f"_t_{f.name}"), F.lit("")) if f.name in given else F.lit(None).cast("string")).alias(f.name)
        for f in schema]
    rows = both.select(
        POSITION, *text, count([F.col(f"_t_{c}") != F.col(c) for c in given]).alias("_trimmed"),
        count([F.col(f"_t_{c}") == "" for c in given]).alias("_blanked"), OVERLONG)
    nothing = F.coalesce(*[F.col(f.name) for f in schema]).isNull()
    return rows.withColumn("_reject", F.when(F.col(OVERLONG), "G-01 over-long line").when(nothing, "G-05 empty row")).drop(OVERLONG)


Stage = Callable[[DataFrame, str], DataFrame]


def mark_copies(df: DataFrame, keys: Sequence[str], stage: Stage | None = None, name: str = "",
                kept: Column | None = None) -> DataFrame:
    """Adds `_first`: for rows whose key occurs more than once among the `kept` rows, where it first does.

    Only keys and positions are shuffled, combined before they travel: a key shared by a third of the
    rows sends one row per task. With a `stage` the repeated keys are written first. They are few in
    practice, and the planner then knows their size before it touches the rows: small enough, they are
    broadcast and the rows are not shuffled at all; otherwise it is a shuffle whose skewed partitions
    are split.
    """
    among = df if kept is None else df.where(kept)
    repeated = among.groupBy(*keys).agg(F.min(POSITION).alias("_first"), F.count("*").alias("_n")).where(F.col("_n") > 1)
    renamed = repeated.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_first")
    if stage:
        renamed = stage(renamed, name)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return df.join(renamed, same, "left").drop(*[f"_key{i}" for i in range(len(keys))])


def is_copy() -> Column:
    return F.col("_first").isNotNull() & (F.col(POSITION) != F.col("_first"))


def keep_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row of each key, by position."""
    return mark_copies(df, keys, kept=F.col("_reject").isNull() if "_reject" in df.columns else None).where(~is_copy()).drop("_first")


#: steps before the first of a table: lines the general rules drop
_GENERAL = {"G-01 over-long line": -2, "G-05 empty row": -1}


def _reached(step: int) -> Column:
    """Whether a row is still kept when a step is reached."""
    return F.col("_at").isNull() | (F.col("_at") >= step)


def _by_row(prepared: DataFrame, schema: T.StructType, steps: Sequence[Step]) -> tuple[DataFrame, dict[int, list[str]]]:
    """What follows from each row alone: position, counts of the general rules, `_at`, `_flags` and the values in
    their table types; and for each `Unique` the columns that hold its keys as they stand when it is reached."""
    at = F.lit(None).cast("int")
    for label, number in _GENERAL.items():
        at = F.when(F.col("_reject") == label, number).otherwise(at)
    df = prepared.withColumn("_at", at)
    fixed = {c for step in steps if isinstance(step, Fix) for c in step.values}
    kinds = {f.name: f.dataType for f in schema}
    pending: list[Column] = []
    flags: list[str] = []
    keys: dict[int, list[str]] = {}

    def same_typed(name: str) -> bool:
        """Whether the table holds the value that was parsed."""
        exact = isinstance(kinds[name], T.StringType) or name == "date" or name.endswith("_id")
        return exact and name not in fixed

    for i, step in enumerate(steps):
        if isinstance(step, Reject):
            pending.append(F.when(step.test, i))
            continue
        if isinstance(step, Fix) and pending:
            # a fix sets what later tests read
            df, pending = df.withColumn("_at", F.coalesce("_at", *pending)), []
        if isinstance(step, Unique):
            keys[i] = [k if same_typed(k) else f"_key_{i}_{k}" for k in step.keys]
            df = df.withColumns({c: F.col(k) for c, k in zip(keys[i], step.keys) if c != k})
        elif isinstance(step, (Warn, Fix)):
            flags.append(f"_flag{i}")
            df = df.withColumn(f"_flag{i}", F.when(step.test, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
            if isinstance(step, Fix):
                df = df.withColumns(step.values).drop(*[f"_raw_{c}" for c in step.values])
    if pending:
        df = df.withColumn("_at", F.coalesce("_at", *pending))
    found = F.lit(0).cast("bigint")
    for name in flags:
        found = found.bitwiseOR(F.col(name))
    snapshots = [c for columns in keys.values() for c in columns if c.startswith("_key_")]
    return df.select(POSITION, "_trimmed", "_blanked", "_at", found.alias("_flags"), *snapshots,
                     *[_output(f, df.columns) for f in schema]), keys


def apply_rules(table: str, prepared: DataFrame, schema: T.StructType, steps: Sequence[Step],
                stage: Stage | None = None) -> Checked:
    """Runs the steps over a frame from `general_rules` whose columns have been parsed.

    Rules that look for copies read the rows more than once. `stage` writes a frame and reads it back, so that
    text is parsed and tested once and the later passes read the short rows, of which only the columns they need.
    """
    df, keys = _by_row(prepared, schema, steps)
    if stage:
        df = stage(df, "parsed")
    labels = dict(_GENERAL)
    counted = [
        ("G-04", "fix", "trimmed values", F.sum("_trimmed")),
        ("G-03", "fix", "blank values", F.sum("_blanked")),
        ("G-01", "reject", "over-long line", F.count_if(F.col("_reject") == "G-01 over-long line")),
        ("G-05", "reject", "empty row", F.count_if(F.col("_reject") == "G-05 empty row")),
    ]
    days_from = None
    for i, step in enumerate(steps):
        if isinstance(step, (Reject, Unique)):
            label = f"{step.code} {step.what}"
            labels[label] = i
            counted.append((step.code, "reject", step.what, F.count_if(F.col("_reject") == label)))
        if isinstance(step, Unique):
            df = mark_copies(df, keys[i], stage, f"copies_{i}", _reached(i))
            df = df.withColumn("_at", F.when(_reached(i) & is_copy(), i).otherwise(F.col("_at"))).drop("_first")
        elif isinstance(step, MissingDays):
            days_from = step
        elif isinstance(step, (Warn, Fix)):
            test = _reached(i) & (F.col("_flags").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0)
            counted.append((step.code, "warn" if isinstance(step, Warn) else "fix", step.what, F.count_if(test)))
    reject = F.lit(None).cast("string")
    for label, number in labels.items():
        reject = F.when(F.col("_at") == number, label).otherwise(reject)
    return Checked(table, df.withColumn("_reject", reject), schema, counted, days_from)
