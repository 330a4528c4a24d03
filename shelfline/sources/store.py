"""Parquet tables in a folder: full loads, appended batches, and what is maintained beside them.

Facts are written in one folder per month and sorted by day inside a file, so a report on a few days
reads only those days. A rebalance before the write splits a month that holds far more rows
than the others and merges small ones, whatever the number of tasks upstream.

Every change is one commit. Its files lie in folders named after it, and one small file, written last,
names them for all tables at once: readers see a commit whole or not at all, and what a failed one left
behind is written over by the next. Beside the rows a commit writes

- the keys of its rows, in buckets by key and sorted, so that a later batch finds taken keys without
  reading or shuffling the table;
- for sales, the totals and order numbers of the months it touched (see `operators.monthly`).

One writer at a time; readers are free.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.monthly import (
    described_months, described_words, descriptions, in_months, merged_months, merged_words, order_words, product_months, with_month,
)
from shelfline.operators.rules import POSITION, keep_first
from shelfline.schemas import FACTS, KEYS, LINE_ATTRIBUTES, PARTITION, TABLES
from shelfline.sources.driver_star import line_tasks
from shelfline.sources.files import COMPRESSION
from shelfline.star import Star

COMMIT = "_commit"
#: keys of one bucket at a full load
KEYS_PER_BUCKET = 5_000_000
MOST_BUCKETS = 8192
#: aggregates of a fact that every commit brings up to date: how lines are summed, how they are if one product table
#: describes them all, how sums are merged
MAINTAINED: dict[str, dict[str, tuple[Callable, Callable, Callable]]] = {
    "fact_sales": {"sales_months": (product_months, described_months, merged_months),
                   "order_months": (order_words, described_words, merged_words)},
}
# an entry replaces a table, adds rows to it, or replaces some of its months
REPLACE, APPEND, MONTHS, INDEX = "replace", "append", "months", "index"
_ENTRY = ("commit bigint, load_id bigint, batch string, table_name string, kind string, columns string, buckets int, "
          "days array<struct<day:date,rows:bigint>>, received bigint, inserted bigint")


def write_fact(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows that already name their month were brought together by it and are not shuffled again."""
    parted = df if PARTITION in df.columns else with_month(df).hint("rebalance", PARTITION)
    parted.sortWithinPartitions(PARTITION, "date").write.mode(mode).option("compression", COMPRESSION).partitionBy(
        PARTITION).parquet(path)


def write_months(df: DataFrame, path: str, folders: bool) -> None:
    """Aggregates by month. Those of a batch get a folder each. Those of a full load are about as many as the lines they
    sum, so they stay where they were summed instead of being shuffled into folders: sorted by month in each file,
    months are found by the footers."""
    rows = df.hint("rebalance", PARTITION) if folders else df
    rows.sortWithinPartitions(PARTITION, "product_id").write.mode("overwrite").option("compression", COMPRESSION).partitionBy(
        *[PARTITION] if folders else []).parquet(path)


def widen(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Sales lines with their product's attributes: joined once per load instead of once per mart."""
    return sales.join(product.select("product_id", *LINE_ATTRIBUTES), "product_id", "left")


@dataclass(frozen=True)
class Inserted:
    received: int
    inserted: int

    @property
    def skipped(self) -> int:
        return self.received - self.inserted


class Store:
    """The five tables under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- the log of commits ---

    def _log(self) -> list[Row]:
        """Entries of all commits, about six rows each; `compact` keeps their number small."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(folder):  # nothing has been committed; any other failure to read is an error
            return []
        return sorted(self.spark.read.schema(_ENTRY).json(f"{self.root}/commits").collect(), key=lambda r: r["commit"])

    def _live(self, name: str, log: list[Row]) -> list[Row]:
        """Entries of a table since it was last replaced."""
        own = [e for e in log if e.table_name == name]
        starts = [i for i, e in enumerate(own) if e.kind == REPLACE]
        if not starts:
            raise ValueError(f"{name} has not been loaded")
        return own[starts[-1]:]

    def _publish(self, entries: list[tuple]) -> None:
        """One file: it is there or it is not."""
        self.spark.createDataFrame(entries, _ENTRY).coalesce(1).write.mode("append").json(f"{self.root}/commits")

    def _folder(self, name: str, commit: int) -> str:
        return f"{self.root}/{name}/{COMMIT}={commit}"

    def _read(self, name: str, entries: list[Row]) -> DataFrame:
        """With the stored schema, so that no file is opened to infer it and an empty table reads too."""
        if entries[-1].kind != MONTHS:
            return self._files(name, entries, entries).drop(COMMIT)
        # of each month the last commit that wrote it; months of a load and of batches are laid out differently
        last = {d.day: e["commit"] for e in entries for d in e.days}
        parts = []
        for kind in (REPLACE, MONTHS):
            by_commit: dict[int, list] = {e["commit"]: [] for e in entries if e.kind == kind}
            for month, commit in last.items():
                if commit in by_commit:
                    by_commit[commit].append(month)
            live = {c: months for c, months in by_commit.items() if months}
            if live:
                rows = self._files(name, entries, [e for e in entries if e["commit"] in live])
                parts.append(rows.where(reduce(lambda a, b: a | b, (
                    (F.col(COMMIT) == c) & F.col(PARTITION).isin(sorted(months)) for c, months in live.items()))).drop(COMMIT))
        return reduce(DataFrame.unionByName, parts) if parts else self._files(name, entries, entries[:1]).drop(COMMIT)

    def _files(self, name: str, entries: list[Row], of: list[Row]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entries[0].columns)).add(COMMIT, T.LongType())
        paths = [self._folder(name, c) for c in dict.fromkeys(e["commit"] for e in of)]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def table(self, name: str) -> DataFrame:
        return self._read(name, self._live(name, self._log()))

    def load_dim_product(self) -> DataFrame:
        return self.table("dim_product")

    def star(self, as_of: dt.date | None = None) -> Star:
        """All tables as of one commit."""
        log = self._log()
        names = {e.table_name for e in log if e.kind != INDEX}
        return Star(self.spark, as_of, **{n: self._read(n, self._live(n, log)) for n in names})

    def latest_load(self) -> int | None:
        """The id of the last full load; None for an empty store."""
        return max((e.load_id for e in self._log() if e.load_id is not None), default=None)

    def touched(self, batch: str, name: str = "fact_sales") -> list[dt.date] | None:
        """Months in which a batch added rows to a table; None for a batch that is not there."""
        entries = [e for e in self._log() if e.table_name == name and e.batch == batch]
        return sorted({d.day.replace(day=1) for e in entries for d in e.days}) if entries else None

    # --- keys ---

    def _keys(self, name: str, columns: list[str]) -> dict[str, list[str]]:
        return {f"keys_{name}_{i}": keys for i, keys in enumerate(KEYS[name]) if set(keys) <= set(columns)}

    def _index(self, index: str, first: int, buckets: int, schema: T.StructType, keys: list[str]) -> str:
        """Declares the stored keys as an external table with their buckets; returns its name."""
        path = f"{self.root}/{index}/from={first}"
        name = f"{index}_{hashlib.sha1(path.encode()).hexdigest()[:16]}"
        kinds = ", ".join(f"`{k}` {schema[k].dataType.simpleString()}" for k in keys)
        named = ", ".join(f"`{k}`" for k in keys)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name} ({kinds}, {COMMIT} BIGINT) USING parquet OPTIONS (compression '{COMPRESSION}') PARTITIONED BY ({COMMIT}) "
                       f"CLUSTERED BY ({named}) SORTED BY ({named}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return name

    def _write_keys(self, rows: DataFrame, index: str, first: int, commit: int, buckets: int, keys: list[str]) -> None:
        name = self._index(index, first, buckets, rows.schema, keys)
        view = f"{name}_{commit}"
        dealt = rows.select(*keys).where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
        dealt.repartition(buckets, *keys).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({COMMIT} = {commit}) SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
            self.spark.sql(f"DROP TABLE {name}")

    def taken(self, index: str, keys: list[str], log: list[Row], schema: T.StructType) -> DataFrame | None:
        """The keys stored so far, in their buckets; None where no index has been written."""
        live = [e for e in log if e.table_name == index]
        first = max((e["commit"] for e in live if e.kind == REPLACE or e.load_id is not None), default=None)
        if first is None:
            return None
        entry = next(e for e in live if e["commit"] == first)
        name = self._index(index, first, entry.buckets, schema, keys)
        self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return self.spark.table(name).where(F.col(COMMIT) <= max(e["commit"] for e in log))

    def new_rows(self, batch: DataFrame, name: str, log: list[Row] | None = None) -> DataFrame:
        """Rows of the batch whose keys are free, the first of a key where the batch repeats one.

        The batch alone is shuffled, into the buckets the stored keys are already in. Literal bounds on the
        leading column let the footers of the sorted key files rule out most of them; the table itself is
        not read.
        """
        log = self._log() if log is None else log
        indexed = self._keys(name, batch.columns)
        if not indexed:
            return batch
        leads = sorted({"date" if "date" in keys else keys[0] for keys in indexed.values()})
        edges = batch.agg(*[f(c).alias(f"{c}_{i}") for c in leads for i, f in enumerate((F.min, F.max))]).first()
        for index, keys in indexed.items():
            lead = "date" if "date" in keys else keys[0]
            low, high = edges[f"{lead}_0"], edges[f"{lead}_1"]
            stored = None if low is None else self.taken(index, keys, log, batch.schema)
            if stored is not None:
                batch = batch.join(stored.where(F.col(lead).between(low, high)).select(*keys), keys, "left_anti")
        for keys in indexed.values():
            batch = keep_first(batch, keys)
        return batch

    # --- writing ---

    def _add(self, df: DataFrame, name: str, commit: int, kind: str, load_id: int | None, batch: str | None,
             log: list[Row], received: int | None = None, product: DataFrame | None = None) -> list[tuple]:
        """Writes rows of one table and what is maintained beside them; returns the entries to publish. Sales that all
        carry the attributes of one `product` table are summed without them."""
        path = self._folder(name, commit)
        if name in FACTS:
            write_fact(df, path)
            df = with_month(df)
        else:
            df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path)
        count = rows.count()  # from the footers
        days = [(r.date, r.n) for r in rows.groupBy("date").agg(F.count("*").alias("n")).collect()] if name in FACTS else []
        entries = [(commit, load_id, batch, name, kind, df.schema.json(), None, days, received, count)]
        for index, keys in self._keys(name, df.columns).items():
            old = [e for e in log if e.table_name == index and e.load_id is not None]
            if kind == REPLACE or not old:
                first, buckets, load = commit, self._buckets(count), -1 if load_id is None else load_id
            else:
                first, buckets, load = old[-1]["commit"], old[-1].buckets, None
            self._write_keys(rows, index, first, commit, buckets, keys)
            entries.append((commit, load, batch, index, INDEX, None, buckets, [], None, None))
        if set(TABLES[name].names) <= set(df.columns):
            months = sorted({day.replace(day=1) for day, _ in days})
            tasks = line_tasks(count, self.spark.sparkContext.defaultParallelism)
            for state, (summed, described, merged) in MAINTAINED.get(name, {}).items():
                if kind == REPLACE or any(e.table_name == state for e in log):
                    # lines without attributes and descriptions are brought together by product, each once
                    new = summed(rows) if product is None else described(
                        rows.drop(*LINE_ATTRIBUTES).repartition(tasks, "product_id"),
                        descriptions(product.repartition(tasks, "product_id")), "left")
                    entries.append(self._maintain(new, state, merged, months, commit, kind, batch, log))
        return entries

    def _maintain(self, new: DataFrame, state: str, merged: Callable, months: list[dt.date],
                  commit: int, kind: str, batch: str | None, log: list[Row]) -> tuple:
        """Merges the sums of new rows into the months they fall in; other months stay as they are."""
        if kind != REPLACE:
            old = in_months(self._read(state, self._live(state, log)), months)
            new = merged(old.select(new.columns).unionByName(new))
        write_months(new, self._folder(state, commit), kind != REPLACE)
        return (commit, None, batch, state, REPLACE if kind == REPLACE else MONTHS, new.schema.json(), None,
                [(m, None) for m in months], None, None)

    def _buckets(self, keys: int) -> int:
        at_least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return min(max(at_least, math.ceil(keys / KEYS_PER_BUCKET)), MOST_BUCKETS)

    def full_load(self, tables: dict[str, DataFrame], load_id: int) -> None:
        """Replaces the given tables in one commit. The id must be above that of the last full load."""
        log = self._log()
        loaded = max((e.load_id for e in log if e.load_id is not None), default=None)
        if loaded is not None and load_id <= loaded:
            raise ValueError(f"load {load_id} is not above the published load {loaded}")
        commit = 1 + max((e["commit"] for e in log), default=0)
        entries = []
        for name, df in tables.items():
            product = tables["dim_product"] if name == "fact_sales" else None
            entries += self._add(df if product is None else widen(df, product), name, commit, REPLACE, load_id, None, log,
                                 product=product)
        self._publish(entries)

    def existing_on_dates(self, batch: DataFrame, name: str) -> int:
        """Rows already stored on the days of the batch: the log counts them by day."""
        counts = [(d.day, d.rows) for e in self._live(name, self._log()) for d in e.days]
        stored = self.spark.createDataFrame(counts, "date date, rows bigint")
        return batch.select("date").distinct().join(stored, "date").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def insert(self, batches: dict[str, DataFrame], batch: str | None = None) -> dict[str, Inserted]:
        """Appends to each table the rows whose keys are free, all tables in one commit.

        Running it again adds nothing: by its name a batch is known without reading a row, and without a
        name its keys are found taken. If writing any table fails, none of them changes.
        """
        log = self._log()
        batch = batch or uuid.uuid4().hex
        commit = 1 + max((e["commit"] for e in log), default=0)
        done, entries = {}, []
        for name, df in batches.items():
            before = [e for e in self._live(name, log) if e.batch == batch]
            if before:
                done[name] = Inserted(before[0].received, 0)
                continue
            if POSITION not in df.columns:
                df = df.withColumn(POSITION, F.monotonically_increasing_id()).checkpoint()
            fresh = self.new_rows(df, name, log).drop(POSITION)
            product = self._read("dim_product", self._live("dim_product", log)) if name == "fact_sales" else None
            if product is not None:
                fresh = widen(fresh, product)
            made = self._add(fresh, name, commit, APPEND, None, batch, log, df.count(), product)
            done[name] = Inserted(made[0][-2], made[0][-1])
            entries += made
        if entries:
            self._publish(entries)
        return done

    def insert_rows(self, batch: DataFrame, name: str) -> Inserted:
        """Appends the rows of one table whose keys are free."""
        return self.insert({name: batch})[name]

    def compact(self) -> None:
        """Writes each table, its keys and its months to one folder and starts a new log entry for it, so
        that daily batches do not add up to thousands of small files."""
        log = self._log()
        commit = 1 + max((e["commit"] for e in log), default=0)
        load_id = max((e.load_id for e in log if e.load_id is not None), default=0)
        names = sorted({e.table_name for e in log if e.kind in (REPLACE, APPEND)} & set(KEYS))
        entries = []
        for name in names:
            live = self._live(name, log)
            if len(live) == 1:
                continue
            df = self._read(name, live)
            entries += self._add(df.drop(PARTITION) if name in FACTS else df, name, commit, REPLACE, load_id, None, log)
            # batches stay known by name after their rows have been merged
            entries += [(commit, None, e.batch, name, APPEND, e.columns, None, [], e.received, 0) for e in live if e.batch]
        if entries:
            self._publish(entries)

    def vacuum(self) -> list[str]:
        """Deletes the folders no live entry names: replaced loads, compacted batches, failed commits. Readers
        that opened the store before the last commit lose their files; returns what was deleted."""
        log = self._log()
        live = {name: {e["commit"] for e in self._live(name, log)} for name in {e.table_name for e in log if e.kind != INDEX}}
        starts = {e.table_name: e["commit"] for e in log if e.kind == INDEX and e.load_id is not None}
        jvm = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        root = jvm.Path(self.root)
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        gone = []
        for table in files.listStatus(root):
            name = table.getPath().getName()
            for folder in files.listStatus(table.getPath()) if name in live or name in starts else []:
                label, _, number = folder.getPath().getName().partition("=")
                stale = (label == COMMIT and int(number) not in live.get(name, ())) or (
                    label == "from" and int(number) != starts.get(name))
                if stale:
                    files.delete(folder.getPath(), True)
                    gone.append(f"{name}/{folder.getPath().getName()}")
        return sorted(gone)
