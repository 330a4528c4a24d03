"""Written intermediates, the fold of labelled rows, and connected components of links."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import shared_dir

FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A folder nobody has used, under the one that driver and executors share."""
    return f"{shared_dir(spark)}/llm/{uuid.uuid4().hex[:12]}-{name}"


#: rows that one task of a small table writes at least, where their number is known before
ROWS_A_FILE = 1 << 16


def landed(df: DataFrame, name: str, partition_by: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: later jobs start there, and an executor
    that is lost costs only the tasks it was running. With `rows`, which the table and what its last stage reads
    do not exceed by more than a few times, a small one is not written as many almost empty files."""
    path = new_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: bytes of rows handed to a task's Python at once; by default Spark sends 10,000 rows whatever their length, up to 64 MB
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From here on the session hands whole texts to Python a few megabytes at a time. A batch is held by the JVM and
    by Python, once on each side of the pipe, by every core; work on it goes by slices of a megabyte in any case."""
    if int(spark.conf.get(_BATCH_LIMIT).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def neutral(df: DataFrame, *more: Column) -> DataFrame:
    """The columns under names c0, c1, ..., which no name of an operator's own can clash with, and more columns."""
    return df.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(df.schema)], *more)


def named_back(df: DataFrame, like: DataFrame, **changed: Column) -> DataFrame:
    """The columns of `neutral` under their names again; some may be replaced, by name."""
    return df.select(*[changed.get(f.name, F.col(f"c{i}")).alias(f.name) for i, f in enumerate(like.schema)])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; rows in fold 0 are held out, rows without an id too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(links: DataFrame, name: str = "components", rows: int | None = None) -> DataFrame:
    """(id, component) for every id in links (a, b): the smallest id reachable. `rows` is what links do not exceed,
    where that is known.

    Each round every id takes the smallest id among its neighbours and itself, neighbours are handed
    that smallest id in place of the link (large star, then small star), until all links lead to the smallest
    id of their component: until no id has two smaller neighbours, or a smaller and a larger one. The
    number of rows never grows, ids with many links are summed before they are shuffled, and each
    round is a written table.
    """
    a, b = F.col("a"), F.col("b")
    edges = landed(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                   .where(a != b).distinct(), f"{name}-0", rows=rows)
    for step in itertools.count(1):
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        sides = both.groupBy("a").agg(F.count_if(b < a).alias("smaller"), F.count_if(b > a).alias("larger"))
        now = sides.agg(F.bool_or(F.expr("smaller > 1 or (smaller > 0 and larger > 0)")).alias("on"), F.sum("smaller").alias("n")).first()
        if not now.on:
            break
        # large star: every larger neighbour of a node is linked to the node's smallest neighbour
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where(b > a).select(b.alias("a"), F.col("low").alias("b"))
        # small star: smaller neighbours and the node itself are linked to the smallest one
        down = large.where(a != b).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("low"))
        small = (down.join(least, "a").where(b != F.col("low")).select(b.alias("a"), F.col("low").alias("b"))
                 .unionByName(least.select("a", F.col("low").alias("b"))))
        edges = landed(small.where(a != b).distinct(), f"{name}-{step}", rows=now.n)
    roots = edges.select(b.alias("id"), b.alias("component")).distinct()
    return edges.select(a.alias("id"), b.alias("component")).unionByName(roots)


#: bits of a sieve: what is sent to every task is this many bits, however many keys there are
SIEVE_BITS = 1 << 23


def bitmap(keys: DataFrame, key: str, bits: int = SIEVE_BITS) -> np.ndarray:
    """Bits set at the keys modulo `bits`; as large for any number of keys."""
    place = F.pmod(F.col(key), F.lit(bits))
    got = (keys.select(place.alias("p")).groupBy(F.expr("cast(p div 64 as int)").alias("w"))
           .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits"))).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[got.column("w").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return table


def in_bitmap(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.mod(keys.view(np.int64), 64 * len(table))
    return ((table[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)


def sieved(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose `key` (a hash) may be among those of `keys`: a bitmap drops most of the others before a
    shuffle. It passes every row it should, and more the fuller it is."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap(keys, key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(sent.value, batch.column(key).to_numpy())))
    return rows.mapInArrow(run, rows.schema)
