"""Ranks and running totals over a whole table, without a single-task window.

Rows are range-partitioned by the sort order, each partition works out its own positions and sums, and
the totals of the partitions before it are added. Only one summary row per partition (and group)
travels, so what is broadcast is bounded by the partition count and not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_rank(df: DataFrame, by: str, tie: str, total: str | None = None, within: Sequence[str] = (),
                 rank: str = "rank", running: str = "running", grand: str = "grand",
                 partitions: int | None = None) -> DataFrame:
    """Adds the RANK of each row in descending order of `by`, never NULL; `tie` orders equal values.

    With `total`, also the running sum of that column up to and including the row, and its grand
    total. `within` restarts both per group and is meant for a few large groups; many small ones are
    a plain window. The ordered rows are checkpointed: partition numbers are then facts of stored
    data, which a lost executor cannot change under the join.
    """
    group = list(within)
    order = [F.col(by).desc(), F.col(tie)]
    keys = [*map(F.col, group), *order]
    split = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    placed = split.withColumn("_part", F.spark_partition_id()).checkpoint()

    amount = F.col(total) if total else F.lit(0)
    here = Window.partitionBy("_part", *group)
    local = placed.select(
        "*",
        F.rank().over(here.orderBy(order[0])).alias("_rank"),
        F.sum(amount).over(here.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).alias("_running"),
    )

    # Per partition: its size, its sum, the value it starts with, and the value and size of its last tie.
    sizes = placed.groupBy("_part", *group).agg(
        F.count("*").alias("_n"), F.sum(amount).alias("_sum"),
        F.max(by).alias("_head"), F.min(by).alias("_tail"))
    ties = placed.groupBy("_part", *group, F.col(by).alias("_tail")).agg(F.count("*").alias("_tail_n"))
    summary = sizes.join(ties, ["_part", *group, "_tail"], "left")

    parts = Window.partitionBy(*group)
    earlier = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    rows_before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    summary = summary.select(
        "_part", *group, "_head", "_tail", rows_before.alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
        F.sum("_sum").over(parts).alias("_grand"),
        (rows_before + F.col("_n") - F.col("_tail_n") + 1).alias("_tail_start"),
    )
    # A tie cut by a partition boundary keeps the rank it got where it began.
    began = F.min("_tail_start").over(
        Window.partitionBy(*group, "_tail").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    summary = summary.withColumn("_began", began)
    last = parts.orderBy("_part")
    carried = F.when(F.lag("_tail").over(last) == F.col("_head"), F.lag("_began").over(last))
    offsets = summary.select(
        "_part", *group, "_head", "_rows_before", "_sum_before", "_grand", carried.alias("_carried"))

    joined = local.join(F.broadcast(offsets), ["_part", *group])
    continues = F.col("_carried").isNotNull() & (F.col(by) == F.col("_head"))
    position = F.when(continues, F.col("_carried")).otherwise(F.col("_rows_before") + F.col("_rank"))
    added = [position.cast("bigint").alias(rank)]
    if total:
        added += [(F.col("_sum_before") + F.col("_running")).alias(running), F.col("_grand").alias(grand)]
    return joined.select(*df.columns, *added)


def top_ranked(df: DataFrame, by: str, n: int, rank: str = "rnk") -> DataFrame:
    """Rows whose RANK by `by` descending is at most n; ties at the last place are all kept.

    A distributed top-n fetches the n best values. They hold every value above a kept row, so a row's
    rank is one more than the number of them above it: no window, however long the tie.
    """
    best = df.select(by).where(F.col(by).isNotNull()).orderBy(F.col(by).desc()).limit(n)
    values = best.agg(F.collect_list(by)).scalar()
    kept = df.withColumn("_best", values).where(F.col(by) >= F.array_min("_best"))
    above = F.size(F.filter("_best", lambda v: v > F.col(by)))
    return kept.withColumn(rank, (above + 1).cast("bigint")).drop("_best")
