"""Near copies among vectors by an exact metric range join.

Pivots partition the vectors: each belongs to the cell of its nearest pivot, and cells are cut into rings
by the distance to it, rings into blocks of bounded size. The triangle inequality says which rings can
hold a partner within the radius, and only there a vector is sent along. Vectors within half the radius of
one pivot are all linked to each other without a comparison, so a clump, however large, is never compared
with itself. Blocks are joined independently; out come counts, and links enough to connect what is linked.

In data of many independent dimensions distances concentrate and the inequality excludes little; rings
then visit most others and the work is quadratic, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import components, landed, partitions

COSINE = 0.9
#: vectors from which pivots are chosen, pivots at most, and home vectors per block
SAMPLE, PIVOTS, BLOCK = 2048, 64, 4096
#: width of the steps in which distances are counted, and slack for rounding, in radians
STEP, SLACK = 0.02, 1e-6
_VISITORS = 1024


def _units(vectors: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, and which rows have one: not null, finite, not zero."""
    rows = [np.asarray(x, np.float64) if x is not None else np.zeros(0) for x in (
        v.values.to_numpy(zero_copy_only=False) if v.is_valid else None for v in vectors)]
    width = width if width is not None else max((len(x) for x in rows), default=0)
    table = np.zeros((len(rows), width))
    for i, x in enumerate(rows):
        table[i, :len(x)] = x[:width]
    good = np.isfinite(table).all(axis=1) & np.array([len(x) <= width for x in rows], bool)
    table[~good] = 0
    # scaled first, so that squares neither overflow nor vanish
    top = np.abs(table).max(axis=1, initial=0)
    good &= top > 0
    table /= np.where(top > 0, top, 1)[:, None]
    norm = np.sqrt((table * table).sum(axis=1))
    return table / np.where(norm > 0, norm, 1)[:, None], good


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def choose_pivots(units: np.ndarray, n: int, radius: float) -> np.ndarray:
    """`n` of the sampled vectors: first those with the most neighbours, none within the radius of another,
    then whichever is farthest from those chosen."""
    if not len(units):
        return units
    least = math.cos(radius)
    crowd = np.concatenate([((units[i:i + 256] @ units.T) >= least).sum(axis=1) for i in range(0, len(units), 256)])
    near = np.full(len(units), -2.0)
    chosen: list[int] = []
    for i in np.argsort(-crowd, kind="stable"):
        if crowd[i] < 3 or len(chosen) >= n:
            break
        if near[i] < least:
            chosen.append(int(i))
            near = np.maximum(near, units @ units[i])
    while len(chosen) < min(n, len(units)):
        i = int(np.argmin(near))
        if near[i] > 1 - 1e-9:
            break
        chosen.append(i)
        near = np.maximum(near, units @ units[i])
    return units[chosen]


class Rings:
    """How the steps of each cell's distances are packed into rings, and rings into blocks."""

    def __init__(self, n_pivots: int, counts: dict[tuple[int, int], int], radius: float):
        self.radius = radius
        #: steps that end within half the radius make the core of a cell
        self.core_steps = int((radius / 2 - SLACK) / STEP)
        self.of_step: list[np.ndarray] = []
        self.bounds: list[np.ndarray] = []  # per cell: first and last distance of each ring, and its salts
        last = int(math.pi / STEP) + 1
        for p in range(n_pivots):
            own = np.array([counts.get((p, j), 0) for j in range(last + 1)])
            ring = np.zeros(last + 1, np.int64)
            rows: list[list[float]] = []
            for j in range(last + 1):
                # the core is one ring, dealt out by salt alone
                fresh = not rows or j == self.core_steps or (j > self.core_steps and rows[-1][2] and rows[-1][2] + own[j] > BLOCK)
                if fresh:
                    rows.append([j * STEP, 0.0, 0])
                rows[-1][1], rows[-1][2] = (j + 1) * STEP, rows[-1][2] + own[j]
                ring[j] = len(rows) - 1
            self.of_step.append(ring)
            self.bounds.append(np.array([[a, b, math.ceil(n / BLOCK)] for a, b, n in rows]))


def _located(pivots, rings: Rings | None):
    """Per vector: cell, step of its distance, whether it is in the core; or, with rings, its places."""
    def distances(batch: pa.RecordBatch):
        units, good = _units(batch.column("vector"), pivots.value.shape[1])
        return _angle(units @ pivots.value.T), good

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, good = distances(batch)
            rows = np.flatnonzero(good)
            cell = d[rows].argmin(axis=1)
            step = (d[rows, cell] / STEP).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("uid").take(pa.array(rows)), pa.array(cell.astype(np.int32)),
                                              pa.array(step)], names=["uid", "cell", "step"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, core_steps = rings.radius + SLACK, rings.core_steps
        for batch in batches:
            d, good = distances(batch)
            rows = np.flatnonzero(good)
            d, uid = d[rows], batch.column("uid").to_numpy()[rows]
            cell = d.argmin(axis=1)
            near = d.min(axis=1)
            step = (near / STEP).astype(np.int64)
            who, cells, ring, salt, home = [], [], [], [], []
            for p in range(d.shape[1]):
                close = d[:, p] - near <= 2 * r
                core_here = (cell == p) & (step < core_steps)
                for k, (lo, hi, salts) in enumerate(rings.bounds[p]):
                    if not salts:
                        continue
                    core = k == 0 and core_steps > 0
                    visits = close & (d[:, p] >= lo - r) & (d[:, p] <= hi + r)
                    if core:  # linked among themselves already
                        visits &= ~core_here
                    visitors = np.flatnonzero(visits)
                    for s in range(int(salts)):
                        who.append(visitors)
                        cells.append(np.full(len(visitors), p))
                        ring.append(np.full(len(visitors), k))
                        salt.append(np.full(len(visitors), s))
                        home.append(np.zeros(len(visitors), bool))
                own = np.flatnonzero(cell == p)
                if len(own):
                    k = rings.of_step[p][step[own]]
                    who.append(own)
                    cells.append(np.full(len(own), p))
                    ring.append(k)
                    salt.append((uid[own] * np.int64(0x9E3779B97F4A7C1) >> np.int64(20)) % rings.bounds[p][k, 2].astype(np.int64))
                    home.append(np.ones(len(own), bool))
            if not who:
                continue
            who, cells, ring, salt, home = (np.concatenate(x) for x in (who, cells, ring, salt, home))
            for i in range(0, len(who), 20_000):
                w = who[i:i + 20_000]
                yield pa.RecordBatch.from_arrays([
                    *[pa.array(x[i:i + 20_000].astype(np.int32)) for x in (cells, ring, salt)], pa.array(~home[i:i + 20_000]),
                    pa.array(uid[w]), batch.column("vector").take(pa.array(rows[w]))],
                    names=["cell", "ring", "salt", "visitor", "uid", "vector"])
    return send if rings else locate


def _joined(cosine: float, width: int):
    """Per block: how many others each home vector links to, and links (uid, other) that connect all."""
    def compare(homes, home_ids, units, ids):
        """Which homes and visitors link: single precision decides, double near the border."""
        rough = homes.astype(np.float32) @ units.astype(np.float32).T
        linked = rough >= np.float32(cosine)
        a, b = np.nonzero(np.abs(rough - np.float32(cosine)) < 1e-5)
        linked[a, b] = np.einsum("ij,ij->i", homes[a], units[b]) >= cosine
        linked &= home_ids[:, None] != ids[None, :]
        return linked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, homes, home_ids, counts, joined = None, [], [], None, []

        def close():
            if block is not None and counts is not None:
                some = np.flatnonzero(counts)
                yield _out(home_ids[some], np.full(len(some), -1), counts[some])

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("cell", "ring", "salt")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if hi <= lo:
                    continue
                if block != tuple(key[lo]):
                    yield from close()
                    block, homes, home_ids, counts = tuple(key[lo]), [], [], None
                units, _ = _units(batch.column("vector").slice(lo, hi - lo), width)
                ids = batch.column("uid").to_numpy()[lo:hi]
                visits = np.asarray(batch.column("visitor").slice(lo, hi - lo).to_numpy(zero_copy_only=False), bool)
                if (~visits).any():
                    homes.append(units[~visits])
                    home_ids.append(ids[~visits])
                units, ids = units[visits], ids[visits]
                if not len(ids) or not len(homes):
                    continue
                if counts is None:  # homes come first
                    homes, home_ids = np.concatenate(homes), np.concatenate(home_ids)
                    counts = np.zeros(len(home_ids), np.int64)
                for i in range(0, len(ids), _VISITORS):
                    linked = compare(homes, home_ids, units[i:i + _VISITORS], ids[i:i + _VISITORS])
                    counts += linked.sum(axis=1)
                    found = np.flatnonzero(linked.any(axis=0))
                    if len(found):
                        some = linked[:, found]
                        first = some.argmax(axis=0)
                        # every visitor to its first home, every home to the first homes of its visitors
                        yield _out(ids[i + found], home_ids[first], np.zeros(len(found), np.int64))
                        h, v = np.nonzero(some)
                        pairs = np.unique(h * np.int64(len(home_ids)) + first[v])
                        h, f = pairs // len(home_ids), pairs % len(home_ids)
                        own = h != f
                        yield _out(home_ids[h[own]], home_ids[f[own]], np.zeros(int(own.sum()), np.int64))
        yield from close()
    return run


def _out(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (a, b, n)], names=["uid", "other", "n"])


def near_copies(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `embeddings` (vec_id, embedding).

    Two rows link if the cosine of their vectors is at least `cosine`. Vectors that are null, zero or hold
    null or non-finite components link with nothing; vectors shorter than the longest end in zeros. Rows
    that repeat an id are vectors of their own, and link if alike; a row without id takes part, and its
    component's id is the smallest there is (null if there is none; kept is then true).
    """
    spark = embeddings.sparkSession
    radius = math.acos(cosine)
    kind = "array<double>" if "double" in embeddings.schema["embedding"].dataType.simpleString() else "array<float>"
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull())
    rows = landed(embeddings.select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("bigint"),
        F.when(usable, F.col("embedding").cast(kind)).alias("vector")), "vectors")
    valid = rows.where(F.col("vector").isNotNull()).select("uid", "vector")
    n, width = valid.agg(F.count("*"), F.max(F.size("vector"))).first()
    sample = valid.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).select("vector").toArrow().column("vector")
    units, good = _units(sample, width or 0)
    pivots = choose_pivots(units[good], min(PIVOTS, math.ceil((n or 0) / BLOCK)), radius)
    if not len(pivots):
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sent = spark.sparkContext.broadcast(pivots)
    places = landed(valid.mapInArrow(_located(sent, None), "uid bigint, cell int, step int"), "places")
    # as many rows as cells have steps, whatever the number of vectors
    counts = {(r.cell, r.step): r.n for r in places.groupBy("cell", "step").agg(F.count("*").alias("n")).collect()}
    rings = Rings(len(pivots), counts, radius)
    core = places.where(F.col("step") < rings.core_steps)
    cores = core.groupBy("cell").agg(F.min("uid").alias("first"), (F.count("*") - 1).alias("n"))
    in_core = core.join(F.broadcast(cores), "cell").select("uid", F.col("first").alias("other"), "n")

    blocks = valid.mapInArrow(_located(sent, rings), f"cell int, ring int, salt int, visitor boolean, uid bigint, vector {kind}")
    blocks = blocks.repartition(partitions(spark), "cell", "ring", "salt").sortWithinPartitions("cell", "ring", "salt", "visitor")
    found = landed(blocks.mapInArrow(_joined(cosine, width), "uid bigint, other bigint, n bigint"), "found")
    links = found.where("other >= 0").select(F.col("uid").alias("a"), F.col("other").alias("b")).unionByName(
        in_core.where("n > 0").select(F.col("uid").alias("a"), F.col("other").alias("b")))
    comps = components(links).select(F.col("id").alias("uid"), "component")
    n_links = found.where("other < 0").select("uid", "n").unionByName(in_core.select("uid", "n")).groupBy("uid").agg(F.sum("n").alias("n"))
    whole = rows.select("uid", "vec_id").join(comps, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    least = whole.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return whole.join(least, "component").join(n_links, "uid", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
