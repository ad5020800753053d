"""Exact search for the largest inner products by distance to pivots.

Components become whole numbers, ``floor(64 * x)``. Every vector belongs to its nearest pivot
and vectors are sorted by pivot and distance, then cut into chunks: each is an annulus around
its pivot, with an inner and an outer radius. For a query ``q`` at distance ``d`` from the
pivot, a vector ``x`` of an annulus is at least ``gap = max(d - outer, inner - d, 0)`` away,
so by the triangle inequality ``2 q.x <= |q|^2 + |x|^2 - gap^2``; and ``q.x`` is at most ``q.p +
|q| outer``.

Queries go in groups of neighbours, and each has a first bound from its own chunk. Every
annulus that may beat it for a query of the group is sent to the group; the group's task takes
them in the order of their bounds, keeps the best of each query and stops at the first
annulus whose bound is below what all its queries have. So no query is compared with a
vector that a bound excludes, and none is left out: the result is exact. Where bounds exclude
nothing, as among random directions, this is a product of blocks of queries and vectors.

A task holds one group and one batch of chunks at a time. The pivots (at most ``PIVOTS``) and
the annuli's radii (at most about ``ANNULI``; beyond it, neighbouring chunks share one) are
all that goes to every task.

Defined results: vectors that are null or empty, or hold a null or non-finite component, take no part, nor
do rows without ``vec_id``, which nothing could name. A shorter vector counts as filled up with zeros. Each repeated row is a
candidate; rows with the query's own id are not. Repeated equal queries have one
result, and an id with several vectors has each one's. Components and scores beyond 64
bits take the nearest value of 64 bits. Other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import Leaders, Shared, stored

SCALE = 64
TOP = 20
#: Every so many ids is a query.
QUERY_STEP = 20
PIVOTS = 256
#: Vectors for one pivot at least, so that it has several annuli.
PIVOT_ROWS = 4096
ANNULI = 1 << 16
CHUNK_ROWS, CHUNK_BYTES = 1024, 1 << 16
GROUPS, GROUP_LEAST, GROUP_MOST = 16, 64, 2048
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def whole(values) -> np.ndarray | None:
    """``floor(SCALE * x)`` of each component; None for a vector that takes no part."""
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, float)
    if not np.isfinite(vector).all():
        return None
    with np.errstate(over="ignore"):
        scaled = np.floor(vector * SCALE)
    inside = np.clip(scaled, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    inside[scaled >= 2.0**63] = MOST
    return inside


def _size(vector: np.ndarray) -> int:
    return max(abs(int(vector.max())), abs(int(vector.min())))


def _whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [whole(values) for values in batch.column(1).to_pylist()]
        keep = [i for i, v in enumerate(found) if v is not None]
        vectors = [found[i] for i in keep]
        yield pa.record_batch(
            [
                batch.column(0).take(pa.array(keep, pa.int64())),
                pa.array([len(v) for v in vectors], pa.int32()),
                pa.array([min(_size(v), MOST) for v in vectors], pa.int64()),
                pa.array([v.astype(_kind(_size(v))).tobytes() for v in vectors], pa.binary()),
            ],
            ["vec_id", "width", "size", "vec"],
        )


def _kind(size: int) -> np.dtype:
    """The narrowest whole numbers that hold ``size`` with either sign."""
    return np.dtype(next(f"<i{n}" for n in (1, 2, 4, 8) if n == 8 or size < 1 << (8 * n - 1)))


class Space:
    """How vectors of a table are stored and multiplied, and its pivots."""

    def __init__(self, width: int, size: int):
        self.width, self.kind = width, _kind(size)
        most = width * size * size
        #: Doubles hold every product exactly, 64-bit numbers do, or neither.
        self.number = float if most < 1 << 53 else np.int64 if most < 1 << 63 else object
        self.chunk = max(1, min(CHUNK_ROWS, CHUNK_BYTES // (width * self.kind.itemsize)))
        self.pivots = np.zeros((1, width))

    def rows(self, blobs: list[bytes], widths: list[int]) -> np.ndarray:
        out = np.zeros((len(blobs), self.width), self.kind)
        for k, (blob, width) in enumerate(zip(blobs, widths)):
            out[k, :width] = np.frombuffer(blob, f"<i{len(blob) // width}")
        return out

    def matrix(self, blob: bytes) -> np.ndarray:
        return np.frombuffer(blob, self.kind).reshape(-1, self.width)

    def products(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Inner products of rows with rows as 64-bit whole numbers."""
        found = left.astype(self.number) @ right.astype(self.number).T
        if self.number is object:
            found = np.clip(found, LEAST, MOST)
        return found.astype(np.int64)

    def distances(self, rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), len(pivots)))
        for k, pivot in enumerate(pivots):
            out[:, k] = np.linalg.norm(rows - pivot, axis=1)
        return out


def bounds(space: Space, queries: np.ndarray, pivot, inner, outer, norm) -> np.ndarray:
    """No vector of an annulus has a larger product; queries by annuli.

    The arguments are vectors of the same length; ``norm`` is the longest vector's length.
    """
    q = queries.astype(float)
    pivot = np.atleast_1d(pivot)
    own, place = np.unique(pivot, return_inverse=True)
    away = space.distances(q, space.pivots[own])[:, place]
    length = np.linalg.norm(q, axis=1)[:, None]
    gap = np.maximum(np.maximum(away - outer, inner - away), 0)
    far = (length**2 + np.square(norm) - gap**2) / 2
    near = (q @ space.pivots[own].T)[:, place] + length * outer
    # Room for the rounding of distances.
    return np.minimum(far, near) + 1e-9 * (length + np.max(norm, initial=0)) ** 2 + 1e-6


def _keyed(space: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        for batch in batches:
            rows = s.rows(batch.column("vec").to_pylist(), batch.column("width").to_pylist())
            away = s.distances(rows.astype(float), s.pivots)
            own = away.argmin(axis=1) if len(rows) else np.empty(0, int)
            yield pa.record_batch(
                [
                    batch.column("vec_id"),
                    pa.array(own, pa.int32()),
                    pa.array(away[np.arange(len(rows)), own], pa.float64()),
                    pa.array([row.tobytes() for row in rows], pa.binary()),
                ],
                ["vec_id", "pivot", "away", "vec"],
            )

    return run


def _runs(batches: Iterator[pa.RecordBatch], most: int, same: bool) -> Iterator[tuple]:
    """The sorted rows in runs of ``most``, with ``same`` of one pivot each."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and (len(held) == most or same and row[1] != held[0][1]):
                yield tuple(zip(*held))
                held = []
            held.append(row)
    if held:
        yield tuple(zip(*held))


def _first_bounds(space: Space, rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, top: int):
    """For each query the ``top``-th best product with the other rows of its chunk."""
    scores = space.products(rows[queries], rows)
    scores[ids[queries][:, None] == ids] = LEAST
    if scores.shape[1] < top:
        return np.full(len(queries), LEAST)
    return np.partition(scores, -top, axis=1)[:, -top]


def _chunks(space: Shared, step: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, task = space.value, TaskContext.get().partitionId()
        for number, (ids, pivots, away, blobs) in enumerate(_runs(batches, s.chunk, True)):
            ids, rows = np.array(ids, np.int64), s.matrix(b"".join(blobs))
            queries = np.flatnonzero(ids % step == 0)
            floors = _first_bounds(s, rows, ids, queries, top)
            yield pa.record_batch(
                [
                    pa.array([(task << 32) + number], pa.int64()),
                    pa.array([pivots[0]], pa.int32()),
                    pa.array([away[0]]),
                    pa.array([away[-1]]),
                    pa.array([float(np.linalg.norm(rows.astype(float), axis=1).max())]),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([rows.tobytes()], pa.binary()),
                    pa.array([np.array(away).tobytes()], pa.binary()),
                    pa.array([queries.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([floors.tobytes()], pa.binary()),
                ],
                list(CHUNK),
            )

    return run


#: Columns of the index, a row for each chunk.
CHUNK = {
    "chunk": "long",
    "pivot": "int",
    "inner": "double",
    "outer": "double",
    "norm": "double",
    "ids": "binary",
    "vecs": "binary",
    "aways": "binary",
    "queries": "binary",
    "floors": "binary",
}


def _queries(space: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        for batch in batches:
            for row in batch.to_pylist():
                at = np.frombuffer(row["queries"], np.int32)
                yield pa.record_batch(
                    [
                        pa.array(np.frombuffer(row["ids"], np.int64)[at]),
                        pa.array(np.full(len(at), row["pivot"], np.int32)),
                        pa.array(np.frombuffer(row["aways"], float)[at]),
                        pa.array([v.tobytes() for v in s.matrix(row["vecs"])[at]], pa.binary()),
                        pa.array(np.frombuffer(row["floors"], np.int64)),
                    ],
                    ["vec_id", "pivot", "away", "vec", "floor"],
                )

    return run


def _groups(space: Shared, annuli: Shared, size: int):
    """A row with the queries of each group, and one for each annulus it has to look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, task = space.value, TaskContext.get().partitionId()
        names, pivot, inner, outer, norm = annuli.value
        for number, (ids, _, _, blobs, floors) in enumerate(_runs(batches, size, False)):
            rows, floors = s.matrix(b"".join(blobs)), np.array(floors, np.int64)
            best = np.empty(len(names))
            for low in range(0, len(names), 4096):
                cut = slice(low, low + 4096)
                found = bounds(s, rows, pivot[cut], inner[cut], outer[cut], norm[cut])
                found[found < floors[:, None]] = -np.inf
                best[cut] = found.max(axis=0)
            wanted = np.flatnonzero(best > -np.inf)
            many = len(wanted) + 1
            payload = [None] * (many - 1)
            yield pa.record_batch(
                [
                    pa.array(np.full(many, (task << 32) + number)),
                    pa.array([None, *names[wanted].tolist()], pa.int64()),
                    pa.array(np.concatenate([[np.inf], best[wanted]])),
                    pa.array([np.array(ids, np.int64).tobytes(), *payload], pa.binary()),
                    pa.array([rows.tobytes(), *payload], pa.binary()),
                    pa.array([floors.tobytes(), *payload], pa.binary()),
                ],
                ["group", "annulus", "bound", "ids", "vecs", "floors"],
            )

    return run


class Best:
    """The best candidates so far of each query of a group."""

    def __init__(self, space: Space, ids: np.ndarray, rows: np.ndarray, floors: np.ndarray, top: int):
        self.space, self.ids, self.rows, self.top = space, ids, rows, top
        self.leaders = Leaders(floors, top)

    def look(self, row: dict) -> None:
        """Compares the queries that the row's bounds leave open with the vectors of its chunk."""
        limit = bounds(self.space, self.rows, row["pivot"], row["inner"], row["outer"], row["norm"])
        least = self.leaders.least
        open_ = np.flatnonzero(limit[:, 0] >= least)
        if not len(open_):
            return
        ids = np.frombuffer(row["ids"], np.int64)
        scores = self.space.products(self.rows[open_], self.space.matrix(row["vecs"]))
        other = ids != self.ids[open_][:, None]
        good = other & (scores >= least[open_][:, None])
        if len(ids) > self.top:
            # Of a chunk only its own best can count; equal ones stay, ids decide later.
            within = np.where(other, scores, LEAST)
            good &= scores >= np.partition(within, -self.top, axis=1)[:, -self.top][:, None]
        query, place = np.nonzero(good)
        self.leaders.merge(open_[query], ids[place], scores[query, place])

    def result(self) -> pa.RecordBatch:
        query = self.leaders.query
        rank = np.arange(len(query)) - np.searchsorted(query, query) + 1
        return pa.record_batch(
            [
                pa.array(self.ids[query]),
                pa.array(rank.astype(np.int32)),
                pa.array(self.leaders.found),
                pa.array(self.leaders.score),
            ],
            ["query_id", "rank", "vec_id", "score"],
        )


def _search(space: Shared, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, stopped = None, False
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["pivot"] is None:
                    if best is not None:
                        yield best.result()
                    ids = np.frombuffer(row["ids"], np.int64)
                    floors = np.frombuffer(row["floors"], np.int64)
                    best = Best(space.value, ids, space.value.matrix(row["vecs"]), floors, top)
                    stopped = False
                elif not stopped:
                    # Later annuli of the group have no larger bound.
                    stopped = bool((best.leaders.least > row["bound"]).all())
                    if not stopped:
                        best.look(row)
        if best is not None:
            yield best.result()

    return run


def search(
    embeddings: DataFrame, top: int = TOP, step: int = QUERY_STEP, pivots: int = PIVOTS
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``top`` best of each query.

    Queries are the rows whose ``vec_id`` is divisible by ``step``.
    """
    spark = embeddings.sparkSession
    named = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = stored(
        named.filter("vec_id IS NOT NULL").mapInArrow(
            _whole_rows, "vec_id long, width int, size long, vec binary"
        ),
        "whole",
    )
    wanted = F.col("vec_id") % step == 0
    facts = rows.agg(
        F.count("*").alias("n"),
        F.count_if(wanted).alias("queries"),
        F.max("width").alias("width"),
        F.max("size").alias("size"),
    ).first()
    shape = Space(facts["width"] or 1, facts["size"] or 0)
    many = max(1, min(pivots, facts["n"] // PIVOT_ROWS))
    picked = rows.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(many).collect()
    if picked:
        own = shape.rows([bytes(r["vec"]) for r in picked], [r["width"] for r in picked])
        shape.pivots = np.unique(own.astype(float), axis=0)
    space = Shared(spark, shape)
    place = ["pivot", "away", "vec_id"]
    index = stored(
        rows.mapInArrow(_keyed(space), "vec_id long, pivot int, away double, vec binary")
        .repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .mapInArrow(_chunks(space, step, top), ", ".join(map(" ".join, CHUNK.items()))),
        "index",
    )
    # Chunks that lie side by side share an annulus where there are too many of them.
    run = max(1, -(-index.count() // ANNULI))
    index = index.withColumn("annulus", F.expr(f"chunk div {run} * 256 + pivot"))
    listed = (
        index.groupBy("annulus", "pivot")
        .agg(F.min("inner"), F.max("outer"), F.max("norm"))
        .toDF("annulus", "pivot", "inner", "outer", "norm")
        .toPandas()
    )
    annuli = Shared(spark, tuple(listed[name].to_numpy() for name in listed.columns))
    size = max(GROUP_LEAST, min(GROUP_MOST, -(-facts["queries"] // GROUPS)))
    groups = stored(
        index.filter("length(queries) > 0")
        .mapInArrow(_queries(space), "vec_id long, pivot int, away double, vec binary, floor long")
        .dropDuplicates(["vec_id", "vec"])
        .repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .mapInArrow(
            _groups(space, annuli, size),
            "group long, annulus long, bound double, ids binary, vecs binary, floors binary",
        ),
        "groups",
    )
    none = F.lit(None)
    asked = groups.filter("annulus IS NULL").select(
        "group",
        "bound",
        none.cast("int").alias("pivot"),
        *[none.cast("double").alias(name) for name in ("inner", "outer", "norm")],
        "ids",
        "vecs",
        "floors",
    )
    sent = (
        groups.filter("annulus IS NOT NULL")
        .select("group", "bound", "annulus")
        .join(index.drop("floors", "queries", "aways"), "annulus")
        .select(
            "group", "bound", "pivot", "inner", "outer", "norm", "ids", "vecs",
            none.cast("binary").alias("floors"),
        )
    )
    return (
        asked.unionByName(sent)
        .repartition("group")
        .sortWithinPartitions("group", F.desc("bound"))
        .mapInArrow(_search(space, top), "query_id long, rank int, vec_id long, score long")
    )
