"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by rounds of random signs and fast Hadamard transforms; its hash is the
axis, with its sign, that it comes to lie closest to. Several such hashes side by side are
a table's code. Every vector is stored in one bucket of each table and looks into several:
multiprobe goes to the codes with the next best axes. Vectors that meet are compared by
sketches of random signs first, and then by their cosine in double precision.

How many hashes make a code follows from the number of vectors, so that buckets stay small
as they grow in number; how many tables there are follows from the chance that a pair just
at the threshold meets, which is simulated with the same transforms, so that the recall of
the hardest pairs is ``RECALL`` at every size.

Equal vectors are one row of the work and links between them are counted, not listed, so a
vector that a third of all rows share costs what one row does.

Defined results: vectors that are null, empty or zero, or that hold a null or non-finite
component, link with nothing and are their own component, as do vectors of unlike length
with each other; rows with one ``vec_id`` are one vector if they are equal, else each
row has its own vector's links and they share a component; a null ``vec_id`` is kept, without links and
with a null component; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import components, mixed, stored

THRESHOLD = 0.9
RECALL = 0.995
PROBES = 4
ROUNDS = 3
BUCKET = 16
MAX_TABLES = 64
SKETCH_BITS = 256
SEED = 11


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; its length is a power of two."""
    count, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(count, -1, 2, step)
        rows = np.stack(
            [pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2
        ).reshape(count, width)
        step *= 2
    return rows / math.sqrt(width)


def padded(rows: np.ndarray) -> np.ndarray:
    width = 1 << max(1, (rows.shape[1] - 1).bit_length())
    out = np.zeros((len(rows), width))
    out[:, : rows.shape[1]] = rows
    return out


def turned(rows: np.ndarray, number: int) -> np.ndarray:
    """Rotation ``number`` of unit rows, the same in every task."""
    rng = np.random.default_rng([SEED, number, rows.shape[1]])
    for signs in rng.choice([-1.0, 1.0], size=(ROUNDS, rows.shape[1])):
        rows = hadamard(rows * signs)
    return rows


def codes(rows: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """Codes of a table for each row: its own, then those of the likeliest other axes.

    A probe replaces one hash by that hash's second or third axis, or two hashes by their
    second; it costs what the axes lose in length against the closest.
    """
    width = rows.shape[1]
    axes, losses = [], []
    for k in range(hashes):
        far = turned(rows, table * hashes + k)
        size = np.abs(far)
        top = np.argpartition(-size, min(3, width - 1), axis=1)[:, : min(3, width)]
        own = np.take_along_axis(size, top, axis=1)
        order = np.argsort(-own, axis=1, kind="stable")
        top, own = np.take_along_axis(top, order, axis=1), np.take_along_axis(own, order, axis=1)
        sign = np.take_along_axis(far, top, axis=1) < 0
        axes.append((top * 2 + sign).astype(np.uint64))
        losses.append(own[:, :1] ** 2 - own**2)
    choices, prices = [np.zeros(hashes, int)], [np.zeros(len(rows))]
    for k in range(hashes):
        for other in range(1, axes[k].shape[1]):
            choice = np.zeros(hashes, int)
            choice[k] = other
            choices.append(choice)
            prices.append(losses[k][:, other])
        for j in range(k):
            choice = np.zeros(hashes, int)
            choice[[j, k]] = 1
            choices.append(choice)
            prices.append(losses[j][:, 1] + losses[k][:, 1])
    every = []
    for choice in choices:
        code = np.full(len(rows), table + 1, np.uint64)
        for k, pick in enumerate(choice):
            code = code * np.uint64(2 * width + 1) + axes[k][:, min(pick, axes[k].shape[1] - 1)]
        every.append(mixed(code))
    every, prices = np.stack(every, axis=1), np.stack(prices, axis=1)
    best = np.argsort(prices, axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(every, best, axis=1)


def plan(count: int, width: int, threshold: float, probes: int = PROBES) -> tuple[int, int]:
    """Hashes in a code and tables, for ``count`` vectors of a length."""
    size = 1 << max(1, (width - 1).bit_length())
    hashes = max(1, math.ceil(math.log(max(2.0, count / BUCKET)) / math.log(2 * size)))
    rng = np.random.default_rng([SEED, count.bit_length(), width])
    first = rng.normal(size=(4000, width))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other = rng.normal(size=first.shape)
    other -= (other * first).sum(1, keepdims=True) * first
    other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-12)
    second = threshold * first + math.sqrt(max(0.0, 1 - threshold**2)) * other
    mine, theirs = (codes(padded(v), 0, hashes, probes) for v in (first, second))
    met = (mine[:, :1] == theirs).any(axis=1) | (theirs[:, :1] == mine).any(axis=1)
    chance = min(0.999, max(1e-9, met.mean()))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - chance))
    if tables > MAX_TABLES:
        raise ValueError(f"{tables} tables would be needed; the threshold is too low for this index")
    return hashes, max(2, tables)


def sketch_limit(threshold: float) -> int:
    """Differing sketch bits beyond which a pair at the threshold lies with 1 in 10^7."""
    share = math.acos(min(1.0, threshold)) / math.pi
    return math.ceil(SKETCH_BITS * share + 5.2 * math.sqrt(SKETCH_BITS * share * (1 - share)))


def _unit(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length one in double precision; None for those that link with nothing."""
    out = []
    for values in column.to_pylist():
        if not values or any(v is None for v in values):
            out.append(None)
            continue
        vector = np.array(values, float)
        size = np.abs(vector).max()
        if not np.isfinite(size) or not np.isfinite(vector).all() or size == 0:
            out.append(None)
            continue
        vector = vector / size
        out.append(vector / np.linalg.norm(vector))
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's vector in double precision with its digest; none where nothing can link."""
    for batch in batches:
        units = _unit(batch.column(1))
        blobs = [None if u is None else u.tobytes() for u in units]
        digests = [None if b is None else xxhash.xxh3_128_digest(b) for b in blobs]
        widths = [None if u is None else len(u) for u in units]
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(digests, pa.binary()),
                pa.array(widths, pa.int32()),
                pa.array(blobs, pa.binary()),
            ],
            ["vec_id", "digest", "width", "unit"],
        )


def _buckets(plans: dict[int, tuple[int, int]], probes: int):
    """A row for each bucket that a vector is stored in or looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, widths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            blobs = batch.column(2).to_pylist()
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                rows = padded(np.stack([np.frombuffer(blobs[i], float) for i in at]))
                rng = np.random.default_rng([SEED, 1, rows.shape[1]])
                planes = rng.normal(size=(rows.shape[1], SKETCH_BITS))
                words = np.packbits(rows @ planes > 0, axis=1).view(np.int64)
                hashes, tables = plans[int(width)]
                for table in range(tables):
                    code = codes(rows, table, hashes, probes).view(np.int64)
                    many = code.shape[1]
                    yield pa.record_batch(
                        [
                            pa.array(np.repeat(ids[at], many)),
                            pa.array(np.full(len(at) * many, width, np.int32)),
                            pa.array(code.ravel()),
                            pa.array(np.tile(np.arange(many) == 0, len(at))),
                            *(pa.array(np.repeat(words[:, w], many)) for w in range(words.shape[1])),
                        ],
                        ["node", "width", "code", "home", "s0", "s1", "s2", "s3"],
                    )

    return run


def _cosines(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first, second = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = []
            for x, y in zip(first, second):
                keep.append(float(np.frombuffer(x, float) @ np.frombuffer(y, float)) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def links(vectors: DataFrame, threshold: float, probes: int = PROBES) -> DataFrame:
    """Pairs ``a`` < ``b`` of ``node`` whose vectors' cosine is at least ``threshold``.

    ``vectors`` has ``node``, ``width`` and ``unit``, each vector once.
    """
    counts = vectors.groupBy("width").count().collect()
    plans = {r["width"]: plan(r["count"], r["width"], threshold, probes) for r in counts}
    rows = vectors.select("node", "width", "unit").mapInArrow(
        _buckets(plans, probes),
        "node long, width int, code long, home boolean, s0 long, s1 long, s2 long, s3 long",
    )
    homes = stored(rows, "buckets")
    left, right = homes.alias("l"), homes.filter("home").alias("r")
    differ = sum(
        (F.bit_count(F.col(f"l.s{w}").bitwiseXOR(F.col(f"r.s{w}"))) for w in range(4)), F.lit(0)
    )
    pairs = (
        left.join(
            right,
            (F.col("l.code") == F.col("r.code"))
            & (F.col("l.width") == F.col("r.width"))
            & (F.col("l.node") != F.col("r.node"))
            & (differ <= sketch_limit(threshold)),
        )
        .select(
            F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")
        )
        .distinct()
    )
    units = vectors.select("node", "unit")
    return (
        pairs.join(units.toDF("a", "x"), "a")
        .join(units.toDF("b", "y"), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(_cosines(threshold), "a long, b long")
    )


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for each row."""
    rows = stored(
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
            _keys, "vec_id long, digest binary, width int, unit binary"
        ),
        "vectors",
    )
    usable = rows.filter("digest is not null and vec_id is not null")
    # The node of a class is a number of its own: one id may stand for several vectors. It is
    # stored with the class, so no two classes share one and every read has the same.
    nodes = stored(
        usable.select("vec_id", "digest", "width").distinct()
        .groupBy("digest", "width")
        .agg(F.min("vec_id").alias("leader"), F.count("*").alias("members"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    leaders = (
        usable.join(nodes.select("digest", "leader", "node"), "digest")
        .filter("vec_id = leader")
        .select("node", "width", "unit")
        .dropDuplicates(["node"])
    )
    found = stored(links(stored(leaders, "leaders"), threshold), "links")
    both = found.union(found.select("b", "a")).toDF("node", "other")
    reached = (
        both.join(nodes.select(F.col("node").alias("other"), "members"), "other")
        .groupBy("node")
        .agg(F.sum("members").alias("reached"))
    )
    # Components of ids: links between leaders, and between the vectors of one id.
    names = nodes.select("node", "leader")
    between = found.join(names.toDF("a", "u"), "a").join(names.toDF("b", "v"), "b").select("u", "v")
    ids = usable.select("vec_id", "digest").distinct().join(nodes.select("digest", "leader"), "digest")
    several = ids.groupBy("vec_id").agg(F.min("leader").alias("u"), F.max("leader").alias("z"))
    several = several.filter("u != z").select("vec_id", "u")
    joined = ids.join(several, "vec_id").filter("leader != u").select("u", F.col("leader").alias("v"))
    groups = components(between.union(joined)).toDF("leader", "component")
    per_class = (
        nodes.join(reached, "node", "left")
        .join(groups, "leader", "left")
        .select(
            "digest",
            (F.col("members") - 1 + F.coalesce("reached", F.lit(0))).alias("own"),
            F.coalesce("component", "leader").alias("component"),
        )
    )
    return (
        rows.select("vec_id", "digest")
        .join(per_class, "digest", "left")
        .select(
            "vec_id",
            F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("own", F.lit(0))).cast("long").alias("n_links"),
            F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
