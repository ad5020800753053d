"""What the operators of this subpackage share: scratch tables, word hashes, components."""

from __future__ import annotations

import atexit
import pickle
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        key = context.applicationId
        named = _FALLBACK.setdefault(key, tempfile.mkdtemp(prefix="llm-"))
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    if jvm is None or spark.sparkContext._jsc is None:
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is there goes when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_quietly_delete, spark, path)
    return path


def _quietly_delete(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # the gateway may have gone first
        pass


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def tuned(spark: SparkSession) -> SparkSession:
    """``spark`` with Arrow batches that whole texts do not make large.

    The default of 10,000 rows is meant for narrow rows; another setting is left as it is.
    """
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    return spark


class Shared:
    """A broadcast value of a class of this package, pickled by value like its functions."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._value = None

    def __getstate__(self):
        return {"_sent": self._sent, "_value": None}

    @property
    def value(self):
        if self._value is None:
            self._value = pickle.loads(self._sent.value)
        return self._value


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tree_reduced(parts: DataFrame, key: str, merge, schema: str, fan: int = 64) -> DataFrame:
    """Merges the rows of each ``key``, at most ``fan`` in one group, level by level.

    ``part`` numbers the rows of a key; ``merge`` gives one row for a frame, with any of
    the frame's numbers.
    """
    last = parts.agg(F.max("part").alias("n")).first()["n"]
    rows = last + 1 if last is not None else 0
    while rows > 1:
        rows = -(-rows // fan)
        parts = (
            parts.withColumn("part", F.floor(F.col("part") / fan))
            .groupBy(key, "part")
            .applyInPandas(merge, schema)
        )
    return parts


BITMAP_BITS = 26


class Bitmap:
    """Whether a 64-bit code may be among given ones, by its first bits; 8 MB whatever their number."""

    def __init__(self, words: np.ndarray):
        self.bytes = words.view(np.uint8)

    def may_have(self, codes: np.ndarray) -> np.ndarray:
        at = (codes.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
        return (self.bytes[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flags = np.zeros(1 << BITMAP_BITS, bool)
    for batch in batches:
        codes = batch.column(0).to_numpy().view(np.uint64)
        flags[(codes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)] = True
    words = np.packbits(flags).view(np.int64)
    there = np.flatnonzero(words)
    yield pa.record_batch([pa.array(there), pa.array(words[there])], ["word", "bits"])


def bitmap(codes: DataFrame) -> Shared:
    """A ``Bitmap`` of the codes of a frame with one column of 64-bit numbers."""
    found = (
        codes.mapInArrow(_bits, "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toPandas()
    )
    words = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return Shared(codes.sparkSession, Bitmap(words))


def uniform(*columns) -> F.Column:
    """A number of [0, 1) that only the columns' values decide."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


_WINDOW = 1 << 20
_POWER = 0x9E3779B97F4A7C15
#: ASCII white space and space: what separates words.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: All ASCII but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class WordCodes:
    """64-bit codes of the words of many texts at once.

    A word is a run of bytes between separators. Its code is a polynomial of table values
    of its bytes, summed over the buffer of an Arrow column, so no word becomes a Python
    object. Case is ignored for A-Z; with ``latin`` also for two-byte Latin letters, and
    general punctuation then separates words as well.
    """

    def __init__(self, separators: np.ndarray = SPACE, latin: bool = False):
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.lower, self.latin, self.word = lower, latin, ~separators
        rng = np.random.default_rng(20)
        self.values = rng.integers(0, 1 << 64, 256, np.uint64)
        self._grow(_WINDOW)

    def _grow(self, size: int) -> None:
        inverse = pow(_POWER, -1, 1 << 64)
        self.powers = np.multiply.accumulate(np.full(size, _POWER, np.uint64))
        self.inverses = np.multiply.accumulate(np.full(size, inverse, np.uint64))

    def _window(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and codes of the words of ``data``; no word runs over a break."""
        is_word = self.word[data]
        data = self.lower[data]
        if self.latin:
            pairs = data[:-1] == 0xC3
            upper = pairs & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
            data[1:][upper] += 0x20
            marks = np.flatnonzero(data[:-1] == 0xC2)
            is_word[marks] = is_word[marks + 1] = False
            marks = np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] & 0xFE) == 0x80))
            is_word[marks] = is_word[marks + 1] = is_word[marks + 2] = False
        first = is_word.copy()
        first[1:] &= ~is_word[:-1]
        first[breaks] = is_word[breaks]
        starts = np.flatnonzero(first)
        if not len(starts):
            return starts, np.empty(0, np.uint64)
        if len(data) > len(self.powers):
            self._grow(len(data))
        terms = self.values[data]
        terms *= self.powers[: len(data)]
        terms *= is_word
        return starts, mixed(np.add.reduceat(terms, starts) * self.inverses[starts])

    def of(self, column: pa.Array) -> list[np.ndarray]:
        """The words of each text, in order; none for a null."""
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, offsets, values = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        if values is None or not len(column):
            return [np.empty(0, np.uint64)] * len(column)
        data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        places, codes, low = [], [], 0
        while low < len(data):
            high = self._cut(data, offsets, low)
            inside = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high)] - low
            starts, found = self._window(data[low:high], inside)
            places.append(starts + low)
            codes.append(found)
            low = high
        if not places:
            return [np.empty(0, np.uint64)] * len(column)
        places, codes = np.concatenate(places), np.concatenate(codes)
        return np.split(codes, np.searchsorted(places, offsets[1:-1]))

    def _cut(self, data: np.ndarray, offsets: np.ndarray, low: int) -> int:
        """Where a window from ``low`` can end: at a text's start or after a separator."""
        high = low + _WINDOW
        if high >= len(data):
            return len(data)
        start = offsets[np.searchsorted(offsets, high, side="right") - 1]
        if start > low:
            return int(start)
        gaps = np.flatnonzero(~self.word[data[low:high]])
        if len(gaps):
            return low + int(gaps[-1]) + 1
        end = int(offsets[np.searchsorted(offsets, high, side="left")])
        gaps = np.flatnonzero(~self.word[data[high:end]])
        return high + int(gaps[0]) + 1 if len(gaps) else end


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Views of fewer rows each, so that what is made of a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Leaders:
    """The best ``top`` candidates so far of each query, equal scores by ascending id.

    ``least`` is the score that a candidate of a query must have.
    """

    def __init__(self, least: np.ndarray, top: int):
        self.least, self.top = least.copy(), top
        self.query, self.found, self.score = (np.empty(0, np.int64) for _ in range(3))

    def merge(self, query: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        if not len(query):
            return
        query = np.concatenate([self.query, query])
        found = np.concatenate([self.found, found])
        score = np.concatenate([self.score, score])
        # The complement turns the order round without leaving 64 bits.
        order = np.lexsort((found, ~score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.top
        self.query, self.found, self.score = query[keep], found[order[keep]], score[order[keep]]
        last = rank[keep] == self.top - 1
        self.least[self.query[last]] = self.score[last]


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0 to ``count`` - 1 the smallest node that the links reach."""
    parent = np.arange(count)
    while True:
        a, b = parent[left], parent[right]
        low = np.minimum(a, b)
        if np.array_equal(a, b):
            return parent
        np.minimum.at(parent, a, low)
        np.minimum.at(parent, b, low)
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the links of a partition by as many as connect the same nodes."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    a, b = (np.concatenate(side) for side in zip(*parts))
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = roots(len(nodes), index[: len(a)], index[len(a) :])
    child = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.record_batch([pa.array(nodes[child]), pa.array(nodes[root[child]])], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for the nodes of ``links``.

    ``links`` has two columns of integers. Partitions first keep a spanning forest of their
    links; alternating large and small stars then join the forests, each round written to
    the checkpoint folder. Nodes without a link have no row.
    """
    shared_folder(links.sparkSession)
    first, second = links.columns
    edges = (
        links.select(
            F.greatest(first, second).cast("long").alias("u"),
            F.least(first, second).cast("long").alias("v"),
        )
        .filter("u != v")
        .mapInArrow(_forest, "u long, v long")
        .distinct()
        .checkpoint()
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(lowest, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .filter("u != v")
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = (
            large.join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .filter("u != v")
            .distinct()
            .checkpoint()
        )
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
