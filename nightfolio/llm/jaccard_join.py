"""N-gram Jaccard join: a blocked sparse product of the document by n-gram matrix.

A document is the set of its distinct word shingles; two link when their sets' Jaccard
similarity is at least ``percent`` / 100. The n-grams stand in one global order, those in
crowded hash buckets last, and a document enters the product with as many of its first
n-grams as any partner must share one of. These columns are dealt into blocks; a block
multiplies its part of the matrix with its transpose, adds up the overlaps of pairs, and
drops pairs whose sizes and positions keep the overlap below the bound. What is left is
decided by the exact overlap of the whole sets.

Documents with equal sets are one row of the matrix. In a column with more than ``CROWD``
rows only leaders are paired with the others at first; the column is paired further, tile
by tile, only where its rows are still in different components. So a group
of copies costs about its size, and no link between components is lost.

Defined results: a null or empty text and one of white space have no n-gram and link with
nothing; a text of fewer words than a shingle is one n-gram; rows with one ``doc_id`` are
one document and share its component; a null ``doc_id`` is kept, links with nothing and has
a null component; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import WordCodes, components, mixed, sliced, stored, tree_reduced

WORDS = 5
PERCENT = 80
#: Buckets that count n-grams: a fixed size, since they only order the n-grams.
BUCKET_BITS, SEGMENTS = 20, 64
#: N-grams in a block of the product.
BLOCK_ENTRIES = 400_000
#: Rows of a column that are paired at once.
CROWD = 8
#: Rows on each side of a tile of a crowded column.
TILE = 2048
_FACTOR = 0x9E3779B97F4A7C13


def shingles(codes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """The sorted 64-bit fingerprints of the distinct shingles of a text's word codes."""
    if not len(codes):
        return codes
    width = min(words, len(codes))
    span = len(codes) - width + 1
    joined = codes[:span].copy()
    for step in range(1, width):
        joined *= np.uint64(_FACTOR)
        joined += codes[step : step + span]
    joined += np.uint64(width)
    return np.unique(mixed(joined))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _signatures(words: int):
    """For each document its set's size and digest; at the end the bucket counts, with the
    number of the task as ``doc_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCodes()
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        names = ["doc_id", "n", "high", "low", "segment", "counts"]
        for batch in sliced(batches):
            sizes, high, low, pending = [], [], [], []
            for codes in coder.of(batch.column(1)):
                own = shingles(codes, words)
                digest = xxhash.xxh3_128_digest(own.tobytes())
                sizes.append(len(own))
                high.append(int.from_bytes(digest[:8], "big", signed=True))
                low.append(int.from_bytes(digest[8:], "big", signed=True))
                pending.append(own)
            if not pending:
                continue
            buckets = (np.concatenate(pending) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            counts += np.bincount(buckets, minlength=len(counts)).astype(np.uint32)
            rows = batch.num_rows
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.binary()),
                ],
                names,
            )
        if counts.any():
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, SEGMENTS)]
            yield pa.record_batch(
                [pa.array([TaskContext.get().partitionId()] * SEGMENTS, pa.int64())]
                + [pa.nulls(SEGMENTS, pa.int64())] * 3
                + [pa.array(range(SEGMENTS), pa.int32()), pa.array(parts, pa.binary())],
                names,
            )

    return run


def _add_counts(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros((1 << BUCKET_BITS) // SEGMENTS, np.uint64)
    for part in frame["counts"]:
        total += np.frombuffer(zlib.decompress(part), np.uint32)
    total = np.minimum(total, (1 << 31) - 1).astype(np.uint32)
    return pd.DataFrame(
        {
            "segment": frame["segment"].iloc[:1].to_numpy(),
            "part": frame["part"].iloc[:1].to_numpy(),
            "counts": [zlib.compress(total.tobytes(), 1)],
        }
    )


def _bucket_counts(signatures: DataFrame) -> np.ndarray:
    """How many n-grams of all documents fall into each bucket, at most 2^20."""
    parts = signatures.filter("segment is not null").select(
        "segment", F.col("doc_id").alias("part"), "counts"
    )
    rows = tree_reduced(parts, "segment", _add_counts, "segment int, part long, counts binary")
    total = np.zeros(1 << BUCKET_BITS, np.uint32)
    width = len(total) // SEGMENTS
    for row in rows.collect():
        total[row["segment"] * width :][:width] = np.frombuffer(
            zlib.decompress(row["counts"]), np.uint32
        )
    return np.minimum(total, (1 << 20) - 1)


def _prefix_length(sizes, percent: int):
    return sizes - (sizes * percent + 99) // 100 + 1


def _prefixes(counts, words: int, percent: int):
    """A document's first n-grams in the global order, as keys: bucket count, then hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, crowds = WordCodes(), counts.value.astype(np.uint64)
        for batch in sliced(batches):
            ids, sizes, blobs = [], [], []
            for doc, codes in zip(batch.column(0).to_pylist(), coder.of(batch.column(1))):
                own = shingles(codes, words)
                if not len(own):
                    continue
                crowd = crowds[(own >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                keys = (crowd << np.uint64(44)) | (own & np.uint64((1 << 44) - 1))
                length = _prefix_length(len(own), percent)
                if length < len(keys):
                    keys = np.partition(keys, length - 1)[:length]
                keys.sort()
                ids.append(doc)
                sizes.append(len(own))
                blobs.append(keys.tobytes())
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                ["doc_id", "n", "keys"],
            )

    return run


def _tiles(blocks: int):
    """Cuts rows of the matrix into the parts of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            docs = batch.column(0).to_numpy()
            sizes = batch.column(1).to_numpy()
            blobs = batch.column(2).to_pylist()
            keys = np.frombuffer(b"".join(blobs), np.uint64)
            lengths = np.fromiter((len(b) // 8 for b in blobs), np.int64, len(blobs))
            rows = np.repeat(np.arange(len(docs)), lengths)
            starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
            places = np.arange(len(keys)) - starts
            block = (mixed(keys.copy()) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            block = block[order]
            cuts = np.flatnonzero(np.diff(block, prepend=-1))
            out = []
            for begin, end in zip(cuts, [*cuts[1:], len(block)]):
                part = order[begin:end]
                used, local = np.unique(rows[part], return_inverse=True)
                out.append(
                    (
                        int(block[begin]),
                        keys[part].tobytes(),
                        local.astype(np.uint32).tobytes(),
                        places[part].astype(np.uint32).tobytes(),
                        docs[used].tobytes(),
                        sizes[used].astype(np.uint32).tobytes(),
                    )
                )
            columns = list(zip(*out))
            yield pa.record_batch(
                [pa.array(columns[0], pa.int64())] + [pa.array(c, pa.binary()) for c in columns[1:]],
                ["block", "keys", "rows", "places", "docs", "sizes"],
            )

    return run


def _may_link(na, nb, pa_, pb, percent: int) -> np.ndarray:
    """Whether sizes, and what can follow the shared column, allow the overlap needed."""
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    most = np.minimum(na - pa_, nb - pb)
    return (100 * small >= percent * large) & ((100 + percent) * most >= percent * (na + nb))


def _run_lengths(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of a sorted array how many of its run follow it, and the run's length."""
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    lengths = np.diff(np.append(cuts, len(keys)))
    ends = np.repeat(cuts + lengths, lengths)
    return ends - np.arange(len(keys)) - 1, np.repeat(lengths, lengths)


def _pairs_of(keys, docs, sizes, places, after, lengths, percent: int):
    """Pairs within runs of one column: all of small runs, leaders with the rest of others.

    Rows of a crowded column fall into classes whose sizes are within the bound. Where the
    column stands earliest in its document, most of the document can still be shared: the
    first two rows of a class by place are its leaders, for their own class and the next.
    """
    left, right = [], []

    def add(a, b):
        good = _may_link(sizes[a], sizes[b], places[a], places[b], percent)
        good &= docs[a] != docs[b]
        left.append(a[good])
        right.append(b[good])

    for step in range(1, CROWD):
        a = np.flatnonzero((after >= step) & (lengths <= CROWD))
        if not len(a):
            break
        add(a, a + step)
    crowded = np.flatnonzero(lengths > CROWD)
    if len(crowded):
        run = np.cumsum(np.concatenate(([False], keys[crowded][1:] != keys[crowded][:-1])))
        level = (np.log(sizes[crowded]) / np.log(100 / percent)).astype(np.int64)
        group = run * 1024 + level
        order = np.lexsort((docs[crowded], places[crowded], group))
        ranked = group[order]
        names, first, many = np.unique(ranked, return_index=True, return_counts=True)
        for shift in (-1, 0, 1):
            at = np.searchsorted(names, group + shift)
            there = (at < len(names)) & (names[np.minimum(at, len(names) - 1)] == group + shift)
            for rank in (0, 1):
                some = np.flatnonzero(there)
                some = some[many[at[some]] > rank]
                add(crowded[order[first[at[some]] + rank]], crowded[some])
    if not left:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate(left), np.concatenate(right)


_PAIR_COLUMNS = ["a", "b", "overlap", "key", "doc", "n", "place"]
_PAIR_SCHEMA = "a long, b long, overlap long, key long, doc long, n long, place long"


def _product(percent: int):
    """Multiplies a block: pairs with the overlap found in it, and rows of crowded columns."""

    def block_rows(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([np.frombuffer(p[0], np.uint64) for p in parts])
        docs, sizes, places = [], [], []
        for part in parts:
            rows = np.frombuffer(part[1], np.uint32)
            docs.append(np.frombuffer(part[3], np.int64)[rows])
            sizes.append(np.frombuffer(part[4], np.uint32)[rows].astype(np.int64))
            places.append(np.frombuffer(part[2], np.uint32).astype(np.int64))
        docs, sizes, places = map(np.concatenate, (docs, sizes, places))
        order = np.argsort(keys)
        after, lengths = _run_lengths(keys[order])
        order = order[lengths > 1]
        order = order[np.lexsort((docs[order], sizes[order], keys[order]))]
        if not len(order):
            return
        keys, docs, sizes, places = keys[order], docs[order], sizes[order], places[order]
        after, lengths = _run_lengths(keys)
        left, right = _pairs_of(keys, docs, sizes, places, after, lengths, percent)
        a, b = np.minimum(docs[left], docs[right]), np.maximum(docs[left], docs[right])
        if len(a):
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            overlap = np.diff(np.append(new, len(a)))
            empty = pa.nulls(len(new), pa.int64())
            yield pa.record_batch(
                [pa.array(a[new]), pa.array(b[new]), pa.array(overlap)] + [empty] * 4,
                _PAIR_COLUMNS,
            )
        crowd = np.flatnonzero(lengths > CROWD)
        if len(crowd):
            yield pa.record_batch(
                [pa.nulls(len(crowd), pa.int64())] * 3
                + [
                    pa.array(_signed(keys[crowd])),
                    pa.array(docs[crowd]),
                    pa.array(sizes[crowd]),
                    pa.array(places[crowd]),
                ],
                _PAIR_COLUMNS,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for block, *part in zip(*columns):
                if block != current and parts:
                    yield from block_rows(parts)
                    parts = []
                current = block
                parts.append(part)
        if parts:
            yield from block_rows(parts)

    return run


def _tile_pairs(percent: int):
    """Pairs of different components within the tiles of crowded columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        names = ("tile", "side", "doc", "n", "place", "component")
        tile, side, docs, sizes, places, comps = (table[c].to_numpy() for c in names)
        order = np.lexsort((docs, sizes, tile))
        tile, side, docs, sizes, places, comps = (
            v[order] for v in (tile, side, docs, sizes, places, comps)
        )
        after, _ = _run_lengths(tile)
        step = 0
        while True:
            step += 1
            a = np.flatnonzero(after >= step)
            if not len(a):
                return
            b = a + step
            # Side 0 and 1 face each other; side 2 is a tile on the diagonal.
            good = (comps[a] != comps[b]) & ((side[a] == 2) | (side[a] != side[b]))
            good &= _may_link(sizes[a], sizes[b], places[a], places[b], percent)
            if good.any():
                x, y = docs[a[good]], docs[b[good]]
                yield pa.record_batch(
                    [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"]
                )

    return run


def _verify(words: int, percent: int):
    """The exact overlap of the two sets of a pair against the bound of their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCodes()
        for batch in sliced(batches):
            # A text that stands in many pairs is cut into shingles once.
            sides = pa.concat_arrays([batch.column(2), batch.column(3)]).dictionary_encode()
            sets = [shingles(codes, words) for codes in coder.of(sides.dictionary)]
            index = sides.indices.to_numpy()
            linked = []
            for first, second in zip(index[: batch.num_rows], index[batch.num_rows :]):
                x, y = sets[first], sets[second]
                both = np.concatenate([x, y])
                both.sort()
                overlap = int(np.count_nonzero(both[1:] == both[:-1]))
                linked.append(100 * overlap >= percent * (len(x) + len(y) - overlap))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )

    return run


def _decided(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``pairs`` with whether they link; ``texts`` has the texts of their documents."""
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("first"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("second"))
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .select("a", "b", "first", "second")
        .mapInArrow(_verify(words, percent), "a long, b long, linked boolean")
    )


def join_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for each row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signatures = stored(
        texts.mapInArrow(
            _signatures(words),
            "doc_id long, n long, high long, low long, segment int, counts binary",
        ),
        "signatures",
    )
    sets = signatures.filter("segment is null").select("doc_id", "n", "high", "low")
    sized = sets.filter("n > 0 and doc_id is not null")
    leaders = sized.groupBy("high", "low").agg(
        F.min("doc_id").alias("leader"), F.max("n").alias("n")
    )
    total = leaders.agg(F.sum("n").alias("n")).first()["n"] or 0
    counts = spark.sparkContext.broadcast(_bucket_counts(signatures))
    entries = total * (100 - percent) // 100 + 1
    blocks = max(1, entries // BLOCK_ENTRIES)
    present = texts.filter("doc_id is not null and text is not null")
    prefixes = (
        present.mapInArrow(_prefixes(counts, words, percent), "doc_id long, n long, keys binary")
        .join(leaders.select(F.col("leader").alias("doc_id")).distinct(), "doc_id", "left_semi")
    )
    products = stored(
        prefixes.mapInArrow(
            _tiles(blocks),
            "block long, keys binary, rows binary, places binary, docs binary, sizes binary",
        )
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_product(percent), _PAIR_SCHEMA),
        "products",
    )
    pairs = products.filter("a is not null").groupBy("a", "b").agg(F.sum("overlap").alias("overlap"))
    involved = products.select(F.explode(F.array("a", "b", "doc")).alias("doc_id")).filter(
        "doc_id is not null"
    )
    # The texts move once, in every case: a broadcast here would hang on the number of copies.
    used = stored(
        present.join(involved.distinct().hint("shuffle_hash"), "doc_id", "left_semi"), "used"
    )
    first = stored(_decided(pairs.select("a", "b"), used, words, percent), "first-pairs")
    links = first.filter("linked").select("a", "b")
    found = components(links)

    crowded = products.filter("key is not null").select("key", "doc", "n", "place")
    placed = stored(
        crowded.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
            "component", F.coalesce("component", "doc")
        ),
        "crowded",
    )
    open_columns = (
        placed.groupBy("key")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("rows"))
        .filter("least != most")
        .select("key", F.ceil(F.col("rows") / TILE).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int")
    tiled = (
        placed.join(open_columns, "key")
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("tile"),
            F.when(F.col("chunk") == F.col("other"), 2)
            .when(F.col("chunk") < F.col("other"), 0)
            .otherwise(1)
            .alias("side"),
            "doc", "n", "place", "component",
        )
        .repartition("tile")
        .mapInArrow(_tile_pairs(percent), "a long, b long")
        .distinct()
    )
    rest = stored(tiled.join(first.select("a", "b"), ["a", "b"], "left_anti"), "open-pairs")
    if not rest.isEmpty():
        more = _decided(rest, used, words, percent).filter("linked").select("a", "b")
        links = stored(links.union(more), "links")
        found = components(links)

    # A document may stand in several rows with several sets: these share a component.
    ledby = sized.join(leaders.select("high", "low", "leader"), ["high", "low"])
    several = ledby.groupBy("doc_id").agg(F.min("leader").alias("a"), F.max("leader").alias("z"))
    several = several.filter("a != z").select("doc_id", "a")
    joined = ledby.join(several, "doc_id").filter("leader != a").select("a", "leader")
    if not joined.isEmpty():
        found = components(links.union(joined))
    by_set = leaders.join(found.withColumnRenamed("node", "leader"), "leader", "left").select(
        "high", "low", F.coalesce("component", "leader").alias("component")
    )
    return sets.join(by_set, ["high", "low"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` but for all documents of a group other than its first.

    Rows that repeat a ``doc_id`` are one document and leave one row; rows without one stay.
    """
    found = join_components(docs, words, percent)
    first = found.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.filter(F.col("doc_id").isNotNull())
    kept = named.join(first, "doc_id", "left_semi").select(*docs.columns)
    once = kept.dropDuplicates(["doc_id"])
    return once.unionByName(docs.filter(F.col("doc_id").isNull()))
