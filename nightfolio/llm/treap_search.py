"""Ranked lexical search by a K2-treap over the term-document grid.

A batch of documents is a range of columns, the terms of the items are rows, and a cell holds
what a term adds to a document's score. The grid is a quadtree of which only non-empty cells are
stored: a mask of a cell's four quarters, the place of the first of them, and the largest
value below. For an item, the paths of its terms' rows go down jointly: a node is a range
of documents with one cell for each term that occurs there, and the sum of the cells' maxima bounds
every score in the range. Nodes open best-first, some of each item at once, until none is
left whose bound reaches the item's last place; at single documents the sum is the score.

Documents are read once for each block of items (``BLOCK_TERMS`` terms of items, which with
their weights are all that goes to every task): their terms among the block's are stored with
the documents' lengths, the statistics over all documents follow from them, and each
task then builds the trees of its batches and carries its best places from one to the next.
Only ``top`` rows for each task and item move.

Terms are compared by 64-bit codes. Whatever the corpus, a term of an item meets another
with its code with a chance of one in 10^12 for ten million different words.

Defined results: a null or empty text has no terms and is not ranked. Documents without an id count and
are ranked, after others of equal score, with a null ``doc_id``; each repeated row is a
document. Items without an id or terms have no rows; a repeated item has its rows once, an
id with several texts has each one's. Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightfolio.llm.common import NOT_ALNUM, Leaders, Shared, WordCodes, sliced, stored

TOP = 50
BLOCK_TERMS = 1 << 17
#: Terms of items whose nodes are open at once in a task, and nodes opened at once per item.
OPEN_TERMS, BEAM = 4096, 64
NO_ID = (1 << 63) - 1


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, damping: np.ndarray) -> np.ndarray:
    """What terms add to scores: their weight, with ``tf`` damped for long documents."""
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * damping))


def dampings(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    # Python's numbers: the product can leave 64 bits before the division.
    return np.array([50 + 50 * int(n) * documents // total for n in lengths], np.int64)


def _spread(values: np.ndarray) -> np.ndarray:
    """Puts a zero bit before each bit of 32-bit values."""
    out = values.astype(np.uint64)
    for shift, keep in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        out = (out | (out << np.uint64(shift))) & np.uint64(keep)
    return out


#: How many of a mask's bits lie below a quarter.
BELOW = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)])


class Treap:
    """A quadtree of the non-empty cells of a grid, level by level, with their maxima."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
        most = max(int(rows.max(initial=0)), int(columns.max(initial=0)))
        self.height = max(1, most.bit_length())
        keys = (_spread(rows) << np.uint64(1)) | _spread(columns)
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        masks, firsts, tops = [np.zeros(len(keys), np.uint8)], [np.zeros(len(keys), int)], [values]
        for _ in range(self.height if len(keys) else 0):
            quarter = np.uint8(1) << (keys & np.uint64(3)).astype(np.uint8)
            keys = keys >> np.uint64(2)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            masks.append(np.bitwise_or.reduceat(quarter, first))
            firsts.append(first)
            tops.append(np.maximum.reduceat(tops[-1], first))
            keys = keys[first]
        # From the root down; a cell's quarters are found by their place in the whole.
        start = 0
        for level in range(len(tops) - 1, 0, -1):
            start += len(tops[level])
            firsts[level] = firsts[level] + start
        self.mask, self.first, self.top = (
            np.concatenate(parts[::-1]) for parts in (masks, firsts, tops)
        )

    def quarter(self, cells: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The cells' quarters 0 to 3, or -1 where one is empty."""
        mask = self.mask[cells]
        place = self.first[cells] + BELOW[mask, which]
        return np.where((mask >> which) & 1, place, -1)


def _pieces(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as counted, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def explore(
    tree: Treap, ids: np.ndarray, items: np.ndarray, rows: list[np.ndarray], leaders: Leaders, beam: int = BEAM
) -> None:
    """Takes the best columns for each item into ``leaders``.

    ``rows`` has the rows of each of ``items``, ``ids`` the name of each column.
    """
    if not len(tree.top):
        return
    counts = np.array([len(r) for r in rows])
    row = np.concatenate(rows)
    cell = np.zeros(len(row), int)
    # Open nodes: item, level, first column over the range's width, bound, and their cells.
    node = np.array(
        [items, np.zeros_like(items), np.zeros_like(items), counts * tree.top[0], np.cumsum(counts) - counts, counts]
    )
    while True:
        node = node[:, node[3] >= np.maximum(leaders.least[node[0]], 1)]
        if not node.shape[1]:
            return
        order = np.lexsort((-node[3], node[0]))
        node = node[:, order]
        rank = np.arange(len(order)) - np.searchsorted(node[0], node[0])
        now, later = node[:, rank < beam], node[:, rank >= beam]
        at = _pieces(now[4], now[5])
        owner = np.repeat(np.arange(now.shape[1]), now[5])
        own_row, own_cell = row[at], cell[at]
        bit = (own_row >> (tree.height - 1 - now[1][owner])) & 1
        at = _pieces(later[4], later[5])
        row, cell = row[at], cell[at]
        later[4] = np.cumsum(later[5]) - later[5]
        opened = [later]
        for half in (0, 1):
            below = tree.quarter(own_cell, 2 * bit + half)
            there = np.flatnonzero(below >= 0)
            if not len(there):
                continue
            below, of = below[there], owner[there]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            bound = np.add.reduceat(tree.top[below], first)
            parent = now[:, of[first]]
            level, column = parent[1] + 1, parent[2] * 2 + half
            done = level == tree.height
            leaders.merge(parent[0][done], ids[column[done]], bound[done])
            size = np.diff(np.append(first, len(of)))
            child = np.array([parent[0], level, column, bound, first, size])[:, ~done]
            at = _pieces(child[4], child[5])
            child[4] = np.cumsum(child[5]) - child[5] + len(row)
            row, cell = np.concatenate([row, own_row[there][at]]), np.concatenate([cell, below[at]])
            opened.append(child)
        node = np.concatenate(opened, axis=1)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordCodes(NOT_ALNUM)
    for batch in batches:
        found = [np.unique(codes) for codes in words.of(batch.column("text"))]
        yield pa.record_batch(
            [
                batch.column("item_id"),
                pa.array([len(codes) for codes in found], pa.int32()),
                pa.array([codes.tobytes() for codes in found], pa.binary()),
            ],
            ["item_id", "size", "terms"],
        )


def _matches(vocabulary: Shared):
    """Each document's length, and its terms among the vocabulary with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = WordCodes(NOT_ALNUM), vocabulary.value
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            found = words.of(batch.column("text"))
            sizes = np.array([len(codes) for codes in found])
            codes = np.concatenate(found)
            at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            hit = known[at] == codes
            keys = np.repeat(np.arange(len(found)), sizes)[hit] * len(known) + at[hit]
            keys, counts = np.unique(keys, return_counts=True)
            ends = np.searchsorted(keys, np.arange(1, len(found)) * len(known))
            terms = np.split((keys % len(known)).astype(np.int32), ends)
            counts = [c.astype(np.uint8 if c.max(initial=0) < 256 else np.uint64) for c in np.split(counts, ends)]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array([t.tobytes() for t in terms], pa.binary()),
                    pa.array([c.tobytes() for c in counts], pa.binary()),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return run


def _joined(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.int32)


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_joined(batch.column(0).to_pylist()), minlength=size)
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there), pa.array(total[there])], ["term", "df"])

    return run


def _rank(block: Shared, top: int):
    """The best documents of a task for each item of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows, weights, documents, total = block.value
        leaders = Leaders(np.zeros(len(names), np.int64), top)
        ends = np.cumsum([len(r) for r in rows])
        cuts = np.flatnonzero(np.diff((ends - 1) // OPEN_TERMS)) + 1
        parts = np.split(np.arange(len(names)), cuts)
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            blobs, counts = batch.column("terms").to_pylist(), batch.column("counts").to_pylist()
            size = np.array([len(b) // 4 for b in blobs])
            tf = [np.frombuffer(c, np.uint8 if len(c) == k else np.uint64) for c, k in zip(counts, size)]
            term, tf = _joined(blobs), np.concatenate(tf).astype(np.int64)
            column = np.repeat(np.arange(len(size)), size)
            damping = dampings(batch.column("n").to_numpy(), documents, total)
            value = impacts(weights[term], tf, damping[column])
            there = value > 0
            tree = Treap(term[there], column[there], value[there])
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            for part in parts:
                explore(tree, ids, part, [rows[k] for k in part], leaders)
        found = pa.array(leaders.found, mask=leaders.found == NO_ID)
        yield pa.record_batch(
            [pa.array(leaders.query), pa.array(names[leaders.query]), found, pa.array(leaders.score)],
            ["item", "item_id", "doc_id", "score"],
        )

    return run


def _block(docs: DataFrame, names: np.ndarray, codes: list[np.ndarray], top: int) -> DataFrame:
    """The best documents of each task for the items of a block."""
    spark = docs.sparkSession
    known = np.unique(np.concatenate(codes))
    grid = stored(
        docs.mapInArrow(
            _matches(Shared(spark, known)), "doc_id long, n long, terms binary, counts binary"
        ),
        "grid",
    )
    facts = grid.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total")).first()
    frequency = np.zeros(len(known), np.int64)
    for row in (
        grid.select("terms")
        .mapInArrow(_frequencies(len(known)), "term long, df long")
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
        .collect()
    ):
        frequency[row["term"]] = row["df"]
    documents = facts["documents"] or 0
    weights = np.array([weight(documents, int(df)) for df in frequency], np.int64)
    rows = [np.searchsorted(known, own) for own in codes]
    block = Shared(spark, (names, rows, weights, documents, facts["total"] or 1))
    return grid.filter("length(terms) > 0").mapInArrow(
        _rank(block, top), "item long, item_id long, doc_id long, score long"
    )


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the ``top`` best documents of each item.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = stored(
        items.select(F.col("item_id").cast("long").alias("item_id"), "text")
        .filter("item_id IS NOT NULL")
        .mapInArrow(_item_terms, "item_id long, size int, terms binary")
        .filter("size > 0")
        .distinct(),
        "items",
    )
    blocks = -(-(asked.agg(F.sum("size")).first()[0] or 0) // block_terms)
    found = []
    for number in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == number)
        own = mine.sort("item_id", "terms").collect()
        if own:
            names = np.array([r["item_id"] for r in own], np.int64)
            codes = [np.frombuffer(bytes(r["terms"]), np.uint64) for r in own]
            found.append(_block(docs, names, codes, top).withColumn("block", F.lit(number)))
    none = docs.sparkSession.createDataFrame(
        [], "item long, item_id long, doc_id long, score long, block int"
    )
    places = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        reduce(DataFrame.unionByName, found, none)
        .withColumn("rank", F.row_number().over(places))
        .filter(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )
