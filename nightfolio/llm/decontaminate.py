"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask ignores some, so a hit survives words
that were exchanged under the ignored places. Seeds of the benchmark's items and of the
training texts meet by their hash. Around each hit the item is laid over the text along the
hit's diagonal. An overlap is a stretch of at least ``MIN_WORDS`` words, or of the whole
item if that is shorter, of which at least four fifths are equal: its sum of +1 for an
equal and -4 for another word is not negative. Of several, the one with the best sum is
given; it is never trimmed below that length. An item with fewer words than a mask has
places is one seed as a whole, and is found where all its words stand.

Where the benchmark has at most ``BROADCAST_SEEDS`` seeds, its seeds go to every task and
no training text is shuffled; a larger benchmark is joined by hash instead: seeds that a
bitmap of the items' seeds excludes do not move, and only texts
with hits are read again. Both ways give the same rows.

Words are runs of letters, digits and other signs beyond ASCII; ASCII and general
punctuation separates them, and the case of ASCII and Latin-1 letters is ignored. Defined results: null or empty
texts and items give no row; repeated rows of a
table give the row once; null ids are left out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import NOT_ALNUM, Shared, WordCodes, bitmap, mixed, sliced, stored

#: 1 is a place whose word is read, 0 one that is ignored. Fixed values.
MASKS = ("1110100111", "1101011011", "1011100101")
MIN_WORDS = 13
MISMATCH = 4
BROADCAST_SEEDS = 1_000_000
_FILTER_BITS = 22
#: Added to the length of a short item, the number of its seed.
WHOLE = 1000
_FACTOR = 0x9E3779B97F4A7C15


def plain_words() -> WordCodes:
    return WordCodes(NOT_ALNUM, latin=True)


def seeds(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of every window of ``mask`` over ``words``, by where it starts."""
    span = len(words) - len(mask) + 1
    if span < 1:
        return np.empty(0, np.uint64)
    value = np.full(span, number + 1, np.uint64)
    for place, read in enumerate(mask):
        if read == "1":
            value *= np.uint64(_FACTOR)
            value += words[place : place + span]
    return mixed(value)


def item_seeds(words: np.ndarray, masks: tuple[str, ...]) -> list[tuple[int, np.ndarray]]:
    """The seeds of an item under the numbers of their masks.

    An item that is shorter than the masks is one seed as a whole, numbered by its length.
    """
    if 0 < len(words) < min(map(len, masks)):
        return [whole_seeds(words, len(words))]
    return [(n, seeds(words, mask, n)) for n, mask in enumerate(masks)]


def whole_seeds(words: np.ndarray, length: int) -> tuple[int, np.ndarray]:
    return WHOLE + length, seeds(words, "1" * length, WHOLE + length)


def text_seeds(
    words: np.ndarray, masks: tuple[str, ...], lengths: list[int]
) -> Iterator[tuple[bool, np.ndarray]]:
    """The seeds of a text, and whether they are of whole items of the given ``lengths``."""
    for n, mask in enumerate(masks):
        yield False, seeds(words, mask, n)
    for length in lengths:
        yield True, whole_seeds(words, length)[1]


def best_overlap(same: np.ndarray, least: int) -> tuple[int, int, int] | None:
    """Start, length and equal words of the stretch with the best sum.

    Only stretches of ``least`` words or more with at least four fifths equal count.
    """
    if len(same) < least:
        return None
    gains = np.where(same, 1, -MISMATCH)
    total = np.concatenate([[0], np.cumsum(gains)])
    lowest = np.minimum.accumulate(total[: len(total) - least])
    sums = total[least:] - lowest
    last = int(np.argmax(sums))
    if sums[last] < 0:
        return None
    begin = int(np.flatnonzero(total[: last + 1] == lowest[last])[0])
    end = last + least
    return begin, end - begin, int(same[begin:end].sum())


def overlap_on(words: np.ndarray, item: np.ndarray, diagonal: int) -> tuple | None:
    """The overlap of a text with an item whose first word stands at ``diagonal``."""
    first, last = max(0, -diagonal), min(len(item), len(words) - diagonal)
    if last <= first:
        return None
    same = item[first:last] == words[first + diagonal : last + diagonal]
    found = best_overlap(same, min(MIN_WORDS, len(item)))
    if found is None:
        return None
    begin, length, equal = found
    return first + begin + diagonal, first + begin, length, equal


def _better(old: tuple | None, new: tuple) -> tuple:
    return new if old is None or (new[3], -new[0], -new[1]) > (old[3], -old[0], -old[1]) else old


_COLUMNS = "doc_id long, item_id long, doc_start long, item_start long, n_words long, n_equal long"


class SeedIndex:
    """The items' seeds in order of their hash, behind a bit for each hash's end."""

    def __init__(self, items: list[tuple[int, np.ndarray]], masks: tuple[str, ...]):
        self.items, self.masks = items, masks
        self.lengths = sorted({len(w) for _, w in items if 0 < len(w) < min(map(len, masks))})
        parts = [
            (found, np.full(len(found), i), np.arange(len(found)))
            for i, (_, words) in enumerate(items)
            for _, found in item_seeds(words, masks)
        ]
        codes = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.uint64)
        order = np.argsort(codes)
        self.codes = codes[order]
        self.item = np.concatenate([p[1] for p in parts])[order] if parts else order
        self.place = np.concatenate([p[2] for p in parts])[order] if parts else order
        self.present = np.zeros(1 << _FILTER_BITS, bool)
        self.present[(codes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def overlaps(self, words: np.ndarray) -> list[tuple]:
        """For each item with an overlap, its id and the best one."""
        if not len(self.codes):
            return []
        diagonals = []
        for whole, codes in text_seeds(words, self.masks, self.lengths):
            at = np.flatnonzero(
                self.present[(codes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
            )
            if not len(at):
                continue
            begin = np.searchsorted(self.codes, codes[at], "left")
            many = np.searchsorted(self.codes, codes[at], "right") - begin
            at, begin = np.repeat(at, many), np.repeat(begin, many)
            hit = begin + np.arange(len(begin)) - np.repeat(np.cumsum(many) - many, many)
            item, diagonal = self.item[hit], at - self.place[hit]
            if whole:
                # All hits are equal word for word: the first is the best.
                item, first = np.unique(item, return_index=True)
                diagonal = diagonal[first]
            diagonals.append(np.stack([item, diagonal], axis=1))
        best: dict[int, tuple] = {}
        if diagonals:
            for item, diagonal in np.unique(np.concatenate(diagonals), axis=0).tolist():
                found = overlap_on(words, self.items[item][1], diagonal)
                if found:
                    best[item] = _better(best.get(item), found)
        rows: dict[int, tuple] = {}
        for item, found in best.items():
            rows[self.items[item][0]] = _better(rows.get(self.items[item][0]), found)
        return sorted(rows.items())


def _by_index(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, found = plain_words(), index.value
        for batch in sliced(batches):
            rows = [
                (doc, item, *overlap)
                for doc, words in zip(batch.column(0).to_pylist(), coder.of(batch.column(1)))
                for item, overlap in found.overlaps(words)
            ]
            columns = list(zip(*rows)) if rows else [[]] * 6
            names = [c.split()[0] for c in _COLUMNS.split(", ")]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _item_rows(masks: tuple[str, ...]):
    """Every seed of an item: its hash, the item's id, where it starts, and the length of a
    short item that is one seed as a whole, else 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = plain_words()
        for batch in sliced(batches):
            for key, words in zip(batch.column(0).to_pylist(), coder.of(batch.column(1))):
                for number, codes in item_seeds(words, masks):
                    many = len(codes)
                    columns = [
                        pa.array(codes.view(np.int64)),
                        pa.array([key] * many, pa.int64()),
                        pa.array(np.arange(many)),
                        pa.array(np.full(many, max(0, number - WHOLE))),
                    ]
                    yield pa.record_batch(columns, ["code", "item_id", "item_place", "length"])

    return run


def _text_rows(masks: tuple[str, ...], lengths: list[int], present: Shared):
    """The seeds of a text that the items may have: hash, the text's id, where it starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, known = plain_words(), present.value
        for batch in sliced(batches):
            for key, words in zip(batch.column(0).to_pylist(), coder.of(batch.column(1))):
                for _, codes in text_seeds(words, masks, lengths):
                    at = np.flatnonzero(known.may_have(codes))
                    if len(at):
                        yield pa.record_batch(
                            [
                                pa.array(codes[at].view(np.int64)),
                                pa.array([key] * len(at), pa.int64()),
                                pa.array(at),
                            ],
                            ["code", "key", "place"],
                        )

    return run


def _on_diagonals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder = plain_words()
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    for batch in sliced(batches):
        doc, item, diagonal = (batch.column(i).to_pylist() for i in range(3))
        texts, items = coder.of(batch.column(3)), coder.of(batch.column(4))
        rows = []
        for d, i, at, text, other in zip(doc, item, diagonal, texts, items):
            found = overlap_on(text, other, at)
            if found:
                rows.append((d, i, *found))
        columns = list(zip(*rows)) if rows else [[]] * 6
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)


def _by_join(texts: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    own = stored(
        items.mapInArrow(
            _item_rows(masks), "code long, item_id long, item_place long, length long"
        ),
        "seeds",
    )
    lengths = sorted(r["length"] for r in own.select("length").distinct().collect() if r["length"])
    # Most seeds of the corpus stop here: only those that items may have move.
    present = bitmap(own.select("code"))
    diagonal = F.col("place") - F.col("item_place")
    hits = (
        texts.mapInArrow(_text_rows(masks, lengths, present), "code long, key long, place long")
        .join(own, "code")
        # Of a short item, equal word for word, the first place is the best; else every diagonal.
        .groupBy("key", "item_id", F.when(F.col("length") == 0, diagonal).alias("on"))
        .agg(F.min(diagonal).alias("diagonal"))
        .select(F.col("key").alias("doc_id"), "item_id", "diagonal")
    )
    found = (
        hits.join(texts, "doc_id")
        .join(items.toDF("item_id", "item"), "item_id")
        .select("doc_id", "item_id", "diagonal", "text", "item")
        .mapInArrow(_on_diagonals, _COLUMNS)
    )
    order = F.struct(
        F.col("n_equal"), -F.col("doc_start"), -F.col("item_start"), F.col("n_words")
    )
    best = found.groupBy("doc_id", "item_id").agg(F.max(order).alias("o"))
    return best.select(
        "doc_id",
        "item_id",
        (-F.col("o.col2")).alias("doc_start"),
        (-F.col("o.col3")).alias("item_start"),
        F.col("o.n_words").alias("n_words"),
        F.col("o.n_equal").alias("n_equal"),
    )


def _named(table: DataFrame, key: str) -> DataFrame:
    return table.filter(F.col(key).isNotNull() & F.col("text").isNotNull()).select(
        F.col(key).cast("long").alias(key), "text"
    )


def index_of(
    benchmark: DataFrame, masks: tuple[str, ...] = MASKS, limit: int = BROADCAST_SEEDS
):
    """The seeds of a benchmark as a broadcast variable; None if they are above ``limit``.

    The bound is checked by characters first: a word with its separator has two at least.
    """
    items = _named(benchmark, "item_id").distinct()
    chars = items.agg(F.sum(F.length("text") + 1).alias("n")).first()["n"] or 0
    if chars * len(masks) // 2 > limit * 4:
        return None
    rows = items.collect()
    words = plain_words().of(pa.array([r["text"] for r in rows], pa.string()))
    named = zip([r["item_id"] for r in rows], words)
    index = SeedIndex(sorted(named, key=lambda r: (r[0], r[1].tobytes())), masks)
    if len(index.codes) > limit:
        return None
    return Shared(benchmark.sparkSession, index)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    limit: int = BROADCAST_SEEDS,
) -> DataFrame:
    """A row for each document and benchmark item that overlap, with the best overlap."""
    texts = _named(docs, "doc_id")
    index = index_of(benchmark, masks, limit)
    if index is None:
        return _by_join(texts, _named(benchmark, "item_id").distinct(), masks)
    found = texts.mapInArrow(_by_index(index), _COLUMNS)
    order = F.struct(
        F.col("n_equal"), -F.col("doc_start"), -F.col("item_start"), F.col("n_words")
    )
    best = found.groupBy("doc_id", "item_id").agg(F.max(order).alias("o"))
    return best.select(
        "doc_id",
        "item_id",
        (-F.col("o.col2")).alias("doc_start"),
        (-F.col("o.col3")).alias("item_start"),
        F.col("o.n_words").alias("n_words"),
        F.col("o.n_equal").alias("n_equal"),
    )


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, limit: int = BROADCAST_SEEDS
) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, each judged by its text."""
    index = index_of(benchmark, limit=limit)
    if index is None:
        # Stored, as the numbers must be the same in every read.
        texts = stored(
            docs.filter("text IS NOT NULL")
            .select("text")
            .distinct()
            .select(F.monotonically_increasing_id().alias("doc_id"), "text"),
            "texts",
        )
        items = _named(benchmark, "item_id").distinct()
        found = _by_join(texts, items, MASKS).select("doc_id").distinct()
        dirty = texts.join(found, "doc_id").select(F.sha2("text", 256).alias("digest"))
        return docs.join(dirty, F.sha2(docs["text"], 256) == dirty["digest"], "left_anti")

    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder, found = plain_words(), index.value
        for texts in batches:
            yield pa.array([not found.overlaps(words) for words in coder.of(texts)], pa.bool_())

    return docs.filter(F.arrow_udf(clean, "boolean")("text"))
