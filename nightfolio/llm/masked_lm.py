"""Document scores by masked pseudo-likelihood.

A window network reads the words on both sides of a place, never the word itself, and
predicts the word: embeddings by position, a tanh layer, and a softmax over word classes;
within a class a word has its share of the corpus, so the chances of all words add up to
one. The sum of the logarithms over all places of a text is its score.

Classes are learned from contexts: each frequent word has a profile of what stands left and
right of it in all texts, and words with like profiles, by their leading singular
directions, fall into one class. So choosing a class is choosing among words that stand
in such a place, and not a band of frequency.

Word counts come from all texts. Words from ``EMBEDDED_COUNT`` occurrences on have
embeddings, so their number grows with the corpus, between ``EMBEDDED_LEAST`` and
``EMBEDDED_MOST``: the weights of a task go to the tasks and back whole. The others share
hashed embeddings and one class, in which each has the share of its own (smoothed) count,
however rare it is. The counts of at most ``TABLE_WORDS`` words go to the tasks; words
below that meet their counts by a join.

The network is trained by every task on its own texts, on every place once: each of the
``ROUNDS`` rounds takes another share of the places of every text, from common weights that
are the mean of the round before, weighted by places. The weights have a fixed size; means are taken in a tree, so
no group of weights grows with the number of tasks.

Defined results: a null or empty text has no tokens, score 0 and a null mean; words are
runs between ASCII white space without A-Z case; repeated rows count each; null ids are
kept; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import Shared, WordCodes, mixed, sliced, stored, tree_reduced

EMBEDDED_COUNT = 1024
EMBEDDED_LEAST, EMBEDDED_MOST = 4096, 32768
#: Words whose counts go to every task, 16 bytes each.
TABLE_WORDS = 1 << 19
SMOOTHING = 0.5
SHARED = 256
CLASSES = 48
#: Kinds of neighbours in a word's profile, each side: some frequent words, the rest hashed.
OWN_KINDS, KINDS = 48, 64
PROFILE_DIRECTIONS, CLASS_ROUNDS = 16, 25
HIDDEN = 16
WINDOW = 2
ROUNDS = 2
RATE = 0.15
STEP = 4096
BLOCKS = 16
CHUNK = 1 << 16


@dataclass
class Vocabulary:
    """Codes of frequent words in order, their number, class and log share of the class.

    ``table`` has further words' codes in order, ``table_shares`` their log shares of the
    last class. A word in neither has a count below ``least``, and no share here.
    """

    codes: np.ndarray
    classes: np.ndarray
    shares: np.ndarray
    table: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    table_shares: np.ndarray = field(default_factory=lambda: np.empty(0))
    least: int = 1
    others: float = 1.0

    def __post_init__(self):
        self.boundary = len(self.codes) + SHARED
        self.size = self.boundary + 1

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        other = len(self.codes) + (codes % np.uint64(SHARED)).astype(np.int64)
        if not len(self.codes):
            return other
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, other)

    def tail_shares(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log shares of words without embeddings, and which of them have none here."""
        if not len(self.table):
            return np.zeros(len(codes)), np.ones(len(codes), bool)
        at = np.minimum(np.searchsorted(self.table, codes), len(self.table) - 1)
        absent = self.table[at] != codes
        return np.where(absent, 0.0, self.table_shares[at]), absent


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coder = WordCodes()
    for batch in batches:
        words = coder.of(batch.column(0))
        codes, counts = np.unique(np.concatenate(words) if words else [], return_counts=True)
        codes = codes.astype(np.uint64).view(np.int64)
        yield pa.record_batch([pa.array(codes), pa.array(counts, pa.int64())], ["code", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """``code`` and ``n`` of every word of all texts."""
    counts = docs.select("text").mapInArrow(_counted, "code long, n long")
    return stored(counts.groupBy("code").agg(F.sum("n").alias("n")), "words")


def _profiled(known: Shared, kinds: Shared):
    """Counts of the kinds of neighbours of each frequent word, over the task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, words, kind = WordCodes(), known.value, kinds.value
        total = np.zeros(len(words.codes) * 2 * KINDS, np.int64)
        for batch in sliced(batches, 4000):
            line, places = contexts(coder.of(batch.column(0)), words)
            places = places[line[places] < len(words.codes)]
            for side, step in enumerate((-1, 1)):
                cells = (line[places] * 2 + side) * KINDS + kind[line[places + step]]
                total += np.bincount(cells, minlength=len(total))
        part = TaskContext.get().partitionId()
        # A task has few of the pairs; packed, the rest weighs nothing.
        blocks = [zlib.compress(b.tobytes(), 1) for b in np.array_split(total, BLOCKS)]
        yield pa.record_batch(
            [pa.array(range(BLOCKS), pa.int32()), pa.array([part] * BLOCKS, pa.int64()), pa.array(blocks, pa.binary())],
            ["block", "part", "counts"],
        )

    return run


def _summed(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in frame["counts"])
    return pd.DataFrame(
        {
            "block": frame["block"].iloc[:1].to_numpy(),
            "part": frame["part"].iloc[:1].to_numpy(),
            "counts": [zlib.compress(total.tobytes(), 1)],
        }
    )


def profiles(docs: DataFrame, codes: np.ndarray) -> np.ndarray:
    """For words given by falling frequency, how often each kind of neighbour stands beside them.

    Neighbours are the boundary, the ``OWN_KINDS`` first words, and all others by hash.
    """
    spark, order = docs.sparkSession, np.argsort(codes)
    known = Vocabulary(codes[order], np.empty(0, np.int64), np.empty(0))
    kinds = OWN_KINDS + np.arange(known.size) % (KINDS - 1 - OWN_KINDS)
    kinds[: len(codes)] = np.where(order < OWN_KINDS, order, kinds[: len(codes)])
    kinds[known.boundary] = KINDS - 1
    schema = "block int, part long, counts binary"
    parts = docs.select("text").mapInArrow(_profiled(Shared(spark, known), Shared(spark, kinds)), schema)
    rows = tree_reduced(stored(parts, "profiles"), "block", _summed, schema).collect()
    if not rows:
        return np.zeros((len(codes), 2 * KINDS))
    rows.sort(key=lambda r: r["block"])
    cells = np.concatenate([np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in rows])
    out = np.empty((len(codes), 2 * KINDS))
    out[order] = cells.reshape(len(codes), 2 * KINDS)
    return out


def learned_classes(profile: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Classes of words with like profiles, by weighted k-means on singular directions.

    The square root makes shares comparable whether large or small. Centres start from a
    frequent word each, the one worst served by the centres before it.
    """
    if not len(profile):
        return np.empty(0, np.int64)
    shares = np.sqrt((profile + 0.1) / (profile + 0.1).sum(axis=1, keepdims=True))
    shares -= np.average(shares, axis=0, weights=own)
    # Directions that matter for many tokens, and not for many rare words.
    values, turn = np.linalg.eigh((shares * own[:, None]).T @ shares)
    points = shares @ turn[:, np.argsort(-values)[:PROFILE_DIRECTIONS]]
    weight = np.sqrt(own)
    centres = points[:1]
    far = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < min(CLASSES - 1, len(points)):
        centres = np.concatenate([centres, points[[np.argmax(far * weight)]]])
        far = np.minimum(far, ((points - centres[-1]) ** 2).sum(axis=1))
    for _ in range(CLASS_ROUNDS):
        away = (centres**2).sum(axis=1) - 2 * points @ centres.T
        classes = away.argmin(axis=1)
        sums = np.stack([np.bincount(classes, weight * p, len(centres)) for p in points.T], axis=1)
        total = np.bincount(classes, weight, len(centres))[:, None]
        centres = np.where(total > 0, sums / np.maximum(total, 1e-12), centres)
    return classes.astype(np.int64)


def vocabulary(docs: DataFrame, counts: DataFrame | None = None) -> Vocabulary:
    """Learns classes of the frequent words, and gives further words their shares."""
    counts = word_counts(docs) if counts is None else counts
    # Different counts are few: n of them need n * (n + 1) / 2 tokens.
    rows = counts.groupBy("n").agg(F.count("*").alias("kinds")).collect()
    sizes = sorted(((r["n"], r["kinds"]) for r in rows), reverse=True)
    kinds, tokens = sum(k for _, k in sizes), sum(n * k for n, k in sizes)
    frequent = sum(k for n, k in sizes if n >= EMBEDDED_COUNT)
    embedded = min(max(frequent, EMBEDDED_LEAST), EMBEDDED_MOST)
    # Whole counts only, so that a word's count tells whether it is in the table.
    least, held = (sizes[0][0] + 1 if sizes else 1), 0
    for n, several in sizes:
        held += several
        if held > embedded + TABLE_WORDS:
            break
        least = n
    top = counts.filter(F.col("n") >= least).toArrow()
    codes = top.column("code").to_numpy().view(np.uint64)
    own = top.column("n").to_numpy().astype(float)
    order = np.lexsort((codes.view(np.int64), -own))
    (codes, further), (own, rare) = (
        np.split(values[order], [embedded]) for values in (codes, own)
    )
    # The last class is that of all other words.
    classes = learned_classes(profiles(docs, codes), own)
    weight = np.bincount(classes, own, CLASSES)
    shares = np.log(own / weight[classes]) if len(own) else own
    others = tokens - own.sum() + SMOOTHING * (kinds - len(own) + 1)
    order, tail = np.argsort(codes), np.argsort(further)
    classes = np.concatenate([classes[order], np.full(SHARED + 1, CLASSES - 1)])
    shares = np.concatenate([shares[order], np.zeros(SHARED + 1)])
    table_shares = np.log((rare[tail] + SMOOTHING) / others)
    return Vocabulary(codes[order], classes, shares, further[tail], table_shares, least, float(others))


def _shapes(size: int) -> list[tuple[int, ...]]:
    return [(2 * WINDOW, size, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]


def _split(weights: np.ndarray, size: int) -> list[np.ndarray]:
    parts, at = [], 0
    for shape in _shapes(size):
        count = int(np.prod(shape))
        parts.append(weights[at : at + count].reshape(shape))
        at += count
    return parts


def start_weights(size: int) -> np.ndarray:
    rng = np.random.default_rng(5)
    parts = [rng.normal(0, 0.3 if len(s) > 1 else 0.0, s).ravel() for s in _shapes(size)]
    return np.concatenate(parts).astype(np.float32)


def contexts(texts: list[np.ndarray], known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All texts' word numbers with boundaries around each, and the places of the words."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    line = np.full(int(lengths.sum()) + WINDOW * (len(texts) + 1), known.boundary)
    owner = np.repeat(np.arange(len(texts)), lengths)
    places = np.arange(len(owner)) + WINDOW * (owner + 1)
    if len(places):
        line[places] = known.numbers(np.concatenate(texts))
    return line, places


_SIDES = [step for step in range(-WINDOW, WINDOW + 1) if step]


def _hidden(parts: list[np.ndarray], around: list[np.ndarray]) -> np.ndarray:
    total = parts[0][0][around[0]] + parts[1]
    for table, numbers in zip(parts[0][1:], around[1:]):
        total += table[numbers]
    return np.tanh(total, out=total)


def _log_classes(parts: list[np.ndarray], hidden: np.ndarray) -> np.ndarray:
    scores = hidden @ parts[2] + parts[3]
    scores -= scores.max(axis=1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return scores


class Trainer:
    """Stochastic gradients with rates that fall as a weight's gradients add up."""

    def __init__(self, weights: np.ndarray, known: Vocabulary):
        self.weights, self.known = weights.copy(), known
        self.parts = _split(self.weights, known.size)
        self.squares = np.zeros_like(self.weights)
        self.square_parts = _split(self.squares, known.size)

    def step(self, line: np.ndarray, places: np.ndarray) -> None:
        around = [line[places + side] for side in _SIDES]
        hidden = _hidden(self.parts, around)
        slope = np.exp(_log_classes(self.parts, hidden))
        slope[np.arange(len(places)), self.known.classes[line[places]]] -= 1
        slope /= np.float32(len(places))
        back = (slope @ self.parts[2].T) * (1 - hidden * hidden)
        self._move(2, slice(None), hidden.T @ slope)
        self._move(3, slice(None), slope.sum(axis=0))
        self._move(1, slice(None), back.sum(axis=0))
        for side, numbers in enumerate(around):
            used, local = np.unique(numbers, return_inverse=True)
            sums = np.stack(
                [np.bincount(local, back[:, k], len(used)) for k in range(HIDDEN)], axis=1
            )
            self._move(0, (side, used), sums.astype(np.float32))

    def _move(self, part: int, where, slope: np.ndarray) -> None:
        self.square_parts[part][where] += slope * slope
        rate = RATE / np.sqrt(self.square_parts[part][where] + 1e-6)
        self.parts[part][where] -= rate * slope


def _trained(weights, known, round_: int):
    """A task's weights after its texts, in blocks, with the number of places it learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, words = WordCodes(), known.value
        trainer, learned = Trainer(weights.value, words), 0
        for batch in sliced(batches, 4000):
            line, places = contexts(coder.of(batch.column(0)), words)
            # Every place has its round.
            masked = places[mixed(places.astype(np.uint64)) % np.uint64(ROUNDS) == round_]
            # Neighbouring texts are alike; a step takes places from the whole batch.
            masked = masked[np.argsort(mixed(masked.astype(np.uint64) + np.uint64(1)), kind="stable")]
            for at in range(0, len(masked), STEP):
                trainer.step(line, masked[at : at + STEP])
            learned += len(masked)
        if not learned:
            return
        blocks = [b.tobytes() for b in np.array_split(trainer.weights, BLOCKS)]
        part = TaskContext.get().partitionId()
        yield pa.record_batch(
            [
                pa.array(range(BLOCKS), pa.int32()),
                pa.array([part] * BLOCKS, pa.int64()),
                pa.array([float(learned)] * BLOCKS),
                pa.array(blocks, pa.binary()),
            ],
            ["block", "part", "learned", "weights"],
        )

    return run


def _mean(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(
        n * np.frombuffer(w, np.float32).astype(float)
        for n, w in zip(frame["learned"], frame["weights"])
    )
    learned = frame["learned"].sum()
    return pd.DataFrame(
        {
            "block": frame["block"].iloc[:1].to_numpy(),
            "part": frame["part"].iloc[:1].to_numpy(),
            "learned": [learned],
            "weights": [(total / learned).astype(np.float32).tobytes()],
        }
    )


def train(docs: DataFrame, known: Vocabulary):
    """The network's weights and the vocabulary, as broadcast variables."""
    context = docs.sparkSession.sparkContext
    words = Shared(docs.sparkSession, known)
    weights = start_weights(known.size)
    schema = "block int, part long, learned double, weights binary"
    for round_ in range(ROUNDS):
        now = context.broadcast(weights)
        parts = stored(docs.select("text").mapInArrow(_trained(now, words, round_), schema), "weights")
        rows = tree_reduced(parts, "block", _mean, schema).collect()
        if rows:
            blocks = [r["weights"] for r in sorted(rows, key=lambda r: r["block"])]
            weights = np.frombuffer(b"".join(blocks), np.float32)
    return context.broadcast(weights), words


def _likelihoods(
    texts: list[np.ndarray], weights: np.ndarray, known: Vocabulary
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each text's sum, and those of its words whose share is still to be added."""
    line, places = contexts(texts, known)
    parts = _split(weights, known.size)
    out = np.empty(len(places))
    for at in range(0, len(places), CHUNK):
        here = places[at : at + CHUNK]
        logs = _log_classes(parts, _hidden(parts, [line[here + side] for side in _SIDES]))
        word = line[here]
        out[at : at + CHUNK] = logs[np.arange(len(here)), known.classes[word]] + known.shares[word]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    tail = np.flatnonzero(line[places] >= len(known.codes))
    codes = np.concatenate(texts)[tail] if len(tail) else np.empty(0, np.uint64)
    shares, absent = known.tail_shares(codes)
    out[tail] += shares
    ends = np.searchsorted(owner[tail[absent]], np.arange(1, len(texts)))
    return np.bincount(owner, out, len(texts)), np.split(codes[absent], ends)


def log_likelihoods(
    texts: list[np.ndarray], weights: np.ndarray, known: Vocabulary
) -> np.ndarray:
    """For each text the sum of its words' log probabilities, each given both sides.

    A word in no table of ``known`` counts with its class only.
    """
    return _likelihoods(texts, weights, known)[0]


_SCORED = "row long, doc_id long, n_tokens long, log_likelihood double, rest array<long>"


def _scored(weights, known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCodes()
        for batch in sliced(batches, 4000):
            texts = coder.of(batch.column(2))
            sums, rest = _likelihoods(texts, weights.value, known.value)
            lengths = np.array([len(t) for t in texts], np.int64)
            ends = np.cumsum([0, *map(len, rest)])
            codes = np.concatenate(rest).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(lengths), pa.array(sums), lists],
                ["row", "doc_id", "n_tokens", "log_likelihood", "rest"],
            )

    return run


def _with_rest(scored: DataFrame, counts: DataFrame, known: Vocabulary) -> DataFrame:
    """Adds the shares of the words that no table holds; each occurs less than ``least`` times."""
    scored = stored(scored, "scored")
    rare = counts.filter(F.col("n") < known.least)
    share = F.log((F.coalesce("n", F.lit(0)) + SMOOTHING) / known.others)
    added = (
        scored.select("row", F.explode("rest").alias("code"))
        .join(rare, "code", "left")
        .groupBy("row")
        .agg(F.sum(share).alias("added"))
    )
    total = F.col("log_likelihood") + F.coalesce("added", F.lit(0.0))
    return scored.drop("rest").join(added, "row", "left").withColumn("log_likelihood", total)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``log_likelihood`` and its mean for each row."""
    counts = word_counts(docs)
    weights, known = train(docs, vocabulary(docs, counts))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    scored = rows.mapInArrow(_scored(weights, known), _SCORED)
    if known.value.least > 1:
        scored = _with_rest(scored, counts, known.value)
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.select("doc_id", "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"))
