"""Language ID: a linear-chain conditional random field over the words of a text.

A word's label is its language. Features are hashed character n-grams within word
boundaries, affixes, and a lexicon of words with their log-odds per language; transitions
between neighbouring words are learned with them, on sequences put together from pieces of
labelled documents in several languages, so that switching is in the training data. The
forward-backward pass gives each word its marginals; a document's language is that with
the largest share of its words' marginals, and the share is its score.

Fitting uses a sample that ``FIT_DOCUMENTS`` per language and ``FIT_CHARS`` characters of
each bound, drawn by hash from all labelled rows. Every word of every text is predicted.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Words
without a letter take no part. Ties go to the label that sorts first. Without a labelled
row everything is ``und``. Repeated rows are predicted alike; null ids are never held out
and never learned from; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import Shared, uniform

UNKNOWN = "und"
FIT_DOCUMENTS = 500
FIT_CHARS = 1200
FEATURE_BITS = 15
EPOCHS = 3
SEQUENCE = 48
#: Words that go through one forward-backward pass together.
PASS_WORDS = 400_000
#: Words whose emissions a task keeps for when they come again.
KNOWN_WORDS = 150_000
_FACTOR = 0x9E3779B1


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # features by labels
    lexicon: dict[str, np.ndarray]
    lexicon_scale: np.ndarray
    transitions: np.ndarray


def core(word: str) -> str:
    """A word without what stands around its letters, in lower case; empty without a letter."""
    word = word.lower()
    if word.isalpha():
        return word
    first, last = 0, len(word)
    while first < last and not word[first].isalpha():
        first += 1
    while last > first and not word[last - 1].isalpha():
        last -= 1
    return word[first:last]


def _hashed(parts: np.ndarray, salt: int) -> np.ndarray:
    value = (parts + np.uint32(salt)) * np.uint32(_FACTOR)
    return (value ^ (value >> np.uint32(15))) & np.uint32((1 << FEATURE_BITS) - 1)


def feature_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of many words at once, and where each word's features start.

    A word stands between boundary marks. Every position gives the n-grams of one to
    three characters that end there; prefixes and suffixes have hashes of their own.
    """
    text = "\x02" + "\x03\x02".join(words) + "\x03"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    ends = starts + lengths - 1
    factor = np.uint32(_FACTOR)
    one = codes * factor
    two = one.copy()
    two[1:] = (one[:-1] ^ (one[:-1] >> np.uint32(13))) * np.uint32(0x85EBCA6B) + one[1:]
    three = two.copy()
    three[1:] = (two[:-1] ^ (two[:-1] >> np.uint32(11))) * np.uint32(0xC2B2AE35) + one[1:]
    # At a word's first mark a two-gram would reach back into the word before.
    two[starts] = one[starts]
    three[starts] = one[starts]
    three[starts + 1] = two[starts + 1]
    grams = np.stack([_hashed(one, 1), _hashed(two, 2), _hashed(three, 3)], axis=1)
    width = 3
    wide = np.empty((len(codes), width), np.uint32)
    wide[:] = grams
    # Affixes of two and three letters: the hashes at the places where they end.
    affixes = np.stack(
        [
            _hashed(three[np.minimum(starts + 2, ends)], 11),
            _hashed(three[np.minimum(starts + 3, ends)] ^ two[np.minimum(starts + 1, ends)], 12),
            _hashed(three[ends], 13),
            _hashed(three[ends] ^ two[np.maximum(ends - 2, starts)], 14),
        ],
        axis=1,
    )
    sizes = lengths * width + affixes.shape[1]
    offsets = np.cumsum(sizes) - sizes
    ids = np.empty(int(sizes.sum()), np.int64)
    place = np.repeat(offsets - starts * width, lengths * width) + np.arange(len(codes) * width)
    ids[place] = wide.ravel()
    for step in range(affixes.shape[1]):
        ids[offsets + lengths * width + step] = affixes[:, step]
    return ids, offsets


def _emissions(model: Model, words: list[str]) -> np.ndarray:
    ids, offsets = feature_ids(words)
    scores = np.add.reduceat(model.weights[ids], offsets, axis=0)
    none = np.zeros(len(model.labels), np.float32)
    known = np.array([model.lexicon.get(w, none) for w in words], np.float32)
    return scores + known * model.lexicon_scale


def marginal_sums(
    emissions: np.ndarray, transitions: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """For sequences laid end to end, the sum of their words' forward-backward marginals.

    All sequences step forward together; longer ones go on alone.
    """
    labels = emissions.shape[1]
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    steps = int(sizes[0])
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(steps), side="right")
    offsets = np.concatenate([[0], np.cumsum(active)])
    starts = (np.cumsum(lengths) - lengths)[order]
    rank = np.repeat(np.arange(len(sizes)), sizes)
    time = np.arange(len(rank)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = np.empty(len(rank), np.int64)
    inside[offsets[time] + rank] = np.repeat(starts, sizes) + time
    del rank, time
    local = emissions[inside]
    del inside
    local -= local.max(axis=1, keepdims=True)
    np.exp(local, out=local)
    step_weights = np.exp(transitions - transitions.max()).astype(local.dtype)
    ahead = np.empty_like(local)
    before = local[: active[0]] / local[: active[0]].sum(axis=1, keepdims=True)
    ahead[: active[0]] = before
    for t in range(1, steps):
        rows = slice(offsets[t], offsets[t + 1])
        now = (before[: active[t]] @ step_weights) * local[rows]
        now /= now.sum(axis=1, keepdims=True)
        ahead[rows] = before = now
    sums = np.zeros((len(sizes), labels))
    behind = np.ones((len(sizes), labels), local.dtype)
    back = step_weights.T.copy()
    for t in range(steps - 1, -1, -1):
        rows = slice(offsets[t], offsets[t + 1])
        if t + 1 < steps:
            many = active[t + 1]
            after = (local[offsets[t + 1] : offsets[t + 2]] * behind[:many]) @ back
            after /= after.sum(axis=1, keepdims=True)
            behind[:many] = after
        share = ahead[rows] * behind[: active[t]]
        share /= share.sum(axis=1, keepdims=True)
        sums[: active[t]] += share
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _sequences(rows: list[tuple[str, str]], labels: list[str], rng) -> list[tuple]:
    """Training sequences of fixed length, put together from pieces of 6 to 24 words."""
    position = {label: i for i, label in enumerate(labels)}
    pieces = []
    for lang, text in rows:
        words = [w for w in map(core, text.split()) if w]
        at = 0
        while at < len(words):
            size = int(rng.integers(6, 25))
            pieces.append((position[lang], words[at : at + size]))
            at += size
    order = rng.permutation(len(pieces))
    words, marks = [], []
    for i in order:
        label, piece = pieces[i]
        words += piece
        marks += [label] * len(piece)
    return words, np.array(marks, np.int64)


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """Maximum likelihood by stochastic gradients of the forward-backward pass."""
    labels = sorted({lang for lang, _ in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    count = len(labels)
    words, marks = _sequences(rows, labels, rng)
    weights = np.zeros((1 << FEATURE_BITS, count), np.float32)
    transitions = np.zeros((count, count))
    scale = np.ones(count, np.float32) * 0.5
    seen = {}
    for word, mark in zip(words, marks):
        seen.setdefault(word, np.zeros(count))[mark] += 1
    lexicon = {}
    prior = np.bincount(marks, minlength=count) + 1.0 if len(marks) else np.ones(count)
    for word, found in seen.items():
        if found.sum() >= 2:
            odds = np.log((found + 0.2) / prior)
            lexicon[word] = np.clip(odds - odds.mean(), -4, 4).astype(np.float32)
    model = Model(labels, weights, lexicon, scale, transitions)
    whole = len(words) // SEQUENCE * SEQUENCE
    if count == 1 or not whole:
        return model
    names = sorted(seen)
    index = {word: i for i, word in enumerate(names)}
    ids, offsets = feature_ids(names)
    sizes = np.diff(np.append(offsets, len(ids)))
    none = np.zeros(count, np.float32)
    known = np.array([lexicon.get(w, none) for w in names], np.float32)
    chain = np.array([index[w] for w in words[:whole]]).reshape(-1, SEQUENCE)
    gold = marks[:whole].reshape(-1, SEQUENCE)
    square = np.zeros_like(weights)
    square_t = np.zeros_like(transitions)
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(chain)), max(1, len(chain) // 48)):
            rows_, target = chain[batch], gold[batch]
            used, inverse = np.unique(rows_, return_inverse=True)
            inverse = inverse.reshape(rows_.shape)
            places = np.repeat(offsets[used] - np.cumsum(sizes[used]) + sizes[used], sizes[used])
            own = ids[places + np.arange(len(places))]
            begin = np.cumsum(sizes[used]) - sizes[used]
            score = np.add.reduceat(weights[own], begin, axis=0) + known[used] * scale
            local = np.exp(score - score.max(axis=1, keepdims=True))[inverse].astype(float)
            step = np.exp(transitions)
            ahead, behind = np.empty_like(local), np.ones_like(local)
            ahead[:, 0] = local[:, 0] / local[:, 0].sum(1, keepdims=True)
            for t in range(1, SEQUENCE):
                now = (ahead[:, t - 1] @ step) * local[:, t]
                ahead[:, t] = now / now.sum(1, keepdims=True)
            for t in range(SEQUENCE - 2, -1, -1):
                now = (local[:, t + 1] * behind[:, t + 1]) @ step.T
                behind[:, t] = now / now.sum(1, keepdims=True)
            share = ahead * behind
            share /= share.sum(2, keepdims=True)
            truth = np.eye(count)[target]
            slope = np.zeros((len(used), count))
            np.add.at(slope, inverse.ravel(), (truth - share).reshape(-1, count))
            joint = (
                ahead[:, :-1, :, None] * step * (local[:, 1:] * behind[:, 1:])[:, :, None, :]
            )
            joint /= joint.sum((2, 3), keepdims=True)
            slope_t = (truth[:, :-1, :, None] * truth[:, 1:, None, :] - joint).sum((0, 1))
            slope_t -= 0.01 * transitions
            change = np.repeat(slope, sizes[used], axis=0)
            flat = np.stack(
                [np.bincount(own, change[:, k], len(weights)) for k in range(count)], axis=1
            )
            square += flat * flat
            weights += (0.1 * flat / np.sqrt(square + 1e-3)).astype(np.float32)
            square_t += slope_t * slope_t
            transitions += 0.1 * slope_t / np.sqrt(square_t + 1e-3)
            scale += np.float32(0.002) * (slope * known[used]).sum(0).astype(np.float32) / len(used)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows kept from fitting: CRC-32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, per_language: int = FIT_DOCUMENTS) -> list[tuple[str, str]]:
    """A bounded sample of labelled rows, alike in size for each language."""
    labelled = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
    ).filter(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    rate = F.coalesce(
        *[F.when(F.col("lang") == k, min(1.0, per_language / n)) for k, n in counts.items()]
    )
    free = F.greatest(F.length("text") - FIT_CHARS, F.lit(1))
    start = (uniform("doc_id", F.lit(5)) * free).cast("int") + 1
    chosen = labelled.filter(uniform("doc_id", F.lit(3)) < rate).select(
        "lang", F.substring("text", start, F.lit(FIT_CHARS)).alias("piece"), "doc_id"
    )
    return sorted((r["lang"], r["piece"]) for r in chosen.collect())


class _Known(dict):
    """Numbers the distinct words that a task meets; 0 stands for no letter."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []
        self.numbers: dict[str, int] = {"": 0}

    def __missing__(self, raw: str) -> int:
        word = core(raw)
        number = self.numbers.get(word)
        if number is None:
            number = self.numbers[word] = len(self.numbers)
            self.fresh.append(word)
        self[raw] = number
        return number


def prediction(model):
    """Batches of texts to ``lang_pred`` and ``score``; ``model`` is a broadcast variable."""

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = model.value
        known, table = _Known(), None
        for texts in batches:
            names = np.full(len(texts), UNKNOWN, object)
            scores = np.zeros(len(texts))
            waiting, at, total = [], [], 0

            def finish():
                nonlocal known, table
                if known.fresh:
                    if table is None:
                        table = np.zeros((1, len(fitted.labels)), np.float32)
                    fresh, known.fresh = known.fresh, []
                    parts = [fresh[i : i + 20_000] for i in range(0, len(fresh), 20_000)]
                    table = np.concatenate([table, *(_emissions(fitted, p) for p in parts)])
                lengths = np.fromiter(map(len, waiting), np.int64, len(waiting))
                sums = marginal_sums(table[np.concatenate(waiting)], fitted.transitions, lengths)
                best = sums.argmax(axis=1)
                names[at] = np.array(fitted.labels, object)[best]
                scores[at] = np.clip(sums[np.arange(len(best)), best] / lengths, 0, 1)
                if len(known) > KNOWN_WORDS:
                    known, table = _Known(), None

            for i, text in enumerate(texts if fitted is not None else []):
                # One text at a time becomes Python objects.
                words = (text.as_py() or "").split()
                found = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                found = found[found > 0]
                if len(found):
                    waiting.append(found)
                    at.append(i)
                    total += len(found)
                if total >= PASS_WORDS:
                    finish()
                    waiting, at, total = [], [], 0
            if waiting:
                finish()
            yield pa.StructArray.from_arrays(
                [pa.array(names.tolist(), pa.string()), pa.array(scores)], ["lang_pred", "score"]
            )

    return predict


def predictor(model):
    """``prediction`` as a column function."""
    return F.arrow_udf(prediction(model), "lang_pred string, score double")


def fitted_on(docs: DataFrame):
    """The model of a table's labelled rows, as a broadcast variable."""
    return Shared(docs.sparkSession, fit(training_rows(docs)))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` for each row."""
    predict = predictor(fitted_on(docs))
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """The rows whose text has a language by at least ``min_score`` of its words."""
    predict = predictor(fitted_on(docs))
    columns = docs.columns
    return (
        docs.select(*columns, predict("text").alias("__found"))
        .filter((F.col("__found.lang_pred") != UNKNOWN) & (F.col("__found.score") >= min_score))
        .select(*columns)
    )
