"""Repeatable draws from a row number, in plain 64-bit integer arithmetic.

A draw depends on the row, the seed and the stream only, so a task that runs again
after a lost executor gives the same rows, and any SQL engine can recompute them.
Every product stays below 2^62.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 2147483647  # 2^31 - 1, prime
ROUND_MULTIPLIERS = (1103515245, 1664525525)
STREAM_STEP = 715827883
WORD_OFFSETS = (1, 1234567891)


def _scramble(value: Column) -> Column:
    for multiplier in ROUND_MULTIPLIERS:
        value = (value.bitwiseXOR(F.shiftright(value, 15)) * F.lit(multiplier)) % F.lit(MODULUS)
    return value


def seed_words(seed: int, business_date: str) -> tuple[int, int]:
    """Two unrelated words for a seed and a date."""
    digest = hashlib.sha256(f"{seed}:{business_date}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 8], "big") % MODULUS for i in (0, 8))


def row_state(index: Column, seed: int, business_date: str) -> Column:
    """Two scrambled words of one row, ``a`` and ``b``.

    Both words of the row number are scrambled before they meet those of the seed and the
    date, so that no other seed, date or row shares a run of states.
    """
    low = index % F.lit(MODULUS)
    high = F.call_function("div", index, F.lit(MODULUS)) % F.lit(MODULUS)

    def word(offset: int, own: int) -> Column:
        parts = (_scramble((part + F.lit(offset)) % F.lit(MODULUS)) for part in (low, high))
        # Twice the high word: the words of a row number must not be exchangeable.
        mixed = next(parts) + F.lit(2) * next(parts) + F.lit(own)
        return _scramble(mixed % F.lit(MODULUS))

    words = zip(WORD_OFFSETS, seed_words(seed, business_date))
    return F.struct(*[word(*pair).alias(name) for name, pair in zip("ab", words)])


def draw(state: Column, stream: int, low: int, high: int) -> Column:
    """Uniform whole number in ``low..high``, both included."""
    step = F.lit(stream * STREAM_STEP % MODULUS)
    start = (state["a"] + (state["b"] * step) % F.lit(MODULUS)) % F.lit(MODULUS)
    return F.lit(low) + _scramble(start) % F.lit(high - low + 1)


def pick(state: Column, stream: int, values: list[str]) -> Column:
    """One of ``values``, uniformly."""
    position = draw(state, stream, 1, len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(value) for value in values]), position)


def random_date(base: Column, state: Column, stream: int, low: int = 1, high: int = 60) -> Column:
    return F.date_add(base, draw(state, stream, low, high).cast("int"))
