"""Cost-balanced packing of documents into sequences.

A document's token ids, closed by an end mark, are cut into pieces; the estimated cost of
a piece is its length (dense layers) plus its length squared (attention inside the
document). Whole capacities of a long document are sequences of their own. The remainders
of a block of documents are taken in descending order; each goes to the sequence of lowest
cost that has room for it, and, where none has, is cut to fill the one of lowest cost with
any room. A block opens as many sequences as its tokens fill; what is left over fills
sequences whose sizes are powers of two, so no sequence needs padding.

Blocks are cut from the stream of a task, so the work needs no shuffle, a task holds the
remainders of one block only, and a lost task packs its own rows again to the same result.

Token ids come from the tokenizer's own merges, which ``tiktoken`` applies; a text that
spells a special token or has a very long run of white space, and a vocabulary whose ids
are not in merge order, go through ``tokenizers``.

Defined results: a null or empty text is one piece, the end mark; repeated rows are packed
each; null ids are kept; a document's pieces have ascending ``start``; other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CAPACITY = 2048
END = 1
#: Cost of a token, and of a pair of tokens that attend to each other.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Documents of a block: 2,048 remainders of 1,024 tokens on average fill 1,024 sequences.
BLOCK_DOCUMENTS = 2048

_COLUMNS = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    for place, byte in enumerate(b for b in range(256) if b not in plain):
        letters[chr(256 + place)] = byte
    return letters


class Encoder:
    """Texts to token ids, as ``tokenizers`` gives them without added special tokens."""

    PATTERN = (
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    )
    #: A text with a longer run of white space, at any place, goes to the slower library:
    #: the pattern steps back through such a run, and fails above some 900,000 characters.
    RUN = 20_000
    #: Begins at the first character of a run only, so a search takes linear time.
    LONG_RUN = re.compile(rf"(?<!\s)\s{{{RUN + 1}}}")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = _byte_letters()
        added = set(self.special)
        ranks = {
            bytes(letters[c] for c in piece): number
            for piece, number in spec["model"]["vocab"].items()
            if piece not in added and all(c in letters for c in piece)
        }
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ordered = all(
            spec["model"]["vocab"].get("".join(m)) == 256 + i for i, m in enumerate(merges)
        )
        plain = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel"
        self.quick = None
        if ordered and plain and not spec["pre_tokenizer"]["add_prefix_space"]:
            self.quick = tiktoken.Encoding(
                "byte_bpe", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def _needs_slow(self, text: str) -> bool:
        if self.quick is None or any(s in text for s in self.special):
            return True
        return len(text) > self.RUN and self.LONG_RUN.search(text) is not None

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.array([END], np.uint32)
        if self._needs_slow(text):
            ids = self.slow.encode(text, add_special_tokens=False).ids
            return np.array([*ids, END], np.uint32)
        ids = self.quick.encode_to_numpy(text, disallowed_special=())
        return np.append(ids, END).astype(np.uint32)


def cost(length):
    return LINEAR * length + QUADRATIC * length * length


def sequence_sizes(total: int, capacity: int = CAPACITY) -> list[int]:
    """Sequences that ``total`` tokens fill: whole ones, then powers of two."""
    sizes = [capacity] * (total // capacity)
    rest = total % capacity
    return sizes + [1 << bit for bit in range(rest.bit_length())[::-1] if rest >> bit & 1]


def pack(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Pieces (document, start, length, sequence, offset), and the number of sequences.

    ``lengths`` are those of the documents' remainders.
    """
    sizes = np.array(sequence_sizes(sum(lengths), capacity), np.int64)
    room = sizes.copy()
    load = np.zeros(len(sizes))
    pieces = []
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    for document in order:
        start, left = 0, lengths[document]
        while left:
            fits = room >= left
            open_ = fits if fits.any() else room > 0
            best = int(np.where(open_, load, np.inf).argmin())
            size = min(left, int(room[best]))
            pieces.append((document, start, size, best, int(sizes[best] - room[best])))
            room[best] -= size
            load[best] += cost(size)
            start, left = start + size, left - size
    return pieces, len(sizes)


def _packed(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        names = [c.split()[0] for c in _COLUMNS.split(", ")]
        first = TaskContext.get().partitionId() << 36
        used = 0
        rest: list[tuple[int | None, int, int, np.ndarray]] = []

        def crc(ids: np.ndarray) -> int:
            return zlib.crc32(ids.astype("<u4").tobytes())

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names)

        def block() -> list[tuple]:
            nonlocal used
            pieces, sequences = pack([len(r[3]) for r in rest], capacity)
            rows = []
            for document, start, size, sequence, offset in pieces:
                doc, tokens, begin, ids = rest[document]
                part = ids[start : start + size]
                rows.append(
                    (doc, begin + start, size, crc(part), tokens, first + used + sequence, offset)
                )
            used += sequences
            rest.clear()
            return rows

        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py())
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    part = ids[start : start + capacity]
                    rows.append((doc, start, capacity, crc(part), len(ids), first + used, 0))
                    used += 1
                if whole < len(ids):
                    rest.append((doc, len(ids), whole, ids[whole:].copy()))
                if len(rest) >= BLOCK_DOCUMENTS:
                    rows += block()
            yield table(rows)
        yield table(block())

    return run


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = tokenizer or default_tokenizer()
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_packed(path, capacity), _COLUMNS)
