"""Which filter of a chain removes what, in every order of the chain.

Five filters judge whole texts. Four look at one text alone; the fifth fails a document whose
text a smaller id has too. That one is an existential self-join: a left-semi join on hash,
exact text and smaller id. Only texts whose hash several ids have can match, so only these
move, and the other side of the join is one row for each of them, with its smallest id.

The ids that the join finds are united with the failures of the other filters, and what a
document fails becomes a set of bits. Documents with the same part, bits and labels count
as one row from then on; there are at most 128 such rows a part, whatever the number of
documents, and each gives all 120 orders.

Defined results: a null text is empty, a null language the part with the empty name. A null
``doc_id`` is smaller than none and has no labels, and no other id's text is a copy of one
without an id. Each repeated row counts, and rows with one id are no copies of each other.
Several labels of one id hold if any does; a null label does not hold. Other columns are
ignored. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightfolio.llm.common import stored

#: The separators of words, and marks that a clean text does not hold.
SPACES = r"[\x20\x09-\x0D]+"
MARKS = "[#$%&*|]"
LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")
#: Up to so many hashes of repeated texts, 16 bytes each, go to every task.
BROADCAST_HASHES = 1 << 19


def _bit(letter: str, fails: Column) -> Column:
    return F.when(fails, F.lit(1 << LETTERS.index(letter))).otherwise(F.lit(0))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))


def own_failures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``hash`` and the ``bits`` of the filters that need one text only."""
    words = _texts(docs).withColumn(
        "words", F.array_remove(F.split("text", SPACES), "")
    )
    sized = words.select(
        "doc_id",
        "part",
        "hash",
        F.size("words").alias("words"),
        F.size(F.array_distinct("words")).alias("kinds"),
        F.length("text").alias("length"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).alias("capitals"),
        F.col("text").rlike(MARKS).alias("marked"),
    )
    bits = (
        _bit("A", F.col("words") < 200)
        + _bit("B", 100 * F.col("kinds") < 50 * F.col("words"))
        + _bit("C", 100 * F.col("capitals").cast("long") > 3 * F.col("length").cast("long"))
        + _bit("D", F.col("marked"))
    )
    return sized.select("doc_id", "part", "hash", bits.alias("bits"))


def copies(docs: DataFrame, hashes: DataFrame, limit: int = BROADCAST_HASHES) -> DataFrame:
    """``doc_id``, ``part`` and ``hash`` of the rows whose text a smaller id has.

    ``hashes`` has the ``doc_id`` and ``hash`` of all rows. Beyond ``limit`` hashes that
    several ids share, texts meet them in a shuffle instead of a broadcast.
    """
    repeated = stored(
        hashes.groupBy("hash")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last")
        .select("hash"),
        "repeated",
    )
    if repeated.count() <= limit:
        repeated = F.broadcast(repeated)
    suspects = stored(_texts(docs).join(repeated, "hash", "left_semi"), "suspects")
    first = stored(
        suspects.groupBy("hash", "text").agg(F.min("doc_id").alias("first")), "first"
    ).alias("f")
    later = (
        (F.col("s.hash") == F.col("f.hash"))
        & (F.col("s.text") == F.col("f.text"))
        & (F.col("s.doc_id") > F.col("f.first"))
    )
    return suspects.alias("s").join(first, later, "left_semi").select("doc_id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame, limit: int = BROADCAST_HASHES) -> DataFrame:
    """``documents`` for each ``part``, ``mask`` of failed filters and label (good, toxic)."""
    own = stored(own_failures(docs), "failures")
    later = copies(docs, own, limit)
    marks = own.withColumn("rows", F.lit(1)).unionByName(
        later.withColumns({"bits": F.lit(COPY), "rows": F.lit(0)})
    )
    judged = marks.groupBy("doc_id", "part", "hash").agg(
        F.bit_or("bits").alias("mask"), F.sum("rows").alias("rows")
    )
    named = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    no = F.lit(False)
    labelled = (
        judged.filter("doc_id IS NOT NULL")
        .join(named, "doc_id", "left")
        .withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})
        .unionByName(judged.filter("doc_id IS NULL").withColumns({"good": no, "toxic": no}))
    )
    return labelled.groupBy("part", "mask", "good", "toxic").agg(F.sum("rows").alias("documents"))


def interactions(counts: DataFrame) -> DataFrame:
    """What each step of each order does to the documents that ``counts`` has."""
    orders = F.array(*[F.lit("".join(order)) for order in permutations(LETTERS)])
    steps = (
        counts.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    )
    own, earlier = F.lit(0), F.lit(0)
    for letter in LETTERS:
        place = F.instr("filter_order", letter)
        own = own + _bit(letter, place == F.col("step"))
        earlier = earlier + _bit(letter, place < F.col("step"))
    steps = steps.withColumns({"own": own, "earlier": earlier})
    mask = F.col("mask")
    fails = mask.bitwiseAND(F.col("own")) != 0
    gone = mask.bitwiseAND(F.col("earlier")) != 0
    removed = fails & ~gone
    # Of the orders of all filters, each failed one comes before the others in equally many.
    share = F.expr("120 div bit_count(mask)")

    def total(which: Column, times: Column = F.lit(1)) -> Column:
        return F.sum(F.when(which, F.col("documents") * times).otherwise(F.lit(0)))

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(removed).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == F.col("own")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order and step; ``labels`` has doc_id, quality and toxic."""
    return interactions(combinations(docs, labels))
