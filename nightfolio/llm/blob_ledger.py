"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by its content: a blob. A ledger on disk records
which blob has been scanned with which version of which rule, and what was found. A scan
finds the pairs of blob and rule version that the ledger lacks, reads one text of each such
blob, appends the outcome, and joins the findings back to all paths that hold the blob.

A ledger row is the outcome of one pair, spans or none, so findings and progress cannot
part: a run that dies before its files are committed has scanned nothing. Each run adds
files of its own and rewrites none.

Ids decide first: digests meet the ledger without their texts. Only texts whose digest a bitmap of the
pending ones admits are moved, to be scanned once each, and where nothing is pending no
text is read for it. Copies of a text are dropped in each task before texts
move, so a blob held by a third of all paths is one row per task.

Defined results: an empty table gives no rows and scans nothing; a null text is the empty blob, which has no findings; several versions of
a path are rows of one id, each with its blob's findings; offsets count code points, ends
are exclusive; ties at one start go by the order of ``RULES``; null ids are kept; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from nightfolio.llm.common import Shared, bitmap, stored

BASE = ("assign", "access", "hex")
#: Rule, version, pattern, group whose length counts, least length of it.
RULES = (
    (
        "assign", 1,
        r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8,
    ),
    ("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    # Shorter runs fail, and a longer one is matched whole from its first character.
    ("hex", 1, r"(?<![0-9a-f])[0-9a-f]{32,}+", 0, 32),
    ("private_key", 1, r"-----BEGIN (?:[A-Z]{1,20} ){0,3}PRIVATE KEY-----", 0, 1),
    # From the first character of a run only, so that no run is read from each of its parts.
    (
        "jwt", 2,
        r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
        0, 1,
    ),
    ("forge_token", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat_token", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("url_login", 1, r"://[^\s:/@]{1,100}:[^\s:/@]{1,100}@[A-Za-z0-9.-]+", 0, 1),
)
LEDGER = "blob binary, rule string, version int, spans array<struct<first:long,last:long>>"
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_LEDGER = pa.schema(
    [("blob", pa.binary()), ("rule", pa.string()), ("version", pa.int32()), ("spans", _SPANS)]
)


def spans_of(text: str, pattern: re.Pattern, group: int, least: int) -> list[dict]:
    return [
        {"first": m.start(), "last": m.end()}
        for m in pattern.finditer(text)
        if m.end(group) - m.start(group) >= least
    ]


def blob_of(text: F.Column) -> F.Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _code(blob: F.Column) -> F.Column:
    """64 bits of a digest."""
    return F.conv(F.hex(F.substring(blob, 1, 8)), 16, -10).cast("long")


def _pending_once(pending: Shared):
    """Drops the blobs that cannot be pending, and those that the task has had."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keep = pending.value.may_have(batch.column(2).to_numpy())
            blobs = batch.column(0).to_pylist()
            for k in np.flatnonzero(keep):
                keep[k] = blobs[k] not in seen
                seen.add(blobs[k])
            yield batch.select(["blob", "text"]).filter(pa.array(keep))

    return run


def _scan(rules: tuple):
    """Applies to each blob, once, the rules that its row names by their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(name, v, re.compile(p), g, n) for name, v, p, g, n in rules]
        done: set[bytes] = set()
        for batch in batches:
            out = []
            columns = (batch.column(i).to_pylist() for i in range(3))
            for blob, text, wanted in zip(*columns):
                if blob in done:
                    continue
                done.add(blob)
                for place in wanted:
                    name, version, *rule = compiled[place]
                    out.append((blob, name, version, spans_of(text, *rule)))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, _LEDGER)], schema=_LEDGER
            )

    return run


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All outcomes so far; none where there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def scan_unseen(docs: DataFrame, ledger_path: str, rules: tuple = RULES) -> DataFrame:
    """Scans the pairs of blob and rule version that the ledger lacks; returns the ledger."""
    spark = docs.sparkSession
    ledger = read_ledger(spark, ledger_path)
    wanted = F.array(
        *[F.struct(F.lit(r[0]).alias("rule"), F.lit(r[1]).alias("version"), F.lit(i).alias("place"))
          for i, r in enumerate(rules)]
    )
    had = ledger.select("blob", F.struct("rule", "version").alias("pair")).groupBy("blob").agg(
        F.collect_set("pair").alias("had")
    )
    # One row a blob holds its rules, of which there are few; only ids meet the ledger.
    pending = stored(
        docs.select(blob_of(F.col("text")).alias("blob"))
        .distinct()
        .join(had, "blob", "left")
        .withColumn("had", F.coalesce("had", F.expr("array()")))
        .select(
            "blob",
            F.transform(
                F.filter(
                    wanted,
                    lambda r: ~F.exists(
                        "had",
                        lambda h: (h["rule"] == r["rule"]) & (h["version"] == r["version"]),
                    ),
                ),
                lambda r: r["place"],
            ).alias("wanted"),
        )
        .filter(F.size("wanted") > 0),
        "pending",
    )
    if pending.isEmpty():
        return ledger
    blob, text = blob_of(F.col("text")), F.coalesce("text", F.lit(""))
    named = docs.select(blob.alias("blob"), text.alias("text")).withColumn("code", _code(F.col("blob")))
    admitted = bitmap(pending.select(_code(F.col("blob")).alias("code")))
    found = (
        named.mapInArrow(_pending_once(admitted), "blob binary, text string")
        # However the join is done, all copies of a blob are in one task, which scans one.
        .repartition("blob")
        .join(pending, "blob")
        .select("blob", "text", "wanted")
        .mapInArrow(_scan(rules), LEDGER)
    )
    found.write.mode("append").parquet(ledger_path)
    return read_ledger(spark, ledger_path)


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple = RULES) -> DataFrame:
    """The findings of the given rule versions for every row, through its blob."""
    order = {r[0]: i for i, r in enumerate(rules)}
    current = F.array(*[F.struct(F.lit(r[0]).alias("rule"), F.lit(r[1]).alias("version")) for r in rules])
    place = F.coalesce(*[F.when(F.col("rule") == name, i) for name, i in order.items()])
    per_blob = (
        ledger.filter(F.size("spans") > 0)
        .filter(F.array_contains(current, F.struct("rule", "version")))
        .select("blob", place.alias("kind"), F.explode("spans").alias("s"))
        .groupBy("blob")
        # A run that was repeated may have left an outcome twice.
        .agg(F.array_sort(F.collect_set(F.struct("s.first", "kind", "s.last"))).alias("s"))
    )
    paths = docs.select("doc_id", blob_of(F.col("text")).alias("blob"))
    return paths.join(per_blob, "blob", "left").select(
        "doc_id", "blob", F.coalesce("s", F.expr("array()")).alias("s")
    )


def _is_kind(kind: int):
    # A second parameter, even with a default, would be the place in the array.
    return lambda span: span["kind"] == kind


def _joined(spans, rules: tuple) -> F.Column:
    names = F.array(*[F.lit(r[0]) for r in rules])
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["first"], s["last"])),
    )


def report(docs: DataFrame, ledger_path: str, rules: tuple = RULES) -> DataFrame:
    """Counts, digest and spans for each row, after a scan of what the ledger lacks."""
    rows = findings(docs, scan_unseen(docs, ledger_path, rules), rules)
    base = F.filter("s", lambda s: s["kind"] < len(BASE))
    counts = [
        F.size(F.filter("s", _is_kind(k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(BASE)
    ]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_joined(base, rules), 256).alias("base_sha256"),
        _joined(F.col("s"), rules).alias("spans"),
        F.lower(F.hex("blob")).alias("blob"),
    )
