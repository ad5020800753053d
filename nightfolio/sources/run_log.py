"""The table of runs as a log: each change is a small file of its own.

Recording a change creates one file and reads and rewrites nothing, so any number of jobs
can record at once and what a load writes does not grow with the log. Readers fold the
changes by run. Compaction writes the changes that decide the outcome as one table and
notes in its commit which files it covers; they are deleted by the next compaction, so that
a reader of the table before still finds them.

Changes of a run stand in the order of their time, by the clocks of the drivers that
recorded them; changes of one process keep their order even in one instant.
"""

from __future__ import annotations

import itertools
import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from nightfolio.functions.stay import require_day
from nightfolio.operators.audit import STATUS, deciding_events, fold_runs
from nightfolio.schemas import AUDIT_COUNTS, RUN_EVENT
from nightfolio.sources.paths import create_new, delete_directory, names
from nightfolio.sources.snapshots import (
    commit_info,
    current_version,
    read_snapshot,
    write_snapshot,
)

_TICKS = itertools.count()


def _records(path: str) -> str:
    return f"{path.rstrip('/')}/records"


def _folded(path: str) -> str:
    return f"{path.rstrip('/')}/folded"


def _record(spark: SparkSession, path: str, run_id: str, kind: str, at: datetime | None, **values):
    assert kind in STATUS
    own = uuid.uuid4().hex
    at = at or datetime.now(timezone.utc)
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    change = {
        "run_id": run_id, "kind": kind, "at": at.isoformat(), "tick": next(_TICKS), "id": own,
    }
    text = json.dumps(change | {k: v for k, v in values.items() if v is not None})
    create_new(spark, f"{_records(path)}/{own}.json", text)


def record_start(
    spark: SparkSession,
    path: str,
    run_id: str,
    job_name: str,
    business_date: str,
    at: datetime | None = None,
) -> None:
    """Enter a run as RUNNING. Times without a zone are UTC."""
    _record(
        spark, path, run_id, "start", at,
        job_name=job_name, business_date=require_day(business_date),
    )


def record_finish(
    spark: SparkSession, path: str, run_id: str, at: datetime | None = None, **counts: int | None
) -> None:
    """Set a run to SUCCESS with its counts; a count that is not given becomes null."""
    unknown = set(counts) - set(AUDIT_COUNTS)
    if unknown:
        raise TypeError(f"unknown counts: {', '.join(sorted(unknown))}")
    _record(spark, path, run_id, "finish", at, **counts)


def record_failure(
    spark: SparkSession, path: str, run_id: str, error_message: str, at: datetime | None = None
) -> None:
    """Set a run to FAILED; its counts stay."""
    _record(spark, path, run_id, "fail", at, error_message=error_message)


def _state(spark: SparkSession, path: str) -> tuple[int, list[str], list[str]]:
    """The folded table's version, the files it covers, and all files there are."""
    while True:
        version = current_version(spark, _folded(path))
        covered = commit_info(spark, _folded(path), version).get("covers", [])
        there = [name for name in names(spark, _records(path)) if name.endswith(".json")]
        if version == current_version(spark, _folded(path)):
            return version, covered, there


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """All changes that count, at most once each; no rows where nothing is recorded."""
    version, covered, there = _state(spark, path)
    return _events(spark, path, version, sorted(set(there) - set(covered)))


def _events(spark: SparkSession, path: str, version: int, files: list[str]) -> DataFrame:
    folded = read_snapshot(spark, _folded(path), RUN_EVENT, version)
    if not files:
        return folded
    files = [f"{_records(path)}/{name}" for name in files]
    fresh = spark.read.schema(RUN_EVENT).option("mode", "FAILFAST").json(files)
    return folded.unionByName(fresh)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The table of runs as the log has it now."""
    return fold_runs(read_events(spark, path))


def compact(spark: SparkSession, path: str, least: int = 1) -> int:
    """Fold what was recorded since the last compaction if that are ``least`` files or more.

    Returns how many were. Records that come meanwhile stay files. Of two compactions at
    once one gets a ``ConflictError``, and no record is lost.
    """
    version, covered, there = _state(spark, path)
    fresh = sorted(set(there) - set(covered))
    if len(fresh) < least or not fresh:
        return 0
    kept = deciding_events(_events(spark, path, version, fresh))
    write_snapshot(kept, _folded(path), after=version, info=lambda: {"covers": there})
    for name in covered:
        delete_directory(spark, f"{_records(path)}/{name}")
    return len(fresh)
