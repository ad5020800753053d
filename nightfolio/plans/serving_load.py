"""Gold layer to serving table, with staging, reconciliation and audit."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nightfolio.functions.stay import new_run_id
from nightfolio.operators.quality import require_keys
from nightfolio.operators.serve import (
    gold_counts,
    merge_run,
    require_equal_counts,
    require_measures,
    serving_columns,
    to_staging,
    upsert_all,
)
from nightfolio.plans.reservation_batch import BatchCounts
from nightfolio.schemas import APPENDED, SERVING
from nightfolio.sources.files import read_gold, read_layer, write_parquet
from nightfolio.sources.jdbc import read_jdbc, write_jdbc
from nightfolio.sources.paths import delete_directory
from nightfolio.sources.run_log import record_failure, record_finish, record_start
from nightfolio.sources.snapshots import (
    ConflictError,
    commit_info,
    current_version,
    part_names,
    read_snapshot,
    retried,
    versions,
    write_snapshot,
)
from nightfolio.sources.staging import (
    clear_run,
    read_staged,
    require_run_id,
    run_directory,
    stage_run,
)

JOB_NAME = "load_gold_stay_revenue"


def month() -> Column:
    """Month of the night: the serving table's parts. A load rewrites the months it has."""
    return F.date_format("stay_date", "yyyy-MM")


@dataclass(frozen=True)
class LoadCounts:
    run_id: str
    gold: int
    staged: int
    merged: int


class UnrecordedCommit(RuntimeError):
    """A load is committed, but its end could not be recorded."""


def _merged(
    spark: SparkSession,
    serving_path: str,
    staged: DataFrame,
    months: Sequence[str],
    change: Callable[[DataFrame, Observation], DataFrame],
    info: Callable[[Observation], Mapping[str, Any]] = lambda seen: {},
) -> int:
    """Commit what ``change`` makes of the months, again from the new version as long as
    others change them meanwhile. Returns the version.

    What the merge observes is looked at when its rows are written and before they count, so
    bad keys cost no pass of their own and nothing is left to do that could fail after the commit.
    """

    def attempt() -> int:
        version, seen = current_version(spark, serving_path), Observation()

        def judged() -> Mapping[str, Any]:
            if seen.get["bad_keys"]:
                require_keys(staged)
                raise RuntimeError(f"{serving_path} has keys that are incomplete or repeated")
            return info(seen)

        try:
            serving = read_snapshot(spark, serving_path, SERVING, version, months)
            return write_snapshot(
                change(serving, seen),
                serving_path,
                after=version,
                part=month(),
                replaces=months,
                info=judged,
            )
        except ConflictError:
            raise
        except Exception as error:
            if current_version(spark, serving_path) > version + 1:
                # Its files may have been dropped while they were read.
                raise ConflictError(f"version {version} of {serving_path} is gone") from error
            raise

    return retried(attempt)


def run_serving_load(
    spark: SparkSession,
    gold_path: str,
    staging_path: str,
    serving_path: str,
    audit_path: str,
    business_date: str,
    job_name: str = JOB_NAME,
    run_id: str | None = None,
    batch: BatchCounts | None = None,
) -> LoadCounts:
    """Stage gold, check it, merge it into the serving table, and record the run.

    The staged partition is written once and read back, so the count gate sees what
    is on disk. Only months with staged nights are read, merged and written. Loads can run
    side by side: those of different months do not disturb each other, and of two that
    change a month the later one merges again into what the other committed. ``batch``,
    what the run that made gold counted, goes into the record as well. A business date
    that is none, and a measure that the serving table cannot hold, stop the run.

    On any error before the commit the run is recorded as failed, what it staged is removed,
    the serving table stays as it is, and the error goes on to the caller. The commit
    notes the run and its counts and decides: after it the run is a success. Should recording
    that fail, ``UnrecordedCommit`` says so, and ``recover_run`` or the same run again mends it.
    """
    run_id = run_id or new_run_id(job_name, business_date)
    record_start(spark, audit_path, run_id, job_name, business_date)
    try:
        gold = read_gold(spark, gold_path)
        gold_count, lost = gold_counts(gold)
        require_measures(lost)
        stage_run(to_staging(gold, run_id, business_date), staging_path, run_id)

        staged = read_staged(spark, staging_path, run_id)
        staged_count, first, last, months = staged.agg(
            F.count(F.lit(1)), F.min("stay_date"), F.max("stay_date"), F.collect_set(month())
        ).first()
        require_equal_counts(gold_count, staged_count)

        counts = {
            "source_count": batch and batch.raw,
            "bronze_count": batch and batch.raw,
            "silver_count": batch and batch.valid,
            "rejected_count": batch and batch.rejected,
            "gold_count": gold_count,
            "staged_count": staged_count,
            "merged_count": 0,
        }

        def change(serving: DataFrame, seen: Observation) -> DataFrame:
            return merge_run(serving, staged, run_id, first=first, last=last, seen=seen)

        def info(seen: Observation) -> dict[str, Any]:
            counts["merged_count"] = seen.get["merged_count"]
            return {"run_id": run_id, "counts": counts}

        if staged_count:
            _merged(spark, serving_path, staged, months, change, info)
    except Exception as error:
        _quietly(clear_run, spark, staging_path, run_id)
        record_failure(spark, audit_path, run_id, str(error))
        raise
    try:
        record_finish(spark, audit_path, run_id, **counts)
    except Exception as error:
        raise UnrecordedCommit(f"{run_id} is committed, its end is not recorded") from error
    finally:
        _quietly(clear_run, spark, staging_path, run_id)
    return LoadCounts(run_id, gold_count, staged_count, counts["merged_count"])


def _quietly(cleaning: Callable, *args) -> None:
    """Trouble in cleaning up is a warning: it must not hide or change a run's outcome."""
    try:
        cleaning(*args)
    except Exception as error:
        warnings.warn(f"{cleaning.__name__}: {error}", stacklevel=3)


def recover_run(spark: SparkSession, serving_path: str, audit_path: str, run_id: str) -> bool:
    """Record the end of a run that a commit of the serving table notes.

    For a load whose driver was lost between the two, as long as the version it made is kept.
    Returns whether there is such a commit.
    """
    for version in reversed(versions(spark, serving_path)):
        info = commit_info(spark, serving_path, version)
        if info.get("run_id") == run_id:
            record_finish(spark, audit_path, run_id, **info["counts"])
            return True
    return False


def run_upsert_load(
    spark: SparkSession, gold_path: str, staging_path: str, serving_path: str
) -> int:
    """Merge the whole gold layer into the serving table without run bookkeeping.

    It stages in a directory of its own, which alone is removed, come what may. Side by side
    with other loads it behaves as ``run_serving_load``.
    """
    own = run_directory(staging_path, new_run_id("upsert", ""))
    try:
        gold = read_gold(spark, gold_path)
        require_measures(gold_counts(gold)[1])
        batch = serving_columns(gold)
        write_parquet(batch, own)
        staged = read_layer(spark, own, batch.schema)
        staged_count, months = staged.agg(F.count(F.lit(1)), F.collect_set(month())).first()
        if staged_count:
            _merged(
                spark,
                serving_path,
                staged,
                months,
                lambda serving, seen: upsert_all(serving, staged, seen=seen),
            )
    finally:
        _quietly(delete_directory, spark, own)
    return staged_count


def run_append_load(
    spark: SparkSession, gold_path: str, table_path: str, run_id: str | None = None
) -> int:
    """Append gold's serving columns to a table, without looking at keys.

    With a run id the table is one of versions and the run's rows are a part of it: repeating
    the id appends nothing, whatever became of the first attempt, and returns 0;
    ``read_appended`` reads it. Without one, Parquet files are added to a directory, which a
    repeated call does again and a job that dies half-way may have done in part.
    """
    gold = read_gold(spark, gold_path)
    count, lost = gold_counts(gold)
    require_measures(lost)
    rows = serving_columns(gold)
    if run_id is None:
        write_parquet(rows, table_path, mode="append")
        return count
    require_run_id(run_id)

    def attempt() -> int:
        version = current_version(spark, table_path)
        if run_id in part_names(spark, table_path, version):
            return 0
        write_snapshot(
            rows,
            table_path,
            after=version,
            part=F.lit(run_id),
            replaces=[run_id],
            info=lambda: {"run_id": run_id, "rows": count},
        )
        return count

    return retried(attempt) if count else 0


def read_appended(spark: SparkSession, table_path: str) -> DataFrame:
    """All rows of a table that ``run_append_load`` has filled with run ids."""
    return read_snapshot(spark, table_path, APPENDED)


def publish_to_database(
    spark: SparkSession, serving_path: str, config: Mapping[str, Any], table: str
) -> None:
    """Replace a database staging table's rows by the current serving snapshot.

    A lost executor may write a task's rows twice, so the table is counted afterwards and
    a difference is an error. ``table`` is one that no reader uses: putting it in place of
    the live one is a statement of the database, for the caller to run after this returns.
    """
    serving = read_snapshot(spark, serving_path, SERVING)
    write_jdbc(serving, config, table, mode="overwrite", truncate=True)
    require_equal_counts(serving.count(), read_jdbc(spark, config, table).count())
