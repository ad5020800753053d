"""The table of runs: started, finished, failed.

Changes come as frames, which give the new table, or as a log of single changes, which
``fold_runs`` turns into the table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightfolio.functions.stay import as_date, now_or, require_day
from nightfolio.operators.serve import upsert
from nightfolio.schemas import AUDIT, AUDIT_COUNTS, RUN_EVENT

# Kinds of changes in a log, and the state each leaves a run in.
STATUS = {"start": "RUNNING", "finish": "SUCCESS", "fail": "FAILED"}


def start_runs(
    audit: DataFrame, runs: DataFrame, at: Column | datetime | None = None
) -> DataFrame:
    """Enter ``runs`` (run_id, job_name, business_date) as RUNNING.

    A run id that is known keeps its job, date and counts; status, times and error
    are reset.
    """
    batch = runs.select(
        "run_id",
        "job_name",
        "business_date",
        F.lit("RUNNING").alias("status"),
        now_or(at).alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return upsert(
        audit, batch, ["run_id"], ["status", "started_at", "ended_at", "error_message"]
    )


def _update(audit: DataFrame, changes: DataFrame) -> DataFrame:
    """Known runs take the columns of ``changes``; unknown ones are not entered."""
    known = changes.select("*", F.lit(True).alias("_hit")).alias("c")
    hit = F.col("c._hit").isNotNull()
    return (
        audit.alias("a")
        .join(known, F.col("a.run_id") == F.col("c.run_id"), "left")
        .select(
            *[
                F.when(hit, F.col(f"c.{name}")).otherwise(F.col(f"a.{name}")).alias(name)
                if name in changes.columns and name != "run_id"
                else F.col(f"a.{name}")
                for name in audit.columns
            ]
        )
    )


def finish_runs(
    audit: DataFrame, counts: DataFrame, at: Column | datetime | None = None
) -> DataFrame:
    """Set runs to SUCCESS with their counts; a count that is not given becomes null."""
    changes = counts.select(
        "run_id",
        F.lit("SUCCESS").alias("status"),
        *[
            (F.col(name) if name in counts.columns else F.lit(None)).cast("bigint").alias(name)
            for name in AUDIT_COUNTS
        ],
        now_or(at).alias("ended_at"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return _update(audit, changes)


def fail_runs(
    audit: DataFrame, errors: DataFrame, at: Column | datetime | None = None
) -> DataFrame:
    """Set runs to FAILED with their ``error_message``; counts stay."""
    changes = errors.select(
        "run_id",
        F.lit("FAILED").alias("status"),
        now_or(at).alias("ended_at"),
        "error_message",
    )
    return _update(audit, changes)


def _one_row(audit: DataFrame, **values: Column) -> DataFrame:
    return audit.sparkSession.range(1).select(
        *[value.alias(name) for name, value in values.items()]
    )


def start_run(
    audit: DataFrame,
    run_id: str,
    job_name: str,
    business_date: str,
    at: Column | datetime | None = None,
) -> DataFrame:
    run = _one_row(
        audit,
        run_id=F.lit(run_id),
        job_name=F.lit(job_name),
        business_date=as_date(F.lit(require_day(business_date))),
    )
    return start_runs(audit, run, at)


def finish_run(
    audit: DataFrame, run_id: str, at: Column | datetime | None = None, **counts: int | None
) -> DataFrame:
    unknown = set(counts) - set(AUDIT_COUNTS)
    if unknown:
        raise TypeError(f"unknown counts: {', '.join(sorted(unknown))}")
    given = {name: F.lit(count).cast("bigint") for name, count in counts.items()}
    return finish_runs(audit, _one_row(audit, run_id=F.lit(run_id), **given), at)


def fail_run(
    audit: DataFrame, run_id: str, error_message: str, at: Column | datetime | None = None
) -> DataFrame:
    error = _one_row(audit, run_id=F.lit(run_id), error_message=F.lit(error_message))
    return fail_runs(audit, error, at)


def empty_audit(spark) -> DataFrame:
    return spark.createDataFrame([], AUDIT)


_ORDER = ("at", "tick", "id")


def _order(*kinds: str) -> Column:
    """Where a change of one of the kinds stands in the log; null for others."""
    place = F.struct(*_ORDER)
    return F.when(F.col("kind").isin(*kinds), place) if kinds else place


def fold_runs(events: DataFrame) -> DataFrame:
    """The table of runs after all changes of a log, in whatever order they are read.

    One aggregation by run with a rule for each column: job and date are those of the first
    start, the start time that of the last start, the counts those of the last finish, and
    state, end and error follow the last change. A run that was never started is not
    entered, and what came before its first start does not count, as in ``finish_runs``
    and ``fail_runs``.
    """
    start, finish = _order("start"), _order("finish")
    folded = events.groupBy("run_id").agg(
        F.min(start).alias("entered"),
        F.min_by(F.struct("job_name", "business_date"), start).alias("first"),
        F.max_by("at", start).alias("started_at"),
        F.max(finish).alias("finished"),
        F.max_by(F.struct(*AUDIT_COUNTS), finish).alias("counts"),
        F.max_by(F.struct("kind", "at", "error_message"), _order()).alias("last"),
    )
    kind = F.col("last.kind")
    status = F.lit(None).cast("string")
    for name, state in STATUS.items():
        status = F.when(kind == name, state).otherwise(status)
    columns = {
        "run_id": F.col("run_id"),
        "job_name": F.col("first.job_name"),
        "business_date": F.col("first.business_date"),
        "status": status,
        "started_at": F.col("started_at"),
        "ended_at": F.when(kind != "start", F.col("last.at")),
        "error_message": F.when(kind == "fail", F.col("last.error_message")),
    }
    known = F.col("finished") > F.col("entered")
    columns |= {name: F.when(known, F.col(f"counts.{name}")) for name in AUDIT_COUNTS}
    return folded.filter(F.col("entered").isNotNull()).select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in AUDIT]
    )


def deciding_events(events: DataFrame) -> DataFrame:
    """The changes that decide what ``fold_runs`` gives, four for each run at most.

    First and last start, last finish and last change are maxima, so these stand for the
    whole log with whatever is added to it, even what is older.
    """
    events = events.select(*RUN_EVENT.fieldNames())
    row = F.struct(*RUN_EVENT.fieldNames())
    start = _order("start")
    chosen = F.array(
        F.min_by(row, start),
        F.max_by(row, start),
        F.max_by(row, _order("finish")),
        F.max_by(row, _order()),
    )
    return (
        events.groupBy("run_id")
        .agg(F.array_distinct(F.array_compact(chosen)).alias("kept"))
        .select(F.inline("kept"))
    )
