"""Staging projection, keyed merge and run reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from nightfolio.functions.stay import as_date, now_or, require_day
from nightfolio.schemas import GOLD_KEYS, MONEY, SERVING, STAGING

STAGING_SOURCE = "gold_parquet_layer"

MEASURES = ("reservation_count", "booked_rooms", "total_revenue", "adr", "gold_ingestion_ts")


def serving_columns(gold: DataFrame) -> DataFrame:
    """Gold in the serving table's types; what does not fit becomes null. The loads count
    such values by :func:`gold_counts` and stop."""
    return gold.select(
        "property_code",
        "stay_date",
        F.col("reservation_count").try_cast("int").alias("reservation_count"),
        F.col("booked_rooms").try_cast("int").alias("booked_rooms"),
        F.col("total_revenue").try_cast(MONEY).alias("total_revenue"),
        F.col("adr").try_cast(MONEY).alias("adr"),
        "gold_ingestion_ts",
    )


def gold_counts(gold: DataFrame) -> tuple[int, int]:
    """Rows of gold, and those with a measure that the serving table cannot hold."""
    cast = serving_columns(gold).schema
    lost = F.lit(False)
    for name in MEASURES[:-1]:
        value = F.col(name)
        lost = lost | (value.isNotNull() & value.try_cast(cast[name].dataType).isNull())
    return tuple(gold.agg(F.count(F.lit(1)), F.count_if(lost)).first())


def require_measures(lost: int) -> None:
    if lost:
        raise ValueError(f"{lost} rows of gold have measures that the serving table cannot hold")


def to_staging(gold: DataFrame, run_id: str, business_date: str) -> DataFrame:
    """Serving columns stamped with the run, in the staging table's order."""
    return (
        serving_columns(gold)
        .withColumns(
            {
                "run_id": F.lit(run_id),
                "business_date": as_date(F.lit(require_day(business_date))),
                "source_system": F.lit(STAGING_SOURCE),
            }
        )
        .select(*STAGING.fieldNames())
    )


def with_staged_at(staged: DataFrame, at: Column | datetime | None = None) -> DataFrame:
    return staged.withColumn("staged_at", now_or(at))


def of_run(df: DataFrame, run_id: str, column: str = "run_id") -> DataFrame:
    return df.filter(F.col(column) == run_id)


def without_run(staged: DataFrame, run_id: str) -> DataFrame:
    """Staging after the rows of one run are deleted; rows without a run id stay."""
    return staged.filter(~F.col("run_id").eqNullSafe(F.lit(run_id)))


def run_count(df: DataFrame, run_id: str, column: str = "run_id") -> DataFrame:
    """Rows of one run, as a one-row frame."""
    return of_run(df, run_id, column).agg(F.count(F.lit(1)).alias("row_count"))


def scalar(df: DataFrame):
    """First column of the first row, or None."""
    row = df.first()
    return None if row is None else row[0]


def require_equal_counts(gold_count: int, staged_count: int) -> None:
    if staged_count != gold_count:
        raise ValueError(f"staged {staged_count} rows of {gold_count} in gold")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    overwrite: Sequence[str],
    on_update: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The target after ``batch`` is merged into it by key, in the target's columns.

    On a match the ``overwrite`` columns take the batch's value, null included, and
    ``on_update`` columns the given one. A new key takes whatever columns the batch
    has. Other target rows and columns stay as they are. Keys must be complete and
    unique on both sides.
    """
    on_update = on_update or {}
    old = target.select(*target.columns, F.lit(True).alias("_old")).alias("t")
    new = batch.select(
        *[name for name in target.columns if name in batch.columns], F.lit(True).alias("_new")
    ).alias("b")
    is_old = F.col("t._old").isNotNull()
    is_new = F.col("b._new").isNotNull()

    def merged(name: str) -> Column:
        kept = F.col(f"t.{name}")
        given = F.col(f"b.{name}") if name in batch.columns else F.lit(None)
        if name in keys:
            return F.coalesce(kept, given)
        if name in on_update:
            return F.when(is_old & is_new, on_update[name]).when(is_old, kept).otherwise(given)
        if name in overwrite:
            return F.when(is_new, given).otherwise(kept)
        return F.when(is_old, kept).otherwise(given)

    matches = F.lit(True)
    for key in keys:
        matches = matches & (F.col(f"t.{key}") == F.col(f"b.{key}"))
    return old.join(new, matches, "full_outer").select(
        *[merged(field.name).cast(field.dataType).alias(field.name) for field in target.schema]
    )


_SIDE, _BAD = "_new", "_bad"


def merge_by_key(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    overwrite: Sequence[str],
    on_update: Mapping[str, Column] | None = None,
) -> DataFrame:
    """As :func:`upsert`, in one aggregation that also judges the keys.

    Old and new rows become one frame with a tag and meet by key, after one shuffle and one
    sort of both. The column ``_bad`` marks keys that are incomplete or that the batch, or
    the target, has more than once; the other columns of such a row mean nothing.
    """
    on_update = on_update or {}
    given = [name for name in target.columns if name in batch.columns]
    fields = {field.name: field.dataType for field in target.schema}
    old = target.select(*target.columns, F.lit(False).alias(_SIDE))
    new = batch.select(
        *[
            (F.col(name) if name in given else F.lit(None)).cast(kind).alias(name)
            for name, kind in fields.items()
        ],
        F.lit(True).alias(_SIDE),
    )
    # Dealt out here, so that the aggregation has its partial and its last step in one task.
    rows = old.unionByName(new).repartition(*keys)
    measures = [name for name in target.columns if name not in keys]

    def side(name: str, is_new: bool) -> Column:
        # One row of a side at most, so its value is the largest; a null stays one.
        of_side = F.when(F.col(_SIDE) == F.lit(is_new), F.col(name))
        return F.max(of_side).alias(f"{'new' if is_new else 'old'}_{name}")

    met = rows.groupBy(*keys).agg(
        F.count_if(F.col(_SIDE)).alias("new_rows"),
        F.count_if(~F.col(_SIDE)).alias("old_rows"),
        *[side(name, False) for name in measures],
        *[side(name, True) for name in measures if name in given],
    )
    is_old, is_new = F.col("old_rows") > 0, F.col("new_rows") > 0

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        kept = F.col(f"old_{name}")
        value = F.col(f"new_{name}") if name in given else F.lit(None)
        if name in on_update:
            return F.when(is_old & is_new, on_update[name]).when(is_old, kept).otherwise(value)
        if name in overwrite:
            return F.when(is_new, value).otherwise(kept)
        return F.when(is_old, kept).otherwise(value)

    bad = (F.col("new_rows") > 1) | (F.col("old_rows") > 1)
    for key in keys:
        bad = bad | F.col(key).isNull()
    return met.select(
        *[merged(name).cast(kind).alias(name) for name, kind in fields.items()], bad.alias(_BAD)
    )


def _checked(
    merged: DataFrame, keys: Sequence[str], seen: Observation | None, run_id: str | None
) -> DataFrame:
    """Without the mark: counted by ``seen`` as ``bad_keys``, beside the run's rows as
    ``merged_count``, or else an error when the result is computed."""
    if seen is not None:
        of_run = F.lit(False) if run_id is None else F.col("last_run_id") == run_id
        counted = F.count_if(_BAD).alias("bad_keys"), F.count_if(of_run).alias("merged_count")
        return merged.observe(seen, *counted).drop(_BAD)
    first, *rest = keys
    message = F.lit(f"incomplete or repeated keys {tuple(keys)}")
    checked = F.when(F.col(_BAD), F.raise_error(message)).otherwise(F.col(first))
    return merged.withColumn(first, checked).drop(_BAD)


def merge_run(
    serving: DataFrame,
    staged: DataFrame,
    run_id: str,
    at: Column | datetime | None = None,
    first: date | None = None,
    last: date | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """The serving table after the staged rows of one run are merged into it.

    ``first`` and ``last`` are the earliest and latest night staged by the run, if
    known: nights outside cannot match and bypass the shuffle. A batch that has a
    night outside them is an error when the result is computed, and so are incomplete or
    repeated keys. With ``seen`` these are counted instead, as ``bad_keys``: who writes the
    result must look at the count before anybody reads it. ``seen`` also gets the rows that
    bear the run's id, as ``merged_count``.
    """
    now = now_or(at)
    batch = (
        of_run(staged, run_id)
        .withColumnRenamed("run_id", "last_run_id")
        .withColumn("created_at", now)
    )
    overwrite = [
        name
        for name in SERVING.fieldNames()
        if name not in (*GOLD_KEYS, "created_at", "updated_at")
    ]
    serving = serving.select(*SERVING.fieldNames())
    on_update = {"updated_at": now}
    if first is None or last is None:
        merged = merge_by_key(serving, batch, GOLD_KEYS, overwrite, on_update)
        return _checked(merged, GOLD_KEYS, seen, run_id)
    night = F.col("stay_date")
    message = F.lit(f"a staged night is not between {first} and {last}")
    within = night.isNull() | night.between(F.lit(first), F.lit(last))
    batch = batch.withColumn(
        "stay_date", F.when(within, night).otherwise(F.raise_error(message))
    )
    inside = serving.filter(night.between(F.lit(first), F.lit(last)))
    outside = serving.filter((night < F.lit(first)) | (night > F.lit(last)) | night.isNull())
    merged = merge_by_key(inside, batch, GOLD_KEYS, overwrite, on_update)
    both = merged.unionByName(outside.withColumn(_BAD, F.lit(False)))
    return _checked(both, GOLD_KEYS, seen, run_id)


def upsert_all(
    serving: DataFrame,
    staged: DataFrame,
    at: Column | datetime | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """The serving table after everything staged is merged into it, whatever the run.

    Only the measures are taken over; run, date and source columns, where the serving
    table has them, stay. Keys are judged as in :func:`merge_run`.
    """
    now = now_or(at)
    batch = staged.select(*GOLD_KEYS, *MEASURES).withColumn("created_at", now)
    merged = merge_by_key(serving, batch, GOLD_KEYS, MEASURES, {"updated_at": now})
    return _checked(merged, GOLD_KEYS, seen, None)


def append_load(table: DataFrame, gold: DataFrame) -> DataFrame:
    """The table with gold's serving columns appended, without looking at keys."""
    return table.unionByName(serving_columns(gold), allowMissingColumns=True)
