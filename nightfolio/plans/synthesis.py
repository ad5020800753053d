"""Synthetic reservations, stored as CSV and JSON lines."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from nightfolio.operators.synth import synthesise
from nightfolio.sources.files import write_events_json, write_reservations_csv


def store(
    records: DataFrame,
    events: DataFrame,
    business_date: str,
    csv_directory: str,
    json_directory: str,
) -> tuple[str, str]:
    """Write reservations and their events; returns the two paths."""
    return (
        write_reservations_csv(records, csv_directory, business_date),
        write_events_json(events, json_directory, business_date),
    )


def synthesise_and_store(
    spark: SparkSession,
    count: int,
    business_date: str,
    csv_directory: str,
    json_directory: str,
    property_code: str | None = None,
    seed: int | None = None,
    partitions: int | None = None,
) -> dict[str, Any]:
    """Write ``count`` reservations in both forms; returns a summary with one sample each."""
    records, events = synthesise(spark, count, business_date, property_code, seed, partitions)
    csv_path, json_path = store(records, events, business_date, csv_directory, json_directory)
    return {
        "status": "success",
        "business_date": business_date,
        "property_code": property_code or "RANDOM",
        "reservation_count": count,
        "csv_file_path": csv_path,
        "json_file_path": json_path,
        "sample_record": records.first().asDict(),
        "sample_event": events.first().asDict(recursive=True),
    }
