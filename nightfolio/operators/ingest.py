"""Bronze enrichment, and the change between flat records and nested events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightfolio.functions.stay import as_count, now_or

SOURCE_SYSTEM = "dummy_reservation_generator"


def to_bronze(
    raw: DataFrame, business_date: str, ingested_at: Column | datetime | None = None
) -> DataFrame:
    """Raw rows with their lineage. Every row of a run gets the same business date."""
    return raw.withColumns(
        {
            "business_date": F.lit(business_date),
            "bronze_ingestion_ts": now_or(ingested_at),
            "source_system": F.lit(SOURCE_SYSTEM),
        }
    )


def to_events(records: DataFrame, revenue_type: str = "decimal(18,2)") -> DataFrame:
    """Flat records as nested events. ``created_ts`` has no place in an event.

    Amounts keep their fraction; a room count is the whole number that silver reads.
    """
    status = F.array_join(F.transform(F.split("booking_status", "_"), F.initcap), "_")
    return records.select(
        F.concat(F.lit("EVT_"), "reservation_id").alias("eventId"),
        F.concat(F.lit("Reservation"), status).alias("eventType"),
        F.replace("updated_ts", F.lit(" "), F.lit("T")).alias("eventTimestamp"),
        F.col("property_code").alias("propertyCode"),
        F.struct(F.col("confirmation_number").alias("value")).alias("confirmationNumber"),
        F.struct(
            F.col("reservation_id").alias("reservationId"),
            F.col("guest_id").alias("guestId"),
            F.col("arrival_date").alias("arrivalDate"),
            F.col("departure_date").alias("departureDate"),
            F.col("room_type").alias("roomType"),
            F.col("rate_plan_code").alias("ratePlanCode"),
            F.col("price_plan_code").alias("pricePlanCode"),
            F.col("booking_status").alias("status"),
            as_count(F.col("room_count")).cast("bigint").alias("roomCount"),
            F.col("total_revenue").try_cast(revenue_type).alias("totalRevenue"),
            F.col("currency"),
        ).alias("reservationDetails"),
    )


def flatten_events(events: DataFrame) -> DataFrame:
    """Events as flat raw records, all text; ``created_ts`` is unknown and left null."""
    details = "reservationDetails"
    return events.select(
        F.col(f"{details}.reservationId").alias("reservation_id"),
        F.col("propertyCode").alias("property_code"),
        F.col("confirmationNumber.value").alias("confirmation_number"),
        F.col(f"{details}.guestId").alias("guest_id"),
        F.col(f"{details}.arrivalDate").alias("arrival_date"),
        F.col(f"{details}.departureDate").alias("departure_date"),
        F.col(f"{details}.roomType").alias("room_type"),
        F.col(f"{details}.ratePlanCode").alias("rate_plan_code"),
        F.col(f"{details}.pricePlanCode").alias("price_plan_code"),
        F.col(f"{details}.status").alias("booking_status"),
        F.col(f"{details}.roomCount").cast("string").alias("room_count"),
        F.col(f"{details}.totalRevenue").cast("string").alias("total_revenue"),
        F.col(f"{details}.currency").alias("currency"),
        F.lit(None).cast("string").alias("created_ts"),
        F.replace("eventTimestamp", F.lit("T"), F.lit(" ")).alias("updated_ts"),
    )
