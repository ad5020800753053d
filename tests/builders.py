"""Small hand-written frames."""

from __future__ import annotations

from nightfolio.schemas import RAW, RAW_COLUMNS, SERVING, STAGING

GOOD = {
    "reservation_id": "RES1",
    "property_code": "GOA001",
    "confirmation_number": "CNF1",
    "guest_id": "GUEST1",
    "arrival_date": "2026-06-01",
    "departure_date": "2026-06-03",
    "room_type": "STD",
    "rate_plan_code": "BAR",
    "price_plan_code": "BAR_STD",
    "booking_status": "BOOKED",
    "room_count": "2",
    "total_revenue": "1000",
    "currency": "INR",
    "created_ts": "2026-05-01 10:00:00",
    "updated_ts": "2026-05-01 11:30:00",
}


def raw_frame(spark, *changes: dict):
    """One good row per argument, with its changes."""
    rows = [tuple({**GOOD, **change}[name] for name in RAW_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, RAW)


def staged_frame(spark, *rows: dict):
    return spark.createDataFrame(
        [tuple(row.get(name) for name in STAGING.fieldNames()) for row in rows], STAGING
    )


def serving_frame(spark, *rows: dict):
    return spark.createDataFrame(
        [tuple(row.get(name) for name in SERVING.fieldNames()) for row in rows], SERVING
    )
