"""Silver: typed reservations, and the split of checked rows in one frame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightfolio.functions.stay import as_amount, as_count, as_date, as_timestamp, now_or
from nightfolio.operators.quality import REASON
from nightfolio.schemas import BRONZE, MALFORMED, SILVER

#: The columns whose type silver changes.
TYPES = {
    "arrival_date": as_date,
    "departure_date": as_date,
    "created_ts": as_timestamp,
    "updated_ts": as_timestamp,
    "room_count": as_count,
    "total_revenue": as_amount,
}

#: Columns of a split frame beside silver's: whether the row is valid, and what only a
#: rejected row has, its text as it came.
VALID, REJECTED = "valid", "rejected"


def to_silver(valid: DataFrame, ingested_at: Column | datetime | None = None) -> DataFrame:
    """Types of the valid rows; unreadable values become null.

    Timestamps are read in the session's time zone.
    """
    typed = {name: cast(F.col(name)) for name, cast in TYPES.items()}
    return valid.withColumns({**typed, "silver_ingestion_ts": now_or(ingested_at)}).drop(REASON)


def split(
    checked: DataFrame,
    ingested_at: Column | datetime | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Valid and rejected rows in one frame, so that one pass can write both.

    A valid row has silver's columns and a null ``rejected``; a rejected one keeps the text
    of the columns that silver types, its whole line if it was malformed and the reason
    there. ``extra`` columns of ``checked`` stay as they are.
    """
    valid = F.col(REASON).isNull()
    line = F.col(MALFORMED) if MALFORMED in checked.columns else F.lit(None).cast("string")
    text = F.struct(*TYPES, line.alias(MALFORMED), REASON)
    typed = {name: cast(F.col(name)) for name, cast in TYPES.items()}
    typed["silver_ingestion_ts"] = now_or(ingested_at)
    return checked.select(
        *[
            F.when(valid, typed[name]).alias(name) if name in typed else F.col(name)
            for name in SILVER.fieldNames()
        ],
        *extra,
        F.when(~valid, text).alias(REJECTED),
        valid.alias(VALID),
    )


def rejected_of(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Rejected rows of a split frame with bronze's columns, line and reason."""
    return rows.select(
        *[
            F.col(f"{REJECTED}.{name}").alias(name) if name in TYPES else F.col(name)
            for name in BRONZE.fieldNames()
        ],
        F.col(f"{REJECTED}.{MALFORMED}").alias(MALFORMED),
        F.col(f"{REJECTED}.{REASON}").alias(REASON),
        *extra,
    )
