"""Synthetic reservations of any size, made where they are needed."""

from __future__ import annotations

import random
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightfolio.functions.draws import draw, pick, random_date, row_state
from nightfolio.operators.ingest import to_events
from nightfolio.operators.quality import BOOKING_STATUSES
from nightfolio.schemas import RAW_COLUMNS

# Fixed values of the synthetic data set.
PROPERTY_CODES = [
    "BLR001",
    "BLR002",
    "DEL001",
    "MUM001",
    "HYD001",
    "CHN001",
    "DEL002",
    "MUM002",
    "KOL001",
    "KER001",
    "CHA001",
]
ROOM_TYPES = ["STD", "DLX", "STE", "KING", "QUEEN"]
RATE_PLANS = ["BAR", "CORP", "MEMBER", "PKG", "PREPAY"]
PRICE_PLANS = {
    "BAR": ["BAR_STD", "BAR_DLX"],
    "CORP": ["CORP_STD", "CORP_DLX"],
    "MEMBER": ["MEM_STD", "MEM_DLX"],
    "PKG": ["PKG_STD", "PKG_DLX"],
    "PREPAY": ["PPR_STD", "PPR_DLX"],
}
CURRENCY = "INR"
FIRST_NUMBER = 100_000
ARRIVAL_DAYS = (1, 60)
NIGHTS = (1, 5)
ROOMS = (1, 4)
NIGHTLY_RATE = (3500, 15000)
UPDATE_MINUTES = (0, 180)


def reservations_for(
    indexes: DataFrame,
    business_date: str,
    property_code: str | None = None,
    seed: int = 0,
    index_column: str = "index",
) -> DataFrame:
    """One reservation per row of ``indexes``, decided by the row number and the seed.

    No shuffle and no state: a projection over whatever holds the numbers.
    """
    index = F.col(index_column).cast("bigint")
    state = F.col("_state")
    business_day = F.lit(business_date).cast("date")
    plans = F.coalesce(
        *[
            F.when(F.col("rate_plan_code") == rate, F.array(*map(F.lit, codes)))
            for rate, codes in PRICE_PLANS.items()
        ]
    )
    drawn = indexes.select(
        index.alias("_index"), row_state(index, seed, business_date).alias("_state")
    ).select(
        "_index",
        (F.lit(property_code) if property_code else pick(state, 1, PROPERTY_CODES)).alias(
            "property_code"
        ),
        pick(state, 2, RATE_PLANS).alias("rate_plan_code"),
        draw(state, 3, 0, 1).cast("int").alias("_price_plan"),
        pick(state, 4, ROOM_TYPES).alias("room_type"),
        random_date(business_day, state, 5, *ARRIVAL_DAYS).alias("_arrival"),
        draw(state, 6, *NIGHTS).cast("int").alias("_nights"),
        pick(state, 7, list(BOOKING_STATUSES)).alias("booking_status"),
        draw(state, 8, *ROOMS).cast("int").alias("room_count"),
        draw(state, 9, *NIGHTLY_RATE).alias("_rate"),
        (
            business_day.cast("timestamp_ntz")
            + F.make_dt_interval(
                F.lit(0),
                draw(state, 10, 0, 23).cast("int"),
                draw(state, 11, 0, 59).cast("int"),
                draw(state, 12, 0, 59),
            )
        ).alias("_created"),
        draw(state, 13, *UPDATE_MINUTES).cast("int").alias("_update_minutes"),
    )
    number = (F.col("_index") + FIRST_NUMBER).cast("string")
    return drawn.select(
        "*",
        F.concat(F.lit("RES"), number).alias("reservation_id"),
        F.concat(F.lit("CNF"), number).alias("confirmation_number"),
        F.concat(F.lit("GUEST"), number).alias("guest_id"),
        F.col("_arrival").cast("string").alias("arrival_date"),
        F.date_add("_arrival", F.col("_nights")).cast("string").alias("departure_date"),
        F.get(plans, F.col("_price_plan")).alias("price_plan_code"),
        F.when(F.col("booking_status") == "CANCELLED", F.lit(0).cast("bigint"))
        .otherwise(F.col("_rate") * F.col("_nights") * F.col("room_count"))
        .alias("total_revenue"),
        F.lit(CURRENCY).alias("currency"),
        F.col("_created").cast("string").alias("created_ts"),
        (
            F.col("_created")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.col("_update_minutes"))
        )
        .cast("string")
        .alias("updated_ts"),
    ).select(*RAW_COLUMNS)


def checked_request(count: int, business_date: str) -> None:
    """``ValueError`` unless the count is positive and the date is ``yyyy-MM-dd``."""
    if count <= 0:
        raise ValueError("the number of reservations must be greater than 0")
    datetime.strptime(business_date, "%Y-%m-%d")


def synthesise(
    spark: SparkSession,
    count: int,
    business_date: str,
    property_code: str | None = None,
    seed: int | None = None,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``count`` reservations and their events, numbered from 1.

    Without a seed every call gives other data.
    """
    checked_request(count, business_date)
    if seed is None:
        seed = random.SystemRandom().randrange(2**31)
    numbers = spark.range(1, count + 1, numPartitions=partitions).withColumnRenamed("id", "index")
    records = reservations_for(numbers, business_date, property_code, seed)
    # Synthetic amounts are whole numbers.
    return records, to_events(records, "bigint")
