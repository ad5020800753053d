"""Gold: one row per property and night."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightfolio.functions import stay
from nightfolio.functions.stay import now_or
from nightfolio.schemas import GOLD_KEYS

# Nights marked in one mask; a power of two, so that a shift finds the period.
PERIOD_BITS = 5
PERIOD_NIGHTS = 1 << PERIOD_BITS


def active_stays(silver: DataFrame, money: str = "double") -> DataFrame:
    """Stays of at least one night that are not cancelled, with revenue per night.

    Rows without status or with an unknown date drop out here.
    """
    return (
        silver.filter(F.col("booking_status") != "CANCELLED")
        .withColumn("stay_nights", stay.stay_nights(F.col("arrival_date"), F.col("departure_date")))
        .filter(F.col("stay_nights") > 0)
        .withColumn(
            "revenue_per_night",
            stay.revenue_per_night(F.col("total_revenue"), F.col("stay_nights"), money),
        )
    )


def _within(
    stays: DataFrame, first: date | None, last: date | None
) -> tuple[DataFrame, Column, Column]:
    """Stays with a night in the range, and their first and last night in it.

    The overlap is tested on the stays, so it reaches the scan, and long stays expand
    no further than asked.
    """
    start = F.col("arrival_date")
    end = F.date_sub("departure_date", 1)
    if first is not None:
        stays = stays.filter(F.col("departure_date") > F.lit(first))
        start = F.greatest(start, F.lit(first))
    if last is not None:
        stays = stays.filter(F.col("arrival_date") <= F.lit(last))
        end = F.least(end, F.lit(last))
    # A sequence whose start lies behind its end would run backwards.
    return stays.filter(start <= end), start, end


def stay_nights(
    stays: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """One row per night, from arrival to the night before departure.

    With ``first`` or ``last`` only nights in that range are made.
    """
    stays, start, end = _within(stays, first, last)
    return stays.withColumn("stay_date", F.explode(F.sequence(start, end)))


def reservations_per_night(
    stays: DataFrame, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Distinct reservation ids per property and night, exactly.

    A reservation's nights are bits of one mask per 32-night period, so telling
    repeated ids apart shuffles about one row per stay instead of one per night, and
    an id that repeats without end is one row per task before the shuffle.
    """
    stays, start, end = _within(stays.filter(F.col("reservation_id").isNotNull()), first, last)
    period = F.col("_period")
    period_start = F.shiftleft(period, PERIOD_BITS)
    low = F.greatest(F.col("_start") - period_start, F.lit(0))
    high = F.least(F.col("_end") - period_start, F.lit(PERIOD_NIGHTS - 1))
    one = F.lit(1).cast("bigint")
    nights = F.call_function(
        "shiftleft", F.call_function("shiftleft", one, high - low + 1) - one, low
    )
    masks = (
        stays.select(
            "property_code",
            "reservation_id",
            F.unix_date(start).alias("_start"),
            F.unix_date(end).alias("_end"),
        )
        .withColumn(
            "_period",
            F.explode(
                F.sequence(
                    F.shiftright("_start", PERIOD_BITS), F.shiftright("_end", PERIOD_BITS)
                )
            ),
        )
        .groupBy("property_code", "reservation_id", "_period")
        .agg(F.bit_or(nights).alias("_nights"))
    )
    per_period = masks.groupBy("property_code", "_period").agg(
        F.array(
            *[
                F.sum(F.shiftright("_nights", night).bitwiseAND(one))
                for night in range(PERIOD_NIGHTS)
            ]
        ).alias("_counts")
    )
    return (
        per_period.select(
            "property_code", "_period", F.posexplode("_counts").alias("_night", "reservation_count")
        )
        .filter(F.col("reservation_count") > 0)
        .select(
            "property_code",
            F.date_from_unix_date(period_start + F.col("_night")).alias("stay_date"),
            "reservation_count",
        )
    )


def daily_revenue(
    stays: DataFrame,
    first: date | None = None,
    last: date | None = None,
    gold_at: Column | datetime | None = None,
) -> DataFrame:
    """Reservations, rooms, revenue and average daily rate per property and night.

    A reservation id that occurs twice in a cell counts once, but its rooms and
    revenue are added twice. The rate divides the rounded revenue by rooms.
    """
    amounts = stay_nights(stays, first, last).select(
        *GOLD_KEYS, "room_count", "revenue_per_night"
    )
    counts = reservations_per_night(stays, first, last)
    # One aggregation over both: amounts are added up in each task before they move.
    return (
        amounts.unionByName(counts, allowMissingColumns=True)
        .groupBy(*GOLD_KEYS)
        .agg(
            F.coalesce(F.sum("reservation_count"), F.lit(0).cast("bigint")).alias(
                "reservation_count"
            ),
            F.sum("room_count").alias("booked_rooms"),
            F.round(F.sum("revenue_per_night"), 2).alias("total_revenue"),
        )
        .withColumn("adr", stay.average_daily_rate(F.col("total_revenue"), F.col("booked_rooms")))
        .withColumn("gold_ingestion_ts", now_or(gold_at))
    )


def to_gold(
    silver: DataFrame,
    money: str = "double",
    first: date | None = None,
    last: date | None = None,
    gold_at: Column | datetime | None = None,
) -> DataFrame:
    """Silver to gold in one step.

    ``money="double"`` adds in the order rows arrive, so a cell whose exact revenue
    ends on half a cent may come out one cent apart between runs. ``"decimal"``
    gives the same cents every time.
    """
    return daily_revenue(active_stays(silver, money), first, last, gold_at)
