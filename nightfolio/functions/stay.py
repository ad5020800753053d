"""Column expressions for stays, money and run ids.

Everything here gives null, never an error, on unusable input, whether or not the
session runs in ANSI mode.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from nightfolio.schemas import MONEY


def as_date(value: Column) -> Column:
    return value.try_cast("date")


def require_day(business_date: str) -> str:
    """The same text, or ``ValueError`` unless it is a day as ``yyyy-MM-dd``."""
    if date.fromisoformat(business_date).isoformat() != business_date:
        raise ValueError(f"a business date is yyyy-MM-dd, not {business_date!r}")
    return business_date


def as_timestamp(value: Column) -> Column:
    return value.try_cast("timestamp")


def as_amount(value: Column) -> Column:
    return value.try_cast("double")


def as_count(value: Column) -> Column:
    """Whole number, cutting a fraction off: ``'2.0'`` and ``'2.7'`` are both 2."""
    return value.try_cast("double").try_cast("int")


def stay_nights(arrival: Column, departure: Column) -> Column:
    return F.datediff(departure, arrival)


def revenue_per_night(total: Column, nights: Column, money: str = "double") -> Column:
    """Revenue of one night. The total already covers all rooms.

    ``decimal`` keeps 13 digits behind the point, rounded half up.
    """
    if money == "decimal":
        return F.try_divide(total.try_cast(MONEY), nights)
    if money == "double":
        return F.try_divide(total, nights)
    raise ValueError(f"money must be 'double' or 'decimal', not {money!r}")


def average_daily_rate(total: Column, rooms: Column) -> Column:
    return F.round(F.try_divide(total, rooms), 2)


def now_or(at: Column | datetime | None) -> Column:
    """The given instant, or the current one."""
    if at is None:
        return F.current_timestamp()
    return at if isinstance(at, Column) else F.lit(at)


def run_id(job_name: Column, business_date: Column, at: Column) -> Column:
    """``job_name_yyyymmdd_yyyymmdd_hhmmss`` from a ``yyyy-MM-dd`` text and a timestamp."""
    return F.concat_ws(
        "_",
        F.translate(F.lower(job_name), " -", "__"),
        F.replace(business_date, F.lit("-"), F.lit("")),
        F.date_format(at, "yyyyMMdd_HHmmss"),
    )


def new_run_id(job_name: str, business_date: str, now: datetime | None = None) -> str:
    """As :func:`run_id`, for the one id a driver program needs.

    Without a given instant a part that no other run has is added, so that two runs that
    start in one second are told apart.
    """
    job = job_name.lower().translate(str.maketrans(" -", "__"))
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    own = [] if now else [uuid.uuid4().hex[:8]]
    return "_".join([job, business_date.replace("-", ""), stamp, *own])
