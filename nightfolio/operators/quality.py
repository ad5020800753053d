"""Ordered validation rules, the split they make, and key checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightfolio.functions.stay import as_amount, as_count, as_date
from nightfolio.schemas import GOLD_KEYS, MALFORMED

BOOKING_STATUSES = ("BOOKED", "CANCELLED", "MODIFIED")

REASON = "validation_reason"


@dataclass(frozen=True)
class Rule:
    """A row for which ``broken`` is true gets ``code``; null counts as not true."""

    code: str
    broken: Column


def finite(amount: Column) -> Column:
    return ~F.isnan(amount) & (F.abs(amount) < float("inf"))


def standard_rules() -> list[Rule]:
    """The rules in order. A value that is present but unreadable, and a missing
    status, room count or revenue, breaks none of them."""
    return [
        Rule("PROPERTY_CODE_NULL", F.col("property_code").isNull()),
        Rule("CONFIRMATION_NUMBER_NULL", F.col("confirmation_number").isNull()),
        Rule("ARRIVAL_DATE_NULL", F.col("arrival_date").isNull()),
        Rule("DEPARTURE_DATE_NULL", F.col("departure_date").isNull()),
        Rule(
            "INVALID_STAY_DATES",
            as_date(F.col("arrival_date")) >= as_date(F.col("departure_date")),
        ),
        Rule("INVALID_ROOM_COUNT", as_amount(F.col("room_count")) <= 0),
        Rule("NEGATIVE_REVENUE", as_amount(F.col("total_revenue")) < 0),
        Rule("INVALID_BOOKING_STATUS", ~F.col("booking_status").isin(*BOOKING_STATUSES)),
    ]


def strict_rules() -> list[Rule]:
    """The standard rules, then rejection of what they let through."""
    return standard_rules() + [
        Rule("ARRIVAL_DATE_UNREADABLE", as_date(F.col("arrival_date")).isNull()),
        Rule("DEPARTURE_DATE_UNREADABLE", as_date(F.col("departure_date")).isNull()),
        Rule("ROOM_COUNT_MISSING", as_count(F.col("room_count")).isNull()),
        Rule("REVENUE_MISSING", as_amount(F.col("total_revenue")).isNull()),
        Rule("BOOKING_STATUS_NULL", F.col("booking_status").isNull()),
        Rule("ROOM_COUNT_BELOW_ONE", as_count(F.col("room_count")) < 1),
        Rule("REVENUE_NOT_FINITE", ~finite(as_amount(F.col("total_revenue")))),
    ]


def reason_column(rules: Sequence[Rule]) -> Column:
    """Code of the first broken rule, null when there is none."""
    first, *rest = rules
    reason = F.when(first.broken, first.code)
    for rule in rest:
        reason = reason.when(rule.broken, rule.code)
    return reason


def with_reason(bronze: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """``bronze`` with the first reason against each row.

    A line that did not fit the columns is malformed before any rule is asked.
    """
    rules = list(rules or standard_rules())
    if MALFORMED in bronze.columns:
        rules.insert(0, Rule("MALFORMED_ROW", F.col(MALFORMED).isNotNull()))
    return bronze.withColumn(REASON, reason_column(rules))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull())


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def reason_counts(checked: DataFrame) -> DataFrame:
    """Rows per code; the null code counts the valid rows."""
    return checked.groupBy(REASON).agg(F.count(F.lit(1)).alias("row_count"))


def split_counts() -> list[Column]:
    """Raw, valid and rejected rows of a checked frame, as aggregates."""
    return [
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(F.col(REASON).isNull()).alias("valid_count"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected_count"),
    ]


def key_violations(df: DataFrame, keys: Sequence[str] = GOLD_KEYS) -> DataFrame:
    """Keys that are incomplete or occur more than once, with their row count."""
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(incomplete | (F.col("row_count") > 1))
    )


def require_keys(df: DataFrame, keys: Sequence[str] = GOLD_KEYS) -> None:
    """``ValueError`` unless every key is complete and unique."""
    broken = key_violations(df, keys).take(3)
    if broken:
        shown = "; ".join(str(row.asDict()) for row in broken)
        raise ValueError(f"incomplete or repeated keys {tuple(keys)}, for example {shown}")
