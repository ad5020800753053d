from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from builders import raw_frame
from nightfolio.operators.refine import to_silver
from nightfolio.operators.revenue import (
    active_stays,
    reservations_per_night,
    stay_nights,
    to_gold,
)

SILVER = (
    "reservation_id string, property_code string, arrival_date date, departure_date date, "
    "booking_status string, room_count int, total_revenue double"
)


def silver_frame(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def brute_force(rows, first=None, last=None):
    """Gold cell by cell in exact fractions."""
    cells = defaultdict(list)
    for identity, code, arrival, departure, status, rooms, revenue in rows:
        if status is None or status == "CANCELLED" or arrival is None or departure is None:
            continue
        nights = (departure - arrival).days
        for offset in range(nights):
            night = arrival + timedelta(days=offset)
            if (first is None or night >= first) and (last is None or night <= last):
                share = None if revenue is None else Fraction(Decimal(str(revenue))) / nights
                cells[code, night].append((identity, rooms, share))
    gold = {}
    for key, members in cells.items():
        identities = {identity for identity, _, _ in members if identity is not None}
        rooms = [count for _, count, _ in members if count is not None]
        shares = [share for _, _, share in members if share is not None]
        gold[key] = (
            len(identities),
            sum(rooms) if rooms else None,
            cents(sum(shares)) if shares else None,
        )
    return gold


def cents(amount: Fraction) -> Decimal:
    return (Decimal(int(amount * 1000000)) / 1000000).quantize(Decimal("0.01"), ROUND_HALF_UP)


def as_cells(gold):
    return {
        (row.property_code, row.stay_date): (
            row.reservation_count,
            row.booked_rooms,
            row.total_revenue,
        )
        for row in gold.collect()
    }


# Amounts whose share of a night is a whole number of cents, so that both money forms are exact.
def stays():
    return st.lists(
        st.tuples(
            st.sampled_from(["R1", "R2", "R3", None]),
            st.sampled_from(["GOA001", "GOA002"]),
            st.one_of(
                st.none(), st.dates(min_value=date(1969, 11, 20), max_value=date(1970, 2, 20))
            ),
            st.integers(min_value=-3, max_value=100),
            st.sampled_from(["BOOKED", "MODIFIED", "CANCELLED", None]),
            st.one_of(st.none(), st.integers(min_value=1, max_value=4)),
            st.one_of(st.none(), st.integers(min_value=0, max_value=100000)),
        ),
        min_size=15,
        max_size=60,
    )


def as_rows(drawn):
    return [
        (
            identity,
            code,
            arrival,
            None if arrival is None else arrival + timedelta(days=nights),
            status,
            rooms,
            None if share is None else float(Decimal(share * max(nights, 1)) / 100),
        )
        for identity, code, arrival, nights, status, rooms, share in drawn
    ]


@settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(drawn=stays())
def test_gold_equals_brute_force(spark, drawn):
    rows = as_rows(drawn)
    expected = brute_force(rows)
    silver = silver_frame(spark, rows)
    assert as_cells(to_gold(silver, money="decimal")) == expected
    doubles = as_cells(to_gold(silver))
    assert {key: cell[:2] for key, cell in doubles.items()} == {
        key: cell[:2] for key, cell in expected.items()
    }
    for key, cell in doubles.items():
        assert (cell[2] is None) == (expected[key][2] is None)
        assert cell[2] is None or abs(Decimal(str(cell[2])) - expected[key][2]) <= Decimal("0.01")


@settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(drawn=stays())
def test_range_equals_filtered_brute_force(spark, drawn):
    rows = as_rows(drawn)
    first, last = date(1969, 12, 25), date(1970, 1, 9)
    silver = silver_frame(spark, rows)
    assert as_cells(to_gold(silver, "decimal", first, last)) == brute_force(rows, first, last)
    assert as_cells(to_gold(silver, "decimal", first=first)) == brute_force(rows, first)
    assert as_cells(to_gold(silver, "decimal", last=last)) == brute_force(rows, last=last)


def test_repeated_id_counts_once_but_adds_twice(spark):
    day = date(2026, 6, 1)
    row = ("R1", "GOA001", day, day + timedelta(days=2), "BOOKED", 2, 100.0)
    (first, second) = to_gold(silver_frame(spark, [row, row])).orderBy("stay_date").collect()
    assert (first.reservation_count, first.booked_rooms, first.total_revenue) == (1, 4, 100.0)
    assert first.adr == 25.0
    assert second.stay_date == day + timedelta(days=1)


def test_rate_divides_the_rounded_total(spark):
    day = date(2026, 6, 1)
    three_nights = ("R1", "GOA001", day, day + timedelta(days=3), "BOOKED", 3, 100.0)
    row = to_gold(silver_frame(spark, [three_nights])).first()
    assert row.total_revenue == 33.33
    assert row.adr == 11.11


def test_no_rooms_known_gives_no_rate(spark):
    day = date(2026, 6, 1)
    row = ("R1", "GOA001", day, day + timedelta(days=1), "BOOKED", None, 100.0)
    cell = to_gold(silver_frame(spark, [row])).first()
    assert cell.booked_rooms is None and cell.adr is None and cell.total_revenue == 100.0


@pytest.mark.parametrize(
    "arrival, departure",
    [
        (date(2026, 1, 30), date(2026, 2, 2)),
        (date(2025, 12, 30), date(2026, 1, 3)),
        (date(2028, 2, 28), date(2028, 3, 2)),
        (date(2026, 6, 1), date(2026, 6, 2)),
    ],
)
def test_departure_night_is_excluded(spark, arrival, departure):
    silver = silver_frame(spark, [("R1", "P", arrival, departure, "BOOKED", 1, 1.0)])
    nights = stay_nights(active_stays(silver)).orderBy("stay_date").collect()
    length = (departure - arrival).days
    assert [row.stay_date for row in nights] == [arrival + timedelta(days=i) for i in range(length)]


def test_backward_and_empty_stays_have_no_nights(spark):
    day = date(2026, 6, 5)
    rows = [
        ("R1", "P", day, day, "BOOKED", 1, 1.0),
        ("R2", "P", day, day - timedelta(days=3), "BOOKED", 1, 1.0),
    ]
    silver = silver_frame(spark, rows)
    assert to_gold(silver).count() == 0
    assert stay_nights(silver).count() == 0 and reservations_per_night(silver).count() == 0


def test_empty_range_has_no_nights(spark):
    day = date(2026, 6, 5)
    rows = [("R1", "P", day, day + timedelta(days=20), "BOOKED", 1, 1.0)]
    inverted = {"first": day + timedelta(days=9), "last": day + timedelta(days=5)}
    assert to_gold(silver_frame(spark, rows), **inverted).count() == 0


def test_one_id_and_property_with_a_third_of_all_rows(spark):
    """The hot cell is one row per task before any shuffle; nothing is dropped for it."""
    day = date(2026, 6, 1)
    hot = spark.range(20000).select(
        F.lit("HOT").alias("reservation_id"),
        F.lit("GOA001").alias("property_code"),
        F.lit(day).alias("arrival_date"),
        F.lit(day + timedelta(days=2)).alias("departure_date"),
        F.lit("BOOKED").alias("booking_status"),
        F.lit(1).alias("room_count"),
        F.lit(2.0).alias("total_revenue"),
    )
    cold = spark.range(40000).select(
        F.concat(F.lit("R"), "id").alias("reservation_id"),
        F.concat(F.lit("P"), F.col("id") % 50).alias("property_code"),
        F.date_add(F.lit(day), (F.col("id") % 30).cast("int")).alias("arrival_date"),
        F.date_add(F.lit(day), (F.col("id") % 30 + 1).cast("int")).alias("departure_date"),
        F.lit("MODIFIED").alias("booking_status"),
        F.lit(1).alias("room_count"),
        F.lit(2.0).alias("total_revenue"),
    )
    gold = to_gold(hot.unionByName(cold))
    first = gold.filter("property_code = 'GOA001'").orderBy("stay_date").collect()
    assert [(row.reservation_count, row.booked_rooms) for row in first] == [(1, 20000)] * 2
    rest = gold.filter("property_code <> 'GOA001'").agg(F.sum("reservation_count")).first()[0]
    assert rest == 40000


def test_night_counts_agree_with_a_distinct_count(spark):
    stays_frame = spark.range(3000).select(
        F.concat(F.lit("R"), F.col("id") % 400).alias("reservation_id"),
        F.concat(F.lit("P"), F.col("id") % 3).alias("property_code"),
        F.date_add(F.lit(date(2026, 1, 1)), (F.col("id") * 7 % 90).cast("int")).alias(
            "arrival_date"
        ),
        F.date_add(
            F.lit(date(2026, 1, 1)), (F.col("id") * 7 % 90 + 1 + F.col("id") % 70).cast("int")
        ).alias("departure_date"),
    )
    expected = (
        stay_nights(stays_frame)
        .groupBy("property_code", "stay_date")
        .agg(F.count_distinct("reservation_id").alias("reservation_count"))
    )
    actual = reservations_per_night(stays_frame)
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()


def test_gold_scans_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "silver")
    to_silver(raw_frame(spark, {})).write.parquet(path)
    gold = to_gold(spark.read.parquet(path), first=date(2026, 6, 1))
    plan = spark._jvm.PythonSQLUtils.explainString(gold._jdf.queryExecution(), "formatted")
    assert "guest_id" not in plan and "currency" not in plan
    assert "GreaterThan(departure_date,2026-06-01)" in plan
    assert "Not(EqualTo(booking_status,CANCELLED))" in plan
