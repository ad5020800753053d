from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from builders import serving_frame, staged_frame
from nightfolio.operators import serve
from nightfolio.schemas import SERVING, STAGING

NIGHT = date(2026, 6, 1)
BEFORE, NOW = datetime(2026, 5, 1, 8), datetime(2026, 5, 2, 8)


def cell(code, night=NIGHT, **values):
    return {"property_code": code, "stay_date": night, **values}


@pytest.fixture
def serving(spark):
    old = {"last_run_id": "old", "created_at": BEFORE, "adr": Decimal("5.00")}
    return serving_frame(
        spark,
        cell("matched", reservation_count=1, booked_rooms=1, source_system="s", **old),
        cell("untouched", reservation_count=2, **old),
        cell("far", date(2020, 1, 1), reservation_count=3, **old),
    )


@pytest.fixture
def staged(spark):
    return staged_frame(
        spark,
        cell("matched", run_id="new", reservation_count=9, business_date=NIGHT),
        cell("fresh", run_id="new", reservation_count=4, adr=Decimal("7.50")),
        cell("untouched", run_id="other", reservation_count=99),
    )


def by_code(frame):
    return {row.property_code: row for row in frame.collect()}


@pytest.mark.parametrize("bounds", [{}, {"first": NIGHT, "last": NIGHT}])
def test_merge_of_one_run(spark, serving, staged, bounds):
    merged = serve.merge_run(serving, staged, "new", F.lit(NOW), **bounds)
    assert merged.columns == SERVING.fieldNames()
    assert [f.dataType for f in merged.schema] == [f.dataType for f in SERVING]
    rows = by_code(merged)
    assert set(rows) == {"matched", "untouched", "far", "fresh"}
    matched = rows["matched"]
    assert (matched.reservation_count, matched.last_run_id) == (9, "new")
    # A null in the batch wins over what was there.
    assert matched.booked_rooms is None and matched.adr is None and matched.source_system is None
    assert (matched.created_at, matched.updated_at) == (BEFORE, NOW)
    fresh = rows["fresh"]
    assert (fresh.reservation_count, fresh.adr) == (4, Decimal("7.50"))
    assert (fresh.created_at, fresh.updated_at) == (NOW, None)
    for code, count in (("untouched", 2), ("far", 3)):
        assert (rows[code].reservation_count, rows[code].last_run_id) == (count, "old")
        assert (rows[code].created_at, rows[code].updated_at) == (BEFORE, None)


def test_merge_twice_equals_once(serving, staged):
    once = serve.merge_run(serving, staged, "new", F.lit(NOW))
    twice = serve.merge_run(once, staged, "new", F.lit(NOW))
    clocks = ("created_at", "updated_at")
    assert sorted(once.drop(*clocks).collect(), key=str) == sorted(
        twice.drop(*clocks).collect(), key=str
    )


def test_upsert_of_everything_staged(serving, staged):
    rows = by_code(serve.upsert_all(serving, staged, F.lit(NOW)))
    assert rows["untouched"].reservation_count == 99
    # Columns that are not measures stay on a match and are empty on a new key.
    assert rows["matched"].last_run_id == "old" and rows["matched"].source_system == "s"
    assert rows["fresh"].last_run_id is None and rows["fresh"].created_at == NOW
    assert rows["far"].updated_at is None


def test_staging_projection(spark):
    gold = spark.createDataFrame(
        [("P", NIGHT, 3, 2**40, 10.005, 1e30, NOW)],
        "property_code string, stay_date date, reservation_count bigint, booked_rooms bigint, "
        "total_revenue double, adr double, gold_ingestion_ts timestamp",
    )
    staged = serve.to_staging(gold, "run", "2026-05-11")
    assert staged.columns == STAGING.fieldNames()
    assert [f.dataType for f in staged.schema] == [f.dataType for f in STAGING]
    row = staged.first()
    assert row.reservation_count == 3 and row.total_revenue == Decimal("10.01")
    # What does not fit the serving types is null, in any session mode.
    assert row.booked_rooms is None and row.adr is None
    assert (row.run_id, row.business_date, row.source_system) == (
        "run",
        date(2026, 5, 11),
        "gold_parquet_layer",
    )
    assert serve.with_staged_at(staged).first().staged_at is not None


def test_run_scope_and_deletion(spark, staged):
    unknown = staged_frame(spark, cell("unknown"))
    everything = staged.unionByName(unknown)
    assert serve.of_run(everything, "new").count() == 2
    assert {row.property_code for row in serve.without_run(everything, "new").collect()} == {
        "untouched",
        "unknown",
    }
    assert serve.scalar(serve.run_count(everything, "new")) == 2
    assert serve.scalar(serve.run_count(everything, "none")) == 0
    assert serve.scalar(everything.limit(0)) is None


def test_count_gate():
    serve.require_equal_counts(3, 3)
    with pytest.raises(ValueError, match="2 rows of 3"):
        serve.require_equal_counts(3, 2)


def test_a_night_outside_the_stated_range_is_an_error(serving, staged):
    later = date(2030, 1, 1)
    with pytest.raises(Exception, match="a staged night is not between"):
        serve.merge_run(serving, staged, "new", F.lit(NOW), first=later, last=later).collect()
