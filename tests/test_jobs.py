"""Whole jobs on files."""

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from builders import raw_frame
from nightfolio.operators.synth import synthesise
from nightfolio.plans import serving_load
from nightfolio.plans.preview import show_layers
from nightfolio.plans.reservation_batch import run_reservation_batch
from nightfolio.plans.serving_load import (
    publish_to_database,
    run_append_load,
    run_serving_load,
    run_upsert_load,
)
from nightfolio.schemas import RAW_COLUMNS, SERVING
from nightfolio.sources.files import read_layer, write_parquet, write_reservations_csv
from nightfolio.sources.layers import layer_path, read_layer_of
from nightfolio.sources.run_log import read_runs
from nightfolio.sources.snapshots import read_snapshot, write_snapshot
from nightfolio.sources.staging import read_staged

DAY = "2026-05-11"


class Paths:
    def __init__(self, base):
        for name in ("raw", "layers", "gold", "staging", "serving", "audit"):
            setattr(self, name, f"{base}/{name}")


@pytest.fixture
def paths(tmp_path):
    return Paths(tmp_path)


def run_batch(spark, paths, **options):
    counts = run_reservation_batch(spark, paths.raw, paths.layers, DAY, **options)
    paths.gold = layer_path(spark, paths.layers, "gold")
    return counts


def load(spark, paths, **options):
    return run_serving_load(
        spark, paths.gold, paths.staging, paths.serving, paths.audit, DAY, **options
    )


def test_batch_layers(spark, paths, capsys):
    write_reservations_csv(
        raw_frame(spark, {}, {"property_code": None}, {"booking_status": "CANCELLED"}),
        paths.raw,
        "2026-05-09",
    )
    write_reservations_csv(
        raw_frame(spark, {}, {"room_count": "0"}, {"arrival_date": "oops"}), paths.raw, "2026-05-10"
    )
    counts = run_batch(spark, paths)
    assert (counts.raw, counts.valid, counts.rejected, counts.gold) == (6, 4, 2, 2)
    bronze = read_layer_of(spark, paths.layers, "bronze")
    assert bronze.count() == 6 and "validation_reason" not in bronze.columns
    # The one business date of the run is on all rows, whatever file they are from.
    assert {row.business_date for row in bronze.collect()} == {DAY}
    assert read_layer_of(spark, paths.layers, "silver").count() == 4
    rejected = read_layer_of(spark, paths.layers, "rejected")
    assert {row.validation_reason for row in rejected.collect()} == {
        "PROPERTY_CODE_NULL",
        "INVALID_ROOM_COUNT",
    }
    gold = read_layer(spark, paths.gold).orderBy("stay_date").collect()
    assert [(row.stay_date, row.reservation_count, row.booked_rooms) for row in gold] == [
        (date(2026, 6, 1), 1, 4),
        (date(2026, 6, 2), 1, 4),
    ]
    assert {row.total_revenue for row in gold} == {1000.0}
    # Silver is made from bronze on disk, so lineage stamps agree between the layers.
    assert (
        read_layer_of(spark, paths.layers, "silver").select("bronze_ingestion_ts").distinct().collect()
        == bronze.select("bronze_ingestion_ts").distinct().collect()
    )
    show_layers(spark, paths.layers)
    assert "2026-06-02" in capsys.readouterr().out


def test_batch_replaces_rejects_by_default(spark, paths):
    write_reservations_csv(raw_frame(spark, {"room_count": "0"}), paths.raw, DAY)
    assert run_batch(spark, paths).rejected == 1
    write_reservations_csv(raw_frame(spark, {}), paths.raw, DAY)
    assert run_batch(spark, paths, keep_stale_rejects=True).rejected == 0
    assert read_layer_of(spark, paths.layers, "rejected").count() == 1
    run_batch(spark, paths)
    assert read_layer_of(spark, paths.layers, "rejected").count() == 0


def test_batch_on_synthetic_reservations(spark, paths):
    records, _ = synthesise(spark, 500, DAY, seed=11)
    write_reservations_csv(records, paths.raw, DAY)
    counts = run_batch(spark, paths, money="decimal", gold_partition_by=["property_code"])
    assert (counts.raw, counts.valid, counts.rejected) == (500, 500, 0)
    gold = read_layer(spark, paths.gold)
    nights = records.filter("booking_status <> 'CANCELLED'").agg(
        F.sum(F.datediff("departure_date", "arrival_date"))
    )
    assert gold.agg(F.sum("reservation_count")).first()[0] == nights.first()[0]
    assert gold.count() == counts.gold


def write_gold(spark, paths, *cells):
    rows = [(code, date(2026, 6, day), 1, 2, revenue, revenue / 2) for code, day, revenue in cells]
    gold = spark.createDataFrame(
        rows,
        "property_code string, stay_date date, reservation_count bigint, booked_rooms bigint, "
        "total_revenue double, adr double",
    )
    write_parquet(gold.withColumn("gold_ingestion_ts", F.current_timestamp()), paths.gold)


def serving_cells(spark, paths):
    rows = read_snapshot(spark, paths.serving, SERVING).collect()
    return {(row.property_code, row.stay_date.day): row for row in rows}


def test_two_loads(spark, paths):
    write_gold(spark, paths, ("a", 1, 10.0), ("a", 2, 20.0), ("b", 1, 30.0))
    counts = load(spark, paths, run_id="one")
    assert (counts.gold, counts.staged, counts.merged) == (3, 3, 3)
    write_gold(spark, paths, ("a", 2, 25.0), ("a", 3, 5.0))
    counts = load(spark, paths, run_id="two")
    assert (counts.gold, counts.staged, counts.merged) == (2, 2, 2)

    cells = serving_cells(spark, paths)
    assert {key: row.total_revenue for key, row in cells.items()} == {
        ("a", 1): Decimal("10.00"),
        ("a", 2): Decimal("25.00"),
        ("a", 3): Decimal("5.00"),
        ("b", 1): Decimal("30.00"),
    }
    assert cells["a", 2].last_run_id == "two" and cells["a", 2].updated_at is not None
    assert cells["a", 1].last_run_id == "one" and cells["a", 1].updated_at is None
    assert cells["a", 3].updated_at is None and cells["a", 3].created_at is not None
    runs = {row.run_id: row for row in read_runs(spark, paths.audit).collect()}
    assert {run: row.status for run, row in runs.items()} == {"one": "SUCCESS", "two": "SUCCESS"}
    assert (runs["two"].gold_count, runs["two"].staged_count, runs["two"].merged_count) == (2, 2, 2)
    assert read_staged(spark, paths.staging).count() == 0


def test_repeating_a_run_changes_nothing_but_clocks(spark, paths):
    write_gold(spark, paths, ("a", 1, 10.0), ("a", 2, 20.0))
    load(spark, paths, run_id="one")
    before = serving_cells(spark, paths)
    load(spark, paths, run_id="one")
    after = serving_cells(spark, paths)
    assert before.keys() == after.keys()
    assert all(before[key].created_at == after[key].created_at for key in before)
    assert read_runs(spark, paths.audit).count() == 1


@pytest.mark.parametrize("second", [("a", 2, 20.0), (None, 2, 20.0)])
def test_bad_keys_fail_the_run_and_leave_serving_alone(spark, paths, second):
    write_gold(spark, paths, ("a", 1, 10.0))
    load(spark, paths, run_id="good")
    write_gold(spark, paths, ("a", 1, 99.0), ("a", 2, 20.0), second)
    with pytest.raises(ValueError, match="keys"):
        load(spark, paths, run_id="bad")
    assert serving_cells(spark, paths)["a", 1].total_revenue == Decimal("10.00")
    runs = {row.run_id: row for row in read_runs(spark, paths.audit).collect()}
    assert runs["bad"].status == "FAILED" and "keys" in runs["bad"].error_message
    assert runs["good"].status == "SUCCESS"


def test_count_mismatch_fails_the_run(spark, paths, monkeypatch):
    write_gold(spark, paths, ("a", 1, 10.0), ("a", 2, 20.0))
    stage = serving_load.stage_run
    monkeypatch.setattr(
        serving_load, "stage_run", lambda staged, path, run: stage(staged.limit(1), path, run)
    )
    with pytest.raises(ValueError, match="staged 1 rows of 2"):
        load(spark, paths, run_id="short")
    assert serving_cells(spark, paths) == {}
    (run,) = read_runs(spark, paths.audit).collect()
    assert (run.status, run.ended_at is not None) == ("FAILED", True)


def test_load_of_an_empty_layer(spark, paths):
    write_gold(spark, paths, ("a", 1, 10.0))
    load(spark, paths, run_id="one")
    write_parquet(read_layer(spark, paths.gold).limit(0), f"{paths.gold}-empty")
    paths.gold += "-empty"
    assert load(spark, paths, run_id="two").merged == 0
    assert len(serving_cells(spark, paths)) == 1


def test_upsert_and_append_loads(spark, paths, tmp_path):
    write_gold(spark, paths, ("a", 1, 10.0), ("a", 2, 20.0))
    assert run_upsert_load(spark, paths.gold, paths.staging, paths.serving) == 2
    table = str(tmp_path / "table")
    assert run_append_load(spark, paths.gold, table) == 2
    write_gold(spark, paths, ("a", 2, 25.0))
    assert run_upsert_load(spark, paths.gold, paths.staging, paths.serving) == 1
    cells = serving_cells(spark, paths)
    assert cells["a", 2].total_revenue == Decimal("25.00") and cells["a", 2].updated_at is not None
    assert cells["a", 1].last_run_id is None
    assert not [name for name in os.listdir(paths.staging) if name.endswith(".parquet")]
    assert run_append_load(spark, paths.gold, table) == 1
    assert read_layer(spark, table).count() == 3


def test_publishing_reads_the_committed_snapshot(spark, paths, monkeypatch):
    write_gold(spark, paths, ("a", 1, 10.0))
    load(spark, paths, run_id="one")
    seen = {}

    def record(df, config, table, **options):
        seen.update(rows=df.collect(), table=table, **options)

    monkeypatch.setattr(serving_load, "write_jdbc", record)
    monkeypatch.setattr(serving_load, "read_jdbc", lambda *_: spark.range(len(seen["rows"])))
    publish_to_database(spark, paths.serving, {}, "serving.nights")
    assert len(seen["rows"]) == 1 and seen["table"] == "serving.nights"
    assert (seen["mode"], seen["truncate"]) == ("overwrite", True)
    monkeypatch.setattr(serving_load, "read_jdbc", lambda *_: spark.range(2))
    with pytest.raises(ValueError, match="staged 2 rows of 1"):
        publish_to_database(spark, paths.serving, {}, "serving.nights")


def test_snapshot_of_itself(spark, paths):
    write_gold(spark, paths, ("a", 1, 10.0))
    load(spark, paths, run_id="one")
    write_snapshot(read_snapshot(spark, paths.serving, SERVING), paths.serving)
    assert len(serving_cells(spark, paths)) == 1


def test_batch_keeps_malformed_lines_and_refuses_other_headers(spark, paths):
    write_reservations_csv(raw_frame(spark, {}, {}), paths.raw, DAY)
    header = ",".join(RAW_COLUMNS)
    line = ",".join(str(value) for value in raw_frame(spark, {}).first())
    os.makedirs(f"{paths.raw}/more")
    with open(f"{paths.raw}/more/odd.csv", "w") as file:
        file.write(f"{header}\n{line}\n{line},surplus\nshort,row\n")
    counts = run_batch(spark, paths)
    assert (counts.raw, counts.valid, counts.rejected) == (5, 3, 2)
    rejected = read_layer_of(spark, paths.layers, "rejected").collect()
    assert {row.validation_reason for row in rejected} == {"MALFORMED_ROW"}
    assert {row["_corrupt_record"] for row in rejected} == {f"{line},surplus", "short,row"}
    assert "_corrupt_record" not in read_layer_of(spark, paths.layers, "silver").columns
    swapped = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
    with open(f"{paths.raw}/more/swapped.csv", "w") as file:
        file.write(",".join(swapped) + f"\n{line}\n")
    with pytest.raises(Exception, match="header"):
        run_batch(spark, paths)


def test_failed_load_leaves_nothing_staged(spark, paths, monkeypatch):
    gold = [("a", date(2026, 6, 1))] * 2
    frame = spark.createDataFrame(gold, "property_code string, stay_date date")
    for name in ("reservation_count", "booked_rooms", "total_revenue", "adr"):
        frame = frame.withColumn(name, F.lit(1))
    frame = frame.withColumn("gold_ingestion_ts", F.current_timestamp())
    frame.write.parquet(paths.gold)
    with pytest.raises(ValueError, match="repeated keys"):
        load(spark, paths, run_id="bad")
    assert not os.path.exists(f"{paths.staging}/run_id=bad")


def files_of(directory):
    return {
        (child, name): os.stat(f"{root}/{name}").st_mtime_ns
        for root, _, names in os.walk(directory)
        for name in names
        for child in [os.path.relpath(root, directory)]
        if name.startswith("part-")
    }


def test_a_load_touches_only_its_months(spark, paths):
    write_gold(spark, paths, ("a", 1, 10.0))
    june = read_layer(spark, paths.gold)
    months = june.unionByName(june.withColumn("stay_date", F.lit(date(2026, 7, 1)))).unionByName(
        june.withColumn("stay_date", F.lit(date(2026, 8, 1)))
    )
    write_parquet(months, f"{paths.gold}-months")
    write_parquet(
        june.withColumns({"stay_date": F.lit(date(2026, 7, 1)), "total_revenue": F.lit(7.0)}),
        f"{paths.gold}-july",
    )
    paths.gold += "-months"
    assert load(spark, paths, run_id="one").merged == 3
    before = files_of(paths.serving)
    paths.gold = paths.gold.replace("months", "july")
    assert load(spark, paths, run_id="two").merged == 1
    after = files_of(paths.serving)
    assert before.items() <= after.items()
    (new,) = after.keys() - before.keys()
    assert new[0].endswith("part=2026-07")
    rows = read_snapshot(spark, paths.serving, SERVING).collect()
    assert sorted((row.stay_date.month, row.total_revenue, row.last_run_id) for row in rows) == [
        (6, Decimal("10.00"), "one"),
        (7, Decimal("7.00"), "two"),
        (8, Decimal("10.00"), "one"),
    ]
    read = read_snapshot(spark, paths.serving, SERVING, parts=["2026-07"])
    assert len(read.inputFiles()) == 1
    # A third version drops the first; what later ones still name stays.
    assert load(spark, paths, run_id="three").merged == 1
    assert read_snapshot(spark, paths.serving, SERVING).count() == 3
    assert len({key for key in files_of(paths.serving) if "2026-07" in key[0]}) == 2


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e20])
def test_measures_that_do_not_fit_stop_every_load(spark, paths, tmp_path, value):
    write_gold(spark, paths, ("a", 1, 10.0), ("a", 2, value))
    with pytest.raises(ValueError, match="1 rows of gold"):
        load(spark, paths, run_id="bad")
    with pytest.raises(ValueError, match="1 rows of gold"):
        run_upsert_load(spark, paths.gold, paths.staging, paths.serving)
    with pytest.raises(ValueError, match="1 rows of gold"):
        run_append_load(spark, paths.gold, str(tmp_path / "table"))
    assert serving_cells(spark, paths) == {}
    assert not os.path.exists(tmp_path / "table")


def test_counts_of_the_batch_reach_the_audit(spark, paths):
    write_reservations_csv(raw_frame(spark, {}, {"room_count": "0"}), paths.raw, DAY)
    counts = run_batch(spark, paths)
    load(spark, paths, run_id="one", batch=counts)
    (run,) = read_runs(spark, paths.audit).collect()
    assert (run.source_count, run.bronze_count, run.silver_count, run.rejected_count) == (2, 2, 1, 1)
    assert run.gold_count == run.staged_count == run.merged_count == counts.gold


@pytest.mark.parametrize("day", ["11.05.2026", "20260511", "2026-02-30"])
def test_business_dates_are_checked(spark, paths, day):
    with pytest.raises(ValueError):
        run_serving_load(spark, paths.gold, paths.staging, paths.serving, paths.audit, day)
    with pytest.raises(ValueError):
        run_reservation_batch(spark, paths.raw, paths.layers, day)
