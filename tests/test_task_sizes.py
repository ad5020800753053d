"""No task gets a share of the rows that does not shrink with the number of tasks."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from builders import raw_frame
from checks import domain, queries
from nightfolio.operators.ingest import to_bronze, to_events
from nightfolio.operators.quality import with_reason
from nightfolio.operators.refine import split
from nightfolio.plans import reservation_batch
from nightfolio.plans.incremental_batch import read_refreshed, run_incremental_batch
from nightfolio.plans.preview import PREVIEWS, preview_layer, up_to_last
from nightfolio.plans.reservation_batch import run_reservation_batch
from nightfolio.schemas import RAW
from nightfolio.sources import files, layers
from nightfolio.sources.snapshots import NewVersion

DAY = "2026-05-11"


@pytest.fixture
def settings(spark):
    """Sets session settings and puts them back."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def files_below(path, ending):
    return [name for _, _, names in os.walk(path) for name in names if name.endswith(ending)]


def tasks_of(path, ending):
    """How many tasks wrote the files below a folder."""
    return len({re.match(r"part-(\d+)", n).group(1) for n in files_below(path, ending) if n[0] == "p"})


def reservations(spark, tasks, **changes):
    """2000 rows in so many tasks."""
    row = raw_frame(spark, changes)
    numbers = spark.range(0, 2000, 1, tasks).select(F.concat(F.lit("RES"), "id").alias("reservation_id"))
    return numbers.join(F.broadcast(row.drop("reservation_id"))).select(*RAW.fieldNames())


def scratch(monkeypatch, tmp_path, raw):
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "raw_reservations", lambda spark, sf: raw)


def test_a_large_file_is_parsed_by_several_tasks(spark, tmp_path, settings):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "layers")
    reservations(spark, 1).write.option("header", True).csv(raw)
    assert tasks_of(raw, ".csv") == 1
    settings("spark.sql.files.maxPartitionBytes", "32768")
    run_incremental_batch(spark, raw, path, DAY, money="decimal")
    stored = [d for d in os.listdir(path) if d.startswith("version-")]
    assert tasks_of(f"{path}/{stored[0]}/bronze", ".parquet") > 4
    assert read_refreshed(spark, path, "bronze").count() == 2000


def test_raw_files_of_the_refresh_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    raw = reservations(spark, 12, guest_id="GUEST3")
    scratch(monkeypatch, tmp_path, raw)
    gold = queries.incremental_gold(spark, "").collect()
    assert tasks_of(tmp_path / "refresh" / "raw" / "one", ".csv") == 12
    assert [row.reservation_count for row in gold] == [2000, 2000]


def test_malformed_lines_are_written_by_all_tasks(spark, tmp_path, monkeypatch):
    guests = (F.col("reservation_id").substr(4, 9).cast("int") % 13 * 17 % 13).cast("string")
    raw = reservations(spark, 12).withColumn("guest_id", F.concat(F.lit("GUEST"), guests))
    scratch(monkeypatch, tmp_path, raw)
    found = {row[0]: row for row in queries.csv_malformed(spark, "").collect()}
    assert tasks_of(tmp_path / "malformed", ".csv") == 12
    assert found["MALFORMED_ROW"].row_count == 154 and found[None].row_count == 1846


@pytest.mark.parametrize("changes", [{"property_code": None}, {}])
def test_rows_alike_in_the_clustered_columns_are_divided(spark, tmp_path, settings, changes):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    reservations(spark, 4, **changes).write.parquet(str(tmp_path / "raw"))
    rows = split(with_reason(to_bronze(spark.read.schema(RAW).parquet(str(tmp_path / "raw")), DAY)))
    with NewVersion(spark, str(tmp_path / "layers")) as version:
        silver, rejected = layers.write_split(rows, version, ["arrival_date"])
        version.commit()
    assert tasks_of(rejected if changes else silver, ".parquet") == 8
    assert layers.read_layer_of(spark, str(tmp_path / "layers"), "rejected" if changes else "silver").count() == 2000


def test_events_are_stored_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    raw = reservations(spark, 1)
    scratch(monkeypatch, tmp_path, raw)
    monkeypatch.setattr(files, "GZIP_ROWS", 500)
    assert queries.json_roundtrip(spark, "").count() == 2000
    assert len(files_below(tmp_path / "json", ".json.gz")) == 4
    files.write_events_json(to_events(raw), str(tmp_path / "plain"), DAY)
    sizes = [
        sum(os.path.getsize(file) for file in glob.glob(f"{tmp_path}/{name}/*/part-*"))
        for name in ("json", "plain")
    ]
    assert 5 * sizes[0] < sizes[1]


def test_the_batch_reads_compressed_files_and_splits_without_a_sort(spark, tmp_path, monkeypatch):
    scratch(monkeypatch, tmp_path, reservations(spark, 3, guest_id=None))
    open_files, writing = [], layers._open_files
    monkeypatch.setattr(layers, "_open_files", lambda *given: open_files.append(given[1]) or writing(*given))
    counted = {row.layer: row for row in queries.batch_counts(spark, "").collect()}
    assert {counted[name].row_count for name in ("bronze", "silver")} == {2000}
    assert open_files == [2]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert len(files_below(tmp_path / "batch" / "raw", ".csv.gz")) == 3


def test_a_preview_reads_whole_only_rows_that_can_be_first(spark, tmp_path):
    path = str(tmp_path / "layers")
    spaced = reservations(spark, 4).withColumn(
        "reservation_id", F.when(F.col("reservation_id") != "RES1077", F.col("reservation_id"))
    )
    for name, raw in {"one": reservations(spark, 4), "null": spaced.unionByName(spaced)}.items():
        files.write_reservations_csv(raw, f"{path}/raw-{name}", DAY, gzip=True)
        run_reservation_batch(spark, f"{path}/raw-{name}", f"{path}/{name}", DAY)
        for layer in ("bronze", "silver"):
            stored = layers.read_layer_of(spark, f"{path}/{name}", layer)
            rows, order = PREVIEWS[layer]
            first = [row.reservation_id for row in stored.orderBy(*order).limit(rows).collect()]
            some = up_to_last(stored, rows, order)
            assert some.count() < 30
            shown = preview_layer(spark, f"{path}/{name}", layer).collect()
            assert [row.reservation_id for row in shown] == first
            assert up_to_last(stored, 5000, order).count() == stored.count()
    assert first[:2] == [None, None]


def test_the_batch_scans_with_several_tasks_a_slot(spark, tmp_path, settings, monkeypatch):
    path = str(tmp_path / "layers")
    files.write_reservations_csv(reservations(spark, 2), f"{path}/raw", DAY)
    seen, name = [], "spark.sql.files.minPartitionNum"
    writing = reservation_batch.write_split
    monkeypatch.setattr(
        reservation_batch, "write_split", lambda *given: seen.append(spark.conf.get(name, None)) or writing(*given)
    )
    run_reservation_batch(spark, f"{path}/raw", f"{path}/layers", DAY)
    assert spark.conf.get(name, None) is None
    settings(name, "3")
    run_reservation_batch(spark, f"{path}/raw", f"{path}/layers", DAY)
    slots = spark.sparkContext.defaultParallelism
    assert seen == [str(files.TASKS_PER_SLOT * slots), "3"] and spark.conf.get(name) == "3"


def test_the_raw_table_is_written_by_several_tasks_a_slot(spark, tmp_path, monkeypatch):
    seen, name = [], "spark.sql.files.minPartitionNum"
    monkeypatch.setattr(domain, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(domain, "_written", {})
    monkeypatch.setattr(domain, "table", lambda *given: reservations(spark, 3))
    monkeypatch.setattr(
        domain, "_reservations_of", lambda lines: seen.append(spark.conf.get(name, None)) or lines
    )
    assert domain.raw_reservations(spark, "").count() == 2000
    assert seen == [str(files.TASKS_PER_SLOT * spark.sparkContext.defaultParallelism)]
    assert spark.conf.get(name, None) is None


def test_text_is_checked_and_typed_once_for_both_loads(spark, tmp_path, monkeypatch):
    scratch(monkeypatch, tmp_path, reservations(spark, 3))
    silvers, typing = [], queries._silver
    monkeypatch.setattr(queries, "_silver", lambda *given: silvers.append(1) or typing(*given))
    queries.truncate_stage(spark, "").collect()
    assert len(silvers) == 1 and files_below(tmp_path / "silver", ".parquet")
    for gold in queries._two_loads(spark, ""):
        assert all("/silver/" in file for file in gold.inputFiles()) and gold.inputFiles()
