import os

import pytest
from pyspark.sql import functions as F

from builders import GOOD, raw_frame, staged_frame
from nightfolio.operators.ingest import to_bronze
from nightfolio.schemas import BRONZE, RAW, RAW_COLUMNS
from nightfolio.sources import files, jdbc, snapshots, staging

CONFIG = {
    "host": "db.example",
    "port": 5433,
    "database": "lodging",
    "user": "loader",
    "password": "secret",
}


def write_csv(path, header, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write("\n".join([",".join(header), *lines]) + "\n")


def test_csv_columns_follow_the_header(spark, tmp_path):
    header = list(reversed(RAW_COLUMNS)) + ["extra"]
    values = [GOOD[name] for name in reversed(RAW_COLUMNS)]
    write_csv(str(tmp_path / "a.csv"), header, ",".join(values) + ",more")
    write_csv(str(tmp_path / "nested" / "b.csv"), header, ",".join(values))
    rows = files.read_raw_reservations(spark, str(tmp_path)).orderBy("extra").collect()
    assert [row.extra for row in rows] == [None, "more"]
    assert all(row[name] == GOOD[name] for row in rows for name in RAW_COLUMNS)


def test_csv_values_stay_text(spark, tmp_path):
    short = ",".join(["RES7", "", '"a code, with a comma"'])
    write_csv(
        str(tmp_path / "a.csv"),
        RAW_COLUMNS,
        ",".join({**GOOD, "arrival_date": "oops", "room_count": "02"}.values()),
        short,
    )
    frame = files.read_raw_reservations(spark, str(tmp_path), RAW)
    assert {kind for _, kind in frame.dtypes} == {"string"}
    rows = {row.reservation_id: row for row in frame.collect()}
    assert (rows["RES1"].arrival_date, rows["RES1"].room_count) == ("oops", "02")
    assert rows["RES7"].property_code is None
    assert rows["RES7"].confirmation_number == "a code, with a comma"
    assert rows["RES7"].updated_ts is None


def test_csv_header_must_match_a_given_schema(spark, tmp_path):
    write_csv(str(tmp_path / "a.csv"), list(reversed(RAW_COLUMNS)), ",".join(GOOD.values()))
    with pytest.raises(Exception, match="(?i)header"):
        files.read_raw_reservations(spark, str(tmp_path), RAW).collect()


def test_parquet_modes_and_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    bronze = to_bronze(raw_frame(spark, {}, {"property_code": "GOA002"}), "2026-05-11")
    files.write_parquet(bronze, path)
    files.write_parquet(bronze, path)
    assert files.read_layer(spark, path).count() == 2
    files.write_parquet(bronze, path, mode="append")
    assert files.read_layer(spark, path).count() == 4
    files.write_parquet(bronze, path, partition_by=["property_code"])
    assert sorted(name for name in os.listdir(path) if "=" in name) == [
        "property_code=GOA001",
        "property_code=GOA002",
    ]
    assert files.read_layer(spark, path, BRONZE).count() == 2


def test_rejects_are_cleared_or_kept(spark, tmp_path):
    path = str(tmp_path / "rejects")
    rejected = raw_frame(spark, {}, {})
    assert files.write_rejects(rejected, 2, path)
    assert not files.write_rejects(rejected.limit(0), 0, path, keep_stale=True)
    assert files.read_layer(spark, path).count() == 2
    assert files.write_rejects(rejected.limit(0), 0, path)
    assert files.read_layer(spark, path).count() == 0


def test_snapshot_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.range(3).select(F.col("id").alias("n"))
    assert snapshots.read_snapshot(spark, path, frame.schema).count() == 0
    for expected in (3, 6, 12, 24):
        current = snapshots.read_snapshot(spark, path, frame.schema)
        rows = frame if expected == 3 else current.unionByName(current)
        snapshots.write_snapshot(rows, path)
        assert snapshots.read_snapshot(spark, path, frame.schema).count() == expected
    names = [name for name in sorted(os.listdir(path)) if not name.startswith(".")]
    assert names[:2] == ["commit-00000003.json", "commit-00000004.json"]
    assert [name[:16] for name in names[2:]] == ["version-00000003", "version-00000004"]
    with pytest.raises(ValueError):
        snapshots.write_snapshot(frame, path, keep=0)


def test_half_written_snapshot_does_not_count(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.range(3)
    snapshots.write_snapshot(frame, path)
    broken = frame.select(
        F.when(F.col("id") == 2, F.raise_error(F.lit("task lost"))).otherwise(F.col("id")).alias("id")
    )
    with pytest.raises(Exception, match="task lost"):
        snapshots.write_snapshot(broken, path)
    assert snapshots.read_snapshot(spark, path, frame.schema).count() == 3
    # What a killed job leaves: a directory without a commit.
    os.makedirs(f"{path}/version-00000009")
    assert snapshots.read_snapshot(spark, path, frame.schema).count() == 3
    snapshots.write_snapshot(spark.range(5), path)
    assert snapshots.read_snapshot(spark, path, frame.schema).count() == 5
    versions = sorted(name for name in os.listdir(path) if name.startswith("version"))
    assert [name[:16] for name in versions] == [f"version-0000000{n}" for n in (1, 2, 9)]


def test_staging_area(spark, tmp_path):
    path = str(tmp_path / "staging")
    one = staged_frame(spark, {"property_code": "a"}, {"property_code": "b"})
    staging.stage_run(one, path, "20260511")
    staging.stage_run(one, path, "run_two")
    staging.stage_run(one, path, "run_two")
    assert staging.read_staged(spark, path).count() == 4
    staged = staging.read_staged(spark, path, "20260511")
    # A run id that looks like a number stays text.
    assert {row.run_id for row in staged.collect()} == {"20260511"}
    assert "PartitionFilters: [isnotnull(run_id" in staged._jdf.queryExecution().toString()
    assert staging.read_staged(spark, path, "unknown").count() == 0
    assert staging.clear_run(spark, path, "run_two")
    assert not staging.clear_run(spark, path, "run_two")
    assert staging.read_staged(spark, path).count() == 2
    staging.clear_all(spark, path)
    assert staging.read_staged(spark, path).count() == 0
    with pytest.raises(ValueError, match="run id"):
        staging.clear_run(spark, path, "..//run")


class RecordingWriter:
    """Stands in for a frame and its writer; there is no database to write to here."""

    def __init__(self):
        self.calls = {"options": {}}
        self.write = self

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **values):
        self.calls["options"].update(values)
        return self

    def option(self, name, value):
        self.calls["options"][name] = value
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def save(self):
        self.calls["saved"] = True


def test_jdbc_options():
    assert jdbc.jdbc_url(CONFIG) == "jdbc:postgresql://db.example:5433/lodging"
    writer = RecordingWriter()
    jdbc.write_jdbc(writer, CONFIG, "stage.nights")
    assert writer.calls["format"] == "jdbc" and writer.calls["mode"] == "append"
    assert writer.calls["saved"]
    options = writer.calls["options"]
    assert options["url"] == jdbc.jdbc_url(CONFIG)
    assert options["dbtable"] == "stage.nights"
    assert (options["user"], options["password"]) == ("loader", "secret")
    assert options["driver"] == "org.postgresql.Driver"
    assert options["batchsize"] == 10_000 and options["numPartitions"] == 32

    writer = RecordingWriter()
    jdbc.write_jdbc(
        writer, {**CONFIG, "driver": "other.Driver"}, "t", mode="overwrite", truncate=True
    )
    assert writer.calls["options"]["driver"] == "other.Driver"
    assert writer.calls["options"]["truncate"] is True and writer.calls["mode"] == "overwrite"


def test_snapshot_without_spark_markers(spark, tmp_path):
    path = str(tmp_path / "table")
    for expected in (3, 6):
        write = spark.range(expected)
        snapshots.write_snapshot(write, path)
        for version in tmp_path.glob("table/version-*/_SUCCESS"):
            version.unlink()
        assert snapshots.read_snapshot(spark, path, write.schema).count() == expected


def test_versions_without_a_commit_are_not_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.range(3)
    snapshots.write_snapshot(frame, path)
    for commit in tmp_path.glob("table/commit-*"):
        commit.unlink()
    with pytest.raises(RuntimeError, match="no commit"):
        snapshots.read_snapshot(spark, path, frame.schema)
    with pytest.raises(RuntimeError, match="no commit"):
        snapshots.write_snapshot(frame, path)


def test_lost_data_files_are_noticed(spark, tmp_path):
    path = str(tmp_path / "table")
    snapshots.write_snapshot(spark.range(3), path)
    next(tmp_path.glob("table/version-*/part-*")).unlink()
    with pytest.raises(RuntimeError, match="lacks"):
        snapshots.read_snapshot(spark, path, spark.range(1).schema)


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "table")
    snapshots.write_snapshot(spark.range(3), path)
    version = snapshots.current_version(spark, path)
    snapshots.write_snapshot(spark.range(4), path, after=version)
    with pytest.raises(RuntimeError, match="another writer"):
        snapshots.write_snapshot(spark.range(5), path, after=version)
    assert snapshots.read_snapshot(spark, path, spark.range(1).schema).count() == 4
    assert len(list(tmp_path.glob("table/version-*"))) == 2


def test_gold_keys_keep_leading_zeros(spark, tmp_path):
    path = str(tmp_path / "gold")
    gold = spark.createDataFrame([("001", 1.5), ("010", 2.5)], "property_code string, adr double")
    files.write_parquet(gold, path, partition_by=["property_code"])
    assert sorted(files.read_gold(spark, path).select("property_code", "adr").collect()) == [
        ("001", 1.5), ("010", 2.5)
    ]
