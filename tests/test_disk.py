"""What a job keeps on the disks at one time: raw text, layers, and what it shuffles."""

import os
import time
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from builders import raw_frame
from checks import domain, queries
from nightfolio.operators.ingest import to_bronze
from nightfolio.operators.quality import with_reason
from nightfolio.operators.refine import split
from nightfolio.plans import incremental_batch, reservation_batch, turns
from nightfolio.plans.incremental_batch import read_refreshed, run_incremental_batch
from nightfolio.plans.reservation_batch import run_reservation_batch
from nightfolio.schemas import RAW
from nightfolio.sources import files, layers
from nightfolio.sources.layers import read_layer_of
from nightfolio.sources.snapshots import NewVersion

DAY = "2026-05-11"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stays(spark, rows=300):
    """Stays over half a year and across months; some on one day, some with unknown or no days."""
    frame = raw_frame(spark, {}).drop("reservation_id", "property_code", "arrival_date", "departure_date")
    n = F.col("id")
    arrival = F.when(n % 3 == 0, F.lit(60)).otherwise(n * 7 % 180)
    numbers = spark.range(0, rows, 1, 4).select(
        F.concat(F.lit("RES"), (n / 2).cast("int")).alias("reservation_id"),
        F.concat(F.lit("P"), n % 5).alias("property_code"),
        F.when(n % 11 == 0, "unknown")
        .when(n % 13 > 0, F.date_add(F.lit(date(2026, 1, 1)), arrival.cast("int")).cast("string"))
        .alias("arrival_date"),
        F.date_add(F.lit(date(2026, 1, 1)), (arrival + 1 + n % 50).cast("int")).cast("string").alias("departure_date"),
    )
    return numbers.join(F.broadcast(frame)).select(*RAW.fieldNames())


def counted(df, *without):
    return Counter(map(tuple, df.drop(*without).collect()))


def names_below(path, ending=""):
    return [n for _, _, found in os.walk(path) for n in found if n[0] not in "._" and n.endswith(ending)]


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for top in manager.localDirsString() for n in names_below(top) if n.startswith("shuffle_")}


def left_over(spark, before, seconds=20):
    """Shuffle files that do not go."""
    until = time.time() + seconds
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_a_large_refresh_has_compressed_raw_files(spark, tmp_path, monkeypatch):
    raw = stays(spark).withColumn("guest_id", F.concat(F.lit("GUEST"), F.hash("reservation_id", "arrival_date") % 9 + 9))
    monkeypatch.setattr(queries, "raw_reservations", lambda *given: raw)
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(files, "GZIP_ROWS", 100)
    found = counted(queries.incremental_gold(spark, ""))
    for name in ("one", "two", "three"):
        written = names_below(f"{tmp_path}/refresh/raw/{name}")
        assert written and all(n.endswith(".csv.gz") for n in written)
    gold = queries.portable(queries._gold(queries._silver(spark, "")))
    assert found == counted(gold, "gold_ingestion_ts") and len(found) > 200


@pytest.mark.parametrize("cluster", [False, True])
def test_gold_in_turns_is_the_same(spark, tmp_path, monkeypatch, cluster):
    files.write_reservations_csv(stays(spark), f"{tmp_path}/raw", DAY)
    found, ranges, to_gold = {}, [], reservation_batch.to_gold
    monkeypatch.setattr(
        reservation_batch, "to_gold", lambda *given: ranges.append(given[2:4]) or to_gold(*given)
    )
    for rows in (300, 100):
        ranges.clear()
        monkeypatch.setattr(turns, "GOLD_ROWS", rows)
        monkeypatch.setattr(turns, "DEALT_ROWS", rows)
        path = f"{tmp_path}/{rows}"
        counts = run_reservation_batch(spark, f"{tmp_path}/raw", path, DAY, money="decimal", cluster_silver=cluster)
        gold = read_layer_of(spark, path, "gold")
        assert gold.select("gold_ingestion_ts").distinct().count() == 1
        split_rows = [
            counted(read_layer_of(spark, path, layer), "bronze_ingestion_ts", "silver_ingestion_ts")
            for layer in ("silver", "rejected")
        ]
        found[rows] = counts, counted(gold, "gold_ingestion_ts"), split_rows
    assert len(ranges) == 3 and found[100] == found[300] and found[300][0].gold > 200


def test_refreshed_gold_in_turns_is_the_same(spark, tmp_path, monkeypatch):
    raw, ranges, to_gold = stays(spark), [], incremental_batch.to_gold
    monkeypatch.setattr(turns, "GOLD_ROWS", 100)
    monkeypatch.setattr(
        incremental_batch, "to_gold", lambda *given: ranges.append(given[2:4]) or to_gold(*given)
    )
    source, path = f"{tmp_path}/raw", f"{tmp_path}/layers"
    for n, part in enumerate((F.col("property_code") < "P2", F.col("property_code") >= "P1")):
        raw.filter(part).coalesce(1).write.option("header", True).csv(f"{source}/{n}")
        run_incremental_batch(spark, source, path, DAY, money="decimal")
    assert len([given for given in ranges if given]) > 2
    both = raw.unionByName(raw.filter(F.col("property_code") == "P1"))
    monkeypatch.setattr(queries, "raw_reservations", lambda *given: both)
    found = counted(read_refreshed(spark, path, "gold"), "gold_ingestion_ts")
    assert found == counted(queries._gold(queries._silver(spark, "")), "gold_ingestion_ts")
    assert len(found) > 200


def test_rows_are_dealt_out_in_turns(spark, tmp_path, monkeypatch):
    stays(spark).write.parquet(f"{tmp_path}/raw")
    rows = split(with_reason(to_bronze(spark.read.schema(RAW).parquet(f"{tmp_path}/raw"), DAY, datetime(2026, 5, 11))), datetime(2026, 5, 11))
    starts = [date(2026, 2, 1), date(2026, 3, 2), date(2026, 3, 2), date(2026, 5, 1)]
    found, sizes, in_turns = [], [], layers._in_turns

    def watched(*given):
        for part in in_turns(*given):
            sizes.append(part.count())
            yield part

    monkeypatch.setattr(layers, "_in_turns", watched)
    for given in ((), starts):
        path = f"{tmp_path}/layers-{len(given)}"
        with NewVersion(spark, path) as version:
            silver, _ = layers.write_split(rows, version, ["arrival_date"], starts=given)
            version.commit()
            assert not os.path.exists(version.directory("turns"))
        found.append([counted(read_layer_of(spark, path, layer)) for layer in ("silver", "rejected")])
    assert found[0] == found[1] and len(sizes) == 5 and sum(sizes) == 300 and max(sizes) < 100
    of_file = files.read_layer(spark, silver).groupBy(F.input_file_name()).agg(
        F.min("arrival_date"), F.max("arrival_date")
    )
    for _, low, high in of_file.collect():
        assert low is None or not any(low < start < high for start in starts)


def test_what_a_batch_shuffles_goes(spark, tmp_path):
    before = shuffle_files(spark)
    files.write_reservations_csv(stays(spark), f"{tmp_path}/raw", DAY)
    run_reservation_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/layers", DAY, cluster_silver=True)
    run_incremental_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/refreshed", DAY)
    assert not left_over(spark, before)
    assert spark.conf.get(CLEANUP, None) is None


def test_layers_are_compressed_unless_the_session_says_how(spark, tmp_path):
    name = "spark.sql.parquet.compression.codec"
    files.write_parquet(stays(spark), f"{tmp_path}/own")
    spark.conf.set(name, "snappy")
    try:
        files.write_parquet(stays(spark), f"{tmp_path}/set")
    finally:
        spark.conf.unset(name)
    assert names_below(f"{tmp_path}/own", ".zstd.parquet") and names_below(f"{tmp_path}/set", ".snappy.parquet")


def test_raw_files_of_a_batch_come_from_the_table(spark, tmp_path, monkeypatch):
    n = F.col("id")
    spark.range(1, 400, 1, 2).select(
        n.alias("l_orderkey"),
        (n * 3).alias("l_partkey"),
        (n % 40).alias("l_suppkey"),
        (n % 4 + 1).cast("int").alias("l_linenumber"),
        (n % 9).cast("double").alias("l_quantity"),
        (n * 1.25).cast("double").alias("l_extendedprice"),
        F.lit(0.05).cast("double").alias("l_tax"),
        F.element_at(F.array(F.lit("A"), F.lit("N")), (n % 2 + 1).cast("int")).alias("l_returnflag"),
        F.lit(datetime(1997, 3, 1)).alias("l_shipdate"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    paths = []
    monkeypatch.setattr(domain, "scratch_path", lambda spark, name: paths.append(name) or f"{tmp_path}/{name}")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(domain, "_written", {})
    gold = counted(queries.batch_gold(spark, str(tmp_path)))
    assert not paths
    assert gold == counted(queries.portable(queries._gold(queries._silver(spark, str(tmp_path))).drop("gold_ingestion_ts")))
    assert paths == ["raw"] and len(gold) == 16


def test_turns_cover_all_nights():
    assert turns.cuts(None, 0, 10) == turns.cuts([5] * 127, 10, 10) == []
    days = list(range(127))
    assert len(turns.cuts(days, 10**9, 10)) == 127
    assert turns.cuts(days, 20, 10) == [date(1970, 1, 1) + timedelta(days=63)]
    assert turns.cuts([-(10**7)] * 64 + [10**7] * 63, 100, 10) == []
    assert turns.night_ranges([]) == [(None, None)]
    one, two = date(2026, 1, 1), date(2026, 2, 1)
    assert turns.night_ranges([two, one, two]) == [
        (None, one - timedelta(days=1)), (one, two - timedelta(days=1)), (two, None)
    ]
    assert turns.night_ranges([one, two], one, two) == [(one, two - timedelta(days=1)), (two, two)]
