"""Every operator as a query over whole tables.

Results go out in types that any engine shows alike: dates and timestamps as text,
decimals as doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.domain import (
    BUSINESS_DATE,
    not_stored,
    raw_reservations,
    scratch_path,
    table,
)
from nightfolio.functions.stay import run_id
from nightfolio.operators import audit, quality, revenue, serve
from nightfolio.operators.ingest import flatten_events, to_bronze, to_events
from nightfolio.operators.refine import TYPES, to_silver
from nightfolio.operators.synth import reservations_for, synthesise
from nightfolio.plans.incremental_batch import read_refreshed, run_incremental_batch
from nightfolio.plans.preview import BRONZE_ROWS, GOLD_ROWS, SILVER_ROWS, preview, preview_layer
from nightfolio.plans.reservation_batch import BatchCounts, run_reservation_batch
from nightfolio.plans.serving_load import (
    read_appended,
    run_append_load,
    run_serving_load,
    run_upsert_load,
)
from nightfolio.plans.synthesis import store
from nightfolio.schemas import (
    AUDIT,
    AUDIT_COUNTS,
    BRONZE,
    GOLD_KEYS,
    MALFORMED,
    RAW,
    RUN_EVENT,
    SERVING,
)
from nightfolio.sources import files, staging
from nightfolio.sources.layers import read_layer_of
from nightfolio.sources.paths import delete_directory
from nightfolio.sources.run_log import read_runs
from nightfolio.sources.snapshots import read_snapshot, write_snapshot

# Two overlapping loads, told apart by arrival date.
FIRST_LOAD_BEFORE = date(1999, 1, 1)
SECOND_LOAD_FROM = date(1998, 12, 1)
FIRST_RUN, SECOND_RUN, OTHER_RUN = "run_one", "run_two", "run_other"
RANGE_FIRST, RANGE_LAST = date(1998, 1, 15), date(1998, 3, 10)


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


BRONZE_AT = "2026-05-11 01:00:00"
SILVER_AT = "2026-05-11 02:00:00"
GOLD_AT = "2026-05-11 03:00:00"
FIRST_MERGE_AT = "2026-05-12 04:00:00"
SECOND_MERGE_AT = "2026-05-13 05:00:00"


def portable(df: DataFrame) -> DataFrame:
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "date":
            column = column.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("decimal"):
            column = column.cast("double")
        columns.append(column.alias(name))
    return df.select(*columns)


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return to_bronze(raw_reservations(spark, sf), BUSINESS_DATE, _at(BRONZE_AT))


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    return quality.with_reason(_bronze(spark, sf))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return to_silver(quality.valid_rows(_checked(spark, sf)), _at(SILVER_AT))


def _gold(silver: DataFrame, **options) -> DataFrame:
    return revenue.to_gold(silver, money="decimal", gold_at=_at(GOLD_AT), **options)


_GOLD_READS = (
    "reservation_id",
    "property_code",
    "arrival_date",
    "departure_date",
    "booking_status",
    "room_count",
    "total_revenue",
)


def _stored_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver's columns that gold reads, on disk: each gold scans them twice, and text is
    checked and typed once for all."""
    path = scratch_path(spark, "silver")
    silver = _silver(spark, sf).select(*_GOLD_READS)
    with files.scan_tasks(spark):
        files.write_parquet(silver, path)
    return files.read_layer(spark, path, silver.schema)


def _two_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Gold of early and of late arrivals; nights around the turn of 1998 are in both."""
    silver = _stored_silver(spark, sf)
    early = silver.filter(F.col("arrival_date") < F.lit(FIRST_LOAD_BEFORE))
    late = silver.filter(F.col("arrival_date") >= F.lit(SECOND_LOAD_FROM))
    return _gold(early), _gold(late)


def _staged_runs(spark: SparkSession, sf: str) -> DataFrame:
    early, late = _two_loads(spark, sf)
    return serve.to_staging(early, FIRST_RUN, BUSINESS_DATE).unionByName(
        serve.to_staging(late, SECOND_RUN, BUSINESS_DATE)
    )


# Layers


def bronze_enrich(spark, sf):
    return portable(_bronze(spark, sf))


def reject_counts(spark, sf):
    return quality.reason_counts(_checked(spark, sf))


def strict_reject_counts(spark, sf):
    return quality.reason_counts(
        quality.with_reason(_bronze(spark, sf), quality.strict_rules())
    )


def strict_reject_odd_values(spark, sf):
    """Amounts that are no finite number and fractions of a room, which only strict rules see."""
    guest = F.substring("guest_id", 6, 20).cast("bigint")
    odd = _bronze(spark, sf).withColumns(
        {
            "room_count": F.when(guest % 11 == 0, "0.5").otherwise(F.col("room_count")),
            "total_revenue": F.when(guest % 13 == 0, "NaN")
            .when(guest % 17 == 0, "Infinity")
            .otherwise(F.col("total_revenue")),
        }
    )
    return quality.reason_counts(quality.with_reason(odd, quality.strict_rules()))


def rejected_rows(spark, sf):
    return portable(quality.rejected_rows(_checked(spark, sf)))


def valid_rows(spark, sf):
    return portable(quality.valid_rows(_checked(spark, sf)).drop(quality.REASON))


def split_counts(spark, sf):
    return _checked(spark, sf).agg(*quality.split_counts())


def silver_typed(spark, sf):
    return portable(_silver(spark, sf))


# Revenue

_STAY_COLUMNS = (
    "reservation_id",
    "property_code",
    "confirmation_number",
    "guest_id",
    "arrival_date",
    "departure_date",
    "room_count",
    "total_revenue",
    "stay_nights",
)


def active_stays(spark, sf):
    stays = revenue.active_stays(_silver(spark, sf))
    return portable(stays.select(*_STAY_COLUMNS, "revenue_per_night"))


def stay_nights_exploded(spark, sf):
    nights = revenue.stay_nights(revenue.active_stays(_silver(spark, sf)))
    return portable(nights.select(*_STAY_COLUMNS, "stay_date"))


def gold_daily_revenue(spark, sf):
    return portable(_gold(_silver(spark, sf)))


def gold_double_form(spark, sf):
    """The default money form: counts, and whether money is within a cent of the decimal form."""
    silver = _silver(spark, sf)
    exact = _gold(silver).select(
        *GOLD_KEYS, F.col("total_revenue").alias("_total"), F.col("adr").alias("_adr")
    )
    def near(left: str, right: str) -> Column:
        return F.abs(F.col(left) - F.col(right).cast("double")) < 0.0101

    return portable(
        revenue.to_gold(silver)
        .join(exact, list(GOLD_KEYS))
        .select(
            *GOLD_KEYS,
            "reservation_count",
            "booked_rooms",
            near("total_revenue", "_total").alias("total_within_cent"),
            near("adr", "_adr").alias("adr_within_cent"),
        )
    )


def gold_date_range(spark, sf):
    return portable(_gold(_silver(spark, sf), first=RANGE_FIRST, last=RANGE_LAST))


# Serving


def staging_projection(spark, sf):
    staged = serve.to_staging(_gold(_silver(spark, sf)), FIRST_RUN, BUSINESS_DATE)
    return portable(serve.with_staged_at(staged, _at(FIRST_MERGE_AT)))


def _serving_after_first(spark: SparkSession, staged: DataFrame) -> DataFrame:
    empty = spark.createDataFrame([], SERVING)
    return serve.merge_run(empty, staged, FIRST_RUN, _at(FIRST_MERGE_AT))


def merge_run_scoped(spark, sf):
    staged = staging.read_staged(spark, _stage_both(spark, sf))
    serving = _serving_after_first(spark, staged)
    return portable(
        serve.merge_run(serving, staged, SECOND_RUN, _at(SECOND_MERGE_AT), first=SECOND_LOAD_FROM,
                        last=date(9999, 12, 31))
    )


def upsert_all(spark, sf):
    staged = staging.read_staged(spark, _stage_both(spark, sf))
    serving = _serving_after_first(spark, staged)
    late = serve.of_run(staged, SECOND_RUN)
    return portable(serve.upsert_all(serving, late, _at(SECOND_MERGE_AT)))


def append_load(spark, sf):
    early, late = _two_loads(spark, sf)
    return portable(serve.append_load(serve.serving_columns(early), late))


def delete_run(spark, sf):
    return portable(serve.without_run(_staged_runs(spark, sf), SECOND_RUN))


def run_scope(spark, sf):
    return portable(serve.of_run(_staged_runs(spark, sf), SECOND_RUN))


def run_scope_count(spark, sf):
    return serve.run_count(_staged_runs(spark, sf), SECOND_RUN)


def scalar_fetch(spark, sf):
    """First column of the first row, put back beside the rows it belongs to."""
    staged = _staged_runs(spark, sf)
    value = serve.scalar(serve.run_count(staged, FIRST_RUN))
    return staged.groupBy("run_id").agg(
        (F.count(F.lit(1)) - F.lit(value)).alias("more_than_first_run")
    )


def reconcile_counts(spark, sf):
    """Gold rows, staged rows and rows the merge left under the run's id."""
    staged = staging.read_staged(spark, _stage_both(spark, sf))
    serving = serve.merge_run(
        _serving_after_first(spark, staged), staged, SECOND_RUN, _at(SECOND_MERGE_AT)
    )
    _, late = _two_loads(spark, sf)
    counted = (
        late.select(F.lit(SECOND_RUN).alias("run_id"), F.lit("gold").alias("of"))
        .unionByName(serve.of_run(staged, SECOND_RUN).select("run_id", F.lit("staged").alias("of")))
        .unionByName(
            serve.of_run(serving, SECOND_RUN, "last_run_id").select(
                F.col("last_run_id").alias("run_id"), F.lit("merged").alias("of")
            )
        )
    )
    return (
        counted.groupBy("run_id")
        .agg(
            *[
                F.count_if(F.col("of") == name).alias(f"{name}_count")
                for name in ("gold", "staged", "merged")
            ]
        )
        .withColumn("balanced", F.col("gold_count") == F.col("staged_count"))
    )


def key_violations(spark, sf):
    """Nights of single reservations are no key of gold: repeats and missing codes show."""
    bronze = _bronze(spark, sf)
    return portable(quality.key_violations(bronze, ["property_code", "arrival_date"]))


# Audit

_AUDIT_AT = "2026-05-13 06:00:00"


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    """One earlier run per order."""
    status = (
        F.when(F.col("o_orderstatus") == "O", "SUCCESS")
        .when(F.col("o_orderstatus") == "F", "FAILED")
        .otherwise("RUNNING")
    )
    values = {
        "run_id": F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")),
        "job_name": F.col("o_orderpriority"),
        "business_date": F.col("o_orderdate").cast("date"),
        "status": status,
        "gold_count": F.when(F.col("o_orderstatus") == "O", F.col("o_custkey")),
        "started_at": F.col("o_orderdate").cast("timestamp"),
        "ended_at": F.when(
            F.col("o_orderstatus") != "P", F.date_add(F.col("o_orderdate").cast("date"), 1)
        ),
        "error_message": F.when(F.col("o_orderstatus") == "F", "it's broken"),
    }
    return table(spark, sf, "orders").select(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in AUDIT
        ]
    )


def _run_of(step: int) -> Column:
    """Ids of every ``step``-th earlier run, and as many that are not known."""
    return F.concat(F.lit("run_"), (F.col("o_orderkey") * step).cast("string")).alias("run_id")


def audit_start(spark, sf):
    runs = table(spark, sf, "orders").select(
        _run_of(2),
        F.concat(F.lit("again "), "o_orderpriority").alias("job_name"),
        F.date_add(F.col("o_orderdate").cast("date"), 7).alias("business_date"),
    )
    return portable(audit.start_runs(_audit(spark, sf), runs, _at(_AUDIT_AT)))


def audit_success(spark, sf):
    counts = table(spark, sf, "orders").select(
        _run_of(3),
        F.col("o_custkey").alias("gold_count"),
        F.col("o_custkey").alias("staged_count"),
        (F.col("o_custkey") + 1).alias("merged_count"),
    )
    return portable(audit.finish_runs(_audit(spark, sf), counts, _at(_AUDIT_AT)))


def audit_failure(spark, sf):
    errors = table(spark, sf, "orders").select(
        _run_of(3), F.concat(F.lit("can't load "), "o_orderpriority").alias("error_message")
    )
    return portable(audit.fail_runs(_audit(spark, sf), errors, _at(_AUDIT_AT)))


def audit_single_run(spark, sf):
    """One new run entered and finished, one known run failed, in the table of all runs."""
    runs = audit.start_run(_audit(spark, sf), "run_new", "load gold", BUSINESS_DATE, _at(_AUDIT_AT))
    runs = audit.finish_run(
        runs, "run_new", _at(_AUDIT_AT), gold_count=7, staged_count=7, merged_count=5
    )
    return portable(audit.fail_run(runs, "run_1", "can't say 'why'", _at(_AUDIT_AT)))


def _run_events(spark: SparkSession, sf: str) -> DataFrame:
    """A log with the orders of a customer as the changes of a run, a day's in order of the
    keys. Many runs end before they start, start again or never do."""
    kind = (
        F.when(F.col("o_orderstatus") == "O", "start")
        .when(F.col("o_orderstatus") == "F", "finish")
        .otherwise("fail")
    )
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    start, finish = kind == "start", kind == "finish"
    values = {
        "run_id": F.concat(F.lit("run_"), F.col("o_custkey").cast("string")),
        "kind": kind,
        "at": day,
        "tick": key,
        "id": F.lit("log"),
        "job_name": F.when(start, F.col("o_orderpriority")),
        "business_date": F.when(start, day),
        "gold_count": F.when(finish, key),
        "staged_count": F.when(finish & (key % 3 > 0), key + 1),
        "error_message": F.when(kind == "fail", F.concat(F.lit("it's "), F.col("o_orderpriority"))),
    }
    return table(spark, sf, "orders").select(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in RUN_EVENT
        ]
    )


def audit_log(spark, sf):
    """The table of runs from a log of starts, ends and failures."""
    return portable(audit.fold_runs(_run_events(spark, sf)))


def audit_log_compacted(spark, sf):
    """The same when the older part of the log, by key, has been compacted on disk before, and is again."""
    path = scratch_path(spark, "log")
    events, schema = _run_events(spark, sf), RUN_EVENT
    for part in (F.col("tick") % 3 == 0, F.col("tick") % 3 == 1):
        before = read_snapshot(spark, path, schema)
        write_snapshot(audit.deciding_events(before.unionByName(events.filter(part))), path)
    late = events.filter(F.col("tick") % 3 == 2)
    return portable(audit.fold_runs(read_snapshot(spark, path, schema).unionByName(late)))


def run_id_format(spark, sf):
    started = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("o_custkey")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        run_id(
            F.concat(F.lit("Load "), "o_orderpriority"),
            F.col("o_orderdate").cast("date").cast("string"),
            started.cast("timestamp"),
        ).alias("run_id"),
    )


# Events and synthetic data


def _events(records: DataFrame, revenue_type: str) -> DataFrame:
    return _spread_events(to_events(records, revenue_type))


def _spread_events(events: DataFrame) -> DataFrame:
    """Events with their structs spread out, one column per field."""
    return events.select(
        "eventId",
        "eventType",
        "eventTimestamp",
        "propertyCode",
        F.col("confirmationNumber.value").alias("confirmationNumber_value"),
        *[
            F.col(f"reservationDetails.{name}").alias(f"details_{name}")
            for name in events.schema["reservationDetails"].dataType.fieldNames()
        ],
    )


def event_nest(spark, sf):
    return portable(_events(raw_reservations(spark, sf), "decimal(18,2)"))


def event_flatten(spark, sf):
    return flatten_events(to_events(raw_reservations(spark, sf), "decimal(18,2)"))


def _synthetic(spark: SparkSession, sf: str) -> DataFrame:
    """As many synthetic reservations as there are orders."""
    indexes = table(spark, sf, "orders").select((F.col("o_orderkey") + 1).alias("index"))
    return reservations_for(indexes, BUSINESS_DATE, seed=7)


def synth_reservations(spark, sf):
    return _synthetic(spark, sf)


def synth_one_property(spark, sf):
    indexes = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 4000000000).alias("index"))
    return reservations_for(indexes, BUSINESS_DATE, property_code="GOA001", seed=2026)


def synth_events(spark, sf):
    return _events(_synthetic(spark, sf), "bigint")


def synth_batch(spark, sf):
    """A batch for one property through its argument checks: records beside their events."""
    count = table(spark, sf, "orders").count()
    records, events = synthesise(spark, count, BUSINESS_DATE, "GOA001", seed=7)
    spread = _spread_events(events).withColumn("reservation_id", F.substring("eventId", 5, 40))
    return records.join(spread, "reservation_id")


def synth_stored(spark, sf):
    """Synthetic reservations stored in both forms and read back, as flat text."""
    base = scratch_path(spark, "synthetic")
    records = _synthetic(spark, sf)
    csv, json = store(
        records, to_events(records, "bigint"), BUSINESS_DATE, f"{base}/csv", f"{base}/json"
    )
    flat = files.read_raw_reservations(spark, csv, RAW)
    events = flatten_events(files.read_events(spark, json))
    return flat.withColumn("form", F.lit("csv")).unionByName(
        events.withColumn("form", F.lit("json"))
    )


# Previews


def preview_bronze(spark, sf):
    bronze = _bronze(spark, sf)
    return portable(preview(bronze, BRONZE_ROWS, bronze.columns))


def preview_silver(spark, sf):
    silver = _silver(spark, sf)
    return portable(preview(silver, SILVER_ROWS, silver.columns))


def preview_gold(spark, sf):
    return portable(preview(_gold(_silver(spark, sf)), GOLD_ROWS, GOLD_KEYS))


# Files and whole jobs


def csv_roundtrip(spark, sf):
    directory = scratch_path(spark, "csv")
    files.write_reservations_csv(raw_reservations(spark, sf), directory, BUSINESS_DATE)
    return files.read_raw_reservations(spark, directory, RAW)


def csv_malformed(spark, sf):
    """Lines with a field too many or too few, kept whole beside those that fit."""
    path = scratch_path(spark, "malformed")
    fields = [F.coalesce(F.col(name), F.lit("")) for name in RAW.fieldNames()]
    guest = F.substring("guest_id", 6, 20).cast("bigint")
    line = (
        F.when(guest % 13 == 0, F.concat_ws(",", *fields, F.lit("surplus")))
        .when(guest % 17 == 0, F.concat_ws(",", *fields[:-1]))
        .otherwise(F.concat_ws(",", *fields))
    )
    # Whole lines as one column whose name is the header: it comes on top of each task's file,
    # and with a separator that no line has, and no quotes, the lines go out as they are.
    (
        raw_reservations(spark, sf)
        .select(line.alias(",".join(RAW.fieldNames())))
        .write.options(header=True, sep="\u0001", quote="")
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
    raw = files.read_raw_reservations(spark, path, RAW, MALFORMED)
    checked = quality.with_reason(to_bronze(raw, BUSINESS_DATE, _at(BRONZE_AT)))
    return checked.groupBy(quality.REASON).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.length(MALFORMED)).alias("malformed_length"),
    )


def json_roundtrip(spark, sf):
    directory = scratch_path(spark, "json")
    events = to_events(raw_reservations(spark, sf), "decimal(18,2)")
    files.write_events_json(events, directory, BUSINESS_DATE, gzip=True)
    return flatten_events(files.read_events(spark, directory))


def layer_roundtrip(spark, sf):
    path = scratch_path(spark, "layer")
    files.write_parquet(_bronze(spark, sf), path)
    return portable(files.read_layer(spark, path, BRONZE))


def gold_by_property(spark, sf):
    """Gold written with a directory per property, then read back."""
    path = scratch_path(spark, "gold-by-property")
    gold = _gold(_silver(spark, sf))
    files.write_parquet(gold, path, partition_by=["property_code"])
    return portable(files.read_layer(spark, path, gold.schema).select(*gold.columns))


def rejects_conditional(spark, sf):
    """Rejects written, then left alone by a clean run that keeps stale ones."""
    path = scratch_path(spark, "rejects")
    checked = _checked(spark, sf)
    rejected = quality.rejected_rows(checked)
    files.write_rejects(rejected, rejected.count(), path)
    files.write_rejects(rejected.limit(0), 0, path, keep_stale=True)
    return portable(files.read_layer(spark, path, checked.schema))


def rejects_cleared(spark, sf):
    """Rejected rows on disk after a run with rejects and after a clean one."""
    path = scratch_path(spark, "rejects")
    checked = _checked(spark, sf)
    rejected = quality.rejected_rows(checked)
    files.write_rejects(rejected, rejected.count(), path)
    after_first = files.read_layer(spark, path, checked.schema).count()
    files.write_rejects(rejected.limit(0), 0, path)
    left = files.read_layer(spark, path, checked.schema)
    return left.agg(
        F.lit(after_first).cast("bigint").alias("after_rejects"),
        F.count(F.lit(1)).alias("after_clean_run"),
    )


_CLOCKS = ("bronze_ingestion_ts", "silver_ingestion_ts")


def _run_batch(spark: SparkSession, sf: str, **options) -> tuple[str, BatchCounts]:
    base = scratch_path(spark, "batch")
    with not_stored():
        raw = raw_reservations(spark, sf)
    with files.scan_tasks(spark):
        files.write_reservations_csv(raw, f"{base}/raw", BUSINESS_DATE, gzip=True)
    counts = run_reservation_batch(
        spark,
        f"{base}/raw",
        f"{base}/layers",
        BUSINESS_DATE,
        money="decimal",
        **options,
    )
    return f"{base}/layers", counts


def batch_gold(spark, sf):
    """The whole batch from CSV files to the gold layer on disk."""
    layers, _ = _run_batch(spark, sf)
    return portable(read_layer_of(spark, layers, "gold").drop("gold_ingestion_ts"))


def batch_split(spark, sf):
    """Silver and rejected rows as one pass over bronze has written them, rejected ones with
    the raw text of the columns that silver types, and their reason."""
    path, _ = _run_batch(spark, sf, cluster_silver=True)
    silver = read_layer_of(spark, path, "silver").drop(*_CLOCKS)
    rejected = read_layer_of(spark, path, "rejected").drop("bronze_ingestion_ts", MALFORMED)
    raw = {name: f"raw_{name}" for name in TYPES}
    both = silver.unionByName(rejected.withColumnsRenamed(raw), allowMissingColumns=True)
    return portable(both)


def clustered_month(spark, sf):
    """Gold of some weeks, from silver on disk that is sorted by arrival."""
    path, _ = _run_batch(spark, sf, cluster_silver=True)
    silver = read_layer_of(spark, path, "silver")
    return portable(_gold(silver, first=RANGE_FIRST, last=RANGE_LAST))


def incremental_gold(spark, sf):
    """Gold after files came, were copied and went; only what changed was made anew."""
    base = scratch_path(spark, "refresh")
    third = F.substring("guest_id", 6, 20).cast("bigint") % 3
    with not_stored():
        raw = raw_reservations(spark, sf)
    # As plain text a large table's raw files would take more of the disk than all layers.
    gzip = raw.count() > files.GZIP_ROWS

    def write(name: str, part: int) -> None:
        writer = files.text_writer(raw.filter(third == part), gzip).option("header", True)
        with files.scan_tasks(spark):
            writer.csv(f"{base}/raw/{name}")

    def refresh() -> None:
        run_incremental_batch(spark, f"{base}/raw", f"{base}/layers", BUSINESS_DATE, money="decimal")

    write("one", 0)
    write("two", 1)
    write("wrong", 1)
    refresh()
    delete_directory(spark, f"{base}/raw/wrong")
    write("three", 2)
    refresh()
    gold = read_refreshed(spark, f"{base}/layers", "gold")
    return portable(gold.drop("gold_ingestion_ts"))


def preview_stored(spark, sf):
    """The previews of bronze and silver as the job shows them, without what clocks decide."""
    path, _ = _run_batch(spark, sf)
    names = RAW.fieldNames()
    bronze, silver = (
        portable(preview_layer(spark, path, layer)).select(
            F.lit(layer).alias("layer"), *[F.col(name).cast("string") for name in names]
        )
        for layer in ("bronze", "silver")
    )
    return bronze.unionByName(silver)


def batch_counts(spark, sf):
    """Rows of each layer on disk, beside the counts the batch reported."""
    path, counts = _run_batch(spark, sf)
    reported = {
        "bronze": counts.raw,
        "silver": counts.valid,
        "rejected": counts.rejected,
        "gold": counts.gold,
    }
    layers = [
        read_layer_of(spark, path, layer).agg(
            F.lit(layer).alias("layer"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(count).cast("bigint").alias("reported"),
        )
        for layer, count in reported.items()
    ]
    union, *rest = layers
    for layer in rest:
        union = union.unionByName(layer)
    return union


def _load_twice(spark: SparkSession, sf: str) -> str:
    base = scratch_path(spark, "load")
    for name, gold in zip((FIRST_RUN, SECOND_RUN), _two_loads(spark, sf)):
        files.write_parquet(gold, f"{base}/{name}")
        run_serving_load(
            spark,
            f"{base}/{name}",
            f"{base}/staging",
            f"{base}/serving",
            f"{base}/audit",
            BUSINESS_DATE,
            run_id=name,
        )
    return base


def serving_load(spark, sf):
    """Two loads into a serving table on disk; its clock columns as yes or no."""
    base = _load_twice(spark, sf)
    serving = read_snapshot(spark, f"{base}/serving", SERVING)
    return portable(
        serving.withColumns(
            {
                "created_at": F.col("created_at").isNotNull(),
                "updated_at": F.col("updated_at").isNotNull(),
            }
        )
    )


def serving_load_audit(spark, sf):
    """What the two loads recorded about themselves."""
    base = _load_twice(spark, sf)
    runs = read_runs(spark, f"{base}/audit")
    return portable(
        runs.select(
            "run_id",
            "job_name",
            "business_date",
            "status",
            *AUDIT_COUNTS,
            (F.col("ended_at") >= F.col("started_at")).alias("ended"),
            "error_message",
        )
    )


def upsert_load(spark, sf):
    """Two loads without bookkeeping, on disk."""
    base = scratch_path(spark, "upsert")
    for name, gold in zip((FIRST_RUN, SECOND_RUN), _two_loads(spark, sf)):
        files.write_parquet(gold, f"{base}/{name}")
        run_upsert_load(spark, f"{base}/{name}", f"{base}/staging", f"{base}/serving")
    serving = read_snapshot(spark, f"{base}/serving", SERVING)
    return portable(serving.select(*GOLD_KEYS, *serve.MEASURES))


def failed_load(spark, sf):
    """A load that knows its batch, then one that repeated keys stop: the two records, what
    is left in staging, and the serving rows of each run."""
    base = scratch_path(spark, "failed")
    early, late = _two_loads(spark, sf)
    raw, valid, rejected = _checked(spark, sf).agg(*quality.split_counts()).first()
    loads = {
        FIRST_RUN: (early, BatchCounts(raw, valid, rejected, gold=0)),
        SECOND_RUN: (late.unionByName(late), None),
    }
    for name, (gold, batch) in loads.items():
        files.write_parquet(gold, f"{base}/{name}")
        try:
            run_serving_load(
                spark,
                f"{base}/{name}",
                f"{base}/staging",
                f"{base}/serving",
                f"{base}/audit",
                BUSINESS_DATE,
                run_id=name,
                batch=batch,
            )
        except ValueError:
            if name != SECOND_RUN:
                raise
    staged = staging.read_staged(spark, f"{base}/staging").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("staged_left")
    )
    serving = read_snapshot(spark, f"{base}/serving", SERVING).groupBy(
        F.col("last_run_id").alias("run_id")
    ).agg(F.count(F.lit(1)).alias("serving_rows"))
    runs = read_runs(spark, f"{base}/audit")
    return (
        runs.join(staged, "run_id", "left")
        .join(serving, "run_id", "left")
        .select(
            "run_id",
            "status",
            *AUDIT_COUNTS,
            F.col("error_message").like("incomplete or repeated keys%").alias("keys_named"),
            F.coalesce("staged_left", F.lit(0)).alias("staged_left"),
            F.coalesce("serving_rows", F.lit(0)).alias("serving_rows"),
        )
    )


def coded_keys_load(spark, sf):
    """Both loads from gold laid out by property, its codes digits with leading zeros."""
    base = scratch_path(spark, "coded")
    for name, gold in zip((FIRST_RUN, SECOND_RUN), _two_loads(spark, sf)):
        code = F.concat(F.lit("00"), F.substring("property_code", 2, 20))
        files.write_parquet(
            gold.withColumn("property_code", code), f"{base}/{name}", partition_by=["property_code"]
        )
    paths = f"{base}/staging", f"{base}/serving"
    run_serving_load(
        spark, f"{base}/{FIRST_RUN}", *paths, f"{base}/audit", BUSINESS_DATE, run_id=FIRST_RUN
    )
    run_upsert_load(spark, f"{base}/{SECOND_RUN}", *paths)
    run_append_load(spark, f"{base}/{SECOND_RUN}", f"{base}/table")
    columns = [*GOLD_KEYS, *serve.MEASURES]
    serving = read_snapshot(spark, f"{base}/serving", SERVING).select(*columns)
    appended = files.read_layer(spark, f"{base}/table").select(*columns)
    return portable(
        serving.withColumn("of", F.lit("serving")).unionByName(
            appended.withColumn("of", F.lit("appended"))
        )
    )


def append_to_files(spark, sf):
    base = scratch_path(spark, "append")
    for name, gold in zip((FIRST_RUN, SECOND_RUN), _two_loads(spark, sf)):
        files.write_parquet(gold, f"{base}/{name}")
        run_append_load(spark, f"{base}/{name}", f"{base}/table")
    return portable(files.read_layer(spark, f"{base}/table"))


def append_once(spark, sf):
    """Both loads appended under their ids, each attempted twice, the second time the other's rows."""
    base = scratch_path(spark, "append-once")
    for name, gold in zip((FIRST_RUN, SECOND_RUN), _two_loads(spark, sf)):
        files.write_parquet(gold, f"{base}/{name}")
    for name, other in ((FIRST_RUN, SECOND_RUN), (SECOND_RUN, FIRST_RUN)):
        run_append_load(spark, f"{base}/{name}", f"{base}/table", name)
        run_append_load(spark, f"{base}/{other}", f"{base}/table", name)
    return portable(read_appended(spark, f"{base}/table"))


def _stage_both(spark: SparkSession, sf: str) -> str:
    return _stage(spark, *_two_loads(spark, sf))


def _stage(spark: SparkSession, *loads: DataFrame) -> str:
    path = scratch_path(spark, "staging")
    for name, gold in zip((FIRST_RUN, SECOND_RUN), loads):
        staging.stage_run(
            serve.to_staging(gold, name, BUSINESS_DATE), path, name, _at(FIRST_MERGE_AT)
        )
    return path


def staging_cleared_run(spark, sf):
    """Two runs staged on disk, one cleared."""
    path = _stage_both(spark, sf)
    staging.clear_run(spark, path, FIRST_RUN)
    return portable(staging.read_staged(spark, path))


def truncate_stage(spark, sf):
    """Two runs staged on disk, the area emptied, one staged anew."""
    early, late = _two_loads(spark, sf)
    path = _stage(spark, early, late)
    staging.clear_all(spark, path)
    staged = serve.to_staging(early, OTHER_RUN, BUSINESS_DATE)
    staging.stage_run(staged, path, OTHER_RUN, _at(FIRST_MERGE_AT))
    return portable(staging.read_staged(spark, path))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        bronze_enrich,
        reject_counts,
        strict_reject_counts,
        strict_reject_odd_values,
        rejected_rows,
        valid_rows,
        split_counts,
        silver_typed,
        active_stays,
        stay_nights_exploded,
        gold_daily_revenue,
        gold_double_form,
        gold_date_range,
        staging_projection,
        merge_run_scoped,
        upsert_all,
        append_load,
        delete_run,
        run_scope,
        run_scope_count,
        scalar_fetch,
        reconcile_counts,
        key_violations,
        audit_start,
        audit_success,
        audit_failure,
        audit_single_run,
        audit_log,
        audit_log_compacted,
        run_id_format,
        event_nest,
        event_flatten,
        synth_reservations,
        synth_one_property,
        synth_events,
        synth_batch,
        synth_stored,
        preview_bronze,
        preview_silver,
        preview_gold,
        csv_roundtrip,
        csv_malformed,
        json_roundtrip,
        layer_roundtrip,
        gold_by_property,
        rejects_conditional,
        rejects_cleared,
        batch_gold,
        batch_split,
        clustered_month,
        incremental_gold,
        preview_stored,
        batch_counts,
        serving_load,
        serving_load_audit,
        failed_load,
        coded_keys_load,
        upsert_load,
        append_to_files,
        append_once,
        staging_cleared_run,
        truncate_stage,
    )
}
