"""Raw reservations played by the ``lineitem`` table.

One line is one raw reservation, all columns text as a CSV scan would give them.
Defects come in by remainder, so that every rule has rows, several rows have more
than one defect, and some values are present but unreadable. About a third of the
rows belong to one property, and reservation ids repeat.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightfolio.schemas import RAW, RAW_COLUMNS
from nightfolio.sources.files import scan_tasks
from nightfolio.sources.paths import delete_directory, is_complete

BUSINESS_DATE = "2026-05-11"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, step: int) -> Column:
    return F.col(column) % step == 0


def _day(column: Column) -> Column:
    return column.cast("date").cast("string")


def _reservations_of(lines: DataFrame) -> DataFrame:
    ship = F.col("l_shipdate")
    created = ship - F.make_dt_interval(F.lit(30), F.lit(0), F.lit(0), F.col("l_partkey"))
    updated = created + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("l_suppkey") % 181).cast("int")
    )
    tens = F.call_function("div", F.col("l_suppkey"), F.lit(10))
    twenties = F.call_function("div", F.col("l_orderkey"), F.lit(20))
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    rate_plans = F.array(*[F.lit(code) for code in ("BAR", "CORP", "MEMBER", "PKG", "PREPAY")])
    room_types = F.array(*[F.lit(code) for code in ("STD", "DLX", "STE", "KING", "QUEEN")])
    rate_plan = F.get(rate_plans, (F.col("l_suppkey") % 5).cast("int"))
    text = {
        "reservation_id": F.concat(F.lit("RES"), (twenties + 100000).cast("string")),
        "property_code": F.when(_every("l_orderkey", 97), None)
        .when(F.col("l_tax") < 0.025, "P0")
        .otherwise(F.concat(F.lit("P"), (tens + 1).cast("string"))),
        "confirmation_number": F.when(
            ~_every("l_orderkey", 89), F.concat(F.lit("CNF"), F.col("l_orderkey").cast("string"))
        ),
        "guest_id": F.concat(F.lit("GUEST"), F.col("l_partkey").cast("string")),
        "arrival_date": F.when(_every("l_orderkey", 83), None)
        .when(_every("l_orderkey", 101), "unknown")
        .otherwise(_day(ship)),
        "departure_date": F.when(_every("l_orderkey", 79), None)
        .when(_every("l_partkey", 53), _day(ship))
        .otherwise(F.date_add(ship.cast("date"), F.col("l_linenumber")).cast("string")),
        "room_type": F.get(room_types, (F.col("l_partkey") % 5).cast("int")),
        "rate_plan_code": rate_plan,
        "price_plan_code": F.concat(
            rate_plan, F.when(_every("l_partkey", 2), "_STD").otherwise("_DLX")
        ),
        "booking_status": F.when(_every("l_orderkey", 73), None)
        .when(_every("l_orderkey", 71), "HOLD")
        .when(F.col("l_returnflag") == "A", "BOOKED")
        .when(F.col("l_returnflag") == "N", "MODIFIED")
        .otherwise("CANCELLED"),
        "room_count": F.when(_every("l_partkey", 59), "0")
        .when(_every("l_partkey", 67), "two")
        .otherwise(F.col("l_quantity").cast("int").cast("string")),
        "total_revenue": F.when(_every("l_partkey", 61), F.concat(F.lit("-"), amount)).when(
            ~_every("l_partkey", 71), amount
        ),
        "currency": F.lit("INR"),
        "created_ts": created.cast("string"),
        "updated_ts": updated.cast("string"),
    }
    return lines.select(*[text[name].alias(name) for name in RAW_COLUMNS])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder the cluster shares, or, in local mode without one, in
    a temporary folder. What is there goes when the driver ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        shared = os.path.join(tempfile.gettempdir(), "nightfolio")
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        delete_directory(spark, path)
    except Exception:  # the session may have gone first
        pass


def _spread(df: DataFrame) -> DataFrame:
    """A file of one row group is one task; share its rows out unless there are enough."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


_written: dict[tuple[str, str], str] = {}
_storing = contextvars.ContextVar("_storing", default=True)


@contextlib.contextmanager
def not_stored() -> Iterator[None]:
    """Raw reservations that are asked for here are made in each scan: for jobs that write
    them to raw files of their own and work on those."""
    token = _storing.set(False)
    try:
        yield
    finally:
        _storing.reset(token)


def raw_reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``lineitem`` table as raw reservations, written once per application.

    As a table on disk it is scanned like any landing zone: columns and filters of the
    operators under test reach a file, not the expressions that make up the text.
    """
    if not _storing.get():
        with scan_tasks(spark):
            return _reservations_of(_spread(table(spark, sf_dir, "lineitem")))
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written or not is_complete(spark, _written[key]):
        path = scratch_path(spark, "raw")
        with scan_tasks(spark):
            lines = _spread(table(spark, sf_dir, "lineitem"))
            _reservations_of(lines).write.parquet(path)
        _written[key] = path
    return spark.read.schema(RAW).parquet(_written[key])
