"""CSV, JSON-lines and Parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightfolio.schemas import EVENT

#: Most rows of a compressed text file.
GZIP_ROWS = 1_000_000


#: Tasks of a scan for each slot, as far as there are rows for them.
TASKS_PER_SLOT = 4

#: How layers are compressed: they take two thirds of what they take by Spark's default.
LAYER_CODEC, ZSTD_LEVEL = "zstd", 9


@contextmanager
def _unless_set(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting that holds here, unless the session has one of its own."""
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)


@contextmanager
def scan_tasks(spark: SparkSession) -> Iterator[None]:
    """Scans that run here have several tasks for each slot, unless the session says how many.

    By default Spark aims at one for each; packing whole files makes it a few more, and then most
    slots wait for a second round of those.
    """
    tasks = TASKS_PER_SLOT * spark.sparkContext.defaultParallelism
    with _unless_set(spark, "spark.sql.files.minPartitionNum", tasks):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles here leaves the disks when it ends, unless the session says otherwise.

    By default it stays until the driver happens to collect its garbage, beside all that follows.
    """
    with _unless_set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", True):
        yield


def read_raw_reservations(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """All CSV files below ``path``, with a header line each, as text columns.

    With a schema, the header of every file must match it, in its order. Without one,
    columns are named by the header of one file and bound by position in all: only for
    files known to be alike. No pass over the data is made to infer types. Rows with too
    few fields get nulls and further fields are cut off; with ``malformed`` a column of
    that name keeps the whole line of such a row.
    """
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    if schema is not None:
        if malformed:
            schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
            # Pruned to some columns, the parser would not see that others are missing.
            reader = reader.option("columnNameOfCorruptRecord", malformed).option(
                "columnPruning", False
            )
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All JSON-lines event files below ``path``, nested as written."""
    return spark.read.schema(EVENT).option("recursiveFileLookup", True).json(path)


def read_layer(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet layer. With a schema, an empty directory reads as no rows."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """A gold layer with its keys as stored, even where they are directory names.

    The type of a partition column is guessed from the names, which would turn the
    property code ``001`` into the number 1.
    """
    keys = {"property_code": T.StringType(), "stay_date": T.DateType()}
    fields = spark.read.parquet(path).schema.fields
    schema = T.StructType([T.StructField(f.name, keys.get(f.name, f.dataType)) for f in fields])
    return spark.read.schema(schema).parquet(path)


def layer_writer(df: DataFrame, mode: str, partition_by: Sequence[str] = ()) -> DataFrameWriter:
    """A writer that compresses well, unless the session says how."""
    codec = df.sparkSession.conf.get("spark.sql.parquet.compression.codec", LAYER_CODEC)
    writer = df.write.mode(mode).option("compression", codec).partitionBy(*partition_by)
    return writer.option("parquet.compression.codec.zstd.level", ZSTD_LEVEL)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Write a layer. With ``partition_by`` rows are first brought together per value;
    a value that holds much of the data is split over several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    layer_writer(df, mode, partition_by).parquet(path)


def write_rejects(rejected: DataFrame, count: int, path: str, keep_stale: bool = False) -> bool:
    """Write rejected rows; returns whether anything was written.

    A clean run replaces earlier rejects by an empty layer. With ``keep_stale`` it
    leaves the directory alone instead, so that old rejects stay there.
    """
    if count == 0:
        if keep_stale:
            return False
        # Known to be empty: no need to look through the data for it.
        write_parquet(rejected.limit(0), path)
        return True
    # Rejects are few and spread over all tasks: without this, one tiny file each.
    write_parquet(rejected.hint("rebalance"), path)
    return True


def dated_path(directory: str, prefix: str, business_date: str, extension: str) -> str:
    return f"{directory.rstrip('/')}/{prefix}_{business_date.replace('-', '')}.{extension}"


def text_writer(df: DataFrame, gzip: bool) -> DataFrameWriter:
    """A compressed file is read by one task, so it holds only so many rows."""
    writer = df.write.mode("overwrite")
    if not gzip:
        return writer
    # Four fifths of the bytes of the fastest level, and most of its speed.
    return writer.options(compression="gzip", maxRecordsPerFile=GZIP_ROWS).option(
        "zlib.compress.level", "FIVE"
    )


def write_reservations_csv(
    records: DataFrame, directory: str, business_date: str, gzip: bool = False
) -> str:
    """Flat records as CSV part files with header, below one path per business date.

    ``ValueError`` when there are none. With ``gzip`` the files are compressed.
    """
    path = dated_path(directory, "reservations", business_date, "csv")
    text_writer(require_rows(records), gzip).option("header", True).csv(path)
    return path


def write_events_json(
    events: DataFrame, directory: str, business_date: str, gzip: bool = False
) -> str:
    """Nested events, one JSON object per line, below one path per business date.

    ``ValueError`` when there are none. With ``gzip`` the files are compressed.
    """
    path = dated_path(directory, "reservation_events", business_date, "json")
    text_writer(require_rows(events), gzip).option("ignoreNullFields", False).json(path)
    return path


def require_rows(df: DataFrame) -> DataFrame:
    """The same frame, or ``ValueError`` when it has no row. Stops at the first row found."""
    if df.select(F.lit(1)).isEmpty():
        raise ValueError("there are no records to write")
    return df
