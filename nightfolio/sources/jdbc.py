"""JDBC sink and scan for a serving database."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

DEFAULT_DRIVER = "org.postgresql.Driver"


def jdbc_url(config: Mapping[str, Any]) -> str:
    return f"jdbc:postgresql://{config['host']}:{config['port']}/{config['database']}"


def _options(config: Mapping[str, Any], table: str) -> dict[str, str]:
    return {
        "url": jdbc_url(config),
        "dbtable": table,
        "user": config["user"],
        "password": config["password"],
        "driver": config.get("driver", DEFAULT_DRIVER),
    }


def write_jdbc(
    df: DataFrame,
    config: Mapping[str, Any],
    table: str,
    mode: str = "append",
    batch_rows: int = 10_000,
    connections: int = 32,
    truncate: bool = False,
) -> None:
    """Write to a database table.

    Each task commits on its own and may run twice after a lost executor, so load a
    staging table and compare counts before using it. ``connections`` bounds the
    tasks that write at a time; ``truncate`` with ``mode="overwrite"`` empties the
    table and keeps its definition.
    """
    (
        df.write.format("jdbc")
        .options(**_options(config, table))
        .option("batchsize", batch_rows)
        .option("numPartitions", connections)
        .option("truncate", truncate)
        .mode(mode)
        .save()
    )


def read_jdbc(
    spark: SparkSession,
    config: Mapping[str, Any],
    table: str,
    split_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    connections: int = 32,
) -> DataFrame:
    """Scan a database table, in ranges of ``split_column`` when one is given."""
    reader = spark.read.format("jdbc").options(**_options(config, table))
    if split_column is not None:
        reader = reader.options(
            partitionColumn=split_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=connections,
        )
    return reader.load()
