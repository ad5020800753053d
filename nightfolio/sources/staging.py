"""Staging area: one Parquet partition per run."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightfolio.operators.serve import with_staged_at
from nightfolio.schemas import STAGED
from nightfolio.sources.paths import delete_directory, make_directory


def require_run_id(run_id: str) -> str:
    """The same id, or ``ValueError`` unless it can name a directory."""
    if not re.fullmatch(r"[\w.-]+", run_id, re.ASCII):
        raise ValueError(f"a run id is made of letters, digits, '_', '.' and '-', not {run_id!r}")
    return run_id


def run_directory(path: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/run_id={require_run_id(run_id)}"


def stage_run(
    staged: DataFrame, path: str, run_id: str, at: Column | datetime | None = None
) -> None:
    """Replace what is staged for this run; other runs stay. Repeating it is harmless."""
    rows = with_staged_at(staged, at).drop("run_id")
    rows.write.mode("overwrite").parquet(run_directory(path, run_id))


def read_staged(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Rows staged by one run, from its partition only, or by all runs."""
    staged = spark.read.schema(STAGED).parquet(path).select(*STAGED.fieldNames())
    return staged if run_id is None else staged.filter(F.col("run_id") == run_id)


def clear_run(spark: SparkSession, path: str, run_id: str) -> bool:
    """Drop the rows staged by one run."""
    return delete_directory(spark, run_directory(path, run_id))


def clear_all(spark: SparkSession, path: str) -> None:
    """Drop everything staged; the empty staging area stays."""
    delete_directory(spark, path)
    make_directory(spark, path)
