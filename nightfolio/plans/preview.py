"""First rows of each layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightfolio.schemas import BRONZE, GOLD_KEYS, SILVER
from nightfolio.sources.layers import read_layer_of

# Rows shown per layer.
BRONZE_ROWS = 10
SILVER_ROWS = 10
GOLD_ROWS = 50

#: Rows and order of each layer's preview. Only gold has a key; of other layers all columns
#: decide, so the same data show the same rows whatever the files and tasks.
PREVIEWS = {
    "bronze": (BRONZE_ROWS, BRONZE.fieldNames()),
    "silver": (SILVER_ROWS, SILVER.fieldNames()),
    "gold": (GOLD_ROWS, GOLD_KEYS),
}


def preview(df: DataFrame, rows: int, order_by: Sequence[str] = ()) -> DataFrame:
    """Up to ``rows`` rows: the first in order when one is given, else any.

    Each task keeps its first rows only; nothing is sorted as a whole.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def up_to_last(df: DataFrame, rows: int, order_by: Sequence[str]) -> DataFrame:
    """The rows of a stored layer that can be among the first ``rows`` in order.

    The first column alone is looked through for the value that the last of them has, which
    is done here; rows behind it need not be read whole, nor files that hold no others.
    """
    lead = F.col(order_by[0])
    leads = df.select(lead).orderBy(lead).limit(rows).collect()
    if len(leads) < rows:
        return df
    last = leads[-1][0]
    return df.filter(lead.isNull() if last is None else lead.isNull() | (lead <= F.lit(last)))


def preview_layer(spark: SparkSession, layers_path: str, layer: str) -> DataFrame:
    rows, order_by = PREVIEWS[layer]
    return preview(up_to_last(read_layer_of(spark, layers_path, layer), rows, order_by), rows, order_by)


def show_layers(spark: SparkSession, layers_path: str) -> None:
    for layer, title in (
        ("bronze", "bronze reservations"),
        ("silver", "silver reservations"),
        ("gold", "gold daily revenue"),
    ):
        print(f"\n{title}")
        preview_layer(spark, layers_path, layer).show(PREVIEWS[layer][0], truncate=False)
