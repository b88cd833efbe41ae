"""Scans of the input tables and of the medallion layers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

INPUT_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
)


def read_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one input table. Column pruning and filter pushdown
    happen when the caller selects/filters; nothing is read eagerly."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def layer_path(root: str, layer: str, table: str) -> str:
    """``<root>/<layer>/<table>`` — where a medallion table lives."""
    return os.path.join(root, layer, table)


def read_layer(spark: SparkSession, root: str, layer: str, table: str,
               schema: StructType) -> DataFrame:
    """Scan a written layer table under its schema, which stops partition
    values from being guessed (a string ``'01'`` would come back as int) and
    restores the column order (partition columns come last in a plain read).
    """
    return spark.read.schema(schema).parquet(layer_path(root, layer, table)).select(*schema.fieldNames())
