"""Loads whose schema changes over time, and one read over all of them.

Every load is written under its own schema into a folder of its own, and a row
of the load list says which schema that is. The merged schema has every column
that any load has, each of the narrowest type that holds all of its types
without loss: integers widen to longer ones, to decimals and (up to int) to
double, float to double, decimals to longer ones, date to timestamp without
zone. Columns that no type holds are refused by name. A read scans the loads of
equal schema together, casts what is narrower, fills columns that a load lacks
with null, and puts all scans side by side: no shuffle, and filters and column
selections still reach every scan.
"""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType,
    StringType, StructField, StructType, TimestampNTZType,
)

from haulwise.sources.layout import TABLE_CODEC

LOADS = "load_id string, load_ts string, schema string"
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
_INTEGERS = list(_DIGITS)


def wider(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that holds all values of both, or None."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    for x, y in ((a, b), (b, a)):
        if x in _INTEGERS and y in _INTEGERS and _INTEGERS.index(x) < _INTEGERS.index(y):
            return y
        if isinstance(y, DoubleType) and (isinstance(x, FloatType) or x in _INTEGERS[:3]):
            return y
        if isinstance(y, DecimalType) and x in _INTEGERS:
            x = DecimalType(_DIGITS[x], 0)
        if isinstance(y, DecimalType) and isinstance(x, DecimalType):
            scale = max(x.scale, y.scale)
            whole = max(x.precision - x.scale, y.precision - y.scale)
            return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
        if isinstance(x, DateType) and isinstance(y, TimestampNTZType):
            return y
    return None


def merge_schemas(schemas: list[StructType]) -> StructType:
    """All columns, in the order in which they first appear, nullable."""
    merged: dict[str, DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            kind = wider(merged[f.name], f.dataType) if f.name in merged else f.dataType
            if kind is None:
                raise ValueError(f"column {f.name!r} is {merged[f.name].simpleString()} in one load and "
                                 f"{f.dataType.simpleString()} in another")
            merged[f.name] = kind
    return StructType([StructField(n, t, True) for n, t in merged.items()])


def _path(root: str, load_id: str) -> str:
    return os.path.join(root, "loads", f"load_id={load_id}")


def write_load(df: DataFrame, root: str, load_id: str, load_ts: str) -> None:
    """Adds a load under its own schema. The list is written last: a load that
    failed on the way is not read."""
    df.write.mode("overwrite").option("compression", TABLE_CODEC).parquet(_path(root, load_id))
    df.sparkSession.createDataFrame([(load_id, load_ts, df.schema.json())], LOADS).write.mode("append").parquet(
        os.path.join(root, "_loads"))


def read_loads(spark: SparkSession, root: str) -> list[tuple[str, StructType]]:
    """(load, schema) of all loads by time; one small row for each."""
    rows = spark.read.schema(LOADS).parquet(os.path.join(root, "_loads")).orderBy("load_ts", "load_id").collect()
    return [(r["load_id"], StructType.fromJson(json.loads(r["schema"]))) for r in rows]


def read_merged(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all loads under the merged schema, with ``load_id``."""
    loads = read_loads(spark, root)
    merged = merge_schemas([s for _, s in loads])
    by_schema: dict[str, tuple[StructType, list[str]]] = {}
    for load_id, schema in loads:
        by_schema.setdefault(schema.json(), (schema, []))[1].append(_path(root, load_id))
    scans = []
    for schema, paths in by_schema.values():
        there = set(schema.fieldNames())
        rows = (spark.read.option("basePath", os.path.join(root, "loads"))
                .schema(StructType([*schema.fields, StructField("load_id", StringType())])).parquet(*paths))
        scans.append(rows.select("load_id", *[
            (F.col(f"`{f.name}`") if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in merged.fields]))
    return reduce(DataFrame.unionByName, scans)


def schema_changes(spark: SparkSession, root: str) -> DataFrame:
    """``(load_id, column, load_type, merged_type, change, non_null)``: where a
    load's schema is not the merged one: ``missing`` columns, and ``widened``
    ones, which the load has in a narrower type; and those that it is the
    first, but not the first load, to have: ``added``. ``non_null`` counts the
    load's values of the column."""
    loads = read_loads(spark, root)
    merged = merge_schemas([s for _, s in loads])
    changes, known = [], set(loads[0][1].fieldNames())
    for load_id, schema in loads:
        own = {f.name: f.dataType for f in schema.fields}
        for f in merged.fields:
            kind = own.get(f.name)
            kinds = [k for k, holds in (("missing", kind is None), ("added", kind is not None and f.name not in known),
                                        ("widened", kind is not None and kind != f.dataType)) if holds]
            changes += [(load_id, f.name, kind.simpleString() if kind else None, f.dataType.simpleString(), k) for k in kinds]
        known |= set(own)
    listed = spark.createDataFrame(changes, "load_id string, `column` string, load_type string, merged_type string, change string")
    names = sorted({c[1] for c in changes})
    rows = read_merged(spark, root).groupBy("load_id").agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{n}`")).alias(n) for n in names])
    counts = rows.unpivot("load_id", [F.col(f"`{n}`") for n in names], "column", "non_null") if names else rows.select(
        "load_id", F.lit("").alias("column"), F.col("_rows").alias("non_null"))
    return (listed.join(counts, ["load_id", "column"], "left")
            .select("load_id", "column", "load_type", "merged_type", "change", F.coalesce("non_null", F.lit(0)).alias("non_null")))
