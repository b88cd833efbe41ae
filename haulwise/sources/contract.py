"""The source contract: a declared 39-column schema, an enforced CSV scan,
ingestion metadata and a live-vs-expected schema check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)

# The route-day source contract (name, type), in file order.
# Every column is required except incident_type.
SOURCE_FIELDS = [
    ("route_date_key", "string"),
    ("date", "date"),
    ("year", "int"),
    ("month", "int"),
    ("quarter", "string"),
    ("day_of_week", "string"),
    ("region", "string"),
    ("bu", "string"),
    ("area", "string"),
    ("route_id", "string"),
    ("primary_waste_stream", "string"),
    ("primary_customer_segment", "string"),
    ("num_drivers", "int"),
    ("num_trucks", "int"),
    ("total_stops", "int"),
    ("completed_stops", "int"),
    ("missed_stops", "int"),
    ("total_distance_km", "double"),
    ("total_fuel_used_litres", "double"),
    ("total_labour_hours", "double"),
    ("total_yards", "double"),
    ("total_tonnes", "double"),
    ("avg_revenue_per_stop", "double"),
    ("total_revenue", "double"),
    ("disposal_cost", "double"),
    ("fuel_cost", "double"),
    ("labour_cost", "double"),
    ("maintenance_cost", "double"),
    ("admin_cost", "double"),
    ("total_cost", "double"),
    ("net_revenue", "double"),
    ("gross_profit", "double"),
    ("gross_margin_pct", "double"),
    ("scheduled_hours", "double"),
    ("actual_hours", "double"),
    ("delay_minutes", "int"),
    ("on_time_flag", "int"),
    ("incident_flag", "int"),
    ("incident_type", "string"),
]
NULLABLE_SOURCE_COLUMNS = {"incident_type"}
# The literal that means "no incident" in the raw feed.
NO_INCIDENT_SENTINEL = "None"
# Columns a restatement may not change (natural key, calendar,
# geography).
IMMUTABLE_COLUMNS = (
    "route_date_key", "date", "year", "month", "quarter", "day_of_week",
    "region", "bu", "area", "route_id",
)
KEY = "route_date_key"

_TYPES = {
    "string": StringType(), "date": DateType(), "int": IntegerType(),
    "double": DoubleType(), "bigint": LongType(), "boolean": BooleanType(),
    "timestamp": TimestampType(),
}

SOURCE_SCHEMA = StructType([
    StructField(n, _TYPES[t], n in NULLABLE_SOURCE_COLUMNS)
    for n, t in SOURCE_FIELDS
])
SOURCE_COLUMNS = [n for n, _ in SOURCE_FIELDS]
REQUIRED_COLUMNS = [n for n in SOURCE_COLUMNS if n not in NULLABLE_SOURCE_COLUMNS]

BRONZE_SCHEMA = StructType(
    SOURCE_SCHEMA.fields
    + [StructField("ingestion_ts", TimestampType(), True),
       StructField("source_file", StringType(), True)]
)
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """Enforced-schema CSV scan, plus ``source_file`` (base name of the file
    each row came from, so a multi-file load keeps per-row provenance).

    ``FAILFAST`` makes a bad number, bad date, extra or missing column
    raise on the first action. ``enforceSchema=false`` makes Spark check the
    header against the declared names too, so a renamed column raises
    instead of being silently accepted. An empty field still loads as null;
    the null-count quality check is the guard for that.
    """
    df = (
        spark.read
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("dateFormat", "yyyy-MM-dd")
        .schema(SOURCE_SCHEMA)
        .csv(path)
    )
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def with_ingestion_metadata(df: DataFrame, ingestion_ts=None,
                            source_file: str | None = None) -> DataFrame:
    """Add ``ingestion_ts`` (load time by default; tests pass a fixed value)
    and, when the frame has none yet, ``source_file`` (the given name or
    null), in Bronze column order."""
    ts = (F.current_timestamp() if ingestion_ts is None
          else F.lit(ingestion_ts).cast("timestamp"))
    if "source_file" not in df.columns:
        df = df.withColumn("source_file", F.lit(source_file).cast("string"))
    return df.withColumn("ingestion_ts", ts).select(*BRONZE_COLUMNS)


def struct_of(fields) -> StructType:
    """A StructType from ``(name, type)`` pairs (all nullable)."""
    return StructType([StructField(n, _TYPES[t], True) for n, t in fields])


def schema_check(df: DataFrame, expected: StructType) -> DataFrame:
    """Live vs expected columns as rows ``(position, column, expected_type,
    actual_type, status, non_null)`` with status ``ok``/``missing``/
    ``unexpected``/``type_mismatch`` and the number of values the table has in
    the column (null for a missing one). The counts are one aggregate over the
    table, unpivoted with ``stack``."""
    live = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = [*want, *(n for n in df.columns if n not in want)]
    quoted = lambda v: "CAST(NULL AS STRING)" if v is None else f"'{v}'"
    rows = []
    for pos, name in enumerate(names):
        w, got = want.get(name), live.get(name)
        status = ("unexpected" if w is None else "missing" if got is None
                  else "ok" if got == w else "type_mismatch")
        n = f"_n{pos}" if got else "CAST(NULL AS BIGINT)"
        rows.append(f"{pos}, '{name}', {quoted(w)}, {quoted(got)}, '{status}', {n}")
    counts = df.agg(*[F.count(F.col(f"`{n}`")).alias(f"_n{k}") for k, n in enumerate(names) if n in live])
    return counts.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS "
                             "(position, column, expected_type, actual_type, status, non_null)")
