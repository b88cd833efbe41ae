"""Physical layout of written tables: partitioned sinks, multi-column
(z-order) clustering inside partitions, compaction and file statistics.

Parquet keeps min/max statistics per file and row group, so a table whose
files each cover a narrow range of the clustering columns lets a filter on
those columns skip most files. Clustering is a rewrite job:

* each clustering column is mapped to its ordinal among the column's
  distinct values (a distributed dense rank, see ``ordinal``);
* the ordinals are bit-interleaved into one z-value (``zorder_value``), so
  rows close in every column get close z-values;
* the rows are range-partitioned on ``(partition columns, z)`` — range
  bounds come from a sample, so a large partition value is split over
  several tasks instead of landing in one — and sorted within each task.

Rows that are a projection of a narrow table are dealt in their narrow form
and projected where they are written (``Late``): a shuffle then carries what
the projection needs, not all that it makes of it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.operators.interval_join import containing
from haulwise.session import cut_lineage

Z_BITS = 63
TABLE_CODEC = "zstd"


@dataclass(frozen=True)
class Late:
    """How narrow rows become a table's: ``widen`` is a projection, row by row,
    and ``columns`` gives those of its columns by which rows are dealt as
    expressions over the narrow ones."""

    widen: Callable[[DataFrame], DataFrame] = lambda rows: rows
    columns: Mapping[str, Column] = field(default_factory=dict)

    def column(self, name: str) -> Column:
        return self.columns[name] if name in self.columns else F.col(name)


AS_IS = Late()


def ordinals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """For every clustering column ``i`` and each of its distinct values:
    the value's 0-based rank (nulls first), scaled to ``Z_BITS // k`` bits
    when the column has more distinct values than that fits.

    One lazy plan, no driver round trip and no single-task sort:

    * the distinct ``(i, value)`` pairs of all columns come from one
      partially aggregated pass (each pair is a struct with the value in
      field ``c<i>``, so columns keep their own types and orderings);
    * the pairs are range-partitioned, numbered inside each range partition,
      and each partition's offset is the running count of the partitions
      before it for the same column — a table of one row per (column,
      range partition), bounded by the partition count and broadcast.
    """
    k = len(cols)
    bits = min(Z_BITS // k, 62)  # one column: keep 2**bits a positive bigint
    fields = [f"c{j}" for j in range(k)]
    structs = [
        F.struct(F.lit(i).alias("ci"),
                 *[(F.col(c) if j == i else F.lit(None).cast(df.schema[c].dataType)).alias(fields[j])
                   for j, c in enumerate(cols)])
        for i in range(k)
    ]
    pairs = df.select(F.explode(F.array(*structs)).alias("p")).select("p.*").distinct()
    order = [F.col("ci")] + [F.col(f).asc_nulls_first() for f in fields]
    ranged = pairs.repartitionByRange(*order).withColumn("pid", F.spark_partition_id())
    local = ranged.withColumn(
        "r", F.row_number().over(Window.partitionBy("ci", "pid").orderBy(*order[1:])) - 1)
    sizes = local.groupBy("ci", "pid").agg(F.count(F.lit(1)).alias("n"))
    offsets = (
        sizes.withColumn("off", F.coalesce(F.sum("n").over(
            Window.partitionBy("ci").orderBy("pid")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("total", F.sum("n").over(Window.partitionBy("ci")))
        .select("ci", "pid", "off", "total")
    )
    rank = F.col("r") + F.col("off")
    scaled = F.when(F.col("total") > F.lit(1 << bits),
                    (rank * F.lit(1 << bits) / F.col("total")).cast("bigint")
                    ).otherwise(rank.cast("bigint"))
    return (local.join(F.broadcast(offsets), ["ci", "pid"])
            .select("ci", *fields, scaled.alias("ord")))


# Bit-spreading masks for Morton codes ("insert one/two zero
# bits between every bit"), as (shift, mask) steps.
_SPREAD = {
    2: [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333), (1, 0x5555555555555555)],
    3: [(32, 0x001F00000000FFFF), (16, 0x001F0000FF0000FF), (8, 0x100F00F00F00F00F),
        (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)],
}


def _spread(c: Column, k: int) -> Column:
    x = c.cast("bigint").bitwiseAND(F.lit((1 << (Z_BITS // k)) - 1))
    for shift, mask in _SPREAD[k]:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def interleave(ords: Sequence[Column]) -> Column:
    """Bit-interleave non-negative ordinals (each already scaled to
    ``Z_BITS // len(ords)`` bits) into one bigint, most significant bits
    first, the first column leading at every bit level.

    Two or three columns use the classic shift-and-mask bit spreading (five
    steps per column); other widths interleave bit by bit."""
    k = len(ords)
    if k == 1:
        return ords[0].cast("bigint")
    if k in _SPREAD:
        z = F.lit(0).cast("bigint")
        for j, o in enumerate(ords):
            z = z.bitwiseOR(F.shiftleft(_spread(o, k), k - 1 - j))
        return z
    bits = Z_BITS // k
    z = F.lit(0).cast("bigint")
    pos = bits * k - 1
    for b in range(bits - 1, -1, -1):
        for j in range(k):
            bit = F.shiftright(ords[j], b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit.cast("bigint"), pos))
            pos -= 1
    return z


def zorder_value(df: DataFrame, cols: Sequence[str], out: str = "_z") -> DataFrame:
    """Add a z-order value over ``cols``. The distinct combinations of the
    columns are found first (one partially aggregated pass); ordinals and the
    z-value are computed per combination and written to the shared checkpoint
    folder, and one join on all the columns brings it back to the rows. The
    planner broadcasts that table when its measured size is small; otherwise
    the join shuffles on the whole combination, with skewed ones split."""
    cols = list(cols)
    combos = cut_lineage(df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)]).distinct(),
                         "zorder-combinations")
    ords = cut_lineage(ordinals(combos, combos.columns), "zorder-ordinals")
    z = combos
    for i in range(len(cols)):
        o = ords.where(F.col("ci") == i).select(F.col(f"c{i}").alias("_v"), F.col("ord").alias(f"_o{i}"))
        z = z.join(o, F.col(f"_k{i}").eqNullSafe(F.col("_v")), "left").drop("_v")
    z = z.select(*combos.columns, interleave([F.col(f"_o{i}") for i in range(len(cols))]).alias(out))
    z = cut_lineage(z, "zorder-values")
    on = F.lit(True)
    for i, c in enumerate(cols):
        on = on & df[c].eqNullSafe(z[f"_k{i}"])
    return df.join(z, on, "left").drop(*combos.columns)


def clustered(df: DataFrame, partition_cols: Sequence[str], zorder_cols: Sequence[str],
              num_files: int | None = None, late: Late = AS_IS) -> DataFrame:
    """Rows reordered for a clustered write: range-partitioned on
    (partition columns, z, row hash) and sorted within each task.

    The row hash is a tie-breaker: range partitioning never splits equal
    keys, so without it a route holding a third of a partition (one z
    value) would land in one task. With it, equal z values spread over
    adjacent ranges and every file still covers a contiguous z interval."""
    held = df.withColumns({f"_z_{c}": late.column(c) for c in zorder_cols})
    names = [f"_z_{c}" for c in zorder_cols]
    z = zorder_value(held, names).drop(*names).withColumn("_h", _row_hash(df))
    keys = [late.column(c) for c in partition_cols] + [F.col("_z"), F.col("_h")]
    ranged = (z.repartitionByRange(num_files, *keys) if num_files
              else z.repartitionByRange(*keys))
    return late.widen(ranged.sortWithinPartitions(*keys).drop("_z", "_h"))


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      zorder_cols: Sequence[str] = (), num_files: int | None = None,
                      max_records_per_file: int | None = None, in_place: bool = False,
                      late: Late = AS_IS) -> None:
    """Full rebuild of a partitioned table (schema replaced).

    Without clustering columns the rows are shuffled with a ``rebalance``
    hint on the partition columns: each task then writes (mostly) one
    partition value, so a partition gets few files, and AQE splits a
    partition value that is too large for one task (a region holding a
    third of the rows) and merges small ones — without the extra sampling
    pass over the input that range partitioning needs. With clustering
    columns, z-order clustering is applied (range partitioning on
    (partition columns, z), whose sample is worth it for a maintenance
    rewrite).

    ``in_place``: ``df`` reads ``path`` itself. Every partition it has rows
    for is replaced when all new files are there, in one write. ``late``:
    ``df`` is the table's rows in a narrow form."""
    if zorder_cols:
        out = clustered(df, partition_cols, zorder_cols, num_files, late)
    elif partition_cols and num_files:
        # range on (partition columns, row hash): a fixed file count, each
        # range inside one partition value or spanning adjacent ones, and a
        # partition value too big for one file split across several
        keys = [late.column(c) for c in partition_cols] + [_row_hash(df)]
        out = late.widen(df.repartitionByRange(num_files, *keys))
    elif partition_cols:
        out = late.widen(rebalanced(df, partition_cols, late))
    else:
        out = late.widen(df.repartition(num_files) if num_files else df)
    w = out.write.mode("overwrite").option("compression", TABLE_CODEC)
    if in_place:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.partitionBy(*partition_cols).parquet(path)


def rebalanced(df: DataFrame, cols: Sequence[str], late: Late) -> DataFrame:
    """The rebalance hint takes names only, so expressions travel as columns."""
    given = {f"_by_{c}": late.columns[c] for c in cols if c in late.columns}
    by = [f"_by_{c}" if c in late.columns else c for c in cols]
    return df.withColumns(given).hint("rebalance", *by).drop(*given) if given else df.hint("rebalance", *by)


# About how many rows of one partition a task takes, and up to how many
# partitions are read each on its own (each is a scan in the plan).
SLICE_ROWS, MOST_SLICES = 1_000_000, 500


class Landed:
    """``df`` stored at ``path`` by the partition columns, by the tasks that
    made it: a load that is read several times and then written to a table
    partitioned in that way. Its rows lie by partition in compressed columns, so
    that :meth:`deal` brings them together without a shuffle of whole rows."""

    def __init__(self, df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
        self.cols = list(partition_cols)
        df.write.option("compression", TABLE_CODEC).partitionBy(*self.cols).parquet(path)
        self.rows = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)

    def deal(self, df: DataFrame, cols: Sequence[str], late: Late) -> DataFrame:
        """``df``, a projection or filter of :attr:`rows`, as tasks of one
        partition each; by :func:`rebalanced` if there are very many."""
        sizes = self.rows.groupBy(*self.cols).count().limit(MOST_SLICES + 1).collect() if list(cols) == self.cols else []
        if not 0 < len(sizes) <= MOST_SLICES:
            return rebalanced(df, cols, late)
        # never coalesced to one: a union of single tasks is planned as a single task
        slices = [df.where(reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in self.cols]))
                  .coalesce(max(2, math.ceil(r["count"] / SLICE_ROWS))) for r in sizes]
        while len(slices) > 1:
            slices = [reduce(DataFrame.unionAll, slices[i:i + 2]) for i in range(0, len(slices), 2)]
        return slices[0]


def compact(df: DataFrame, path: str, partition_cols: Sequence[str],
            target_rows_per_file: int = 1_000_000, late: Late = AS_IS) -> None:
    """Rewrite into about ``rows / target`` files (one count, then a
    range partitioning on the partition columns plus a row hash, so a
    partition value holding most rows is still spread over many files)."""
    n = df.count()
    files = max(1, math.ceil(n / target_rows_per_file))
    write_partitioned(df, path, partition_cols, num_files=files, late=late)


def file_count(spark, path: str) -> int:
    """Data files under ``path``, from the scan's own file list (no job)."""
    return len(spark.read.parquet(path).inputFiles())


def file_stats(spark, path: str, cols: Sequence[str] = ()) -> DataFrame:
    """Rows per data file and the min/max of ``cols`` inside each file —
    how well a layout supports file skipping (a DataFrame job, no listing
    on the driver)."""
    df = spark.read.parquet(path).withColumn("_file", F.input_file_name())
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy("_file").agg(*aggs)


def files_touched(wanted: DataFrame, stats: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """``(cols, files)``: for every row of ``wanted``, an equality predicate on
    ``cols``, the files of ``stats`` (see :func:`file_stats`) that it cannot
    skip: all ranges hold its values. The ranges of ``by`` are joined as
    intervals, over the ranks of the values that occur; the others are compared
    for the pairs that this leaves. Null predicates and empty ranges match
    nothing."""
    values = (wanted.select(F.col(by).alias("v")).unionByName(stats.select(F.col(f"{by}_min").alias("v")))
              .unionByName(stats.select(F.col(f"{by}_max").alias("v"))).where("v is not null").distinct())
    ranks = cut_lineage(ordinals(values, ["v"]).select(F.col("c0").alias("v"), F.col("ord")), "file-ranks")
    rank = lambda c, out: ranks.select(F.col("v").alias(c), F.col("ord").alias(out))
    points = wanted.select(*cols).join(rank(by, "_point"), by)
    spans = stats.join(rank(f"{by}_min", "_low"), f"{by}_min").join(rank(f"{by}_max", "_high"), f"{by}_max")
    met = containing(points, "_point", spans, "_low", "_high")
    for c in cols:
        if c != by:
            met = met.where(F.col(c).between(F.col(f"{c}_min"), F.col(f"{c}_max")))
    return met.groupBy(*cols).agg(F.count(F.lit(1)).alias("files"))
