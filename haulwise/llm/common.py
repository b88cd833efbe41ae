"""Helpers of the operators: text slices for numpy, word bounds, rolling
hashes, and ranks or running sums in one global order."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.session import cut_lineage

# Texts are handled in slices of about this many bytes, whatever the size of
# an Arrow batch; a longer text is one slice of its own.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_hash_class(key: str, modulus: int, remainder: int) -> Column:
    """True where crc32(key as text) mod ``modulus`` is ``remainder``; false
    for a null key."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of texts; a null text
    is empty. ``offsets`` has one entry more than there are rows."""
    col = column.cast(pa.large_string()).fill_null("")
    if not len(col):
        return
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(at, at[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(col))
        yield lo, hi, data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (run of bytes outside x20, x09-x0D)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    joined = np.zeros(n + 1, bool)  # bytes i-1 and i are of one word
    joined[1:n] = word[1:] & word[:-1]
    joined &= ~edge
    starts = np.flatnonzero(word & ~joined[:n])
    ends = np.flatnonzero(word & ~joined[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n)


class RollingHash:
    """64-bit polynomial hashes of byte segments, from one running sum."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self._up = self._down = np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._up) < n + 1:
            n = max(n + 1, SLICE_BYTES + 1)
            with np.errstate(over="ignore"):
                for name, base in (("_up", self.BASE), ("_down", pow(self.BASE, -1, 1 << 64))):
                    p = np.full(n, base, np.uint64)
                    p[0] = 1
                    setattr(self, name, np.cumprod(p))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        self._powers(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=total[1:])
        return mix((total[ends] - total[starts]) * self._down[starts])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def read_ranks(blob: bytes) -> dict[bytes, int]:
    """Token bytes to ids, from the content of a tiktoken rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in blob.splitlines() if line)}


def token_encoding(blob: bytes, pattern: str):
    """The tiktoken encoding of a rank file, built once a Python worker."""
    import tiktoken
    from tiktoken import registry

    name = f"{zlib.crc32(blob)}-{zlib.crc32(pattern.encode())}"
    if name not in registry.ENCODINGS:
        registry.ENCODINGS[name] = tiktoken.Encoding(
            name, pat_str=pattern, mergeable_ranks=read_ranks(blob), special_tokens={})
    return registry.ENCODINGS[name]


def whole_groups(batches, keys: int = 1) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by their first ``keys`` columns (not null): tables
    that end where a group does, and the edges of the groups in each. A task
    holds a batch and one group at a time."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        new = np.ones(table.num_rows, bool)
        if table.num_rows:
            new[1:] = np.any([pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
                              for c in (table.column(k).combine_chunks() for k in range(keys))], axis=0)
        return np.concatenate([np.flatnonzero(new), [table.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        last = held[-1] if held else None
        if last is not None and all(last.column(k)[-1] == batch.column(k)[-1] for k in range(keys)):
            held.append(batch)  # one group as yet
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        edges = cut(table)
        if len(edges) > 2:
            yield table.slice(0, int(edges[-2])), edges[:-1]
        held = table.slice(int(edges[-2])).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, cut(table)


def join_unique(rows: DataFrame, table: DataFrame, key: str, count: str, *, most: int = 1024) -> DataFrame:
    """``rows`` joined with the one row of ``table`` for their ``key`` (never
    null), without its column ``count``, which says how many rows have the key.

    A key with more than a ``most``-th part of all rows is dealt out, by row
    number, to as many parts as it takes, and its row of ``table`` goes to each.
    There are fewer than ``most`` such keys; what each takes is broadcast. Both
    sides are read stored."""
    total = table.agg(F.sum(count)).first()[0] or 0
    each = max(1, total // most)
    parts = F.ceil(F.col(count) / each).cast("int")
    frequent = table.where(F.col(count) > each).select(key, parts.alias("_parts"))
    dealt = rows.join(F.broadcast(frequent), key, "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")), F.lit(0)).cast("int")).drop("_parts")
    copies = table.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop(count)
    return dealt.join(copies, [key, "_part"]).drop("_part")


def running(df: DataFrame, order: list[str], value: Column, out: str, name: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` up to and with each row in the order
    of ``order``. The rows are dealt by range, summed in each range, and the
    driver sees one total a range."""
    spark = df.sparkSession
    width = shuffle_width(df)
    dealt = cut_lineage(
        df.repartitionByRange(width, *order).withColumn("_range", F.spark_partition_id()), name)
    totals = sorted((r[0], int(r[1])) for r in
                    dealt.groupBy("_range").agg(F.sum(value)).collect())
    before, rows = 0, []
    for part, total in totals:
        rows.append((part, before))
        before += total
    # one row a range: bounded by the number of shuffle partitions
    offsets = F.broadcast(spark.createDataFrame(rows, "_range int, _before long"))
    upto = (Window.partitionBy("_range").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (dealt.withColumn(out, F.sum(value).over(upto))
            .join(offsets, "_range").withColumn(out, F.col(out) + F.col("_before"))
            .drop("_range", "_before"))
