"""Exact top-k inner-product search over a bit-sliced index.

Attributes are kept as bitmaps, one for each binary digit of the quantised
value and a bit for each row of a block. A query's scores are then sums of
shifted slices, added with bitmap adders; the k best rows are chosen from the
most significant slice of the sum downward. Quantising leaves a bounded error,
so every row whose sum is within that bound of the k-th best is a boundary
row, and those alone are scored exactly.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.session import cut_lineage

# Bitmaps are Python integers: bit i belongs to row i of the block.


def add_columns(columns: dict[int, list[int]]) -> list[int]:
    """Slices, least significant first, of the sum of weighted bitmaps:
    ``columns[p]`` are the bitmaps of weight 2**p."""
    out, p = [], 0
    columns = {k: list(v) for k, v in columns.items()}
    while columns:
        own = columns.pop(p, [])
        while len(own) > 2:
            a, b, c = own.pop(), own.pop(), own.pop()
            half = a ^ b
            own.insert(0, half ^ c)
            columns.setdefault(p + 1, []).append((a & b) | (half & c))
        if len(own) == 2:
            a, b = own
            columns.setdefault(p + 1, []).append(a & b)
            own = [a ^ b]
        out.append(own[0] if own else 0)
        p += 1
    return out


def kth_largest(slices: list[int], rows: int, k: int) -> int:
    """The k-th largest value (the least one, if there are fewer rows), found
    from the most significant slice downward; ``rows`` is the bitmap of rows."""
    value, live, above = 0, rows, 0
    for p in range(len(slices) - 1, -1, -1):
        ones = live & slices[p]
        n = ones.bit_count()
        if above + n >= k:
            value |= 1 << p
            live = ones
        else:
            above += n
            live &= ~slices[p]
    return value if above + live.bit_count() >= k else 0


def at_least(slices: list[int], rows: int, value: int) -> int:
    """Bitmap of the rows whose value is ``value`` or more."""
    if value <= 0:
        return rows
    if value >> len(slices):
        return 0
    more, equal = 0, rows
    for p in range(len(slices) - 1, -1, -1):
        if value >> p & 1:
            equal &= slices[p]
        else:
            more |= equal & slices[p]
            equal &= ~slices[p]
    return more | equal


class SlicedBlock:
    """Bit slices of a block's attributes, ``width`` digits each; finer digits
    count as error."""

    def __init__(self, values: np.ndarray, width: int = 6) -> None:
        self.values = values
        self.n, self.dims = values.shape
        low = values.min(axis=0)
        span = int((values - low).max())
        self.cut = max(0, span.bit_length() - width)
        self.width = min(width, max(1, span.bit_length()))
        coarse = (values - low) >> self.cut
        self.rows = (1 << self.n) - 1
        self.slices = []  # by attribute and digit: (ones, zeros)
        for d in range(self.dims):
            own = []
            for b in range(self.width):
                bits = np.packbits((coarse[:, d] >> b & 1).astype(np.uint8), bitorder="little")
                ones = int.from_bytes(bits.tobytes(), "little")
                own.append((ones, self.rows & ~ones))
            self.slices.append(own)

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the k best, with all that tie with them."""
        columns: dict[int, list[int]] = {}
        for d, q in enumerate(query.tolist()):
            m, sign = abs(q), int(q < 0)
            p = 0
            while m:
                if m & 1:
                    for b, both in enumerate(self.slices[d]):
                        columns.setdefault(p + b, []).append(both[sign])
                m >>= 1
                p += 1
        total = add_columns(columns)
        # an exact score is a constant plus 2**cut times the sum plus an error
        # of this range at most
        error = ((1 << self.cut) - 1) * int(np.abs(query).sum())
        best = kth_largest(total, self.rows, k)
        found = at_least(total, self.rows, best - -(-error >> self.cut))
        bits = np.frombuffer(found.to_bytes(-(-self.n // 8), "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(bits, count=self.n, bitorder="little"))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of different length are filled up with zeros."""
    rows = [x.values.to_numpy(zero_copy_only=False) for x in column]
    out = np.zeros((len(rows), dims), np.int64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


LONG = 2 ** 63 - 1
WIDE = Decimal(10) ** 38 - 1


def _search(k: int):
    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        got: list[list] = [[], [], [], [], [], []]
        if index.num_rows and queries.num_rows:
            dims = max(len(x) for t in (index, queries) for x in t.column("v"))
            values = _matrix(index.column("v"), dims)
            block = SlicedBlock(values) if dims else None
            exact = values.astype(object) if np.abs(values).max(initial=0) >= 1 << 20 else values
            ids, rows = index.column("vec_id").to_numpy(), index.column("row").to_numpy()
            asked = zip(*(queries.column(c).to_pylist() for c in ("vec_id", "row")), _matrix(queries.column("v"), dims), strict=True)
            for q, row, vector in asked:
                at = block.candidates(vector, k + int((rows == row).sum())) if dims else np.arange(len(ids))
                at = at[rows[at] != row]
                score = (exact[at] @ (vector if exact is values else vector.astype(object))).tolist() if dims else [0] * len(at)
                best = sorted(zip([-s for s in score], ids[at].tolist(), rows[at].tolist(), strict=True))[:k]
                for out, value in zip(got, zip(*((q, row, i, j, max(-LONG - 1, min(LONG, -s)), max(-WIDE, min(WIDE, Decimal(-s))))
                                                 for s, i, j in best), strict=True), strict=False):
                    out += value
        kinds = [pa.int64()] * 5 + [pa.decimal128(38, 0)]
        return pa.table([pa.array(x, t) for x, t in zip(got, kinds, strict=True)],
                        names=["query_id", "query_row", "vec_id", "row", "score", "wide"])

    return search


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Not null, and all components are there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, scale: int = 256, block_rows: int = 4096,
          query_rows: int = 8192) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``vectors``
    (vec_id, embedding) where ``is_query`` holds, the k other rows of highest
    inner product of floor(scale * component); ties go to the smaller vec_id,
    fewer rows come back where there are fewer.

    Rows with a null vec_id and vectors that are null, or hold a null or
    non-finite component, take no part. Vectors of different length are filled
    up with zeros; an empty one scores 0 with all. Rows that repeat are rows of
    their own: each is an answer, and each asks for itself. A score that no
    long can hold is given as the nearest long, its rank by the score itself
    (up to 38 digits); so is floor(scale * component).
    Blocks of about ``block_rows`` rows meet blocks of about ``query_rows``
    queries, so no task holds more than that of either.
    """
    rows = cut_lineage(vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        "vec_id", quantised(F.col("embedding"), scale).alias("v"), F.monotonically_increasing_id().alias("row")), "topk-rows")
    asked = rows.where(is_query)
    counts = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, query_blocks = -(-counts.n // block_rows) or 1, -(-counts.q // query_rows) or 1
    of = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select(of(blocks, 1).alias("block"), every(query_blocks).alias("part"), "vec_id", "row", "v")
    right = asked.select(of(query_blocks, 2).alias("part"), every(blocks).alias("block"), "vec_id", "row", "v")
    near = (left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
            .applyInArrow(_search(k), "query_id long, query_row long, vec_id long, row long, score long, wide decimal(38,0)"))
    order = Window.partitionBy("query_row").orderBy(F.desc("wide"), "vec_id", "row")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
