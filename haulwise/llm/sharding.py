"""Minimax contiguous partition of atomic groups into shards.

Rows of equal key form a group that is never split. The groups stand in one
order, and a shard is a run of them. The smallest capacity for which a greedy
left-to-right packing needs no more than the given number of shards is found
by binary search; the cuts are then made under that capacity, each as near as
the rest allows to an even share of what remains.

The driver never holds all groups. It knows some group ends (a bounded number)
and whether others lie between two of them. A search that asks about a place
where others lie notes the gap, a Spark job reads such gaps in finer steps,
and the search runs again until it has met known ends only. The result is that
of a search over all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import running
from haulwise.session import cut_lineage


class _Ends:
    """Ends of the groups as far as they are known."""

    def __init__(self, groups: DataFrame, total: int, most: int) -> None:
        self.groups, self.most = groups, most
        self.at = np.array([0, total], np.int64)
        self.whole = np.array([False])  # no unknown end in the gap before at[k + 1]
        self.asked: set[int] = {0}

    def floor(self, x: int) -> int:
        """The largest end up to x, or a smaller one with the gap noted."""
        k = int(np.searchsorted(self.at, x, "right")) - 1
        if k < len(self.whole) and self.at[k] != x and not self.whole[k]:
            self.asked.add(k)
        return int(self.at[k])

    def ceil(self, x: int) -> int:
        """The smallest end from x on, or a larger one with the gap noted."""
        k = int(np.searchsorted(self.at, x, "left"))
        if self.at[k] != x and not self.whole[k - 1]:
            self.asked.add(k - 1)
        return int(self.at[k])

    def read(self) -> None:
        """Reads the gaps noted, each in as many steps as the bound allows."""
        gaps = np.array(sorted(self.asked))
        low, high = self.at[gaps], self.at[gaps + 1]
        step = np.maximum(1, -(-(high - low) // max(2, self.most // len(gaps))))

        def cells(batches):
            for batch in batches:
                end = batch.column(0).to_numpy(zero_copy_only=False)
                k = np.searchsorted(low, end, "left") - 1
                inside = (k >= 0) & (end <= high[np.maximum(k, 0)])
                k, end = k[inside], end[inside]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k), pa.array((end - low[k] - 1) // step[k]), pa.array(end)], names=["gap", "cell", "end"])

        rows = (self.groups.select("end").mapInArrow(cells, "gap long, cell long, end long")
                .groupBy("gap", "cell")
                .agg(F.min("end").alias("least"), F.max("end").alias("most"), F.count("*").alias("n")).toPandas())
        known = dict(zip(self.at[1:].tolist(), self.whole.tolist(), strict=True))
        known |= dict(zip(rows.most.tolist(), (rows.n <= 2).tolist(), strict=True))
        known |= dict.fromkeys(rows.least.tolist(), True)
        ends = sorted(known)
        self.at = np.array([0, *ends], np.int64)
        self.whole = np.array([known[e] for e in ends])
        self.asked = set()


def _packs(ends: _Ends, total: int, shards: int, capacity: int) -> bool:
    place = 0
    for _ in range(shards):
        place = ends.floor(place + capacity)
        if place >= total:
            return True
    return False


def _cut(ends: _Ends, total: int, shards: int, largest: int) -> tuple[int, list[int]]:
    """(capacity, ends of the shards)."""
    even = -(-total // shards)
    low, high = max(largest, even), max(largest, even + largest)
    while low < high:
        mid = (low + high) // 2
        if _packs(ends, total, shards, mid):
            high = mid
        else:
            low = mid + 1
    need = [total]  # from where on the shards after a cut can hold the rest
    for _ in range(shards - 1):
        need.append(ends.ceil(max(0, need[-1] - low)))
    need.reverse()
    cuts, place = [], 0
    for j in range(shards):
        share = place + -(-(total - place) // (shards - j))
        cut = ends.floor(min(place + low, max(share, need[j]), total))
        if cut == place < total:
            cut = ends.ceil(place + 1)
        cuts.append(cut)
        place = cut
    return low, cuts


def shard_groups(groups: DataFrame, shards: int, *, most_known: int = 65_536) -> tuple[int, list[int]]:
    """(capacity, ends) for ``groups`` (end, size): ``end`` is the running sum
    of ``size`` (1 or more) in the groups' order; the ends are positions in
    that sum, one for each shard. No group at all: capacity 0."""
    total, largest = groups.agg(F.max("end"), F.max("size")).first()
    if not total:
        return 0, [0] * shards
    ends = _Ends(groups, total, most_known)
    while ends.asked:
        ends.read()
        capacity, cuts = _cut(ends, total, shards, largest)
    return capacity, cuts


def shard_documents(docs: DataFrame, *, shards: int = 40, overhead: int = 16, key: Column | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``, one row per row of ``docs``
    (doc_id, text; further columns are ignored).

    ``size`` is the text's UTF-8 bytes (none for null) plus ``overhead``,
    ``text_crc32`` the unsigned CRC-32 of those bytes (null for null). Rows of
    equal text share a shard, null texts being equal to each other; groups
    stand in the order of their least doc_id, and shards are runs of groups
    with the least possible largest size. Shards stay empty only if there are
    fewer groups than shards or some are so large that the rest fits in fewer.
    ``slot`` numbers a shard's rows from 0 without gaps, by group and doc_id.
    """
    text = F.col("text")
    rows = cut_lineage(docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(key if key is not None else F.sha2(text, 256), F.lit("")).alias("group")), "shard-rows")
    groups = rows.groupBy("group").agg(F.min("doc_id").alias("first"), F.sum("size").alias("size"))
    groups = cut_lineage(running(groups, ["first", "group"], F.col("size"), "end", "shard-groups"), "shard-ends")
    _, cuts = shard_groups(groups, shards)
    start = F.col("end") - F.col("size")
    placed = groups.select("group", "first", F.size(F.filter(
        F.array(*(F.lit(int(c)) for c in cuts)), lambda c: c <= start)).cast("int").alias("shard"))
    dealt = running(rows.join(placed, "group"), ["first", "group", "doc_id"], F.lit(1), "place", "shard-slots")
    counts = dict(dealt.groupBy("shard").count().collect())
    before = np.concatenate([[0], np.cumsum([counts.get(k, 0) for k in range(shards)])]).tolist()
    offset = F.element_at(F.array(*(F.lit(int(b)) for b in before)), F.col("shard") + 1)
    return dealt.select("doc_id", "size", "text_crc32", "shard", (F.col("place") - 1 - offset).cast("long").alias("slot"))
