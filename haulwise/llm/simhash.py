"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is cut into segments, and the bit counts of the segments are a
point in a small lattice. Changing one bit moves the point by one step, so the
Manhattan distance of two points is a lower bound of the Hamming distance.

The segments are dealt to ``max_bits // 2 + 1`` bands. Two fingerprints within
``max_bits`` differ by one bit at most in some band, so in that band their
points share a cell of the unit grid or lie in neighbouring cells. The range
join sends every point to its own cell and, if the band's bit count is even,
to the neighbouring ones as well: points one step apart have counts of
different parity, so each such pair meets once. Pairs that meet are held
against the Manhattan bound over all segments and then verified exactly.

A crowded cell is not paired off. Its points go to the finest grid, with one
bit a segment, where the Manhattan distance is the Hamming distance: each
point visits the cells within half of ``max_bits``, points that meet there are
within ``max_bits`` of each other, and a link to the least of them joins all.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import join_unique, mix, text_slices, word_bounds
from haulwise.session import cut_lineage

BITS = 64
# Narrow rows that one task writes, or contracts, at a time at least.
TASK_ROWS = 1 << 15


# A-Z in lower case, white space as x20
_PLAIN = np.array([c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256)], np.uint8)


def single_spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with one space between words, and their offsets."""
    b = _PLAIN[data]
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
    keep[offsets[:-1][np.diff(offsets) > 0]] = True
    return b[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def _shingles(data: np.ndarray, offsets: np.ndarray, width: int):
    """Start, end and row of every shingle, by row."""
    starts, ends, row = word_bounds(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    full = np.flatnonzero(np.arange(len(row)) + width <= (first + n)[row])
    short = np.flatnonzero((n > 0) & (n < width))
    rows = np.concatenate([row[full], short])
    order = np.argsort(rows, kind="stable")
    return (np.concatenate([starts[full], starts[first[short]]])[order],
            np.concatenate([ends[full + width - 1], ends[first[short] + n[short] - 1]])[order], rows[order])


def majority(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Of each of n rows, the value whose bits are set in over half of the
    row's hashes; ``rows`` is sorted. Eight bits are counted in the bytes of
    one word, in runs short enough not to overflow."""
    counts = np.bincount(rows, minlength=n)
    out = np.zeros(n, np.uint64)
    if not len(hashes):
        return out
    within = np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]
    runs = np.flatnonzero(within % 255 == 0)
    owner = np.flatnonzero(np.diff(rows[runs], prepend=-1))
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(0x0101010101010101), runs)
        ones = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), owner, axis=0)
        have = rows[runs[owner]]
        over = (2 * ones > counts[have][:, None]).astype(np.uint64)
        out[have] |= (over << (8 * np.arange(8, dtype=np.uint64) + np.uint64(k))).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, *, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp)``: the signed 64-bit SimHash of every whole text. A null
    or empty text, or one of white space, has fingerprint 0; a text of fewer
    words than a shingle is one shingle."""

    def hashed(batches):
        from xxhash import xxh64_digest

        for batch in batches:
            fps = []
            for _, _, data, offsets in text_slices(batch.column(1)):
                data, offsets = single_spaced(data, offsets)
                starts, ends, rows = _shingles(data, offsets, shingle)
                line = data.tobytes()
                digests = b"".join([xxh64_digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
                fps.append(majority(np.frombuffer(digests, ">u8").astype(np.uint64), rows, len(offsets) - 1))
            fps = np.concatenate([np.zeros(0, np.uint64), *fps])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(hashed, "doc_id long, fp long")


def segment_counts(fps: np.ndarray, segment_bits: int) -> np.ndarray:
    """The embedding: bit counts of the segments, an array (values, segments)."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    edges = np.arange(0, BITS, segment_bits)
    return np.add.reduceat(bits.astype(np.int8), edges, axis=1)


def _bands(segments: int, max_bits: int) -> list[tuple[int, int]]:
    n = max_bits // 2 + 1
    edges = np.linspace(0, segments, n + 1).astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))


def _cells(max_bits: int, segment_bits: int):
    """The rows of the range join: (cell, fp, guest). A cell is the hash of a
    band and its lattice point, a guest a point from a neighbouring cell."""

    def cells(batches):
        for batch in batches:
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            counts = segment_counts(signed.view(np.uint64), segment_bits).astype(np.int64)
            sizes = np.minimum(segment_bits, BITS - np.arange(0, BITS, segment_bits))
            for k, (lo, hi) in enumerate(_bands(counts.shape[1], max_bits)):
                point, room = counts[:, lo:hi], sizes[lo:hi]
                weights = mix(np.arange(1, hi - lo + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                              + np.uint64(k << 32))
                own = (point.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
                out = [(own, signed, np.zeros(len(own), bool))]
                even = point.sum(axis=1) % 2 == 0
                for j in range(hi - lo) if max_bits else ():
                    for step in (-1, 1):
                        go = even & (point[:, j] + step >= 0) & (point[:, j] + step <= room[j])
                        move = weights[j] if step > 0 else ~weights[j] + np.uint64(1)
                        out.append((own[go] + move, signed[go], np.ones(int(go.sum()), bool)))
                cell, fp, guest = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(cell).view(np.int64)), pa.array(fp), pa.array(guest)], names=["cell", "fp", "guest"])

    return cells


def _meet(max_bits: int, segment_bits: int, crowd: int):
    """Over rows sorted by cell: (a, b) for every verified link, and (fp, null)
    for the points of cells with more than ``crowd``."""

    def links(own: np.ndarray, guest: np.ndarray):
        a, b = own.view(np.uint64), np.concatenate([own, guest]).view(np.uint64)
        i, j = np.nonzero(np.triu(np.ones((len(a), len(b)), bool), 1))
        la, lb = segment_counts(a, segment_bits), segment_counts(b, segment_bits)
        close = np.abs(la[i].astype(np.int16) - lb[j]).sum(axis=1) <= max_bits
        i, j = i[close], j[close]
        true = np.bitwise_count(a[i] ^ b[j]) <= max_bits
        return a[i[true]].view(np.int64), b[j[true]].view(np.int64)

    def finish(fps: list[np.ndarray], guests: list[np.ndarray]):
        fp, guest = np.concatenate(fps), np.concatenate(guests)
        if len(fp) < 2 or guest.all():
            return None
        return links(fp[~guest], fp[guest])

    def meet(batches):
        cell, fps, guests, held, crowded = None, [], [], 0, False
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False)
            guest = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)
            out_a, out_b = [], []
            cuts = np.flatnonzero(np.diff(cells)) + 1
            edges = np.concatenate([[0], cuts, [len(cells)]])
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                if cells[lo] != cell:
                    if held > 1 and not crowded and (found := finish(fps, guests)):
                        out_a.append(found[0])
                        out_b.append(found[1])
                    cell, fps, guests, held, crowded = cells[lo], [], [], 0, False
                fps.append(fp[lo:hi])
                guests.append(guest[lo:hi])
                held += hi - lo
                if held > crowd or crowded:
                    crowded = True
                    out_a += fps
                    out_b += [None] * len(fps)
                    fps, guests = [], []
            yield _edges(out_a, out_b)
        if held > 1 and not crowded and (found := finish(fps, guests)):
            yield _edges([found[0]], [found[1]])

    return meet


def _edges(a: list[np.ndarray], b: list) -> pa.RecordBatch:
    left = np.concatenate([np.zeros(0, np.int64), *a])
    right = np.concatenate([np.zeros(0, np.int64), *(np.zeros(len(x), np.int64) if y is None else y
                                                     for x, y in zip(a, b, strict=True))])
    none = np.concatenate([np.zeros(0, bool), *(np.full(len(x), y is None) for x, y in zip(a, b, strict=True))])
    return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right, mask=none)], names=["a", "b"])


def _finest(reach: int):
    """(cell, fp): the cells of the one-bit grid within ``reach`` steps."""

    def visit(batches):
        flips = [np.uint64(sum(1 << b for b in c)) for r in range(reach + 1) for c in combinations(range(BITS), r)]
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for part in np.array_split(np.array(flips, np.uint64), max(1, len(flips) // 256)):
                cell = (fp.view(np.uint64)[:, None] ^ part[None, :]).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.repeat(fp, len(part)))], names=["cell", "fp"])

    return visit


def link_fingerprints(fps: DataFrame, *, max_bits: int = 2, segment_bits: int = 2, crowd: int = 64) -> DataFrame:
    """``(a, b)``: links between distinct values of ``fps`` (fp) that join just
    those within ``max_bits`` bits, directly or by way of others within
    ``max_bits`` of both. ``max_bits`` is even: two points within it then meet
    halfway in the finest grid, and all that meet there are within it."""
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even")
    spread = fps.select("fp").mapInArrow(_cells(max_bits, segment_bits), "cell long, fp long, guest boolean")
    met = cut_lineage(
        spread.repartition("cell").sortWithinPartitions("cell")
        .mapInArrow(_meet(max_bits, segment_bits, crowd), "a long, b long"), "simhash-met")
    links = met.where("b is not null")
    dense = met.where("b is null").select(F.col("a").alias("fp")).distinct()
    if dense.isEmpty():
        return links
    visits = dense.mapInArrow(_finest(max_bits // 2), "cell long, fp long")
    least = visits.groupBy("cell").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    stars = (visits.join(least, "cell").where("fp <> least")
             .select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct())
    return links.unionByName(stars)


def _files(rows: int, spark) -> int:
    """Files for so many rows, no more than there are shuffle partitions."""
    return max(1, min(-(-rows // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _few_files(stored: DataFrame) -> DataFrame:
    """A stored table of narrow rows, read by as many tasks as its rows take."""
    return stored.coalesce(_files(stored.count(), stored.sparkSession))


def _state(edges: DataFrame):
    """Equal for equal sets of edges."""
    h = F.xxhash64("a", "b")
    return edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links a node to the least one it reaches over the given ones."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[own], nodes[root[own]]


def _contracted(batches):
    """(a, b): links that join what those given do, fewer than their nodes;
    a task holds ``TASK_ROWS`` links and a batch at a time."""

    def stars():
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _stars(a, b)], names=["a", "b"])

    held, n = [], 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        n += batch.num_rows
        if n >= TASK_ROWS:
            yield stars()
            held, n = [], 0
    if n:
        yield stars()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the least node that every node of ``edges`` (a, b)
    reaches. The links that a task reads are contracted there to stars, which
    are joined in rounds of linking every node to the least neighbour, first
    among larger, then among smaller ones, until nothing changes; every round
    is written, so lost executors cost one round."""
    edges = cut_lineage(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    edges = cut_lineage(_few_files(edges).mapInArrow(_contracted, "a long, b long"), "edges")
    spark, state = edges.sparkSession, _state(edges)
    if not state[0]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        # larger neighbours of a node go to its least neighbour or itself
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .distinct())
        # a node and its smaller neighbours go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = cut_lineage(small.coalesce(_files(state[0], spark)), "edges")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, *, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs`` (doc_id,
    text; further columns are ignored): the signed fingerprint, and the least
    doc_id that links of ``max_bits`` differing bits or fewer reach, its own
    included. Repeated doc_ids are rows of their own. A null doc_id links like
    any other and is never a component_id unless no other id is there.
    """
    rows = cut_lineage(fingerprints(docs, shingle=shingle), "fingerprints")
    files = _files(rows.count(), rows.sparkSession)
    firsts = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).coalesce(files),
                         "fingerprint-firsts")
    roots = components(link_fingerprints(firsts, max_bits=max_bits))
    linked = roots.select(F.col("node").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct())
    least = (linked.join(firsts, "fp").groupBy("root").agg(F.min("first").alias("least")))
    label = linked.join(least, "root").select("fp", "least")
    named = firsts.join(label, "fp", "left").select("fp", "n", F.coalesce("least", "first").alias("component_id"))
    return join_unique(rows, cut_lineage(named.coalesce(files), "fingerprint-names"), "fp", "n").select("doc_id", "fp", "component_id")
