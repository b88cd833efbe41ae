"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Words are runs of anything but white space and ASCII punctuation, lower-cased.
Every run of n words of a test item is a seed. Seeds are counted over all
documents, and an item's rare ones are kept: those in at most ``rare`` times
as many documents as the item's median seed (plus ten). At least half of an
item's seeds are kept, however often its passage was copied. Where a document
holds a rare seed, the words around it are aligned with the item, and the
alignment score decides.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import RollingHash, mix, text_slices, word_bounds
from haulwise.session import cut_lineage

# Upper case to lower, ASCII punctuation and control characters to a space.
_PLAIN = np.array([c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256)], np.uint8)
_TABLE_BITS = 20
MATCH, MISMATCH, GAP = 2, -1, -1


def _fold(data: np.ndarray) -> np.ndarray:
    b = _PLAIN[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.zeros(0, np.int64)
    b[after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]] += 0x20  # as for A-Z
    return b


def _seed_hashes(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    h = words[at]
    for k in range(1, n):
        h = mix(h * np.uint64(3) + words[at + k])
    return h


class Seeds:
    """The seeds of some items: hashes in order, and their items."""

    def __init__(self, items: list[tuple[int, str]], n: int) -> None:
        self.n, hasher, of = n, RollingHash(), defaultdict(set)
        self.words = np.zeros(1 << _TABLE_BITS, bool)  # whether a word may be in an item
        self.length: dict[int, int] = {}
        for item, text in items:
            data = _fold(np.frombuffer(text.encode(), np.uint8))
            starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
            self.length[item] = len(starts)
            if len(starts) >= n:
                h = hasher(data, starts, ends)
                self.words[h >> np.uint64(64 - _TABLE_BITS)] = True
                for s in _seed_hashes(h, np.arange(len(h) - n + 1), n).tolist():
                    of[s].add(item)
        self.hashes = np.array(sorted(of), np.uint64)
        self.items = [sorted(of[h]) for h in self.hashes.tolist()]

    def find(self, data: np.ndarray, offsets: np.ndarray, hasher: RollingHash):
        """(index of seed, word, row) of each seed met, and the word bounds."""
        starts, ends, row = word_bounds(data, offsets)
        none = np.zeros(0, np.int64)
        if len(starts) < self.n or not len(self.hashes):
            return none, none, none, starts, ends, row
        h = hasher(data, starts, ends)
        known = self.words[h >> np.uint64(64 - _TABLE_BITS)]
        m = len(h) - self.n + 1
        ok = row[:m] == row[self.n - 1:]
        for k in range(self.n):
            ok &= known[k:k + m]
        at = np.flatnonzero(ok)
        s = _seed_hashes(h, at, self.n)
        k = np.minimum(np.searchsorted(self.hashes, s), len(self.hashes) - 1)
        hit = self.hashes[k] == s
        return k[hit], at[hit], row[at[hit]], starts, ends, row


def align(item: list[str], passage: list[str]) -> tuple[int, int]:
    """(best local alignment score, end of it in the passage), in words."""
    number = {w: k for k, w in enumerate(dict.fromkeys(item))}
    p = np.array([number.get(w, -1) for w in passage])
    line = np.arange(len(p) + 1)
    row, best, end = np.zeros(len(p) + 1, np.int64), 0, 0
    for w in item:
        new = np.zeros(len(p) + 1, np.int64)
        new[1:] = np.maximum(row[:-1] + np.where(p == number[w], MATCH, MISMATCH), row[1:] + GAP)
        # gaps along the passage: the best of all cells before, less one each
        row = np.maximum(np.maximum.accumulate(np.maximum(new, 0) - GAP * line) + GAP * line, 0)
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def _seed_documents(docs: DataFrame, seeds: Seeds) -> np.ndarray:
    """In how many documents each seed is."""

    def count(batches):
        hasher, total = RollingHash(), np.zeros(len(seeds.hashes), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(1)):
                k, _, row, *_ = seeds.find(_fold(data), offsets, hasher)
                pairs = np.unique(row * len(total) + k)
                total += np.bincount(pairs % max(1, len(total)), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["seed", "n"])

    rows = docs.mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(seeds.hashes), np.int64)
    out[rows.seed.to_numpy(np.int64)] = rows.n
    return out


def _rare(seeds: Seeds, documents: np.ndarray, rare: float) -> Seeds:
    """The same with each item's rare seeds only."""
    own = defaultdict(list)
    for k, items in enumerate(seeds.items):
        for i in items:
            own[i].append(documents[k])
    most = {i: rare * float(np.median(x)) + 10 for i, x in own.items()}
    kept = [[i for i in items if documents[k] <= most[i]] for k, items in enumerate(seeds.items)]
    have = [k for k, items in enumerate(kept) if items]
    out = object.__new__(Seeds)
    out.n, out.words, out.length = seeds.n, seeds.words, seeds.length
    out.hashes, out.items = seeds.hashes[have], [kept[k] for k in have]
    return out


def _passages(seeds: Seeds):
    """(doc_id, item, first word, words): the surroundings of rare seeds,
    one row for seeds of one item that lie within reach of each other."""

    def passages(batches):
        hasher = RollingHash()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[list] = [[], [], [], []]
            for lo, _, data, offsets in text_slices(batch.column(1)):
                data = _fold(data)
                found, at, rows, starts, ends, row = seeds.find(data, offsets, hasher)
                first = np.searchsorted(row, np.arange(len(offsets)))  # a row's first word
                spots = defaultdict(list)
                for k, a, r in zip(found.tolist(), at.tolist(), rows.tolist(), strict=True):
                    for item in seeds.items[k]:
                        spots[r, item].append(a)
                for (r, item), places in spots.items():
                    reach = seeds.length[item]
                    groups = np.split(places, np.flatnonzero(np.diff(places) > 2 * reach) + 1)
                    for g in groups:
                        a = max(int(first[r]), int(g[0]) - reach)
                        b = min(int(first[r + 1]), int(g[-1]) + reach + seeds.n)
                        for x, v in zip(out, (ids[lo + r], item, a - int(first[r]),
                                              data[starts[a]:ends[b - 1]].tobytes().decode("utf-8", "replace")), strict=True):
                            x.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.string())], names=["doc_id", "item", "first_word", "passage"])

    return passages


def _words(text: str) -> list[str]:
    return _fold(np.frombuffer(text.encode(), np.uint8)).tobytes().decode("utf-8", "replace").split(" ")


def _score(batches):
    for batch in batches:
        scores, ends = [], []
        found = []
        for item, passage in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            words = [w for w in _words(item) if w]
            score, end = align(words, [w for w in passage.split(" ") if w])
            scores.append(score / (MATCH * len(words)))
            found.append(score / MATCH)
            ends.append(end)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(scores, pa.float64()), pa.array(found, pa.float64()), pa.array(ends, pa.int64())],
            names=["doc_id", "item", "first_word", "score", "words", "end"])


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, n: int = 3, least_score: float = 0.45, least_words: int = 50,
               rare: float = 3.0, most_words: int = 4_000_000) -> DataFrame:
    """``(doc_id, item_id, score, last_word)``: the documents (doc_id, text)
    that hold a copy of an item (item_id, text), one row for each pair.

    ``score`` is the best alignment score over that of an exact copy, 1 at
    most; pairs under ``least_score`` are left out, unless the alignment is
    worth ``least_words`` copied words (so a long part of a much longer item
    counts). ``last_word`` is where the best alignment ends in the document, in
    words. Null and empty texts, and items of fewer than ``n`` words, match
    nothing. Repeated rows give one row for a doc_id and item. Items of equal
    text are all reported; the texts of a repeated item_id are one item, whose
    best alignment counts, and so are items with a null one. The items
    that documents are held against at a time have ``most_words`` words at
    most (and one item more); a longer benchmark is dealt by item into several
    such passes.
    """
    docs = docs.select("doc_id", "text").where("text is not null")
    # one entry for each id and text, told apart by number
    items = cut_lineage(benchmark.where("text is not null").select("item_id", "text").distinct()
                        .withColumn("item", F.monotonically_increasing_id()), "leak-items")
    total = items.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    parts = max(1, int(-(-total // most_words)))
    out = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        seeds = Seeds([tuple(r) for r in own.select("item", "text").collect()], n)  # about most_words words
        kept = _rare(seeds, _seed_documents(docs, seeds), rare)
        passages = docs.mapInArrow(_passages(kept), "doc_id long, item long, first_word long, passage string")
        scored = (passages.join(own, "item").select("doc_id", "item", "first_word", "text", "passage")
                  .mapInArrow(_score, "doc_id long, item long, first_word long, score double, words double, end long")
                  .where((F.col("score") >= least_score) | (F.col("words") >= least_words))
                  .join(own.select("item", "item_id"), "item"))
        out = scored if out is None else out.unionByName(scored)
    return (out.groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("score", (-F.col("first_word") - F.col("end")).alias("last"))).alias("best"))
            .select("doc_id", "item_id", "best.score", (-F.col("best.last")).alias("last_word")))
