"""A global table of distinct words, and its way back to the texts.

Texts are cut to tokens in blocks of some megabytes. A block sends each of its
distinct words once, to the partition its hash names (the word shuffle), where
every distinct word of the corpus meets all its blocks. What that partition
finds out goes back to the blocks as rows, and joins the block's tokens, which
carry positions into the block's word list instead of words.

A word's place in a block is ``rank * buckets + bucket``, the rank being by
falling count among the block's words of that bucket. So no places travel with
the words, and frequent words have small ones.

Both the words and the tokens of a block come from a scan of their own. The
rows must therefore come in the same order from both, as they do from stored
tables; the two sides are held against each other when they meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from haulwise.llm.common import RollingHash, shuffle_width, text_slices

BLOCK_BYTES = 3 << 20
# (bytes, offsets) -> (bytes, start, end and row of every token)
Cutter = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

WORDS = "bucket int, block long, n int, marks binary, words binary"
TOKENS = "block long, doc_ids array<bigint>, sizes binary, places binary, distinct int, mark long"


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays, byte by byte in planes, compressed."""
    import zstandard

    out = []
    for a in arrays:
        width = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
        planes = np.ascontiguousarray(a.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
        body = zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 1)
        out += [np.array([len(a), width, len(body)], "<u8").tobytes(), body]
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    out, at = [], 0
    while at < len(blob):
        n, width, size = np.frombuffer(blob, "<u8", 3, at).tolist()
        raw = np.frombuffer(zstandard.decompress(blob[at + 24:at + 24 + size], max_output_size=n * width + 1), np.uint8)
        value = np.zeros(n, np.int64)
        for k in range(width):
            value |= raw[k * n:(k + 1) * n].astype(np.int64) << (8 * k)
        out.append(value)
        at += 24 + size
    return out


def pack_words(words: list[bytes]) -> bytes:
    import zstandard

    return pack(np.array([len(w) for w in words], np.int64)) + zstandard.compress(b"".join(words), 1)


def unpack_words(blob: bytes) -> list[bytes]:
    import zstandard

    head = 24 + int(np.frombuffer(blob, "<u8", 3)[2])
    ends = np.cumsum(unpack(blob[:head])[0]).tolist()
    line = zstandard.decompress(blob[head:], max_output_size=(ends[-1] if ends else 0) + 1)
    return [line[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


@dataclass
class Block:
    ids: list  # doc_id of each text
    sizes: np.ndarray  # tokens of each text
    number: np.ndarray  # of each token, the number of its word
    counts: np.ndarray  # of each word
    hashes: np.ndarray
    spans: Callable[[np.ndarray], list[bytes]]  # words by number
    rows: np.ndarray  # the text of each token


def blocks(batches, cut: Cutter, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of texts from batches of (doc_id, text)."""
    hasher = RollingHash()
    held: list[tuple] = []
    size = 0

    def close() -> Block:
        ids = [i for h in held for i in h[0]]
        sizes = np.concatenate([h[1] for h in held])
        hashes = np.concatenate([h[2] for h in held])
        distinct, first, number, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        edges = np.cumsum([0, *(len(h[2]) for h in held)])

        def spans(which: np.ndarray) -> list[bytes]:
            at = first[which]
            part = np.searchsorted(edges, at, "right") - 1
            out: list[bytes] = [b""] * len(which)
            for p in np.unique(part).tolist():
                mine = np.flatnonzero(part == p)
                k = at[mine] - edges[p]
                line, starts, ends = held_now[p][3], held_now[p][4][k].tolist(), held_now[p][5][k].tolist()
                for m, a, b in zip(mine.tolist(), starts, ends, strict=True):
                    out[m] = line[a:b]
            return out

        held_now = list(held)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        return Block(ids, sizes, number.astype(np.int64), counts, distinct, spans, rows)

    for batch in batches:
        pa.default_memory_pool().release_unused()
        doc_ids = batch.column(0).to_pylist()
        for lo, hi, data, offsets in text_slices(batch.column(1)):
            if held and size + len(data) > limit:
                yield close()
                held, size = [], 0
            data, starts, ends, rows = cut(data, offsets)
            held.append((doc_ids[lo:hi], np.bincount(rows, minlength=hi - lo), hasher(data, starts, ends),
                         data.tobytes(), starts.astype(np.int32), ends.astype(np.int32)))
            size += len(data)
    if held:
        yield close()


def _arranged(block: Block, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words by bucket and falling count, the bucket of each, the rank)."""
    bucket = (block.hashes >> np.uint64(20)) % np.uint64(buckets)
    order = np.lexsort((block.hashes, -block.counts, bucket))
    bucket = bucket[order].astype(np.int64)
    starts = np.searchsorted(bucket, np.arange(buckets))
    return order, bucket, np.arange(len(order)) - starts[bucket]


def _block_id(k: int) -> int:
    return (TaskContext.get().partitionId() << 32) + k


def bucket_count(df: DataFrame) -> int:
    return max(64, shuffle_width(df) // 4)


def word_rows(docs: DataFrame, cut: Cutter, buckets: int, marks: Callable[[Block], list[np.ndarray]] | None = None
              ) -> DataFrame:
    """A row for each block and bucket: the words (:func:`pack_words`), and
    per-word numbers that ``marks`` makes of the block (:func:`pack`)."""

    def rows(batches):
        for k, block in enumerate(blocks(batches, cut)):
            order, bucket, _ = _arranged(block, buckets)
            extra = [x[order] for x in marks(block)] if marks else []
            words = block.spans(order)
            edges = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
            full = [b for b in range(buckets) if edges[b] < edges[b + 1]]
            cut_out = lambda b: slice(edges[b], edges[b + 1])
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array([_block_id(k)] * len(full), pa.int64()),
                pa.array([edges[b + 1] - edges[b] for b in full], pa.int32()),
                pa.array([pack(*(x[cut_out(b)] for x in extra)) for b in full], pa.binary()),
                pa.array([pack_words(words[cut_out(b)]) for b in full], pa.binary())],
                names=["bucket", "block", "n", "marks", "words"])

    return docs.select("doc_id", "text").mapInArrow(rows, WORDS)


def token_rows(docs: DataFrame, cut: Cutter, buckets: int) -> DataFrame:
    """A row for each block: its doc_ids, and the places of its tokens."""

    def rows(batches):
        for k, block in enumerate(blocks(batches, cut)):
            order, bucket, rank = _arranged(block, buckets)
            place = np.empty(len(order), np.int64)
            place[order] = rank * buckets + bucket
            yield pa.RecordBatch.from_arrays([
                pa.array([_block_id(k)], pa.int64()), pa.array([block.ids], pa.list_(pa.int64())),
                pa.array([pack(block.sizes)], pa.binary()), pa.array([pack(place[block.number])], pa.binary()),
                pa.array([len(order)], pa.int32()),
                pa.array([_mark([np.diff(np.searchsorted(bucket, np.arange(buckets + 1)))])], pa.int64())],
                names=["block", "doc_ids", "sizes", "places", "distinct", "mark"])

    return docs.select("doc_id", "text").mapInArrow(rows, TOKENS)


def _mark(arrays: list[np.ndarray]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b"".join(a.astype("<i8").tobytes() for a in arrays)) >> 1


class WordIds:
    """Numbers for the distinct words met so far, and the ids that ``encode``
    (a list of words to a list of id lists) gave each of them, once."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]) -> None:
        self.encode = encode
        self.index: dict[bytes, int] = {}
        self.length = self.ids = np.zeros(0, np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        index = self.index
        return np.array([index.setdefault(w, len(index)) for w in words], np.int64)

    def refresh(self) -> None:
        """Encodes the words that are new since the last time."""
        new = list(islice(self.index, len(self.length), None))
        ids = self.encode(new)
        self.length = np.concatenate([self.length, np.fromiter(map(len, ids), np.int64, len(ids))])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.int64)])
        self.first = np.cumsum(self.length) - self.length

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many ids each word has, the ids one after another)."""
        n = self.length[numbers]
        return n, self.ids[np.repeat(self.first[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class Answers:
    """What the word partitions sent back to a block: for each bucket a row
    (bucket, n, ...), and where each place is in the rows' joined arrays."""

    def __init__(self, buckets: int, answers: pa.Table, tokens: pa.Table) -> None:
        bucket = answers.column("bucket").to_numpy()
        self.order = np.argsort(bucket, kind="stable")
        n = np.zeros(buckets, np.int64)
        n[bucket] = answers.column("n").to_numpy()
        if _mark([n]) != tokens.column("mark")[0].as_py() or len(np.unique(bucket)) != len(bucket):
            raise RuntimeError("two scans of the texts came in different order: store them as a table first")
        self.base = np.cumsum(n) - n
        self.buckets = buckets
        self.answers = answers

    def column(self, name: str) -> list:
        values = self.answers.column(name)
        return [values[int(k)].as_py() for k in self.order]

    def index(self, places: np.ndarray) -> np.ndarray:
        return self.base[places % self.buckets] + places // self.buckets
