"""Byte-level BPE over a global shuffle of distinct words.

Texts are cut into pre-tokens with positions; every distinct pre-token of the
corpus is encoded once, where the shuffle gathers it; its ids join back to the
blocks it came from, and texts are put together by position. Decoding joins
ids to the table of token bytes.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import read_ranks, text_slices, token_encoding
from haulwise.llm.lexicon import Answers, WordIds, bucket_count, pack, token_rows, unpack, unpack_words, word_rows

SPACE, LETTER, NUMBER, OTHER = range(4)
ID_SLICE = 1 << 18  # ids that are decoded at a time
# Characters with the White_Space property
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def character_classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    out[WHITE] = SPACE
    return out


def _classes(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to."""
    out = table[data]  # right for ASCII
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = data[lead].astype(np.int64)
        more = 1 + (b >= 0xE0) + (b >= 0xF0)
        code = b & (0x3F >> more)
        for k in (1, 2, 3):
            own = more >= k
            code[own] = code[own] << 6 | (data[lead[own] + k] & 0x3F)
        kind = table[code]
        out[lead] = kind
        for k in (1, 2, 3):
            own = more >= k
            out[lead[own] + k] = kind[own]
    return out


def pre_tokens(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """(bytes, start, end, row) of the pre-tokens, which cover every byte: runs
    of letters, numbers or others with one space before; the lower-case
    English endings after an apostrophe; white space up to its last character
    before a word, and that character if it isn't a space."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if not n:
        return data, none, none, none
    kind = _classes(data, table)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start |= edge
    # a word after white space: its last character goes with the word, if it
    # is a space, or stands alone
    word = np.flatnonzero(start[1:n] & ~edge[1:n] & (kind[:-1] == SPACE)) + 1
    last = word - 1
    for _ in range(3):
        last = np.where((data[last] & 0xC0) == 0x80, last - 1, last)
    start[last] = True
    start[word[data[last] == 0x20]] = False
    # endings after an apostrophe that begins a pre-token
    tick = np.flatnonzero(start[:n] & (data == 0x27))
    if len(tick):
        room = np.searchsorted(offsets, tick, "right")
        room = offsets[room] - tick  # bytes to the text's end
        at = lambda k: np.where(room > k, data[np.minimum(tick + k, n - 1)], 0)
        one, two = at(1), at(2)
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for hit, width in ((tick[short], 2), (tick[long], 3)):
            start[hit + 1] = False
            start[hit + width] = True
    starts = np.flatnonzero(start[:n])
    ends = np.append(starts[1:], n)
    return data, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _cutter():
    table = character_classes()  # the driver's; 1.1 MB
    return lambda data, offsets: pre_tokens(data, offsets, table)


def _encode_words(blob, pattern: str):
    """Encodes every distinct word of a partition once, for all its blocks."""

    def encode(batches):
        encoding = token_encoding(blob.value, pattern)
        known = WordIds(lambda words: encoding.encode_ordinary_batch([w.decode() for w in words], num_threads=1))
        for batch in batches:
            rows = [known.numbers(unpack_words(x)) for x in
                    batch.column(batch.schema.get_field_index("words")).to_pylist()]
            known.refresh()
            out = [pack(*known.of(n)) for n in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.binary())],
                names=["bucket", "block", "n", "ids"])

    return encode


def _reassemble(buckets: int, blob=None):
    """Texts' ids from a block's words and positions; decoded again at once
    with the rank file ``blob``."""
    names = ["doc_id", "ids", "decoded"] if blob else ["doc_id", "ids"]
    kinds = [pa.int64(), pa.binary(), pa.binary()]

    def reassemble(answers: pa.Table, tokens: pa.Table) -> pa.Table:
        if not tokens.num_rows:
            return pa.table([pa.array([], k) for _, k in zip(names, kinds)], names=names)
        found = Answers(buckets, answers, tokens)
        parts = [unpack(x) for x in found.column("ids")]
        length = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
        ids = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)]).astype("<u4")
        first = np.cumsum(length) - length
        doc_ids = tokens.column("doc_ids")[0].values
        sizes, = unpack(tokens.column("sizes")[0].as_py())
        places, = unpack(tokens.column("places")[0].as_py())
        word = found.index(places)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        own = length[word]
        upto = np.concatenate([[0], np.cumsum(own)])
        out = np.empty(upto[-1], "<u4")
        for lo in range(0, len(word), ID_SLICE):
            w, m = word[lo:lo + ID_SLICE], own[lo:lo + ID_SLICE]
            a, b = upto[lo], upto[min(lo + ID_SLICE, len(word))]
            out[a:b] = ids[np.repeat(first[w] - upto[lo:lo + len(w)], m) + np.arange(a, b)]
        at = upto[edges]
        columns = [doc_ids, _binary(4 * at, out.tobytes())]
        if blob:
            decoder = _decoder(blob.value)
            columns.append(pa.chunked_array([decoder(out[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
                                             for lo, hi in _row_slices(at)], pa.binary()))
        return pa.table(columns, names=names)

    return reassemble


def _binary(edges: np.ndarray, body: bytes) -> pa.Array:
    """A binary column from the edges of its values."""
    wide = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1,
                                 [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(body)])
    return wide.cast(pa.binary())


def _row_slices(at: np.ndarray):
    """(first row, last row + 1) of runs of rows of about ID_SLICE ids, or one
    row; ``at`` has the rows' edges."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = min(max(lo + 1, int(np.searchsorted(at, at[lo] + ID_SLICE, "right")) - 1), n)
        yield lo, hi
        lo = hi


def _decoder(blob: bytes):
    """(ids, edges of rows) to a binary column: joins ids to token bytes."""
    ranks = read_ranks(blob)
    length = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, k in ranks.items():
        length[k] = len(token)
    first = np.cumsum(length) - length
    line = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)

    def decoder(ids: np.ndarray, at: np.ndarray) -> pa.Array:
        own = length[ids]
        if not own.all():
            raise ValueError("an id is not in the rank file")
        upto = np.concatenate([[0], np.cumsum(own)])
        out = line[np.repeat(first[ids] - upto[:-1], own) + np.arange(upto[-1])]
        return _binary(upto[at], out.tobytes())

    return decoder


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, decoded: bool = False) -> DataFrame:
    """``(doc_id, ids)``, one row per row of ``docs`` (doc_id, text; further
    columns are ignored): the ids of the whole text as little-endian unsigned
    32-bit integers, as tiktoken's ``encode_ordinary`` would give them. A null
    or empty text has no ids. Repeated rows and null doc_ids are encoded as any
    other. ``docs`` must be read from stored tables (see :mod:`lexicon`).
    ``ranks_path``: a tiktoken rank file, read by the driver. ``decoded`` adds
    what :func:`decode` makes of the ids, in the same task.
    """
    with open(ranks_path, "rb") as f:
        blob = docs.sparkSession.sparkContext.broadcast(f.read())
    buckets, cut = bucket_count(docs), _cutter()
    words = word_rows(docs, cut, buckets).repartition(buckets, "bucket")
    answers = words.mapInArrow(_encode_words(blob, pattern), "bucket int, block long, n int, ids binary")
    tokens = token_rows(docs, cut, buckets)
    return (answers.groupBy("block").cogroup(tokens.groupBy("block"))
            .applyInArrow(_reassemble(buckets, blob if decoded else None),
                          "doc_id long, ids binary" + (", decoded binary" if decoded else "")))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes of its ids; null
    for null. An id that the rank file lacks fails the job."""
    with open(ranks_path, "rb") as f:
        blob = encoded.sparkSession.sparkContext.broadcast(f.read())

    def join(batches):
        decoder = _decoder(blob.value)
        for batch in batches:
            wide = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            at = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
            raw = wide.buffers()[2]
            for lo, hi in _row_slices(at // 4):
                n = int(at[hi] - at[lo]) // 4
                ids = np.frombuffer(raw, "<u4", n, int(at[lo])) if n else np.zeros(0, "<u4")
                rows = batch.slice(lo, hi - lo)
                text = decoder(ids, (at[lo:hi + 1] - at[lo]) // 4)
                if rows.column(1).null_count:
                    text = pc.if_else(rows.column(1).is_valid(), text, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*rows.columns, text], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(join, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Token count and digests of ids and decoded bytes, per row."""
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
