"""Spelling variants by blocked Gram matrices of letter counts.

Two words that are one edit apart have letter counts whose squared distance is
two at most: one letter more or less makes it one, a letter for another two.
The squared distances of a block of words come from one matrix product, the
Gram matrix of their letter counts, and only pairs within two are held letter
by letter against each other.

A block holds the words of one length; it is divided by how many letters of
each of four classes a word has. One edit then leads to the same block, to one
of the next length with one letter more of some class, or to one of the same
length where one letter has changed its class. Every word stays in its own
block and visits those that one edit upward can reach, in one direction only,
so that a pair meets once. A block with too many words is cut into chunks by
word hash, and every two chunks of it meet in a task of their own.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import shuffle_width, whole_groups
from haulwise.session import cut_lineage

# The letters of a word all have one byte in Latin-1.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
CLASSES = 4
# of each letter's byte: its column in the counts, and its class
_COLUMN = np.zeros(256, np.int64)
_COLUMN[LETTERS] = np.arange(len(LETTERS))
_CLASS = (np.arange(256) >> 2) % CLASSES
HELD = 200_000  # distinct words that a task counts before it passes them on


def variant(doc_id: int | None, word: str, modulus: int, base: int) -> str:
    """The word, or what is left when one letter is deleted: where ``modulus``
    divides the CRC-32 of id and word (``base``: that of what precedes the
    word). A word of no document stays."""
    h = zlib.crc32(word.encode(), base)
    if doc_id is None or h % modulus:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def _count(modulus: int, least_letters: int):
    def count(batches):
        total: dict[str, int] = {}

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                own: dict[str, int] = {}
                # lower case for A-Z alone is what bytes have
                for run in RUN.findall(text.encode().lower().decode()):
                    if len(run) >= least_letters:
                        own[run] = own.get(run, 0) + 1
                base = zlib.crc32(f"{i}:".encode())
                for run, n in own.items():
                    word = variant(i, run, modulus, base)
                    if len(word) >= least_letters:
                        total[word] = total.get(word, 0) + n
                if len(total) >= HELD:
                    yield flush()
        yield flush()

    return count


def vocabulary(docs: DataFrame, *, modulus: int = 97, least_letters: int = 5, least_count: int = 3) -> DataFrame:
    """``(word, n)``: the words of all texts with at least ``least_letters``
    letters and ``least_count`` occurrences."""
    return (docs.select("doc_id", "text").mapInArrow(_count(modulus, least_letters), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters of all words, where each begins and the last ends), as Latin-1."""
    each = [w.encode("latin-1") for w in words.to_pylist()]
    return np.frombuffer(b"".join(each), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in each], dtype=np.int64)])


def _counts(values: np.ndarray, edges: np.ndarray, of: np.ndarray, width: int) -> np.ndarray:
    """How often each word has each value ``of`` a letter, an array (words, width)."""
    n = len(edges) - 1
    row = np.repeat(np.arange(n), np.diff(edges))
    return np.bincount(row * width + of[values], minlength=n * width).reshape(n, width)


# what an edit upward may add to the counts of the classes: a letter, or one in place of one of a lower class
_STEPS = np.array([[int(k == i) for k in range(CLASSES)] for i in range(CLASSES)]
                  + [[int(k == j) - int(k == i) for k in range(CLASSES)] for i in range(CLASSES) for j in range(i + 1, CLASSES)])


def _visits(batches):
    """(block, word, n, guest): every word in its own block, and as a guest in
    those that it visits."""
    for batch in batches:
        values, edges = _spelled(batch.column(0))
        counts = _counts(values, edges, _CLASS, CLASSES)
        homes = np.arange(len(counts))
        where, who, guest = [counts], [homes], [np.zeros(len(counts), bool)]
        for step in _STEPS:
            go = np.flatnonzero((counts + step >= 0).all(axis=1))
            where.append(counts[go] + step)
            who.append(homes[go])
            guest.append(np.ones(len(go), bool))
        block = np.concatenate(where).astype("<i4")
        at = pa.array(np.concatenate(who))
        keys = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(4 * CLASSES), len(block), [None, pa.py_buffer(np.ascontiguousarray(block))]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [keys, batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(guest))],
            names=["block", "word", "n", "guest"])


def one_edit(values: np.ndarray, edges: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of words (numbers ``a`` and ``b``) differ by just one
    letter inserted, deleted or replaced."""
    size = np.diff(edges)
    swap = size[a] > size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    more = size[b] - size[a]
    out = np.zeros(len(a), bool)
    for extra in (0, 1):
        for length in np.unique(size[a][more == extra]).tolist():
            own = np.flatnonzero((more == extra) & (size[a] == length))
            for part in np.array_split(own, max(1, len(own) * (length + 1) >> 24)):
                x = values[edges[a[part]][:, None] + np.arange(length)]
                y = values[edges[b[part]][:, None] + np.arange(length + extra)]
                if extra:  # the same before the letter more, and after it
                    head = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
                    tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
                    out[part] = head + tail >= length
                else:
                    out[part] = (x != y).sum(axis=1) == 1
    return out


def _letters(values: np.ndarray, edges: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The letter counts of some words, in a type in which products are exact."""
    size = np.diff(edges)[which]
    ends = np.cumsum(size)
    at = np.repeat(edges[which] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    counts = _counts(values[at], np.concatenate([[0], ends]), _COLUMN, len(LETTERS))
    return counts.astype(np.float32 if size.max(initial=0) < 2048 else np.float64)


def near_pairs(values: np.ndarray, edges: np.ndarray, left: np.ndarray, right: np.ndarray, rows: int = 1024
               ) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a word of ``left`` and one of ``right`` that are one edit
    apart, found by squared distances from the Gram matrix."""
    found_a, found_b = [], []
    other = _letters(values, edges, right)
    to = (other * other).sum(axis=1)
    for lo in range(0, len(left), rows):
        own = left[lo:lo + rows]
        counts = _letters(values, edges, own)
        distance = (counts * counts).sum(axis=1)[:, None] + to[None, :] - 2 * (counts @ other.T)
        i, j = np.nonzero(distance <= 2)
        i, j = own[i], right[j]
        near = one_edit(values, edges, i, j)
        found_a.append(i[near])
        found_b.append(j[near])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _meet(batches):
    """Over rows (block, a, b, chunk, word, n, guest), sorted by the first
    three: both directions of every near pair as (word, near, near_n)."""
    for rows, cuts in whole_groups(batches, 3):
        values, edges = _spelled(rows.column("word").combine_chunks())
        chunk, a, b, guest = (rows.column(k).to_numpy() for k in ("chunk", "a", "b", "guest"))
        guest = guest.astype(bool)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = np.arange(lo, hi)
            home, first = own[~guest[lo:hi]], chunk[lo:hi] == a[lo]
            if not len(home) or hi - lo < 2:
                continue
            if a[lo] == b[lo]:
                i, j = near_pairs(values, edges, home, own)
                once = guest[j] | (i < j)
                pairs = [(i[once], j[once])]
            else:  # words at home in one chunk with all of the other, then the other way for guests
                pairs = [near_pairs(values, edges, own[~guest[lo:hi] & first], own[~first]),
                         near_pairs(values, edges, own[~guest[lo:hi] & ~first], own[guest[lo:hi] & first])]
            for i, j in pairs:
                left.append(i)
                right.append(j)
        i, j = np.concatenate(left), np.concatenate(right)
        one, two = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
        words, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
        yield pa.RecordBatch.from_arrays([words.take(one), words.take(two), n.take(two)], names=["word", "near", "near_n"])


def near_words(words: DataFrame, *, most_rows: int = 4096) -> DataFrame:
    """``(word, near, near_n)`` for distinct ``words`` (word, n): both
    directions of every pair one edit apart, each once. ``most_rows``: about
    how many rows of a block are one chunk."""
    visits = cut_lineage(words.select("word", "n").mapInArrow(_visits, "block binary, word string, n long, guest boolean"),
                         "spelling-visits")
    # a block without a home word has no pairs
    blocks = visits.groupBy("block").agg(F.count("*").alias("rows"), F.bool_and("guest").alias("idle"))
    blocks = blocks.where("rows > 1 and not idle").select("block", F.ceil(F.col("rows") / most_rows).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    placed = (visits.join(blocks, "block").withColumn("chunk", chunk)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select("block", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
                      "chunk", "word", "n", "guest"))
    return (placed.repartition(shuffle_width(words), "block", "a", "b").sortWithinPartitions("block", "a", "b")
            .mapInArrow(_meet, "word string, near string, near_n long"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: where the chain of ``forms`` (word, form) ends. Forms
    must not lead in a circle. Every round doubles the steps that a row has
    taken and is written."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        further = now.join(ahead, now.root == F.col("_at"), "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        further = cut_lineage(further, "spelling-roots")
        if further.where("moved").isEmpty():
            return further.select("word", "root")
        now = further.drop("moved")


def spelling_variants(docs: DataFrame, *, modulus: int = 97, least_letters: int = 5, least_count: int = 3,
                      ratio: int = 2, most_rows: int = 4096) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per distinct word of
    ``docs`` (doc_id, text; further columns are ignored).

    Words are runs of a-z and U+00C0-U+00FF, A-Z lower-cased, some with a letter
    deleted (see :func:`variant`; with a null doc_id none is); shorter ones than
    ``least_letters`` and rarer ones than ``least_count`` are no words. Null and
    empty texts have none; repeated rows count each. ``n_near`` counts the words
    one edit away. ``form`` is the most frequent of those (ties: the least in
    code-point order) if it has ``ratio`` times as many occurrences, else null;
    ``root`` is where forms lead in the end, the word itself without one.
    """
    words = cut_lineage(vocabulary(docs, modulus=modulus, least_letters=least_letters, least_count=least_count), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words, most_rows=most_rows).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    formed = cut_lineage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
