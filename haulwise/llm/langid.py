"""Language ID by error-correcting output codes.

Every language has a binary codeword. For each bit, a naive Bayes classifier
over hashed byte triples decides between the languages with a one and those
with a zero; its margin enters a logistic loss, and the codeword with the
least summed loss is the prediction. The losses also say how far the next
codeword is, which flags ambiguous texts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import mix, text_slices

# Bytes as the classifiers see them: ASCII letters in lower case, other ASCII
# a space, bytes of longer characters as they are.
_FOLD = np.array([c if c > 127 else ord(chr(c).lower()) if chr(c).isalpha() else 32
                  for c in range(256)], np.uint8)


def codewords(n: int, seed: int = 1) -> np.ndarray:
    """An (n, bits) matrix of -1 and 1: every split of the classes for up to
    seven, else random columns, the best of 64 draws by least distance."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        columns = np.arange(1, 1 << (n - 1))
        return np.array([2 * (columns >> k & 1) - 1 for k in range(n)])
    bits, rng, best = 4 * int(np.ceil(np.log2(n))) + 7, np.random.default_rng(seed), None
    for _ in range(64):
        code = rng.choice([-1, 1], (n, bits))
        if (abs(code.sum(0)) == n).any():
            continue
        apart = (bits - (code @ code.T - 2 * bits * np.eye(n)).max()) / 2
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


def _triples(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of the triples that hold a letter, runs of other ASCII
    taken as one space."""
    b = _FOLD[data]
    # capital letters of the Latin-1 block: C3 80-9E are those of C3 A0-BE
    after = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.zeros(0, np.int64)
    capital = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    b[capital] += 0x20
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32) | (row[1:] != row[:-1])
    b, row = b[keep].astype(np.uint64), row[keep]
    same = row[2:] == row[:-2]
    gram = (b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16))[same]
    return (mix(gram + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.int64), row[2:][same]


def fit(docs: DataFrame, learn: Column, *, bits: int = 15) -> tuple[Sequence[str], np.ndarray, np.ndarray]:
    """(languages, codewords, weights by bucket and bit), from the rows of
    ``docs`` where ``learn`` holds and text and lang are not null. The driver
    gets a count for each language and bucket."""
    size = 1 << bits

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = batch.column(0).to_pylist()
            index = {x: k for k, x in enumerate(dict.fromkeys(lang))}
            of = np.array([index[x] for x in lang], np.int64)
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                bucket, row = _triples(data, offsets, bits)
                here = of[lo:hi][row]
                for x, k in index.items():
                    own = bucket[here == k]
                    if len(own):
                        totals.setdefault(x, np.zeros(size, np.int64))
                        totals[x] += np.bincount(own, minlength=size)
        for x, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some])],
                names=["lang", "bucket", "n"])

    rows = (docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
            .mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(rows.lang.unique())
    counts = np.zeros((len(langs), size))
    counts[rows.lang.map({x: k for k, x in enumerate(langs)}).to_numpy(np.int64), rows.bucket] = rows.n
    code = codewords(len(langs))
    # unseen triples take their share of all text, the more the fewer were seen;
    # each language weighs the same on its side of a bit
    pooled = (counts.sum(axis=0) + 0.1) / (counts.sum() + 0.1 * size)
    seen = (counts > 0).sum(axis=1, keepdims=True) + 1
    p = (counts + seen * pooled) / (counts.sum(axis=1, keepdims=True) + seen)
    weights = np.empty((size, code.shape[1]), np.float32)
    for k in range(code.shape[1]):
        one, zero = p[code[:, k] > 0].mean(axis=0), p[code[:, k] < 0].mean(axis=0)
        weights[:, k] = np.log(one / zero)
    return langs, code, weights


def predict(docs: DataFrame, langs: Sequence[str], code: np.ndarray, weights: np.ndarray, *,
            ambiguous_below: float = 0.9) -> DataFrame:
    """``(doc_id, lang_pred, score, ambiguous)``, one row per row of ``docs``.

    Only the text is read. ``lang_pred`` is one of ``langs``; it is ``und``
    with score 0 if the text is null or has no letter, or nothing was learned.
    ``score`` is the chosen language's share of exp(-loss); equal losses go to
    the language that sorts first. ``ambiguous``: the score is under the bound.
    """
    bits = int(weights.shape[0]).bit_length() - 1

    def decide(batches):
        for batch in batches:
            texts = batch.column(1)
            preds, scores = [], []
            lettered = [t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()]
            for lo, hi, data, offsets in text_slices(texts):
                bucket, row = _triples(data, offsets, bits)
                n = np.bincount(row, minlength=hi - lo)
                margin = np.stack([np.bincount(row, weights[bucket, k], hi - lo)
                                   for k in range(code.shape[1])], 1) if code.shape[1] else np.zeros((hi - lo, 0))
                margin = np.clip(margin / np.sqrt(n + 1)[:, None], -30, 30)
                loss = np.log1p(np.exp(-margin[:, None, :] * code[None])).sum(axis=2)
                for k in range(hi - lo):
                    if not lettered[lo + k] or not len(langs):
                        preds.append("und")
                        scores.append(0.0)
                        continue
                    share = np.exp(loss[k].min() - loss[k])
                    best = int(np.argmin(loss[k]))
                    preds.append(langs[best])
                    scores.append(float(1 / share.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return (docs.select("doc_id", "text").mapInArrow(decide, "doc_id long, lang_pred string, score double")
            .withColumn("ambiguous", F.col("score") < ambiguous_below))
