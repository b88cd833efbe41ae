"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words, word pairs, byte triples,
and whether a word and the one after it repeat the word before) are counted:
one of the target text (documents labelled good and not toxic) and one of the
raw text (every document), each in strata such as languages. A document's log
weight is the mean log ratio of its n-grams, summed over the families. Ratios
are taken from their mean over the target text, so that a typical good document
of any stratum has weight 0, and the mean of a short document is drawn toward
that.

The sample is a Gumbel top-k: standard Gumbel noise is added to the log
weights and the k greatest sums are selected, which draws k documents without
replacement in proportion to their weights. k is a share of the documents, a
parameter.

Apart from the draw, every document is classified: it is kept unless its log
weight is under the cut that best parts the held-out labelled documents (good
against not good, equal weight), or a lower one if that would drop more than a
small share of the good.

A mean hides the few words that make a document toxic. A second pair of models
therefore counts in how many toxic and how many other labelled documents a
word occurs, and keeps the words that are far more frequent in toxic ones than
chance allows. The log ratios of those in a document are summed, whatever its
length, and lower its weight where the sum passes a cut of its own, chosen on
held-out labels in the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwise.llm.common import RollingHash, mix, running, text_slices, word_bounds
from haulwise.session import cut_lineage

FAMILIES = 4
SHRINK = 20  # n-grams of weight 0 that every document has besides its own
BELOW = 100.0  # more than other log weights differ by
TOLD = 5.0  # log likelihood ratio from which on a word tells toxic documents

# Bytes with ASCII letters in lower case and ASCII punctuation as spaces
PLAIN = np.array([k + 32 if 65 <= k <= 90 else k if k >= 128 or chr(k).isalnum() or k < 33 else 32 for k in range(256)], np.uint8)


def _features(data: np.ndarray, offsets: np.ndarray, hasher: RollingHash, bits: int):
    """For each family, the bucket and the row of every n-gram."""
    shift = np.uint64(64 - bits)
    starts, ends, row = word_bounds(data, offsets)
    words = hasher(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    yield (words >> shift).astype(np.int64), row
    both = row[1:] == row[:-1]
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])[both]
    yield (pairs >> shift).astype(np.int64), row[1:][both]
    again = np.zeros(len(words), np.uint64)
    again[1:] = (words[1:] == words[:-1]) & both
    yield (mix(again[1:] * np.uint64(2) + again[:-1] + np.uint64(1))[both] >> shift).astype(np.int64), row[1:][both]
    b = data.astype(np.uint64)
    triples = mix((b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16)) + np.uint64(1))
    at = np.arange(len(triples))
    first = np.searchsorted(offsets, at, "right") - 1
    inside = at + 2 < offsets[first + 1] if len(at) else np.zeros(0, bool)
    yield (triples[inside] >> shift).astype(np.int64), first[inside]


def _label_sample(labels: DataFrame, bound: int) -> dict[int, tuple[bool, bool, bool]]:
    """doc_id -> (good, for the model, toxic): at most ``bound`` labelled documents of
    either kind, those with the smallest hash. Rows that disagree count as not
    good; half of the sample is for the model, half for the cut."""
    each = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
            .agg((F.min("quality") == 1) .alias("q"), (F.max(F.coalesce("toxic", F.lit(0))) == 1).alias("t"))
            .select("doc_id", (F.col("q") & ~F.col("t")).alias("good"), F.col("t").alias("toxic"), F.xxhash64("doc_id").alias("h")))
    rows = []
    for kind in (True, False):
        rows += each.where(F.col("good") == kind).orderBy("h", "doc_id").limit(bound).collect()
    return {r.doc_id: (r.good, r.h & 1 == 0, r.toxic) for r in rows}


def _strata(docs: DataFrame, sample: dict) -> dict:
    """Value to number, for the strata that good documents of the sample are
    in: no others have target text."""
    ids = docs.sparkSession.createDataFrame([(i,) for i, s in sample.items() if s[0]], "doc_id long")  # label_bound rows at most
    rows = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("stratum").distinct().collect()
    return {x: k for k, x in enumerate(sorted((r[0] for r in rows), key=lambda x: (x is not None, x)))}


def _ratios(docs: DataFrame, sample: dict, strata: dict, bits: int) -> np.ndarray:
    """Log ratio of target to raw probability of each stratum's and family's
    buckets, less its mean over the target text. Buckets have half a count more
    in the raw text, and the stratum's share of that in the target; a stratum
    without target text has ratio 0, as have all that are not in ``strata``."""
    size = 1 << bits

    def count(batches):
        hasher = RollingHash()
        total = np.zeros((2, len(strata) + 1, FAMILIES, size), np.int64)
        for batch in batches:
            target = np.array([sample.get(i, (False, False))[:2] == (True, True)
                               for i in batch.column(0).to_pylist()], bool)
            part = np.array([strata.get(x, len(strata)) for x in batch.column(2).to_pylist()], np.int64)
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                for k, (bucket, row) in enumerate(_features(data, offsets, hasher, bits)):
                    own = part[lo:hi][row]
                    for p in np.unique(own).tolist():
                        here = own == p
                        total[0, p, k] += np.bincount(bucket[here], minlength=size)
                        total[1, p, k] += np.bincount(bucket[here & target[lo:hi][row]], minlength=size)
        flat = total.reshape(2, -1)
        some = np.flatnonzero(flat[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(flat[0][some]), pa.array(flat[1][some])],
            names=["bucket", "raw", "target"])

    sums = (docs.mapInArrow(count, "bucket int, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    rows = sums.toPandas()  # at most (strata + 1) * FAMILIES * 2**bits rows
    counts = np.zeros((2, (len(strata) + 1) * FAMILIES * size))
    counts[0, rows.bucket] = rows.raw
    counts[1, rows.bucket] = rows.target
    raw, target = counts.reshape(2, len(strata) + 1, FAMILIES, size)
    totals = raw.sum(axis=2, keepdims=True), target.sum(axis=2, keepdims=True)
    share = totals[1] / np.maximum(totals[0], 1)
    p = (target + 0.5 * share) / np.maximum(totals[1] + 0.5 * size * share, 1e-9)
    q = (raw + 0.5) / (totals[0] + 0.5 * size)
    ratio = np.where(totals[1] > 0, np.log(np.maximum(p, 1e-300) / q), 0)
    return (ratio - (p * ratio).sum(axis=2, keepdims=True)).astype(np.float32)


def _plain_words(data: np.ndarray, offsets: np.ndarray, hasher: RollingHash) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct words of each text, without case and
    punctuation (both of ASCII)."""
    data = PLAIN[data]
    starts, ends, row = word_bounds(data, offsets)
    words = hasher(data, starts, ends).view(np.int64) if len(starts) else np.zeros(0, np.int64)
    order = np.lexsort((words, row))
    row, words = row[order], words[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (words[1:] != words[:-1])
    return row[new], words[new]


def _toxic_words(docs: DataFrame, sample: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, of the words that tell toxic documents, and their log
    ratios. A word counts once a document."""
    learn = {i: toxic for i, (_, model, toxic) in sample.items() if model}
    some = sum(learn.values())
    none = np.zeros(0, np.int64), np.zeros(0)
    if not 0 < some < len(learn):
        return none

    def count(batches):
        hasher = RollingHash()
        for batch in batches:
            known = [learn.get(i) for i in batch.column(0).to_pylist()]
            own = np.array([x is not None for x in known], bool)
            toxic = np.array([x for x in known if x is not None], bool)
            for lo, hi, data, offsets in text_slices(batch.column(1).filter(pa.array(own))):
                row, words = _plain_words(data, offsets, hasher)
                each, which = np.unique(words, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(each), pa.array(np.bincount(which, minlength=len(each)).astype(np.int64)),
                     pa.array(np.bincount(which[toxic[lo:hi][row]], minlength=len(each)).astype(np.int64))],
                    names=["word", "documents", "toxic"])

    sums = (docs.mapInArrow(count, "word long, documents long, toxic long").groupBy("word")
            .agg(F.sum("documents").alias("n"), F.sum("toxic").alias("t")))
    # a word has e toxic documents by chance; TOLD is how far above that its count must be
    share = some / len(learn)
    sums = (sums.withColumn("e", F.col("n") * share).withColumn("ratio", F.log((F.col("t") + 1) / (F.col("e") + 1)))
            .where(f"t > 0 and t * ln(t / e) - t + e > {TOLD} and ratio > 0.5"))
    rows = sums.select("word", "ratio").toPandas().sort_values("word")  # few: words of the bounded label sample
    return rows.word.to_numpy(np.int64), rows.ratio.to_numpy(float)


def _weigh(ratios: np.ndarray, toxic_words: tuple[np.ndarray, np.ndarray], sample: dict, strata: dict):
    size = ratios.shape[2]
    bits = int(size).bit_length() - 1
    flat = [ratios[:, k].ravel() for k in range(FAMILIES)]
    told, ratio = toxic_words

    def weigh(batches):
        hasher = RollingHash()
        for batch in batches:
            n = batch.num_rows
            weight, toxic = np.zeros(n), np.zeros(n)
            part = np.array([strata.get(x, len(strata)) for x in batch.column(2).to_pylist()], np.int64)
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                for k, (bucket, row) in enumerate(_features(data, offsets, hasher, bits)):
                    grams = np.bincount(row, minlength=hi - lo)
                    weight[lo:hi] += (np.bincount(row, flat[k][part[lo:hi][row] * size + bucket], hi - lo)
                                      / (grams + SHRINK))
                if len(told):
                    row, words = _plain_words(data, offsets, hasher)
                    at = np.minimum(np.searchsorted(told, words), len(told) - 1)
                    hit = told[at] == words
                    toxic[lo:hi] += np.bincount(row[hit], ratio[at[hit]], hi - lo)
            known = [sample.get(i) for i in batch.column(0).to_pylist()]
            good = [None if s is None or s[1] else s[0] for s in known]
            is_toxic = [None if s is None or s[1] else s[2] for s in known]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(weight), pa.array(toxic), pa.array(good, pa.bool_()), pa.array(is_toxic, pa.bool_())],
                names=["doc_id", "row_key", "base_weight", "toxic_weight", "held_out_good", "held_out_toxic"])

    return weigh


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The cut with the fewest errors, either kind of document weighing the
    same; midway between its neighbours."""
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order].astype(bool)
    kept_good = g.sum() - np.concatenate([[0], np.cumsum(g)])
    dropped_bad = np.concatenate([[0], np.cumsum(~g)])
    value = kept_good / max(1, g.sum()) + dropped_bad / max(1, (~g).sum())
    value[1:-1][w[1:] == w[:-1]] = -1  # no cut between equal weights
    at = int(np.argmax(value))
    if at == 0:
        return float("-inf")
    if at == len(w):
        return float("inf")
    return float(w[at - 1] + w[at]) / 2


def importance_resample(docs: DataFrame, labels: DataFrame, *, stratum: str | None = None,
                        row_key: str | None = None, bits: int = 15, share: float = 0.5,
                        label_bound: int = 20_000, good_loss: float = 0.01, seed: int = 7) -> DataFrame:
    """``(doc_id, log_weight, sample_key, selected, keep)``, one row per row of
    ``docs`` (doc_id, text and the ``stratum`` column, if one is named; further
    columns are ignored).

    ``selected``: the row is in the sample of k = round(``share`` * rows) rows,
    those of the greatest ``sample_key``, the log weight plus Gumbel noise (a
    hash of doc_id and ``seed``). ``keep``: the row is not rejected by the cuts
    chosen on labels.

    ``stratum``: a column such as the language; every value that good labelled
    documents have gets models of its own, and documents of other strata, for
    which nothing is known, have no n-gram ratios.
    ``row_key``: a long column that is returned too, to find rows again.
    ``bits``: buckets of a family as a power of two. ``good_loss``: the share
    of held-out good documents that either cut may drop. ``label_bound``: labelled
    documents of either kind that are used, at most; raw counts, weights, the
    draw and the classification cover every document. Toxic documents are told
    by the words of the same labelled ones.

    A null or empty text has no n-grams and log weight 0. Equal keys go to the
    smaller doc_id; a null doc_id is unlabelled and comes first. Without good
    labels, without others, or without documents nothing is rejected. Repeated
    rows are weighed and drawn each for itself, with equal noise; a labelled
    doc_id of several rows counts once for the cuts, with its least weight.
    """
    named = F.col(stratum) if stratum else F.lit(None)
    key = F.col(row_key) if row_key else F.lit(None)
    docs = docs.select("doc_id", "text", named.cast("string").alias("stratum"), key.cast("long").alias("row_key"))
    sample = _label_sample(labels, label_bound)
    strata = _strata(docs, sample)
    kinds = {g for g, _, _ in sample.values()}
    ratios = (_ratios(docs, sample, strata, bits) if len(kinds) == 2
              else np.zeros((len(strata) + 1, FAMILIES, 1 << bits), np.float32))
    toxic_words = _toxic_words(docs, sample)
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weighed = cut_lineage(
        docs.mapInArrow(_weigh(ratios, toxic_words, sample, strata), "doc_id long, row_key long, base_weight double, "
                        "toxic_weight double, held_out_good boolean, held_out_toxic boolean"), "quality-weights")
    held = (weighed.where("held_out_good is not null").groupBy("doc_id")
            .agg(F.min("base_weight").alias("base_weight"), F.max("toxic_weight").alias("toxic_weight"),
                 F.first("held_out_good").alias("good"), F.first("held_out_toxic").alias("toxic")))
    held = held.orderBy("doc_id").toPandas()  # at most 2 * label_bound rows, one for each labelled doc_id
    good, toxic = held.good.to_numpy(bool), held.toxic.to_numpy(bool)
    # what a good document's toxic words may add up to
    told = held.toxic_weight.to_numpy()
    upto = (-min(best_cut(-told[good | toxic], good[good | toxic]),
                 np.quantile(-told[good], good_loss, method="lower")) if good.any() and toxic.any() else float("inf"))
    weights, good = held.base_weight.to_numpy()[told <= upto], good[told <= upto]
    cut = (min(best_cut(weights, good), np.quantile(weights[good], good_loss, method="lower"))
           if 0 < good.sum() < len(good) else float("-inf"))
    clean = F.col("toxic_weight") <= float(upto)
    drop = F.when(clean, F.lit(0.0)).otherwise(F.col("toxic_weight") + BELOW)
    weighed = (weighed.withColumn("log_weight", F.col("base_weight") - drop)
               .withColumn("keep", clean & (F.col("log_weight") >= cut))
               .withColumn("sample_key", F.col("log_weight") - F.log(-F.log(uniform))))
    k = round(share * weighed.count())
    ranked = running(weighed.withColumn("_down", -F.col("sample_key")), ["_down", "doc_id"],
                     F.lit(1), "rank", "quality-ranks")
    return ranked.select("doc_id", *([F.col("row_key").alias(row_key)] if row_key else []), "log_weight", "sample_key",
                         (F.col("rank") <= k).alias("selected"), "keep")
