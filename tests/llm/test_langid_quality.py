import zlib

import numpy as np
from pyspark.sql import functions as F

from haulwise.llm import langid, quality
from haulwise.llm.queries import op2_langid, op10_quality


def test_held_out_languages_are_right(spark, docs, small_dir):
    got = op2_langid(spark, small_dir)
    joined = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(joined) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in joined)
    held = [r for r in joined if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in joined)


def test_codewords_are_apart():
    for n in range(2, 40):
        code = langid.codewords(n)
        assert code.shape[0] == n and set(np.unique(code)) == {-1, 1}
        least = min(int((code[a] != code[b]).sum()) for a in range(n) for b in range(a))
        assert least >= (1 if n == 2 else 2 if n < 8 else 3)
        assert (np.abs(code.sum(axis=0)) < n).all()  # no bit is the same for all


def test_languages_of_odd_rows(odd_docs):
    model = langid.fit(odd_docs, F.lit(True))
    got = {r.doc_id: r for r in langid.predict(odd_docs, *model).collect()}
    assert langid.predict(odd_docs, *model).count() == odd_docs.count()
    for i in (1, 2, 3, 9, 13):
        assert got[i].lang_pred == "und" and got[i].score == 0
    assert got[8].lang_pred == "de" and got[0].lang_pred == "en"


def test_nothing_learned(odd_docs, no_docs):
    model = langid.fit(no_docs, F.lit(True))
    assert {r.lang_pred for r in langid.predict(odd_docs, *model).collect()} == {"und"}
    assert langid.predict(no_docs, *model).count() == 0


def test_one_language(stored):
    only = stored([(1, "some words", "en"), (2, "other words", "en")], "doc_id long, text string, lang string")
    got = langid.predict(only, *langid.fit(only, F.lit(True))).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("en", 1.0)}


def test_quality_parts_labelled_documents(spark, small_dir):
    sf = small_dir.replace("sf0.001", "sf0.01")
    got = op10_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r.keep for r in got if r.quality == 1 and not r.toxic]
    bad = [r.keep for r in got if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_toxic_documents_go_whatever_their_length(spark, small_dir, stored):
    sf = small_dir.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    clean = docs.join(labels.where("quality = 1 and toxic = 0"), "doc_id", "left_semi").orderBy(F.desc("n_chars"), "doc_id").limit(40)
    planted = clean.select((F.col("doc_id") + 10 ** 9).alias("doc_id"), F.concat("text", F.lit(
        " You IDIOT, what trash! A stupid loser and a moron, pathetic and worthless.")).alias("text"), "lang")
    both = docs.select("doc_id", "text", "lang").unionByName(planted)
    rows = both.select("doc_id", "text", "lang").collect()
    got = quality.importance_resample(stored([tuple(r) for r in rows], "doc_id long, text string, lang string"),
                                      labels, stratum="lang").join(labels, "doc_id", "left").collect()
    added = [r.keep for r in got if r.doc_id >= 10 ** 9]
    toxic = [r.keep for r in got if r.quality == 1 and r.toxic]
    good = [r.keep for r in got if r.quality == 1 and not r.toxic]
    assert len(added) == 40 and sum(added) <= 2
    assert sum(toxic) <= 0.3 * len(toxic) and sum(good) >= 0.985 * len(good)


def test_kept_are_the_top_keys(spark, small_dir):
    rows = op10_quality(spark, small_dir).collect()
    keys = sorted((-r.sample_key, r.doc_id, r.selected) for r in rows)
    k = sum(r.selected for r in rows)
    assert [x[2] for x in keys] == [True] * k + [False] * (len(rows) - k)


def test_the_draw_follows_the_weights(spark, small_dir, docs):
    """Over many seeds a document is in the sample as often as in a brute-force
    draw without replacement in proportion to the weights."""
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    some = docs.where("doc_id < 40")
    times, weights, rounds = {}, {}, 12
    for seed in range(rounds):
        rows = quality.importance_resample(some, labels, stratum="lang", share=0.3, seed=seed).collect()
        assert sum(r.selected for r in rows) == round(0.3 * len(rows))
        for r in rows:
            times[r.doc_id] = times.get(r.doc_id, 0) + r.selected
            weights[r.doc_id] = r.log_weight
    rng = np.random.default_rng(0)
    ids, w = list(weights), np.array(list(weights.values()))
    w = np.maximum(w, w.max() - 60)
    p = np.exp(w - w.max()) / np.exp(w - w.max()).sum()
    want = np.zeros(len(ids))
    for _ in range(2000):
        want[rng.choice(len(ids), round(0.3 * len(ids)), replace=False, p=p)] += 1 / 2000
    got = np.array([times[i] for i in ids]) / rounds
    assert np.corrcoef(got, want)[0, 1] > 0.7 and abs(got - want).mean() < 0.2
    assert (got > 0).sum() > round(0.3 * len(ids))  # not the same top k each time


def test_a_labelled_id_of_many_rows_counts_once(stored, docs, spark, small_dir):
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    one = labels.where("quality = 1 and toxic = 0").first().doc_id
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    many = rows + [r for r in rows if r[0] == one] * 300
    schema = "doc_id long, text string, lang string"
    kept = [{r.doc_id: r.keep for r in quality.importance_resample(stored(x, schema), labels, stratum="lang").collect()} for x in (rows, many)]
    assert sum(kept[0][i] != kept[1][i] for i in kept[0]) <= 0.05 * len(kept[0])


def test_best_cut():
    assert quality.best_cut(np.array([1.0, 2.0, 8.0, 9.0]), np.array([0, 0, 1, 1])) == 5.0
    assert quality.best_cut(np.array([1.0, 1.0]), np.array([1, 1])) == float("-inf")
    assert quality.best_cut(np.array([1.0, 1.0, 3.0]), np.array([0, 1, 1])) == 2.0


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, None), (9, 0, 0), (4, 1, 0), (11, 0, 1), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.importance_resample(odd_docs, labels)
    assert got.count() == odd_docs.count() and got.where("doc_id in (1, 2, 13) and log_weight <> 0").count() == 0
    none = labels.limit(0)
    assert quality.importance_resample(odd_docs, none).where("not keep").count() == 0
    assert quality.importance_resample(no_docs, labels).count() == 0
