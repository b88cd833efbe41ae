import hashlib

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from haulwise.llm.common import read_ranks
from tests.llm.test_bpe_lm import PATH, PATTERN
from tests.llm.test_filters import reference_spans
from tests.llm.test_simhash import brute, least_reachable

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small_dir, docs, tmp_path_factory):
    """What goes into and comes out of every stage, stored."""
    root, out, now = str(tmp_path_factory.mktemp("stages")), [], docs
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, now, small_dir).write.parquet(f"{root}/{k}")
        after = spark.read.parquet(f"{root}/{k}")
        out.append((now, after))
        now = after
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(stages):
    assert 4 <= len(pipeline.STAGES) <= 5 and pipeline.ORACLE_SQL is None
    for _, after in stages[:-1]:
        assert after.columns == COLUMNS


def test_quality_keeps_clean_documents(spark, small_dir, stages):
    labels = by_id(spark.read.parquet(f"{small_dir}/labels.parquet"))
    before, after = map(by_id, stages[0])
    clean = [i for i in before if i in labels and labels[i].quality == 1 and not labels[i].toxic]
    assert sum(i in after for i in clean) >= 0.98 * len(clean)
    assert all(after[i] == before[i] for i in after)


def test_near_duplicates_keep_one_each(stages):
    before, after = map(by_id, stages[1])
    roots = least_reachable({i: brute(r.text) for i, r in before.items()}, 2)
    assert set(after) == {i for i in before if roots[i] == i}


def test_leaks_go(spark, small_dir, stages):
    before, after = map(by_id, stages[2])
    items = [r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    leaks = {i for i, r in before.items() if any(t in r.text for t in items)}
    assert not leaks & set(after) and len(set(before) - set(after) - leaks) <= 1


def test_secrets_go_and_the_rest_stays(stages):
    before, after = map(by_id, stages[3])
    assert set(before) == set(after)
    for i, r in before.items():
        if not reference_spans(r.text):
            assert after[i] == r
        assert not [s for s in reference_spans(after[i].text) if not s.startswith("hex")]


def test_last_stage_encodes_what_is_left(stages):
    before, after = map(by_id, stages[4])
    with open(PATH, "rb") as f:
        encoding = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    assert set(before) == set(after)
    for i, r in before.items():
        ids = encoding.encode_ordinary(r.text)
        assert after[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert after[i].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_stages_take_odd_rows(spark, small_dir, odd_docs, no_docs, tmp_path):
    for start in (odd_docs.select(*COLUMNS), no_docs):
        now, n = start, start.count()
        for k, (_, stage) in enumerate(pipeline.STAGES):
            path = str(tmp_path / f"{n}-{k}")
            stage(spark, now, small_dir).write.parquet(path)
            now = spark.read.parquet(path)
            assert now.count() <= n
            if k == 1 and n:  # of the copies 0, 7, 7 and 10 one is left, whatever quality did
                assert now.where("doc_id in (0, 7, 10)").count() <= 1
        assert now.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_repeated_rows_leave_one(spark, small_dir, stored):
    docs = stored([(1, "alpha beta gamma delta", "en", "s", 1)] * 2 + [(2, "other words altogether here", "en", "s", 1)],
                  "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.near_duplicate_stage(spark, docs, small_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert kept.agg(F.count("*")).first()[0] == 2


def test_rows_of_one_id_are_judged_each_for_itself(spark, small_dir, stored, docs, stages):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    item = spark.read.parquet(f"{small_dir}/benchmark.parquet").first().text
    clean = [(None, f"clean text number {k} about rivers, hills and {k * k} old towns", "en", "s", 1) for k in range(5)]
    got = pipeline.decontamination_stage(spark, stored([*clean, (None, item, "en", "s", 1), (7, item, "en", "s", 1)], schema), small_dir)
    assert sorted(r.text for r in got.collect()) == sorted(c[1] for c in clean)
    text = "alpha beta gamma delta epsilon zeta"
    copies = [(5, text, "en", "s", 1), (None, text, "en", "s", 1), (None, "other words altogether here", "en", "s", 1),
              (5, text, "en", "another source", 1)]
    got = pipeline.near_duplicate_stage(spark, stored(copies, schema), small_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("5", text), ("None", "other words altogether here")]
    before, after = map(by_id, stages[0])
    bad = [r for i, r in before.items() if i not in after]
    assert bad
    rows = [tuple(r) for r in before.values()] + [(None, *r[1:]) for r in [*map(tuple, bad), *map(tuple, after.values())]]
    got = pipeline.quality_stage(spark, stored(rows, schema), small_dir).where("doc_id is null").collect()
    assert 0 < len(got) < len(before) and sum(r.text in {b.text for b in bad} for r in got) <= 0.5 * len(bad)


def test_columns_of_the_stages_own_names(spark, small_dir, stored):
    """A column like the one that a stage numbers rows with stays as it is."""
    rows = [(k, f"clean words of text number {k} about rivers and towns", "en", "s", 1, -k, k, "x") for k in range(6)]
    docs = stored(rows, "doc_id long, text string, lang string, source string, n_chars long, _row_key long, _ROW_KEY_ long, at string")
    for stage in (pipeline.quality_stage, pipeline.near_duplicate_stage, pipeline.decontamination_stage, pipeline.secret_stage):
        got = stage(spark, docs, small_dir)
        assert got.columns == docs.columns
        assert {tuple(r) for r in got.collect()} <= set(rows)
    assert got.count() == 6
