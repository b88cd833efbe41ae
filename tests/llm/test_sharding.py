import random
import zlib

import pytest

from haulwise.llm import sharding
from haulwise.llm.queries import op3_sharding


def least_capacity(sizes, shards):
    def packs(c):
        n, held = 1, 0
        for s in sizes:
            if held + s > c:
                n, held = n + 1, 0
            held += s
        return n <= shards
    c = max([*sizes, 0])
    while not packs(c):
        c += 1
    return c


@pytest.mark.parametrize("seed,n,shards,most", [(1, 50, 7, 8), (2, 400, 40, 16), (3, 5, 40, 4), (4, 300, 3, 1000), (5, 1, 1, 4)])
def test_cuts_are_minimax(spark, seed, n, shards, most):
    rng = random.Random(seed)
    sizes = [rng.choice([16, 17, 20, 300, rng.randint(16, 90)]) for _ in range(n)]
    ends = [sum(sizes[:k + 1]) for k in range(n)]
    groups = spark.createDataFrame(list(zip(ends, sizes)), "end long, size long")
    capacity, cuts = sharding.shard_groups(groups, shards, most_known=most)
    assert capacity == max(least_capacity(sizes, shards), -(-sum(sizes) // shards))
    widths = [b - a for a, b in zip([0, *cuts], cuts)]
    assert cuts[-1] == ends[-1] and set(cuts) <= {0, *ends} and max(widths) <= capacity and min(widths) >= 0


def test_query_on_whole_table(spark, small_dir, texts):
    rows = op3_sharding(spark, small_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by_shard, of_text = {}, {}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        by_shard.setdefault(r.shard, []).append(r)
        of_text.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert set(by_shard) <= set(range(40)) and all(len(s) == 1 for s in of_text.values())
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    size = {}
    for i, t in texts.items():
        size[t] = size.get(t, 0) + len(t.encode()) + 16
    sizes = [size[t] for t in sorted(first, key=first.get)]
    assert max(sum(r["size"] for r in own) for own in by_shard.values()) == least_capacity(sizes, 40)


def test_odd_rows(odd_docs, no_docs):
    rows = sharding.shard_documents(odd_docs, shards=4).collect()
    assert len(rows) == odd_docs.count()
    null = [r for r in rows if r.doc_id in (1, 13)]
    assert {(r["size"], r.text_crc32) for r in null} == {(16, None)} and len({r.shard for r in null}) == 1
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.shard_documents(no_docs).count() == 0
