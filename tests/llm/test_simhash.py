import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from haulwise.llm import simhash
from haulwise.llm.queries import op1_simhash

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def brute(text):
    words = WORD.findall((text or "").encode().translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k:k + 3]), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(points: dict[int, int], bits: int) -> dict[int, int]:
    root = {k: k for k in points}
    changed = True
    while changed:
        changed = False
        for a, b in combinations(points, 2):
            if (points[a] ^ points[b]).bit_count() <= bits and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def test_query_matches_brute_force(spark, small_dir, texts):
    got = {r.doc_id: r for r in op1_simhash(spark, small_dir).collect()}
    points = {i: brute(t) for i, t in texts.items()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == points
    assert all(len(r.fingerprint) == 16 for r in got.values())
    assert {i: r.component_id for i, r in got.items()} == least_reachable(points, 2)


def clusters(seed):
    """Fingerprints in chains and dense clouds, and far apart."""
    rng = np.random.default_rng(seed)
    out = set(rng.integers(0, 1 << 63, 60).tolist())
    for start in rng.integers(0, 1 << 63, 6).tolist():
        x = start
        for _ in range(15):  # a chain of steps of one to three bits
            x ^= sum(1 << int(b) for b in rng.choice(63, rng.integers(1, 4), replace=False))
            out.add(x)
    cloud = int(rng.integers(0, 1 << 63))
    out |= {cloud ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 3), replace=False)) for _ in range(200)}
    return sorted(out)


@pytest.mark.parametrize("seed,bits,crowd", [(1, 2, 64), (2, 2, 4), (3, 0, 64), (4, 4, 64), (5, 4, 6)])
def test_links_join_what_is_near(spark, seed, bits, crowd):
    fps = clusters(seed)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    roots = {r.node: r.root for r in simhash.components(
        simhash.link_fingerprints(df, max_bits=bits, crowd=crowd)).collect()}
    want = least_reachable({x: x for x in fps}, bits)
    assert {x: roots.get(x, x) for x in fps} == want


def test_odd_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.link_fingerprints(spark.createDataFrame([(1,)], "fp long"), max_bits=3)


def test_odd_rows(odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    zero = {1, 2, 3, 13}
    assert all(r.fp == 0 for i in zero for r in by[i]) and {r.component_id for i in zero for r in by[i]} == {1}
    # copies, repeated rows, and the same words in other case and spacing
    assert {r.component_id for i in (0, 7, 10) for r in by[i]} == {0} and len(by[7]) == 2
    assert by[None][0].component_id is None


def test_no_rows(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_many_copies_stay_one_point(spark, stored):
    many = stored([(k, "alpha beta gamma delta epsilon") for k in range(3000)] + [(5000, "other words than those")],
                  "doc_id long, text string")
    got = simhash.near_duplicates(many)
    assert got.where("doc_id < 3000").agg(F.max("component_id")).first()[0] == 0
    assert got.where("doc_id = 5000").first().component_id == 5000


def test_stars_join_what_the_links_join():
    rng = np.random.default_rng(7)
    for n in (1, 5, 60, 400):
        a, b = rng.integers(-90, 90, (2, n))
        node, root = simhash._stars(a, b)
        want = {x: x for x in (*a.tolist(), *b.tolist())}
        for _ in want:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                want[x] = want[y] = min(want[x], want[y])
        assert dict(zip(node.tolist(), root.tolist(), strict=True)) == {x: r for x, r in want.items() if x != r}
        assert (root < node).all()


def test_long_chains_take_few_rounds_and_files(spark, monkeypatch):
    written = []
    cut = simhash.cut_lineage

    def counted(df, name="cut"):
        out = cut(df, name)
        written.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(simhash, "cut_lineage", counted)
    order = np.random.default_rng(3).permutation(500).tolist()  # neighbours on the chain bear no near numbers
    links = spark.createDataFrame([(x, y) for x, y in zip(order, order[1:], strict=False)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    assert roots == {x: 0 for x in range(1, 500)}
    assert len(written) <= 3 and all(files == 1 for _, files in written[1:])


def test_stars_of_many_tasks_are_joined(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TASK_ROWS", 16)
    order = np.random.default_rng(4).permutation(300).tolist()
    links = spark.createDataFrame([(x, y) for x, y in zip(order, order[1:], strict=False)], "a long, b long").repartition(7)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    assert roots == {x: 0 for x in range(1, 300)}
