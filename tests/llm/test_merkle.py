import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from haulwise.llm import merkle
from haulwise.llm.common import in_hash_class
from haulwise.llm.queries import op13_merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(r, text):
    return sha(*(framed(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(hashes, fan):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k:k + fan]) for k in range(0, len(levels[-1]), fan)])
    return levels


def brute(rows, fan=8):
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    order = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        by[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
    trees = {g: tree([leaf_of(r, r.text) for r in by[g]], fan) for g in order}
    over = tree([trees[g][-1][0] for g in order], fan)
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(by[g]):
            changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            fold, siblings = leaf_of(r, lowered(r.text) if changed else r.text), []
            for levels, at in ((trees[g], i), (over, k)):
                for level in levels[:-1]:
                    run, p = level[at // fan * fan:][:fan], at % fan
                    siblings += run[:p] + run[p + 1:]
                    fold, at = sha(*run[:p], fold, *run[p + 1:]), at // fan
            out.append((r.doc_id, trees[g][0][i], trees[g][-1][0], over[-1][0], sha(*siblings), fold, fold == over[-1][0]))
    return sorted(out, key=str)


def got(df, **options):
    return sorted(map(tuple, merkle.document_manifest(df, in_hash_class("doc_id", 3, 0), **options).collect()), key=str)


def test_query_matches_brute_force(spark, small_dir, docs):
    rows = op13_merkle(spark, small_dir)
    assert rows.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, rows.collect()), key=str) == brute(docs.collect())


@pytest.mark.parametrize("fan,most", [(2, 0), (3, 5)])
def test_any_fan_and_both_parts_of_the_climb(docs, fan, most):
    assert got(docs, fan=fan, most_broadcast=most) == brute(docs.collect(), fan)


def test_odd_rows(odd_docs):
    assert got(odd_docs) == brute(odd_docs.collect())


def test_many_groups_and_lone_leaves(stored):
    rows = [(k, None if k % 7 == 0 else f"text {k}", None if k % 11 == 0 else f"l{k % 40}" if k % 3 else f"only{k}", "S", k)
            for k in range(400)] + [(None, "A", "", "s", None)] * 20 + [(3, "B", "l3", None, 1)] * 3
    df = stored(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(df) == brute(df.collect()) and got(df, most_broadcast=3) == brute(df.collect())


@pytest.mark.parametrize("n", [1, 9, 64])
def test_one_group(stored, n):
    df = stored([(k, f"Text {k}", "en", "s", k) for k in range(n)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = got(df)
    assert rows == brute(df.collect()) and all(r[2] == r[3] for r in rows)


def test_no_rows(no_docs):
    assert got(no_docs) == []


def test_a_group_spread_over_ranges_is_numbered(spark, stored):
    df = stored([("a", k % 50) for k in range(3000)] + [("b", 1)], "g string, v int").withColumn("_row", F.monotonically_increasing_id())
    rows = merkle.numbered(df, "g", ["v", "_row"]).collect()
    a = sorted((r.place, r.v) for r in rows if r.g == "a")
    assert [p for p, _ in a] == list(range(3000)) and [v for _, v in a] == sorted(v for _, v in a)
    assert {(r.g, r.total) for r in rows} == {("a", 3000), ("b", 1)}
