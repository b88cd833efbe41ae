import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import numpy as np
import pytest

from haulwise.llm import spelling
from haulwise.llm.queries import op12_spelling

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def edits(word, alphabet):
    out = {word[:k] + word[k + 1:] for k in range(len(word))}
    out |= {word[:k] + c + word[k + 1:] for k in range(len(word)) for c in alphabet}
    return (out | {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in alphabet}) - {word}


def brute(rows):
    total = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}
    alphabet = sorted({c for w in words for c in w})
    near = {w: [x for x in edits(w, alphabet) if x in words] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def got(df, **options):
    rows = spelling.spelling_variants(df, **options)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, rows.collect()))


def test_query_matches_brute_force(spark, small_dir, docs):
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, op12_spelling(spark, small_dir).collect())) == want and any(r[1] for r in want)


def crowd(seed=1, n=700):
    """Words of few letters, so that blocks are full and chains of forms long."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcéÿ") for _ in range(rng.randint(4, 8))) for _ in range(n)}
    rows = []
    for k, w in enumerate(sorted(words)):
        rows.append((10_000 + k, " ".join([w] * rng.choice([1, 2, 3, 4, 7, 15, 40]))))
    return rows


@pytest.mark.parametrize("most_rows", [4096, 16])
def test_full_blocks(stored, most_rows):
    rows = crowd()
    assert got(stored(rows, "doc_id long, text string"), most_rows=most_rows) == brute(rows)


def test_near_pairs():
    words = sorted({w for _, t in crowd(2, 400) for w in t.split()[:1]})
    values, edges = spelling._spelled(pa.array(words))
    every = np.arange(len(words))
    found = set(zip(*(x.tolist() for x in spelling.near_pairs(values, edges, every, every, rows=64)), strict=True))
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_apart(a, b)}


def test_odd_rows(odd_docs, stored):
    assert got(odd_docs) == brute([tuple(r) for r in odd_docs.collect()])
    long = "a" * 5000
    rows = [(None, "Ünder Ünder ünder under UNDER under under under"), (None, "Ünder"), (1, None), (2, ""), (3, "1 2 3 !"),
            (4, f"{long} {long} {long}"), (5, f"{long}b " * 7), (5, f"{long}b " * 7), (6, "colour color\x00colour×colour÷ " * 9)]
    assert got(stored(rows, "doc_id long, text string")) == brute(rows)


def test_no_rows(no_docs):
    assert got(no_docs) == []


def test_chains_of_forms_end(spark):
    chain = spark.createDataFrame([(f"w{k:02}", f"w{k + 1:02}") for k in range(40)], "word string, form string")
    assert {tuple(r) for r in spelling.roots(chain).collect()} == {(f"w{k:02}", "w40") for k in range(40)}
