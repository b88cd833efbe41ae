import random

import pytest

from haulwise.llm import decontam
from haulwise.llm.queries import op6_decontam


def brute_align(item, passage):
    best = 0
    table = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if a == b else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


@pytest.mark.parametrize("seed", range(6))
def test_alignment_matches_the_full_table(seed):
    rng = random.Random(seed)
    words = "abcdef"[:rng.randint(2, 6)]
    item, passage = (rng.choices(words, k=rng.randint(1, n)) for n in (20, 60))
    assert decontam.align(item, passage)[0] == brute_align(item, passage)


def test_exact_copies_of_the_table_are_found(spark, small_dir, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in texts.items() for i, p in items.items() if p in t}
    rows = op6_decontam(spark, small_dir).collect()
    got = {(r.doc_id, r.item_id): r.score for r in rows}
    assert want and want <= set(got) and all(got[x] == 1.0 for x in want)
    assert len(got) - len(want) <= 1


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(5)
    vocabulary = [f"w{k}x" for k in range(3000)] + ["the", "of", "in"] * 400
    say = lambda n: rng.choices(vocabulary, k=n)
    items = {k: say(30) for k in range(20)}
    docs, want = {}, set()
    for d in range(120):
        body = say(rng.randint(50, 400))
        if d < 60:
            i = d % 20
            copy = [w if rng.random() > (0, 0.1, 0.2)[d // 20] else rng.choice(vocabulary) for w in items[i]]
            if d % 5 == 4:
                copy = copy[:10] + say(3) + copy[10:]
            at = rng.randint(0, len(body))
            body = body[:at] + copy + body[at:]
            want.add((d, i))
        docs[d] = " ".join(w.upper() if d % 3 == 1 else w + "," if d % 7 == 0 else w for w in body)
    hot = " ".join(items[3])
    for d in range(1000, 1400):  # one passage in most documents
        docs[d] = " ".join(say(20)) + ".\n" + hot
        want.add((d, 3))
    return docs, {k: " ".join(v) for k, v in items.items()}, want


@pytest.mark.parametrize("most_words", [10 ** 6, 100])
def test_edited_copies_are_found(stored, planted, most_words):
    docs, items, want = planted
    rows = decontam.find_leaks(stored(list(docs.items()), "doc_id long, text string"),
                               stored(list(items.items()), "item_id long, text string"), most_words=most_words).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert len(rows) == len(want)


def test_odd_rows(odd_docs, no_docs, stored):
    items = stored([(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "fox jumps"), (None, "x y z"),
                    (5, "quick brown fox jumps over the lazy dog"), (1, "quick brown fox jumps over the lazy dog")],
                   "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(odd_docs, items).collect()}
    assert got == {(d, i) for d in (0, 7, 10) for i in (1, 5)}
    assert decontam.find_leaks(no_docs, items).count() == 0
    assert decontam.find_leaks(odd_docs, items.limit(0)).count() == 0


def test_items_without_an_id_and_parts_of_long_items(stored):
    rng = random.Random(9)
    say = lambda n: [f"{rng.choice('bcdfg')}{rng.randint(0, 4000)}" for _ in range(n)]
    long, short, lost = say(400), say(20), say(30)
    docs = [(1, " ".join(say(30) + long[50:150] + say(30))), (2, " ".join(say(200))), (3, " ".join(say(9) + lost)),
            (4, " ".join(say(30) + long[200:230] + say(30))), (5, " ".join(short + say(50)))]
    items = [(10, " ".join(long)), (None, " ".join(lost)), (11, " ".join(short)), (11, " ".join(say(25)))]
    rows = decontam.find_leaks(stored(docs, "doc_id long, text string"), stored(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 10), (3, None), (5, 11)}
    scores = {r.doc_id: r.score for r in rows}
    assert scores[1] == pytest.approx(0.25) and scores[3] == scores[5] == 1.0
