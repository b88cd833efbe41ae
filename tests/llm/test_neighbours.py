import numpy as np
import pytest
from pyspark.sql import functions as F

from haulwise.llm import neighbours
from haulwise.llm.queries import op11_neighbours

SCHEMA = "vec_id long, embedding array<float>, rank int, node long, score string"


def cosine(a, b):
    n = max(len(a), len(b))
    a, b = (np.pad(np.array(x, np.float64), (0, n - len(x))) for x in (a, b))
    return float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)))


def brute(rows, every=50, k=5):
    """Per query row, its answers as a sorted list of (score, vec_id)."""
    rows = [(i, v) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for at, (i, v) in enumerate(rows):
        if i % every == 0:
            best = sorted((-round(cosine(v, w), 12), j) for other, (j, w) in enumerate(rows) if other != at)[:k]
            out.setdefault(i, []).append(best)
    return {i: sorted(x) for i, x in out.items()}


def answers(df):
    by = {}
    for r in df.collect():
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return by


def test_query_matches_brute_force(spark, small_dir):
    sf = small_dir.replace("sf0.001", "sf0.01")
    want = brute([tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    got = answers(op11_neighbours(spark, sf))
    assert set(got) == set(want)
    for i, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        assert [(-round(s, 12), j) for _, j, s in rows] == want[i][0]


def test_recall_where_the_graph_is_needed(spark, stored):
    """Few entries and small blocks, so that the search depends on the descent."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x[:600] = x[0] + rng.normal(size=(600, 32)) * 0.3  # a crowded corner
    df = stored([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = answers(neighbours.nearest_neighbours(df, F.pmod("vec_id", F.lit(50)) == 0, beam=96, block=64, trees=2, neighbours=16,
                                                reverse=12, degree=24, entries=16, rounds=6))
    want = brute([(k, v.tolist()) for k, v in enumerate(x)])
    hits = sum(len({j for _, j, _ in got[i]} & {j for _, j in want[i][0]}) for i in want)
    assert hits >= 0.93 * 5 * len(want)


def test_odd_rows(stored):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [(0, v), (50, v), (50, v), (50, [2.0, 4.0, 6.0]), (3, [1.0, 2.0]), (4, [0.0, 0.0, 0.0]), (5, []), (6, None),
            (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]), (9, [None, 1.0, 1.0]), (None, v), (100, [-1.0, 0.0, 0.0]),
            (150, None), (200, [0.0, 0.0, 0.0]), (10, [1e30, 5e30, -3e30]), (11, [1e-30, 0.0, 0.0]), (12, [-0.0, 1.0, 0.0]), (12, [0.0, 1.0, 0.0])]
    df = stored([(*r, 1, 2, "x") for r in rows], SCHEMA)
    got = neighbours.nearest_neighbours(df, F.pmod("vec_id", F.lit(50)) == 0).collect()
    mine = {}
    for r in got:
        mine.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])  # as stored, in single precision
    assert set(mine) == set(want) == {0, 50, 100}
    assert len(mine[50]) == 15 and len(mine[0]) == len(mine[100]) == 5
    for i in (0, 100):
        assert [(-round(s, 9), j) for _, j, s in sorted(mine[i])] == [(round(s, 9), j) for s, j in want[i][0]]


def test_fewer_rows_than_asked_for(stored):
    df = stored([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = neighbours.nearest_neighbours(df, F.col("vec_id") == 0).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1), (2, 2)]
    one = stored([(0, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest_neighbours(one, F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("rows", [[], [(0, None), (50, [])]])
def test_nothing_to_index(stored, rows):
    df = stored(rows, "vec_id long, embedding array<float>")
    assert neighbours.nearest_neighbours(df, F.pmod("vec_id", F.lit(50)) == 0).count() == 0


def test_a_third_of_the_rows_is_one_vector(stored):
    rng = np.random.default_rng(5)
    rows = [(k, ([1.0] * 8 if k % 3 == 0 else rng.normal(size=8).tolist())) for k in range(900)]
    df = stored(rows, "vec_id long, embedding array<float>")
    got = answers(neighbours.nearest_neighbours(df, F.pmod("vec_id", F.lit(50)) == 0))
    copies = [k for k in range(0, 900, 3)]
    for i in range(0, 900, 150):
        assert [j for _, j, _ in sorted(got[i])] == [j for j in copies if j != i][:5]
    assert len(got) == 18 and all(len(x) == 5 for x in got.values())
