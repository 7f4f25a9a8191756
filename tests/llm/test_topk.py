import math

import numpy as np
import pytest

from tidelake.llm import topk_search as t

ENDS = (-(2**63), 2**63 - 1)


def brute(rows, k=5):
    vs = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vs.append((i, [max(-(2**62), min(2**62, math.floor(256 * float(x)))) for x in v]))
    out = []
    for q in {i for i, _ in vs if i % 50 == 0}:
        scored = sorted((-max(ENDS[0], min(ENDS[1], sum(a * b for a, b in zip(w, v)))), i) for j, w in vs if j == q for i, v in vs if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows):
    vectors = t.cut(t.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    return sorted(tuple(r) for r in t.search(vectors, vectors.where("vec_id % 50 = 0")).collect())


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(t, "BLOCK", 64)
    monkeypatch.setattr(t, "STEPS", (3, 6, 9))
    rng = np.random.default_rng(10)
    rows = [(i, np.float32(rng.normal(size=12) * rng.choice([0.1, 1, 3])).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # many equal vectors, so ties
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")]), (2003, [float("inf"), 1.0]), (None, [1.0]), (2004, []), (2051, [0.5, 0.5]), (2051, [0.25, 0.5])]
    want = brute(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(t, "QUERIES", 8)
    assert run(spark, rows) == want


def test_rows_that_share_an_id_all_count(spark):
    assert run(spark, [(0, [1.0, 0.0]), (7, [2.0, 0.0]), (7, [1.0, 0.0])]) == [(0, 1, 7, 131072), (0, 2, 7, 65536)]


def test_huge_components_stop_at_the_ends_of_a_long(spark):
    rows = [(0, [1e8, 1.0]), (1, [1e8, 2.0]), (2, [-1e300, 1.0]), (3, [1e5, 3.0]), (50, [1e300, 0.0]), (51, [2e7, 2e7])]
    assert run(spark, rows) == brute(rows)


def test_outlines_leave_blocks_out(spark, monkeypatch):
    """Long vectors in one direction, short ones elsewhere: most pairs of blocks never meet."""
    monkeypatch.setattr(t, "BLOCK", 32)
    monkeypatch.setattr(t, "QUERIES", 4)
    met = []
    monkeypatch.setattr(t, "meetings", lambda *a, f=t.meetings: met.append(t.cut(f(*a))) or met[-1])
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * (4.0 if i % 16 == 0 else 0.05)).tolist()) for i in range(960)]
    assert run(spark, rows) == brute(rows)
    assert sum(m.count() for m in met) < 0.5 * (960 / 32) * (20 / 4)


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(i, [float(i % 7), 1.0], 0.0, "x") for i in range(60)], "vec_id long, embedding array<double>, norm double, v string")
    vectors = t.scaled(frame)
    assert t.search(vectors, vectors.where("vec_id % 50 = 0")).count() == 10


@pytest.mark.parametrize("rows", [[(0, [1.0, 2.0])], [(0, [1.0]), (1, [-0.5])], [], [(1, [1.0])]])
def test_few_vectors(spark, rows):
    assert run(spark, rows) == brute(rows)
