import random

from pyspark.sql import functions as F

from tidelake.operators import asof


def test_points_meet_just_the_intervals_they_lie_in(spark):
    rng = random.Random(7)
    intervals = []
    for i in range(300):
        start = rng.randrange(-1000, 1000)
        end = None if rng.random() < 0.1 else start + rng.choice([0, 1, 2, 7, 64, 65, 900])
        intervals.append((rng.choice("ab"), i, start if rng.random() > 0.03 else None, end))
    points = [(rng.choice("abc"), rng.randrange(-1100, 2000)) for _ in range(200)] + [("a", 0), ("a", 0)]
    p, i = spark.createDataFrame(points, "k string, t long"), spark.createDataFrame(intervals, "k string, id long, a long, b long")
    got = [(r.k, r.t, r.id) for r in asof.in_intervals(p, i, "k", F.col("t"), F.col("a"), F.col("b")).collect()]
    want = [(k, t, n) for k, t in points for q, n, a, b in intervals if q == k and a is not None and a <= t and (b is None or t < b)]
    assert sorted(got) == sorted(want)
    assert asof.in_intervals(p, i.limit(0), "k", F.col("t"), F.col("a"), F.col("b")).count() == 0


def test_conflicts_are_all_overlapping_pairs(spark):
    rng = random.Random(8)
    rows = []
    for i in range(80):
        a, b = rng.randrange(50), rng.randrange(50)
        rows.append((rng.choice("xy"), i, a, None if rng.random() < 0.2 else a + rng.randrange(9), b, None if rng.random() < 0.2 else b + rng.randrange(20)))
    frame = spark.createDataFrame(rows, "k string, id long, valid_from long, valid_to long, known_from long, known_to long")
    far = 10**9
    full = [(k, i, a, far if b is None else b, c, far if d is None else d) for k, i, a, b, c, d in rows]
    want = {(x[0], x[1], y[1]) for x in full for y in full if x[0] == y[0] and x[1] < y[1] and x[2] < y[3] and y[2] < x[3] and x[4] < y[5] and y[4] < x[5]}
    assert {tuple(r) for r in asof.conflicts(frame, "k", "id").collect()} == want
