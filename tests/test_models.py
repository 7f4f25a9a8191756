import random

import pytest

from tidelake.operators import models, ordered


def plain_tree(rows, residual, depth, penalty):
    """Leaf value of each row (bins), by trying every split on the rows themselves."""
    total = sum(residual)
    score = lambda s, n: s * s / (n + penalty)
    best = None
    if depth:
        for f in range(len(rows[0])):
            for edge in sorted({r[f] for r in rows})[:-1]:
                a = [x for r, x in zip(rows, residual) if r[f] <= edge]
                gain = score(sum(a), len(a)) + score(total - sum(a), len(rows) - len(a)) - score(total, len(rows))
                if gain > (best[0] if best else 1e-12) * (1 + 1e-9):
                    best = (gain, f, edge)
    if best is None:
        return [total / (len(rows) + penalty)] * len(rows)
    left = [r[best[1]] <= best[2] for r in rows]
    out = [0.0] * len(rows)
    for side in (True, False):
        at = [i for i, x in enumerate(left) if x is side]
        for i, v in zip(at, plain_tree([rows[i] for i in at], [residual[i] for i in at], depth - 1, penalty)):
            out[i] = v
    return out


def test_boosted_trees_are_those_of_plain_rows(spark):
    rng = random.Random(2)
    day = lambda: rng.randrange(1, 40)
    rows = []
    for i in range(160):
        t, a, b = day(), rng.choice([0.0, 1.0, 2.0, 3.5, 7.0]), round(rng.random(), 2)
        rows.append((f"i{i}", t, t + 3, (a > 1.5) * 2.0 + b * (a < 3) + rng.random() / 10, a, b))
    rows += [("gone", 20, 23, None, 1.0, 0.5), ("blank", 20, 23, 1.0, None, 0.5), ("nan", 20, 23, 1.0, 2.0, float("nan"))]
    times, bins, trees, rate = [10, 20, 30], 4, 6, 0.3
    frame = spark.createDataFrame(rows, "instrument_id string, t long, label_end long, y double, a double, b double")
    got = {(r.instrument_id, r.t): (r.prediction, r.n) for r in models.boosted(frame, ["a", "b"], times, bins, 2, trees, rate).collect()}
    whole = [r for r in rows if r[4] is not None and r[5] == r[5]]
    start = [r for r in whole if r[3] is not None and r[2] <= times[0]]
    edges = [sorted({sorted(r[c] for r in start)[k * len(start) // bins] for k in range(1, bins)}) for c in (4, 5)]
    bin_of = lambda r: tuple(sum(e <= r[c] for e in edges[c - 4]) for c in (4, 5))
    want = {}
    for t in times:
        train = [r for r in whole if r[3] is not None and r[2] <= t]
        asked = [r for r in whole if r[1] == t]
        value = {bin_of(r): sum(x[3] for x in train) / len(train) for r in train}
        for r in asked:
            value.setdefault(bin_of(r), sum(x[3] for x in train) / len(train))
        for _ in range(trees):
            leaf = plain_tree([bin_of(r) for r in train], [r[3] - value[bin_of(r)] for r in train], 2, 1.0)
            step = {bin_of(r): v for r, v in zip(train, leaf)}
            for c in step:
                value[c] += rate * step[c]
        want |= {(r[0], t): (value[bin_of(r)], len(train)) for r in asked if bin_of(r) in {bin_of(x) for x in train}}
    assert want and want.keys() <= got.keys() == {(r[0], r[1]) for r in whole if r[1] in times}
    for k, (value, n) in want.items():
        assert got[k][1] == n and abs(got[k][0] - value) < 1e-9
    assert models.boosted(frame.limit(0), ["a", "b"], times, bins).count() == 0
    with pytest.raises(ValueError):
        models.boosted(frame, ["a", "b"], times, bins=1000)


def test_running_sums_and_ranks_go_on_over_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), i, rng.randrange(9)) for i in range(500)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, part long, n long").repartition(7)
    got = {(r.k, r.part): r.n for r in ordered.running_sums(frame, ["k", "part"], ["n"], within="k").collect()}
    assert got == {(k, i): sum(n for q, j, n in rows if q == k and j <= i) for k, i, _ in rows}
    ranks = {r.part: r.rank for r in ordered.ranked(frame, ["n", "part"]).collect()}
    assert ranks == {i: at for at, (_, i, _) in enumerate(sorted(rows, key=lambda r: (r[2], r[1])))}


def test_elastic_net_shrinks_to_nothing_and_to_least_squares():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3))
    x = (x - x.mean(0)) / x.std(0)
    y = x @ [1.0, -2.0, 0.0]
    corr, target = x.T @ x / 50, x.T @ y / 50
    assert np.allclose(models.elastic_net_beta(corr, target, 0.0, 0.5), [1, -2, 0])
    assert (models.elastic_net_beta(corr, target, 10.0, 1.0) == 0).all()
    beta = models.elastic_net_beta(corr, target, 0.3, 0.5)
    slope = corr @ beta - target + 0.15 * beta  # at the optimum the gradient is within the lasso's bound
    assert np.abs(slope).max() <= 0.15 + 1e-9 and np.allclose(slope[beta != 0], -0.15 * np.sign(beta[beta != 0]))
