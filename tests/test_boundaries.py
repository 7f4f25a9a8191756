"""Literal cases at the edges of the operators' rules."""

import pytest
from pyspark.sql import functions as F

from tidelake.functions import checks as C
from tidelake.functions import times as T
from tidelake.operators import asof, bars, canonical, factors, labels, portfolio, quality, stats, universe


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def texts(df, *columns):
    """values(), of rows that may hold nulls."""
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


def test_asof_bounds_and_order(spark):
    facts = spark.createDataFrame([(1, 0, 10, 1.0), (1, 5, 12, 2.0), (1, 3, 20, 3.0), (2, 0, None, 9.0)], "k int, period_start long, availability long, x double")
    asks = spark.createDataFrame([(1, 9), (1, 10), (1, 12), (1, 30), (2, 50)], "k int, t long")
    # available exactly at t is in; a late-published older period never beats a newer one
    assert values(asof.latest(asks, facts, "k", ["x"]), "t", "x") == [(10, 1.0), (12, 2.0), (30, 2.0)]
    # the age bounds each fact before the latest is chosen
    assert values(asof.latest_within(asks, facts, "k", ["x"], 15), "t", "x") == [(10, 1.0), (12, 2.0), (30, 3.0)]


def test_eligibility_bounds(spark):
    row = spark.range(1)
    seen = lambda *a: row.select(asof.observation_eligible(*(F.lit(x).cast("long") for x in a)).alias("x")).head()[0]
    assert seen(10, 10, None, 10) and not seen(10, 11, None, None) and not seen(10, 5, None, 9) and not seen(10, None, None, None)
    fact = lambda *a: row.select(asof.reference_eligible(*(F.lit(x).cast("long") for x in a)).alias("x")).head()[0]
    assert fact(10, 10, 10, None, 10, None) and not fact(10, 10, 0, 10, 0, None) and not fact(10, 12, 0, None, 11, None) and not fact(10, 10, None, None, 0, None)


def test_bars_ties_duplicates_and_closure(spark):
    t = spark.createDataFrame([("a", 0, "2", 5.0, 1.0, None), ("a", 0, "1", 4.0, 1.0, 7.0), ("a", 10, "3", 6.0, 2.0, None), ("a", 3, "1", 9.0, 1.0, None)], "instrument_id string, ts_us long, trade_id string, price double, quantity double, quote_quantity double")
    made = bars.reconstruct(t, 10)
    assert values(made, "period_start_us", "open", "close", "high", "trade_count", "quote_volume") == [(0, 4.0, 5.0, 5.0, 2, 12.0), (10, 6.0, 6.0, 6.0, 1, 12.0)]
    assert values(bars.reconstruct(t, 10, left_closed=False), "period_start_us") == [(-10,), (0,)]
    assert values(bars.duplicate_trades(t), "trade_id", "occurrences") == [("1", 2)]


def test_incomplete_day_and_null_volumes(spark):
    step = 6 * T.HOUR
    rows = [(1, i * step, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0 if i != 2 else None, 1) for i in range(4)] + [(1, T.DAY + i * step, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1) for i in range(3)]
    b = spark.createDataFrame(rows, "instrument_id int, period_start_us long, open double, high double, low double, close double, base_volume double, quote_volume double, trade_count long")
    assert values(bars.day_completeness(b, step), "day_us", "code") == [(0, None), (T.DAY, "incomplete_utc_day")]
    assert bars.day_completeness(b, 7 * T.HOUR).where("code <> 'unsupported_daily_interval'").count() == 0
    assert values(bars.resample_daily(b.where(F.col("period_start_us") < T.DAY)), "quote_volume", "trade_count") == [(None, 4)]


@pytest.mark.parametrize("flip", [False, True])
def test_duplicates_in_either_order(spark, flip):
    rows = [(1, 5.0, "b"), (1, 5.0, "a"), (2, 5.0, "a"), (2, 6.0, "b")]
    r = spark.createDataFrame(rows[::-1] if flip else rows, "k int, x double, s string")
    assert values(bars.enforce_unique(r, ["k"], ["x"], "s"), "k", "s", "code") == [(1, "a", None), (1, "b", "identical_duplicate"), (2, "a", "conflicting_duplicate"), (2, "b", "conflicting_duplicate")]


def test_ranks_and_weights(spark):
    s = spark.createDataFrame([(0, "a", 1.0), (0, "b", 1.0), (0, "c", -1.0), (1, "a", -2.0), (2, "a", 0.0)], "t int, instrument_id string, score double")
    ranked = s.withColumn("p", factors.average_rank(F.col("score"), "t"))
    assert values(ranked.where("t = 0"), "instrument_id", "p") == [("a", 1.5), ("b", 1.5), ("c", 3.0)]
    assert values(portfolio.sign_weights(s), "t", "instrument_id", "weight") == [(0, "a", 0.25), (0, "b", 0.25), (0, "c", -0.5), (1, "a", -1.0), (2, "a", 0.0)]
    assert values(portfolio.rank_weights(s), "t", "instrument_id", "weight") == [(0, "a", 0.0), (0, "b", 0.5), (0, "c", -0.5), (1, "a", 1.0), (2, "a", 1.0)]


def test_risk_limits(spark):
    w = spark.createDataFrame([(0, "a", 0.9), (0, "b", 0.3), (0, "c", -0.2), (1, "a", 2.0), (1, "b", 0.5)], "t int, instrument_id string, weight double")
    got = {(t, i): x for t, i, x in values(portfolio.limit_risk(w, 1.0, 0.6), "t", "instrument_id", "weight")}
    assert got[(0, "a")] + got[(0, "b")] == pytest.approx(0.2) and got[(0, "c")] == pytest.approx(-0.2)
    assert got[(1, "a")] + got[(1, "b")] == pytest.approx(1.0)


def test_perpetual_book_is_folded_in_order(spark):
    targets = spark.createDataFrame([("s", p, "a", 1.0) for p in (1, 2, 3)], "strategy_id string, period int, instrument_id string, weight double")
    moves = spark.createDataFrame([(1, "a", 0.1, 0.0), (2, "a", -1.0, 0.0), (3, "a", 0.0, 0.01)], "period int, instrument_id string, ret double, funding_rate double")
    got = portfolio.perpetual_account(targets, moves, 0.01, 0.05).orderBy("period").collect()
    assert [r.liquidated for r in got] == [False, True, False] and got[1].net_return == -1.0
    assert got[0].net_return == pytest.approx(0.09) and got[1].turnover == pytest.approx(abs(1 - 1.1 / 1.09))
    assert got[2].turnover == pytest.approx(1.0) and got[2].funding == pytest.approx(-0.01)


def test_purge_leaves_no_overlap(spark):
    e = spark.createDataFrame([(i % 2, str(i), i, i, i + 4) for i in range(40)], "instrument_id int, event_id string, t long, event_start long, event_end long")
    got = labels.walk_forward(e, 15, 5, 2).collect()
    tests = {}
    for r in got:
        if r.role == "test":
            tests.setdefault(r.fold_id, []).append(r)
    assert sorted(tests) == list(range(len(tests)))
    for r in got:
        if r.role == "train":
            assert r.event_end <= min(x.t for x in tests[r.fold_id]) - 2


def test_adjusted_p_values(spark):
    p = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.5)], "strategy string, p_value double")
    got = {r.strategy: r for r in stats.adjust(p, 0.05).collect()}
    assert got["a"].bonferroni == pytest.approx(0.04) and got["d"].bonferroni == 1.0
    assert got["b"].q_value == pytest.approx(0.04 * 4 / 3) and got["c"].q_value == pytest.approx(0.04 * 4 / 3)


def test_time_functions(spark):
    row = spark.range(1)
    one = lambda c: row.select(c.alias("x")).head()[0]
    seconds = lambda s: one(T.decimal_seconds(F.lit(s)))
    assert seconds("1.5") == 1_500_000 and seconds("1.0000001") is None and seconds("1.0000000") == 1_000_000
    assert seconds("-1") is None and seconds("1e3") is None and seconds("4102444800") is None
    assert one(T.floor_to(F.lit(-1).cast("long"), 10)) == -10
    assert one(T.plausible_unit(F.lit(1700000000).cast("long"), 10**15, 2 * 10**15)) == "s"
    assert one(T.plausible_unit(F.lit(5).cast("long"), 10**15, 2 * 10**15)) == "OUT_OF_RANGE"


def test_checks(spark):
    row = spark.range(1)
    one = lambda c: row.select(c.alias("x")).head()[0]
    assert one(C.fits_decimal(F.lit("1.000000000000000000"))) and not one(C.fits_decimal(F.lit("1.0000000000000000001")))
    assert [one(C.value_class(F.lit(x).cast("string"))) for x in (None, " ", "True", "-3", "1e5", "x")] == ["null", "empty", "boolean", "integer", "float", "string"]
    assert one(C.hex_quantity(F.lit("0x" + "f" * 28))) == 2**112 - 1 and one(C.hex_quantity(F.lit("0x1" + "0" * 28))) is None
    inf, nan = float("inf"), float("nan")
    near = lambda a, b: one(C.close_to(F.lit(a).cast("double"), F.lit(b).cast("double")))
    assert near(1.0, 1.0 + 1e-12) and near(nan, nan) and near(inf, inf) and not near(inf, -inf) and not near(None, 1.0) and near(None, None)


def test_survivors(spark):
    coins = spark.createDataFrame([("live", "2024-01-02", None, True), ("dead", None, "2024-01-05", False), ("lost", None, None, False), ("odd", "?", "never", False)], "instrument_id string, birth string, death string, is_active boolean")
    day = lambda d: (19723 + d - 1) * T.DAY  # noqa: E731  2024-01-01 is day 1
    times = spark.createDataFrame([(day(1),), (day(5),), (day(6),)], "t long")
    got = {(t, i) for t, i in values(universe.survivors(times, coins), "t", "instrument_id")}
    assert got == {(day(1), "dead"), (day(1), "odd"), (day(5), "live"), (day(5), "dead"), (day(5), "odd"), (day(6), "live"), (day(6), "odd")}


def test_fail_closed(spark):
    with pytest.raises(ValueError):
        quality.assert_empty(spark.range(1), "rows")
    quality.assert_empty(spark.range(0), "rows")


def test_lineage_cycle_shows(spark):
    got = universe.closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "child string, parent string"))
    assert got.where("child = ancestor").count() == 3


def test_ridge_equals_a_fit_at_each_time(spark):
    import numpy as np

    from tidelake.operators import models

    rng = np.random.default_rng(1)
    rows = [(str(i), t, t + 2, float(rng.normal()), float(rng.normal()), float(rng.normal())) for t in range(8) for i in range(4)]
    rows += [("x", 3, 5, None, 1.0, 1.0), ("y", 3, 5, 1.0, None, 1.0)]
    got = models.ridge(spark.createDataFrame(rows, "instrument_id string, t long, label_end long, y double, a double, b double"), ["a", "b"], 0.7).collect()
    assert not [r for r in got if r.instrument_id == "y"]
    for r in got:
        train = np.array([x[3:] for x in rows if x[2] <= r.t and None not in x[3:]])
        assert len(train) == r.n >= models.LEAST
        y, x = train[:, 0], train[:, 1:]
        z = (x - x.mean(0)) / x.std(0)
        beta = np.linalg.solve(z.T @ z + 0.7 * np.eye(2), z.T @ (y - y.mean()))
        mine = next(x for x in rows if x[0] == r.instrument_id and x[1] == r.t)
        assert r.prediction == pytest.approx(y.mean() + ((np.array(mine[4:]) - x.mean(0)) / x.std(0)) @ beta)
    assert {r.t for r in got} == {r[1] for r in rows if sum(x[2] <= r[1] and None not in x[3:] for x in rows) >= 5}


def test_funding_meets_positions_by_time_bucket(spark):
    import re

    spans = [(i, "s", 7 * i, 7 * i + (i * 5) % 23, 1.0 + i, 2.0) for i in range(30)] + [(90, "s", 9, 3, 1.0, 1.0), (91, "t", 0, 9, 1.0, 1.0)]
    events = [("s", t, t / 10.0, None if t % 3 else 4.0) for t in range(0, 220, 2)]
    po = spark.createDataFrame(spans, "position_id int, symbol string, start long, end long, quantity double, mark_price double")
    fu = spark.createDataFrame(events, "symbol string, at long, rate double, price double")
    want = {}
    for i, s, a, b, q, m in spans:
        met = [-q * r * (m if p is None else p) for x, t, r, p in events if x == s and a <= t <= b]
        want[i] = (len(met), round(sum(met), 6))
    for width in (None, 5, 50):
        found = portfolio.funding_cashflow(po, fu, width=width)
        assert {r.position_id: (r.events, round(r.cashflow, 6)) for r in found.collect()} == want
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert any(re.search(r"bucket#\d+L? = bucket#\d+L?", line) for line in plan.splitlines() if "Join Inner" in line)


def test_compared_bars_with_null_keys_and_repeats(spark):
    schema = "k long, t long, n int, x double"
    ours = spark.createDataFrame([(1, 1, 1, 1.0), (1, 1, 2, 9.0), (None, 1, 1, 1.0), (2, 1, 1, None), (3, 1, 1, 5.0)], schema)
    theirs = spark.createDataFrame([(1, 1, 2, 9.0), (1, 1, 1, 1.0), (None, 1, 1, 1.0), (2, 1, 1, 2.0), (4, 1, 1, 5.0)], schema)
    assert texts(canonical.compare_bars(ours, theirs, ["k", "t"], {"x": 0.0}, "n"), "k", "field", "status", "delta") == sorted(map(str, [
        (1, "row", "duplicate_ours", None), (1, "row", "duplicate_theirs", None), (2, "x", "null_mismatch", None), (3, "row", "missing_from_theirs", None),
        (4, "row", "missing_from_ours", None), (None, "row", "missing_from_theirs", None), (None, "row", "missing_from_ours", None),
    ]))


def test_repeats_of_canonical_days_are_set_aside_whatever_their_keys(spark):
    step, content = 12 * 3600 * 10**6, len(canonical.CONTENT)
    row = lambda k, frame, at, x, source: (k, frame, at, *([x] * content), source)
    rows = [row(1, "12h", 0, 1.0, "b"), row(1, "12h", 0, 1.0, "a"), row(1, "12h", step, 1.0, "a"), row(2, "12h", 0, 1.0, "a"), row(2, "12h", 0, 2.0, "b"), row(2, "12h", step, 1.0, "a")]
    rows += [row(None, "12h", 0, 3.0, "a"), row(None, "12h", 0, 3.0, "b"), row(3, "12h", None, 3.0, "a"), row(3, "12h", None, 4.0, "b"), row(4, None, 0, 3.0, "b"), row(4, None, 0, 3.0, "a")]
    given = spark.createDataFrame(rows, "instrument_id long, timeframe string, period_start_us long, " + ", ".join(f"{c} double" for c in canonical.CONTENT) + ", source_id string")
    made = canonical.canonical_daily(given, given.limit(0).selectExpr("*", "period_start_us AS day_us"), {"12h": step})
    assert values(made.daily, "instrument_id", "day_us", "base_volume") == [(1, 0, 2.0)]
    assert values(made.quarantine, "instrument_id", "source_id") == [(2, "a"), (2, "b"), (3, "a"), (3, "b")]
    assert set(made.quarantine.columns) == {*given.columns, "code"}
    repeats = texts(made.issues.where("code like '%duplicate'"), "instrument_id", "code")
    assert repeats == sorted(map(str, [(2, "conflicting_duplicate")] * 2 + [(3, "conflicting_duplicate")] * 2 + [(k, "identical_duplicate") for k in (1, None, 4)]))
