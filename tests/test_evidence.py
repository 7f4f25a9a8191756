import pytest
from pyspark.sql import functions as F

from tidelake.operators import evidence as E
from tidelake.operators import factors


def test_history_takes_what_was_known_and_stops_where_there_is_too_little(spark):
    bars = spark.createDataFrame(
        [("a", p, p + lag, float(p), 1.0) for p, lag in ((1, 1), (2, 9), (3, 1), (4, 1))] + [("a", 3, 6, 33.0, 2.0)],
        "instrument_id string, period_start long, availability long, close double, base_volume double",
    )
    at = lambda *t: spark.createDataFrame([("a", x) for x in t], "instrument_id string, t long")
    got = {r.t: r.closes for r in factors.history_at(at(5, 6, 11), bars, 2).collect()}
    assert got == {5: [3.0, 4.0], 6: [33.0, 4.0], 11: [33.0, 4.0]}
    assert {r.t: r.closes for r in factors.history_at(at(11), bars, 4).collect()} == {11: [1.0, 2.0, 33.0, 4.0]}
    with pytest.raises(Exception, match="fewer than 3"):
        factors.history_at(at(5, 3), bars, 3).collect()


def test_weekly_times_start_on_the_day_asked_for(spark):
    day = 86400 * 10**6
    spans = spark.createDataFrame([(0, 20 * day), (day, day), (day + 1, 8 * day)], "start_us long, end_us long")
    got = sorted((r.start_us, r.t // day) for r in E.weekly_times(spans).collect())  # 1970-01-02 was a Friday
    assert got == [(0, 1), (0, 8), (0, 15), (day, 1), (day + 1, 8)]


def test_an_alias_and_its_object_with_nulls(spark):
    objects = spark.createDataFrame([(1, "x", None), (2, "y", 3)], "key long, a string, b long")
    entries = spark.createDataFrame([("ok", 1, "x", None), ("b", 2, "y", None), ("none", 9, "x", 1)], "alias string, key long, a string, b long")
    assert sorted(map(tuple, E.false_aliases(entries, objects, "key", ["a", "b"]).collect())) == [("b", 2, "b"), ("none", 9, "unknown_object")]


def test_a_listing_without_symbols_gives_no_rows(spark):
    pages = spark.createDataFrame([("{}",), (None,), ('{"symbols": []}',), ("not json",)], "json string")
    assert E.contracts(pages, ["TRADING"], ["COIN"]).count() == 0


def test_empty_evidence(spark):
    none = spark.createDataFrame([], "run long, decision_time long, x long")
    ran = spark.createDataFrame([(1, 2)], "run long, decision_time long")
    assert [tuple(r) for r in E.binding_series(none, ran, ["x"]).collect()] == [(1, 2, "missing_entry")]
    points = spark.createDataFrame([], "symbol string, at_us long, size long")
    life = spark.createDataFrame([("s", 3, 5)], "symbol string, first_day long, last_day long")
    row = E.retained_coverage(points, life).first()
    assert (row.days, row.lifecycle_days, row.supported, row.bytes_per_point) == (0, 3, True, None)
    assert E.storage_projection(E.retained_coverage(points, life).where(F.lit(False))).first().points_needed == 0


def test_columns_find_their_roles():
    from tidelake.operators.quality import resolve_columns

    roles, issues = resolve_columns(["TS", "o", "high", "h", "close"], {"low": "gone"})
    assert roles == {"timestamp": "TS", "open": "o", "close": "close"}
    assert issues == [
        ("inferred_by_name", "WARNING", "timestamp"), ("inferred_by_name", "WARNING", "open"), ("mapping_ambiguous", "ERROR", "high"),
        ("mapping_missing_column", "ERROR", "low"), ("inferred_by_name", "WARNING", "close"),
    ]
    assert resolve_columns([])[1][0] == ("mapping_absent", "WARNING", "timestamp")
