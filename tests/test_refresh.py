import random

import numpy as np

from tidelake.streaming import refresh, twins


def test_snapshots_are_versions_and_a_replayed_batch_changes_nothing(spark, tmp_path):
    rng = random.Random(8)
    at = str(tmp_path / "table")
    snapshots = refresh.Snapshots(at, ["k"], "part", "seen")
    want, kept, batches = {}, [], []
    for n in range(4):
        parts = range(3) if n != 2 else [1]  # the third batch touches one partition only
        rows = [(10 * p + rng.randrange(6), rng.random(), i, p) for p in parts for i in range(9)]
        batches.append(spark.createDataFrame(rows, "k long, v double, seen long, part long"))
        snapshots.merge(batches[-1], n)
        for k, v, seen, p in sorted(rows, key=lambda r: r[2]):
            want[k] = (k, v, seen, p)
        kept.append(dict(want))
    rows = lambda n=None: {r.k: (r.k, r.v, r.seen, r.part) for r in snapshots.read(spark, n).collect()}
    assert [rows(n) for n in range(4)] == kept and rows() == kept[3]
    assert {r.version for r in spark.read.parquet(f"{at}/manifest/n=2").collect()} == {1, 2}
    snapshots.merge(batches[3], 3)
    assert [rows(n) for n in range(4)] == kept
    plan = snapshots.read(spark, 2)._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower() or "PartitionFilters" in plan


def test_runs_join_as_times_come_in_any_order():
    rng = random.Random(1)
    for _ in range(200):
        times = [5 * t for t in rng.sample(range(40), rng.randrange(1, 40))]
        runs = []
        for i in range(0, len(times), 7):
            runs = twins.joined_runs([*runs, *twins.runs_of(np.unique(times[i : i + 7]), 5)], 5)
        assert runs == twins.runs_of(np.array(sorted(times)), 5)
        assert sorted(t for a, b in runs for t in range(a, b + 1, 5)) == sorted(times)


def stream(spark, rows, schema, path, batches):
    """rows in so many files, one micro-batch each."""
    size = -(-len(rows) // batches)
    for i in range(batches):
        spark.createDataFrame(rows[i * size : (i + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_corrections_do_not_depend_on_batches(spark, tmp_path):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    rows = sorted((t + rng.choice([0, 5, 40, 90]), t, i, rng.random(), float(i % 3)) for i, t in enumerate(rng.sample(range(300), 60)))
    rows = [("a", *r) for r in rows] + [("a", 1000, 999, 99, 1.0, 1.0)]
    schema = "instrument_id string, known_us long, ts_us long, trade_id long, price double, quantity double"
    found = []
    for batches in (1, 4):
        given = stream(spark, rows, schema, str(tmp_path / f"in{batches}"), batches)
        made = refresh.corrected_bars(given.withColumn("known_at", F.timestamp_micros(F.col("known_us") * 1000)), 50, 20)
        found.append(sorted(map(str, twins.drain(made).where("period_us < 900").collect())))
    assert found[0] == found[1] and any("CORRECTION" in r for r in found[0]) and any("FINAL" in r for r in found[0])


def test_a_gap_holds_the_prefix_until_a_later_batch_fills_it(spark, tmp_path):
    rows = [("a", t) for t in (10, 20, 50, 60, 40, 30, 90, 70)]
    given = stream(spark, rows, "k string, t long", str(tmp_path / "in"), 4)
    got = {r.batch: (r.prefix_end, r.length) for r in twins.drain(twins.contiguous_prefix(given, "k", "t", 10), "update").collect()}
    assert got == {0: (20, 2), 1: (20, 2), 2: (60, 6), 3: (70, 7)}


def test_repeats_are_found_across_batches_and_none_is_dropped_for_being_late(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [(1, 10, 100), (2, 11, 100), (1, 12, 101), (3, 13, 100), (1, 14, 9000), (2, 15, 50), (3, 16, 9001), (4, 17, 10)]  # key, order, second
    given = stream(spark, rows, "k long, o long, s long", str(tmp_path / "in"), 4)
    made = refresh.repeats(given.withColumn("ts", F.timestamp_seconds("s")), "k", "o", "1 hour")
    assert isinstance(made, twins.Folded)  # tables, not a call of Python for each key
    got = {r.o: r.again for r in twins.drain(made).collect()}
    # key 3 is forgotten once an hour has passed: the mark moves with the third batch, and its row comes with the fourth
    assert got == {10: False, 11: False, 12: True, 13: False, 14: True, 15: True, 16: False, 17: False}


def test_a_trade_at_or_under_the_watermark_is_not_lost(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [("a", 5, 5, 1, 2.0, 1.0), ("a", 90, 10, 2, 3.0, 1.0), ("a", 90, 20, 3, 4.0, 1.0), ("a", 60, 30, 4, 1.0, 1.0)]
    schema = "instrument_id string, known_us long, ts_us long, trade_id long, price double, quantity double"
    given = stream(spark, rows, schema, str(tmp_path / "in"), 2)
    made = refresh.corrected_bars(given.withColumn("known_at", F.timestamp_micros(F.col("known_us") * 1000)), 50, 20)
    got = sorted((r.kind, r.revision, r.close, r.high, r.low, r.n, r.before_close) for r in twins.drain(made).collect())
    assert got == [("CORRECTION", 1, 3.0, 3.0, 2.0, 2, 2.0), ("CORRECTION", 2, 4.0, 4.0, 2.0, 3, 3.0), ("CORRECTION", 3, 1.0, 4.0, 1.0, 4, 4.0), ("FINAL", 0, 2.0, 2.0, 2.0, 1, None)]


def test_streams_are_folded_by_tables(spark):
    rows = spark.readStream.format("rate").load().selectExpr("value AS k", "value AS t", "double(value) AS equity")
    for made in (twins.contiguous_prefix(rows, "k", "t", 10), twins.drawdown_alerts(rows, "k", "t", 1.0, 0.1), refresh.advancing(rows, "k", "t", "t")):
        assert isinstance(made, twins.Folded)


def test_states_go_on_over_batches_without_a_call_for_each_key(spark, tmp_path):
    rows = [("a", 1, "x"), ("b", 2, "y"), ("a", 2**60 + 1, "y"), ("a", 2**60 + 2, "x"), ("b", 5, "x"), ("b", 6, "y")]
    given = stream(spark, rows, "k string, o long, state string", str(tmp_path / "in"), 3)
    made = twins.states(given, "k", "o", {(None, "x"), ("x", "y")})
    assert isinstance(made, twins.Folded)
    got = sorted((r.k, r.o, r.before, r.state, r.legal) for r in twins.drain(made).collect())
    assert got == [
        ("a", 1, None, "x", True), ("a", 2**60 + 1, "x", "y", True), ("a", 2**60 + 2, "y", "x", False),
        ("b", 2, None, "y", False), ("b", 5, None, "x", True), ("b", 6, "x", "y", True),
    ]



def test_a_bar_comes_once_and_trades_after_it_are_left_out(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = [("a", 10, 1, 5.0, 1.0), ("a", 5, 2, 7.0, 1.0), ("a", 30, 3, 6.0, 1.0), ("b", 70, 4, 1.0, 1.0), ("a", 40, 5, 9.0, 1.0), ("a", 100, 6, 2.0, 2.0)]
    given = stream(spark, rows, "instrument_id string, s long, trade_id long, price double, quantity double", str(tmp_path / "in"), 3)
    made = twins.bars(given.withColumn("ts", F.timestamp_seconds("s")), 50 * 10**6, 10 * 10**6)
    assert isinstance(made, twins.Folded)
    got = sorted((r.instrument_id, r.period_start_us // 10**6, r.open, r.high, r.low, r.close, r.base_volume, r.trade_count) for r in twins.drain(made).collect())
    # the mark is 60 after the second batch, so the trade at 40 is late; at the end it is 90, so later bars have not come
    assert got == [("a", 0, 7.0, 7.0, 5.0, 6.0, 3.0, 3)]
