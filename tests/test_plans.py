"""Sides whose rows are repeated before a join are never broadcast: their sizes are guessed from before."""

import os
import re

import pytest

from tidelake.plans import registry

DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the given tables")

REPEATED = [
    "j2_asof_all",
    "j16_conflicts",
    "j19_ineligible",
    "j1_asof_max_age",
    "j3_bitemporal",
    "j4_bitemporal_latest",
    "j5_point_lookup",
]


@pytest.mark.parametrize("name", REPEATED)
def test_repeated_rows_are_not_broadcast(spark, name):
    plan = registry.queries()[name](spark, DIR)._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert all("orderkey" in line for line in joins) and "SortMergeJoin" in plan  # orders themselves may be small


def test_bars_are_made_by_tasks_of_bounded_size(spark, monkeypatch):
    from tidelake.plans import inputs, market

    dealt = inputs.spread(spark.range(1001), "id", 100)
    assert dealt.rdd.getNumPartitions() == 11 and dealt.count() == 1001
    monkeypatch.setattr(inputs, "spread", lambda rows, key: dealt.select(dealt["id"].alias(key)))
    assert market.grid(spark, DIR).rdd.getNumPartitions() == 11


#: Queries over parts that are repeated by date or version.
DEALT = [
    "j16_conflicts",
    "j3_bitemporal",
    "j4_bitemporal_latest",
    "j5_point_lookup",
]


@pytest.mark.parametrize("name", DEALT)
def test_parts_are_dealt_before_they_are_repeated(spark, name):
    plan = registry.queries()[name](spark, DIR)._jdf.queryExecution().analyzed().toString()
    assert 0 < plan.count("RepartitionByExpression [part") == plan.count("Relation [p_partkey")


def test_duplicates_are_dealt_by_rows_and_compared_as_they_stand(spark):
    plan = registry.queries()["a5_duplicates"](spark, DIR)._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression [k" in plan and "sha2" not in plan  # what packs small is not small when sorted


def test_canonical_days_are_made_once(spark):
    from tidelake.plans import canonical

    made = canonical.made(spark, DIR)
    for table in (made.daily, made.report, made.issues):
        plan = table._jdf.queryExecution().analyzed().toString()
        assert "Window" not in plan and "Generate explode(sequence" not in plan  # bars are not made again for each table


def test_canonical_days_of_files_are_made_once(spark):
    plan = registry.queries()["q6_canonical_from_files"](spark, DIR)._jdf.queryExecution().analyzed().toString()
    assert "Window" not in plan


def test_compared_bars_are_dealt(spark):
    plan = registry.queries()["j11_compare_bars"](spark, DIR)._jdf.queryExecution().analyzed().toString()
    assert 0 < plan.count("RepartitionByExpression [instrument_id") == plan.count("Relation [p_partkey")


def test_compared_bars_meet_in_one_pass(spark):
    plan = registry.queries()["j11_compare_bars"](spark, DIR)._jdf.queryExecution()
    assert "Join" not in plan.optimizedPlan().toString()
    parts = plan.optimizedPlan().toString().count("Relation [p_partkey")
    assert plan.sparkPlan().toString().count("HashAggregate") == 2 and 0 < plan.executedPlan().toString().count("Exchange ") == parts  # parts are dealt, bars are not


def test_canonical_rows_are_dealt_and_sorted_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tidelake.operators import canonical

    rows = spark.range(40).select((F.col("id") % 5).alias("instrument_id"), F.lit("6h").alias("timeframe"), (F.col("id") * 6 * 3600 * 10**6).alias("period_start_us"), *(F.lit(1.0).alias(c) for c in canonical.CONTENT), F.lit("a").alias("source_id"))
    none = rows.limit(0).withColumn("day_us", F.lit(0).cast("long"))
    kept, real = [], type(rows).checkpoint
    monkeypatch.setattr(type(rows), "checkpoint", lambda df: kept.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    canonical.canonical_daily(rows, none, {"6h": 6 * 3600 * 10**6})
    assert sum(p.count("Exchange ") for p in kept) == 1 and sum(p.count("- Sort ") for p in kept) == 1


def test_canonical_tasks_are_told_by_rows(spark, monkeypatch):
    from tidelake.operators import canonical
    from tidelake.plans import canonical as plans

    kept, real = [], type(spark.range(1)).checkpoint
    monkeypatch.setattr(canonical, "TASK_ROWS", 5000)
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda df: kept.append(df._jdf.queryExecution().analyzed().toString()) or real(df))
    plans.q6_canonical_from_files(spark, DIR)
    rows = spark.read.parquet(plans.sourced(spark, DIR)).count()
    dealt = [int(n) for n in re.findall(r"RepartitionByExpression \[instrument_id#\d+L, day_us#\d+L\], (\d+)", kept[0])]
    assert len(dealt) == 1 and rows / 5000 * 0.7 < dealt[0] <= rows / 5000 + 1


def test_duplicate_files_are_told_in_parts_too(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:  # as on larger tables, tasks end within a shelf
        got = sorted(tuple(r) for r in registry.queries()["q15_duplicate_files"](spark, DIR).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert got == [(str(s), "ARCHIVE", 1 if s in (2, 5) else 2, str(s if s in (2, 5) else s % 3)) for s in range(6)]
