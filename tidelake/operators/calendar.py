"""Expected calendars, objects named by period, and chosen versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def period_of(name: Column) -> Column:
    """The month or day at the end of an object's name (x-2024-03.zip, x-2024-03-05.csv) as 'yyyy-MM[-dd]'; null without one."""
    found = F.regexp_extract(name, r"-(\d{4}-\d{2}(?:-\d{2})?)\.(?:zip|csv)$", 1)
    return F.when(found != "", found)


def cadence_of(name: Column) -> Column:
    return F.when(F.length(period_of(name)) == 7, "monthly").when(F.length(period_of(name)) == 10, "daily")


def month_opens_missing(rows: DataFrame, key: str, at: str) -> DataFrame:
    """key, after, expected: monthly opens (dates) whose next row is not the next month's."""
    next_ = F.lead(at).over(Window.partitionBy(key).orderBy(at))
    expected = F.add_months(at, 1)
    return rows.select(key, F.col(at).alias("after"), expected.alias("expected"), next_.alias("next")).where("next is not null and next <> expected").drop("next")


def holdout_readiness(expected: DataFrame, available: DataFrame, lock: int, as_of: int) -> DataFrame:
    """status, rows of the calendar (t) after the lock: present, missing, or future (later than as_of, not yet expected); and of claims after as_of: refused."""
    have = available.select("t").distinct().withColumn("there", F.lit(True))
    wanted = expected.where(F.col("t") > lock).join(have, "t", "left")
    status = F.when(F.col("t") > as_of, "future").when(F.col("there"), "present").otherwise("missing")
    claims = available.where(F.col("t") > as_of).select(F.lit("refused").alias("status"))
    return wanted.select(status.alias("status")).unionAll(claims).groupBy("status").agg(F.count("*").alias("rows"))


def preferred_version(versions: DataFrame, key: str, classes: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the best quality class (first in classes; unknown ones last), then the latest by order."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, classes)), F.col("quality")), F.lit(0)), F.lit(len(classes) + 1))
    best = Window.partitionBy(key).orderBy(rank, *(F.desc(c) for c in order))
    return versions.withColumn("turn", F.row_number().over(best)).where("turn = 1").drop("turn")


def slice_of(rows: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """limit rows after offset in order."""
    return rows.orderBy(*order).offset(offset).limit(limit)


def extents(rows: DataFrame, family: str, group: str, month: str) -> DataFrame:
    """family, groups, first, last, shortest and longest: how far a family's groups reach, in months."""
    per = rows.groupBy(family, group).agg(F.min(month).alias("a"), F.max(month).alias("z"))
    span = F.col("z") - F.col("a") + 1
    return per.groupBy(family).agg(F.count("*").alias("groups"), F.min("a").alias("first"), F.max("z").alias("last"), F.min(span).alias("shortest"), F.max(span).alias("longest"))


def not_advancing(runs: DataFrame, key: str, order: str, t: str) -> DataFrame:
    """key, order, t, before: evaluations whose time is not after the one before."""
    before = F.lag(t).over(Window.partitionBy(key).orderBy(order))
    return runs.select(key, order, t, before.alias("before")).where(F.col(t) <= F.col("before"))


def coverage_by_time(spans: DataFrame, dead: DataFrame, times: DataFrame, key: str) -> DataFrame:
    """t, covered, dead, left: of keys whose span (a, z) holds t, how many died before t. Times are few rows."""
    met = spans.join(F.broadcast(times), (F.col("a") <= F.col("t")) & (F.col("t") <= F.col("z"))).join(dead.select(key, "died"), key, "left")
    gone = F.coalesce(F.col("died") < F.col("t"), F.lit(False))
    return met.groupBy("t").agg(F.count("*").alias("covered"), F.count_if(gone).alias("dead"), F.count_if(~gone).alias("left"))


def state_export(versions: DataFrame, links: DataFrame) -> DataFrame:
    """hypothesis, json: its versions with their evidence ids, sorted."""
    per = versions.join(links.groupBy("hypothesis", "version").agg(F.array_sort(F.collect_set("evidence_id")).alias("evidence")), ["hypothesis", "version"], "left")
    each = F.array_sort(F.collect_list(F.struct("version", F.coalesce("evidence", F.array().cast("array<bigint>")).alias("evidence"))))
    return per.groupBy("hypothesis").agg(F.to_json(each).alias("json"))
