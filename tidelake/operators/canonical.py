"""Canonical daily bars from checked source bars, and what is set aside on the way."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.functions.times import DAY, SECOND, floor_to
from tidelake.operators import bars as B

CONTENT = ["open", "high", "low", "close", "base_volume", "quote_volume", "trade_count"]
#: Source bars that a task sorts, or so.
TASK_ROWS = 1_000_000


def complete_rows(rows: DataFrame, steps: dict[str, int], keys: tuple[str, ...] = ("instrument_id",)) -> tuple[DataFrame, DataFrame]:
    """(rows of complete days, incomplete days): rows have timeframe, one of steps (name -> microseconds).

    A day is complete if its rows' opens are just those that the timeframe's step expects.
    """
    day = Window.partitionBy(*keys, "timeframe", "day_us")
    marked = rows.withColumn("step", _step(steps)).withColumn("day_us", floor_to(F.col("period_start_us"), DAY))
    marked = marked.withColumns({c: x.over(day) for c, x in _counts().items()}).withColumn("expected", _expected(F.col("step")))
    whole = _whole(F.col("step"))
    short = marked.where(~whole).select(*keys, "timeframe", "day_us", "observed", "expected").distinct()
    return marked.where(whole).select(*rows.columns), short


def _step(steps: dict[str, int]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in steps.items() for x in kv)), F.col("timeframe"))


def _expected(step: Column) -> Column:
    return (F.lit(DAY) / step).cast("long")


def _counts(step: Column | None = None) -> dict[str, Column]:
    """What tells whether a day (day_us) is complete."""
    aligned = F.pmod(F.col("period_start_us") - F.col("day_us"), F.col("step") if step is None else step) == 0
    return {"observed": F.count("*"), "on_grid": F.count_if(aligned)}


def _whole(step: Column) -> Column:
    whole = (F.col("observed") == F.col("expected")) & (F.col("on_grid") == F.col("expected")) & (F.lit(DAY) % step == 0)
    return F.coalesce(whole, F.lit(False))


def daily_source(rows: DataFrame, timeframe: str | None = None) -> DataFrame:
    """rows of one timeframe: the one asked for, or the only one there is. Timeframes are few; more than one without a choice is an error."""
    present = sorted(r[0] for r in rows.select("timeframe").distinct().limit(100).collect())
    chosen = timeframe.strip() if timeframe else None
    if chosen and chosen not in present:
        raise ValueError(f"no complete day of timeframe {chosen}; there are {present}")
    if not chosen and len(present) > 1:
        raise ValueError(f"several timeframes {present} have complete days: choose one")
    return rows.where(F.col("timeframe") == chosen) if chosen else rows


@dataclass(frozen=True)
class Canonical:
    """daily: the bars; quarantine: rows that contradict each other; report: against a provider's days; issues: code, severity, key."""

    daily: DataFrame
    quarantine: DataFrame
    report: DataFrame
    issues: DataFrame

    def write(self, path: str) -> None:
        """The bars and the three side tables, as Parquet under path."""
        for name in ("daily", "quarantine", "report", "issues"):
            getattr(self, name).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")


SOURCE = ["instrument_id", "timeframe", "period_start_us", "close_us", *CONTENT, "source_id", "source_open_time", "source_close_time", "source_timestamp_unit"]


def cross_checked(rows: DataFrame, steps: dict[str, int]) -> DataFrame:
    """rows (SOURCE) with code: whether a bar's normalized times are those of its source, in the source's own unit.

    code: unknown_timeframe or unknown_unit; source_close_mismatch (the source's close is not its open plus the
    interval less one unit), open_time_mismatch or close_time_mismatch (a normalized time is not the source's),
    missing_time, else null.
    """
    step = F.element_at(F.create_map(*(F.lit(x) for kv in steps.items() for x in kv)), F.col("timeframe"))
    unit, opens, closes = F.col("source_timestamp_unit"), F.col("source_open_time"), F.col("source_close_time")
    scale = F.when(unit == "s", SECOND).when(unit == "ms", 1000).when(unit == "us", 1)
    code = (
        F.when(step.isNull(), "unknown_timeframe").when(scale.isNull(), "unknown_unit")
        .when(opens.isNull() | closes.isNull() | F.col("period_start_us").isNull() | F.col("close_us").isNull(), "missing_time")
        .when(closes != opens + step / scale - 1, "source_close_mismatch").when(opens * scale != F.col("period_start_us"), "open_time_mismatch")
        .when(closes * scale != F.col("close_us"), "close_time_mismatch")
    )
    return rows.withColumn("code", code)


def canonical_from_files(
    spark: SparkSession, path: str, provider: DataFrame, steps: dict[str, int], timeframe: str | None = None, tolerance: float = 0.0
) -> Canonical:
    """Source bars read from Parquet under path, their times cross-checked, as canonical_daily makes them.

    A column of SOURCE that the files lack is an error. Rows whose times don't agree are issues of severity
    ERROR and go no further.
    """
    loaded = spark.read.parquet(path)
    if missing := [c for c in SOURCE if c not in loaded.columns]:
        raise ValueError(f"source bars lack {missing}")
    checked = cross_checked(loaded.select(*SOURCE), steps)
    made = canonical_daily(checked.where("code is null").drop("code"), provider, steps, timeframe, tolerance)
    refused = checked.where("code is not null").select("code", F.lit("ERROR").alias("severity"), "instrument_id", F.col("period_start_us").alias("at_us"))
    return Canonical(made.daily, made.quarantine, made.report, made.issues.unionByName(refused))


def canonical_daily(rows: DataFrame, provider: DataFrame, steps: dict[str, int], timeframe: str | None = None, tolerance: float = 0.0) -> Canonical:
    """Source bars (instrument_id, timeframe, period_start_us, CONTENT, source_id) to daily ones.

    Equal repeats collapse, contradicting ones are set aside; only complete days of one timeframe are
    resampled; the result is reconciled with provider (instrument_id, day_us, CONTENT). Rows are dealt once, by
    day, and kept as days; a day with repeats is a second one, flagged, by which repeats are looked up again.
    """
    key = ["instrument_id", "timeframe", "day_us"]
    dated = rows.withColumn("day_us", floor_to(F.col("period_start_us"), DAY))
    told = lambda df: B.enforce_unique(df, [*key, "period_start_us"], CONTENT, "source_id")
    # days are made and told complete in one pass, and kept: every table needs them
    counts = tuple(c.alias(n) for n, c in _counts(_step(steps)).items())
    # Spark deals by bytes shuffled, of which bars have few: tasks are told by rows
    tasks = max(-(-rows.count() // TASK_ROWS), 1)
    unique = told(dated.select(*key, "period_start_us", *CONTENT, "source_id").repartition(tasks, "instrument_id", "day_us"))
    made = B.resample_daily(unique.withColumn("flagged", F.col("code").isNotNull()), ("instrument_id", "timeframe", "flagged"), also=counts)
    made = made.withColumn("expected", _expected(_step(steps))).withColumn("whole", _whole(_step(steps))).checkpoint()
    days, flagged = made.where("not flagged").drop("flagged"), made.where("flagged").select(*(F.col(c).alias(f"of_{c}") for c in key))
    again = dated.limit(0)
    if not flagged.isEmpty():
        again = dated.join(flagged, reduce(and_, (F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in key)), "left_semi")
    repeated = told(again).where("code is not null").drop("day_us").checkpoint()
    quarantine = repeated.where("code = 'conflicting_duplicate'")
    short = days.where("not whole")
    daily = daily_source(days.where("whole"), timeframe).drop("timeframe", "observed", "on_grid", "expected", "whole")
    report = B.reconcile(daily, provider, ["instrument_id", "day_us"], CONTENT, tolerance)
    issue = lambda df, code, severity, at: df.select(code.alias("code"), F.lit(severity).alias("severity"), "instrument_id", at.alias("at_us"))
    issues = (
        issue(repeated, F.col("code"), "WARNING", F.col("period_start_us"))
        .unionByName(issue(short, F.concat(F.lit("incomplete_utc_day:"), F.col("timeframe")), "WARNING", F.col("day_us")))
        .unionByName(issue(report.where("status <> 'match'"), F.col("status"), "ERROR", F.col("day_us")))
    )
    return Canonical(daily, quarantine, report, issues)


def compare_bars(ours: DataFrame, theirs: DataFrame, keys: list[str], tolerances: dict[str, float], ordinal: str = "ordinal") -> DataFrame:
    """keys, field, status, delta: how ours and a provider's bars differ in the fields of tolerances.

    missing_from_theirs, missing_from_ours, duplicate_ours, duplicate_theirs (field 'row'), mismatch
    and null_mismatch. Of repeated keys the first by ordinal is compared. Fields of no tolerance
    are not compared, and equal bars give no row.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        # a null key is nobody's but its side's
        own = F.when(reduce(or_, (F.col(k).isNull() for k in keys)), name)
        fields = (F.col(f).cast("double").alias(f"{name}_{f}") for f in tolerances)
        return df.select(*keys, own.alias("own"), F.lit(1).alias(f"n_{name}"), F.col(ordinal).alias(f"at_{name}"), *fields)

    # both sides in one table and one pass: of the other side's rows a field's order is null, so they don't count
    both_sides = side(ours, "a").unionByName(side(theirs, "b"), allowMissingColumns=True)
    firsts = (F.min_by(f"{s}_{f}", f"at_{s}").alias(f"{s}_{f}") for s in "ab" for f in tolerances)
    counts = (c for s in "ab" for c in (F.count(f"n_{s}").alias(f"n_{s}"), (F.count(f"at_{s}") > 0).alias(f"in_{s}")))
    met = both_sides.groupBy(*keys, "own").agg(*firsts, *counts)

    def item(test: Column, field: str, status: str, delta: Column | None = None) -> Column:
        what = F.struct(F.lit(field).alias("field"), F.lit(status).alias("status"), (F.lit(None) if delta is None else delta).cast("double").alias("delta"))
        return F.when(test, what)

    a, b = (lambda f: F.col(f"a_{f}")), (lambda f: F.col(f"b_{f}"))
    both = F.col("in_a") & F.col("in_b")
    items = [
        item(~F.col("in_b"), "row", "missing_from_theirs"), item(~F.col("in_a"), "row", "missing_from_ours"),
        item(F.col("n_a") > 1, "row", "duplicate_ours"), item(F.col("n_b") > 1, "row", "duplicate_theirs"),
    ]
    for field, most in tolerances.items():
        items.append(item(both & (a(field).isNull() != b(field).isNull()), field, "null_mismatch"))
        items.append(item(both & (F.abs(a(field) - b(field)) > most), field, "mismatch", a(field) - b(field)))
    return met.select(*keys, F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("x")).select(*keys, "x.*")
