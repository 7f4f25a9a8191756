"""Trades to bars, bars to days, and bars against bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.times import DAY, floor_to

BAR_KEY = ("instrument_id", "venue_id", "market_type", "timeframe", "period_start_us")


def first_trades(trades: DataFrame, keys: list[str]) -> DataFrame:
    """Trades with the first of each trade_id, by (ts_us, price, quantity), within keys; and n, its occurrences."""
    each = Window.partitionBy(*keys, "trade_id")
    order = each.orderBy("ts_us", "price", "quantity")
    return trades.withColumn("n", F.count("*").over(each)).withColumn("turn", F.row_number().over(order)).where("turn = 1").drop("turn")


def reconstruct(trades: DataFrame, interval_us: int, origin_us: int = 0, left_closed: bool = True, unique_ids: bool = False) -> DataFrame:
    """OHLCV bars of trades (instrument_id, ts_us, trade_id, price, quantity, quote_quantity).

    Open and close are by (ts_us, trade_id). A repeated trade_id counts once, its first trade. Without
    left_closed an interval holds its end and not its start. No bar is made for an interval without
    trades. unique_ids skips the deduplication, and its shuffle, where ids are known to be unique.
    """
    rows = trades if unique_ids else first_trades(trades, ["instrument_id"])
    at = F.col("ts_us") if left_closed else F.col("ts_us") - 1
    rows = rows.withColumn("period_start_us", floor_to(at, interval_us, origin_us))
    order = F.struct("ts_us", "trade_id")
    return rows.groupBy("instrument_id", "period_start_us").agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("base_volume"), F.sum(F.coalesce("quote_quantity", F.col("price") * F.col("quantity"))).alias("quote_volume"), F.count("*").alias("trade_count"),
    ).withColumn("period_end_us", F.col("period_start_us") + interval_us)


def duplicate_trades(trades: DataFrame) -> DataFrame:
    """trade_id, occurrences of ids that come more than once."""
    return trades.groupBy("trade_id").agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def all_or_null(column: str) -> Column:
    """A sum that is null if any member is null."""
    return F.when(F.count(column) == F.count("*"), F.sum(column))


def day_completeness(bars: DataFrame, step_us: int, keys: tuple[str, ...] = ("instrument_id",)) -> DataFrame:
    """keys, day_us, observed, expected, code: null for days whose opens are just the expected cadence.

    A step that does not tile a day gives unsupported_daily_interval for every day.
    """
    day = floor_to(F.col("period_start_us"), DAY)
    expected = DAY // step_us
    on_grid = F.count_if(F.pmod(F.col("period_start_us") - F.col("day_us"), F.lit(step_us)) == 0)
    found = bars.withColumn("day_us", day).groupBy(*keys, "day_us").agg(F.count("*").alias("observed"), F.count_distinct("period_start_us").alias("distinct"), on_grid.alias("aligned"))
    whole = (F.col("observed") == expected) & (F.col("distinct") == expected) & (F.col("aligned") == expected)
    code = F.when(F.lit(DAY % step_us != 0), "unsupported_daily_interval").when(~whole, "incomplete_utc_day")
    return found.select(*keys, "day_us", "observed", F.lit(expected).cast("long").alias("expected"), code.alias("code"))


def resample_daily(
    bars: DataFrame, keys: tuple[str, ...] = ("instrument_id",), source: str | None = None, step_us: int | None = None, also: tuple[Column, ...] = ()
) -> DataFrame:
    """Daily bars of intraday bars; optional volumes are null if any member's is.

    With step_us days that are not complete (day_completeness) are left out, in the same pass; without it
    all days must be. also: further aggregates of a day's bars. Bars may bring their day_us, by which they then
    need not be dealt again.
    """
    order = F.struct("period_start_us", source) if source else F.col("period_start_us")
    since = F.pmod("period_start_us", F.lit(DAY))
    # different opens on the grid: at most one for each step of a day
    slots = F.size(F.collect_set(F.when(since % step_us == 0, since))) if step_us else None
    dated = bars if "day_us" in bars.columns else bars.withColumn("day_us", floor_to(F.col("period_start_us"), DAY))
    found = dated.groupBy(*keys, "day_us").agg(
        F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", order).alias("close"),
        F.sum("base_volume").alias("base_volume"), all_or_null("quote_volume").alias("quote_volume"), all_or_null("trade_count").alias("trade_count"),
        *([F.min(source).alias(source), (F.count_distinct(source) > 1).alias("multi_source")] if source else []),
        *([F.count("*").alias("__n"), slots.alias("__slots")] if step_us else []), *also,
    )
    if step_us:
        expected = DAY // step_us if DAY % step_us == 0 else -1
        found = found.where((F.col("__n") == expected) & (F.col("__slots") == expected)).drop("__n", "__slots")
    return found.withColumn("availability_us", F.col("day_us") + DAY)


def enforce_unique(rows: DataFrame, keys: list[str], content: list[str], source: str) -> DataFrame:
    """rows with code: null (kept), identical_duplicate (dropped for its equal) or conflicting_duplicate (all quarantined).

    Rows of a key are equal if their content is (as Spark compares values), whatever their source; the smallest
    source is kept. Content is compared as it stands: a digest of it would be sorted and kept with every row.
    """
    each = Window.partitionBy(*keys).orderBy(source)
    whole = each.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # ordered too, so that rows are sorted once
    same = F.struct(*content)
    differ = F.min(same).over(whole) != F.max(same).over(whole)
    turn = F.row_number().over(each)
    return rows.withColumn("code", F.when(differ, "conflicting_duplicate").when(turn > 1, "identical_duplicate"))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], tolerance: float = 0.0) -> DataFrame:
    """A long report of two tables with unique keys: keys, field, expected, observed, status.

    missing_left and missing_right are one row each (field 'row'). A field null on both sides is left
    out; null on one is null_mismatch; else match or mismatch by absolute tolerance.
    """
    l, r = left.select(*keys, F.struct(*fields).alias("l")), right.select(*keys, F.struct(*fields).alias("r"))
    both = l.join(r, keys, "full_outer")
    value = lambda side, f: F.col(side)[f].cast("double")
    row = lambda status: F.array(F.struct(F.lit("row").alias("field"), F.lit(None).cast("double").alias("expected"), F.lit(None).cast("double").alias("observed"), F.lit(status).alias("status")))
    status = lambda f: F.when(value("l", f).isNull() | value("r", f).isNull(), "null_mismatch").when(F.abs(value("l", f) - value("r", f)) <= tolerance, "match").otherwise("mismatch")
    each = F.array(*(F.struct(F.lit(f).alias("field"), value("r", f).alias("expected"), value("l", f).alias("observed"), status(f).alias("status")) for f in fields))
    some = F.filter(each, lambda x: x["expected"].isNotNull() | x["observed"].isNotNull())
    report = F.when(F.col("l").isNull(), row("missing_left")).when(F.col("r").isNull(), row("missing_right")).otherwise(some)
    return both.select(*keys, F.explode(report).alias("x")).select(*keys, "x.*")
