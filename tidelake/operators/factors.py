"""Cross-sectional factors for all instruments and decision times at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.asof import in_intervals, latest


def history(bars: DataFrame, n: int) -> DataFrame:
    """bars with the closes and volumes of their last n observations, oldest first; fewer than n give none (history_at: an error)."""
    by = Window.partitionBy("instrument_id").orderBy("period_start").rowsBetween(-(n - 1), 0)
    held = bars.withColumn("closes", F.collect_list("close").over(by)).withColumn("volumes", F.collect_list("base_volume").over(by))
    return held.where(F.size("closes") == n)


def history_at(decisions: DataFrame, bars: DataFrame, n: int) -> DataFrame:
    """decisions (instrument_id, t) with closes and volumes of the last n different observations available at t, oldest first.

    Of an observation that is told more than once the one available last by t counts. Fewer than n, or none,
    stop the job with an error. Each decision meets its key's bars of before t only, and keeps n of them.
    """
    known = in_intervals(decisions, bars, "instrument_id", F.col("t"), F.greatest("availability", "period_start"), F.lit(None).cast("long"))
    told = Window.partitionBy("instrument_id", "t", "period_start").orderBy(F.desc("availability"))
    last = Window.partitionBy("instrument_id", "t").orderBy(F.desc("period_start"))
    kept = known.withColumn("__told", F.row_number().over(told)).where("__told = 1").withColumn("__turn", F.row_number().over(last)).where(F.col("__turn") <= n)
    held = kept.groupBy("instrument_id", "t").agg(F.array_sort(F.collect_list(F.struct("period_start", "close", "base_volume"))).alias("x"))
    met = decisions.select("instrument_id", "t").join(held, ["instrument_id", "t"], "left")
    few = F.raise_error(F.concat(F.lit(f"fewer than {n} observations of "), F.col("instrument_id").cast("string"), F.lit(" at "), F.col("t").cast("string")))
    x = F.when(F.size(F.coalesce("x", F.array().cast(held.schema["x"].dataType))) == n, F.col("x")).otherwise(few.cast(held.schema["x"].dataType))
    return met.select("instrument_id", "t", x.alias("x")).select("instrument_id", "t", F.col("x.close").alias("closes"), F.col("x.base_volume").alias("volumes"))


def window_factors(bars: DataFrame, n: int) -> DataFrame:
    """instrument_id, period_start, availability, momentum, mean_reversion, volume_ratio over the last n observations.

    momentum is last / first - 1 over n steps (n + 1 observations); mean reversion is minus the
    population z-score of the last close; volume ratio is the last volume over the mean. Each is
    null where it has too few observations or no spread or volume.
    """
    order = Window.partitionBy("instrument_id").orderBy("period_start")
    frame = order.rowsBetween(-(n - 1), 0)
    enough = F.count("*").over(frame) == n
    spread, mean, volume = F.stddev_pop("close").over(frame), F.avg("close").over(frame), F.avg("base_volume").over(frame)
    return bars.select(
        "instrument_id", "period_start", "availability",
        (F.col("close") / F.lag("close", n).over(order) - 1).alias("momentum"),
        F.when(enough & (spread > 0), -(F.col("close") - mean) / spread).alias("mean_reversion"),
        F.when(enough & (volume > 0), F.col("base_volume") / volume).alias("volume_ratio"),
    )


def momentum(decisions: DataFrame, bars: DataFrame, lookback_us: int, skip_us: int) -> DataFrame:
    """instrument_id, t, raw_value: ln of the price known at t - skip over that at t - lookback.

    A decision without either price, or with one not positive, has no value and no row.
    """
    def price(back: int, name: str) -> DataFrame:
        moved = decisions.select("instrument_id", (F.col("t") - back).alias("t"))
        found = latest(moved, bars, "instrument_id", ["close"])
        return found.select("instrument_id", (F.col("t") + back).alias("t"), F.col("close").alias(name))

    both = price(skip_us, "p1").join(price(lookback_us, "p0"), ["instrument_id", "t"])
    return both.where("p0 > 0 and p1 > 0").select("instrument_id", "t", F.ln(F.col("p1") / F.col("p0")).alias("raw_value"))


def momentum_grid(decisions: DataFrame, bars: DataFrame, configs: list[tuple[str, int, int]]) -> DataFrame:
    """config_id, instrument_id, t, raw_value for each (config_id, lookback_us, skip_us)."""
    out = None
    for name, lookback, skip in configs:
        one = momentum(decisions, bars, lookback, skip).withColumn("config_id", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("config_id", "instrument_id", "t", "raw_value")


def average_rank(score: Column, *across: str) -> Column:
    """Rank by falling score, 1 the best; ties have the mean of their places."""
    best = Window.partitionBy(*across).orderBy(score.desc())
    return F.rank().over(best) + (F.count("*").over(Window.partitionBy(*across, score)) - 1) / 2.0


def rank_composite(values: DataFrame, across: list[str], keys: list[str]) -> DataFrame:
    """across, keys, mean_rank, score (minus the mean rank), factors: the mean of a key's ranks in all factors of values.

    values: factor_id, across, keys, score.
    """
    ranked = values.withColumn("place", average_rank(F.col("score"), "factor_id", *across))
    mean = ranked.groupBy(*across, *keys).agg(F.avg("place").alias("mean_rank"), F.count("*").alias("factors"))
    return mean.withColumn("score", -F.col("mean_rank"))


def noise(decisions: DataFrame, seed: int) -> DataFrame:
    """decisions (instrument_id, t) with score: a unit normal that depends on (seed, instrument, t) alone."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), "instrument_id", "t").cast("binary"))
    unit = lambda at: (F.conv(F.substring(digest, at, 8), 16, 10).cast("double") + 1) / (2**32 + 1)
    return decisions.withColumn("score", F.sqrt(-2 * F.ln(unit(1))) * F.cos(2 * math.pi * unit(9)))
