"""Which instruments exist, trade and pass screens at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.times import DAY


def survivors(decisions: DataFrame, coins: DataFrame, use_availability: bool = False) -> DataFrame:
    """(t, instrument_id) of coins born by t that are active, or whose death is known and not before t.

    coins: instrument_id, birth, death (text dates), is_active, availability. A date that can't be
    read bounds nothing; an inactive coin without a death date is never in. Decisions are few rows.
    """
    day = lambda c: F.unix_micros(F.expr(f"try_to_timestamp({c})"))
    dated = coins.withColumn("born", day("birth")).withColumn("died", day("death"))
    t = F.col("t")
    inside = (F.col("born").isNull() | (F.col("born") <= t)) & (F.col("is_active") | ((F.coalesce("death", F.lit("")) != "") & (F.col("died").isNull() | (t <= F.col("died")))))
    if use_availability:
        inside = inside & (F.col("availability").isNull() | (F.col("availability") <= t))
    return dated.join(F.broadcast(decisions.select("t").distinct()), inside).select("t", "instrument_id").distinct()


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that holds, in order; null if none does."""
    return F.coalesce(*(F.when(test, F.lit(name)) for test, name in rules))


def leveraged(symbols: DataFrame, suffixes: list[str]) -> DataFrame:
    """symbols (base) with leveraged: base is a stem and a suffix, and the stem is a base itself."""
    stems = symbols.select("base", F.explode(F.array(*map(F.lit, suffixes))).alias("suffix")).where(F.col("base").endswith(F.col("suffix")))
    stems = stems.select("base", F.expr("substr(base, 1, length(base) - length(suffix))").alias("stem")).where("stem <> ''")
    hit = stems.join(symbols.select(F.col("base").alias("stem")).distinct(), "stem", "left_semi").select("base").distinct().withColumn("leveraged", F.lit(True))
    return symbols.join(hit, "base", "left").fillna({"leveraged": False})


def screen(metrics: DataFrame, keys: list[str], least: dict[str, float]) -> DataFrame:
    """keys, provider, verdict, reason by the most authoritative provider (the least priority) of each key.

    A metric that is null or NaN makes UNAVAILABLE; one under its floor REJECT; else PASS.
    """
    best = Window.partitionBy(*keys).orderBy("priority", "provider")
    one = metrics.withColumn("turn", F.row_number().over(best)).where("turn = 1")
    gone = [(F.col(m).isNull() | F.isnan(m), f"{m}_unavailable") for m in least]
    low = [(F.col(m) < floor, f"{m}_below_floor") for m, floor in least.items()]
    reason = first_reason(*gone, *low)
    verdict = F.when(reason.endswith("_unavailable"), "UNAVAILABLE").when(reason.isNotNull(), "REJECT").otherwise("PASS")
    return one.select(*keys, "provider", verdict.alias("verdict"), reason.alias("reason"))


def eligible_history(bars: DataFrame, as_of_us: int, least_days: int) -> DataFrame:
    """instrument_id, days since the first bar, state: ELIGIBLE or INSUFFICIENT."""
    first = bars.groupBy("instrument_id").agg(F.min("period_start").alias("first"))
    days = F.floor((F.lit(as_of_us) - F.col("first")) / DAY)
    return first.select("instrument_id", days.alias("days"), F.when(days >= least_days, "ELIGIBLE").otherwise("INSUFFICIENT").alias("state"))


def dead_by_bad_days(listed: DataFrame, stats: DataFrame, keys: list[str], as_of_us: int, days: int, floors: tuple[float, float]) -> DataFrame:
    """listed keys with dead: the last `days` observed days up to as_of all have both daily maxima under the floors.

    Fewer observed days prove nothing. stats: keys, at, liquidity, volume.
    """
    daily = stats.withColumn("day", F.floor(F.col("at") / DAY)).where(F.col("day") <= as_of_us // DAY).groupBy(*keys, "day").agg(F.max("liquidity").alias("l"), F.max("volume").alias("v"))
    last = daily.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("day")))).where(F.col("turn") <= days)
    bad = last.groupBy(*keys).agg(((F.count("*") == days) & F.bool_and((F.col("l") < floors[0]) & (F.col("v") < floors[1]))).alias("dead"))
    return listed.select(*keys).join(bad, keys, "left").fillna({"dead": False})


def inactive(bars: DataFrame, key: str, at: str, as_of_us: int, days: int) -> DataFrame:
    """key, idle_days, dead: whole days since the last bar, more than `days`."""
    last = bars.groupBy(key).agg(F.max(at).alias("last"))
    idle = F.floor((F.lit(as_of_us) - F.col("last")) / DAY)
    return last.select(key, idle.alias("idle_days"), (idle > days).alias("dead"))


def top_ranked(rows: DataFrame, by: str, tie: str, n: int, within: list[str] = ()) -> DataFrame:
    """rows with place (by falling `by`, then tie) and kept: whether it is n at most."""
    best = Window.partitionBy(*within).orderBy(F.desc(by), tie)
    return rows.withColumn("place", F.row_number().over(best)).withColumn("kept", F.col("place") <= n)


def trailing_volume(bars: DataFrame, end_us: int, days: int) -> DataFrame:
    """instrument_id, state, volume, trades of just the closed days before end_us: COMPLETE, or INCOMPLETE with nulls."""
    inside = bars.where((F.col("period_start") >= end_us - days * DAY) & (F.col("period_start") < end_us))
    found = inside.groupBy("instrument_id").agg(F.count_distinct("period_start").alias("n"), F.sum("quote_volume").alias("v"), F.sum("trade_count").alias("c"))
    whole = F.col("n") == days
    return found.select("instrument_id", F.when(whole, "COMPLETE").otherwise("INCOMPLETE").alias("state"), F.when(whole, F.col("v")).alias("volume"), F.when(whole, F.col("c")).alias("trades"))


def latest_per_key(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by order."""
    last = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return log.withColumn("turn", F.row_number().over(last)).where("turn = 1").drop("turn")


def merge_newest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All keys of both tables; new rows win."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def coalesce_upsert(rows: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """keys and, field by field, the last value that is not null by order."""
    return rows.groupBy(*keys).agg(*(F.max_by(f, F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields), F.max(order).alias(order))


def canonical_objects(objects: DataFrame, keys: tuple[str, ...] = ("symbol",), usable: Column | None = None) -> DataFrame:
    """Objects (keys, month, day: null for monthly) with chosen: every monthly one, and daily ones of months without a (usable) monthly one."""
    monthly = objects.where(F.col("day").isNull() & (usable if usable is not None else F.lit(True))).select(*keys, "month").distinct().withColumn("covered", F.lit(True))
    joined = objects.join(monthly, [*keys, "month"], "left")
    return joined.withColumn("chosen", F.col("day").isNull() | F.col("covered").isNull()).drop("covered")


def closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, ancestor, depth): every ancestor once, at its least depth; an ancestor that is the child itself shows a cycle.

    Each round joins the frontier to the edges and keeps what is new; it ends when nothing is.
    """
    e = edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).distinct()
    step = e.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("up"))
    seen = frontier = e.withColumn("depth", F.lit(1))
    depth = 1
    while frontier.limit(1).count():
        depth += 1
        frontier = frontier.select("child", "ancestor").join(step, "ancestor").select("child", F.col("up").alias("ancestor")).distinct()
        frontier = frontier.join(seen.select("child", "ancestor"), ["child", "ancestor"], "left_anti").withColumn("depth", F.lit(depth)).checkpoint()
        seen = seen.unionByName(frontier)
    return seen
