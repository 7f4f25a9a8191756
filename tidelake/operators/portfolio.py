"""Weights, risk limits and period accounting as tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TINY = 1e-12


def rank_weights(scores: DataFrame, long_only: bool = False, across: tuple[str, ...] = ("t",)) -> DataFrame:
    """across, instrument_id, weight: ascending place / (n - 1), less 0.5 unless long_only, scaled to gross 1; a lone instrument has 1.

    Ties in score go by instrument_id.
    """
    of_t = Window.partitionBy(*across)
    place = F.row_number().over(of_t.orderBy("score", "instrument_id")) - 1
    raw = scores.withColumn("n", F.count("*").over(of_t)).withColumn("raw", place / F.nullif(F.col("n") - 1, F.lit(0)) - (0.0 if long_only else 0.5))
    gross = F.sum(F.abs("raw")).over(of_t)
    return raw.withColumn("gross", gross).select(*across, "instrument_id", F.when(F.col("n") == 1, 1.0).when(F.col("gross") > 0, F.col("raw") / F.col("gross")).otherwise(F.col("raw")).alias("weight"))


def sign_weights(scores: DataFrame, leverage: float = 1.0, across: tuple[str, ...] = ("t",)) -> DataFrame:
    """across, instrument_id, weight: half the leverage shared by positive scores, half, short, by negative; zero scores have no row.

    A lone instrument of a time has all the leverage on its side, or weight 0.
    """
    of_t = Window.partitionBy(*across)
    counted = scores.withColumn("n", F.count("*").over(of_t)).withColumn("up", F.count_if(F.col("score") > 0).over(of_t)).withColumn("down", F.count_if(F.col("score") < 0).over(of_t))
    weight = F.when(F.col("n") == 1, F.signum("score") * leverage).when(F.col("score") > 0, F.lit(leverage / 2) / F.col("up")).when(F.col("score") < 0, F.lit(-leverage / 2) / F.col("down"))
    return counted.select(*across, "instrument_id", weight.alias("weight")).where("weight is not null")


def limit_risk(weights: DataFrame, max_gross: float, max_single: float) -> DataFrame:
    """weights clipped to max_single and scaled per t: both legs of a two-sided book to the same gross, a one-sided book to max_gross."""
    of_t = Window.partitionBy("t")
    clipped = weights.withColumn("w", F.greatest(F.lit(-max_single), F.least(F.lit(max_single), F.col("weight"))))
    legs = clipped.withColumn("long", F.sum(F.greatest("w", F.lit(0.0))).over(of_t)).withColumn("short", F.sum(F.greatest(-F.col("w"), F.lit(0.0))).over(of_t))
    both = (F.col("long") > TINY) & (F.col("short") > TINY)
    leg = F.when(F.col("w") > 0, F.col("long")).otherwise(F.col("short"))
    goal = F.when(both, F.least("long", "short", F.lit(max_gross / 2))).otherwise(F.lit(max_gross))
    held = F.when(both, leg).otherwise(F.col("long") + F.col("short"))
    scaled = F.when(held > goal + TINY, F.col("w") * goal / held).otherwise(F.col("w"))
    return legs.select("t", "instrument_id", scaled.alias("weight")).where(F.abs("weight") > TINY)


def account(targets: DataFrame, returns: DataFrame, cost_rate: float) -> DataFrame:
    """Per strategy_id and period: turnover, cost, gross_return, net_return.

    targets: strategy_id, period, instrument_id, weight; returns: period, instrument_id, ret (missing:
    0). Weights held into a period are the last period's, moved by its returns and divided by its
    gross growth; turnover is the absolute change to the targets over all instruments of either.
    """
    held = targets.join(returns, ["period", "instrument_id"], "left").withColumn("ret", F.coalesce("ret", F.lit(0.0)))
    gross = held.groupBy("strategy_id", "period").agg(F.sum(F.col("weight") * F.col("ret")).alias("gross_return"))
    turns = gross.withColumn("next", F.lead("period").over(Window.partitionBy("strategy_id").orderBy("period")))
    drift = held.join(turns, ["strategy_id", "period"]).where("next is not null and 1 + gross_return > 0").select(
        "strategy_id", F.col("next").alias("period"), "instrument_id", (F.col("weight") * (1 + F.col("ret")) / (1 + F.col("gross_return"))).alias("before")
    )
    change = targets.join(drift, ["strategy_id", "period", "instrument_id"], "full_outer")
    turnover = change.groupBy("strategy_id", "period").agg(F.sum(F.abs(F.coalesce("weight", F.lit(0.0)) - F.coalesce("before", F.lit(0.0)))).alias("turnover"))
    cost = F.col("turnover") * cost_rate
    return turnover.join(gross, ["strategy_id", "period"]).select("strategy_id", "period", "turnover", cost.alias("cost"), "gross_return", (F.col("gross_return") - cost).alias("net_return"))


def perpetual_account(targets: DataFrame, moves: DataFrame, cost_rate: float, maintenance: float = 0.0) -> DataFrame:
    """Per strategy_id and period: turnover, cost, price_return, funding, net_return, long_return, short_return, liquidated.

    targets: strategy_id, period, instrument_id, weight; moves: period, instrument_id, ret, funding_rate
    (missing: 0). Drifted weights are over net growth, so a period needs the one before: the rows of a
    strategy stream through a task in order of periods, which holds the positions of two periods at a
    time, and strategies go in parallel. A loss of 1 - maintenance or more liquidates the book: the
    period's net return is -1, and the next one starts without positions.
    """
    held = targets.join(moves, ["period", "instrument_id"], "left").fillna(0.0, ["ret", "funding_rate"])
    columns = ["turnover", "cost", "price_return", "funding", "net_return", "long_return", "short_return"]

    def close(key: tuple, rows: list[tuple], before: dict) -> tuple[tuple, dict]:
        turnover = sum(abs(w - before.pop(i, 0.0)) for i, w, _, _ in rows) + sum(map(abs, before.values()))
        price, funding = sum(w * r for _, w, r, _ in rows), -sum(w * f for _, w, _, f in rows)
        net = price + funding - turnover * cost_rate
        gone = -net >= 1 - maintenance
        net = -1.0 if gone else net
        sides = [sum(w * r for _, w, r, _ in rows if (w > 0) is up and w) for up in (True, False)]
        after = {} if gone else {i: w * (1 + r) / (1 + net) for i, w, r, _ in rows}
        return (*key, turnover, turnover * cost_rate, price, funding, net, *sides, gone), after

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rows, before = None, [], {}
        for part in parts:
            out = []
            for strategy, period, *row in zip(*(part[c] for c in ("strategy_id", "period", "instrument_id", "weight", "ret", "funding_rate"))):
                if key != (strategy, period):
                    if key is not None:
                        done, before = close(key, rows, before)
                        out.append(done)
                        before = before if key[0] == strategy else {}
                    key, rows = (strategy, period), []
                rows.append(tuple(row))
            yield pd.DataFrame(out, columns=["strategy_id", "period", *columns, "liquidated"])
        if key is not None:
            yield pd.DataFrame([close(key, rows, before)[0]], columns=["strategy_id", "period", *columns, "liquidated"])

    kinds = {n: t for n, t in targets.dtypes}
    ordered = held.select("strategy_id", "period", "instrument_id", "weight", "ret", "funding_rate").repartition("strategy_id").sortWithinPartitions("strategy_id", "period", "instrument_id")
    return ordered.mapInPandas(fold, f"strategy_id {kinds['strategy_id']}, period {kinds['period']}, " + ", ".join(f"{c} double" for c in columns) + ", liquidated boolean")


def summary(periods: DataFrame, keys: list[str] = ("strategy_id",)) -> DataFrame:
    """keys, periods, total_return (compounded), mean_turnover, total_cost, wipeouts (net returns of -1 or less, which end at -1)."""
    wiped = F.count_if(F.col("net_return") <= -1)
    grown = F.exp(F.sum(F.ln(F.when(F.col("net_return") > -1, 1 + F.col("net_return"))))) - 1
    return periods.groupBy(*keys).agg(F.count("*").alias("periods"), F.when(wiped > 0, -1.0).otherwise(grown).alias("total_return"), F.avg("turnover").alias("mean_turnover"), F.sum("cost").alias("total_cost"), wiped.alias("wipeouts"))


def risk_summary(weights: DataFrame) -> DataFrame:
    """max_weight, max_gross, max_net over all times of weights (t, instrument_id, weight)."""
    per = weights.groupBy("t").agg(F.max(F.abs("weight")).alias("w"), F.sum(F.abs("weight")).alias("g"), F.abs(F.sum("weight")).alias("n"))
    return per.agg(F.max("w").alias("max_weight"), F.max("g").alias("max_gross"), F.max("n").alias("max_net"))


def equity_path(periods: DataFrame, initial: float, alert: float, keys: list[str] = ("session",)) -> DataFrame:
    """periods (keys, t, equity) with ret from the equity before (first: initial), peak, drawdown and alert."""
    order = Window.partitionBy(*keys).orderBy("t")
    before = F.lag("equity", 1, initial).over(order)
    peak = F.greatest(F.lit(initial), F.max("equity").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = periods.withColumn("ret", F.when(before > 0, F.col("equity") / before - 1)).withColumn("peak", peak).withColumn("drawdown", 1 - F.col("equity") / F.col("peak"))
    return out.withColumn("alert", F.col("drawdown") >= alert)


def funding_cashflow(positions: DataFrame, funding: DataFrame, inverse: bool = False, closed: str = "both", width: int | None = None) -> DataFrame:
    """positions (position_id, symbol, start, end, quantity, mark_price) with events, cashflow: what funding in the interval pays.

    A linear contract pays -quantity * price * rate with the event's price or else the mark price; an
    inverse one -quantity * rate. closed is 'both' or 'right', which leaves out an event at the start.
    Events meet positions by time buckets of `width` (by default the longest interval), so those outside
    a position's buckets make no pair.
    """
    held = positions.where("start <= end")
    if width is None:
        width = max(1, held.agg(F.max(F.col("end") - F.col("start"))).head()[0] or 1)
    bucket = lambda c: F.floor(F.col(c) / width)
    held = held.withColumn("bucket", F.explode(F.sequence(bucket("start"), bucket("end"))))
    inside = (F.col("at") <= F.col("end")) & (F.col("at") >= F.col("start") if closed == "both" else F.col("at") > F.col("start"))
    met = held.join(funding.select("symbol", "at", "rate", "price", bucket("at").alias("bucket")), ["symbol", "bucket"]).where(inside)
    flow = -F.col("quantity") * F.col("rate") * (F.lit(1.0) if inverse else F.coalesce("price", "mark_price"))
    sums = met.groupBy("position_id").agg(F.count("*").alias("events"), F.sum(flow).alias("cashflow"))
    return positions.select("position_id").join(sums, "position_id", "left").fillna({"events": 0, "cashflow": 0.0})
