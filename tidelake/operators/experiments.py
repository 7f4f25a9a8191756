"""Experiments end to end: what a strategy earned, what a holdout says, and whether it is accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.canon import Fields, content_id
from tidelake.operators import portfolio, stats


def accepted(net_return: Column, p_value: Column, least: float = 0.02, alpha: float = 0.05) -> Column:
    """ACCEPT if the return is at least `least` and p at most alpha, both known; else REJECT."""
    return F.when((net_return >= least) & (p_value <= alpha), "ACCEPT").otherwise("REJECT")


def experiment(
    targets: DataFrame, labels: DataFrame, funding: DataFrame, setup: Fields, cost_rate: float, maintenance: float = 0.0
) -> DataFrame:
    """A row for each strategy_id: what its targets earned over its labels, with costs and funding.

    targets: strategy_id, period, instrument_id, weight; labels: instrument_id, t (the period),
    label_return; funding: period, instrument_id, funding_rate. Gives strategy_id, fingerprint (the id of
    setup, columns of constants, with the strategy), n_periods, n_labels (those that a target met),
    net_return (compounded; -1 after a liquidation), mean_turnover, total_trading_cost,
    total_funding_cost, total_cost, long_return, short_return, liquidations.
    """
    moves = labels.select(F.col("t").alias("period"), "instrument_id", F.col("label_return").alias("ret"))
    met = targets.join(moves, ["period", "instrument_id"], "left_semi").groupBy("strategy_id").agg(F.count("*").alias("n_labels"))
    moves = moves.join(funding, ["period", "instrument_id"], "left")
    periods = portfolio.perpetual_account(targets, moves, cost_rate, maintenance)
    gone = F.count_if("liquidated")
    grown = F.exp(F.sum(F.ln(F.when(F.col("net_return") > -1, 1 + F.col("net_return"))))) - 1
    done = periods.groupBy("strategy_id").agg(
        F.count("*").alias("n_periods"), F.when(gone > 0, -1.0).otherwise(grown).alias("net_return"), F.avg("turnover").alias("mean_turnover"),
        F.sum("cost").alias("total_trading_cost"), (-F.sum("funding")).alias("total_funding_cost"), (F.sum("cost") - F.sum("funding")).alias("total_cost"),
        F.sum("long_return").alias("long_return"), F.sum("short_return").alias("short_return"), gone.alias("liquidations"),
    )
    name = content_id({**setup, "strategy_id": F.col("strategy_id")}, "experiment")
    return done.join(met, "strategy_id", "left").fillna({"n_labels": 0}).withColumn("fingerprint", name)


def holdout(
    path: DataFrame, reported: DataFrame, initial: float, decisions: int, iterations: int, mean_block: int, seed: int,
    least: float = 0.02, alpha: float = 0.05,
) -> DataFrame:
    """A row for each session: its statistics worked out anew from the equity path, and the verdict on them.

    path: session, t, equity; reported: session, total (what the session says it earned). Nothing
    reported enters the statistics. Gives session, n, total, observed_mean, exceedances, p_value, fault and
    verdict. fault: decision_count (n is not decisions), non_positive_equity, total_mismatch (the path's
    total is not that of its returns), reported_mismatch (nor the session's own), else null; a session
    with a fault is INVALID.
    """
    moved = portfolio.equity_path(path, initial, 1.0)
    totals = moved.groupBy("session").agg(
        F.count("*").alias("n"), (F.max_by("equity", "t") / initial - 1).alias("total"), F.expm1(F.sum(F.log1p("ret"))).alias("compounded"), F.min("equity").alias("least_equity")
    )
    p = stats.stationary_p_values(moved.where("ret is not null"), ["session"], "t", "ret", iterations, mean_block, seed)
    met = totals.join(p.select("session", "observed_mean", "exceedances", "p_value"), "session", "left").join(reported.select("session", F.col("total").alias("said")), "session", "left")
    fault = (
        F.when(F.col("n") != decisions, "decision_count").when(F.col("least_equity") <= 0, "non_positive_equity")
        .when(F.abs(F.col("total") - F.col("compounded")) > 1e-9, "total_mismatch")
        .when(F.col("said").isNull() | (F.abs(F.col("total") - F.col("said")) > 1e-6), "reported_mismatch")
    )
    verdict = F.when(fault.isNull(), accepted(F.col("total"), F.col("p_value"), least, alpha)).otherwise("INVALID")
    return met.select("session", "n", "total", "observed_mean", "exceedances", "p_value", fault.alias("fault"), verdict.alias("verdict"))
