"""Bootstrap significance and multiple testing.

Draws come from MD5 of (seed, iteration, step), so they are the same on any cluster and in any
engine, and all strategies of a joint test share them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: int, *of: Column) -> Column:
    """An integer from 0 to 2**32 - 1 that depends on seed and columns alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *of).cast("binary")), 1, 8), 16, 10).cast("long")


def numbered(returns: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """keys, i (from 0), x, n, mean of each key's values in order."""
    by = Window.partitionBy(*keys)
    return returns.select(*keys, (F.row_number().over(by.orderBy(order)) - 1).alias("i"), F.col(value).alias("x"), F.count("*").over(by).alias("n"), F.avg(value).over(by).alias("mean"))


#: Iterations of a key that are dealt out together; a key's values travel once for each such lot.
LOT = 500


def _iterations(rows: DataFrame, keys: list[str], held: dict[str, Column], iterations: int) -> DataFrame:
    """keys, n, mean, held, b: a row for each key and iteration, spread over the cluster by lots of iterations.

    held: aggregates of a key's values (as arrays, bounded by its periods), which are all that a
    resampled path needs: paths are folded where they are, without a shuffle.
    """
    lots = F.explode(F.sequence(F.lit(0), F.lit((iterations - 1) // LOT))).alias("lot")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number: the rows are few and small, their work is not
    each = rows.groupBy(*keys, "n", "mean").agg(*(v.alias(k) for k, v in held.items())).select("*", lots).repartition(parts, *keys, "lot")
    last = F.least(F.col("lot") * LOT + (LOT - 1), F.lit(iterations - 1))
    return each.select(*keys, "n", "mean", *held, F.explode(F.sequence(F.col("lot") * LOT, last)).alias("b"))


def _in_order(value: Column) -> Column:
    """A key's values as an array by i."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col("i"), value.alias("v")))), lambda x: x["v"])


def stationary_p_values(returns: DataFrame, keys: list[str], order: str, value: str, iterations: int, mean_block: int, seed: int) -> DataFrame:
    """keys, n, observed_mean, exceedances, p_value: one-sided stationary bootstrap of mean > 0.

    Values are centred; a path starts a new block with probability 1 / mean_block at each step, else
    goes on, around the end.
    """
    rows = numbered(returns, keys, order, value)
    paths = _iterations(rows, keys, {"c": _in_order(F.col("x") - F.col("mean"))}, iterations)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0.0).alias("sum"))

    def step(state: Column, k: Column) -> Column:
        new = (k == 0) | (draw(seed, F.lit("new"), F.col("b"), k) % mean_block == 0)
        at = F.when(new, draw(seed, F.lit("at"), F.col("b"), k) % F.col("n")).otherwise((state["at"] + 1) % F.col("n"))
        return F.struct(at.alias("at"), (state["sum"] + F.get("c", state["at"].cast("int")) * F.when(k > 0, 1.0).otherwise(0.0)).alias("sum"))

    # a step adds the place chosen by the one before, so that a place is worked out once; the last is added at the end
    mean = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), start, step, lambda s: s["sum"] + F.get("c", s["at"].cast("int"))) / F.col("n")
    # sums in another order may differ in the last digits; a tie counts as an exceedance
    out = paths.groupBy(*keys, "n", "mean").agg(F.count_if(mean >= F.col("mean") - 1e-12).alias("exceedances"))
    return out.select(*keys, "n", F.col("mean").alias("observed_mean"), "exceedances", ((F.col("exceedances") + 1) / (iterations + 1.0)).alias("p_value"))


def block_totals(returns: DataFrame, keys: list[str], order: str, value: str, iterations: int, block: int, seed: int) -> DataFrame:
    """keys, b, total: block-bootstrapped total returns of centred log returns; keys with as many values share their draws.

    Blocks of `block` values start anywhere inside and are cut at n values in all. Log is taken once. A
    block's total is a difference of running sums, so a path takes n / block steps.
    """
    logs = returns.where(F.col(value) > -1).withColumn("log", F.log1p(value))
    rows = numbered(logs, keys, order, "log").where(F.col("n") >= block)
    upto = F.sum(F.col("x") - F.col("mean")).over(Window.partitionBy(*keys).orderBy("i"))
    paths = _iterations(rows.withColumn("s", upto), keys, {"sums": F.concat(F.array(F.lit(0.0)), _in_order(F.col("s")))}, iterations)

    def step(total: Column, j: Column) -> Column:
        start = (draw(seed, F.col("b"), j) % (F.col("n") - block + 1)).cast("int")
        size = F.least(F.lit(block).cast("long"), F.col("n") - j * block).cast("int")
        return total + F.get("sums", start + size) - F.get("sums", start)

    total = F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / block) - 1), F.lit(0.0), step)
    return paths.select(*keys, "b", F.expm1(total).alias("total"))


def observed_totals(returns: DataFrame, keys: list[str], value: str) -> DataFrame:
    return returns.where(F.col(value) > -1).groupBy(*keys).agg(F.expm1(F.sum(F.log1p(value))).alias("observed"))


def block_p_values(returns: DataFrame, keys: list[str], order: str, value: str, iterations: int, block: int, seed: int) -> DataFrame:
    """keys, observed, p_value: the share of totals at or over the observed one, 1 / (iterations + 1) at least."""
    met = block_totals(returns, keys, order, value, iterations, block, seed).join(observed_totals(returns, keys, value), keys)
    share = F.avg((F.col("total") >= F.col("observed") - 1e-12).cast("double"))
    return met.groupBy(*keys, "observed").agg(F.greatest(share, F.lit(1.0 / (iterations + 1))).alias("p_value"))


def reality_check(returns: DataFrame, strategy: str, order: str, value: str, iterations: int, block: int, seed: int, excess: bool = False) -> DataFrame:
    """best, observed, p_value of the best strategy's total among the best of each joint resample.

    With excess, all totals are taken over a benchmark, the mean log return of all strategies and periods.
    """
    totals = block_totals(returns, [strategy], order, value, iterations, block, seed)
    seen = observed_totals(returns, [strategy], value)
    logs = returns.where(F.col(value) > -1).groupBy(strategy).agg(F.sum(F.log1p(value)).alias("s"), F.count("*").alias("n"))
    bench = logs.agg(F.expm1(F.sum("s") / F.sum("n") * F.max("n")).alias("bench")) if excess else None
    top = seen.agg(F.max_by(strategy, F.struct("observed", strategy)).alias("best"), F.max("observed").alias("observed"))
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    joined = most.join(F.broadcast(top))  # one row
    if bench is not None:
        joined = joined.join(F.broadcast(bench)).withColumn("observed", F.col("observed") - F.col("bench")).withColumn("most", F.col("most") - F.col("bench"))
    share = F.avg((F.col("most") >= F.col("observed") - 1e-12).cast("double"))
    return joined.groupBy("best", "observed").agg(F.greatest(share, F.lit(1.0 / (iterations + 1))).alias("p_value"))


def adjust(p_values: DataFrame, alpha: float) -> DataFrame:
    """p_values (strategy, p_value) with bonferroni, bonferroni_rejected, q_value (Benjamini-Hochberg), bh_rejected."""
    m = F.count("*").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy("p_value", "strategy"))
    ranked = p_values.withColumn("m", m).withColumn("place", place)
    falling = Window.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0)
    q = F.min(F.least(F.col("p_value") * F.col("m") / F.col("place"), F.lit(1.0))).over(falling)
    return ranked.withColumn("q_value", q).select(
        "strategy", "p_value", F.least(F.col("p_value") * F.col("m"), F.lit(1.0)).alias("bonferroni"), (F.col("p_value") <= alpha / F.col("m")).alias("bonferroni_rejected"),
        "q_value", (F.col("q_value") <= alpha).alias("bh_rejected"),
    )
