"""Linear factors over expanding training sets, from running sums, and boosted trees over binned cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators.ordered import running_sums

LEAST = 5
#: Cells of binned features that one model may have: the size of a group in boosted().
MOST_CELLS = 1 << 18


def elastic_net_beta(corr: np.ndarray, target: np.ndarray, alpha: float, l1_ratio: float, rounds: int = 10_000) -> np.ndarray:
    """Coordinate descent on moments: min b'Cb/2 - b't + alpha (l1 |b|_1 + (1 - l1) |b|^2 / 2), features in turn."""
    beta, lasso, decay = np.zeros(len(target)), alpha * l1_ratio, alpha * (1 - l1_ratio)
    for _ in range(rounds):
        before = beta.copy()
        for j in range(len(target)):
            rest = target[j] - corr[j] @ beta + corr[j, j] * beta[j]
            beta[j] = np.sign(rest) * max(abs(rest) - lasso, 0.0) / max(corr[j, j] + decay, 1e-300)
        if np.abs(beta - before).max(initial=0.0) <= 1e-14 * max(1.0, np.abs(beta).max(initial=0.0)):
            break
    return beta


def _solve(features: list[str], fit):
    """For mapInPandas: rows of running sums to rows of fits; fit(corr, target, n) gives standardized coefficients."""
    d = len(features)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for row in part.itertuples(index=False):
                n = row.n
                sx, sy = np.array([getattr(row, f"x{i}") for i in range(d)]), row.y
                xx, xy = np.zeros((d, d)), np.array([getattr(row, f"xy{i}") for i in range(d)])
                for i, j in pairs:
                    xx[i, j] = xx[j, i] = getattr(row, f"x{i}x{j}")
                mean, my = sx / n, sy / n
                cov, cxy = xx / n - np.outer(mean, mean), xy / n - mean * my
                scale = np.sqrt(np.maximum(np.diag(cov), 0))
                scale[scale == 0] = 1.0
                beta = fit(cov / np.outer(scale, scale), cxy / scale, n) / scale
                out.append((row.t, int(n), float(my - beta @ mean), beta.tolist()))
            yield pd.DataFrame(out, columns=["t", "n", "intercept", "beta"])

    return run


def complete(features: list[str]) -> Column:
    """Whether a row has every feature."""
    whole = F.lit(True)
    for f in features:
        whole = whole & F.col(f).isNotNull() & ~F.isnan(f)
    return whole


def expanding_sums(rows: DataFrame, features: list[str], sums: dict[str, Column]) -> DataFrame:
    """t and each of sums over the training rows of each decision time: those with all features and y whose label_end is at or before t.

    rows: t, label_end, y and features. Sums by label_end run on over time, so a row is added up once.
    """
    closed = rows.where(complete(features) & F.col("y").isNotNull()).groupBy(F.col("label_end").alias("t")).agg(*(v.alias(k) for k, v in sums.items())).withColumn("tag", F.lit(0))
    asked = rows.select("t").distinct().withColumn("tag", F.lit(1))
    both = closed.unionByName(asked, allowMissingColumns=True)
    both = both.select("t", "tag", *(F.coalesce(k, F.lit(0)).alias(k) for k in sums))
    return running_sums(both, ["t", "tag"], list(sums)).where("tag = 1").drop("tag")


def _expanding(rows: DataFrame, features: list[str], fit) -> DataFrame:
    d = len(features)
    whole = complete(features)
    xs, y = [F.col(f) for f in features], F.col("y")
    sums = {"n": F.count("*").cast("double"), "y": F.sum(y)} | {f"x{i}": F.sum(x) for i, x in enumerate(xs)}
    sums |= {f"xy{i}": F.sum(x * y) for i, x in enumerate(xs)} | {f"x{i}x{j}": F.sum(xs[i] * xs[j]) for i in range(d) for j in range(i, d)}
    running = expanding_sums(rows, features, sums).where(f"n >= {LEAST}")
    fits = running.mapInPandas(_solve(features, fit), "t long, n long, intercept double, beta array<double>")
    met = rows.where(whole).join(fits, "t")
    value = F.col("intercept")
    for i, x in enumerate(xs):
        value = value + F.col("beta")[i] * x
    return met.select("instrument_id", "t", value.alias("prediction"), "n")


def ridge(rows: DataFrame, features: list[str], alpha: float) -> DataFrame:
    """instrument_id, t, prediction, n: a ridge fit for each decision time on all rows whose labels closed by then.

    rows: instrument_id, t, label_end, y and features (doubles). Features are standardized over the
    training rows, the intercept is free. Rows that lack a feature or label don't train; rows that
    lack a feature, and times with fewer than LEAST training rows, have no prediction. Sums of
    products by label_end run on over time, so no time trains anew: one small solve for each.
    """
    return _expanding(rows, features, lambda corr, target, n: np.linalg.solve(corr + alpha / n * np.eye(len(target)), target))


def elastic_net(rows: DataFrame, features: list[str], alpha: float, l1_ratio: float) -> DataFrame:
    """As ridge, with the elastic net's penalty on standardized features and the mean squared error halved."""
    return _expanding(rows, features, lambda corr, target, n: elastic_net_beta(corr, target, alpha, l1_ratio))


def bin_edges(rows: DataFrame, features: list[str], bins: int) -> DataFrame:
    """One row: for each feature an array of its bins - 1 edges, the values at ranks floor(k n / bins), k from 1.

    Ranks are exact and counted by ranges of values, so no task sorts a whole column. Without rows the arrays are empty.
    """
    tall = rows.select(F.explode(F.array(*(F.struct(F.lit(i).alias("feature"), F.col(f).alias("value")) for i, f in enumerate(features)))).alias("x")).select("x.*")
    levels = tall.groupBy("feature", "value").agg(F.count("*").alias("n"))
    upto = running_sums(levels, ["feature", "value"], ["n"], within="feature").withColumnRenamed("n", "upto").join(levels, ["feature", "value"])
    total = rows.agg(F.count("*").alias("total"))
    wanted = F.sequence(F.lit(1), F.lit(bins - 1))
    hit = F.filter(wanted, lambda k: (F.floor(k * F.col("total") / bins) >= F.col("upto") - F.col("n")) & (F.floor(k * F.col("total") / bins) < F.col("upto")))
    # a single row joins, and at most (bins - 1) x features rows reach the arrays
    edges = upto.crossJoin(F.broadcast(total)).select("feature", "value", F.explode(hit).alias("k")).groupBy("feature").agg(F.array_sort(F.collect_set("value")).alias("edges"))
    by = [F.coalesce(F.max(F.when(F.col("feature") == i, F.col("edges"))), F.array().cast("array<double>")).alias(f) for i, f in enumerate(features)]
    return edges.agg(*by)


class Trees:
    """Gradient boosting of squared error over binned cells: counts and sums by cell are all that it needs."""

    def __init__(self, depth: int, trees: int, rate: float, penalty: float = 1.0) -> None:
        self.depth, self.trees, self.rate, self.penalty = depth, trees, rate, penalty

    def _best(self, bins: np.ndarray, n: np.ndarray, r: np.ndarray) -> tuple[int, int] | None:
        """(feature, edge) of the greatest gain over 0 of sending bins up to edge left; ties take the first."""
        best, found = 1e-12, None
        total_n, total_r = n.sum(), r.sum()
        score = lambda s, m: s * s / (m + self.penalty)
        for f in range(bins.shape[1]):
            size = int(bins[:, f].max()) + 1
            ln, lr = np.cumsum(np.bincount(bins[:, f], n, size))[:-1], np.cumsum(np.bincount(bins[:, f], r, size))[:-1]
            gain = np.where((ln >= 1) & (total_n - ln >= 1), score(lr, ln) + score(total_r - lr, total_n - ln) - score(total_r, total_n), -np.inf)
            if len(gain) and gain.max() > best * (1 + 1e-9):
                best, found = float(gain.max()), (f, int(gain.argmax()))
        return found

    def fit(self, bins: np.ndarray, n: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The prediction of each cell, trained on n rows with labels that add to sums in it (n 0: asked only)."""
        value = np.full(len(n), sums.sum() / n.sum())
        for _ in range(self.trees):
            left = sums - n * value  # what is not yet explained
            nodes = [np.arange(len(n))]
            for level in range(self.depth + 1):
                below = []
                for at in nodes:
                    split = self._best(bins[at], n[at], left[at]) if level < self.depth else None
                    if split is None:
                        value[at] += self.rate * left[at].sum() / (n[at].sum() + self.penalty)
                    else:
                        goes = bins[at, split[0]] <= split[1]
                        below += [at[goes], at[~goes]]
                nodes = below
        return value


def boosted(
    rows: DataFrame, features: list[str], times: list[int], bins: int = 16, depth: int = 3, trees: int = 100, rate: float = 0.1
) -> DataFrame:
    """instrument_id, t, prediction, n: boosted trees trained at each of times on all rows whose labels closed by then.

    Rows as for ridge; a row at t in times is predicted by the model of t. Features are binned at edges
    that the rows closed by the first time with any give, so none looks ahead. Trees see a row's bins
    only, so rows are added up by cell in Spark, and a model is grown from at most bins ** features cells
    (checked against MOST_CELLS), whatever the number of rows. Times with fewer than LEAST rows have none.
    """
    if bins ** len(features) > MOST_CELLS:
        raise ValueError("fewer bins or features: a model's cells would be over MOST_CELLS")
    times, cells = sorted(times), [f"bin{i}" for i in range(len(features))]
    rows = rows.where(complete(features))
    closed = rows.where(F.col("y").isNotNull() & (F.col("label_end") <= times[-1]))
    # the first time that a label is known at, as its place in times: a list the size of the schedule
    known = F.array_position(F.transform(F.array(*map(F.lit, times)), lambda t: t >= F.col("label_end")), True).cast("int")
    closed = closed.withColumn("turn", known)
    first = closed.agg(F.min("turn").alias("first"))
    start = closed.join(F.broadcast(first), F.col("turn") == F.col("first")).drop("first")
    edges = F.broadcast(bin_edges(start, features, bins))  # one row of at most bins values a feature
    named = edges.select(*(F.col(f).alias(f"edges{i}") for i, f in enumerate(features)))
    upto = lambda f: lambda edge: edge <= F.col(f)
    bin_of = [F.size(F.filter(f"edges{i}", upto(f))).alias(c) for i, (f, c) in enumerate(zip(features, cells))]
    binned = closed.crossJoin(named).select("turn", "y", *bin_of)  # a single row of edges, not a product
    deltas = binned.groupBy("turn", *cells).agg(F.count("*").alias("n"), F.sum("y").alias("sums"))
    later = F.explode(F.slice(F.array(*map(F.lit, times)), F.col("turn"), F.lit(len(times)))).alias("t")
    trained = deltas.select(later, *cells, "n", "sums")
    asked = rows.where(F.col("t").isin(times)).crossJoin(named).select("instrument_id", "t", *bin_of)
    zero = asked.select("t", *cells).distinct().select("t", *cells, F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("sums"))
    summed = trained.unionByName(zero).groupBy("t", *cells).agg(F.sum("n").alias("n"), F.sum("sums").alias("sums"))
    model = Trees(depth, trees, rate)

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(cells)
        total = int(part["n"].sum())
        if total < LEAST:
            return pd.DataFrame({c: [] for c in ("t", *cells, "n", "prediction")})
        value = model.fit(part[cells].to_numpy(np.int64), part["n"].to_numpy(np.float64), part["sums"].to_numpy(np.float64))
        return part[["t", *cells]].assign(n=total, prediction=value)

    grown = summed.groupBy("t").applyInPandas(grow, "t long, " + ", ".join(f"{c} int" for c in cells) + ", n long, prediction double")
    return asked.join(grown, ["t", *cells]).select("instrument_id", "t", "prediction", "n")
