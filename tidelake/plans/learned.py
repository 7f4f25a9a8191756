"""Factors that learn: linear ones and boosted trees over expanding training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.times import DAY
from tidelake.operators import models
from tidelake.plans import inputs as I
from tidelake.plans.market import WF, WINDOWS, R, ridge_rows, rounded

QUERIES: dict = {}
SQL: dict[str, str] = {}
FEATURES = ["momentum", "mean_reversion", "volume_ratio"]
RIDGE, ALPHA, L1 = 1.0, 0.05, 0.5
ROUNDS = 120


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def linear_sql(lasso: str, decay: str) -> str:
    """Coordinate descent in SQL: moments of the rows closed by each time, then ROUNDS turns over three features."""
    moments = ", ".join(
        [f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}, covar_pop(x{i}, y) AS c{i}" for i in range(3)]
        + [f"covar_pop(x{i}, x{j}) AS c{i}{j}" for i, j in ((0, 1), (0, 2), (1, 2))]
    )
    unit = ", ".join(
        [f"c{i} / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END AS t{i}, CAST(s{i} > 0 AS DOUBLE) AS d{i}" for i in range(3)]
        + [f"CASE WHEN s{i} * s{j} = 0 THEN 0 ELSE c{i}{j} / s{i} / s{j} END AS r{i}{j}" for i, j in ((0, 1), (0, 2), (1, 2))]
    )
    step = lambda r, d: f"sign({r}) * greatest(abs({r}) - {lasso}, 0) / ({d} + {decay})"
    return f"""WITH RECURSIVE {WINDOWS}, a AS (SELECT instrument_id, period_start, availability AS t, momentum AS x0,
  CASE WHEN n = {WF} AND s > 0 THEN -(close - m) / s END AS x1, CASE WHEN n = {WF} AND v > 0 THEN base_volume / v END AS x2,
  lead(availability) OVER o AS label_end, lead(close) OVER o / close - 1 AS y FROM w WINDOW o AS (PARTITION BY instrument_id ORDER BY period_start)),
 c AS (SELECT * FROM a WHERE x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL), tt AS (SELECT DISTINCT t FROM a),
 mo AS (SELECT tt.t, count(*) AS n, avg(y) AS my, {moments} FROM tt JOIN c ON c.label_end <= tt.t AND y IS NOT NULL GROUP BY tt.t HAVING count(*) >= 5),
 un AS (SELECT *, {unit} FROM mo),
 cd AS (SELECT 0 AS k, un.*, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM un
  UNION ALL SELECT k + 1, * EXCLUDE (k, b0, b1, b2, z0, z1, z2), z0, z1, z2 FROM (
   SELECT *, {step("(t2 - r02 * z0 - r12 * z1)", "d2")} AS z2 FROM (
    SELECT *, {step("(t1 - r01 * z0 - r12 * b2)", "d1")} AS z1 FROM (
     SELECT *, {step("(t0 - r01 * b1 - r02 * b2)", "d0")} AS z0 FROM cd WHERE k < {ROUNDS}))))
SELECT instrument_id, c.t, cd.n AS n, round(my + {" + ".join(f"b{i} / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END * (x{i} - m{i})" for i in range(3))}, {R}) AS prediction
FROM cd JOIN c ON c.t = cd.t WHERE k = {ROUNDS}"""


@query(linear_sql("0", f"{RIDGE} / n"))
def v12_ridge_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(models.ridge(ridge_rows(spark, sf_dir), FEATURES, RIDGE), "prediction")


@query(linear_sql(str(ALPHA * L1), str(ALPHA * (1 - L1))))
def v12_elastic_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(models.elastic_net(ridge_rows(spark, sf_dir), FEATURES, ALPHA, L1), "prediction")


@query(f"""WITH {WINDOWS}, a AS (SELECT instrument_id, availability AS t, momentum AS x, lead(availability) OVER o AS label_end, lead(close) OVER o / close - 1 AS y FROM w WINDOW o AS (PARTITION BY instrument_id ORDER BY period_start)),
 tt AS (SELECT DISTINCT t FROM a) SELECT tt.t, count(label_end) AS n, round(coalesce(sum(y), 0), {R}) AS y, round(coalesce(sum(x * y), 0), {R}) AS xy FROM tt LEFT JOIN a ON label_end <= tt.t AND x IS NOT NULL AND y IS NOT NULL GROUP BY tt.t""")
def w25_expanding_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each decision time may train on: rows whose labels closed by then, as running sums over time."""
    rows = ridge_rows(spark, sf_dir)
    return rounded(models.expanding_sums(rows, ["momentum"], {"n": F.count("*"), "y": F.sum("y"), "xy": F.sum(F.col("momentum") * F.col("y"))}), "y", "xy")


@query()
def v12_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained anew every seventh day, on all bars closed by then."""
    times = [I.START + d * DAY for d in range(7, 31, 7)]
    return models.boosted(ridge_rows(spark, sf_dir), FEATURES, times)
