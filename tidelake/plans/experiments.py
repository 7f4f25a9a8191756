"""Queries over whole experiments, their ids and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.functions import canon
from tidelake.functions.times import DAY
from tidelake.operators import experiments, factors, labels, portfolio, stats
from tidelake.plans import inputs as I
from tidelake.plans import market as M
from tidelake.plans.market import COST, R, rounded

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


MADE = ["net_return", "mean_turnover", "total_trading_cost", "total_funding_cost", "total_cost", "long_return", "short_return"]
# ranks by score within a time, from -0.5 to 0.5, over their gross; ta and mv are what the accounting reads
RANKED = """rw AS (SELECT strategy_id, t, instrument_id, count(*) OVER g AS n, (row_number() OVER (PARTITION BY strategy_id, t ORDER BY score, instrument_id) - 1) / nullif(count(*) OVER g - 1, 0) - 0.5 AS raw
  FROM sc WINDOW g AS (PARTITION BY strategy_id, t)),
 ta AS (SELECT strategy_id, t AS period, instrument_id, CASE WHEN n = 1 THEN 1.0 ELSE raw / sum(abs(raw)) OVER (PARTITION BY strategy_id, t) END AS weight FROM rw)"""
SCORES = M.SCREEN[: M.SCREEN.index(" tw AS")] + " sc AS (SELECT strategy_id, t, instrument_id, score FROM mo)"


@query(f"""WITH RECURSIVE {SCORES}, {RANKED}, re AS (SELECT t AS period, instrument_id, e1 / e0 - 1 AS ret FROM en JOIN ex USING (instrument_id, t)),
 mv AS (SELECT *, (instrument_id % 7 - 3) / 10000.0 AS funding_rate FROM re), {M.perpetual_sql(COST, 0.05)},
 me AS (SELECT strategy_id, count(*) AS n_labels FROM ta JOIN re USING (period, instrument_id) GROUP BY 1)
SELECT strategy_id, 'experiment:' || sha256('{{"cost":"0.001","embargo":{{"days":1,"kind":"purged"}},"horizon_days":1,"strategy_id":"' || strategy_id || '"}}') AS fingerprint,
 count(*) AS n_periods, coalesce(any_value(n_labels), 0) AS n_labels,
 round(CASE WHEN count(*) FILTER (WHERE liquidated) > 0 THEN -1.0 ELSE exp(sum(CASE WHEN net_return > -1 THEN ln(1 + net_return) END)) - 1 END, {R}) AS net_return,
 round(avg(turnover), {R}) AS mean_turnover, round(sum(cost), {R}) AS total_trading_cost, round(-sum(funding), {R}) AS total_funding_cost, round(sum(cost) - sum(funding), {R}) AS total_cost,
 round(sum(long_return), {R}) AS long_return, round(sum(short_return), {R}) AS short_return, count(*) FILTER (WHERE liquidated) AS liquidations
FROM pn LEFT JOIN me USING (strategy_id) GROUP BY strategy_id""")
def v13_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two momentum factors from ticks to labels, long/short ranks and perpetual accounts."""
    b, d = I.bars(spark, sf_dir), I.decisions(spark, sf_dir)
    values = factors.momentum_grid(d, b, M.CONFIGS).withColumnRenamed("raw_value", "score")
    targets = portfolio.rank_weights(values, across=("config_id", "t")).select(F.col("config_id").alias("strategy_id"), F.col("t").alias("period"), "instrument_id", "weight")
    known = labels.forward_labels(d, b, 0, DAY).checkpoint()
    funding = known.select(F.col("t").alias("period"), "instrument_id", ((F.col("instrument_id") % 7 - 3) / 10000.0).alias("funding_rate"))
    setup = {"cost": F.lit("0.001"), "horizon_days": F.lit(1), "embargo": {"days": F.lit(1), "kind": F.lit("purged")}}
    return rounded(experiments.experiment(targets, known, funding, setup, COST, 0.05), *MADE)


# a period that loses all leaves nothing for those after it
SESSION = """pt AS (SELECT strategy_id AS session, period AS t, CASE WHEN max(CAST(net_return <= -1 AS INTEGER)) OVER w = 1 THEN 0.0 ELSE 1000 * exp(sum(CASE WHEN net_return > -1 THEN ln(1 + net_return) END) OVER w) END AS equity
  FROM ac WINDOW w AS (PARTITION BY strategy_id ORDER BY period)),
 pv AS (SELECT *, coalesce(lag(equity) OVER (PARTITION BY session ORDER BY t), 1000.0) AS prior FROM pt), mv AS (SELECT session, t, equity, CASE WHEN prior > 0 THEN equity / prior - 1 END AS ret FROM pv),
 ac2 AS (SELECT session AS strategy_id, t AS period, ret AS net_return FROM mv WHERE ret IS NOT NULL)"""
BOOTSTRAP = M.SQL["v6_stationary_bootstrap"].removeprefix(f"WITH {M.ACCOUNT}, ").replace("FROM ac)", "FROM ac2)").replace(f"round(m, {R})", "m").replace("round((count(*)", "((count(*)").replace(f"(10000 + 1.0), {R})", "(10000 + 1.0))")


@query(f"""WITH {M.ACCOUNT}, {SESSION}, {BOOTSTRAP[: BOOTSTRAP.index("SELECT strategy_id, n, m AS observed_mean")].rstrip()}, bo AS ({BOOTSTRAP[BOOTSTRAP.index("SELECT strategy_id, n, m AS observed_mean"):]}),
 tt AS (SELECT session, count(*) AS n, last(equity ORDER BY t) / 1000.0 - 1 AS total, min(equity) AS least_equity FROM mv GROUP BY 1),
 fa AS (SELECT *, CASE WHEN n <> (SELECT max(n) FROM tt) THEN 'decision_count' WHEN least_equity <= 0 THEN 'non_positive_equity' WHEN session = 2 THEN 'reported_mismatch' END AS fault FROM tt)
SELECT session, fa.n, round(total, {R}) AS total, round(observed_mean, {R}) AS observed_mean, exceedances, round(p_value, {R}) AS p_value, fault,
 CASE WHEN fault IS NOT NULL THEN 'INVALID' WHEN total >= 0.02 AND p_value <= 0.05 THEN 'ACCEPT' ELSE 'REJECT' END AS verdict FROM fa LEFT JOIN bo ON bo.strategy_id = session""")
def v14_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equity paths of the strategies as sessions; session 2 reports a total that its path does not have."""
    net = M.net_returns(spark, sf_dir)
    upto = Window.partitionBy("strategy_id").orderBy("period")
    left = 1000 * F.exp(F.sum(F.when(F.col("net_return") > -1, F.log1p("net_return"))).over(upto))
    gone = F.max((F.col("net_return") <= -1).cast("int")).over(upto) == 1
    path = net.select(F.col("strategy_id").alias("session"), F.col("period").alias("t"), F.when(gone, 0.0).otherwise(left).alias("equity"))
    reported = path.groupBy("session").agg((F.max_by("equity", "t") / 1000 - 1).alias("total")).withColumn("total", F.col("total") + F.when(F.col("session") == 2, 0.01).otherwise(0.0))
    most = net.groupBy("strategy_id").count().agg(F.max("count")).first()[0] or 0
    return rounded(experiments.holdout(path, reported, 1000.0, most, M.B_, M.BLOCK, M.SEED), "total", "observed_mean", "p_value")


@query("""SELECT o_orderkey, '{"key":' || o_orderkey || ',"when":{"day":' || date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) || ',"status":"' || o_orderstatus || '"},"who":' ||
 CASE WHEN o_custkey % 5 = 0 THEN 'null' ELSE CAST(o_custkey AS VARCHAR) END || '}' AS json FROM orders""")
def f16_canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    who = F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey"))
    fields = {"who": who, "when": {"status": F.col("o_orderstatus"), "day": day}, "key": F.col("o_orderkey")}
    return I.table(spark, sf_dir, "orders").select("o_orderkey", canon.canonical_json(fields).alias("json"))


@query("""SELECT o_custkey, 'bundle:' || sha256('{"orders":[' || string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) || ']}') AS id FROM orders GROUP BY o_custkey""")
def f14_content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bundle for each customer: the id does not depend on the order that its orders come in."""
    per = I.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("keys"))
    return per.select("o_custkey", canon.content_id({"orders": canon.sorted_unique(F.col("keys"))}, "bundle").alias("id"))


@query("""SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS kinds, string_agg(o_orderpriority || '=' || n, '|' ORDER BY o_orderpriority) AS counts
 FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey""")
def f17_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = I.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderpriority").alias("all"))
    counts = F.transform(F.map_entries(canon.distribution(F.col("all"))), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return per.select("o_custkey", F.array_join(canon.sorted_unique(F.col("all")), "|").alias("kinds"), F.array_join(counts, "|").alias("counts"))


@query(f"""WITH {M.TOTALS}, pv AS (SELECT strategy_id, observed, greatest(avg(CAST(total >= observed - 1e-12 AS DOUBLE)), 1.0 / (10000 + 1)) AS p_value FROM tt JOIN ob USING (strategy_id) GROUP BY strategy_id, observed)
SELECT strategy_id, round(observed, {R}) AS observed, round(p_value, {R}) AS p_value, CASE WHEN observed >= -0.5 AND p_value <= 0.6 THEN 'ACCEPT' ELSE 'REJECT' END AS verdict FROM pv""")
def f19_accept_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = stats.block_p_values(M.net_returns(spark, sf_dir), ["strategy_id"], "period", "net_return", M.B_, M.BLOCK, M.SEED)
    return rounded(p.withColumn("verdict", experiments.accepted(F.col("observed"), F.col("p_value"), -0.5, 0.6)), "observed", "p_value")
