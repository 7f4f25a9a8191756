"""Queries over calendars, versions and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import times as T
from tidelake.functions.times import DAY
from tidelake.operators import asof, calendar
from tidelake.plans import inputs as I
from tidelake.plans import inventory as N
from tidelake.plans import market as M

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


@query("""WITH o AS (SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'x-' || strftime(CAST(o_orderdate AS DATE), '%Y-%m') || '.zip' WHEN 1 THEN 'x-' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '.csv' ELSE 'x.txt' END AS name FROM orders)
SELECT id, CASE WHEN name <> 'x.txt' THEN name[3:-5] END AS period, CASE WHEN name LIKE '%.zip' THEN 'monthly' WHEN name LIKE '%.csv' THEN 'daily' END AS cadence FROM o""")
def f7_object_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("x-"), F.date_format(d, "yyyy-MM"), F.lit(".zip"))).when(k % 3 == 1, F.concat(F.lit("x-"), F.date_format(d, "yyyy-MM-dd"), F.lit(".csv"))).otherwise("x.txt")
    return I.table(spark, sf_dir, "orders").select(k.alias("id"), calendar.period_of(name).alias("period"), calendar.cadence_of(name).alias("cadence"))


@query("""WITH m AS (SELECT DISTINCT o_custkey, date_trunc('month', CAST(o_orderdate AS DATE)) AS m FROM orders), n AS (SELECT o_custkey, CAST(m AS DATE) AS after, CAST(m + INTERVAL 1 MONTH AS DATE) AS expected, CAST(lead(m) OVER (PARTITION BY o_custkey ORDER BY m) AS DATE) AS nx FROM m)
SELECT o_custkey, CAST(after AS VARCHAR) AS after, CAST(expected AS VARCHAR) AS expected FROM n WHERE nx IS NOT NULL AND nx <> expected""")
def w8_month_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = I.table(spark, sf_dir, "orders").select("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("m")).distinct()
    return calendar.month_opens_missing(m, "o_custkey", "m").select("o_custkey", F.col("after").cast("string").alias("after"), F.col("expected").cast("string").alias("expected"))


@query(f"""WITH {I.TRADES}, a AS (SELECT DISTINCT ts_us - ts_us % {DAY} AS t FROM t WHERE (ts_us // {DAY}) % 5 <> 0), e AS (SELECT unnest(generate_series({I.START}, {I.START + 40 * DAY}, {DAY})) AS t),
 w AS (SELECT CASE WHEN e.t > {I.START + 25 * DAY} THEN 'future' WHEN a.t IS NOT NULL THEN 'present' ELSE 'missing' END AS status FROM e LEFT JOIN a USING (t) WHERE e.t > {I.START + 9 * DAY} UNION ALL SELECT 'refused' FROM a WHERE t > {I.START + 25 * DAY}) SELECT status, count(*) AS rows FROM w GROUP BY 1""")
def q10_holdout_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = I.trades(spark, sf_dir).select(T.floor_to(F.col("ts_us"), DAY).alias("t")).where(F.floor(F.col("t") / DAY) % 5 != 0).distinct()
    e = spark.range(1).select(F.explode(F.sequence(F.lit(I.START), F.lit(I.START + 40 * DAY), F.lit(DAY))).alias("t"))
    return calendar.holdout_readiness(e, a, I.START + 9 * DAY, I.START + 25 * DAY)


@query("""SELECT o_custkey, o_orderkey, o_orderstatus AS quality FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderkey DESC) = 1""")
def o5_preferred_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.preferred_version(I.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("quality")), "o_custkey", ["F", "O"], ["o_orderkey"])


@query("SELECT p_partkey FROM part ORDER BY p_partkey % 7, p_partkey LIMIT 40 OFFSET 25")
def o6_census_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 7).alias("r"))
    return calendar.slice_of(p, ["r", "p_partkey"], 25, 40).drop("r")


@query("""WITH p AS (SELECT l_returnflag, l_suppkey, min(m) AS a, max(m) AS z FROM (SELECT *, year(CAST(l_shipdate AS DATE)) * 12 + month(CAST(l_shipdate AS DATE)) AS m FROM lineitem) GROUP BY 1, 2) SELECT l_returnflag, count(*) AS groups, min(a) AS first, max(z) AS last, min(z - a + 1) AS shortest, max(z - a + 1) AS longest FROM p GROUP BY 1""")
def a27_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("l_shipdate").cast("date")
    return calendar.extents(I.table(spark, sf_dir, "lineitem").withColumn("m", (F.year(d) * 12 + F.month(d)).cast("long")), "l_returnflag", "l_suppkey", "m")


@query("""WITH r AS (SELECT user_id, event_id, epoch_us(ts) - (event_id % 7) * 600000000 AS t FROM events), b AS (SELECT *, lag(t) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM r) SELECT * FROM b WHERE t <= before""")
def t6_not_advancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = I.table(spark, sf_dir, "events").select("user_id", "event_id", (T.us("ts") - (F.col("event_id") % 7) * 600_000_000).alias("t"))
    return calendar.not_advancing(r, "user_id", "event_id", "t")


@query(f"""WITH {N.PANEL} SELECT t, count(*) AS covered, count(*) FILTER (WHERE coalesce(died < t, FALSE)) AS dead, count(*) FILTER (WHERE NOT coalesce(died < t, FALSE)) AS "left" FROM sp JOIN d ON a <= t AND t <= z LEFT JOIN dd USING (instrument_id) GROUP BY 1""")
def a28_coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = I.bars(spark, sf_dir).groupBy("instrument_id").agg(F.min("period_start").alias("a"), F.max("availability").alias("z"))
    dead = span.where("instrument_id % 4 = 0").select("instrument_id", (F.col("a") + 3 * DAY * (1 + F.col("instrument_id") % 9)).alias("died"))
    times = spark.range(1).select(F.explode(F.sequence(F.lit(I.START + 10 * DAY), F.lit(I.START + 29 * DAY), F.lit(5 * DAY))).alias("t"))
    return calendar.coverage_by_time(span, dead, times, "instrument_id")


@query(f"WITH {M.VERSIONS}, {M.ASKS} SELECT part, t, k, id FROM a JOIN v USING (part) WHERE {M.ELIGIBLE} QUALIFY row_number() OVER (PARTITION BY part, t, k ORDER BY version DESC, id DESC) = 1")
def j5_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.reference_latest(M.asks(spark, sf_dir), M.versions(spark, sf_dir), "part", ["version", "id"]).select("part", "t", "k", "id")


@query(f"""WITH {N.EVIDENCE}, l AS (SELECT hypothesis, version, list_sort(list(DISTINCT evidence_id)) AS e FROM li GROUP BY 1, 2)
SELECT hypothesis, '[' || string_agg('{{"version":' || version || ',"evidence":[' || coalesce(array_to_string(e, ','), '') || ']}}', ',' ORDER BY version) || ']' AS json FROM ve LEFT JOIN l USING (hypothesis, version) GROUP BY 1""")
def k5_state_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions, _, links, _ = N.evidence(spark, sf_dir)
    return calendar.state_export(versions, links)
