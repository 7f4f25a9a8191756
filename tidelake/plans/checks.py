"""Queries over quality checks, universes, inventories and event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import checks as C
from tidelake.functions import times as T
from tidelake.functions.times import DAY, HOUR
from tidelake.operators import quality, universe
from tidelake.plans import inputs as I
from tidelake.plans.market import R, rounded

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


# ---- quality

BAD = """bt AS (SELECT event_id AS trade_id, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN -value ELSE value END AS price, event_id % 5 AS quantity, epoch_us(ts) AS ts_us FROM events)"""


def bad_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events")
    price = F.when(F.col("event_id") % 17 == 0, F.lit(None)).when(F.col("event_id") % 19 == 0, -F.col("value")).otherwise(F.col("value"))
    return e.select(F.col("event_id").alias("trade_id"), price.alias("price"), (F.col("event_id") % 5).alias("quantity"), T.us("ts").alias("ts_us"))


@query(f"""WITH {BAD}, l AS (SELECT trade_id, 'non_positive_price' AS code, price AS p FROM bt WHERE NOT coalesce(price > 0, FALSE) UNION ALL SELECT trade_id, 'non_positive_quantity', NULL FROM bt WHERE NOT quantity > 0)
SELECT trade_id, code, 'ERROR' AS severity FROM l""")
def q4_trade_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.issue_rows(quality.check_trades(bad_trades(spark, sf_dir)), "trade_id").drop("context")


@query(f"WITH {BAD} SELECT trade_id, price, quantity, ts_us FROM bt WHERE price > 0 AND quantity > 0")
def q4_accepted_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted(quality.check_trades(bad_trades(spark, sf_dir)))


@query(f"""WITH c AS (SELECT event_id, {I.START} + event_id * {T.MINUTE} + CASE WHEN event_id % 23 = 0 THEN 1 ELSE 0 END AS open_us, value AS o, value + event_id % 3 - CASE WHEN event_id % 29 = 0 THEN 5 ELSE 0 END AS h, value - 0.01 AS l, value AS c FROM events WHERE value > 1),
 l AS (SELECT event_id, 'unsound_ohlc' AS code FROM c WHERE NOT (l > 0 AND h >= greatest(o, c) AND l <= least(o, c)) UNION ALL SELECT event_id, 'misaligned_open' FROM c WHERE event_id % 23 = 0 UNION ALL SELECT event_id, 'close_mismatch' FROM c WHERE event_id % 31 = 0)
SELECT event_id, code, 'ERROR' AS severity FROM l""")
def q3_candle_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    open_us = I.START + e * T.MINUTE + F.when(e % 23 == 0, 1).otherwise(0)
    high = F.col("value") + e % 3 - F.when(e % 29 == 0, 5).otherwise(0)
    rows = I.table(spark, sf_dir, "events").where("value > 1").select("event_id", open_us.alias("open_us"), (open_us + T.MINUTE - 1 + F.when(e % 31 == 0, 1).otherwise(0)).alias("close_us"), F.col("value").alias("open"), high.alias("high"), (F.col("value") - 0.01).alias("low"), F.col("value").alias("close"), F.lit(1.0).alias("volume"))
    return quality.issue_rows(quality.check_candles(rows, T.MINUTE), "event_id").drop("context")


@query("""SELECT count(*) AS rows, min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last, count(*) FILTER (WHERE NOT (value - 1 > 0 AND value + event_id % 3 - 1 >= value)) AS unsound, 'Time|o|h|l|c' AS roles FROM events""")
def q2_resolved_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as prices under short names: roles are found by name, then times and prices are profiled."""
    v, us = F.col("value"), F.unix_micros(F.col("ts").cast("timestamp"))
    rows = I.table(spark, sf_dir, "events").select(us.alias("Time"), v.alias("o"), (v + F.col("event_id") % 3 - 1).alias("h"), (v - 1).alias("l"), v.alias("c"), "event_id")
    roles, _ = quality.resolve_columns(rows.columns)
    return quality.profile_roles(rows, roles).withColumn("roles", F.lit("|".join(roles.values())))


@query("""WITH l AS (SELECT 'o_custkey' AS "column", CAST(o_custkey AS VARCHAR) AS v FROM orders UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders UNION ALL SELECT 'token', CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'true' WHEN 3 THEN '1.5' ELSE CAST(o_orderkey AS VARCHAR) END FROM orders),
 k AS (SELECT *, CASE WHEN v IS NULL THEN 'null' WHEN trim(v) = '' THEN 'empty' WHEN lower(v) IN ('true', 'false') THEN 'boolean' WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 'integer' WHEN regexp_full_match(v, '[+-]?([0-9]+[.][0-9]*|[.][0-9]+)') THEN 'float' ELSE 'string' END AS kind FROM l)
SELECT "column", count(*) AS rows, count(*) FILTER (WHERE v IS NULL) AS nulls, count(DISTINCT v) AS "distinct", array_to_string(list_sort(list_distinct(list(kind))), ',') AS classes, min(try_cast(v AS DOUBLE)) AS least, max(try_cast(v AS DOUBLE)) AS most FROM k GROUP BY 1""")
def q1_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    token = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "").when(k % 5 == 2, "true").when(k % 5 == 3, "1.5").otherwise(k.cast("string"))
    return quality.profile(I.table(spark, sf_dir, "orders").withColumn("token", token), ["o_custkey", "o_orderstatus", "token"])


@query("WITH c AS (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) SELECT count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM c")
def a8_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(I.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("""WITH e AS (SELECT user_id, epoch_us(ts) AS at_us FROM events), d AS (SELECT user_id, at_us - lag(at_us) OVER (PARTITION BY user_id ORDER BY at_us) AS d FROM e), m AS (SELECT user_id, quantile_disc(d, 0.5) AS median FROM d WHERE d IS NOT NULL GROUP BY 1)
SELECT user_id, median, count(*) AS deltas, count(*) FILTER (WHERE d > 3 * median) AS gaps FROM d JOIN m USING (user_id) WHERE d IS NOT NULL GROUP BY 1, 2""")
def w11_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cadence(I.table(spark, sf_dir, "events").withColumn("at_us", T.us("ts")), "user_id", "at_us")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS x, lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders), c AS (SELECT o_custkey, count(*) AS rows, count(*) FILTER (WHERE x > b) AS ups, count(*) FILTER (WHERE x < b) AS downs FROM o GROUP BY 1)
SELECT *, CASE WHEN rows = 1 THEN 'single' WHEN ups > 0 AND downs > 0 THEN 'mixed' WHEN ups > 0 THEN 'ascending' WHEN downs > 0 THEN 'descending' ELSE 'flat' END AS "order" FROM c""")
def w14_ordering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ordering(I.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date")), "o_custkey", "o_orderkey", "o_orderdate")


HOURS = f"""h AS (SELECT DISTINCT user_id, epoch_us(ts) - epoch_us(ts) % {HOUR} AS at_us FROM events)"""


def hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "events").select("user_id", T.floor_to(T.us("ts"), HOUR).alias("at_us")).distinct()


@query(f"""WITH {HOURS}, g AS (SELECT user_id, lag(at_us) OVER (PARTITION BY user_id ORDER BY at_us) AS after, at_us AS before FROM h) SELECT user_id, after, before, (before - after - 1) // {HOUR} AS missing FROM g WHERE before - after > {HOUR}""")
def w9_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gaps(hours(spark, sf_dir), "user_id", "at_us", HOUR)


@query(f"""WITH {HOURS}, m AS (SELECT *, CASE WHEN at_us - coalesce(lag(at_us) OVER o, at_us - {HOUR}) <> {HOUR} THEN 1 ELSE 0 END AS bad FROM h WINDOW o AS (PARTITION BY user_id ORDER BY at_us)), r AS (SELECT *, max(bad) OVER (PARTITION BY user_id ORDER BY at_us) AS broken FROM m)
SELECT user_id, max(at_us) AS prefix_end, count(*) AS length FROM r WHERE broken = 0 GROUP BY 1""")
def w10_contiguous_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contiguous_prefix(hours(spark, sf_dir), "user_id", "at_us", HOUR)


@query(f"""WITH {HOURS}, b AS (SELECT user_id, min(at_us) AS a, max(at_us) AS z FROM h GROUP BY 1), g AS (SELECT user_id, unnest(generate_series(a, z, {HOUR})) AS at_us FROM b) SELECT user_id, at_us FROM g EXCEPT SELECT user_id, at_us FROM h""")
def u8_missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hours(spark, sf_dir)
    return quality.missing(h, h.groupBy("user_id").agg(F.min("at_us").alias("first"), F.max("at_us").alias("last")), "user_id", "at_us", HOUR)


@query("""WITH i AS (SELECT l_suppkey AS k, l_partkey AS s, l_partkey + l_linenumber * 3 AS e FROM lineitem), p AS (SELECT k, unnest(generate_series(s, e)) AS x FROM i), u AS (SELECT k, count(DISTINCT x) AS covered, min(x) AS first, max(x) AS last FROM p GROUP BY 1),
 o AS (SELECT k, s, max(e) OVER (PARTITION BY k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM i)
SELECT k, covered, bool_or(coalesce(s > r + 1, FALSE)) AS has_gap, bool_or(coalesce(s <= r, FALSE)) AS has_overlap, first, last FROM u JOIN o USING (k) GROUP BY k, covered, first, last""")
def w6_interval_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = I.table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS k", "l_partkey AS start", "l_partkey + l_linenumber * 3 AS end")
    return quality.interval_union(i, "k")


ALLOWED = [(None, "view"), ("view", "click"), ("view", "view"), ("click", "purchase"), ("click", "view"), ("purchase", "view")]


@query("""WITH s AS (SELECT user_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before, event_type AS state FROM events)
SELECT * FROM s WHERE NOT coalesce((before IS NULL AND state = 'view') OR (before = 'view' AND state IN ('click', 'view')) OR (before = 'click' AND state IN ('purchase', 'view')) OR (before = 'purchase' AND state = 'view'), FALSE)""")
def q11_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = I.table(spark, sf_dir, "events").withColumnRenamed("event_type", "state")
    return quality.transitions(log, spark.createDataFrame(ALLOWED, "before string, state string"), "user_id", ["event_id"])


@query("""SELECT l_orderkey, count(*) AS occurrences, count(DISTINCT l_suppkey % 4) AS objects, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN 'exact' ELSE 'conflicting' END AS kind FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def q5_conflicting_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.conflicting_ids(I.table(spark, sf_dir, "lineitem").withColumn("o", F.col("l_suppkey") % 4), "l_orderkey", ["l_returnflag"], "o")


@query("""WITH p AS (SELECT event_id // 100 AS page, event_id AS position, user_id AS id, value AS x FROM events), r AS (SELECT *, x < lag(x) OVER (PARTITION BY page ORDER BY position) AS down, (SELECT count(DISTINCT q.page) FROM p q WHERE q.id = p.id) > 1 AS again FROM p),
 g AS (SELECT page, count(*) AS rows, count(*) FILTER (WHERE down) AS disordered, count(*) FILTER (WHERE again) AS repeats, first(id ORDER BY position) AS head, last(id ORDER BY position) AS tail FROM r GROUP BY 1)
SELECT page, rows, disordered, repeats, coalesce(head = lag(tail) OVER (ORDER BY page), FALSE) AS boundary_overlap FROM g""")
def w15_page_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.table(spark, sf_dir, "events").selectExpr("event_id div 100 AS page", "event_id AS position", "user_id AS id", "value AS x")
    return quality.page_diagnostics(p, "page", "position", "id", "x")


# ---- universe

COINS = """c AS (SELECT user_id AS instrument_id, CASE WHEN user_id % 11 = 0 THEN '' ELSE strftime(min(ts), '%Y-%m-%d') END AS birth, CASE user_id % 4 WHEN 0 THEN strftime(max(ts), '%Y-%m-%d') WHEN 1 THEN 'unknown' WHEN 2 THEN NULL ELSE strftime(min(ts) + INTERVAL 9 DAY, '%Y-%m-%d') END AS death, user_id % 3 = 0 AS is_active FROM events GROUP BY 1)"""


@query(f"""WITH {COINS}, d AS (SELECT unnest(generate_series({I.START}, {I.START + 30 * DAY}, {3 * DAY})) AS t), x AS (SELECT c.*, epoch_us(try_cast(birth AS TIMESTAMP)) AS b, epoch_us(try_cast(death AS TIMESTAMP)) AS e FROM c)
SELECT DISTINCT t, instrument_id FROM x JOIN d ON (b IS NULL OR b <= t) AND (is_active OR (coalesce(death, '') <> '' AND (e IS NULL OR t <= e)))""")
def p8_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("z"))
    text, u = lambda c: F.date_format(c, "yyyy-MM-dd"), F.col("user_id")
    death = F.when(u % 4 == 0, text("z")).when(u % 4 == 1, "unknown").when(u % 4 == 2, F.lit(None)).otherwise(text(F.expr("a + INTERVAL 9 DAYS")))
    coins = e.select(u.alias("instrument_id"), F.when(u % 11 == 0, "").otherwise(text("a")).alias("birth"), death.alias("death"), (u % 3 == 0).alias("is_active"))
    times = spark.range(1).select(F.explode(F.sequence(F.lit(I.START), F.lit(I.START + 30 * DAY), F.lit(3 * DAY))).alias("t"))
    return universe.survivors(times, coins)


@query("""WITH m AS (SELECT p_partkey AS pool, s AS priority, 'prov' || CAST(s AS VARCHAR) AS provider, CASE WHEN (p_partkey + s) % 9 = 0 THEN NULL ELSE ((p_partkey * 37 + s) % 1000) * 1e0 END AS liquidity, ((p_partkey * 91 + s) % 500) * 1e0 AS volume FROM part, generate_series(1, 2) AS ss(s) WHERE (p_partkey + s) % 5 <> 0),
 o AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY pool ORDER BY priority, provider) = 1), r AS (SELECT pool, provider, CASE WHEN liquidity IS NULL THEN 'liquidity_unavailable' WHEN volume IS NULL THEN 'volume_unavailable' WHEN liquidity < 300 THEN 'liquidity_below_floor' WHEN volume < 100 THEN 'volume_below_floor' END AS reason FROM o)
SELECT pool, provider, CASE WHEN reason LIKE '%unavailable' THEN 'UNAVAILABLE' WHEN reason IS NOT NULL THEN 'REJECT' ELSE 'PASS' END AS verdict, reason FROM r""")
def p9_screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pool"), F.explode(F.array(F.lit(1), F.lit(2))).alias("priority")).where("(pool + priority) % 5 <> 0")
    k, s = F.col("pool"), F.col("priority")
    m = p.select("pool", "priority", F.concat(F.lit("prov"), s.cast("string")).alias("provider"), F.when((k + s) % 9 != 0, ((k * 37 + s) % 1000).cast("double")).alias("liquidity"), ((k * 91 + s) % 500).cast("double").alias("volume"))
    return universe.screen(m, ["pool"], {"liquidity": 300.0, "volume": 100.0})


SYMBOLS = """sy AS (SELECT DISTINCT CASE WHEN c_custkey % 6 = 0 THEN 'C' || CAST(c_custkey % 300 AS VARCHAR) || 'UP' WHEN c_custkey % 6 = 1 THEN 'C' || CAST(c_custkey % 400 AS VARCHAR) || 'DOWN' ELSE 'C' || CAST(c_custkey % 500 AS VARCHAR) END AS base FROM customer)"""


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("c_custkey"), lambda n: F.concat(F.lit("C"), (F.col("c_custkey") % n).cast("string"))
    base = F.when(k % 6 == 0, F.concat(c(300), F.lit("UP"))).when(k % 6 == 1, F.concat(c(400), F.lit("DOWN"))).otherwise(c(500))
    return I.table(spark, sf_dir, "customer").select(base.alias("base")).distinct()


@query(f"""WITH {SYMBOLS} SELECT base, coalesce((base LIKE '%UP' AND base <> 'UP' AND base[:-3] IN (SELECT base FROM sy)) OR (base LIKE '%DOWN' AND base[:-5] IN (SELECT base FROM sy)), FALSE) AS leveraged FROM sy""")
def p12_leveraged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.leveraged(symbols(spark, sf_dir), ["UP", "DOWN"])


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'quote' WHEN c_acctbal < 0 THEN 'below_floor' WHEN c_nationkey < 5 THEN 'covered' END AS reason FROM customer""")
def p11_exclusion_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = universe.first_reason((F.col("c_mktsegment") == "BUILDING", "quote"), (F.col("c_acctbal") < 0, "below_floor"), (F.col("c_nationkey") < 5, "covered"))
    return I.table(spark, sf_dir, "customer").select("c_custkey", reason.alias("reason"))


@query(f"""WITH {I.bars_sql()}, f AS (SELECT instrument_id, ({I.START + 25 * DAY} - min(period_start)) // {DAY} AS days FROM b GROUP BY 1) SELECT instrument_id, days, CASE WHEN days >= 25 THEN 'ELIGIBLE' ELSE 'INSUFFICIENT' END AS state FROM f""")
def p19_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.eligible_history(I.bars(spark, sf_dir), I.START + 25 * DAY, 25)


@query(f"""WITH s AS (SELECT user_id AS pool, epoch_us(ts) // {DAY} AS day, max(value) AS l, max(event_id % 100) AS v FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY day DESC) AS k FROM s WHERE day <= {(I.START + 20 * DAY) // DAY}),
 b AS (SELECT pool, count(*) = 3 AND bool_and(l < 120 AND v < 95) AS dead FROM r WHERE k <= 3 GROUP BY 1) SELECT p.pool, coalesce(dead, FALSE) AS dead FROM (SELECT DISTINCT user_id AS pool FROM events) p LEFT JOIN b USING (pool)""")
def w12_dead_by_bad_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events")
    stats = e.select(F.col("user_id").alias("pool"), T.us("ts").alias("at"), F.col("value").alias("liquidity"), (F.col("event_id") % 100).alias("volume"))
    return universe.dead_by_bad_days(stats.select("pool").distinct(), stats, ["pool"], I.START + 20 * DAY, 3, (120.0, 95.0))


@query(f"""SELECT user_id, ({I.START + 31 * DAY} - max(epoch_us(ts))) // {DAY} AS idle_days, ({I.START + 31 * DAY} - max(epoch_us(ts))) // {DAY} > 1 AS dead FROM events GROUP BY 1""")
def w13_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.inactive(I.table(spark, sf_dir, "events").withColumn("at", T.us("ts")), "user_id", "at", I.START + 31 * DAY, 1)


@query("""WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) SELECT c_nationkey, c_custkey, CAST(place AS INTEGER) AS place, place <= 3 AS kept FROM r""")
def o3_top_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.top_ranked(I.table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 3, ["c_nationkey"]).drop("c_acctbal")


@query(f"""WITH {I.bars_sql()}, f AS (SELECT instrument_id, count(*) AS n, sum(quote_volume) AS v, sum(trade_count) AS c FROM b WHERE period_start >= {I.START + 10 * DAY} AND period_start < {I.START + 15 * DAY} GROUP BY 1)
SELECT instrument_id, CASE WHEN n = 5 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS state, round(CASE WHEN n = 5 THEN v END, {R}) AS volume, CAST(CASE WHEN n = 5 THEN c END AS BIGINT) AS trades FROM f""")
def a17_trailing_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(universe.trailing_volume(I.bars(spark, sf_dir), I.START + 15 * DAY, 5), "volume")


@query("""SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def w7_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe.latest_per_key(I.table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""WITH n AS (SELECT o_orderkey, o_custkey + 1 AS x FROM orders WHERE o_orderkey % 3 = 0), o AS (SELECT o_orderkey, o_custkey AS x FROM orders WHERE o_orderkey % 2 = 0) SELECT * FROM n UNION ALL SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)""")
def u2_merge_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = I.table(spark, sf_dir, "orders")
    return universe.merge_newest(o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey", "o_custkey AS x"), o.where("o_orderkey % 3 = 0").selectExpr("o_orderkey", "o_custkey + 1 AS x"), ["o_orderkey"])


@query("""WITH r AS (SELECT l_partkey AS k, l_orderkey * 10 + l_linenumber AS o, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END AS a, CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag END AS b FROM lineitem)
SELECT k, last(a ORDER BY o) FILTER (WHERE a IS NOT NULL) AS a, last(b ORDER BY o) FILTER (WHERE b IS NOT NULL) AS b, max(o) AS o FROM r GROUP BY 1""")
def u4_coalesce_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = I.table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS k", "l_orderkey * 10 + l_linenumber AS o", "CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END AS a", "CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag END AS b")
    return universe.coalesce_upsert(r, ["k"], ["a", "b"], "o")


@query("""WITH o AS (SELECT l_suppkey AS symbol, l_partkey % 12 AS month, CASE WHEN l_orderkey % 8 <> 0 THEN l_linenumber END AS day, l_orderkey AS key FROM lineitem), m AS (SELECT DISTINCT symbol, month FROM o WHERE day IS NULL)
SELECT o.symbol, o.month, day, key, day IS NULL OR m.symbol IS NULL AS chosen FROM o LEFT JOIN m USING (symbol, month)""")
def u10_canonical_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = I.table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS symbol", "l_partkey % 12 AS month", "CASE WHEN l_orderkey % 8 <> 0 THEN l_linenumber END AS day", "l_orderkey AS key")
    return universe.canonical_objects(o)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT p_partkey AS child, p_partkey // 3 AS ancestor FROM part WHERE p_partkey > 0), c(child, ancestor, depth) AS (SELECT child, ancestor, 1 FROM e UNION SELECT c.child, e.ancestor, depth + 1 FROM c JOIN e ON e.child = c.ancestor)
SELECT child, ancestor, CAST(min(depth) AS INTEGER) AS depth FROM c GROUP BY 1, 2""")
def j24_lineage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "part").where("p_partkey > 0").selectExpr("p_partkey AS child", "p_partkey div 3 AS parent")
    return universe.closure(e)


# ---- functions

@query(f"""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 's' WHEN event_id % 3 = 1 THEN 'ms' ELSE 'us' END AS unit, epoch_us(ts) - CASE event_id % 3 WHEN 0 THEN epoch_us(ts) % 1000000 WHEN 1 THEN epoch_us(ts) % 1000 ELSE 0 END AS at FROM events""")
def f1_time_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    us, e = T.us("ts"), F.col("event_id")
    raw = F.when(e % 3 == 0, F.floor(us / 1_000_000)).when(e % 3 == 1, F.floor(us / 1000)).otherwise(us)
    rows = I.table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).withColumn("unit", T.unit_by_digits(F.col("raw")))
    return rows.select("event_id", "unit", T.to_us(F.col("raw"), F.col("unit")).alias("at"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE epoch_us(ts) END AS at FROM events""")
def f3_decimal_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    us, e = T.us("ts"), F.col("event_id")
    token = F.concat(F.floor(us / 1_000_000).cast("string"), F.lit("."), F.lpad((us % 1_000_000).cast("string"), 6, "0"))
    token = F.when(e % 4 == 0, F.concat(F.lit("-"), token)).when(e % 4 == 1, F.concat(token, F.lit("7"))).when(e % 4 == 2, F.concat(token, F.lit("000"))).otherwise(token)
    return I.table(spark, sf_dir, "events").select("event_id", T.decimal_seconds(token).alias("at"))


@query("""SELECT o_orderkey, CAST(o_orderkey * 4294967296 + o_custkey AS VARCHAR) AS quantity FROM orders""")
def f8_hex_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.concat(F.lit("0x"), F.lower(F.hex(F.col("o_orderkey") * (1 << 32) + F.col("o_custkey"))))
    return I.table(spark, sf_dir, "orders").select("o_orderkey", C.hex_quantity(token).cast("string").alias("quantity"))


@query("""SELECT n_nationkey, lower(trim(n_name)) || ' x' AS norm FROM nation""")
def f12_normal_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "nation").select("n_nationkey", C.normal_alias(F.concat(F.lit("  "), "n_name", F.lit(" \t X "))).alias("norm"))
