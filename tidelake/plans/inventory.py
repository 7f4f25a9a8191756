"""Queries over inventories, books, evidence and parity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import checks as C
from tidelake.functions import times as T
from tidelake.functions.times import DAY
from tidelake.operators import asof, factors, inventory, universe
from tidelake.plans import inputs as I
from tidelake.plans import market as M
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


@query(f"WITH {I.bars_sql()} SELECT instrument_id, count(*) AS rows, min(period_start) AS first, max(period_start) AS last, count(*) FILTER (WHERE close < open) AS bad FROM b GROUP BY 1")
def a6_coverage_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.coverage_span(I.bars(spark, sf_dir), ["instrument_id"], "period_start", F.col("close") < F.col("open"))


@query(f"""WITH r AS (SELECT event_type AS side, CASE WHEN event_id % 5 = 0 THEN 's' WHEN event_id % 3 = 0 THEN 'ms' ELSE 'us' END AS unit FROM events), c AS (SELECT side, unit, count(*) AS rows FROM r GROUP BY 1, 2)
SELECT side, unit, rows, round(rows / sum(rows) OVER (PARTITION BY side), {R}) AS rate, row_number() OVER (PARTITION BY side ORDER BY rows DESC, unit) = 1 AS dominant FROM c""")
def a10_unit_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, us = F.col("event_id"), T.us("ts")
    raw = F.when(k % 5 == 0, F.floor(us / 1_000_000)).when(k % 3 == 0, F.floor(us / 1000)).otherwise(us)
    rows = I.table(spark, sf_dir, "events").select(F.col("event_type").alias("side"), T.unit_by_digits(raw).alias("unit"))
    return rounded(inventory.unit_distribution(rows, "side", "unit"), "rate")


@query("""WITH h AS (SELECT sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS h FROM orders),
 p AS (SELECT CAST('0x' || substr(h, 1, 8) AS BIGINT) % 1024 AS part, count(*) AS n, sha256(string_agg(h, chr(10) ORDER BY h)) AS h FROM h GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS "rows", sha256(string_agg(part || ':' || h, chr(10) ORDER BY part)) AS digest FROM p""")
def a11_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.digest(I.table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query(f"""WITH x AS (SELECT l_extendedprice / l_quantity AS x FROM lineitem WHERE l_quantity > 0) SELECT round(median(x), {R}) AS median, round(quantile_cont(x, 0.9), {R}) AS upper, round(max(x), {R}) AS most, round(quantile_cont(x, 0.9) * 1000, 3) AS u25, round(quantile_cont(x, 0.9) * 4000, 3) AS u100 FROM x""")
def a12_storage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = I.table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("bytes"), F.col("l_quantity").alias("rows"))
    found = inventory.storage_stats(s, 0.9, {"u25": 1000, "u100": 4000})
    return rounded(found, "median", "upper", "most").withColumns({c: F.round(c, 3) for c in ("u25", "u100")})


@query("""SELECT l_suppkey, l_partkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey / l_linenumber DESC, l_partkey DESC) = 1""")
def a13_largest_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.largest_ratio(I.table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey", "l_linenumber")


@query("""WITH o AS (SELECT l_partkey, max(CASE WHEN l_partkey % 9 <> 0 THEN l_suppkey END) AS size FROM lineitem GROUP BY 1) SELECT count(*) AS objects, CAST(sum(size) AS BIGINT) AS bytes, count(*) FILTER (WHERE size IS NULL) AS unknown FROM o""")
def a14_physical_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = I.table(spark, sf_dir, "lineitem").select("l_partkey", F.when(F.col("l_partkey") % 9 != 0, F.col("l_suppkey")).alias("size"))
    return inventory.physical_bytes(claims, "l_partkey", "size")


OBJECTS = """ob AS (SELECT o_custkey % 200 AS symbol, o_orderkey AS key, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_orderkey * 37) % 1000 - 50 END AS size FROM orders)"""


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return I.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 200).alias("symbol"), k.alias("key"), F.when(k % 7 != 0, (k * 37) % 1000 - 50).alias("size"))


@query(f"""WITH {OBJECTS}, p AS (SELECT *, CAST(least(2, (3 * (row_number() OVER (PARTITION BY symbol ORDER BY key) - 1)) // count(*) OVER (PARTITION BY symbol)) AS INTEGER) AS era FROM ob)
SELECT symbol, key, size, era, row_number() OVER (PARTITION BY symbol, era ORDER BY CASE WHEN size > 0 THEN size END NULLS LAST, key) = 1 AND coalesce(size, 0) > 0 AS chosen FROM p""")
def w20_eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.eras(objects(spark, sf_dir), ["symbol"], ["key"])


@query(f"""WITH {OBJECTS}, p AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY key) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM ob),
 r AS (SELECT *, CASE WHEN i < n // 3 THEN 'early' WHEN i < 2 * (n // 3) THEN 'middle' ELSE 'recent' END AS regime FROM p WHERE n >= 3 UNION ALL SELECT *, 'early' FROM p WHERE n < 3 AND i = 0 UNION ALL SELECT *, 'middle' FROM p WHERE n < 3 AND i = n // 2 UNION ALL SELECT *, 'recent' FROM p WHERE n < 3 AND i = n - 1)
SELECT symbol, key, size, regime, CAST(row_number() OVER (PARTITION BY symbol, regime ORDER BY size NULLS LAST, key) AS INTEGER) AS place FROM r""")
def w21_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.regimes(objects(spark, sf_dir), ["symbol"], "key")


@query(f"""WITH {OBJECTS}, p AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY key) AS i, count(*) OVER (PARTITION BY symbol) AS n FROM ob) SELECT symbol, key, size FROM p WHERE i = 1 OR i = n // 2 + 1 OR i = n""")
def w22_first_middle_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.first_middle_last(objects(spark, sf_dir), ["symbol"], ["key"])


@query("""WITH h AS (SELECT DISTINCT o_custkey, year(CAST(o_orderdate AS DATE)) * 12 + month(CAST(o_orderdate AS DATE)) AS m FROM orders), s AS (SELECT o_custkey, min(m) AS a, max(m) AS z FROM h GROUP BY 1)
SELECT o_custkey, m FROM (SELECT o_custkey, unnest(generate_series(a, z)) AS m FROM s) EXCEPT SELECT o_custkey, m FROM h""")
def w23_month_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate").cast("date")
    return inventory.month_gaps(I.table(spark, sf_dir, "orders").select("o_custkey", (F.year(d) * 12 + F.month(d)).cast("long").alias("m")), ["o_custkey"], "m")


QUOTES = """qu AS (SELECT user_id AS object, event_id, epoch_us(ts) - CASE WHEN event_id % 97 = 0 THEN 86400000000 ELSE 0 END AS ms, CASE WHEN event_id % 5 = 0 THEN 0 WHEN event_id % 401 = 0 THEN -1 ELSE value END AS bid, CASE WHEN event_id % 5 = 0 AND event_id % 307 <> 0 THEN 0 ELSE 1.5e0 END AS bid_qty,
 CASE WHEN event_id % 7 = 0 THEN 0 WHEN event_id % 211 = 0 THEN value - 1 ELSE value + 1 END AS ask, CASE WHEN event_id % 7 = 0 THEN 0 ELSE 2e0 END AS ask_qty FROM events WHERE value > 2),
 qs AS (SELECT *, ms < lag(ms) OVER (PARTITION BY object ORDER BY event_id) AS back, CASE WHEN least(bid, bid_qty, ask, ask_qty) < 0 THEN 'NEGATIVE' WHEN (bid <= 0 AND bid_qty > 0) OR (ask <= 0 AND ask_qty > 0) THEN 'SIZE_WITHOUT_PRICE' WHEN bid > 0 AND ask > 0 AND bid > ask THEN 'CROSSED' WHEN bid > 0 AND ask > 0 THEN 'TWO_SIDED' WHEN bid > 0 THEN 'BID_ONLY' WHEN ask > 0 THEN 'ASK_ONLY' ELSE 'EMPTY' END AS state FROM qu)"""


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("event_id"), F.col("value")
    return I.table(spark, sf_dir, "events").where("value > 2").select(
        F.col("user_id").alias("object"), "event_id", (T.us("ts") - F.when(k % 97 == 0, DAY).otherwise(0)).alias("ms"), F.when(k % 5 == 0, 0.0).when(k % 401 == 0, -1.0).otherwise(v).alias("bid"),
        F.when((k % 5 == 0) & (k % 307 != 0), 0.0).otherwise(1.5).alias("bid_qty"), F.when(k % 7 == 0, 0.0).when(k % 211 == 0, v - 1).otherwise(v + 1).alias("ask"), F.when(k % 7 == 0, 0.0).otherwise(2.0).alias("ask_qty"),
    )


@query(f"WITH {QUOTES} SELECT event_id, state FROM qs")
def p18_book_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes(spark, sf_dir).select("event_id", inventory.book_state(*(F.col(c) for c in ("bid", "bid_qty", "ask", "ask_qty"))).alias("state"))


@query(f"""WITH {QUOTES}, g AS (SELECT object, count(*) AS rows, count(*) FILTER (WHERE state = 'TWO_SIDED') AS two_sided, count(*) FILTER (WHERE state = 'BID_ONLY') AS bid_only, count(*) FILTER (WHERE state = 'ASK_ONLY') AS ask_only, count(*) FILTER (WHERE state = 'EMPTY') AS empty,
 count(*) FILTER (WHERE state IN ('NEGATIVE', 'SIZE_WITHOUT_PRICE', 'CROSSED')) AS errors, min(ms) AS first, max(ms) AS last, count(*) FILTER (WHERE back) AS back_steps FROM qs GROUP BY 1) SELECT *, CASE WHEN errors = 0 AND back_steps = 0 AND two_sided > 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM g""")
def q8_book_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.book_verdict(quotes(spark, sf_dir), "object", "ms", "event_id")


@query("""WITH s AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 11 = 0 THEN 'quarantined' WHEN o_orderkey % 4 = 0 THEN 'sidecar_absent' WHEN o_orderkey % 3 = 0 THEN 'checksum_proved_retained' ELSE 'sidecar_listed' END AS state FROM orders) SELECT key, state, state IN ('sidecar_listed', 'checksum_proved_retained') AS selectable FROM s""")
def p17_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = I.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    return inventory.integrity(o, "key", o.where("key % 4 <> 0"), o.where("key % 11 = 0"), o.where("key % 3 = 0"))


@query("""WITH p AS (SELECT s_suppkey AS job, s_suppkey * 10 AS s, s_suppkey * 10 + 95 + s_suppkey % 7 AS e FROM supplier), t AS (SELECT job, a AS s, least(a + 9, e) AS e FROM (SELECT job, e, unnest(generate_series(s, e, 10)) AS a FROM p)),
 r AS (SELECT DISTINCT job, s, e + CASE WHEN (job + s) % 13 = 0 THEN 1 ELSE 0 END AS e FROM t WHERE (job + s // 10) % 3 <> 0), j AS (SELECT job, t.s IS NOT NULL AND t.tile AS tile, r.done FROM (SELECT *, TRUE AS tile FROM t) t FULL JOIN (SELECT *, TRUE AS done FROM r) r USING (job, s, e))
SELECT job, count(*) FILTER (WHERE tile AND done) AS done, count(*) FILTER (WHERE done IS NULL) AS pending, count(*) FILTER (WHERE tile IS NULL OR NOT tile) AS misaligned FROM j GROUP BY 1""")
def j21_tile_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("job"), (F.col("s_suppkey") * 10).alias("start"), (F.col("s_suppkey") * 10 + 95 + F.col("s_suppkey") % 7).alias("end"))
    t = p.select("job", "end", F.explode(F.sequence("start", "end", F.lit(10))).alias("a")).select("job", F.col("a").alias("start"), F.least(F.col("a") + 9, "end").alias("end"))
    r = t.where((F.col("job") + F.floor(F.col("start") / 10)) % 3 != 0).withColumn("end", F.col("end") + F.when((F.col("job") + F.col("start")) % 13 == 0, 1).otherwise(0))
    return inventory.tile_coverage(p, r, "job", 10)


@query("""WITH a AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber <> 3), b AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber <> 2) SELECT 'only_a' AS side, count(*) AS rows FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'only_b', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def j13_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = I.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return inventory.set_difference(x.where("l_linenumber <> 3").drop("l_linenumber"), x.where("l_linenumber <> 2").drop("l_linenumber"))


@query("""WITH q AS (SELECT l_suppkey % 20 AS provider, CASE l_linenumber % 3 WHEN 0 THEN 429 WHEN 1 THEN 200 ELSE 500 END AS status, l_orderkey * 10 + l_linenumber AS attempt, l_partkey AS latency_ms, l_suppkey AS bytes FROM lineitem)
SELECT provider, count(*) AS attempts, count(*) FILTER (WHERE status = 429) AS throttled, CAST(sum(latency_ms) AS BIGINT) AS latency, CAST(sum(bytes) AS BIGINT) AS bytes, arg_max(status, attempt) AS last_status, bool_or(status = 200) AS succeeded FROM q GROUP BY 1""")
def a31_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber") % 3
    q = I.table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("provider"), F.when(n == 0, 429).when(n == 1, 200).otherwise(500).alias("status"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("attempt"), F.col("l_partkey").alias("latency_ms"), F.col("l_suppkey").alias("bytes"))
    return inventory.receipts(q, ["provider"])


@query("""WITH p AS (SELECT l_orderkey AS pool, 't' || CAST(l_partkey % 40 AS VARCHAR) AS token0, 't' || CAST(l_suppkey % 30 AS VARCHAR) AS token1 FROM lineitem), s(token, symbol) AS (VALUES ('t1', 'USDC'), ('t2', 'USDT'))
SELECT pool, token0, token1, CASE WHEN a.symbol IS NOT NULL THEN token1 ELSE token0 END AS base, CASE WHEN a.symbol IS NOT NULL THEN token0 ELSE token1 END AS quote, coalesce(a.symbol, b.symbol) AS quote_symbol FROM p LEFT JOIN s a ON a.token = token0 LEFT JOIN s b ON b.token = token1 WHERE (a.symbol IS NULL) <> (b.symbol IS NULL)""")
def p14_orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda c, n: F.concat(F.lit("t"), (F.col(c) % n).cast("string"))
    pairs = I.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pool"), name("l_partkey", 40).alias("token0"), name("l_suppkey", 30).alias("token1"))
    return inventory.oriented(pairs, spark.createDataFrame([("t1", "USDC"), ("t2", "USDT")], "token string, symbol string"))


# hypotheses are customers, their evidence orders, their decisions line items
EVIDENCE = """ve AS (SELECT c_custkey AS hypothesis, 1 + c_custkey % 2 AS version FROM customer), de AS (SELECT o_custkey AS hypothesis, o_orderkey AS decision, o_orderkey % 100 AS decided, o_orderstatus AS lifecycle FROM orders),
 li AS (SELECT o_custkey AS hypothesis, 1 + o_orderkey % 2 AS version, o_orderkey AS evidence_id, CASE o_orderkey % 4 WHEN 0 THEN 'CONTRADICTS' WHEN 1 THEN 'QUALIFIES' ELSE 'SUPPORTS' END AS direction, o_orderkey % 365 AS registered FROM orders),
 it AS (SELECT o_orderkey AS evidence_id, CASE WHEN o_orderkey % 3 = 0 THEN 'LITERATURE' WHEN o_orderkey % 5 = 0 THEN 'LEGACY' ELSE 'EXPERIMENT' END AS kind, CASE WHEN o_orderkey % 23 = 0 THEN 'FAIL' WHEN o_orderkey % 2 = 0 THEN 'PASS' END AS integrity, (o_orderkey * 7) % 365 AS registered FROM orders),
 sn AS (SELECT li.hypothesis, li.version, evidence_id, kind, integrity FROM li JOIN it USING (evidence_id) WHERE li.registered <= 200 AND it.registered <= 200)"""


def evidence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    c, o, k = I.table(spark, sf_dir, "customer"), I.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    versions = c.select(F.col("c_custkey").alias("hypothesis"), (1 + F.col("c_custkey") % 2).alias("version"))
    decisions = o.select(F.col("o_custkey").alias("hypothesis"), k.alias("decision"), (k % 100).alias("at"), F.col("o_orderstatus").alias("lifecycle"))
    direction = F.when(k % 4 == 0, "CONTRADICTS").when(k % 4 == 1, "QUALIFIES").otherwise("SUPPORTS")
    links = o.select(F.col("o_custkey").alias("hypothesis"), (1 + k % 2).alias("version"), k.alias("evidence_id"), direction.alias("direction"), (k % 365).alias("registered"))
    kind = F.when(k % 3 == 0, "LITERATURE").when(k % 5 == 0, "LEGACY").otherwise("EXPERIMENT")
    items = o.select(k.alias("evidence_id"), kind.alias("kind"), F.when(k % 23 == 0, "FAIL").when(k % 2 == 0, "PASS").alias("integrity"), ((k * 7) % 365).alias("registered"))
    return versions, decisions, links, items


@query(f"""WITH {EVIDENCE}, la AS (SELECT hypothesis, last(lifecycle ORDER BY decided, decision) AS lifecycle FROM de GROUP BY 1), co AS (SELECT hypothesis, version, count(*) AS e, count(*) FILTER (WHERE direction = 'SUPPORTS') AS s, count(*) FILTER (WHERE direction = 'CONTRADICTS') AS c, count(*) FILTER (WHERE direction = 'QUALIFIES') AS q FROM li GROUP BY 1, 2)
SELECT hypothesis, version, lifecycle, coalesce(e, 0) AS evidence, coalesce(s, 0) AS supports, coalesce(c, 0) AS contradicts, coalesce(q, 0) AS qualifies FROM ve LEFT JOIN la USING (hypothesis) LEFT JOIN co USING (hypothesis, version)""")
def a24_evidence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions, decisions, links, _ = evidence(spark, sf_dir)
    return inventory.evidence_summary(versions, decisions, links)


@query(f"WITH {EVIDENCE} SELECT hypothesis, version, evidence_id, kind FROM sn")
def j22_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, links, items = evidence(spark, sf_dir)
    return inventory.snapshot(links, items, 200).select("hypothesis", "version", "evidence_id", "kind")


@query(f"WITH {EVIDENCE} SELECT hypothesis, version, bool_or(kind NOT IN ('LITERATURE', 'LEGACY')) AND NOT bool_or(coalesce(integrity = 'FAIL', FALSE)) AS admissible FROM sn GROUP BY 1, 2")
def a25_admissible(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, links, items = evidence(spark, sf_dir)
    return inventory.admissible(inventory.snapshot(links, items, 200), ["LITERATURE", "LEGACY"])


@query("""WITH e AS (SELECT l_partkey AS child, l_suppkey * 30 AS parent FROM lineitem) SELECT DISTINCT child, parent, 'missing_parent' AS fault FROM e WHERE parent NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT child, parent, 'duplicate_edge' FROM e GROUP BY 1, 2 HAVING count(*) > 1""")
def j23_dependency_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS child", "l_suppkey * 30 AS parent")
    return inventory.dependency_faults(e, I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("dataset")))


# ---- parity, eligibility and coverage


@query(f"""WITH {M.MOMENTUM}, c AS (SELECT instrument_id, t, raw_value AS a, CASE WHEN instrument_id % 10 = 3 THEN raw_value * 1.01 WHEN instrument_id % 10 <> 4 THEN raw_value END AS b FROM mo)
SELECT CASE WHEN instrument_id % 10 = 4 THEN 'only_a' WHEN abs(a - b) <= 1e-9 * greatest(abs(a), abs(b)) THEN 'equal' ELSE 'different' END AS status, count(*) AS rows FROM c GROUP BY 1""")
def j12_frame_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = M.momentum(spark, sf_dir)
    b = a.where("instrument_id % 10 <> 4").withColumn("raw_value", F.when(F.col("instrument_id") % 10 == 3, F.col("raw_value") * 1.01).otherwise(F.col("raw_value")))
    j = a.withColumnRenamed("raw_value", "a").withColumn("in_a", F.lit(True)).join(b.withColumnRenamed("raw_value", "b").withColumn("in_b", F.lit(True)), ["instrument_id", "t"], "full_outer")
    status = F.when(F.col("in_b").isNull(), "only_a").when(F.col("in_a").isNull(), "only_b").when(C.close_to(F.col("a"), F.col("b")), "equal").otherwise("different")
    return j.groupBy(status.alias("status")).agg(F.count("*").alias("rows"))


OTHER = lambda sql: sql.replace("JOIN b ON b.", "JOIN b2 ON b2.").replace("AND b.", "AND b2.")
WEEKLY = f"""{I.bars_sql()}, {I.decisions_sql(days=7)}, b2 AS (SELECT instrument_id, period_start, availability, CASE WHEN instrument_id % 10 = 3 THEN close * (1 + period_start // {DAY} % 3 / 100.0) ELSE close END AS close FROM b WHERE instrument_id % 10 <> 4),
 {M.price_sql("pa", M.SKIP, "p1")}, {M.price_sql("pb", M.LOOK, "p0")}, {OTHER(M.price_sql("qa", M.SKIP, "q1"))}, {OTHER(M.price_sql("qb", M.LOOK, "q0"))},
 mo AS (SELECT instrument_id, t, ln(p1 / p0) AS a FROM pa JOIN pb USING (instrument_id, t)), mq AS (SELECT instrument_id, t, ln(q1 / q0) AS b FROM qa JOIN qb USING (instrument_id, t))"""


@query(f"""WITH {WEEKLY} SELECT instrument_id, t, CASE WHEN b IS NULL THEN 'only_a' WHEN a IS NULL THEN 'only_b' WHEN abs(a - b) <= 1e-12 * greatest(abs(a), abs(b)) THEN 'equal' ELSE 'different' END AS status
 FROM mo FULL JOIN mq USING (instrument_id, t)""")
def q13_truncated_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Momentum from the whole table against momentum from stores cut at each decision, which here lack an instrument and have other prices for one."""
    decisions, bars = I.decisions(spark, sf_dir, days=7), I.bars(spark, sf_dir)
    day = F.floor(F.col("period_start") / DAY)
    store = bars.where("instrument_id % 10 <> 4").withColumn("close", F.when(F.col("instrument_id") % 10 == 3, F.col("close") * (1 + day % 3 / 100.0)).otherwise(F.col("close")))
    at = lambda asked, facts: factors.momentum(asked, facts, M.LOOK, M.SKIP)
    return asof.truncated_parity(decisions, bars, store, at, "raw_value", 1e-12)


@query(f"WITH {M.VERSIONS}, {M.ASKS} SELECT part, t, k FROM a WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.part = a.part AND {M.ELIGIBLE})")
def j19_ineligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = M.asks(spark, sf_dir)
    met = asof.reference_at(asks, M.versions(spark, sf_dir), "part").select("part", "t", "k").distinct()
    return asks.join(met.hint("merge"), ["part", "t", "k"], "left_anti")


PANEL = f"""{I.bars_sql()}, d AS (SELECT unnest(generate_series({I.START + 10 * DAY}, {I.START + 29 * DAY}, {5 * DAY})) AS t), sp AS (SELECT instrument_id, min(period_start) AS a, max(availability) AS z FROM b GROUP BY 1), dd AS (SELECT instrument_id, a + {(3 * DAY)} * (1 + instrument_id % 9) AS died FROM sp WHERE instrument_id % 4 = 0)"""


@query(f"""WITH {PANEL} SELECT t, sp.instrument_id FROM sp JOIN d ON a <= t AND t <= z WHERE NOT EXISTS (SELECT 1 FROM dd WHERE dd.instrument_id = sp.instrument_id AND died < t)""")
def j7_panel_minus_dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = I.bars(spark, sf_dir).groupBy("instrument_id").agg(F.min("period_start").alias("a"), F.max("availability").alias("z"))
    times = spark.range(1).select(F.explode(F.sequence(F.lit(I.START + 10 * DAY), F.lit(I.START + 29 * DAY), F.lit(5 * DAY))).alias("t"))
    dead = span.where("instrument_id % 4 = 0").select("instrument_id", (F.col("a") + 3 * DAY * (1 + F.col("instrument_id") % 9)).alias("died"))
    covered = span.join(F.broadcast(times), (F.col("a") <= F.col("t")) & (F.col("t") <= F.col("z"))).select("t", "instrument_id")
    return covered.join(dead.withColumnRenamed("instrument_id", "i"), (F.col("instrument_id") == F.col("i")) & (F.col("died") < F.col("t")), "left_anti")


@query("""SELECT c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'REJECT' ELSE 'PASS' END AS verdict, count(*) AS rows, bool_or(c_acctbal > 9000) AS any_large FROM customer GROUP BY 1, 2""")
def a26_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = I.table(spark, sf_dir, "customer")
    return c.groupBy("c_mktsegment", F.when(F.col("c_acctbal") < 0, "REJECT").otherwise("PASS").alias("verdict")).agg(F.count("*").alias("rows"), F.bool_or(F.col("c_acctbal") > 9000).alias("any_large"))


@query("""WITH r AS (SELECT l_partkey AS k, l_orderkey * 10 + l_linenumber AS o, l_suppkey AS x FROM lineitem) SELECT k, o, x FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY o DESC) = 1""")
def u5_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = I.table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS k", "l_orderkey * 10 + l_linenumber AS o", "l_suppkey AS x")
    return universe.latest_per_key(r, ["k"], ["o"])


@query("""SELECT user_id, CAST((row_number() OVER (ORDER BY user_id) - 1) // 7 AS BIGINT) AS cohort FROM (SELECT DISTINCT user_id FROM events)""")
def o8_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.cohorts(I.table(spark, sf_dir, "events"), "user_id", 7)
