"""Queries over contracts, settlements, reviewed identities, series, coverage and restored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.times import DAY, HOUR
from tidelake.operators import evidence as E
from tidelake.operators.ordered import ranked
from tidelake.plans import inputs as I
from tidelake.plans.market import R, rounded

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


def text(column: str, before: str = "") -> Column:
    return F.concat(F.lit(before), F.expr(column).cast("string"))


# orders as contracts of one listing page for each 100 keys: the key's remainders spoil a field each
@query("""WITH c AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE 'B' || o_orderkey END AS base, 'Q' || CAST(o_orderkey % 3 AS VARCHAR) AS quote FROM orders),
 r AS (SELECT k, CASE WHEN k % 29 = 0 THEN 'TWICE' ELSE upper(base || quote) || CASE WHEN k % 7 = 0 THEN '_X' ELSE '' END END AS symbol, CASE WHEN k % 5 = 0 THEN 'CURRENT_QUARTER' ELSE 'PERPETUAL' END AS kind,
  base = '' AS blank, k % 37 = 0 AS undated, k % 11 = 0 AS under, k % 13 = 0 AS stat, k % 17 = 0 AS margin FROM c),
 s AS (SELECT *, CASE WHEN blank THEN 'missing_identity' WHEN undated THEN 'bad_lifecycle' WHEN symbol = 'TWICE' AND count(*) OVER (PARTITION BY symbol) > 1 THEN 'duplicate_symbol' END AS code,
  CASE WHEN under THEN 'unsupported_underlying_type' WHEN stat THEN 'unsupported_contract_status' WHEN margin OR (kind = 'PERPETUAL' AND (k % 7 = 0 OR k % 29 = 0)) THEN 'incoherent_contract_identity' ELSE 'supported' END AS state FROM r)
SELECT symbol, kind AS contract_type, code, state, kind = 'PERPETUAL' AND state = 'supported' AND code IS NULL AS perpetual, count(*) AS n FROM s GROUP BY ALL""")
def s16_contract_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    base, quote = F.when(k % 31 == 0, "").otherwise(text("o_orderkey", "b")), text("o_orderkey % 3", "Q")
    row = F.struct(
        F.when(k % 29 == 0, " twice ").otherwise(F.concat(base, quote, F.when(k % 7 == 0, "_x").otherwise(""))).alias("symbol"), F.concat(base, quote).alias("pair"),
        F.when(k % 5 == 0, "CURRENT_QUARTER").otherwise("Perpetual").alias("contractType"), F.when(k % 13 == 0, "HALTED").otherwise("TRADING").alias("status"),
        F.when(k % 11 == 0, "EQUITY").otherwise("COIN").alias("underlyingType"), base.alias("baseAsset"), quote.alias("quoteAsset"),
        F.when(k % 17 == 0, "OTHER").otherwise(quote).alias("marginAsset"), F.when(k % 37 == 0, F.lit(0)).otherwise(k + 1).cast("long").alias("onboardDate"), (k + 2).alias("deliveryDate"),
    )
    pages = I.table(spark, sf_dir, "orders").groupBy(F.floor(k / 100).alias("page")).agg(F.collect_list(row).alias("symbols"))
    found = E.contracts(pages.select(F.to_json(F.struct("symbols")).alias("json")), ["TRADING"], ["COIN", "INDEX"], ["TRADIFI"])
    return found.groupBy("symbol", F.col("contractType").alias("contract_type"), "code", "state", "perpetual").agg(F.count("*").alias("n"))


SETTLED = f"""st AS (SELECT 'P' || CAST(o_custkey AS VARCHAR) AS pair, CASE WHEN o_orderkey % 19 = 0 THEN 0 ELSE epoch_us(o_orderdate) // 1000 END AS ms, CASE WHEN o_orderkey % 23 = 0 THEN -1 ELSE o_totalprice END AS price FROM orders),
 se AS (SELECT pair, CAST(CAST(make_timestamp(ms * 1000) AS DATE) AS VARCHAR) AS delivery_date, price,
  CASE WHEN ms <= 0 THEN 'bad_time' WHEN price <= 0 THEN 'bad_price' WHEN count(*) OVER (PARTITION BY pair, ms // {DAY // 1000}) > 1 THEN 'repeated_date' END AS code FROM st)"""


def settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    ms = F.when(k % 19 == 0, F.lit(0)).otherwise(F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("deliveryTime")
    price = F.when(k % 23 == 0, F.lit(-1.0)).otherwise(F.col("o_totalprice")).alias("deliveryPrice")
    pages = I.table(spark, sf_dir, "orders").groupBy(text("o_custkey", "P").alias("pair"), (k % 4).alias("page")).agg(F.to_json(F.collect_list(F.struct(ms, price))).alias("json"))
    return E.settlements(pages.select("pair", "json"))


@query(f"WITH {SETTLED} SELECT pair, delivery_date, round(price, 4) AS price, code FROM se")
def s18_settlement_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(spark, sf_dir).withColumn("price", F.round("price", 4))


# customers as reviewed names, line items as archive objects of six families, orders of status P as funding
OBJECTS = "ob AS (SELECT l_linenumber % 6 AS family, 'P' || CAST(l_suppkey * 3 AS VARCHAR) AS symbol FROM lineitem WHERE l_suppkey % 4 <> 3 OR l_linenumber = 1)"


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = I.table(spark, sf_dir, "lineitem").where("l_suppkey % 4 <> 3 or l_linenumber = 1")
    return line.select((F.col("l_linenumber") % 6).alias("family"), text("l_suppkey * 3", "P").alias("symbol"))


@query(f"""WITH {SETTLED}, {OBJECTS}, rv AS (SELECT DISTINCT 'P' || CAST(c_custkey AS VARCHAR) AS symbol, 'P' || CAST(c_custkey AS VARCHAR) AS pair, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS delivery_date,
  CASE WHEN c_custkey % 2 = 0 THEN 'direct' ELSE 'archive' END AS authority FROM customer JOIN (SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1) ON o_custkey = c_custkey),
 se2 AS (SELECT DISTINCT pair, delivery_date FROM se WHERE code IS NULL), pr AS (SELECT symbol, count(DISTINCT family) AS family_count, count(*) AS object_count FROM ob GROUP BY 1),
 fu AS (SELECT DISTINCT 'P' || CAST(o_custkey AS VARCHAR) AS symbol FROM orders WHERE o_orderkey % 9 = 0),
 j AS (SELECT rv.symbol, rv.delivery_date, authority, coalesce(family_count, 0) AS family_count, coalesce(object_count, 0) AS object_count,
  array_to_string(list_filter([CASE WHEN coalesce(family_count, 0) < 2 THEN 'archive_multi_family_lifecycle_unproved' END, CASE WHEN fu.symbol IS NOT NULL THEN 'realized_funding_observed' END,
   CASE WHEN authority = 'direct' AND se2.pair IS NULL THEN 'official_settlement_price_date_absent' END], lambda x: x IS NOT NULL), '|') AS reasons
  FROM rv LEFT JOIN se2 ON se2.pair = rv.pair AND se2.delivery_date = rv.delivery_date LEFT JOIN pr ON pr.symbol = rv.symbol LEFT JOIN fu ON fu.symbol = rv.symbol)
SELECT *, reasons = '' AS resolved FROM j""")
def j28_delivery_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, name = I.table(spark, sf_dir, "orders"), text("o_custkey", "P")
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").cast("string").alias("delivery_date"))
    known = last.join(I.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    reviewed = known.select(name.alias("symbol"), name.alias("pair"), "delivery_date", F.when(F.col("c_custkey") % 2 == 0, "direct").otherwise("archive").alias("authority"))
    funding = o.where("o_orderkey % 9 = 0").select(name.alias("symbol"))
    found = E.delivery_identities(reviewed, objects(spark, sf_dir), funding, settled(spark, sf_dir))
    return found.select("symbol", "delivery_date", "authority", "family_count", "object_count", F.array_join("reasons", "|").alias("reasons"), "resolved")


@query(f"""WITH {OBJECTS}, rv AS (SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS alias, s_nationkey AS base, CASE WHEN s_suppkey % 3 = 0 THEN 'funding' ELSE 'current' END AS base_authority FROM supplier),
 au AS (SELECT n_nationkey AS base, CASE WHEN n_nationkey % 4 = 0 THEN 'funding' ELSE 'current' END AS observed FROM nation WHERE n_nationkey % 5 <> 0), pr AS (SELECT symbol, count(*) AS object_count FROM ob GROUP BY 1)
SELECT alias, rv.base, coalesce(object_count, 0) AS object_count, CASE WHEN observed IS NULL THEN 'base_has_no_affirmative_perpetual_evidence' WHEN observed <> base_authority THEN 'base_authority_changed_since_review' ELSE '' END AS reasons,
 coalesce(observed = base_authority, FALSE) AS resolved FROM rv LEFT JOIN au ON au.base = rv.base LEFT JOIN pr ON pr.symbol = alias""")
def j28_settlement_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    authority = F.when(F.col("s_suppkey") % 3 == 0, "funding").otherwise("current")
    reviewed = I.table(spark, sf_dir, "supplier").select(text("s_suppkey", "P").alias("alias"), F.col("s_nationkey").alias("base"), authority.alias("base_authority"))
    seen = I.table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0")
    seen = seen.select(F.col("n_nationkey").alias("base"), F.when(F.col("n_nationkey") % 4 == 0, "funding").otherwise("current").alias("observed"))
    return E.settlement_aliases(reviewed, seen, objects(spark, sf_dir)).select("alias", "base", "object_count", F.array_join("reasons", "|").alias("reasons"), "resolved")


@query("""WITH e AS (SELECT user_id AS run, event_id % 40 AS decision_time, CASE WHEN event_id % 17 <> 0 THEN event_id END AS panel, CASE WHEN event_id % 23 <> 0 THEN value END AS bars FROM events WHERE event_id % 3 <> 1),
 p AS (SELECT run, decision_time, count(*) AS n, min(CASE WHEN panel IS NULL THEN 'null_field:panel' WHEN bars IS NULL THEN 'null_field:bars' END) AS fault FROM e GROUP BY ALL),
 d AS (SELECT DISTINCT user_id AS run, event_id % 40 AS decision_time FROM events WHERE event_id % 5 <> 0),
 j AS (SELECT coalesce(p.run, d.run) AS run, coalesce(p.decision_time, d.decision_time) AS decision_time, n, fault, d.run IS NULL AS stray FROM p FULL JOIN d ON d.run = p.run AND d.decision_time = p.decision_time)
SELECT run, decision_time, CASE WHEN n IS NULL THEN 'missing_entry' WHEN stray THEN 'stray_entry' WHEN n > 1 THEN 'repeated_entry' ELSE coalesce(fault, 'ok') END AS status FROM j""")
def q12_binding_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events").withColumn("run", F.col("user_id")).withColumn("decision_time", F.col("event_id") % 40)
    held = e.where("event_id % 3 <> 1").select("run", "decision_time", F.expr("if(event_id % 17 <> 0, event_id, null)").alias("panel"), F.expr("if(event_id % 23 <> 0, value, null)").alias("bars"))
    return E.binding_series(held, e.where("event_id % 5 <> 0"), ["panel", "bars"])


PROMOTED = f"""pm AS (SELECT user_id AS artifact, CASE WHEN user_id % 4 = 1 THEN 'RESEARCH' ELSE 'PAPER_APPROVED' END AS state, min(epoch_us(ts)) + {3 * DAY} AS effective_us,
 min(epoch_us(ts)) + {3 * DAY} + (user_id % 11 - 1) * {2 * DAY} AS evaluated_us FROM events GROUP BY user_id)"""


@query(f"""WITH {PROMOTED}, pd AS (SELECT user_id AS artifact, epoch_us(ts) AS t_us, value / 10000 - 0.01 AS r, event_id % 15 / 10.0 AS lev, event_id % 12 / 100.0 AS w FROM events),
 s AS (SELECT artifact, count(*) AS periods, exp(sum(ln(1 + r))) - 1 AS net_return, max(lev) AS lev, max(w) AS w FROM pm JOIN pd USING (artifact) WHERE t_us BETWEEN effective_us AND evaluated_us GROUP BY 1)
SELECT artifact, (evaluated_us - effective_us) / {DAY}.0 AS duration_days, coalesce(periods, 0) AS periods, round(coalesce(net_return, 0), {R}) AS net_return, coalesce(lev, 0) AS max_leverage, coalesce(w, 0) AS max_weight,
 (evaluated_us - effective_us) / {DAY}.0 >= 7 AS complete, coalesce(lev, 0) <= 1.3 AND coalesce(w, 0) <= 0.1 AS meets_risk,
 CASE WHEN state <> 'PAPER_APPROVED' THEN 'not_paper_approved' WHEN evaluated_us < effective_us THEN 'evaluated_before_start' END AS fault FROM pm LEFT JOIN s USING (artifact)""")
def a23_observation_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events").withColumn("t_us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumn("artifact", F.col("user_id"))
    start = F.min("t_us") + 3 * DAY
    made = e.groupBy("artifact").agg(start.alias("effective_us")).withColumn("evaluated_us", F.col("effective_us") + (F.col("artifact") % 11 - 1) * (2 * DAY))
    made = made.withColumn("state", F.when(F.col("artifact") % 4 == 1, "RESEARCH").otherwise("PAPER_APPROVED"))
    k = F.col("event_id")
    periods = e.select("artifact", "t_us", (F.col("value") / 10000 - 0.01).alias("net_return"), (k % 15 / 10.0).alias("leverage"), (k % 12 / 100.0).alias("weight"))
    return rounded(E.observation_window(made, periods, 7, 1.3, 0.1), "net_return")


RETAINED = f"""pt AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, (CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * {DAY} + CASE WHEN l_linenumber = 7 THEN {HOUR} ELSE 0 END) AS at_us, l_partkey AS size FROM lineitem WHERE l_suppkey % 9 <> 0),
 lf AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, CAST(8100 + s_suppkey % 50 AS BIGINT) AS first_day, CAST(10000 - s_suppkey % 70 AS BIGINT) AS last_day FROM supplier WHERE s_suppkey % 7 <> 0),
 px AS (SELECT symbol, at_us // {DAY} AS day, at_us % {DAY} <> 0 AS off, at_us // {DAY} - lag(at_us // {DAY}) OVER (PARTITION BY symbol ORDER BY at_us) AS step, size FROM pt),
 pc AS (SELECT px.symbol, count(DISTINCT CASE WHEN day BETWEEN first_day AND last_day THEN day END) AS days, count(*) FILTER (WHERE NOT day BETWEEN first_day AND last_day) AS outside, count(*) FILTER (WHERE off) AS misaligned,
  count(*) FILTER (WHERE step > 1) AS gaps, CAST(ceil(sum(size) / count(*)) AS BIGINT) AS bytes_per_point FROM px LEFT JOIN lf ON lf.symbol = px.symbol GROUP BY px.symbol),
 cv AS (SELECT coalesce(pc.symbol, lf.symbol) AS symbol, coalesce(days, 0) AS days, coalesce(outside, 0) AS outside, coalesce(misaligned, 0) AS misaligned, coalesce(gaps, 0) AS gaps, bytes_per_point,
  greatest(last_day - first_day + 1, 0) AS lifecycle_days, first_day IS NOT NULL AS supported FROM pc FULL JOIN lf ON lf.symbol = pc.symbol)"""


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    line = I.table(spark, sf_dir, "lineitem").where("l_suppkey % 9 <> 0")
    points = line.select(text("l_suppkey", "S").alias("symbol"), (day * DAY + F.when(F.col("l_linenumber") == 7, HOUR).otherwise(0)).alias("at_us"), F.col("l_partkey").alias("size"))
    life = I.table(spark, sf_dir, "supplier").where("s_suppkey % 7 <> 0")
    life = life.select(text("s_suppkey", "S").alias("symbol"), (8100 + F.col("s_suppkey") % 50).alias("first_day"), (10000 - F.col("s_suppkey") % 70).alias("last_day"))
    return E.retained_coverage(points, life)


@query(f"WITH {RETAINED} SELECT * FROM cv")
def q14_retained_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage(spark, sf_dir).withColumn("lifecycle_days", F.when(F.col("supported"), F.col("lifecycle_days")).otherwise(F.lit(0)))


@query(f"WITH {RETAINED} SELECT count(*) AS series, CAST(coalesce(sum(lifecycle_days), 0) AS BIGINT) AS points_needed, max(bytes_per_point) AS bytes_per_point, CAST(sum(lifecycle_days) * max(bytes_per_point) AS BIGINT) AS projected_bytes FROM cv WHERE supported")
def a32_storage_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.storage_projection(coverage(spark, sf_dir))


@query(f"""WITH r AS (SELECT event_id, user_id % 20 AS key, event_id % 150 * {HOUR} + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END AS at_us, value, CASE WHEN event_id % 11 = 0 THEN value + 2 ELSE value - 1 END AS low,
 CASE WHEN event_id % 17 = 0 THEN 'other' ELSE 'main' END AS provider, 'raw_' || CAST(event_id % 30 AS VARCHAR) AS raw_id FROM events WHERE value > 2), n AS (SELECT *, count(*) OVER (PARTITION BY key, at_us) AS n FROM r)
SELECT event_id, CASE WHEN provider <> 'main' THEN 'unknown_provider' WHEN raw_id = 'raw_7' THEN 'undeclared_lineage' WHEN at_us % {HOUR} <> 0 THEN 'misaligned' WHEN low > value THEN 'unsound_values' WHEN n > 1 THEN 'repeated_identity' END AS code FROM n""")
def q16_restored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("event_id"), F.col("value")
    e = I.table(spark, sf_dir, "events").where("value > 2")
    rows = e.select(
        "event_id", (F.col("user_id") % 20).alias("key"), (k % 150 * HOUR + F.when(k % 13 == 0, 1).otherwise(0)).alias("at_us"), v.alias("open"), (v + 1).alias("high"), F.when(k % 11 == 0, v + 2).otherwise(v - 1).alias("low"),
        v.alias("close"), F.lit(1.0).alias("volume"), F.when(k % 17 == 0, "other").otherwise("main").alias("provider"), text("event_id % 30", "raw_").alias("raw_id"),
    )
    lineage = e.where("event_id % 30 <> 7").select(text("event_id % 30", "raw_").alias("raw_id"))
    return E.restored_rows(rows, lineage, HOUR, ["main"]).select("event_id", "code")


@query("""WITH f AS (SELECT s_nationkey AS provider, s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'missing' WHEN s_suppkey % 7 = 0 THEN 'undeclared' WHEN s_suppkey % 11 = 0 THEN 'size_mismatch' WHEN s_suppkey % 13 = 0 THEN 'hash_mismatch' ELSE 'ok' END AS status FROM supplier)
SELECT provider, count(*) AS files, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status <> 'ok') AS faulty, count(*) FILTER (WHERE status <> 'ok') = 0 AS complete FROM f GROUP BY 1""")
def q17_provider_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = I.table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    files = s.select(F.col("s_nationkey").alias("provider"), text("s_suppkey", "f").alias("file"), F.sha2(k.cast("string"), 256).alias("sha256"), (k + 100).alias("bytes"), k)
    declared = files.where("s_suppkey % 7 <> 0 or s_suppkey % 5 = 0")
    observed = files.where("s_suppkey % 5 <> 0").withColumn("bytes", F.when(k % 11 == 0, F.lit(0)).otherwise(F.col("bytes"))).withColumn("sha256", F.when(k % 13 == 0, "x").otherwise(F.col("sha256")))
    return E.provider_coverage(E.file_evidence(declared, observed))


@query("""SELECT 'a' || CAST(o_orderkey AS VARCHAR) AS alias, o_custkey AS key, CASE WHEN c_custkey IS NULL OR o_custkey % 6 = 5 THEN 'unknown_object' WHEN o_orderkey % 4 = 0 THEN 'name' WHEN o_orderkey % 7 = 0 THEN 'balance' END AS fault
 FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE c_custkey IS NULL OR o_custkey % 6 = 5 OR o_orderkey % 4 = 0 OR o_orderkey % 7 = 0""")
def u11_false_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = I.table(spark, sf_dir, "customer").where("c_custkey % 6 <> 5").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    o, k = I.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    met = o.select(k, F.col("o_custkey").alias("key")).join(of, "key", "left")
    entries = met.select(text("o_orderkey", "a").alias("alias"), "key", F.when(k % 4 == 0, "other").otherwise(F.col("name")).alias("name"), F.when(k % 7 == 0, None).otherwise(F.col("balance")).alias("balance"))
    return E.false_aliases(entries, of, "key", ["name", "balance"])


@query("""WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_linenumber = 1), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_linenumber = 2)
SELECT k, 'only_a' AS side FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'only_b' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def u12_set_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = I.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), "l_linenumber")
    return E.set_parity(line.where("l_linenumber = 1"), line.where("l_linenumber = 2"), "k")


@query(f"""SELECT c_custkey, t FROM (SELECT c_custkey, CAST(unnest(generate_series(8000, 8400)) AS BIGINT) AS d, (8000 + c_custkey % 100) * {DAY} + c_custkey % 2 * 5 AS a, (8000 + c_custkey % 100 + c_custkey % 200) * {DAY} AS b FROM customer) AS x,
 LATERAL (SELECT d * {DAY} AS t) WHERE t BETWEEN a AND b AND (d + 3) % 7 = 4""")
def f5_weekly_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    spans = I.table(spark, sf_dir, "customer").select("c_custkey", ((8000 + k % 100) * DAY + k % 2 * 5).alias("start_us"), ((8000 + k % 100 + k % 200) * DAY).alias("end_us"))
    return E.weekly_times(spans).select("c_custkey", "t")


@query("SELECT p_partkey AS token, CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 300 <= 255 THEN CAST(p_partkey % 300 AS INTEGER) END AS decimals FROM part")
def s13_token_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    whole = F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(k % 300)), 64, "0"))
    return E.token_decimals(I.table(spark, sf_dir, "part").select(k.alias("token"), F.when(k % 5 == 0, F.substring(whole, 1, 65)).otherwise(whole).alias("result"))).drop("result")


@query("""SELECT event_id, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS place FROM events""")
def o1_total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's canonical order as ranks, without a window over the whole of it."""
    e = I.table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return ranked(e, ["user_id", "ts", "event_id"], "place").select("event_id", "place")


# a line item is an object of its supplier: monthly if its order key is a multiple of 8
LISTED = """ob AS (SELECT l_orderkey * 10 + l_linenumber AS key, l_linenumber % 3 AS family, l_suppkey AS symbol, l_partkey % 12 AS month, CASE WHEN l_orderkey % 8 <> 0 THEN l_orderkey % 28 END AS day,
  CASE WHEN l_orderkey % 10 <> 0 THEN l_partkey END AS bytes, l_orderkey AS o FROM lineitem),
 st AS (SELECT *, CASE WHEN o % 13 = 0 THEN 'quarantined' WHEN o % 7 = 0 THEN 'sidecar_absent' WHEN o % 5 = 0 THEN 'checksum_proved_retained' ELSE 'sidecar_listed' END AS state, symbol % 6 <> 1 AS member FROM ob),
 ok AS (SELECT *, member AND state NOT IN ('quarantined', 'sidecar_absent') AS kept FROM st), mo AS (SELECT DISTINCT family, symbol, month FROM ok WHERE kept AND day IS NULL),
 ch AS (SELECT ok.*, kept AND (day IS NULL OR mo.symbol IS NULL) AS chosen FROM ok LEFT JOIN mo USING (family, symbol, month)),
 se AS (SELECT *, CASE WHEN NOT member THEN 'OUTSIDE' WHEN NOT kept THEN 'REJECTED' WHEN NOT chosen THEN 'SUPERSEDED' WHEN count(*) FILTER (WHERE chosen) OVER (PARTITION BY family, symbol, month, day) > 1 THEN 'COLLISION' ELSE 'SELECTED' END AS selection FROM ch)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("l_orderkey")
    listed = I.table(spark, sf_dir, "lineitem").select(
        (o * 10 + F.col("l_linenumber")).alias("key"), (F.col("l_linenumber") % 3).alias("family"), F.col("l_suppkey").alias("symbol"), (F.col("l_partkey") % 12).alias("month"),
        F.when(o % 8 != 0, o % 28).alias("day"), F.when(o % 10 != 0, F.col("l_partkey")).alias("bytes"),
    )
    some = lambda test: listed.where(test).select("key")
    members = I.table(spark, sf_dir, "lineitem").where("l_suppkey % 6 <> 1").select(F.col("l_suppkey").alias("symbol"))
    return E.acquisition_manifest(listed, members, some("(key div 10) % 7 <> 0"), some("(key div 10) % 13 = 0"), some("(key div 10) % 5 = 0"))


@query(f"""WITH {LISTED} SELECT key, family, symbol, month, day, bytes, state, selection, CASE WHEN selection = 'SELECTED' THEN CASE WHEN state = 'checksum_proved_retained' THEN 'PROVED' ELSE 'PENDING' END END AS validation,
 selection = 'SELECTED' AND state = 'checksum_proved_retained' AS consumable FROM se""")
def j29_acquisition_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir)


@query(f"""WITH {LISTED} SELECT family, symbol, count(*) AS objects, count(*) FILTER (WHERE selection = 'SELECTED') AS selected, count(*) FILTER (WHERE selection = 'SELECTED' AND state = 'checksum_proved_retained') AS consumable,
 CAST(coalesce(sum(bytes) FILTER (WHERE selection = 'SELECTED'), 0) AS BIGINT) AS bytes, count(*) FILTER (WHERE selection = 'SELECTED' AND bytes IS NULL) AS unknown, count(*) FILTER (WHERE selection = 'COLLISION') AS collisions,
 count(*) FILTER (WHERE selection = 'REJECTED') AS rejected FROM se WHERE selection <> 'OUTSIDE' GROUP BY family, symbol""")
def j29_manifest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.manifest_report(manifest(spark, sf_dir))
