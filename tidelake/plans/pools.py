"""Queries over pools, listings, registries and their merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import times as T
from tidelake.operators import pools as P
from tidelake.plans import inputs as I

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


def one_of(names: tuple[str, ...], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (at % len(names) + 1).cast("int"))


def K() -> Column:  # noqa: N802
    return F.col("o_orderkey")


def C() -> Column:  # noqa: N802
    return F.col("o_custkey")


CHAINS, BASES, QUOTES = ("ethereum", "solana", "Base", "arbitrum", "tron"), ("WETH", "eth", "BTC", "USDC", "FOO", "wbtc"), ("USDC", "USDT", "DAI", "ETH")
PAIRS = f"""p AS (SELECT o_orderkey AS k, ({list(CHAINS)})[CAST(o_custkey % 5 + 1 AS INTEGER)] AS chain, ({list(BASES)})[CAST(o_orderkey % 6 + 1 AS INTEGER)] AS base,
  ({list(QUOTES)})[CAST(o_custkey % 4 + 1 AS INTEGER)] AS quote, CASE WHEN o_custkey % 5 = 1 THEN repeat('A', CAST(30 + o_orderkey % 20 AS INTEGER)) WHEN o_orderkey % 7 = 0 THEN '0x' || lpad(lower(to_hex(o_orderkey)), 64, '0')
  ELSE '0x' || lpad(lower(to_hex(o_orderkey)), 40, '0') END AS address, CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice END AS liquidity, o_totalprice / 7 AS volume FROM orders)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hexed = lambda n: F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(K().cast("long"))), n, "0"))
    address = F.when(C() % 5 == 1, F.repeat(F.lit("A"), (30 + K() % 20).cast("int"))).when(K() % 7 == 0, hexed(64)).otherwise(hexed(40))
    price = F.col("o_totalprice").cast("double")
    return I.table(spark, sf_dir, "orders").select(
        K().alias("k"), one_of(CHAINS, C()).alias("chain"), one_of(BASES, K()).alias("base"), one_of(QUOTES, C()).alias("quote"), address.alias("address"),
        F.when(K() % 9 > 0, price).alias("liquidity"), (price / 7).alias("volume"),
    )


VALID = "CASE WHEN lower(chain) = 'solana' THEN regexp_full_match(address, '[1-9A-HJ-NP-Za-km-z]{32,44}') ELSE regexp_full_match(address, '0x[a-fA-F0-9]{40}') END"


@query(f"WITH {PAIRS} SELECT k, {VALID} AS valid FROM p")
def p15_pool_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("k", P.valid_address(F.col("chain"), F.col("address")).alias("valid"))


@query(f"""WITH {PAIRS}, a AS (SELECT * FROM (VALUES ('ETH', 'ETH'), ('ETH', 'WETH'), ('BTC', 'BTC'), ('BTC', 'WBTC'), ('USDC', 'USDC')) v(target, alias))
SELECT k, target, base, quote FROM p JOIN a ON upper(base) = alias WHERE lower(chain) IN ('ethereum', 'solana', 'base') AND {VALID} AND (upper(quote) IN ('USDC', 'USDT') OR upper(base) IN ('USDC', 'USDT'))""")
def p16_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = spark.createDataFrame([("ETH", "ETH"), ("ETH", "WETH"), ("BTC", "BTC"), ("BTC", "WBTC"), ("USDC", "USDC")], "target string, alias string")
    return P.filter_pairs(pairs(spark, sf_dir), aliases, ("ethereum", "solana", "base"), ("USDC", "USDT")).select("k", "target", "base", "quote")


@query(f"WITH {PAIRS} SELECT k, CASE WHEN chain NOT IN ('ethereum', 'solana') THEN 'chain_not_allowed:' || chain WHEN coalesce(liquidity, 0) < 50000 THEN 'low_liquidity' END AS reason FROM p")
def p10_listing_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("k", P.listing_screen(F.col("chain"), F.col("liquidity"), ("ethereum", "solana"), 50_000).alias("reason"))


@query(f"WITH {PAIRS} SELECT k, round(sqrt(coalesce(CAST(liquidity AS DOUBLE), 0) * CAST(volume AS DOUBLE)), 4) AS score FROM p")
def o4_priority_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("k", F.round(P.priority_score(F.col("liquidity"), F.col("volume")), 4).alias("score"))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey % 9 AS VARCHAR) || '%' WHEN o_orderkey % 3 = 2 THEN '0.3%' END AS tier FROM orders""")
def f20_fee_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    tier = F.concat((C() % 9).cast("string"), F.lit("%"))
    labels = F.when(K() % 3 == 0, F.array(F.lit("v2"), F.lit(None).cast("string"))).when(K() % 3 == 1, F.array(F.lit("v3"), tier, F.lit("1%"))).otherwise(F.array(F.lit("0.3%")))
    return I.table(spark, sf_dir, "orders").select(K().alias("k"), P.fee_tier(labels).alias("tier"))


@query("""WITH t AS (SELECT (['BTC', 'UPX', 'ETH', 'DAI', 'eth', 'BEARX', 'SOL'])[CAST(o_custkey % 7 + 1 AS INTEGER)] || CAST(CASE WHEN o_custkey % 7 = 3 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS VARCHAR) || CASE WHEN o_orderkey % 11 = 0 THEN 'BUSD' ELSE 'USDT' END AS symbol,
  CASE WHEN o_orderstatus = 'P' THEN 'BREAK' WHEN o_orderstatus = 'O' THEN NULL ELSE 'TRADING' END AS status, CASE WHEN o_orderkey % 13 > 0 THEN CAST(o_totalprice AS DOUBLE) END AS v, o_orderkey FROM orders)
SELECT symbol, round(v, 2) AS quote_volume FROM t WHERE symbol LIKE '%USDT' AND symbol = upper(symbol) AND symbol NOT LIKE '%UP%' AND symbol NOT LIKE '%BEAR%' AND symbol <> 'DAIUSDT' AND coalesce(status, 'TRADING') = 'TRADING' AND v >= 100000 AND o_orderkey % 17 <> 0""")
def p13_ticker_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.concat(one_of(("BTC", "UPX", "ETH", "DAI", "eth", "BEARX", "SOL"), C()), F.when(C() % 7 == 3, "").otherwise(K().cast("string")))
    status = F.when(F.col("o_orderstatus") == "P", "BREAK").when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise("TRADING")
    rows = I.table(spark, sf_dir, "orders").select(F.concat(base, F.when(K() % 11 == 0, "BUSD").otherwise("USDT")).alias("symbol"), status.alias("status"), F.when(K() % 13 > 0, F.col("o_totalprice").cast("double")).alias("quote_volume"), K().alias("k"))
    known = rows.where("k % 17 = 0").where("symbol <> 'DAIUSDT'").select(F.lower("symbol").alias("symbol"))
    return P.ticker_screen(rows.drop("k"), 100_000, known).select("symbol", F.round("quote_volume", 2).alias("quote_volume"))


@query("""WITH r AS (SELECT (['b', 'a', 'zz'])[CAST(l_linenumber % 3 + 1 AS INTEGER)] AS provider, 'p' || CAST(l_suppkey AS VARCHAR) AS pool, l_shipdate AS ts, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS ordinal, CAST(l_extendedprice AS DOUBLE) AS close FROM lineitem)
SELECT pool, CAST(ts AS DATE) AS ts, provider, ordinal, round(close, 2) AS close FROM r QUALIFY row_number() OVER (PARTITION BY pool, ts ORDER BY CASE provider WHEN 'a' THEN 0 WHEN 'b' THEN 1 ELSE 99 END, ordinal) = 1""")
def u3_merge_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    pool = F.concat(F.when(line % 2 == 0, "P").otherwise("p"), F.col("l_suppkey").cast("string"))
    rows = I.table(spark, sf_dir, "lineitem").select(one_of(("b", "a", "zz"), line).alias("provider"), pool.alias("pool"), F.col("l_shipdate").cast("date").alias("ts"), (F.col("l_orderkey") * 10 + line).cast("long").alias("ordinal"), F.col("l_extendedprice").cast("double").alias("close"))
    return P.merge_providers(rows, {"a": 0, "b": 1}).withColumn("close", F.round("close", 2))


@query("""WITH r AS (SELECT o_custkey AS id, o_orderstatus = 'O' AS active, o_orderkey AS ordinal FROM orders) SELECT id, active, ordinal FROM r QUALIFY row_number() OVER (PARTITION BY id ORDER BY active DESC, ordinal DESC) = 1""")
def u6_active_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.active_first(I.table(spark, sf_dir, "orders").select(C().alias("id"), (F.col("o_orderstatus") == "O").alias("active"), K().alias("ordinal")))


BORN = """b AS (SELECT l_suppkey AS pool, 't' || CAST(CASE WHEN l_suppkey % 3 = 0 THEN l_linenumber % 2 ELSE 0 END AS VARCHAR) AS tx_hash, CAST(l_suppkey % 4 AS BIGINT) AS log_index, CAST(l_suppkey * 10 AS BIGINT) AS creation_block FROM lineitem)"""


def born(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("l_suppkey")
    tx = F.concat(F.lit("t"), F.when(s % 3 == 0, F.col("l_linenumber") % 2).otherwise(0).cast("int").cast("string"))
    return I.table(spark, sf_dir, "lineitem").select(s.alias("pool"), tx.alias("tx_hash"), (s % 4).cast("long").alias("log_index"), (s * 10).cast("long").alias("creation_block"), F.lit("x").alias("token0"), F.lit("y").alias("token1"))


@query(f"""WITH {BORN} SELECT pool, min(tx_hash) AS tx_hash, min(log_index) AS log_index, min(creation_block) AS creation_block, count(*) AS copies, CASE WHEN count(DISTINCT tx_hash) > 1 THEN 'conflicting_birth' END AS code FROM b GROUP BY 1""")
def u7_births(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.births(born(spark, sf_dir)).drop("token0", "token1")


@query(f"""WITH {BORN}, u AS (SELECT pool, min(tx_hash) AS tx_hash, min(creation_block) AS creation_block, min(log_index) AS log_index, count(DISTINCT tx_hash) AS births, count(*) AS copies FROM b GROUP BY 1),
 o AS (SELECT *, 't' || CAST(pool % 7 AS VARCHAR) AS token0, 'T' || CAST(pool % 5 AS VARCHAR) AS token1, CASE pool % 7 WHEN 1 THEN 'USDC' END AS s0, CASE pool % 5 WHEN 2 THEN 'USDT' END AS s1 FROM u WHERE births = 1)
SELECT pool, CASE WHEN s0 IS NULL THEN token0 ELSE token1 END AS base, coalesce(s0, s1) AS quote_symbol, creation_block, log_index, row_number() OVER (ORDER BY creation_block, log_index, pool) - 1 AS birth_order,
 CAST(creation_block * 12000000 + {T.DAY} AS BIGINT) AS available_us, CAST(NULL AS VARCHAR) AS code FROM o WHERE (s0 IS NULL) <> (s1 IS NULL)
UNION ALL SELECT pool, NULL, NULL, NULL, NULL, NULL, NULL, 'conflicting_birth' FROM u WHERE births > 1""")
def q18_pool_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pools known a day after their block (12 seconds a block here), and those refused."""
    s = F.col("pool")
    records = born(spark, sf_dir).withColumns({"token0": F.concat(F.lit("t"), (s % 7).cast("string")), "token1": F.concat(F.lit("T"), (s % 5).cast("string"))})
    stables = spark.createDataFrame([("t1", "USDC"), ("T2", "USDT")], "token string, symbol string")
    pools, refused = P.registry(records, stables, I.table(spark, sf_dir, "lineitem").count(), 12_000_000, T.DAY)
    columns = ["pool", "base", "quote_symbol", "creation_block", "log_index", "birth_order", "available_us"]
    return pools.select(*columns).unionByName(refused.select("pool", "code"), allowMissingColumns=True)


@query("""SELECT o_orderkey AS k, o_custkey % 3 = 0 OR o_custkey % 3 = 1 AS invalid FROM orders""")
def p22_invalid_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    artifact = F.when(C() % 3 == 0, "EXP-1").when(C() % 3 == 1, F.concat(F.lit("EXP-1 grid "), K().cast("string"))).otherwise(F.concat(F.lit("EXP-1"), K().cast("string")))
    return I.table(spark, sf_dir, "orders").select(K().alias("k"), P.invalid_artifact(artifact, ("EXP-1", "EXP-9")).alias("invalid"))


@query("""SELECT o_orderkey AS k, coalesce(o_orderstatus = 'F' AND o_totalprice > 100000 AND o_custkey % 3 > 0 AND (CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 2 = 0 END), FALSE) AS ready FROM orders""")
def p20_live_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = F.when(F.col("o_orderstatus") == "F", "real_asof").otherwise("synthetic")
    return I.table(spark, sf_dir, "orders").select(K().alias("k"), P.live_ready(mode, F.col("o_totalprice").cast("double") - 100_000, C() % 3 > 0, F.when(K() % 5 > 0, K() % 2 == 0)).alias("ready"))


@query("""SELECT o_orderkey AS k, CASE WHEN c_custkey % 4 > 0 THEN c_name END AS venue_symbol, CASE WHEN c_custkey % 4 > 0 THEN c_custkey END AS venue_id FROM orders JOIN customer ON o_custkey = c_custkey""")
def p21_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = I.table(spark, sf_dir, "customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").alias("symbol"), F.col("c_name").alias("venue_symbol"), F.col("c_custkey").alias("venue_id"))
    known, unknown = P.translate(I.table(spark, sf_dir, "orders").select(K().alias("k"), "o_custkey"), names, "o_custkey")
    return known.select("k", "venue_symbol", "venue_id").unionByName(unknown.select("k"), allowMissingColumns=True)


@query(f"""SELECT event_id, user_id FROM events WHERE epoch_us(ts) BETWEEN {I.START + 3 * T.DAY} AND {I.START + 9 * T.DAY} AND user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""")
def p6_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = I.table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"))
    rows = I.table(spark, sf_dir, "events").withColumn("at_us", T.us("ts"))
    return P.between(rows, keys, "user_id", "at_us", I.START + 3 * T.DAY, I.START + 9 * T.DAY).select("event_id", "user_id")


@query(f"""SELECT DISTINCT user_id AS instrument_id FROM events WHERE epoch_us(ts) <= {I.START + 2 * T.DAY} AND event_type = 'purchase'""")
def p7_listed_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.table(spark, sf_dir, "events").select(F.col("user_id").alias("instrument_id"), T.us("ts").alias("at_us"), F.col("event_type").alias("chain"))
    return P.listed_by(rows, "at_us", I.START + 2 * T.DAY, "purchase")


@query("""WITH l AS (SELECT o_custkey, o_orderkey, o_orderdate < lag(o_orderdate) OVER w AS a, o_totalprice < lag(o_totalprice) OVER w AS b FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, o_orderkey, 'o_orderdate' AS field FROM l WHERE a UNION ALL SELECT o_custkey, o_orderkey, 'o_totalprice' FROM l WHERE b""")
def w24_times_go_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.times_go_back(I.table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", ("o_orderdate", "o_totalprice"))


@query("""SELECT p_partkey AS symbol, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50) THEN 'current' WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 7) THEN 'historical' WHEN p_partkey % 5 = 0 THEN 'reviewed' ELSE 'unresolved' END AS state FROM part""")
def j25_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = I.table(spark, sf_dir, "lineitem"), I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("symbol"))
    named = lambda test: line.where(test).select(F.col("l_partkey").alias("symbol"))
    return P.classify_members(part, [("current", named("l_quantity >= 50")), ("historical", named("l_linenumber = 7")), ("reviewed", part.where("symbol % 5 = 0"))])


@query("""WITH n AS (SELECT DISTINCT l_partkey AS s, 'supported' AS k FROM lineitem WHERE l_linenumber = 1 UNION ALL SELECT DISTINCT l_partkey, 'unmapped' FROM lineitem WHERE l_linenumber = 7)
SELECT s AS symbol, 'supported_and_unmapped' AS code FROM n GROUP BY s HAVING count(*) > 1 UNION ALL SELECT s, k || '_not_in_inventory' FROM n WHERE s % 5 = 0 UNION ALL SELECT s, k || '_not_in_universe' FROM n WHERE s % 7 = 0""")
def j26_set_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = I.table(spark, sf_dir, "lineitem"), I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("symbol"))
    named = lambda n: line.where(f"l_linenumber = {n}").select(F.col("l_partkey").alias("symbol"))
    return P.set_faults(named(1), named(7), part.where("symbol % 5 > 0"), part.where("symbol % 7 > 0"))


@query("SELECT p_partkey AS symbol FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 5)")
def j27_not_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = I.table(spark, sf_dir, "lineitem").where("l_linenumber = 5").select(F.col("l_partkey").alias("symbol"))
    return I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("symbol")).join(covered, "symbol", "left_anti")


@query("""WITH o AS (SELECT o_orderpriority AS family, o_orderkey % 4 AS m, o_orderkey AS k FROM orders) SELECT family, count(*) FILTER (WHERE m <> 3) AS objects, CAST(coalesce(sum(k) FILTER (WHERE m <> 3), 0) AS BIGINT) AS bytes,
 count(*) FILTER (WHERE m = 2) AS without_checksum, count(*) FILTER (WHERE m = 3) AS lone_checksums FROM o GROUP BY 1""")
def s17_object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of remainder 0 and 1 have an object and its checksum, 2 an object alone, 3 a checksum alone."""
    name = F.concat(F.lit("d/"), K().cast("string"), F.lit(".zip"))
    both = F.array(F.struct(name.alias("key"), K().cast("long").alias("size")), F.struct(F.concat(name, F.lit(".CHECKSUM")).alias("key"), F.lit(64).cast("long").alias("size")))
    some = F.when(K() % 4 <= 1, both).when(K() % 4 == 2, F.slice(both, 1, 1)).otherwise(F.slice(both, 2, 1))
    rows = I.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("family"), F.explode(some).alias("x")).select("family", "x.*")
    return P.object_inventory(rows)


@query("""WITH p AS (SELECT l_suppkey AS plan, CASE WHEN l_suppkey % 5 > 0 OR l_linenumber > 1 THEN l_partkey END AS b, CASE WHEN l_linenumber % 2 = 0 THEN 5 END AS c FROM lineitem), n AS (SELECT plan, CASE WHEN count(b) = count(*) THEN CAST(sum(greatest(0, b - coalesce(c, 0))) AS BIGINT) END AS new_bytes FROM p GROUP BY 1)
SELECT plan, new_bytes, CASE WHEN new_bytes IS NOT NULL THEN greatest(0, new_bytes - 6000) END AS shortfall, CASE WHEN new_bytes IS NULL THEN 'unknown' WHEN new_bytes > 6000 THEN 'short' ELSE 'fits' END AS state FROM n""")
def a15_feasibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    size = F.when((F.col("l_suppkey") % 5 > 0) | (line > 1), F.col("l_partkey").cast("long"))
    return P.feasibility(I.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("plan"), size.alias("bytes"), F.when(line % 2 == 0, F.lit(5).cast("long")).alias("credit")), "plan", 6000)


@query("""SELECT o_custkey AS symbol, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS families, count(*) AS objects, min('k' || CAST(o_orderkey AS VARCHAR)) AS example FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def a29_funding_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return P.funding_members(rows.select(C().alias("symbol"), F.col("o_orderpriority").alias("family"), F.concat(F.lit("k"), K().cast("string")).alias("key")))


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey AS d, o_orderkey % 3 > 0 AS ok FROM orders), g AS (SELECT d FROM o WHERE ok GROUP BY d)
SELECT (SELECT count(*) FROM o WHERE ok) AS keys, (SELECT count(*) FROM g) AS digests, (SELECT CAST(sum(d) AS BIGINT) FROM g) AS bytes, (SELECT count(*) FROM o WHERE NOT ok) AS unverified""")
def a30_retained_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.table(spark, sf_dir, "orders").select(K().alias("key"), F.sha2(C().cast("string"), 256).alias("sha256"), C().cast("long").alias("size"))
    return P.retained_credit(rows, rows.where("key % 3 > 0"))


@query("""WITH p AS (SELECT o_orderkey AS pool, o_custkey AS birth FROM orders) SELECT count(*) AS pools, CAST(sum(greatest(0, 900 - greatest(birth, 50) + 1)) AS BIGINT) AS blocks FROM p""")
def a16_pool_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.table(spark, sf_dir, "orders").select(K().alias("pool"), C().cast("long").alias("birth"))
    return P.clamped_blocks(rows, 50, 900).agg(F.count("*").alias("pools"), F.sum("blocks").alias("blocks"))


@query("""WITH r AS (SELECT l_suppkey AS pool, unnest(CASE WHEN l_linenumber % 2 = 0 THEN ['swap'] ELSE ['swap', 'sync'] END) AS topic, CAST(l_partkey AS BIGINT) AS a, CAST(l_partkey + 40 AS BIGINT) AS z, l_suppkey * 3 AS birth FROM lineitem),
 n AS (SELECT pool, topic, max(greatest(0, 150 - greatest(birth, 10) + 1)) AS needed FROM r GROUP BY 1, 2), c AS (SELECT DISTINCT pool, topic, x FROM (SELECT pool, topic, birth, unnest(generate_series(a, z)) AS x FROM r) WHERE x >= birth AND x BETWEEN 10 AND 150)
SELECT pool, topic, CAST(needed AS BIGINT) AS needed, count(x) AS covered, count(x) = needed AS complete FROM n LEFT JOIN c USING (pool, topic) GROUP BY pool, topic, needed""")
def j20_registry_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = I.table(spark, sf_dir, "lineitem")
    topics = F.when(F.col("l_linenumber") % 2 == 0, F.array(F.lit("swap"))).otherwise(F.array(F.lit("swap"), F.lit("sync")))
    receipts = line.select(F.array("l_suppkey").alias("addresses"), topics.alias("topics"), F.col("l_partkey").cast("long").alias("from_block"), (F.col("l_partkey") + 40).cast("long").alias("to_block"))
    pools = I.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pool"), (F.col("s_suppkey") * 3).cast("long").alias("birth"))
    return P.registry_coverage(receipts, pools, 10, 150)
