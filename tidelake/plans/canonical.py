"""Queries over the canonical bar pipeline, its side tables, and payload readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.times import DAY, HOUR
from tidelake.operators import bars, canonical, factors
from tidelake.plans import inputs as I
from tidelake.plans.market import DAYS, GRID, R, grid, rounded
from tidelake.sources import market as S
from tidelake.streaming.twins import folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


def made(spark: SparkSession, sf_dir: str) -> canonical.Canonical:
    """The grid's bars, some repeated as they are, some repeated with another close; a provider that knows even instruments."""
    g, k = grid(spark, sf_dir).withColumn("timeframe", F.lit("6h")), F.col("instrument_id")
    again = g.where(k % 10 == 0).withColumn("source_id", F.lit("b"))
    other = g.where(k % 15 == 0).withColumns({"close": F.col("close") + 1, "source_id": F.lit("c")})
    rows = g.withColumn("source_id", F.lit("a")).unionByName(again).unionByName(other)
    provider = bars.resample_daily(g.where(k % 2 == 0), step_us=6 * HOUR).withColumn("close", F.col("close") + F.when(k % 11 == 0, 1.0).otherwise(0.0)).checkpoint()
    return canonical.canonical_daily(rows, provider, {"6h": 6 * HOUR}, " 6h ")


@query(f"""WITH {DAYS} SELECT instrument_id, day_us, first(open ORDER BY period_start_us) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY period_start_us) AS close, sum(base_volume) AS base_volume,
 CASE WHEN count(quote_volume) = count(*) THEN sum(quote_volume) END AS quote_volume, CAST(sum(trade_count) AS BIGINT) AS trade_count, day_us + {DAY} AS availability_us
 FROM g JOIN dd USING (instrument_id) WHERE observed = 4 AND period_start_us - period_start_us % {DAY} = day_us AND instrument_id % 15 <> 0 GROUP BY instrument_id, day_us""")
def q6_canonical_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir).daily


@query(f"""WITH {DAYS}, dl AS (SELECT instrument_id AS k, day_us FROM dd WHERE observed = 4), n AS (
 SELECT 'quarantine' AS "table", 'conflicting_duplicate' AS code, sum(2 + CASE WHEN instrument_id % 10 = 0 THEN 1 ELSE 0 END) AS n FROM g WHERE instrument_id % 15 = 0
 UNION ALL SELECT 'issues', 'conflicting_duplicate', sum(2 + CASE WHEN instrument_id % 10 = 0 THEN 1 ELSE 0 END) FROM g WHERE instrument_id % 15 = 0
 UNION ALL SELECT 'issues', 'identical_duplicate', count(*) FROM g WHERE instrument_id % 10 = 0 AND instrument_id % 15 <> 0
 UNION ALL SELECT 'issues', 'incomplete_utc_day:6h', count(*) FROM dd WHERE observed <> 4 AND instrument_id % 15 <> 0
 UNION ALL SELECT 'issues', 'missing_right', count(*) FROM dl WHERE k % 2 = 1 AND k % 15 <> 0 UNION ALL SELECT 'issues', 'missing_left', count(*) FROM dl WHERE k % 2 = 0 AND k % 15 = 0
 UNION ALL SELECT 'issues', 'mismatch', count(*) FROM dl WHERE k % 2 = 0 AND k % 15 <> 0 AND k % 11 = 0 UNION ALL SELECT 'daily', 'kept', count(*) FROM dl WHERE k % 15 <> 0)
 SELECT "table", code, CAST(n AS BIGINT) AS "rows" FROM n WHERE n > 0""")
def k2_side_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars and side tables are written, read again and counted by code."""
    path = folder(spark)
    made(spark, sf_dir).write(path)
    read = lambda name: spark.read.parquet(f"{path}/{name}").withColumn("table", F.lit(name))
    rows = read("daily").select("table", F.lit("kept").alias("code")).unionByName(read("quarantine").select("table", "code")).unionByName(read("issues").select("table", "code"))
    return rows.groupBy("table", "code").agg(F.count("*").alias("rows"))


@query(f"""WITH {GRID}, r AS (SELECT instrument_id, period_start_us, '6h' AS timeframe FROM g UNION ALL SELECT instrument_id, period_start_us - period_start_us % {DAY}, '1d' FROM g WHERE instrument_id % 3 = 0)
SELECT instrument_id, period_start_us, timeframe FROM r WHERE timeframe = '6h'""")
def a4_daily_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir).select("instrument_id", "period_start_us", F.lit("6h").alias("timeframe"))
    day = g.where("instrument_id % 3 = 0").withColumns({"timeframe": F.lit("1d"), "period_start_us": F.col("period_start_us") - F.pmod("period_start_us", F.lit(DAY))})
    return canonical.daily_source(g.unionByName(day), "6h")


@query(f"""WITH {GRID}, a AS (SELECT instrument_id, period_start_us, close FROM g WHERE (instrument_id + period_start_us // {HOUR}) % 13 <> 0),
 b AS (SELECT instrument_id, period_start_us, close + CASE WHEN instrument_id % 11 = 0 THEN 5e-1 ELSE 0 END AS close FROM g WHERE (instrument_id + period_start_us // {HOUR}) % 19 <> 0),
 j AS (SELECT instrument_id, period_start_us, a.close AS ac, b.close AS bc, a.instrument_id IS NULL AS na, b.instrument_id IS NULL AS nb FROM a FULL JOIN b USING (instrument_id, period_start_us))
 SELECT instrument_id, period_start_us, 'row' AS field, 'missing_from_theirs' AS status, CAST(NULL AS DOUBLE) AS delta FROM j WHERE nb UNION ALL SELECT instrument_id, period_start_us, 'row', 'missing_from_ours', NULL FROM j WHERE na
 UNION ALL SELECT instrument_id, period_start_us, 'row', 'duplicate_theirs', NULL FROM b WHERE instrument_id % 9 = 0 UNION ALL SELECT instrument_id, period_start_us, 'close', 'mismatch', ac - bc FROM j WHERE NOT na AND NOT nb AND abs(ac - bc) > 0.1""")
def j11_compare_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir).select("instrument_id", "period_start_us", "open", "close", F.lit(1).alias("ordinal"))
    hour = F.col("instrument_id") + F.floor(F.col("period_start_us") / HOUR)
    theirs = g.where(hour % 19 != 0).withColumn("close", F.col("close") + F.when(F.col("instrument_id") % 11 == 0, 0.5).otherwise(0.0))
    again = theirs.where("instrument_id % 9 = 0").withColumns({"ordinal": F.lit(2), "close": F.col("close") + 9})
    return canonical.compare_bars(g.where(hour % 13 != 0), theirs.unionByName(again), ["instrument_id", "period_start_us"], {"open": 0.0, "close": 0.1})


@query(f"""WITH {I.bars_sql()}, h AS (SELECT instrument_id, period_start, lag(close, 2) OVER w AS a, lag(close) OVER w AS m, close, lag(period_start, 2) OVER w AS p FROM b WINDOW w AS (PARTITION BY instrument_id ORDER BY period_start))
SELECT instrument_id, period_start, round(a, {R}) AS oldest, round(m, {R}) AS middle, round(close, {R}) AS newest FROM h WHERE p IS NOT NULL""")
def w1_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = factors.history(I.bars(spark, sf_dir), 3)
    return rounded(held.select("instrument_id", "period_start", *(F.get("closes", F.lit(i)).alias(c) for i, c in enumerate(("oldest", "middle", "newest")))), "oldest", "middle", "newest")


@query(f"""SELECT user_id AS key, ({I.START} // 1000 + event_id * 60000) * 1000 AS open_us, round(value, {R}) AS open, round(value + 1, {R}) AS high, round(value - 1, {R}) AS low, round(value, {R}) AS close, 2e0 AS volume, CAST(event_id % 7 AS BIGINT) AS trades FROM events""")
def s7_candle_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("event_id"), F.col("value")
    tokens = F.array(*(x.cast("string") for x in (F.lit(I.START // 1000) + k * 60_000, v, v + 1, v - 1, v, F.lit(2), F.lit(0), F.lit(0), k % 7)))
    return rounded(S.candle_arrays(I.table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.to_json(F.array(tokens)).alias("json"))), "open", "high", "low", "close")


@query("""SELECT 'S' || CAST(o_orderkey AS VARCHAR) AS symbol, 'B' || CAST(o_custkey AS VARCHAR) AS base, 'USDT' AS quote, o_orderstatus AS status, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 2 = 0 ELSE FALSE END AS spot FROM orders""")
def s10_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    one = F.struct(F.concat(F.lit("S"), k.cast("string")).alias("symbol"), F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("baseAsset"), F.lit("usdt").alias("quoteAsset"), F.col("o_orderstatus").alias("status"), F.when(k % 3 > 0, k % 2 == 0).alias("isSpotTradingAllowed"))
    return S.listing(I.table(spark, sf_dir, "orders").select(F.to_json(F.struct(F.array(one).alias("symbols"))).alias("json")))


@query("""SELECT 'S' || CAST(o_orderkey AS VARCHAR) AS symbol, round(CAST(o_totalprice AS DOUBLE), 2) AS quote_volume, CAST(o_custkey AS BIGINT) AS trades FROM orders WHERE o_orderkey % 5 > 2""")
def s11_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    volume = F.when(k % 5 == 0, "NaN").when(k % 5 == 1, (-price).cast("string")).otherwise(price.cast("string"))
    one = F.struct(F.when(k % 5 == 2, " ").otherwise(F.concat(F.lit(" S"), k.cast("string"))).alias("symbol"), volume.alias("quoteVolume"), F.col("o_custkey").alias("count"))
    return S.tickers(I.table(spark, sf_dir, "orders").select(F.to_json(F.array(one)).alias("json"))).withColumn("quote_volume", F.round("quote_volume", 2))


# bars as files with their sources' times: in s, ms or us by key; some days have one that disagrees
SOURCED = f"""{GRID}, so AS (SELECT *, (instrument_id + period_start_us // {6 * HOUR}) % 23 AS z, period_start_us % {DAY} // {6 * HOUR} AS q FROM g)"""
CODE = "CASE z WHEN 0 THEN 'source_close_mismatch' WHEN 1 THEN 'open_time_mismatch' WHEN 2 THEN 'close_time_mismatch' WHEN 3 THEN 'unknown_unit' WHEN 4 THEN 'missing_time' END"


def sourced(spark: SparkSession, sf_dir: str) -> str:
    """Where those bars are."""
    g = grid(spark, sf_dir)
    start, k = F.col("period_start_us"), F.col("instrument_id")
    z, scale = (k + F.floor(start / (6 * HOUR))) % 23, F.when(k % 3 == 0, 1_000_000).when(k % 3 == 1, 1000).otherwise(1)
    opens = F.floor(start / scale)
    closes = opens + F.floor(F.lit(6 * HOUR) / scale) - 1
    rows = g.select(
        "instrument_id", F.lit("6h").alias("timeframe"), F.when(z == 1, start + 1).otherwise(start).alias("period_start_us"), F.when(z == 2, closes * scale + 1).otherwise(closes * scale).alias("close_us"),
        *canonical.CONTENT, F.concat_ws(":", k, start).alias("source_id"), opens.alias("source_open_time"), F.when(z == 0, closes + 1).when(z == 4, F.lit(None)).otherwise(closes).alias("source_close_time"),
        F.when(z == 3, "min").when(k % 3 == 0, "s").when(k % 3 == 1, "ms").otherwise("us").alias("source_timestamp_unit"),
    )
    path = folder(spark)
    rows.write.parquet(path)
    return path


@query(f"WITH {SOURCED} SELECT instrument_id, period_start_us + CASE WHEN z = 1 THEN 1 ELSE 0 END AS period_start_us, {CODE} AS code FROM so")
def q6_time_cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.cross_checked(spark.read.parquet(sourced(spark, sf_dir)), {"6h": 6 * HOUR}).select("instrument_id", "period_start_us", "code")


@query(f"""WITH {SOURCED}, w AS (SELECT *, period_start_us - period_start_us % {DAY} AS day_us FROM so WHERE z > 4)
SELECT instrument_id, day_us, first(open ORDER BY period_start_us) AS open, last(close ORDER BY period_start_us) AS close, sum(base_volume) AS base_volume, CAST(sum(trade_count) AS BIGINT) AS trade_count, 'daily' AS "table", NULL AS code
 FROM w GROUP BY instrument_id, day_us HAVING count(*) = 4
UNION ALL SELECT instrument_id, period_start_us + CASE WHEN z = 1 THEN 1 ELSE 0 END, NULL, NULL, NULL, NULL, 'refused', {CODE} FROM so WHERE z <= 4""")
def q6_canonical_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to daily bars, and the rows whose times disagree."""
    path = sourced(spark, sf_dir)
    none = spark.read.parquet(path).limit(0).withColumn("day_us", F.lit(0).cast("long")).select("instrument_id", "day_us", *canonical.CONTENT)
    made_ = canonical.canonical_from_files(spark, path, none, {"6h": 6 * HOUR}, "6h")
    daily = made_.daily.select("instrument_id", "day_us", "open", "close", "base_volume", "trade_count", F.lit("daily").alias("table"), F.lit(None).cast("string").alias("code"))
    codes = ["source_close_mismatch", "open_time_mismatch", "close_time_mismatch", "unknown_unit", "missing_time"]
    refused = made_.issues.where(F.col("code").isin(*codes)).select("instrument_id", F.col("at_us").alias("day_us"), F.lit("refused").alias("table"), "code")
    return daily.unionByName(refused, allowMissingColumns=True)
