"""Queries over sources: archives and payloads are written from the given tables, then read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import times as T
from tidelake.operators import quality
from tidelake.plans import inputs as I
from tidelake.plans.market import R, rounded
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


def archive(lines: DataFrame, compress: bool = False) -> str:
    """Where lines (line) now are, as text files."""
    path = folder(lines.sparkSession)
    lines.write.option("compression", "gzip" if compress else "none").text(path)
    return path


E_ = "(event_id % 5)"


@query(f"""SELECT event_id, {I.START} + event_id * {T.MINUTE} AS open_us, value AS open, value + 1 AS high, value - 0.5 AS low, value AS close, event_id % 100 AS trades, CASE WHEN event_id % 3 = 0 THEN 'ms' ELSE 'us' END AS unit FROM events WHERE value > 1 AND event_id > 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0""")
def s3_candle_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = I.table(spark, sf_dir, "events").where("value > 1 AND event_id > 0"), F.col("event_id")
    open_us = I.START + k * T.MINUTE
    last = T.MINUTE + F.when(k % 17 == 0, 1).otherwise(0)
    at = lambda c: F.when(k % 3 == 0, F.floor(c / 1000)).otherwise(c).cast("string")
    close = F.when(k % 3 == 0, F.floor(open_us / 1000) + F.floor(last / 1000) - 1 + F.when(k % 17 == 0, 1).otherwise(0)).otherwise(open_us + last - 1).cast("string")
    v = lambda d: (F.col("value") + d).cast("string")
    fields = [at(open_us), v(0.0), v(1.0), v(-0.5), v(0.0), F.lit("3.5"), close, F.lit("7"), (k % 100).cast("string"), F.lit("1"), F.lit("2"), k.cast("string")]
    line = F.when(k % 13 == 0, F.concat_ws(",", *fields[:-1])).otherwise(F.concat_ws(",", *fields))
    path = archive(e.select(line.alias("value")).unionAll(spark.createDataFrame([(",".join(S.CANDLE),)], "value string")).coalesce(3))
    typed = quality.accepted(S.candles(spark, path, T.MINUTE))
    first = I.START
    kept = typed.withColumn("event_id", ((F.col("open_us") - first) / T.MINUTE).cast("long"))
    # a file's first candle may be kept as a listing day; those are candles of multiples of 17 alone
    return rounded(kept.where("event_id % 17 <> 0").select("event_id", "open_us", "open", "high", "low", "close", "trades", "unit"), "open", "high", "low", "close")


@query(f"""SELECT CAST(event_id AS VARCHAR) AS trade_id, 'U' || CAST(user_id AS VARCHAR) AS symbol, epoch_us(ts) AS ts_us, round(value, {R}) AS price, CAST(event_id % 7 AS DOUBLE) AS quantity FROM events WHERE value > 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0""")
def s4_venue_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k, us = I.table(spark, sf_dir, "events"), F.col("event_id"), T.us("ts")
    token = F.concat(F.floor(us / 1_000_000).cast("string"), F.lit("."), F.lpad((us % 1_000_000).cast("string"), 6, "0"))
    side = F.when(k % 11 == 0, "Hold").when(k % 2 == 0, "Buy").otherwise("Sell")
    line = F.concat_ws(",", token, F.concat(F.lit("U"), F.col("user_id").cast("string")), side, (k % 7).cast("string"), F.col("value").cast("string"), F.lit("PlusTick"), k.cast("string"), F.lit("1"), F.lit("1"), F.lit("1"))
    path = archive(e.select(line.alias("value")), compress=True)
    return rounded(quality.accepted(S.venue_trades(spark, path)).select("trade_id", "symbol", "ts_us", "price", "quantity"), "price")


def page(column: str) -> Column:
    """Payloads come in pages, so that none holds all of a key that many rows share."""
    return F.floor(F.col(column) / 1000).alias("page")


@query(f"""SELECT user_id AS key, {I.START} + event_id * {T.MINUTE} AS ts_us, round(value, {R}) AS open, round(value + 1, {R}) AS high, round(value - 0.5, {R}) AS low, round(value, {R}) AS close, 2e0 AS volume FROM events WHERE value > 1 AND event_id % 9 <> 0""")
def s6_ohlcv_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("event_id"), F.col("value")
    second = (F.lit(I.START // T.SECOND) + k * 60 + F.when(k % 9 == 0, 1).otherwise(0)).cast("double")
    bar = F.array(second, v, v + 1, v - 0.5, v, F.lit(2.0))
    payload = F.to_json(F.struct(F.struct(F.struct(F.collect_list(bar).alias("ohlcv_list")).alias("attributes")).alias("data")))
    made = I.table(spark, sf_dir, "events").where("value > 1").groupBy(F.col("user_id").alias("key"), page("event_id")).agg(payload.alias("json")).drop("page")
    return rounded(quality.accepted(S.ohlcv_payload(made, 60)), "open", "high", "low", "close")


@query(f"""WITH r AS (SELECT 'S' || CAST(user_id AS VARCHAR) AS symbol, epoch_us(ts) - epoch_us(ts) % {T.HOUR} AS ts_us, (value - 100) / 1e5 AS rate, CASE WHEN event_id % 4 = 0 THEN (value - 100) / 4e4 END AS daily, event_id FROM events),
 l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY symbol, ts_us ORDER BY event_id DESC) = 1) SELECT symbol, ts_us, round(rate, 8) AS funding_rate, round(coalesce(daily, rate * 3), 8) AS funding_rate_daily, ts_us AS availability_us FROM l""")
def s8_funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, v = I.table(spark, sf_dir, "events"), F.col("value")
    stamp = F.date_format(F.timestamp_micros(T.floor_to(T.us("ts"), T.HOUR)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = F.struct(stamp.alias("timestamp"), F.concat(F.lit(" s"), F.col("user_id").cast("string")).alias("symbol"), ((v - 100) / 1e5).alias("fundingRate"), F.when(F.col("event_id") % 4 == 0, (v - 100) / 4e4).alias("fundingRateDaily"))
    found = S.funding(e.select(F.col("event_id").alias("ordinal"), F.to_json(record).alias("json")))
    return found.withColumns({c: F.round(c, 8) for c in ("funding_rate", "funding_rate_daily")})


@query("""SELECT 'S' || CAST(user_id AS VARCHAR) AS symbol, count(*) AS points, min(event_id) AS first, max(event_id) AS last FROM events GROUP BY 1""")
def s9_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events")
    per = e.groupBy("user_id", page("event_id")).agg(F.collect_list(F.struct(F.col("event_id").alias("t"), F.col("value").alias("l"), F.lit(0.0).alias("s"))).alias("history"))
    one = per.select(F.to_json(F.array(F.struct(F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("symbol"), "history"))).alias("json"))
    return S.history(one)


@query(f"""SELECT CAST(o_orderkey AS BIGINT) AS block, o_orderkey * 1000000 AS ts_us, o_custkey % 50 AS log_index, '0x' || lpad(lower(to_hex(o_custkey)), 40, '0') AS token0, '0x' || lpad(lower(to_hex(o_custkey + 1)), 40, '0') AS token1, '0x' || lpad(lower(to_hex(o_orderkey)), 40, '0') AS pair
 FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0""")
def s12_pair_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, c = I.table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    hexed = lambda x: F.concat(F.lit("0x"), F.lower(F.hex(x.cast("long"))))
    word = lambda x: F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(x.cast("long"))), 64, "0"))
    logs = o.select(
        F.when(k % 5 == 0, "0xbad").otherwise("0xFAC").alias("address"), F.array(F.lit("0xT0"), word(c), word(c + 1)).alias("topics"), F.concat(word(k), F.repeat(F.lit("0"), 64)).alias("data"),
        hexed(k).alias("block_number"), F.when(k % 7 == 0, "0xother").otherwise(word(k)).alias("block_hash"), hexed(c % 50).alias("log_index"), (k % 11 == 0).alias("removed"),
    )
    headers = o.where("o_orderkey % 13 <> 0").select(hexed(k).alias("number"), word(k).alias("hash"), hexed(k).alias("timestamp"))
    return S.pair_logs(logs, headers, "0xfac", "0xt0")[0]


@query(f"""WITH {I.bars_sql()}, d AS (SELECT instrument_id, CASE WHEN instrument_id % 2 = 0 THEN 'a' ELSE 'b' END AS venue, period_start FROM b)
SELECT venue, year(make_timestamp(period_start)) AS year, month(make_timestamp(period_start)) AS month, count(*) AS rows, count(DISTINCT instrument_id) AS instruments FROM d GROUP BY 1, 2, 3""")
def k1_partitioned_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = I.bars(spark, sf_dir).withColumn("venue", F.when(F.col("instrument_id") % 2 == 0, "a").otherwise("b")).withColumn("market", F.lit("spot")).withColumn("timeframe", F.lit("1d"))
    path = folder(spark)
    S.write_bars(b, path)
    back = spark.read.parquet(path)
    return back.groupBy("venue", F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month")).agg(F.count("*").alias("rows"), F.count_distinct("instrument_id").alias("instruments"))


@query("""WITH v AS (SELECT chr(CAST(97 + user_id % 4 AS INTEGER)) AS venue, count(DISTINCT (user_id, ts::DATE)) AS n FROM events WHERE value > 0 GROUP BY 1)
SELECT venue, CASE venue WHEN 'c' THEN 'undeclared' WHEN 'd' THEN 'changed' ELSE 'ok' END AS status FROM v UNION ALL SELECT 'gone', 'missing' """)
def q9_verify_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of each venue against a manifest that lacks venue c, has other contents for d and names one more file."""
    venue = F.chr(F.col("instrument_id") % 4 + 97)
    path = folder(spark)
    S.write_bars(I.bars(spark, sf_dir).withColumn("venue", venue).withColumn("market", F.lit("spot")).withColumn("timeframe", F.lit("1d")), path)
    found, of = S.manifest(spark, path).checkpoint(), F.regexp_extract("file", "venue=([^/]+)", 1)
    declared = found.where(of != "c").withColumn("sha256", F.when(of == "d", F.reverse("sha256")).otherwise(F.col("sha256")))
    gone = found.limit(1).withColumn("file", F.lit("venue=gone/part.parquet"))
    return S.verify(found, declared.unionByName(gone)).select(of.alias("venue"), "status")
