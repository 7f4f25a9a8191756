"""Archives and payloads to typed tables, and the partitioned bar table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.functions import times as T
from tidelake.functions import wide
from tidelake.functions.checks import address_word, hex_quantity, sound_ohlc
from tidelake.operators.quality import issue, with_issues

CANDLE = ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trades", "taker_base", "taker_quote", "ignore"]
#: What an archive's volume columns measure, by market: (volume, second volume).
VOLUME_UNITS = {"spot": ("base_asset", "quote_asset"), "usdm": ("base_asset", "quote_asset"), "coinm": ("contracts", "base_asset")}
VENUE_TRADES = ["timestamp", "symbol", "side", "size", "price", "tickDirection", "trdMatchID", "grossValue", "homeNotional", "foreignNotional"]


def raw_csv(spark: SparkSession, path: str, columns: list[str], header: str | None = None) -> DataFrame:
    """Every line of CSV files, gzipped too, as text columns and its file; lines that begin with `header` are left out.

    A line with too many or too few fields has width other than len(columns).
    """
    lines = spark.read.text(path).withColumn("object", F.col("_metadata.file_path")).where("trim(value) <> ''")
    if header:
        lines = lines.where(~F.col("value").startswith(header))
    fields = F.split("value", ",", -1)
    return lines.select("object", F.size(fields).alias("width"), *(F.trim(F.get(fields, F.lit(i))).alias(c) for i, c in enumerate(columns)))


def candles(spark: SparkSession, path: str, interval_us: int, market: str = "spot") -> DataFrame:
    """Candle archives, with or without a header line, as typed rows with issues; times by each row's own unit.

    A first candle of an object on the grid whose close is early is a listing day: a warning.
    """
    rows = raw_csv(spark, path, CANDLE, header="open_time")
    unit = T.unit_by_digits(F.col("open_time").try_cast("long"))
    typed = rows.select(
        "object", "width", unit.alias("unit"), T.to_us(F.col("open_time").try_cast("long"), unit).alias("open_us"), T.to_us(F.col("close_time").try_cast("long"), unit).alias("close_us"),
        *(F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close", "volume", "quote_volume", "taker_base", "taker_quote")), F.col("trades").try_cast("long").alias("trades"),
    )
    firsts = typed.groupBy("object").agg(F.min("open_us").alias("first_us"))  # a row for each file
    typed = typed.join(F.broadcast(firsts), "object")
    first = F.col("open_us") == F.col("first_us")
    aligned = F.pmod("open_us", F.lit(interval_us)) == 0
    off = F.col("close_us") != T.closes_at(F.col("open_us"), interval_us, F.col("unit"))
    checked = with_issues(
        typed,
        issue(F.col("width") != len(CANDLE), "malformed_row", width=F.col("width")),
        issue(off & ~(first & aligned), "interval_mismatch"), issue(off & first & aligned, "listing_day_partial", "WARNING"),
        issue(~sound_ohlc(*(F.col(c) for c in ("open", "high", "low", "close", "volume"))), "unsound_ohlc"),
    )
    volume, second = VOLUME_UNITS[market]
    return checked.drop("first_us").withColumn("volume_unit", F.lit(volume)).withColumn("second_volume_unit", F.lit(second))


def venue_trades(spark: SparkSession, path: str) -> DataFrame:
    """Trade archives of ten text columns as typed trades with issues; times are exact decimal seconds."""
    rows = raw_csv(spark, path, VENUE_TRADES, header="timestamp")
    typed = rows.select("object", "symbol", "side", F.col("trdMatchID").alias("trade_id"), T.decimal_seconds(F.col("timestamp")).alias("ts_us"), F.col("size").try_cast("double").alias("quantity"), F.col("price").try_cast("double").alias("price"))
    return with_issues(
        typed, issue(F.col("ts_us").isNull(), "bad_timestamp"), issue(~F.col("side").isin("Buy", "Sell"), "bad_side"),
        issue(~(F.col("price") > 0), "non_positive_price"), issue(~(F.col("quantity") > 0), "non_positive_quantity"), issue(F.coalesce("trade_id", F.lit("")) == "", "missing_trade_id"),
    )


def ohlcv_payload(payloads: DataFrame, interval_s: int) -> DataFrame:
    """(key, json) with data.attributes.ohlcv_list of [second, open, high, low, close, volume] -> key, ts_us, OHLCV, issues."""
    parsed = F.from_json("json", "data struct<attributes:struct<ohlcv_list:array<array<double>>>>")
    rows = payloads.select("key", F.explode(parsed["data"]["attributes"]["ohlcv_list"]).alias("x"))
    typed = rows.select("key", (F.col("x")[0].cast("long") * T.SECOND).alias("ts_us"), F.col("x")[0].alias("raw"), *(F.col("x")[i].alias(c) for i, c in enumerate(("open", "high", "low", "close", "volume"), 1)))
    again = F.count("*").over(Window.partitionBy("key", "ts_us")) > 1
    return with_issues(
        typed.withColumn("again", again), issue((F.col("raw") % interval_s) != 0, "misaligned"), issue(F.col("again"), "duplicate_time"),
        issue(~sound_ohlc(*(F.col(c) for c in ("open", "high", "low", "close", "volume"))), "unsound_ohlc"),
    ).drop("raw", "again")


def candle_arrays(payloads: DataFrame) -> DataFrame:
    """(key, json: array of arrays of tokens) -> key, open_us, OHLCV, trades."""
    rows = payloads.select("key", F.explode(F.from_json("json", "array<array<string>>")).alias("x"))
    return rows.select("key", (F.col("x")[0].cast("long") * 1000).alias("open_us"), *(F.col("x")[i].cast("double").alias(c) for i, c in enumerate(("open", "high", "low", "close", "volume"), 1)), F.col("x")[8].cast("long").alias("trades"))


def funding(payloads: DataFrame) -> DataFrame:
    """(json, ordinal) -> symbol, ts_us, funding_rate, funding_rate_daily (3 rates if missing), availability_us; the last of a (symbol, time)."""
    x = F.from_json("json", "timestamp string, symbol string, fundingRate double, fundingRateDaily double, availability_us long")
    rows = payloads.select("ordinal", x.alias("x"))
    ts = F.unix_micros(F.try_to_timestamp(F.col("x.timestamp")))
    typed = rows.select("ordinal", F.upper(F.trim("x.symbol")).alias("symbol"), ts.alias("ts_us"), F.coalesce("x.fundingRate", F.lit(0.0)).alias("funding_rate"), F.col("x.fundingRateDaily").alias("daily"), F.coalesce("x.availability_us", ts).alias("availability_us"))
    last = typed.where("ts_us is not null and symbol <> ''").groupBy("symbol", "ts_us").agg(F.max_by(F.struct("funding_rate", "daily", "availability_us"), "ordinal").alias("y"))
    return last.select("symbol", "ts_us", "y.funding_rate", F.coalesce("y.daily", F.col("y.funding_rate") * 3).alias("funding_rate_daily"), "y.availability_us")


def history(payloads: DataFrame) -> DataFrame:
    """(json: [{symbol, history: [{t, l, s}]}]) -> symbol, points, first, last."""
    rows = payloads.select(F.explode(F.from_json("json", "array<struct<symbol:string,history:array<struct<t:long,l:double,s:double>>>>")).alias("x"))
    points = rows.select("x.symbol", F.explode("x.history").alias("p"))
    return points.groupBy("symbol").agg(F.count("*").alias("points"), F.min("p.t").alias("first"), F.max("p.t").alias("last"))


def listing(payloads: DataFrame) -> DataFrame:
    """(json: {symbols: [...]}) -> symbol, base, quote, status, spot."""
    x = F.from_json("json", "symbols array<struct<symbol:string,baseAsset:string,quoteAsset:string,status:string,isSpotTradingAllowed:boolean>>")
    rows = payloads.select(F.explode(x["symbols"]).alias("s"))
    return rows.select("s.symbol", F.upper("s.baseAsset").alias("base"), F.upper("s.quoteAsset").alias("quote"), "s.status", F.coalesce("s.isSpotTradingAllowed", F.lit(False)).alias("spot"))


def tickers(payloads: DataFrame) -> DataFrame:
    """(json: [{symbol, quoteVolume, count}]) -> symbol, quote_volume, trades; blank symbols and volumes not finite or negative are left out."""
    rows = payloads.select(F.explode(F.from_json("json", "array<struct<symbol:string,quoteVolume:string,count:long>>")).alias("s"))
    typed = rows.select(F.trim("s.symbol").alias("symbol"), F.col("s.quoteVolume").try_cast("double").alias("quote_volume"), F.col("s.count").alias("trades"))
    return typed.where("symbol <> '' AND quote_volume >= 0 AND quote_volume < double('infinity')")


def event_logs(logs: DataFrame, headers: DataFrame, emitter: str, topic: str, topics: int, data_words: int = 0) -> DataFrame:
    """logs of one event with block, block_s, words and code: null, or why a log can't be decoded.

    logs: address, topics, data, block_number, block_hash, log_index, removed and, where a log may come
    twice, tx_hash; headers: number, hash, timestamp. A log must come from the emitter, not be removed, have
    so many topics with the event's first, come once (by tx_hash and log_index), agree with its block's
    header in number and hash, and hold data_words words (0: any data).
    """
    same = F.lower("address") == emitter.lower()
    shape = (F.size("topics") == topics) & (F.lower(F.get("topics", F.lit(0))) == topic.lower())
    known = headers.select(
        hex_quantity(F.col("number")).cast("long").alias("block"), F.lower("hash").alias("header_hash"), hex_quantity(F.col("timestamp")).cast("long").alias("block_s")
    )
    # merged: the headers' size is guessed from packed keys, so what is taken for small may not fit a broadcast
    joined = logs.withColumn("block", hex_quantity(F.col("block_number")).cast("long")).join(known.hint("merge"), "block", "left")
    code = (
        F.when(~same, "wrong_emitter").when(F.col("removed"), "removed_log").when(~shape, "bad_topics").when(F.col("header_hash").isNull(), "missing_header")
        .when(F.col("header_hash") != F.lower("block_hash"), "hash_mismatch")
    )
    joined = joined.withColumn("words", wide.words(F.col("data"), data_words) if data_words else F.lit(None).cast("array<string>"))
    if data_words:
        code = code.when(F.col("words").isNull(), "bad_data")
    marked = joined.withColumn("code", code)
    if "tx_hash" not in logs.columns:
        return marked
    twice = Window.partitionBy("tx_hash", "log_index")  # a key is a log: few rows each
    # what is refused is not decoded, so its words and topics need not be dealt and sorted
    marked = marked.withColumns({c: F.when(F.col("code").isNull(), F.col(c)) for c in ("topics", "words")})
    return marked.withColumn("code", F.when(F.col("code").isNull() & (F.count("*").over(twice) > 1), "duplicate_log").otherwise(F.col("code")))


def _faulty(marked: DataFrame) -> DataFrame:
    return marked.where("code is not null").select("block", "log_index", "code")


def _place(*extra: str) -> list[Column]:
    return [F.col("block"), (F.col("block_s") * T.SECOND).alias("ts_us"), hex_quantity(F.col("log_index")).cast("long").alias("log_index"), *map(F.col, extra)]


def pair_logs(logs: DataFrame, headers: DataFrame, factory: str, topic: str) -> tuple[DataFrame, DataFrame]:
    """(decoded, violations) of the logs by which a factory says that it made a pair; see event_logs."""
    marked = event_logs(logs, headers, factory, topic, 3)
    good = marked.where("code is null").select(
        *_place(), address_word(F.col("topics")[1]).alias("token0"), address_word(F.col("topics")[2]).alias("token1"), address_word(F.substring("data", 1, 66)).alias("pair"),
    )
    return good, _faulty(marked)


SWAP_AMOUNTS = ["amount0_in", "amount1_in", "amount0_out", "amount1_out"]


def swap_logs(logs: DataFrame, headers: DataFrame, pair: str, topic: str) -> tuple[DataFrame, DataFrame]:
    """(decoded, violations) of a pair's swap logs: sender, recipient and four amounts of 256 bits; see event_logs and functions.wide."""
    marked = event_logs(logs, headers, pair, topic, 3, 4)
    sender, to = address_word(F.col("topics")[1]), address_word(F.col("topics")[2])
    marked = marked.withColumn("code", F.when(F.col("code").isNull() & (sender.isNull() | to.isNull()), "bad_address").otherwise(F.col("code")))
    good = marked.where("code is null").select(*_place("tx_hash"), sender.alias("sender"), to.alias("recipient"), *(wide.u256(F.col("words")[i]).alias(c) for i, c in enumerate(SWAP_AMOUNTS)))
    return good, _faulty(marked)


def sync_logs(logs: DataFrame, headers: DataFrame, pair: str, topic: str) -> tuple[DataFrame, DataFrame]:
    """(decoded, violations) of a pair's sync logs: two reserves, which must be under 2 ** 112; see event_logs."""
    marked = event_logs(logs, headers, pair, topic, 1, 2)
    reserves = [wide.u256(F.col("words")[i]) for i in range(2)]
    over = ~(wide.fits(reserves[0], 112) & wide.fits(reserves[1], 112))
    marked = marked.withColumn("code", F.when(F.col("code").isNull() & over, "reserve_range").otherwise(F.col("code")))
    return marked.where("code is null").select(*_place("tx_hash"), reserves[0].alias("reserve0"), reserves[1].alias("reserve1")), _faulty(marked)


PARTITIONS = ["venue", "market", "timeframe", "year", "month"]


def write_bars(bars: DataFrame, path: str) -> None:
    """Bars (venue, market, timeframe, period_start_us, ...) as Parquet by venue, market, timeframe, year and month, sorted within files."""
    at = F.timestamp_micros("period_start_us")
    dated = bars.withColumn("year", F.year(at)).withColumn("month", F.month(at))
    dealt = dated.repartition(*PARTITIONS).sortWithinPartitions(*PARTITIONS, "instrument_id", "period_start_us")
    dealt.write.mode("overwrite").partitionBy(*PARTITIONS).option("compression", "zstd").parquet(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, sha256, bytes, rows of every Parquet file under path."""
    name = lambda c: F.regexp_extract(c, "((?:[^/=]+=[^/]*/)*[^/]+)$", 1)  # noqa: E731  partition folders and the file
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select(name("path").alias("file"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    rows = spark.read.parquet(path).groupBy(name("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    return files.join(rows, "file", "left").fillna({"rows": 0})


def verify(found: DataFrame, declared: DataFrame) -> DataFrame:
    """file, status of two manifests: ok, missing, undeclared or changed."""
    a, b = (x.select("file", F.struct("sha256", "bytes", "rows").alias(n)) for x, n in ((found, "a"), (declared, "b")))
    status = F.when(F.col("a").isNull(), "missing").when(F.col("b").isNull(), "undeclared").when(F.col("a") == F.col("b"), "ok").otherwise("changed")
    return a.join(b, "file", "full_outer").select("file", status.alias("status"))
