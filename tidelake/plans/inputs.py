"""The market tables that queries read, derived from the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.times import DAY, us
from tidelake.operators import bars as B

#: 2024-01-01, where events begin.
START = 1704067200 * 10**6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str | list[str], each: int = 25_000) -> DataFrame:
    """rows dealt by key to tasks of `each` or so: before rows are repeated, or sorted where they are packed small.

    Spark deals by bytes read or shuffled, which tell nothing of that.
    """
    return rows.repartition(max(-(-rows.count() // each), 1), *([key] if isinstance(key, str) else key))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of positive value as trades."""
    e = table(spark, sf_dir, "events").where("value > 0")
    quantity = F.regexp_extract("props", "[0-9]+", 0).cast("double")
    return e.select(F.col("user_id").alias("instrument_id"), us("ts").alias("ts_us"), F.col("event_id").alias("trade_id"), F.col("value").alias("price"), quantity.alias("quantity"), F.lit(None).cast("double").alias("quote_quantity"))


TRADES = """t AS (SELECT user_id AS instrument_id, epoch_us(ts) AS ts_us, event_id AS trade_id, value AS price,
  CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS quantity FROM events WHERE value > 0)"""


def bars(spark: SparkSession, sf_dir: str, step: int = DAY) -> DataFrame:
    """Bars of those trades, known when they end: daily ones by default."""
    made = B.reconstruct(trades(spark, sf_dir), step, unique_ids=True)
    return made.withColumn("period_start", F.col("period_start_us")).withColumn("availability", F.col("period_end_us"))


def bars_sql(step: int = DAY) -> str:
    return f"""{TRADES}, b AS (SELECT instrument_id, ts_us - ts_us % {step} AS period_start, ts_us - ts_us % {step} + {step} AS availability,
  first(price ORDER BY ts_us, trade_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts_us, trade_id) AS close,
  sum(quantity) AS base_volume, sum(price * quantity) AS quote_volume, count(*) AS trade_count FROM t GROUP BY ALL)"""


def decisions(spark: SparkSession, sf_dir: str, first: int = 8, last: int = 29, days: int = 1) -> DataFrame:
    """Each instrument at noon of every days-th day."""
    who = trades(spark, sf_dir).select("instrument_id").distinct()
    times = F.sequence(F.lit(START + first * DAY + DAY // 2), F.lit(START + last * DAY + DAY // 2), F.lit(days * DAY))
    return who.select("instrument_id", F.explode(times).alias("t"))


def decisions_sql(first: int = 8, last: int = 29, days: int = 1) -> str:
    return f"""d AS (SELECT instrument_id, t FROM (SELECT DISTINCT instrument_id FROM t) CROSS JOIN
  (SELECT unnest(generate_series({START + first * DAY + DAY // 2}, {START + last * DAY + DAY // 2}, {days * DAY})) AS t))"""


def late_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as facts about parts: an order's day, known when shipped; some are known out of order."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    day = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * DAY
    met = line.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return met.select(F.col("l_partkey").alias("part"), day("o_orderdate").alias("period_start"), day("l_shipdate").alias("availability"), F.col("l_extendedprice").cast("double").alias("x"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"))


LATE_FACTS = f"""f AS (SELECT l_partkey AS part, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * {DAY} AS period_start,
  date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * {DAY} AS availability, CAST(l_extendedprice AS DOUBLE) AS x, l_orderkey AS k, l_linenumber AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
