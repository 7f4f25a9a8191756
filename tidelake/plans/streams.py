"""Queries over streams of the events table, each held against its batch twin's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.functions.times import HOUR, MINUTE, floor_to, us
from tidelake.plans import checks
from tidelake.plans import inputs as I
from tidelake.plans.market import R, rounded
from tidelake.streaming import refresh, twins

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


BATCHES = 4
#: Rows of a staged file, at least, where a batch has several.
FILE_ROWS = 500_000


def staged(rows: DataFrame, order: str) -> DataFrame:
    """rows as a stream of BATCHES micro-batches: files for each equal range of order (a long), written one range after the other.

    Every range has as many files, so a trigger that takes so many takes a range. They are as many as the
    smallest range can fill.
    """
    spark, to = rows.sparkSession, twins.folder(rows.sparkSession)
    low, high = rows.agg(F.min(order), F.max(order)).first()
    low, width = low or 0, max(((high or 0) - (low or 0)) // BATCHES + 1, 1)
    part = F.coalesce(F.floor((F.col(order) - low) / width), F.lit(0))
    sizes = dict(map(tuple, rows.groupBy(part).count().collect()))
    files = max(min(sizes.get(i, 0) for i in range(BATCHES)) // FILE_ROWS, 1)
    for i in range(BATCHES):
        rows.where(part == i).repartition(files).write.mode("append").parquet(to)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(to)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, by time."""
    e = I.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return staged(e.withColumn("at", us("ts")), "at").drop("at")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where("value > 0")
    return e.select("ts", F.col("user_id").alias("instrument_id"), F.col("event_id").alias("trade_id"), F.col("value").alias("price"), F.regexp_extract("props", "[0-9]+", 0).cast("double").alias("quantity"))


@query(f"""WITH {I.TRADES}, b AS (SELECT instrument_id, ts_us - ts_us % {HOUR} AS period_start_us, first(price ORDER BY ts_us, trade_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts_us, trade_id) AS close, sum(quantity) AS base_volume, count(*) AS trade_count FROM t GROUP BY ALL)
SELECT instrument_id, period_start_us, open, high, low, close, round(base_volume, {R}) AS base_volume, trade_count FROM b WHERE period_start_us + {HOUR} <= (SELECT (max(ts_us) // 1000) * 1000 - {10 * MINUTE} FROM t)""")
def t1_stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(twins.drain(twins.bars(trades(spark, sf_dir), HOUR, 10 * MINUTE)), "base_volume")


@query("SELECT event_id // 2 AS pair, event_id, row_number() OVER (PARTITION BY event_id // 2 ORDER BY ts, event_id) > 1 AS again FROM events")
def t2_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of an id is kept and which repeat it."""
    pairs = events(spark, sf_dir).withColumn("pair", F.expr("event_id div 2"))
    return twins.drain(refresh.repeats(pairs, "pair", "event_id", "60 days"))


@query(checks.SQL["w10_contiguous_prefix"])
def t3_stream_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = events(spark, sf_dir).select("user_id", floor_to(us("ts"), HOUR).alias("at_us"))
    found = twins.drain(twins.contiguous_prefix(hours, "user_id", "at_us", HOUR), "update")
    last = Window.partitionBy("user_id").orderBy(F.desc("batch"))
    return found.withColumn("turn", F.row_number().over(last)).where("turn = 1").select("user_id", "prefix_end", "length")


@query("""WITH RECURSIVE s AS (SELECT user_id, event_id, event_type AS state, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
 w AS (SELECT user_id, event_id, k, CAST(NULL AS VARCHAR) AS before, state, state = 'view' AS legal, CASE WHEN state = 'view' THEN state END AS now FROM s WHERE k = 1
  UNION ALL SELECT s.user_id, s.event_id, s.k, w.now, s.state, coalesce((w.now IS NULL AND s.state = 'view') OR (w.now = 'view' AND s.state IN ('click', 'view')) OR (w.now = 'click' AND s.state IN ('purchase', 'view')) OR (w.now = 'purchase' AND s.state = 'view'), FALSE),
   CASE WHEN coalesce((w.now IS NULL AND s.state = 'view') OR (w.now = 'view' AND s.state IN ('click', 'view')) OR (w.now = 'click' AND s.state IN ('purchase', 'view')) OR (w.now = 'purchase' AND s.state = 'view'), FALSE) THEN s.state ELSE w.now END FROM w JOIN s ON s.user_id = w.user_id AND s.k = w.k + 1)
SELECT user_id, event_id, before, state, legal FROM w""")
def t7_stream_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir).select("user_id", "event_id", F.col("event_type").alias("state"))
    return twins.drain(twins.states(log, "user_id", "event_id", set(checks.ALLOWED)))


@query(f"""WITH s AS (SELECT user_id AS session, event_id AS t, 900 + value AS equity FROM events), o AS (SELECT *, 1 - equity / greatest(1000.0, max(equity) OVER (PARTITION BY session ORDER BY t)) AS d FROM s) SELECT session, t, equity, round(d, {R}) AS drawdown FROM o WHERE d >= 0.12""")
def t8_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = events(spark, sf_dir).select(F.col("user_id").alias("session"), F.col("event_id").alias("t"), (900 + F.col("value")).alias("equity"))
    return rounded(twins.drain(twins.drawdown_alerts(path, "session", "t", 1000.0, 0.12)), "drawdown")


LATE = 10 * MINUTE
# trades are known up to 99 minutes after they happen
KNOWN = f"""k AS (SELECT *, ts_us + trade_id * 37 % 100 * {MINUTE} AS known_us, ts_us - ts_us % {HOUR} AS period_us FROM t),
 r AS (SELECT *, period_us + {HOUR + LATE} AS finish, last(price ORDER BY ts_us, trade_id) OVER w AS one, max(price) OVER w AS high, min(price) OVER w AS low, sum(quantity) OVER w AS volume, count(*) OVER w AS n,
  max(ROW(ts_us, trade_id, price)) OVER w AS newest, row_number() OVER w AS turn FROM k WINDOW w AS (PARTITION BY instrument_id, period_us ORDER BY known_us, trade_id)),
 s AS (SELECT *, newest[3] AS close, lag(newest[3]) OVER v AS before_close, lag(volume) OVER v AS before_volume, known_us >= finish AS late, coalesce(lead(known_us) OVER v >= finish, TRUE) AS last_in,
  max(known_us) OVER () // 1000 AS seen_ms, max(CAST(known_us >= finish AS INTEGER)) OVER (PARTITION BY instrument_id, period_us) AS any_late,
  sum(CAST(known_us >= finish AS INTEGER)) OVER v AS revision FROM r WINDOW v AS (PARTITION BY instrument_id, period_us ORDER BY known_us, trade_id))"""


@query(f"""WITH {I.TRADES}, {KNOWN.replace("last(price ORDER BY ts_us, trade_id) OVER w AS one, ", "")}
SELECT instrument_id, period_us, CASE WHEN late THEN 'CORRECTION' ELSE 'FINAL' END AS kind, CAST(revision AS BIGINT) AS revision, close, high, low, volume, n,
 CASE WHEN late THEN before_close END AS before_close, CASE WHEN late THEN before_volume END AS before_volume
FROM s WHERE late OR (last_in AND (any_late = 1 OR finish // 1000 < seen_ms))""")
def t5_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished hourly bars, and the changes that trades known over ten minutes after their hour bring."""
    t = I.trades(spark, sf_dir)
    known = t.withColumn("known_us", F.col("ts_us") + F.col("trade_id") * 37 % 100 * MINUTE)
    stream = staged(known.withColumn("known_at", F.timestamp_micros("known_us")), "known_us")
    return twins.drain(refresh.corrected_bars(stream, HOUR, LATE))


# each batch brings the latest value of a user's day anew, so batches overlap
@query(f"""WITH d AS (SELECT user_id, (event_id * 7 + user_id) % 30 AS day, value, event_id, epoch_us(ts) AS seen FROM events)
SELECT user_id, day, last(value ORDER BY seen, event_id) AS value, CAST(day % 5 AS BIGINT) AS shelf FROM d GROUP BY user_id, day""")
def t4_refreshed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of the versioned snapshots that micro-batches refresh; the third batch is run twice."""
    day = (F.col("event_id") * 7 + F.col("user_id")) % 30
    rows = events(spark, sf_dir).select("user_id", day.alias("day"), "value", F.struct(us("ts"), "event_id").alias("known"), (day % 5).alias("shelf"))
    to = twins.folder(spark)
    snapshots = refresh.Snapshots(f"{to}/rows", ["user_id", "day"], "shelf", "known")

    def merge(batch: DataFrame, n: int) -> None:
        for _ in range(2 if n == 2 else 1):
            snapshots.merge(batch, n)

    rows.writeStream.foreachBatch(merge).trigger(availableNow=True).option("checkpointLocation", f"{to}/log").start().awaitTermination()
    return snapshots.read(spark).select("user_id", "day", "value", F.col("shelf").cast("long").alias("shelf"))


@query("""WITH a AS (SELECT user_id, event_id, CAST(event_id * 13 % 1000 AS BIGINT) AS decided FROM events)
SELECT user_id, event_id, decided, coalesce(decided > max(decided) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS accepted FROM a""")
def t6_stream_advancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions in order of their ids, which are staged by id; one that does not advance is refused."""
    e = I.table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") * 13 % 1000).alias("decided"))
    return twins.drain(refresh.advancing(staged(e, "event_id"), "user_id", "event_id", "decided"))
