"""Queries over bars, as-of access, factors, labels and portfolios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.times import DAY, HOUR
from tidelake.operators import asof, bars, factors, labels, portfolio, stats
from tidelake.plans import inputs as I

R = 6  # digits that doubles are rounded to, in both engines


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, R) for c in columns})


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


BAR_SQL = f"round(open, {R}) AS open, round(high, {R}) AS high, round(low, {R}) AS low, round(close, {R}) AS close, round(base_volume, {R}) AS base_volume, round(quote_volume, {R}) AS quote_volume, trade_count"
BAR = ("open", "high", "low", "close", "base_volume", "quote_volume")


@query(f"""WITH {I.TRADES}, u AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY instrument_id, trade_id ORDER BY ts_us, price, quantity) = 1),
b AS (SELECT instrument_id, ts_us - ts_us % {HOUR} AS period_start_us, first(price ORDER BY ts_us, trade_id) AS open, max(price) AS high, min(price) AS low,
 last(price ORDER BY ts_us, trade_id) AS close, sum(quantity) AS base_volume, sum(price * quantity) AS quote_volume, count(*) AS trade_count FROM u GROUP BY ALL)
SELECT instrument_id, period_start_us, {BAR_SQL}, period_start_us + {HOUR} AS period_end_us FROM b""")
def a1_trades_to_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bars.reconstruct(I.trades(spark, sf_dir), HOUR), *BAR)


@query("""WITH x AS (SELECT l_orderkey AS trade_id FROM lineitem) SELECT trade_id, count(*) AS occurrences FROM x GROUP BY 1 HAVING count(*) > 1""")
def a1_duplicate_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.duplicate_trades(I.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("trade_id")))


# full cadence is made from part keys: a 6-hour bar for each key, day and quarter, without a few
GRID = f"""g AS (SELECT p_partkey AS instrument_id, {I.START} + d * {DAY} + q * {6 * HOUR} AS period_start_us, 1e2 + (p_partkey * 7 + d * 4 + q) % 50 AS open, 2e2 AS high, 5e1 AS low,
  1e2 + (p_partkey * 3 + d + q * 5) % 40 AS close, 1e1 * (q + 1) AS base_volume, CASE WHEN (p_partkey + d) % 5 = 0 AND q = 2 THEN NULL ELSE 1e3 * (q + 1) END AS quote_volume, q + 1 AS trade_count
  FROM part, generate_series(0, 9) AS ds(d), generate_series(0, 3) AS qs(q) WHERE (p_partkey + 3 * d + q) % 17 <> 0)"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.spread(I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("instrument_id")), "instrument_id")
    p = p.select("instrument_id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("d")).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(3)))).where((F.col("instrument_id") + 3 * F.col("d") + F.col("q")) % 17 != 0)
    k, d, q = F.col("instrument_id"), F.col("d"), F.col("q")
    return p.select(
        "instrument_id", (I.START + d.cast("long") * DAY + q.cast("long") * (6 * HOUR)).alias("period_start_us"), (100.0 + (k * 7 + d * 4 + q) % 50).alias("open"), F.lit(200.0).alias("high"), F.lit(50.0).alias("low"),
        (100.0 + (k * 3 + d + q * 5) % 40).alias("close"), (10.0 * (q + 1)).alias("base_volume"), F.when(~(((k + d) % 5 == 0) & (q == 2)), 1000.0 * (q + 1)).alias("quote_volume"), (q + 1).cast("long").alias("trade_count"),
    )


DAYS = f"""{GRID}, dd AS (SELECT instrument_id, period_start_us - period_start_us % {DAY} AS day_us, count(*) AS observed FROM g GROUP BY ALL)"""


@query(f"""WITH {DAYS} SELECT instrument_id, day_us, observed, CAST(4 AS BIGINT) AS expected, CASE WHEN observed <> 4 THEN 'incomplete_utc_day' END AS code FROM dd""")
def a3_complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.day_completeness(grid(spark, sf_dir), 6 * HOUR)


@query(f"""WITH {DAYS} SELECT instrument_id, day_us, first(open ORDER BY period_start_us) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY period_start_us) AS close, sum(base_volume) AS base_volume,
 CASE WHEN count(quote_volume) = count(*) THEN sum(quote_volume) END AS quote_volume, CAST(sum(trade_count) AS BIGINT) AS trade_count, day_us + {DAY} AS availability_us
 FROM g JOIN dd USING (instrument_id) WHERE observed = 4 AND period_start_us - period_start_us % {DAY} = day_us GROUP BY instrument_id, day_us""")
def a2_resample_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.resample_daily(grid(spark, sf_dir), step_us=6 * HOUR)


DUPES = """r AS (SELECT l_partkey % 50 AS k, l_suppkey % 20 AS day, l_linenumber % 2 AS x, l_orderkey * 10 + l_linenumber AS source FROM lineitem)"""


@query(f"""WITH {DUPES}, s AS (SELECT *, count(DISTINCT x) OVER (PARTITION BY k, day) AS kinds, row_number() OVER (PARTITION BY k, day ORDER BY source) AS turn FROM r)
SELECT k, day, x, source, CASE WHEN kinds > 1 THEN 'conflicting_duplicate' WHEN turn > 1 THEN 'identical_duplicate' END AS code FROM s""")
def a5_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = I.table(spark, sf_dir, "lineitem").selectExpr("l_partkey % 50 AS k", "l_suppkey % 20 AS day", "l_linenumber % 2 AS x", "l_orderkey * 10 + l_linenumber AS source")
    return bars.enforce_unique(I.spread(r, ["k", "day"], 1_000_000), ["k", "day"], ["x"], "source")


@query(f"""WITH {GRID}, a AS (SELECT instrument_id, period_start_us, open, close, quote_volume FROM g WHERE (instrument_id + period_start_us // {HOUR}) % 13 <> 0),
 b AS (SELECT instrument_id, period_start_us, open, close + CASE WHEN instrument_id % 11 = 0 THEN 5e-1 ELSE 0 END AS close, CASE WHEN instrument_id % 7 <> 0 THEN quote_volume END AS quote_volume FROM g WHERE (instrument_id + period_start_us // {HOUR}) % 19 <> 0),
 j AS (SELECT instrument_id, period_start_us, a.open AS ao, b.open AS bo, a.close AS ac, b.close AS bc, a.quote_volume AS aq, b.quote_volume AS bq, a.instrument_id IS NULL AS na, b.instrument_id IS NULL AS nb FROM a FULL JOIN b USING (instrument_id, period_start_us)),
 l AS (SELECT instrument_id, period_start_us, 'open' AS field, bo AS expected, ao AS observed FROM j WHERE NOT na AND NOT nb UNION ALL SELECT instrument_id, period_start_us, 'close', bc, ac FROM j WHERE NOT na AND NOT nb UNION ALL SELECT instrument_id, period_start_us, 'quote_volume', bq, aq FROM j WHERE NOT na AND NOT nb)
 SELECT instrument_id, period_start_us, field, expected, observed, CASE WHEN expected IS NULL OR observed IS NULL THEN 'null_mismatch' WHEN abs(expected - observed) <= 0.1 THEN 'match' ELSE 'mismatch' END AS status FROM l WHERE expected IS NOT NULL OR observed IS NOT NULL
 UNION ALL SELECT instrument_id, period_start_us, 'row', NULL, NULL, CASE WHEN na THEN 'missing_left' ELSE 'missing_right' END FROM j WHERE na OR nb""")
def j10_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir).select("instrument_id", "period_start_us", "open", "close", "quote_volume")
    hour = F.col("instrument_id") + F.floor(F.col("period_start_us") / HOUR)
    a = g.where(hour % 13 != 0)
    b = g.where(hour % 19 != 0).withColumn("close", F.col("close") + F.when(F.col("instrument_id") % 11 == 0, 0.5).otherwise(0.0)).withColumn("quote_volume", F.when(F.col("instrument_id") % 7 != 0, F.col("quote_volume")))
    return bars.reconcile(a, b, ["instrument_id", "period_start_us"], ["open", "close", "quote_volume"], 0.1)


ASOF = "SELECT d.instrument_id, d.t, max(ROW(period_start, availability, close)) AS x FROM d JOIN b ON b.instrument_id = d.instrument_id AND b.availability <= d.t AND b.period_start <= d.t"


@query(f"""WITH {I.bars_sql()}, {I.decisions_sql()}, x AS ({ASOF} GROUP BY ALL)
SELECT instrument_id, t, x[1] AS period_start, x[2] AS availability, round(x[3], {R}) AS close FROM x""")
def j1_asof_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(asof.latest(I.decisions(spark, sf_dir), I.bars(spark, sf_dir), "instrument_id", ["close"]), "close")


PARTS = f"""{I.LATE_FACTS}, d AS (SELECT p_partkey AS part, CAST(t AS BIGINT) AS t FROM part, generate_series({9000 * DAY}, {10400 * DAY}, {90 * DAY}) AS s(t))"""


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, each of which is repeated by date or by version."""
    return I.spread(I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part")), "part")


def part_asks(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = F.sequence(F.lit(9000 * DAY), F.lit(10400 * DAY), F.lit(90 * DAY))
    return parts(spark, sf_dir).select("part", F.explode(times).alias("t"))


@query(f"""WITH {PARTS}, x AS (SELECT d.part, d.t, max(ROW(period_start, availability, k, n)) AS x FROM d JOIN f ON f.part = d.part AND availability <= t AND period_start <= t GROUP BY ALL)
SELECT part, t, x[1] AS period_start, x[2] AS availability, x[3] AS k, x[4] AS n FROM x""")
def j1_asof_late_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.latest(part_asks(spark, sf_dir), I.late_facts(spark, sf_dir), "part", ["k", "n"])


@query(f"""WITH {PARTS}, x AS (SELECT d.part, d.t, max(ROW(period_start, availability, k, n)) AS x FROM d JOIN f ON f.part = d.part AND availability <= t AND period_start <= t AND availability >= t - {45 * DAY} GROUP BY ALL)
SELECT part, t, x[1] AS period_start, x[2] AS availability, x[3] AS k, x[4] AS n FROM x""")
def j1_asof_max_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.latest_within(part_asks(spark, sf_dir), I.late_facts(spark, sf_dir), "part", ["k", "n"], 45 * DAY)


@query(f"""WITH {PARTS} SELECT d.part, d.t, k, n FROM d JOIN f ON f.part = d.part WHERE availability <= t AND (period_start <= t) AND (n % 3 = 0 OR t <= period_start + {200 * DAY})""")
def j2_asof_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = I.late_facts(spark, sf_dir).withColumn("valid_from", F.col("period_start")).withColumn("valid_to", F.when(F.col("n") % 3 != 0, F.col("period_start") + 200 * DAY))
    return asof.all_eligible(part_asks(spark, sf_dir), facts, "part").select("part", "t", "k", "n")


# versions of parts: three each, some open, some known late, some that overlap
VERSIONS = f"""v AS (SELECT p_partkey AS part, CAST(s AS BIGINT) AS version, p_partkey * 10 + s AS id, (9000 + 300 * s + p_partkey % 40) * {DAY} AS valid_from,
 CASE WHEN s < 2 THEN (9300 + 300 * s + p_partkey % 40 + CASE WHEN p_partkey % 13 = 0 THEN 50 ELSE 0 END) * {DAY} END AS valid_to,
 (9000 + 300 * s + p_partkey % 60) * {DAY} AS known_from, CASE WHEN p_partkey % 4 = 0 THEN CAST({10200 * DAY} AS BIGINT) END AS known_to FROM part, generate_series(0, 2) AS ss(s))"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parts(spark, sf_dir).select("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("version"))
    k, s = F.col("part"), F.col("version")
    return p.select(
        "part", "version", (k * 10 + s).alias("id"), ((9000 + 300 * s + k % 40) * DAY).alias("valid_from"),
        F.when(s < 2, (9300 + 300 * s + k % 40 + F.when(k % 13 == 0, 50).otherwise(0)) * DAY).alias("valid_to"),
        ((9000 + 300 * s + k % 60) * DAY).alias("known_from"), F.when(k % 4 == 0, F.lit(10200 * DAY)).alias("known_to"),
    )


ELIGIBLE = "valid_from <= t AND known_from <= k AND known_from <= t AND (valid_to IS NULL OR t < valid_to) AND (known_to IS NULL OR k < known_to)"
ASKS = f"""a AS (SELECT p_partkey AS part, CAST(t AS BIGINT) AS t, CAST(t AS BIGINT) + (p_partkey % 3) * {30 * DAY} AS k FROM part, generate_series({9000 * DAY}, {10400 * DAY}, {90 * DAY}) AS s(t))"""


def asks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_asks(spark, sf_dir).withColumn("k", F.col("t") + (F.col("part") % 3) * (30 * DAY))


@query(f"WITH {VERSIONS}, {ASKS} SELECT part, t, k, version, id FROM a JOIN v USING (part) WHERE {ELIGIBLE}")
def j3_bitemporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.reference_at(asks(spark, sf_dir), versions(spark, sf_dir), "part").select("part", "t", "k", "version", "id")


@query(f"WITH {VERSIONS}, {ASKS} SELECT part, t, k, version, id FROM a JOIN v USING (part) WHERE {ELIGIBLE} QUALIFY row_number() OVER (PARTITION BY part, t, k ORDER BY version DESC, valid_from DESC, known_from DESC, id DESC) = 1")
def j4_bitemporal_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.reference_latest(asks(spark, sf_dir), versions(spark, sf_dir), "part", ["version", "valid_from", "known_from", "id"]).select("part", "t", "k", "version", "id")


@query(f"""WITH {VERSIONS}, w AS (SELECT part, id, valid_from, known_from, coalesce(valid_to, 4611686018427387904) AS valid_to, coalesce(known_to, 4611686018427387904) AS known_to FROM v)
SELECT x.part, x.id AS a, y.id AS b FROM w x JOIN w y ON x.part = y.part AND x.id < y.id AND x.valid_from < y.valid_to AND y.valid_from < x.valid_to AND x.known_from < y.known_to AND y.known_from < x.known_to""")
def j16_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.conflicts(versions(spark, sf_dir), "part", "id")


ALIASES = f"""al AS (SELECT s_suppkey AS alias_id, 'alias ' || CAST(s_suppkey % 40 AS VARCHAR) AS norm, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'venue' || CAST(s_suppkey % 2 AS VARCHAR) END AS venue_id, s_suppkey % 45 AS target_id,
 (s_suppkey % 7) / 10.0 AS confidence, CAST({9000 * DAY} AS BIGINT) AS valid_from, CASE WHEN s_suppkey % 5 = 0 THEN CAST({9500 * DAY} AS BIGINT) END AS valid_to, (9000 + s_suppkey % 100) * {DAY} AS known_from, CAST(NULL AS BIGINT) AS known_to FROM supplier)"""
ALIAS_ASKS = f"""q AS (SELECT n * 10 + v AS ask_id, 'alias ' || CAST(n AS VARCHAR) AS norm, 'venue' || CAST(v AS VARCHAR) AS venue_id, CAST({9090 * DAY} + n * {15 * DAY} AS BIGINT) AS t, CAST({9090 * DAY} + n * {15 * DAY} AS BIGINT) AS k FROM (SELECT DISTINCT s_suppkey % 50 AS n FROM supplier), generate_series(0, 1) AS vs(v))"""


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return I.table(spark, sf_dir, "supplier").select(
        s.alias("alias_id"), F.concat(F.lit("alias "), (s % 40).cast("string")).alias("norm"), F.when(s % 3 != 0, F.concat(F.lit("venue"), (s % 2).cast("string"))).alias("venue_id"), (s % 45).alias("target_id"),
        ((s % 7) / 10.0).alias("confidence"), F.lit(9000 * DAY).alias("valid_from"), F.when(s % 5 == 0, F.lit(9500 * DAY)).alias("valid_to"), ((9000 + s % 100) * DAY).alias("known_from"), F.lit(None).cast("long").alias("known_to"),
    )


@query(f"""WITH {ALIASES}, {ALIAS_ASKS}, m AS (SELECT ask_id, target_id, al.venue_id IS NULL AS every, confidence, alias_id FROM q JOIN al USING (norm) WHERE {ELIGIBLE} AND (al.venue_id IS NULL OR al.venue_id = q.venue_id)),
 g AS (SELECT ask_id, count(DISTINCT target_id) AS targets, first(target_id ORDER BY every, confidence DESC, alias_id) AS best FROM m GROUP BY 1)
SELECT q.ask_id, CASE WHEN coalesce(targets, 0) = 0 THEN 'UNRESOLVED' WHEN targets = 1 THEN 'RESOLVED' ELSE 'AMBIGUOUS' END AS state, CASE WHEN targets = 1 THEN best END AS target_id, coalesce(targets, 0) AS targets FROM q LEFT JOIN g USING (ask_id)""")
def j6_resolve_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = I.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 50).alias("n")).distinct().withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    t = F.lit(9090 * DAY) + F.col("n") * (15 * DAY)
    q = n.select((F.col("n") * 10 + F.col("v")).alias("ask_id"), F.concat(F.lit("alias "), F.col("n").cast("string")).alias("norm"), F.concat(F.lit("venue"), F.col("v").cast("string")).alias("venue_id"), t.alias("t"), t.alias("k"))
    return asof.resolve_alias(q, aliases(spark, sf_dir))


@query(f"""WITH {ALIASES} SELECT x.norm, x.alias_id AS a, y.alias_id AS b FROM al x JOIN al y ON x.norm = y.norm AND x.venue_id IS NOT DISTINCT FROM y.venue_id AND x.alias_id < y.alias_id AND x.target_id <> y.target_id
 WHERE (y.valid_to IS NULL OR x.valid_from < y.valid_to) AND (x.valid_to IS NULL OR y.valid_from < x.valid_to)""")
def j17_alias_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.alias_collisions(aliases(spark, sf_dir))


WF = 5
WINDOWS = f"""{I.bars_sql()}, w AS (SELECT instrument_id, period_start, availability, close / lag(close, {WF}) OVER o - 1 AS momentum, count(*) OVER f AS n, stddev_pop(close) OVER f AS s, avg(close) OVER f AS m, avg(base_volume) OVER f AS v, close, base_volume
 FROM b WINDOW o AS (PARTITION BY instrument_id ORDER BY period_start), f AS (PARTITION BY instrument_id ORDER BY period_start ROWS BETWEEN {WF - 1} PRECEDING AND CURRENT ROW))"""


@query(f"""WITH {WINDOWS} SELECT instrument_id, period_start, availability, round(momentum, {R}) AS momentum, round(CASE WHEN n = {WF} AND s > 0 THEN -(close - m) / s END, {R}) AS mean_reversion, round(CASE WHEN n = {WF} AND v > 0 THEN base_volume / v END, {R}) AS volume_ratio FROM w""")
def w2_window_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(factors.window_factors(I.bars(spark, sf_dir), WF), "momentum", "mean_reversion", "volume_ratio")


def price_sql(name: str, back: int, value: str) -> str:
    return f"{name} AS (SELECT d.instrument_id, d.t, max(ROW(period_start, availability, close))[3] AS {value} FROM d JOIN b ON b.instrument_id = d.instrument_id AND b.availability <= d.t - {back} GROUP BY ALL)"


LOOK, SKIP = 7 * DAY, DAY
MOMENTUM = f"""{I.bars_sql()}, {I.decisions_sql()}, {price_sql("pa", SKIP, "p1")}, {price_sql("pb", LOOK, "p0")},
 mo AS (SELECT instrument_id, t, ln(p1 / p0) AS raw_value FROM pa JOIN pb USING (instrument_id, t))"""


def momentum(spark: SparkSession, sf_dir: str, days: int = 1) -> DataFrame:
    return factors.momentum(I.decisions(spark, sf_dir, days=days), I.bars(spark, sf_dir), LOOK, SKIP)


@query(f"WITH {MOMENTUM} SELECT instrument_id, t, round(raw_value, {R}) AS raw_value FROM mo")
def v1_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(momentum(spark, sf_dir), "raw_value")


@query(f"""WITH {MOMENTUM}, s AS (SELECT instrument_id, t, round(raw_value, 3) AS score FROM mo)
SELECT instrument_id, t, score, rank() OVER (PARTITION BY t ORDER BY score DESC) + (count(*) OVER (PARTITION BY t, score) - 1) / 2.0 AS place FROM s""")
def w3_average_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = momentum(spark, sf_dir).select("instrument_id", "t", F.round("raw_value", 3).alias("score"))
    return s.withColumn("place", factors.average_rank(F.col("score"), "t"))


@query(f"""WITH {WINDOWS}, l AS (SELECT 'momentum' AS factor_id, period_start, instrument_id, momentum AS score FROM w WHERE momentum IS NOT NULL UNION ALL SELECT 'reversion', period_start, instrument_id, -(close - m) / s FROM w WHERE n = {WF} AND s > 0),
 r AS (SELECT *, rank() OVER (PARTITION BY factor_id, period_start ORDER BY score DESC) + (count(*) OVER (PARTITION BY factor_id, period_start, score) - 1) / 2.0 AS place FROM l)
SELECT period_start, instrument_id, round(avg(place), {R}) AS mean_rank, count(*) AS factors, round(-avg(place), {R}) AS score FROM r GROUP BY ALL""")
def a18_rank_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = factors.window_factors(I.bars(spark, sf_dir), WF)
    part = lambda name, c: w.where(F.col(c).isNotNull()).select(F.lit(name).alias("factor_id"), "period_start", "instrument_id", F.col(c).alias("score"))
    values = part("momentum", "momentum").unionByName(part("reversion", "mean_reversion"))
    return rounded(factors.rank_composite(values, ["period_start"], ["instrument_id"]), "mean_rank", "score")


GAP, AHEAD = 0, 3 * DAY
LABELS = f"""{I.bars_sql()}, {I.decisions_sql()}, {price_sql("en", 0, "entry_price")}, {price_sql("ex", -(GAP + AHEAD), "exit_price")},
 lb AS (SELECT instrument_id, t, t + {GAP} AS event_start, t + {GAP + AHEAD} AS event_end, entry_price, exit_price, exit_price / entry_price - 1 AS r FROM en JOIN ex USING (instrument_id, t))"""


@query(f"""WITH {LABELS} SELECT instrument_id, t, event_start, event_end, round(entry_price, {R}) AS entry_price, round(exit_price, {R}) AS exit_price, round(r, {R}) AS label_return, CAST(sign(r) AS INTEGER) AS label_sign, CAST(r > 0 AS INTEGER) AS label_binary FROM lb""")
def v3_forward_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labels.forward_labels(I.decisions(spark, sf_dir), I.bars(spark, sf_dir), GAP, AHEAD)
    return rounded(found, "entry_price", "exit_price", "label_return")


# events for splits: one per instrument and day, over three days
EVENTS = f"""{I.TRADES}, {I.decisions_sql(0, 29)}, ev AS (SELECT instrument_id, CAST(instrument_id AS VARCHAR) || '@' || CAST(t AS VARCHAR) AS event_id, t, t AS event_start, t + (1 + instrument_id % 3) * {DAY} AS event_end FROM d)"""
PURGE = """kept AS (SELECT p.* FROM pool p LEFT JOIN edges e USING (fold_id) WHERE e.fold_id IS NULL OR (p.event_end <= e.edge AND p.t < e.edge AND NOT (p.event_start < e.last_end AND e.edge < p.event_end)
 AND NOT EXISTS (SELECT 1 FROM test x WHERE x.fold_id = p.fold_id AND x.instrument_id = p.instrument_id AND p.event_start < x.event_end AND x.event_start < p.event_end)))"""


def split_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = I.decisions(spark, sf_dir, 0, 29)
    name = F.concat_ws("@", F.col("instrument_id").cast("string"), F.col("t").cast("string"))
    return d.select("instrument_id", name.alias("event_id"), "t", F.col("t").alias("event_start"), (F.col("t") + (1 + F.col("instrument_id") % 3) * DAY).alias("event_end"))


TRAIN, TEST, EMBARGO = 10 * DAY, 5 * DAY, DAY


@query(f"""WITH {EVENTS}, span AS (SELECT min(t) AS t0, max(t) AS t1 FROM ev), fo AS (SELECT i AS fold_id, t0 + {TRAIN + EMBARGO} + i * {TEST} AS ts, t1 FROM span, generate_series(0, 20) AS s(i)),
 fw AS (SELECT fold_id, ts, ts - {EMBARGO} AS te FROM fo WHERE ts + {TEST} <= t1 + 1), test AS (SELECT fold_id, ev.* FROM ev JOIN fw ON t >= ts AND t < ts + {TEST}), pool AS (SELECT fold_id, ev.* FROM ev JOIN fw ON t >= te - {TRAIN} AND t < te),
 edges AS (SELECT fold_id, min(t) - {EMBARGO} AS edge, max(event_end) AS last_end FROM test GROUP BY 1), {PURGE}
SELECT CAST(fold_id AS INTEGER) AS fold_id, 'train' AS role, event_id FROM kept UNION ALL SELECT CAST(fold_id AS INTEGER), 'test', event_id FROM test""")
def v4_walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.walk_forward(split_events(spark, sf_dir), TRAIN, TEST, EMBARGO).select("fold_id", "role", "event_id")


@query(f"""WITH {EVENTS}, pl AS (SELECT *, row_number() OVER (ORDER BY t, event_end, instrument_id, event_id) - 1 AS rn, count(*) OVER () AS n FROM ev), test AS (SELECT CAST(least(4, rn // (n // 5)) AS INTEGER) AS fold_id, * FROM pl),
 edges AS (SELECT fold_id, min(t) - {EMBARGO} AS edge, max(event_end) AS last_end FROM test GROUP BY 1), pool AS (SELECT e.fold_id, ev.* FROM ev JOIN edges e ON ev.t < e.edge), {PURGE}
SELECT fold_id, 'train' AS role, event_id FROM kept UNION ALL SELECT fold_id, 'test', event_id FROM test""")
def v5_purged_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.purged_kfold(split_events(spark, sf_dir), 5, EMBARGO).select("fold_id", "role", "event_id")


SCORES = f"""{MOMENTUM}, sc AS (SELECT t, instrument_id, raw_value AS score FROM mo)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return momentum(spark, sf_dir).select("t", "instrument_id", F.col("raw_value").alias("score"))


@query(f"""WITH {SCORES}, r AS (SELECT *, count(*) OVER (PARTITION BY t) AS n, (row_number() OVER (PARTITION BY t ORDER BY score, instrument_id) - 1) / nullif(count(*) OVER (PARTITION BY t) - 1, 0) - 0.5 AS raw FROM sc)
SELECT t, instrument_id, round(CASE WHEN n = 1 THEN 1.0 ELSE raw / sum(abs(raw)) OVER (PARTITION BY t) END, {R}) AS weight FROM r""")
def w4_rank_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.rank_weights(scores(spark, sf_dir)), "weight")


WEIGHTS = f"""{SCORES}, sw AS (SELECT t, instrument_id, CASE WHEN score > 0 THEN 0.5 / sum(CAST(score > 0 AS INTEGER)) OVER (PARTITION BY t) WHEN score < 0 THEN -0.5 / sum(CAST(score < 0 AS INTEGER)) OVER (PARTITION BY t) END AS weight FROM sc)"""


@query(f"WITH {WEIGHTS} SELECT t, instrument_id, round(weight, {R}) AS weight FROM sw WHERE weight IS NOT NULL")
def w5_sign_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.sign_weights(scores(spark, sf_dir)), "weight")


LIMITED = f"""{WEIGHTS}, cl AS (SELECT t, instrument_id, greatest(-0.02, least(0.02, 3 * weight)) AS w FROM sw WHERE weight IS NOT NULL),
 lg AS (SELECT *, sum(greatest(w, 0)) OVER (PARTITION BY t) AS lo, sum(greatest(-w, 0)) OVER (PARTITION BY t) AS sh FROM cl),
 rl AS (SELECT t, instrument_id, CASE WHEN lo > 1e-12 AND sh > 1e-12 THEN w * least(1, least(lo, sh, 0.4) / CASE WHEN w > 0 THEN lo ELSE sh END) ELSE w * least(1, 0.8 / (lo + sh)) END AS weight FROM lg)"""


@query(f"WITH {LIMITED} SELECT t, instrument_id, round(weight, {R}) AS weight FROM rl")
def f18_risk_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = portfolio.sign_weights(scores(spark, sf_dir)).withColumn("weight", 3 * F.col("weight"))
    return rounded(portfolio.limit_risk(w, 0.8, 0.02), "weight")


@query(f"WITH {LIMITED}, p AS (SELECT t, max(abs(weight)) AS w, sum(abs(weight)) AS g, abs(sum(weight)) AS n FROM rl GROUP BY 1) SELECT round(max(w), {R}) AS max_weight, round(max(g), {R}) AS max_gross, round(max(n), {R}) AS max_net FROM p")
def a22_risk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = portfolio.sign_weights(scores(spark, sf_dir)).withColumn("weight", 3 * F.col("weight"))
    return rounded(portfolio.risk_summary(portfolio.limit_risk(w, 0.8, 0.02)), "max_weight", "max_gross", "max_net")


COST = 0.001
# a strategy for each instrument's remainder by 5; returns are the bars' own
BOOK = f"""{I.bars_sql()}, ta AS (SELECT instrument_id % 5 AS strategy_id, period_start AS period, instrument_id, ((instrument_id * 7 + period_start // {DAY}) % 11 - 5) / 1000.0 AS weight FROM b),
 re AS (SELECT period_start AS period, instrument_id, close / open - 1 AS ret FROM b WHERE instrument_id % 9 <> 4)"""


def book(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b = I.bars(spark, sf_dir)
    day = F.floor(F.col("period_start") / DAY)
    weight = ((F.col("instrument_id") * 7 + day) % 11 - 5) / 1000.0
    targets = b.select((F.col("instrument_id") % 5).alias("strategy_id"), F.col("period_start").alias("period"), "instrument_id", weight.alias("weight"))
    return targets, b.where("instrument_id % 9 <> 4").select(F.col("period_start").alias("period"), "instrument_id", (F.col("close") / F.col("open") - 1).alias("ret"))


ACCOUNT = f"""{BOOK}, he AS (SELECT ta.*, coalesce(ret, 0) AS ret FROM ta LEFT JOIN re USING (period, instrument_id)), gr AS (SELECT strategy_id, period, sum(weight * ret) AS gross_return, lead(period) OVER (PARTITION BY strategy_id ORDER BY period) AS nx FROM he GROUP BY 1, 2),
 dr AS (SELECT strategy_id, nx AS period, instrument_id, weight * (1 + ret) / (1 + gross_return) AS before FROM he JOIN gr USING (strategy_id, period) WHERE nx IS NOT NULL AND 1 + gross_return > 0),
 tu AS (SELECT strategy_id, period, sum(abs(coalesce(weight, 0) - coalesce(before, 0))) AS turnover FROM ta FULL JOIN dr USING (strategy_id, period, instrument_id) GROUP BY 1, 2),
 ac AS (SELECT strategy_id, period, turnover, turnover * {COST} AS cost, gross_return, gross_return - turnover * {COST} AS net_return FROM tu JOIN gr USING (strategy_id, period))"""


@query(f"WITH {ACCOUNT} SELECT strategy_id, period, round(turnover, {R}) AS turnover, round(cost, {R}) AS cost, round(gross_return, {R}) AS gross_return, round(net_return, {R}) AS net_return FROM ac")
def a19_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.account(*book(spark, sf_dir), COST), "turnover", "cost", "gross_return", "net_return")


@query(f"""WITH {ACCOUNT} SELECT strategy_id, count(*) AS periods, round(CASE WHEN count(*) FILTER (WHERE net_return <= -1) > 0 THEN -1.0 ELSE exp(sum(CASE WHEN net_return > -1 THEN ln(1 + net_return) END)) - 1 END, {R}) AS total_return,
 round(avg(turnover), {R}) AS mean_turnover, round(sum(cost), {R}) AS total_cost, count(*) FILTER (WHERE net_return <= -1) AS wipeouts FROM ac GROUP BY 1""")
def a21_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.summary(portfolio.account(*book(spark, sf_dir), COST)), "total_return", "mean_turnover", "total_cost")


def perpetual_sql(cost: float, maintenance: float) -> str:
    """pn: perpetual accounting of ta (targets) and mv (moves), a period at a time; for WITH RECURSIVE."""
    return f"""pe AS (SELECT strategy_id, period, row_number() OVER (PARTITION BY strategy_id ORDER BY period) AS k FROM (SELECT DISTINCT strategy_id, period FROM ta)),
 hd AS (SELECT ta.strategy_id, k, instrument_id, weight AS w, coalesce(ret, 0) AS r, coalesce(funding_rate, 0) AS f FROM ta JOIN pe USING (strategy_id, period) LEFT JOIN mv USING (period, instrument_id)),
 pr AS (SELECT coalesce(x.strategy_id, y.strategy_id) AS s, coalesce(x.k, y.k + 1) AS k, coalesce(x.w, 0) AS w, coalesce(x.r, 0) AS r, coalesce(x.f, 0) AS f, coalesce(y.w * (1 + y.r), 0) AS d
  FROM hd x FULL JOIN hd y ON x.strategy_id = y.strategy_id AND x.k = y.k + 1 AND x.instrument_id = y.instrument_id),
 fo AS (SELECT strategy_id AS s, CAST(0 AS BIGINT) AS k, CAST(0 AS DOUBLE) AS turnover, CAST(0 AS DOUBLE) AS raw FROM pe WHERE k = 1
  UNION ALL SELECT s, k, turnover, price - turnover * {cost} FROM (
   SELECT pr.s, pr.k, sum(abs(pr.w - CASE WHEN fo.k = 0 OR -fo.raw >= 1 - {maintenance} THEN 0 ELSE pr.d / (1 + fo.raw) END)) AS turnover, sum(pr.w * pr.r) - sum(pr.w * pr.f) AS price
   FROM fo JOIN pr ON pr.s = fo.s AND pr.k = fo.k + 1 GROUP BY pr.s, pr.k)),
 pn AS (SELECT strategy_id, period, fo.turnover, fo.turnover * {cost} AS cost, g.price AS price_return, -g.fund AS funding, CASE WHEN -raw >= 1 - {maintenance} THEN -1.0 ELSE raw END AS net_return,
  g.lo AS long_return, g.sh AS short_return, -raw >= 1 - {maintenance} AS liquidated
  FROM fo JOIN pe ON pe.strategy_id = fo.s AND pe.k = fo.k JOIN (SELECT strategy_id AS s, k, sum(w * r) AS price, sum(w * f) AS fund, coalesce(sum(w * r) FILTER (WHERE w > 0), 0) AS lo,
   coalesce(sum(w * r) FILTER (WHERE w < 0), 0) AS sh FROM hd GROUP BY 1, 2) g ON g.s = fo.s AND g.k = fo.k)"""


PERPETUAL = ("turnover", "cost", "price_return", "funding", "net_return", "long_return", "short_return")


@query(f"""WITH RECURSIVE {BOOK}, mv AS (SELECT period, instrument_id, ret, (instrument_id % 7 - 3) / 10000.0 AS funding_rate FROM re), {perpetual_sql(COST, 0.05)}
SELECT strategy_id, period, {", ".join(f"round({c}, {R}) AS {c}" for c in PERPETUAL)}, liquidated FROM pn""")
def a20_perpetual_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets, moves = book(spark, sf_dir)
    moves = moves.withColumn("funding_rate", (F.col("instrument_id") % 7 - 3) / 10000.0)
    return rounded(portfolio.perpetual_account(targets, moves, COST, 0.05), *PERPETUAL)


@query(f"""WITH {I.TRADES}, po AS (SELECT event_id AS position_id, user_id AS symbol, epoch_us(ts) AS s, epoch_us(ts) + {2 * DAY} AS e, (event_id % 7 - 3) / 2.0 AS q, value AS m FROM events),
 fu AS (SELECT user_id AS symbol, epoch_us(ts) AS a, (value - 100) / 1e5 AS rate, CASE WHEN event_id % 3 = 0 THEN value END AS price FROM events WHERE event_type = 'purchase'),
 su AS (SELECT position_id, count(*) AS n, sum(-q * rate * coalesce(price, m)) AS c FROM po JOIN fu ON fu.symbol = po.symbol AND a >= s AND a <= e GROUP BY 1)
SELECT position_id, coalesce(n, 0) AS events, round(coalesce(c, 0), {R}) AS cashflow FROM po LEFT JOIN su USING (position_id)""")
def j18_funding_cashflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.table(spark, sf_dir, "events").withColumn("at", I.us("ts"))
    po = e.selectExpr("event_id AS position_id", "user_id AS symbol", "at AS start", f"at + {2 * DAY} AS end", "(event_id % 7 - 3) / 2.0D AS quantity", "value AS mark_price")
    fu = e.where("event_type = 'purchase'").selectExpr("user_id AS symbol", "at", "(value - 100) / 1e5D AS rate", "CASE WHEN event_id % 3 = 0 THEN value END AS price")
    return rounded(portfolio.funding_cashflow(po, fu, width=2 * DAY), "cashflow")


@query(f"""WITH s AS (SELECT user_id AS session, event_id AS t, 900 + value AS equity FROM events), o AS (SELECT *, coalesce(lag(equity) OVER (PARTITION BY session ORDER BY t), 1000.0) AS b, greatest(1000.0, max(equity) OVER (PARTITION BY session ORDER BY t)) AS peak FROM s)
SELECT session, t, equity, round(equity / b - 1, {R}) AS ret, peak, round(1 - equity / peak, {R}) AS drawdown, 1 - equity / peak >= 0.12 AS alert FROM o""")
def w17_equity_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), F.col("event_id").alias("t"), (900 + F.col("value")).alias("equity"))
    return rounded(portfolio.equity_path(p, 1000.0, 0.12), "ret", "drawdown")


B_, BLOCK, SEED = 10_000, 3, 7
DRAW = lambda *x: "CAST('0x' || substr(md5(" + " || '|' || ".join([f"'{SEED}'", *(f"CAST({c} AS VARCHAR)" for c in x)]) + "), 1, 8) AS BIGINT)"
NET = f"{ACCOUNT}, ne AS (SELECT strategy_id, row_number() OVER (PARTITION BY strategy_id ORDER BY period) - 1 AS i, net_return AS x, count(*) OVER (PARTITION BY strategy_id) AS n FROM ac)"


def net_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.account(*book(spark, sf_dir), COST).select("strategy_id", "period", "net_return").checkpoint()


@query(f"""WITH {NET}, me AS (SELECT strategy_id, n, avg(x) AS m FROM ne GROUP BY 1, 2), st AS (SELECT strategy_id, n, m, b, CAST(s AS BIGINT) AS s FROM me, generate_series(0, {B_ - 1}) AS bs(b), LATERAL (SELECT unnest(generate_series(0, n - 1)) AS s)),
 ww AS (SELECT *, max(CASE WHEN s = 0 OR {DRAW("'new'", "b", "s")} % {BLOCK} = 0 THEN s END) OVER (PARTITION BY strategy_id, b ORDER BY s) AS g FROM st), ix AS (SELECT *, ({DRAW("'at'", "b", "g")} % n + s - g) % n AS i FROM ww),
 mm AS (SELECT ix.strategy_id, ix.n, m, b, avg(x - m) AS bm FROM ix JOIN ne ON ne.strategy_id = ix.strategy_id AND ne.i = ix.i GROUP BY ALL)
SELECT strategy_id, n, round(m, {R}) AS observed_mean, count(*) FILTER (WHERE bm >= m - 1e-12) AS exceedances, round((count(*) FILTER (WHERE bm >= m - 1e-12) + 1) / ({B_} + 1.0), {R}) AS p_value FROM mm GROUP BY strategy_id, n, m""")
def v6_stationary_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.stationary_p_values(net_returns(spark, sf_dir), ["strategy_id"], "period", "net_return", B_, BLOCK, SEED)
    return rounded(found, "observed_mean", "p_value")


TOTALS = f"""{NET.replace("FROM ac)", "FROM ac WHERE net_return > -1)")}, lo AS (SELECT strategy_id, i, n, ln(1 + x) AS x, avg(ln(1 + x)) OVER (PARTITION BY strategy_id) AS m FROM ne), sz AS (SELECT DISTINCT strategy_id, n FROM lo),
 bl AS (SELECT strategy_id, n, b, CAST(j AS BIGINT) AS j FROM sz, generate_series(0, {B_ - 1}) AS bs(b), LATERAL (SELECT unnest(generate_series(0, (n + {BLOCK - 1}) // {BLOCK} - 1)) AS j)),
 pk AS (SELECT strategy_id, b, {DRAW("b", "j")} % (n - {BLOCK - 1}) + k AS i FROM bl, generate_series(0, {BLOCK - 1}) AS ks(k) WHERE j * {BLOCK} + k < n),
 tt AS (SELECT pk.strategy_id, b, exp(sum(x - m)) - 1 AS total FROM pk JOIN lo ON lo.strategy_id = pk.strategy_id AND lo.i = pk.i GROUP BY 1, 2), ob AS (SELECT strategy_id, exp(sum(x)) - 1 AS observed FROM lo GROUP BY 1)"""


@query(f"""WITH {TOTALS} SELECT strategy_id, round(observed, {R}) AS observed, round(greatest(avg(CAST(total >= observed - 1e-12 AS DOUBLE)), 1.0 / ({B_} + 1)), {R}) AS p_value FROM tt JOIN ob USING (strategy_id) GROUP BY strategy_id, observed""")
def v7_block_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.block_p_values(net_returns(spark, sf_dir), ["strategy_id"], "period", "net_return", B_, BLOCK, SEED), "observed", "p_value")


@query(f"""WITH {TOTALS}, p AS (SELECT strategy_id AS strategy, greatest(avg(CAST(total >= observed - 1e-12 AS DOUBLE)), 1.0 / ({B_} + 1)) AS p_value FROM tt JOIN ob USING (strategy_id) GROUP BY 1),
 r AS (SELECT *, count(*) OVER () AS m, row_number() OVER (ORDER BY p_value, strategy) AS k FROM p), q AS (SELECT *, min(least(p_value * m / k, 1.0)) OVER (ORDER BY k DESC) AS q_value FROM r)
SELECT strategy, round(p_value, {R}) AS p_value, round(least(p_value * m, 1.0), {R}) AS bonferroni, p_value <= 0.1 / m AS bonferroni_rejected, round(q_value, {R}) AS q_value, q_value <= 0.1 AS bh_rejected FROM q""")
def v9_multiple_testing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = stats.block_p_values(net_returns(spark, sf_dir), ["strategy_id"], "period", "net_return", B_, BLOCK, SEED)
    return rounded(stats.adjust(p.select(F.col("strategy_id").alias("strategy"), "p_value"), 0.1), "p_value", "bonferroni", "q_value")


@query(f"""WITH {TOTALS}, mo AS (SELECT b, max(total) AS most FROM tt GROUP BY 1), tp AS (SELECT last(strategy_id ORDER BY observed, strategy_id) AS best, max(observed) AS observed FROM ob)
SELECT best, round(observed, {R}) AS observed, round(greatest(avg(CAST(most >= observed - 1e-12 AS DOUBLE)), 1.0 / ({B_} + 1)), {R}) AS p_value FROM mo, tp GROUP BY best, observed""")
def v10_reality_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.reality_check(net_returns(spark, sf_dir), "strategy_id", "period", "net_return", B_, BLOCK, SEED), "observed", "p_value")


@query(f"""WITH {TOTALS}, be AS (SELECT exp(sum(x) / count(*) * max(n)) - 1 AS bench FROM lo), mo AS (SELECT b, max(total) AS most FROM tt GROUP BY 1), tp AS (SELECT last(strategy_id ORDER BY observed, strategy_id) AS best, max(observed) AS o FROM ob),
 al AS (SELECT best, o - bench AS observed, most - bench AS most FROM mo, tp, be) SELECT best, round(observed, {R}) AS observed, round(greatest(avg(CAST(most >= observed - 1e-12 AS DOUBLE)), 1.0 / ({B_} + 1)), {R}) AS p_value FROM al GROUP BY best, observed""")
def v11_max_excess_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.reality_check(net_returns(spark, sf_dir), "strategy_id", "period", "net_return", B_, BLOCK, SEED, excess=True), "observed", "p_value")


CONFIGS = [("m7", LOOK, SKIP), ("m14", 14 * DAY, SKIP)]
SCREEN = f"""{I.bars_sql()}, {I.decisions_sql()}, {price_sql("pa", SKIP, "p1")}, {price_sql("pb", LOOK, "p0")}, {price_sql("pc", 14 * DAY, "p0")}, {price_sql("en", 0, "e0")}, {price_sql("ex", -DAY, "e1")},
 mo AS (SELECT 'm7' AS strategy_id, instrument_id, t, ln(p1 / p0) AS score FROM pa JOIN pb USING (instrument_id, t) UNION ALL SELECT 'm14', instrument_id, t, ln(p1 / p0) FROM pa JOIN pc USING (instrument_id, t)),
 tw AS (SELECT strategy_id, t AS period, instrument_id, CASE WHEN score > 0 THEN 0.5 / sum(CAST(score > 0 AS INTEGER)) OVER (PARTITION BY strategy_id, t) WHEN score < 0 THEN -0.5 / sum(CAST(score < 0 AS INTEGER)) OVER (PARTITION BY strategy_id, t) END AS weight FROM mo),
 ta AS (SELECT * FROM tw WHERE weight IS NOT NULL), re AS (SELECT t AS period, instrument_id, e1 / e0 - 1 AS ret FROM en JOIN ex USING (instrument_id, t))"""


@query(f"""WITH {ACCOUNT.replace(BOOK, SCREEN)} SELECT strategy_id, count(*) AS periods, round(CASE WHEN count(*) FILTER (WHERE net_return <= -1) > 0 THEN -1.0 ELSE exp(sum(CASE WHEN net_return > -1 THEN ln(1 + net_return) END)) - 1 END, {R}) AS total_return,
 round(avg(turnover), {R}) AS mean_turnover, round(sum(cost), {R}) AS total_cost, count(*) FILTER (WHERE net_return <= -1) AS wipeouts FROM ac GROUP BY 1""")
def v15_momentum_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each configuration from factor to weights, labels and accounting, as one job."""
    b, d = I.bars(spark, sf_dir), I.decisions(spark, sf_dir)
    values = factors.momentum_grid(d, b, CONFIGS).withColumnRenamed("raw_value", "score")
    targets = portfolio.sign_weights(values, across=("config_id", "t")).select(F.col("config_id").alias("strategy_id"), F.col("t").alias("period"), "instrument_id", "weight")
    returns = labels.forward_labels(d, b, 0, DAY).select(F.col("t").alias("period"), "instrument_id", F.col("label_return").alias("ret"))
    return rounded(portfolio.summary(portfolio.account(targets, returns, COST)), "total_return", "mean_turnover", "total_cost")


def ridge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window factors of each bar, known when it ends, and the return to the bar after."""
    from pyspark.sql import Window

    b = I.bars(spark, sf_dir)
    order = Window.partitionBy("instrument_id").orderBy("period_start")
    ahead = b.select("instrument_id", "period_start", F.lead("availability").over(order).alias("label_end"), (F.lead("close").over(order) / F.col("close") - 1).alias("y"))
    f = factors.window_factors(b, WF).withColumnRenamed("availability", "t")
    return f.join(ahead, ["instrument_id", "period_start"]).select("instrument_id", "t", "label_end", "y", "momentum", "mean_reversion", "volume_ratio")


@query(f"""WITH d AS (SELECT DISTINCT user_id AS instrument_id, CAST(t AS BIGINT) AS t FROM events, generate_series(1, 50) AS s(t)), h AS (SELECT *, md5('11|' || instrument_id || '|' || t) AS m FROM d),
 u AS (SELECT *, (CAST('0x' || substr(m, 1, 8) AS BIGINT) + 1) / 4294967297.0 AS a, (CAST('0x' || substr(m, 9, 8) AS BIGINT) + 1) / 4294967297.0 AS b FROM h)
SELECT instrument_id, t, round(sqrt(-2 * ln(CAST(a AS DOUBLE))) * cos(2 * pi() * CAST(b AS DOUBLE)), {R}) AS score FROM u""")
def f15_noise_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(50).cast("long")))
    d = I.table(spark, sf_dir, "events").select(F.col("user_id").alias("instrument_id")).distinct().withColumn("t", times)
    return rounded(factors.noise(d, 11), "score")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks to daily bars, as-of momentum at weekly decisions, ranks and long/short weights."""
    values = momentum(spark, sf_dir, days=7).withColumn("score", F.col("raw_value"))
    ranked = values.withColumn("place", factors.average_rank(F.col("score"), "t"))
    return ranked.join(portfolio.sign_weights(values.select("t", "instrument_id", "score")), ["t", "instrument_id"], "left").select("t", "instrument_id", "raw_value", "place", "weight")


@query(f"""WITH {MOMENTUM.replace(I.decisions_sql(), I.decisions_sql(days=7))}, r AS (SELECT t, instrument_id, raw_value, rank() OVER (PARTITION BY t ORDER BY raw_value DESC) + (count(*) OVER (PARTITION BY t, raw_value) - 1) / 2.0 AS place,
 CASE WHEN raw_value > 0 THEN 0.5 / sum(CAST(raw_value > 0 AS INTEGER)) OVER (PARTITION BY t) WHEN raw_value < 0 THEN -0.5 / sum(CAST(raw_value < 0 AS INTEGER)) OVER (PARTITION BY t) END AS weight FROM mo)
SELECT t, instrument_id, round(raw_value, {R}) AS raw_value, place, round(weight, {R}) AS weight FROM r""")
def flagship_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(flagship(spark, sf_dir), "raw_value", "weight")
