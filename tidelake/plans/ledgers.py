"""Queries over ledger logs and their 256-bit numbers. Orders stand for blocks, each with one log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions import wide
from tidelake.plans import inputs as I
from tidelake.sources import market as S

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


def quantity(x: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(x.cast("long"))))


def word(high: Column, low: Column) -> Column:
    """64 digits of high * 2 ** 100 + low."""
    return F.concat(F.lpad(F.lower(F.hex(high.cast("long"))), 39, "0"), F.lpad(F.lower(F.hex(low.cast("long"))), 25, "0"))


def word_sql(high: str, low: str) -> str:
    return f"lpad(lower(to_hex(CAST({high} AS BIGINT))), 39, '0') || lpad(lower(to_hex(CAST({low} AS BIGINT))), 25, '0')"


def _logs(spark: SparkSession, sf_dir: str, topics: Column, data: Column) -> tuple[DataFrame, DataFrame]:
    """Logs and headers: one in five comes from elsewhere, one in seven has another hash, and so on."""
    o, k = I.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    none = F.lit(0)
    hash_ = F.concat(F.lit("0x"), word(none, k))
    logs = o.select(
        F.when(k % 5 == 0, "0xbad").otherwise("0xPair").alias("address"), topics.alias("topics"), data.alias("data"), quantity(k).alias("block_number"),
        F.when(k % 7 == 0, "0xother").otherwise(hash_).alias("block_hash"), quantity(F.col("o_custkey") % 50).alias("log_index"),
        F.concat(F.lit("tx"), F.when(k % 17 == 0, F.lit("s")).otherwise(k.cast("string"))).alias("tx_hash"), (k % 11 == 0).alias("removed"),
    )
    return logs, o.where("o_orderkey % 13 <> 0").select(quantity(k).alias("number"), hash_.alias("hash"), quantity(k).alias("timestamp"))


# why a log is refused, in order; logs of one transaction and index are duplicates
CODES = """CASE WHEN k % 5 = 0 THEN 'wrong_emitter' WHEN k % 11 = 0 THEN 'removed_log' {topics} WHEN k % 13 = 0 THEN 'missing_header' WHEN k % 7 = 0 THEN 'hash_mismatch' {data}
 WHEN k % 17 = 0 AND count(*) OVER (PARTITION BY k % 17 = 0, CASE WHEN k % 17 <> 0 THEN k END, c % 50) > 1 THEN 'duplicate_log' {more} END AS code"""
KEYS = "o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)"


def swaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k, c, none = F.col("o_orderkey"), F.col("o_custkey"), F.lit(0)
    address = lambda x: F.concat(F.lit("0x"), word(none, x))
    dirty = F.when(k % 19 == 0, F.concat(F.lit("0x1"), F.substring(word(none, c), 2, 63))).otherwise(address(c))
    topics = F.when(k % 23 == 0, F.array(F.lit("0xT1"))).otherwise(F.array(F.lit("0xT1"), dirty, address(c + 1)))
    whole = F.concat(F.lit("0x"), word(k, c), word(k * 2**30, c), word(none, k), word(none, none))
    return S.swap_logs(*_logs(spark, sf_dir, topics, F.when(k % 29 == 0, F.concat(whole, F.lit("00"))).otherwise(whole)), "0xpAIR", "0xt1")


SWAP_CODES = CODES.format(topics="WHEN k % 23 = 0 THEN 'bad_topics'", data="WHEN k % 29 = 0 THEN 'bad_data'", more="WHEN k % 19 = 0 THEN 'bad_address'")


@query(f"""WITH {KEYS}, m AS (SELECT *, {SWAP_CODES} FROM o)
SELECT k AS block, k * 1000000 AS ts_us, c % 50 AS log_index, CASE WHEN k % 17 = 0 THEN 'txs' ELSE 'tx' || CAST(k AS VARCHAR) END AS tx_hash,
 '0x' || lpad(lower(to_hex(c)), 40, '0') AS sender, '0x' || lpad(lower(to_hex(c + 1)), 40, '0') AS recipient,
 CAST(CAST(k AS UHUGEINT) * 1267650600228229401496703205376 + CAST(c AS UHUGEINT) AS VARCHAR) AS amount0_in, '0x' || {word_sql("k * 1073741824", "c")} AS amount1_in,
 CAST(k AS VARCHAR) AS amount0_out, '0' AS amount1_out FROM m WHERE code IS NULL""")
def s12_swap_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = {c: wide.decimal_text(F.col(c)) for c in ("amount0_in", "amount0_out", "amount1_out")} | {"amount1_in": wide.hexed(F.col("amount1_in"))}
    return swaps(spark, sf_dir)[0].withColumns(text)


@query(f"WITH {KEYS}, m AS (SELECT *, {SWAP_CODES} FROM o) SELECT k AS block, '0x' || lower(to_hex(c % 50)) AS log_index, code FROM m WHERE code IS NOT NULL")
def s12_swap_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a block has no header its number is that of the log."""
    return swaps(spark, sf_dir)[1]


SYNC_CODES = CODES.format(topics="", data="", more="WHEN k % 31 = 0 THEN 'reserve_range'")


@query(f"""WITH {KEYS}, m AS (SELECT *, {SYNC_CODES} FROM o)
SELECT k AS block, c % 50 AS log_index, code,
 CASE WHEN code IS NULL THEN CAST(CAST(c % 4096 AS UHUGEINT) * 1267650600228229401496703205376 + CAST(k AS UHUGEINT) AS VARCHAR) END AS reserve0,
 CASE WHEN code IS NULL THEN CAST(k AS VARCHAR) END AS reserve1 FROM m""")
def s12_sync_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded logs, and violations with their code; reserves over 2 ** 112 are such."""
    k, c, none = F.col("o_orderkey"), F.col("o_custkey"), F.lit(None).cast("string")
    data = F.concat(F.lit("0x"), word(F.when(k % 31 == 0, F.lit(4096)).otherwise(c % 4096), k), word(F.lit(0), k))
    good, bad = S.sync_logs(*_logs(spark, sf_dir, F.array(F.lit("0xT2")), data), "0xpair", "0xT2")
    text = lambda x: wide.decimal_text(F.col(x)).alias(x)
    index = F.conv(F.substring("log_index", 3, 16), 16, 10).cast("long").alias("log_index")
    good = good.select("block", "log_index", none.alias("code"), text("reserve0"), text("reserve1"))
    return good.unionByName(bad.select("block", index, "code", none.alias("reserve0"), none.alias("reserve1")))
