"""Chat formatting after cumulative-snapshot collapse.

Loggers store a conversation anew after every turn, so most logged conversations are prefixes of
longer ones. Each turn gets a hash of all turns up to it; a conversation is a snapshot of a longer
one if its last hash is an inner hash of another. Anti-joins keep the maximal conversations, and
only those are rendered. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import cut, table

#: Hash words of 60 bits (15 hex digits of SHA-256) taken for the rolling prefix hash.
_WORDS = ((1, 15), (16, 15), (31, 15))


def _turn_hash(position: str) -> list[Column]:
    text = F.concat_ws(
        "|",
        F.col(position).cast("string"),
        *(F.when(F.col(c).isNull(), "null").otherwise(F.concat_ws(":", F.length(c).cast("string"), F.col(c))) for c in ("role", "text")),
    )
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, a, n), 16, 10).cast("long") for a, n in _WORDS]


def prefixes(turns: DataFrame) -> DataFrame:
    """turns with position (from 1) in its conversation and h, a hash of all turns up to it.

    turns: conv_id, turn, role, text. The order is turn (null first), then role and text; a turn
    repeated whole in its conversation counts once. Rows without conv_id belong to no conversation
    and are left out. The prefix hash is the XOR of hashes of (position, role, text), which a running
    window gives without gathering a conversation; null and empty role or text differ.
    """
    rows = turns.where("conv_id is not null").select("conv_id", "turn", "role", "text").distinct()
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rows.withColumn("position", F.row_number().over(order))
    hashed = placed.select("*", *(h.alias(f"h{i}") for i, h in enumerate(_turn_hash("position"))))
    running = Window.partitionBy("conv_id").orderBy("position")
    rolled = F.struct(*(F.bit_xor(f"h{i}").over(running).alias(f"h{i}") for i in range(len(_WORDS))))
    return hashed.withColumn("h", rolled).drop(*(f"h{i}" for i in range(len(_WORDS))))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that no longer one begins with.

    Equal conversations are copies: the smallest conv_id stands for them, n_copies counts them.
    A first turn or conversation that a third of the rows share meets as one row: prefixes and ends
    are aggregated by hash, partly before the shuffle, and only then joined.
    """
    return _maximal(cut(prefixes(turns).select("conv_id", "position", "h")))


def _maximal(placed: DataFrame) -> DataFrame:
    ends = placed.groupBy("conv_id").agg(F.max("position").alias("n_turns"), F.max_by("h", "position").alias("h"))
    ends = ends.groupBy("n_turns", "h").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    n = F.max("position").over(Window.partitionBy("conv_id"))
    inner = placed.withColumn("n_turns", n).where(F.col("position") < F.col("n_turns")).select(F.col("position").alias("n_turns"), "h").distinct()
    return ends.join(inner, ["n_turns", "h"], "left_anti").select("conv_id", "n_turns", "n_copies")


def render(turns: DataFrame, begin: str = "<|", end: str = "|>\n", close: str = "\n") -> DataFrame:
    """conv_id, n_turns, n_copies, text: maximal conversations in one chat text each.

    A turn is begin + role + end + text + close; a null role is 'unknown', a null text is empty.
    """
    placed = prefixes(turns)
    kept = _maximal(cut(placed.select("conv_id", "position", "h")))
    said = F.concat(F.lit(begin), F.coalesce("role", F.lit("unknown")), F.lit(end), F.coalesce("text", F.lit("")), F.lit(close))
    lines = placed.select("conv_id", F.struct("position", said.alias("said")).alias("line")).join(kept, "conv_id")
    whole = lines.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return whole.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("lines", lambda x: x["said"]), "").alias("text"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(table(spark, sf_dir, "conversations"))


OP4_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position,
         coalesce(role, 'unknown') AS said_by, coalesce(text, '') AS said,
         md5(coalesce('r' || role, 'n') || '|' || coalesce('t' || text, 'n')) AS h
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
), p AS (
  SELECT conv_id, position, string_agg(h, ',' ORDER BY position) OVER (PARTITION BY conv_id ORDER BY position) AS upto FROM t
), e AS (
  SELECT conv_id, max(position) AS n_turns, arg_max(upto, position) AS upto FROM p GROUP BY conv_id
), u AS (
  SELECT upto, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM e GROUP BY upto, n_turns
), k AS (
  SELECT * FROM u WHERE upto NOT IN (SELECT p.upto FROM p JOIN e USING (conv_id) WHERE p.position < e.n_turns)
)
SELECT k.conv_id, k.n_turns, k.n_copies,
       string_agg('<|' || t.said_by || '|>' || chr(10) || t.said || chr(10), '' ORDER BY t.position) AS text
FROM k JOIN t ON t.conv_id = k.conv_id GROUP BY k.conv_id, k.n_turns, k.n_copies
"""
