"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents fall, by a hash that permutes them, into blocks of about BLOCK_WORDS words. A
source whose target is f + r times its size gives all its blocks f times and, once more, its first
blocks up to the rest r; the block on the edge is cut between documents and its last document between
words, so the words taken are the rounded target. These block quotas are split among output shards:
each node of a binary tree over the shards hands its left half a multivariate-hypergeometric draw of
what it holds, so each shard gets the same number of blocks and an exact, random composition. Shards
then take disjoint runs of each source's permuted blocks and shuffle their documents locally. A
document is in the mix as often as a block of it was drawn for a shard, and not otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from tidelake.llm.common import cut, lots, table, unused, word_counts

#: Words of a block, about. A source has a power of two of blocks, LEAST_BLOCKS at least: a
#: permutation of blocks is then b -> (odd * b + c) mod blocks.
BLOCK_WORDS = 1_000_000
LEAST_BLOCKS = 256
MOST = 3
WEIGHTS = (1, 2, 3)
#: Sources share this many lists of blocks (by hash) in the tree, which bounds what a node holds.
LISTS = 4096
#: Plans of at most so many rows, with names of at most so many characters, are broadcast.
BROADCAST_ROWS, BROADCAST_NAME = 100_000, 256
SHARD_WORDS = 20_000_000


def _words(texts: pa.Array) -> pa.Array:
    counts = [word_counts(texts.slice(a, b - a)) for a, b in lots(texts)]
    return pa.array(np.concatenate(counts) if counts else [], pa.int64())


words = F.arrow_udf(_words, LongType())


def _first_words(texts: pa.Array, counts: pa.Array) -> pa.Array:
    out = []
    for text, n in zip(texts.to_pylist(), counts.to_pylist()):
        if n is not None and text is not None:
            ends = (m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", text))
            text = text[: next(islice(ends, n - 1, None), len(text))] if n else ""
        out.append(text)
    return pa.array(out, pa.string())


#: (text, n): text up to its n-th word; whole where n is null.
first_words = F.arrow_udf(_first_words, StringType())


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target for one row per source (source, source_size).

    Sources by code point, null last, weigh weights, repeating. All sizes are shared by weight; a
    target stops at `most` times its source's size and the excess is shared again until none is
    above. In the order of most * size / weight the stopped sources are the first k, the least k
    for which sharing the remainder stops no other; it is found with running sums over the sources.
    """
    everyone = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(everyone) - 1) % len(weights) + 1))
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    upto, rest = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    ranked = weighed.withColumn("room", most * F.col("source_size") / F.col("weight")).select(
        "*",
        F.sum("source_size").over(whole).alias("total"),
        F.coalesce(F.sum(most * F.col("source_size")).over(upto), F.lit(0)).alias("stopped"),
        F.sum("weight").over(rest).alias("open_weight"),
        F.row_number().over(by_room).alias("turn"),
    )
    level = (F.col("total") - F.col("stopped")) / F.col("open_weight")
    share = F.min_by(level, F.when(level <= F.col("room"), F.col("turn"))).over(whole)  # of the first that needs no stop
    return ranked.withColumn("level", share).select("source", "source_size", F.least(F.col("level") * F.col("weight"), (most * F.col("source_size")).cast("double")).alias("target"))


def split_node(held: np.ndarray, node: int, levels: int, seed: int) -> list[tuple[int, np.ndarray]]:
    """(node, its quotas) of the nodes `levels` below; node 1 is the root, 2 n and 2 n + 1 are below n.

    A node draws half of what it holds, without replacement, for its left half. Its draw depends on
    seed and node alone, so a subtree is the same in whatever task it is split.
    """
    if not levels:
        return [(node, held)]
    left = held * 0
    if held.sum():
        left = np.random.default_rng([seed, node]).multivariate_hypergeometric(held, int(held.sum()) // 2, method="marginals")
    return split_node(left, 2 * node, levels - 1, seed) + split_node(held - left, 2 * node + 1, levels - 1, seed)


_NODE = pa.schema([("node", pa.int64()), ("lists", pa.list_(pa.int32())), ("quotas", pa.list_(pa.int64()))])
_NODE_DDL = "node long, lists array<int>, quotas array<long>"


def _split(levels: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, lists, quotas in zip(*(batch[c].to_pylist() for c in _NODE.names)):
                below = split_node(np.array(quotas, np.int64), node, levels, seed)
                some = [(n, np.flatnonzero(held), held) for n, held in below]
                names = np.array(lists, np.int32)
                rows = [(n, names[at].tolist(), held[at].tolist()) for n, at, held in some if len(at)]
                yield pa.RecordBatch.from_pydict(dict(zip(_NODE.names, map(list, zip(*rows)))) if rows else {c: [] for c in _NODE.names}, schema=_NODE)

    return run


def draw(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """list, shard, n: how many blocks of each list each shard takes; no rows for none.

    quotas: list, quota, one row per list. The tree is split in two steps, so the lower half of its
    levels is spread over the cluster; a node is a row of LISTS numbers at most.
    """
    levels = shards.bit_length() - 1
    sorted_ = F.array_sort(F.collect_list(F.struct("list", "quota")))
    node = quotas.where("quota > 0").agg(sorted_.alias("q")).select(F.lit(1).cast("long").alias("node"), F.col("q.list").alias("lists"), F.col("q.quota").alias("quotas"))
    for step in (levels // 2, levels - levels // 2):
        node = node.repartition("node").mapInArrow(_split(step, seed), _NODE_DDL)
    each = node.select((F.col("node") - shards).cast("int").alias("shard"), F.explode(F.arrays_zip("lists", "quotas")).alias("x"))
    return each.select(F.col("x.lists").alias("list"), "shard", F.col("x.quotas").alias("n"))


def _list_of(source: Column) -> Column:
    return F.pmod(F.xxhash64(source), F.lit(LISTS)).cast("int")


def _small(df: DataFrame) -> DataFrame:
    """df with a broadcast hint where its rows are few and its sources' names are short."""
    n, longest = df.agg(F.count("*"), F.max(F.length("__source"))).head()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (longest or 0) <= BROADCAST_NAME else df


def _of_source() -> Column:
    return F.col("source").eqNullSafe(F.col("__source"))


def _sized(docs: DataFrame, keep: list[str]) -> DataFrame:
    key = F.xxhash64(F.lit(41), F.col("source"), F.col("doc_id"), F.col("text"))
    return docs.select(*keep, key.alias("key"), words("text").alias("size"))


class Plan:
    """What a mix takes: goals (a row per source) and deals (a row per block, with its shard of each pass)."""

    def __init__(self, docs: DataFrame, shards: int | None = None, seed: int = 7) -> None:
        sized = cut(_sized(docs, ["source"]))
        goal = targets(sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")))
        goal = goal.withColumn("words", F.round("target").cast("long"))
        goal = goal.withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(F.lit(0)).cast("int"))
        goal = goal.withColumn("rest", F.col("words") - F.col("full") * F.col("source_size"))
        many = F.greatest(F.lit(float(LEAST_BLOCKS)), F.col("source_size") / BLOCK_WORDS)
        goal = cut(goal.withColumn("blocks", F.pow(F.lit(2.0), F.ceil(F.log2(many))).cast("long")).withColumnRenamed("source", "__source"))
        total = goal.agg(F.sum("source_size")).head()[0] or 0
        self.shards, self.seed = shards or max(16, 1 << (total // SHARD_WORDS).bit_length()), seed
        per_block = cut(self._in_blocks(sized, goal).groupBy("source", "block").agg(F.sum("size").alias("size")))
        running = per_block.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("block")))
        edge = (
            running.join(_small(goal), _of_source())
            .where((F.col("rest") > 0) & (F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")))
            .select(F.col("source").alias("e_source"), F.col("block").alias("edge"), (F.col("upto") - F.col("size")).alias("before"))
        )
        goal = goal.join(edge, F.col("__source").eqNullSafe(F.col("e_source")), "left").drop("e_source")
        goal = goal.withColumns({"edge": F.coalesce("edge", F.lit(-1)), "before": F.coalesce("before", F.lit(0)), "list": _list_of(F.col("__source"))})
        goal = goal.withColumn("quota", F.col("full") * F.col("blocks") + F.col("edge") + 1)
        in_list = Window.partitionBy("list").orderBy(F.col("__source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        self.goals = cut(goal.withColumn("first", F.coalesce(F.sum("quota").over(in_list), F.lit(0))))
        self.deals = cut(self._deals(per_block))

    @staticmethod
    def _in_blocks(rows: DataFrame, goal: DataFrame) -> DataFrame:
        """rows (source, key, ...) with their block."""
        met = rows.join(_small(goal.select("__source", "blocks")), _of_source()).drop("__source")
        return met.withColumn("block", F.pmod(F.shiftrightunsigned("key", 20), F.col("blocks"))).drop("blocks")

    def _deals(self, per_block: DataFrame) -> DataFrame:
        """__source, __block, dealt (pass, shard): for which shards a block was drawn."""
        runs = draw(self.goals.groupBy("list").agg(F.sum("quota").alias("quota")), self.shards, self.seed)
        before = Window.partitionBy("list").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        runs = runs.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        runs = runs.select("list", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("index"))
        blocks = per_block.select("source", "block").join(_small(self.goals), _of_source())
        last = F.col("full") - F.when(F.col("block") <= F.col("edge"), 0).otherwise(1)
        each = blocks.where(last >= 0).withColumn("pass", F.explode(F.sequence(F.lit(0), last)))
        odd, shift = F.pmod(F.hash("source", "pass", F.lit(self.seed)), F.lit(1 << 20)) * 2 + 1, F.pmod(F.hash("pass", "source", F.lit(self.seed)), F.lit(1 << 20))
        turn = F.when(F.col("pass") < F.col("full"), F.pmod(odd * F.col("block") + shift, F.col("blocks"))).otherwise(F.col("block"))
        each = each.select("source", "block", "pass", "list", (F.col("first") + F.col("pass") * F.col("blocks") + turn).alias("index"))
        dealt = each.join(runs, ["list", "index"]).groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("dealt"))
        return dealt.select(F.col("source").alias("__source"), F.col("block").alias("__block"), "dealt")

    def apply(self, rows: DataFrame) -> DataFrame:
        """rows (source, key, size, ...) with their source's goal, dealt (null: no shard) and part: words taken in the last pass."""
        rows = self._in_blocks(rows, self.goals)
        deals = _small(self.deals)
        rows = rows.join(deals, _of_source() & (F.col("block") == F.col("__block")), "left").drop("__source", "__block")
        rows = rows.join(_small(self.goals.drop("list", "quota", "first", "words", "blocks")), _of_source()).drop("__source")
        inner = rows.where(F.col("block") != F.col("edge")).withColumn("part", F.when(F.col("block") < F.col("edge"), F.col("size")).otherwise(F.lit(0)).cast("long"))
        in_edge = Window.partitionBy("source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
        ahead = F.col("before") + F.coalesce(F.sum("size").over(in_edge), F.lit(0))
        on_edge = rows.where(F.col("block") == F.col("edge")).withColumn("part", F.greatest(F.lit(0), F.least("size", F.col("rest") - ahead)).cast("long"))
        return inner.unionByName(on_edge)


def weigh(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and full_passes for every row of docs (doc_id, text, source).

    taken by the plan's arithmetic, to hold against the mix. A null text has size 0; a null source is
    a source. Rows repeated whole are rows of their own, each weighed; which of them the edge cuts
    makes no difference. An empty table gives none.
    """
    taken = Plan(docs).apply(_sized(docs, ["doc_id", "source"]))
    return taken.select("doc_id", F.col("size").cast("long"), F.col("source_size").cast("long"), "target", (F.col("full") * F.col("size") + F.col("part")).cast("long").alias("taken"), F.col("full").alias("full_passes"))


def _deal(docs: DataFrame, plan: Plan) -> DataFrame:
    """The mix's rows (row: a struct of the columns of docs; pass, shard, text as it is given, cut), dealt and shuffled."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "source", "doc_id", "text")
    rows = plan.apply(_sized(rows, ["row", "source"]))
    empty = F.array(F.struct(F.lit(0).alias("pass"), F.pmod("key", F.lit(plan.shards)).cast("int").alias("shard")))
    taken = F.filter("dealt", lambda d: (d["pass"] < F.col("full")) | (F.col("part") > 0))
    each = rows.withColumn("deal", F.explode(F.when(F.col("size") == 0, empty).otherwise(taken)))
    each = each.withColumns({"pass": F.col("deal.pass"), "shard": F.col("deal.shard")})
    each = each.withColumn("cut", (F.col("pass") == F.col("full")) & (F.col("part") < F.col("size")))
    shorter = first_words(F.when(F.col("cut"), F.col("row.text")), F.when(F.col("cut"), F.col("part")))  # few texts go to Python
    each = each.withColumn("text", F.when(F.col("cut"), shorter).otherwise(F.col("row.text")))
    return each.repartition(plan.shards, "shard").sortWithinPartitions("shard", F.xxhash64("key", "pass", F.lit(plan.seed)))


def mix(docs: DataFrame, shards: int | None = None, seed: int = 7) -> DataFrame:
    """The mixed corpus: the columns of docs, a row for each time a document is taken.

    Rows are dealt to `shards` partitions (a power of two; by default one for each SHARD_WORDS words,
    16 at least) by the tree and shuffled within each. The document on a
    source's edge is cut to its first words taken, n_chars (if there) with it. Documents without
    words count for nothing; they come once, so that nothing but words decides.
    """
    dealt = _deal(docs, Plan(docs, shards, seed))
    columns = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("cut"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return dealt.select(*(v.alias(c) for c, v in columns.items()))


def given(docs: DataFrame, row: str, shards: int | None = None, seed: int = 7) -> DataFrame:
    """What weigh() gives, with taken counted in the mixed rows themselves: their words, summed for each row of docs, and their shards.

    row: a column that differs in all rows of docs and stays the same when they are read again.
    """
    plan = Plan(docs, shards, seed)
    counted = _deal(docs, plan).select(F.col("row").getField(row).alias(row), words("text").alias("given"), "shard")
    counted = counted.groupBy(row).agg(F.sum("given").alias("taken"), F.array_sort(F.collect_set("shard")).alias("shards"))
    goals = _small(plan.goals.select("__source", "source_size", "target", F.col("full").alias("full_passes")))
    every = _sized(docs, [row, "doc_id", "source"])
    every = every.join(goals, _of_source()).join(counted, row, "left")
    return every.select(
        "doc_id", F.col("size").cast("long"), F.col("source_size").cast("long"), "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "full_passes", F.coalesce("shards", F.array().cast("array<int>")).alias("shards"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all documents takes of each (the contract's digest columns)."""
    docs = table(spark, sf_dir, "documents")
    row = unused(docs.columns, "__row")
    return given(docs.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias(row)), row)
