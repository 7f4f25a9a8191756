"""SimHash near-duplicates by a Gray-order hierarchical index.

Every document has a 64-bit fingerprint of its word shingles. Documents link if their fingerprints
differ in few bits; groups are the connected components. Equal fingerprints meet first, so copies
are one row from there on. Two fingerprints that differ in at most 2 of 64 bits agree in two of
four 16-bit quarters, so each is sent to the six pairs of quarters; within such a bucket they are
sorted by Gray rank and indexed: a node holds, for a run of neighbours, the masked bits that all of
them share and its parent doesn't, a search adds up the differences from the root down and leaves
a whole run as soon as they exceed the limit. A bucket hands on a spanning forest of its links,
never all pairs, and the forests are joined to components by large-star and small-star steps.
"""

from __future__ import annotations

from itertools import combinations
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import cut, per_batch, table, unused

BITS, QUARTER, LIMIT, SEED = 64, 16, 2, 42
#: Buckets with more fingerprints are dealt again by their other bits.
HOT = 100_000
#: Children of an index node.
FANOUT = 8
#: (query, node) pairs that one step of a search holds at most, about.
STEP = 1 << 20


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a whole text; of no words it is 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
        begins = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
        parts = [joined[a:b] for a, b in zip(begins, (ends[shingle - 1 :] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, SEED) for p in parts], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist()))


def _fingerprints():
    def each(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t) for t in batch["text"].to_pylist()], np.uint64)
        return {"doc_id": batch["doc_id"], "content": batch["content"], "fp": found.view(np.int64)}

    return each


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """The place of each word in the reflected Gray code."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A forest, a tree for each bucket, over fingerprints sorted by (bucket, Gray rank)."""

    def __init__(self, buckets: np.ndarray, fps: np.ndarray) -> None:
        self.order = np.lexsort((gray_rank(fps), buckets))
        self.fps = fps[self.order]
        group = buckets[self.order]
        new = np.concatenate([[True], group[1:] != group[:-1]])
        self.levels = []  # from the leaves' parents up: (first child, children, pattern, shared mask)
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(group)))
        pattern, mask = self.fps, np.full(len(fps), np.iinfo(np.uint64).max, np.uint64)
        while True:
            nodes = -(-sizes // FANOUT)  # of each bucket
            first_node = np.concatenate([[0], np.cumsum(nodes)[:-1]])
            bucket_of = np.repeat(np.arange(len(nodes)), nodes)
            first = begins[bucket_of] + FANOUT * (np.arange(nodes.sum()) - first_node[bucket_of])
            n = np.minimum(FANOUT, begins[bucket_of] + sizes[bucket_of] - first)
            up = pattern[first]
            differ = np.bitwise_or.reduceat(pattern ^ np.repeat(up, n), first) | ~np.bitwise_and.reduceat(mask, first)
            self.levels.append((first, n, up, ~differ))
            pattern, mask, begins, sizes = up, ~differ, first_node, nodes
            if (nodes <= 1).all():
                break
        self.root = np.repeat(np.arange(len(begins)), np.diff(np.append(np.flatnonzero(new), len(group))))

    def links(self, limit: int = LIMIT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i < j in sorted order, within limit bits, in blocks of queries."""
        at, block = 0, 4096
        while at < len(self.fps):
            queries = np.arange(at, min(len(self.fps), at + block))
            pairs, widest = self._search(queries, limit)
            yield pairs
            at += block
            block = max(64, min(1 << 16, block * STEP // max(widest, 1)))

    def _search(self, queries: np.ndarray, limit: int):
        q, node = queries, self.root[queries]
        fixed = np.zeros(len(q), np.uint64)  # bits that nodes above have compared
        differences = np.zeros(len(q), np.uint8)
        widest = len(q)
        for first, n, pattern, mask in reversed(self.levels):
            differences = differences + np.bitwise_count((self.fps[q] ^ pattern[node]) & mask[node] & ~fixed)
            near = differences <= limit
            q, node, differences = q[near], node[near], differences[near]
            fixed = mask[node]
            k = n[node]
            child = np.repeat(first[node] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            q, fixed, differences = np.repeat(q, k), np.repeat(fixed, k), np.repeat(differences, k)
            node = child
            widest = max(widest, len(q))
        after = node > q
        q, node, fixed, differences = q[after], node[after], fixed[after], differences[after]
        near = differences + np.bitwise_count((self.fps[q] ^ self.fps[node]) & ~fixed) <= limit
        return (q[near], node[near]), widest


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """label[i]: the smallest member of i's component."""
    label = np.arange(n)
    for i, j in links:
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            low = np.minimum(a, b)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while (label != label[label]).any():
                label = label[label]
    return label


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; whole buckets are searched together, in lots of some size."""
    lot, held, size = 1 << 17, [], 0  # held: parts of (bucket, fp)

    def search(buckets: np.ndarray, fps: np.ndarray):
        index = GrayIndex(buckets, fps.view(np.uint64))
        label = forest(len(fps), index.links())
        moved = np.flatnonzero(label != np.arange(len(fps)))
        sorted_fps = index.fps.view(np.int64)
        return pa.RecordBatch.from_pydict({"a": sorted_fps[moved], "b": sorted_fps[label[moved]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    for batch in batches:
        held.append((batch["bucket"].to_numpy(), batch["fp"].to_numpy()))
        size += len(batch)
        if size >= lot:
            buckets, fps = map(np.concatenate, zip(*held))
            whole = int(np.flatnonzero(buckets != buckets[-1])[-1]) + 1 if (buckets != buckets[-1]).any() else 0  # the last bucket may go on
            if whole:
                yield search(buckets[:whole], fps[:whole])
            held, size = [(buckets[whole:], fps[whole:])], len(buckets) - whole
            lot = max(lot, 2 * size)  # so that a long bucket is copied as often as it doubles
    if size:
        yield search(*map(np.concatenate, zip(*held)))


def links(fps: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of all links between distinct fingerprints fp.

    A bucket of more than HOT fingerprints is dealt again in the same way: what its 32 agreed bits
    leave is four 8-bit parts, of which linked fingerprints agree in two. Then 48 bits are agreed, so
    no bucket has more than 2 ** 16 distinct fingerprints, whatever the corpus.
    """
    pairs = list(combinations(range(4), 2))

    def dealt_by(bits: Column, width: int) -> list[Column]:
        part = lambda i: F.shiftrightunsigned(bits, width * i).bitwiseAND((1 << width) - 1)
        return [F.shiftleft(part(i), width).bitwiseOR(part(j)).bitwiseOR(F.lit(k << 2 * width)) for k, (i, j) in enumerate(pairs)]

    quarter = lambda i: F.shiftrightunsigned("fp", QUARTER * i).bitwiseAND((1 << QUARTER) - 1)
    left = [F.shiftleft(quarter(a), QUARTER).bitwiseOR(quarter(b)) for i, j in pairs for a, b in [[x for x in range(4) if x not in (i, j)]]]
    cell = F.explode(F.array(*(F.struct(k.alias("bucket"), x.alias("left")) for k, x in zip(dealt_by(F.col("fp"), QUARTER), left))))
    buckets = fps.select("fp", cell.alias("cell")).select("fp", "cell.*")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = buckets.join(shared, "bucket")
    small = met.where(F.col("n") <= HOT).select("bucket", "fp")
    again = met.where(F.col("n") > HOT).select("fp", "bucket", F.explode(F.array(*dealt_by(F.col("left"), QUARTER // 2))).alias("sub"))
    # a bucket's number has 35 bits and a part's 19; bit 62 sets these apart from whole buckets
    again = again.select(F.shiftleft("bucket", 19).bitwiseOR(F.col("sub")).bitwiseOR(F.lit(1 << 62)).alias("bucket"), "fp")
    dealt = small.unionByName(again).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_bucket_links, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node it reaches.

    Large-star and small-star steps in turn until neither changes an edge. Each step is cut, so a
    lost executor costs one step; edges stay at most as many as they were.
    """
    both = lambda e: e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        around = both(now)
        low = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = cut(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = cut(small.where("a != b").distinct())
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).head())
        if state == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        mark = state


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, content (hash of text), fp, root (smallest fingerprint of the group), component_id of every row."""
    kept = docs.select("doc_id", "text", F.xxhash64("text").alias("content"))
    schema = pa.schema([("doc_id", pa.int64()), ("content", pa.int64()), ("fp", pa.int64())])
    prints = cut(kept.mapInArrow(per_batch(_fingerprints, schema), "doc_id long, content long, fp long"))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "content", "fp", "root", "component_id")


def group(docs: DataFrame) -> DataFrame:
    """doc_id, fp (signed), component_id for every row of docs (doc_id, text).

    component_id is the smallest doc_id that links reach. A null text has no words; fingerprint 0
    links like any other. Null ids are grouped too: a group of nothing else has a null component_id.
    Repeated rows come as often as they do in docs.
    """
    return _grouped(docs).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """docs with exactly one row of each group: the smallest doc_id's, rows without an id last.

    Of rows that share the id the one whose text has the least hash stays, and of rows that share the
    text too the first by their other columns (as JSON). Groups are of rows, not of ids: where an id
    stands in two groups, each keeps a row of its own.
    """
    content, turn, least, its = (unused(docs.columns, f"__{n}") for n in ("content", "turn", "id", "hash"))
    rows = cut(_grouped(docs))
    chosen = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")).alias("c"))
    chosen = chosen.select(F.col("c.doc_id").alias(least), F.col("c.content").alias(its))
    match = F.col(least).eqNullSafe(F.col("doc_id")) & (F.col(its) == F.col(content))
    left = docs.withColumn(content, F.xxhash64("text")).join(chosen, match, "left_semi")
    if rows.groupBy("doc_id", "content").count().where("count > 1").limit(1).count():
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        order = Window.partitionBy("doc_id", content).orderBy(F.to_json(F.struct(F.lit(0).alias("none"), *others)))
        left = left.withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1)
    return left.select(*docs.columns)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (the contract's digest columns)."""
    found = group(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
