"""Exact top-k inner products over norm-sorted vectors.

Vectors are scaled to integers, sorted by falling length and packed into blocks; a rotation by the
corpus's right singular vectors gathers most of each vector in its first coordinates. Blocks are
processed by descending length, in bands of growing size. Before a band, each query has a score to
beat: the k-th best of the bands before. A query block meets a vector block only if its queries can
still be beaten there: by the product of the greatest lengths, and by the products of the blocks'
extents in the first rotated coordinates plus what is left of the lengths (Cauchy and Schwarz). This
is decided on the blocks' outlines, before any vector is shuffled. Where blocks meet, partial sums
over the first STEPS coordinates plus the product of the residual lengths bound each pair's score,
step by step; pairs that can't beat their query's score are dropped, the others are scored in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import cut, table

SCALE = 256
BLOCK = 4096
QUERIES = 2048
#: Rotated coordinates after which partial sums are bounded; the first of them also outline a block.
STEPS = (16, 32, 48)
#: A band has so many times the blocks of all bands before it.
GROWTH = 3
#: Bounds are doubles; they are widened by this share so that rounding never loses a vector.
SLACK = 1e-9
#: Components stop here, and scores at the ends of a long.
MOST = float(1 << 62)


def scaled(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (floor(SCALE * x) of each component), norm; vectors null or with a null or non-finite component, and null ids, are left out.

    Rows that share a vec_id are vectors of their own. A component over 2^62 counts as 2^62 (and its
    negative so), and scores beyond 64 bits as the nearest long.
    """
    e = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fit = F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.floor(F.greatest(F.lit(-MOST), F.least(F.lit(MOST), x * SCALE))).cast("long")
    rows = vectors.where(fit).select(F.col(vec_id).alias("vec_id"), F.transform(e, whole).alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))


def _matrix(rows: pa.Array, dims: int) -> np.ndarray:
    """Rows (lists of long) as a matrix; shorter vectors are filled up with zeros."""
    flat, lengths = rows.flatten().to_numpy(zero_copy_only=False), rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(lengths) * dims:
        return flat.astype(np.int64).reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _gram(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            m = _matrix(batch["v"], dims).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_pydict({"at": np.arange(dims * dims), "x": total.ravel()})

    return run


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, by falling singular value; from their dims x dims Gram matrix."""
    parts = vectors.select("v").mapInArrow(_gram(dims), "at long, x double").groupBy("at").agg(F.sum("x")).collect()
    gram = np.zeros(dims * dims)
    for at, x in parts:
        gram[at] = x
    return np.linalg.eigh(gram.reshape(dims, dims) / max(np.abs(gram).max(), 1.0))[1][:, ::-1]


class Block:
    """Vectors by falling length, their lengths, and on demand their rotation and residual lengths."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, turn: np.ndarray) -> None:
        self.ids, self.v = ids, v
        self.norm = np.sqrt((v.astype(float) ** 2).sum(1))
        self.turned = v.astype(float) @ turn
        # rest[s]: length of what comes after STEPS[s] coordinates
        self.rest = [np.sqrt((self.turned[:, s:] ** 2).sum(1)) for s in STEPS]

    @staticmethod
    def read(ids: bytes, v: bytes, width: int, dims: int, turn: np.ndarray) -> Block:
        return Block(np.frombuffer(ids, np.int64), np.frombuffer(v, f"<i{width}").reshape(-1, dims).astype(np.int64), turn)


_PACKED = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("top", pa.float64()), ("rest", pa.float64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
     ("beat", pa.float64()), ("width", pa.int32()), ("ids", pa.binary()), ("vs", pa.binary()), ("beats", pa.binary())]
)
_PACKED_DDL = "part int, seq int, top double, rest double, low array<double>, high array<double>, beat double, width int, ids binary, vs binary, beats binary"


def _pack(dims: int, turn: np.ndarray, most: int):
    """Rows (vec_id, v, beat) of a partition, in their order -> blocks and their outlines."""
    from pyspark import TaskContext

    def block(part: int, seq: int, rows: pa.Table) -> pa.RecordBatch:
        v, beat = _matrix(rows["v"].combine_chunks(), dims), rows["beat"].to_numpy()
        made = Block(rows["vec_id"].to_numpy(), v, turn)
        head = made.turned[:, : STEPS[0]]
        largest = int(np.abs(v).max(initial=0)) + 1
        width = next(w for w in (2, 4, 8) if largest < 1 << (8 * w - 1))
        return pa.RecordBatch.from_pydict(
            {"part": [part], "seq": [seq], "top": [made.norm.max()], "rest": [made.rest[0].max()], "low": [head.min(0).tolist()], "high": [head.max(0).tolist()], "beat": [beat.min()],
             "width": [width], "ids": [made.ids.astype(np.int64).tobytes()], "vs": [v.astype(f"<i{width}").tobytes()], "beats": [beat.tobytes()]}, schema=_PACKED,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            while size >= most:
                rows = pa.Table.from_batches(held)
                yield block(part, seq, rows.slice(0, most))
                seq, size = seq + 1, size - most
                held = rows.slice(most).to_batches()
        if size:
            yield block(part, seq, pa.Table.from_batches(held))

    return run


def packed(rows: DataFrame, dims: int, turn: np.ndarray, most: int, total: int) -> DataFrame:
    """Blocks of at most `most` rows of rows (vec_id, v, norm, beat), by falling norm over all partitions.

    Equal lengths, which may be a third of all rows, are dealt by their ids' hash.
    """
    parts = -(-total // most)
    spread = F.xxhash64("vec_id", "v")
    ranged = rows.repartitionByRange(parts, F.desc("norm"), spread).sortWithinPartitions(F.desc("norm"), spread)
    return ranged.select("vec_id", "v", "beat").mapInArrow(_pack(dims, turn, most), _PACKED_DDL)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_DDL = "query_id long, vec_id long, score long"


def _best(q: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k best of each query: by score, then by smaller id."""
    order = np.lexsort((ids, ~scores, q))  # -1 - score, which can't overflow
    q = q[order]
    starts = np.concatenate([[True], q[1:] != q[:-1]])[: len(q)]
    rank = np.arange(len(q)) - np.maximum.accumulate(np.where(starts, np.arange(len(q)), 0))
    return order[rank < k]


def exact(q: np.ndarray, v: np.ndarray, most: float) -> np.ndarray:
    """Inner products of the rows of q and v, pair by pair; most: a bound of their size."""
    if most < 1 << 53:  # whole numbers in doubles
        return np.einsum("ij,ij->i", q.astype(float), v.astype(float)).astype(np.int64)
    if most < 1 << 62:
        return np.einsum("ij,ij->i", q, v)
    ends = np.iinfo(np.int64)
    return np.array([min(ends.max, max(ends.min, sum(map(int.__mul__, a, b)))) for a, b in zip(q.tolist(), v.tolist())], np.int64)


def meet(q: Block, v: Block, beat: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score): the k best of each query's pairs that reach its beat, exactly."""
    out = []
    live = np.flatnonzero(q.norm * v.norm.max(initial=0) * (1 + SLACK) + 1e-6 >= beat)
    wide = max(1, (1 << 21) // max(1, len(v.ids)))
    for at in range(0, len(live), wide):
        some = live[at : at + wide]
        goal, norm = beat[some, None], q.norm[some, None]
        # vectors are sorted by length: those after the first too short for every query are left
        n = int(np.count_nonzero(v.norm * norm.max() * (1 + SLACK) + 1e-6 >= goal.min()))
        slack = SLACK * norm * v.norm[:n] + 1e-6
        most = float(norm.max() * v.norm[:n].max(initial=0))
        partial, begin, kept = np.zeros((len(some), n)), 0, None
        for s, rest in zip(STEPS, range(len(STEPS))):
            if begin >= q.v.shape[1]:
                break
            partial += q.turned[some, begin:s] @ v.turned[:n, begin:s].T
            begin = s
            bound = partial + q.rest[rest][some, None] * v.rest[rest][:n] + slack
            if not np.isfinite(goal).all():  # nothing to beat yet: each query's k highest lower bounds are
                floor = partial - q.rest[rest][some, None] * v.rest[rest][:n] - slack
                floor[q.ids[some, None] == v.ids[:n]] = -np.inf
                if n > k:
                    goal = np.maximum(goal, np.partition(floor, n - k, axis=1)[:, n - k, None])
            kept = bound >= goal
            if np.count_nonzero(kept) * 8 < kept.size:
                break
        kept &= q.ids[some, None] != v.ids[:n]
        if most < 1 << 53 and np.count_nonzero(kept) * 8 >= kept.size:  # most are left: all products at once, in doubles that hold them exactly
            scores = q.v[some].astype(float) @ v.v[:n].T.astype(float)
            if n > k:
                floor = np.where(kept, scores, -np.inf)
                kept &= scores >= np.partition(floor, n - k, axis=1)[:, n - k, None]
            a, b = np.nonzero(kept)
            score = scores[a, b].astype(np.int64)
        else:
            a, b = np.nonzero(kept)
            cuts = range(0, max(len(a), 1), 1 << 16)
            score = np.concatenate([exact(q.v[some[a[i : i + (1 << 16)]]], v.v[b[i : i + (1 << 16)]], most) for i in cuts])
        top = _best(some[a], score, v.ids[b], k)
        out.append((q.ids[some[a]][top], v.ids[b][top], score[top]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _search(dims: int, turn: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, v = None, None  # a partition's meetings come sorted by vector block
        for batch in batches:
            for row in batch.to_pylist():
                if last != (row["part"], row["seq"]):
                    last, v = (row["part"], row["seq"]), Block.read(row["ids"], row["vs"], row["width"], dims, turn)
                q = Block.read(row["q_ids"], row["q_vs"], row["q_width"], dims, turn)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, meet(q, v, np.frombuffer(row["q_beats"]), k))), schema=_FOUND)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "turn")
    return found.withColumn("turn", F.monotonically_increasing_id()).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("turn")


def _can_beat() -> Column:
    """Whether a query block (q_...) may have a pair with a vector block that reaches its least score to beat."""
    spans = F.arrays_zip("q_low", "q_high", "low", "high")
    most = lambda x: F.greatest(x["q_low"] * x["low"], x["q_low"] * x["high"], x["q_high"] * x["low"], x["q_high"] * x["high"])
    head = F.aggregate(spans, F.lit(0.0), lambda a, x: a + most(x))
    limit = F.col("q_top") * F.col("top")
    return F.least(limit, head + F.col("q_rest") * F.col("rest")) + SLACK * limit + 1e-6 >= F.col("q_beat")


def meetings(asks: DataFrame, blocks: DataFrame, first: int, last: int) -> DataFrame:
    """(q_part, q_seq, part, seq): the pairs of blocks of parts first to last that have to meet, by their outlines alone."""
    outline = asks.drop("q_ids", "q_vs", "q_beats")
    each = outline.withColumn("part", F.explode(F.sequence(F.lit(first), F.lit(last))))
    return each.join(blocks.drop("ids", "vs", "beats"), "part").where(_can_beat()).select("q_part", "q_seq", "part", "seq")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products among all other vectors.

    vectors, queries: of scaled(). Ties go to the smaller vec_id; fewer than k vectors give them all.
    Vectors of unlike lengths are compared as if the shorter had zeros. A query's own are the rows
    with its vec_id; if it is asked more than once, its rows share one list of k. Each meeting of
    blocks hands on k rows a query at most, and a band is one job, cut.
    """
    dims = max((r[0] or 0 for r in (vectors.agg(F.max(F.size("v"))).head(), queries.agg(F.max(F.size("v"))).head())), default=0)
    total, asked = vectors.count(), queries.count()
    if not dims or not total or not asked:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    turn = rotation(vectors, dims)
    none = F.lit(float("-inf")).alias("beat")
    blocks = cut(packed(vectors.select("vec_id", "v", "norm", none), dims, turn, BLOCK, total))
    parts = blocks.agg(F.max("part")).head()[0] + 1
    found, done = None, 0
    while done < parts:
        last = min(parts, done + max(1, GROWTH * done)) - 1
        if found is None:
            open_ = queries.select("vec_id", "v", "norm", none)
        else:
            kth = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
            kth = kth.select("vec_id", F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(float("-inf"))).alias("beat"))
            open_ = queries.join(kth, "vec_id", "left").select("vec_id", "v", "norm", F.coalesce("beat", none).alias("beat"))
            top = blocks.where(F.col("part") >= done).agg(F.max("top")).head()[0]
            open_ = open_.where(F.col("norm") * top * (1 + SLACK) + 1e-6 >= F.col("beat"))
        asks = packed(open_, dims, turn, QUERIES, asked)
        asks = cut(asks.select(*(F.col(c).alias(f"q_{c}") for c in asks.columns)))
        pairs = meetings(asks, blocks, done, last)
        bodies = blocks.where(F.col("part").between(done, last)).select("part", "seq", "width", "ids", "vs")
        met = pairs.join(asks.select("q_part", "q_seq", "q_width", "q_ids", "q_vs", "q_beats"), ["q_part", "q_seq"]).join(bodies, ["part", "seq"])
        met = met.sortWithinPartitions("part", "seq").mapInArrow(_search(dims, turn, k), _DDL)
        found = cut(_ranked(met if found is None else found.select("query_id", "vec_id", "score").unionByName(met), k))
        done = last + 1
    return found.select("query_id", "rank", "vec_id", "score")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest scores of every vector whose id is divisible by 50, among all other rows."""
    vectors = cut(scaled(table(spark, sf_dir, "embeddings")))
    return search(vectors, vectors.where("vec_id % 50 = 0"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
