"""Packing token sequences by non-negative least squares over a length histogram.

A document's ids, closed by END, are cut into pieces of WINDOW ids and a shorter last one. Piece
lengths, in levels of UNIT ids, form a histogram. All combinations of at most three levels that
fill a window exactly are the columns of a non-negative least-squares problem whose right side is
the histogram; its solution, rounded down, says how often each combination is used. What is left
is packed greedily: a pattern takes the longest level left, then the longest that still fits, and
is used as often as the counts allow. Both steps see counts of levels only, so their cost does not
grow with the corpus; pieces find their place by their rank within their level.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm.common import cut, per_batch, table

WINDOW = 2048
UNIT = 8
LEVELS = WINDOW // UNIT
END = 1
#: Ranks are counted within (level, one of so many parts), for levels that a third of all pieces share.
PARTS = 128
VOCABULARY = "byte_bpe_50k.json"


class _Encoded(dict):
    """What follows a space (or begins a text) -> its ids as little-endian 32-bit numbers."""

    MOST = 200_000

    def __init__(self, encode, before: str) -> None:
        super().__init__()
        self.encode, self.before = encode, before

    def __missing__(self, part: str) -> bytes:
        ids = array("I", self.encode(self.before + part)).tobytes()
        if len(part) <= 40:
            if len(self) >= self.MOST:
                self.clear()
            self[part] = ids
        return ids


class Tokens:
    """The ids of the public byte-level BPE vocabulary as the tokenizers library gives them.

    Its pre-tokenizer always begins a token at a space that a non-space follows, so texts are
    encoded between such spaces and repeated parts only once. Parts are encoded from the same
    vocabulary's rank table; a text that spells a special token goes to the tokenizers library.
    """

    ODD = re.compile(r" (?:\s|$)")
    SPLIT = re.compile(r" (?=\S)")

    def __init__(self, path: str) -> None:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first, self.rest = _Encoded(plain.encode_ordinary, ""), _Encoded(plain.encode_ordinary, " ")

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        parts = self.SPLIT.split(text) if self.ODD.search(text) else text.split(" ")
        return self.first[parts[0]] + b"".join(map(self.rest.__getitem__, parts[1:]))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


_PIECES = {"doc_id": "long", "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long"}


def _pieces(path: str | None):
    def make():
        tokens = Tokens(path or default_vocabulary())
        end = array("I", [END]).tobytes()

        def each(batch: pa.RecordBatch) -> dict:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = (tokens(text) if text else b"") + end
                n = len(ids) // 4
                out += [(doc_id, at, min(WINDOW, n - at), zlib.crc32(ids[4 * at : 4 * (at + WINDOW)]), n) for at in range(0, n, WINDOW)]
            return dict(zip(_PIECES, map(list, zip(*out)))) if out else {c: [] for c in _PIECES}

        return each

    return per_batch(make, pa.schema([(c, pa.int64()) for c in _PIECES]))


def combinations() -> np.ndarray:
    """Every way to fill a window with at most three levels, as rows of three (0: none)."""
    return np.array([(a, b, LEVELS - a - b) for a in range(1, LEVELS + 1) for b in range(min(a, LEVELS - a) + 1) if 0 <= LEVELS - a - b <= b])


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 3 * LEVELS) -> np.ndarray:
    """Lawson and Hanson's active-set method for min |a x - b| with x >= 0."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slack = 1e-9 * max(1.0, np.abs(b).max(initial=0)) * len(b)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        if gain.max() <= slack:
            break
        active[gain.argmax()] = True
        while True:
            at = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            step = (x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)).min()
            x[at] += step * (z - x[at])
            active[at[x[at] <= 1e-12]] = False
            x[~active] = 0
    return x


def patterns(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(levels, times) that use each of counts[level] pieces once; levels run from 1 to LEVELS."""
    left = np.asarray(counts, np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if not left.sum():
        return out
    ways = combinations()
    a = np.zeros((LEVELS + 1, len(ways)))
    for part in ways.T:
        np.add.at(a, (part, np.arange(len(ways))), 1.0)
    weight = np.arange(1, LEVELS + 1) * 2 / LEVELS  # a long piece left over wastes more than a short one
    x = nnls(a[1:] * weight[:, None], left[1:] * weight)
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        levels = tuple(int(v) for v in ways[i] if v)
        times = min(int(x[i]), *(int(left[v]) // levels.count(v) for v in levels))
        if times > 0:
            out.append((levels, times))
            for v in levels:
                left[v] -= times
    while left.sum():
        room, levels, spare = LEVELS, [], left.copy()
        while (fits := np.flatnonzero(spare[: room + 1])).size:
            v = int(fits[-1])
            n = min(int(spare[v]), room // v)
            levels += [v] * n
            spare[v] -= n
            room -= n * v
        times = min(int(left[v]) // levels.count(v) for v in set(levels))
        out.append((tuple(levels), times))
        for v in levels:
            left[v] -= times
    return out


def slots(found: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(level, first rank, last rank, first sequence, times): ranks of a level and where they go."""
    out, used, base = [], np.zeros(LEVELS + 1, np.int64), 0
    for levels, times in found:
        for v in sorted(set(levels), reverse=True):
            n = times * levels.count(v)
            out.append((v, int(used[v]), int(used[v] + n - 1), base, times))
            used[v] += n
        base += times
    return out


def pack(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Pieces of all docs (doc_id, text) and their places.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null text is empty and has
    only END. Repeated rows and null ids are documents of their own. Each id is in one piece. The
    vocabulary is read on executors, which need the file at tokenizer_path (by default the installed one).
    """
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer_path), ", ".join(f"{c} {t}" for c, t in _PIECES.items()))
    pieces = cut(pieces).withColumn("level", F.ceil(F.col("length") / UNIT).cast("int"))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(PARTS)).cast("int"))
    sizes = cut(pieces.groupBy("level", "part").count())  # LEVELS * PARTS rows at most
    histogram = np.zeros(LEVELS + 1, np.int64)
    for level, n in sizes.groupBy("level").agg(F.sum("count")).collect():
        histogram[level] = n
    places = slots(patterns(histogram))
    spark = docs.sparkSession
    # at most LEVELS + the number of combinations used rows: bounded by the window, not by the corpus
    place = spark.createDataFrame(places, "level int, first long, last long, base long, times long")
    before = Window.partitionBy("level").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("level", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("level", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(sizes, ["level", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("ahead"))
    found = ranked.join(F.broadcast(place), "level").where(F.col("rank").between(F.col("first"), F.col("last")))
    at = F.col("rank") - F.col("first")
    found = found.withColumn("sequence_id", F.col("base") + at % F.col("times")).withColumn("turn", F.floor(at / F.col("times")))
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("level"), "turn").rowsBetween(Window.unboundedPreceding, -1)
    return found.select(*_PIECES, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
