"""Runs of repeating words, by recursive frequency splitting and a lag scan.

A run is a stretch of words with a smallest period q that spans it LEAST_TURNS times or more. Every
word of a run comes at least LEAST_TURNS times in it, so a word that comes less often within a segment
lies in no run of that segment and splits it. The parts are counted anew, which makes more words rare,
until no part changes: in prose nothing is left. What survives is scanned lag by lag. At lag q a run
holds at least three neighbouring aligned blocks of q words that are equal; blocks are compared by
rolling hashes, n / q for a lag, and every hit is verified and extended word by word. A stretch that a
run of a smaller period covers is one of its multiples and is left out.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import BLANK, per_batch, table, text_bytes

LEAST_TURNS, LEAST_WORDS = 4, 6

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_COLUMNS = {
    "doc_id": pa.int64(), "n_words": pa.int64(), "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
    "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
}
_SCHEMA = ", ".join(f"{c} {'string' if t == pa.string() else 'long'}" for c, t in _COLUMNS.items())


def segments(codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the segments that frequency splitting leaves; of[i] is the text that word i is in."""
    at = np.arange(len(codes), dtype=np.int64)  # words still in a segment
    group = of.astype(np.int64)  # and the segment of each
    settled: list[np.ndarray] = []
    while len(at):
        order = np.lexsort((codes[at], group))
        g, c = group[order], codes[at[order]]
        first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])]))
        often = np.empty(len(at), np.int64)
        often[order] = np.repeat(np.diff(np.append(first, len(at))), np.diff(np.append(first, len(at))))
        kept = often >= LEAST_TURNS
        whole = np.ones(int(group[-1]) + 1, bool)
        whole[group[~kept]] = False
        settled.append(at[whole[group]])
        left = kept & ~whole[group]
        at, group = at[left], group[left]
        if len(at):
            begins = np.concatenate([[True], (np.diff(at) > 1) | (group[1:] != group[:-1])])
            group = np.cumsum(begins) - 1
            long = np.bincount(group) >= LEAST_WORDS
            at, group = at[long[group]], group[long[group]]
            if len(at):
                group = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1
    rest = np.sort(np.concatenate(settled)) if settled else np.zeros(0, np.int64)
    if not len(rest):
        return rest, rest
    # two segments of one text never touch: a rare word lies between them
    begins = np.concatenate([[True], (np.diff(rest) > 1) | (of[rest[1:]] != of[rest[:-1]])])
    starts = rest[begins]
    ends = rest[np.append(np.flatnonzero(begins)[1:] - 1, len(rest) - 1)] + 1
    long = ends - starts >= LEAST_WORDS
    return starts[long], ends[long]


def _reach(codes: np.ndarray, at: int, q: int, step: int) -> int:
    """How far from at, stepwise, words keep equal to those q ahead."""
    done, size = 0, 64
    while True:
        if step > 0:
            a = codes[at + done : min(at + done + size, len(codes) - q)]
            differ = np.flatnonzero(a != codes[at + done + q : at + done + q + len(a)])
        else:
            low = max(at - done - size, 0)
            a = codes[low : at - done][::-1]
            differ = np.flatnonzero(a != codes[low + q : at - done + q][::-1])
        if len(differ):
            return done + int(differ[0])
        done += len(a)
        if len(a) < size:
            return done
        size *= 2


def scan(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one segment, by start and period."""
    n = len(codes)
    if n < LEAST_WORDS:
        return []
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _FACTOR | np.uint64(1))]), dtype=np.uint64)
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed * powers[:-1], dtype=np.uint64)])
        covered = np.zeros(n, np.int64)  # the furthest end of a run found that begins at or before each word
        out = []
        for q in range(1, n // LEAST_TURNS + 1):
            edges = sums[: n // q * q + 1 : q]
            blocks = np.diff(edges)
            same = blocks[:-1] * powers[q] == blocks[1:]
            hits = np.flatnonzero(same[:-1] & same[1:])
            if not len(hits):
                continue
            hits = hits[covered[hits * q] < (hits + 3) * q] * q
            done = 0
            for x in hits.tolist():
                if x < done or covered[x] >= x + 3 * q:
                    continue
                ahead = _reach(codes, x, q, 1)
                if ahead < 2 * q:
                    continue  # equal hashes of other words
                start = x - _reach(codes, x, q, -1)
                end = x + ahead + q
                done = end - 3 * q + 1  # a later block of this run begins before that
                if end - start >= max(LEAST_WORDS, LEAST_TURNS * q):
                    out.append((start, end - start, q))
                    np.maximum(covered[start:end], end, out=covered[start:end])
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(codes: np.ndarray, of: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run within a text, by start and period; starts count through all texts."""
    out = []
    for a, b in zip(*(x.tolist() for x in segments(codes, of))):
        out += [(a + s, n, q) for s, n, q in scan(codes[a:b])]
    return out


def words_of(texts: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """(words of all texts, offsets): text i has words offsets[i] to offsets[i + 1]; null has none."""
    data, offsets = text_bytes(texts)
    blank = BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = ~blank[firsts]
    starts = np.flatnonzero(begins)
    letters = np.cumsum(~blank, dtype=np.int64)
    bounds = np.append(letters[starts] - 1, letters[-1] if len(letters) else 0)
    packed = np.ascontiguousarray(data[~blank])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(packed)])
    return words, np.searchsorted(starts, offsets)


def _joined(words: pa.LargeBinaryArray, take: np.ndarray) -> str:
    """SHA-256 of those words, one space between them."""
    digest, step = hashlib.sha256(), 1 << 16
    for i in range(0, len(take), step):
        part = b" ".join(words.take(pa.array(take[i : i + step])).to_pylist())
        digest.update(b" " + part if i else part)
    return digest.hexdigest()


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """The original word at each place, after a run is planted: for a tenth of ids, by their crc32."""
    i = np.arange(n, dtype=np.int64)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return i
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i[a:] = a + (i[a:] - a) % p
    return i


def collapse(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """The words that stay: those that no run contains after its first period."""
    drop = np.zeros(n, bool)
    for start, length, period in found:
        drop[start + period : start + length] = True
    return np.flatnonzero(~drop)


def _report(doc_id, words, take: np.ndarray, found: list[tuple[int, int, int]]) -> tuple:
    best = None
    for r in found:  # by start and period, so that ties keep the first
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
    said = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(take), len(found), *said, digest, _joined(words, take[collapse(len(take), found)]))


def _each(plant: bool):
    def make():
        def each(batch: pa.RecordBatch) -> dict:
            words, offsets = words_of(batch["text"])
            codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            ids, takes = batch["doc_id"].to_pylist(), []
            for doc_id, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist()):
                takes.append(a + (planted(doc_id, b - a) if plant else np.arange(b - a)))
            codes = codes[np.concatenate(takes)] if takes else codes
            of = np.repeat(np.arange(len(ids)), np.diff(offsets))
            found: list[list[tuple[int, int, int]]] = [[] for _ in ids]
            for s, n, q in runs_of(codes, of):
                d = int(of[s])
                found[d].append((s - int(offsets[d]), n, q))
            rows = [_report(d, words, t, f) for d, t, f in zip(ids, takes, found)]
            return dict(zip(_COLUMNS, map(list, zip(*rows)))) if rows else {c: [] for c in _COLUMNS}

        return each

    return per_batch(make, pa.schema(list(_COLUMNS.items())))


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """The runs of every text of docs (doc_id, text), a row each.

    doc_id, n_words, n_runs; start, length, period, exponent_milli of the run with the greatest length /
    period (ties: smallest start, then period; nulls without a run); runs_sha256 of all runs, and
    collapsed_sha256 of the words left when each run keeps its first period. Words are
    [^\\x20\\x09-\\x0D]+ of the whole text; a null or empty text has none. Rows with a repeated or null id
    have a row each; other columns are ignored. With plant, a tenth of texts get a run first (planted),
    by their id; a null id gets none.
    """
    return docs.select("doc_id", "text").mapInArrow(_each(plant), _SCHEMA)


def collapsed(docs: DataFrame) -> DataFrame:
    """docs with each run in text cut to its first period; a changed text has single spaces, others stay as they are."""

    def run(batches):
        for batch in batches:
            words, offsets = words_of(batch["text"])
            codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(len(batch)), np.diff(offsets))
            by_text: dict[int, list] = {}
            for s, n, q in runs_of(codes, of):
                d = int(of[s])
                by_text.setdefault(d, []).append((s - int(offsets[d]), n, q))
            texts = batch["text"].to_pylist()
            for d, found in by_text.items():
                a, b = int(offsets[d]), int(offsets[d + 1])
                texts[d] = b" ".join(words.take(pa.array(a + collapse(b - a, found))).to_pylist()).decode("utf-8", "replace")
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, after a run is planted in a tenth of them; see periodic_runs."""
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)
