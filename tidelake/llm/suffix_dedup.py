"""Exact removal of repeated substrings with suffix arrays built by linear grouping.

A byte is removed if a string of LENGTH bytes over it also starts earlier in the corpus. Texts are
too many for one suffix array, so strings that can be equal are brought together first: each window
of LENGTH bytes is owned by the ANCHOR-byte string in it with the least hash (the leftmost of
equals), which equal windows share. Neighbouring windows with one owner form a context. Equal
contexts meet by hash; all but the first are covered whole. Contexts that share their owner but
are not equal are fetched, and the suffix array of their texts shows which windows agree.

The suffix array is built by grouping (`suffix_array`): suffixes are grouped by their Lyndon
prefixes, groups are taken in descending order, each moving the suffixes that its members'
previous-smaller pointers name; then each group's order is emitted in one pass, with no recursion
and no renaming. The owner that a group of contexts shares is one symbol of its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import cut, lots, release, table, text_bytes

LENGTH, ANCHOR = 100, 32
#: Owners with more different contexts than this are compared window by window, spread by hash.
CROWD = 1500
#: Symbols in one suffix array, about.
SYMBOLS = 200_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def suffix_array(text: np.ndarray) -> list[int]:
    """Starts of text's suffixes in order. Linear: each suffix is moved once for each pointer to it."""
    n = len(text) + 1
    t = np.empty(n, np.int64)
    t[:-1] = text
    t[-1] = int(t[:-1].min(initial=0)) - 1  # ends every suffix, smaller than all
    order = np.argsort(t, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], t[order][1:] != t[order][:-1]]))
    sizes = np.diff(np.append(starts, n))
    group, place, size = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
    group[order], place[order], size[starts] = np.repeat(starts, sizes), np.arange(n), sizes
    sa, group, place, size = order.tolist(), group.tolist(), place.tolist(), size.tolist()
    smaller = [-1] * n
    top = n - 1
    while top > 0:  # groups in descending order; a group is named by its first place
        g = group[sa[top]]
        if g == top:
            s = sa[top]
            j = s - 1
            while j >= 0 and group[j] >= g:
                j = smaller[j]
            smaller[s] = j
            if j >= 0:
                old = group[j]
                if (z := size[old]) > 1:
                    end, k = old + z - 1, place[j]
                    if k != end:
                        other = sa[end]
                        sa[end], sa[k], place[j], place[other] = j, other, end, k
                    group[j], size[end], size[old] = end, 1, z - 1
            top = g - 1
            continue
        named: dict[int, int] = {}
        for s in sorted(sa[g : top + 1]):
            j = s - 1
            while j >= 0 and group[j] > g:
                j = smaller[j]
            if j >= 0 and group[j] == g:  # a run of members: they share what comes before
                j = smaller[j]
            smaller[s] = j
            if j >= 0:
                named[j] = named.get(j, 0) + 1
        by_times: dict[int, dict[int, list[int]]] = {}
        for j, times in named.items():
            by_times.setdefault(times, {}).setdefault(group[j], []).append(j)
        for times in sorted(by_times, reverse=True):
            parts = by_times[times]
            if len(by_times) > 1:  # groups may have been split by a larger count
                flat = [j for js in parts.values() for j in js]
                parts = {}
                for j in flat:
                    parts.setdefault(group[j], []).append(j)
            for old, js in parts.items():
                z = size[old]
                if len(js) == z:
                    continue
                end = old + z
                for j in js:
                    end -= 1
                    k, other = place[j], sa[end]
                    if other != j:
                        sa[end], sa[k], place[j], place[other] = j, other, end, k
                for j in js:
                    group[j] = end
                size[end], size[old] = len(js), z - len(js)
        top = g - 1
    out, free, placed = [-1] * n, list(range(n)), bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = smaller[j]
    return out[1:]


def _slide(op, x: np.ndarray, width: int) -> np.ndarray:
    """op over every run of width values."""
    n = 1
    while 2 * n <= width:
        x, n = op(x[:-n], x[n:]), 2 * n
    return op(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, owner's hash, its start, first window, last window), starts within the row, of all contexts."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(data) < LENGTH:
        return none
    h, n, i = (data.astype(np.uint64) + np.uint64(1)) * _ODD[0], 1, 1
    h ^= h >> np.uint64(29)
    while n < ANCHOR:
        h, n, i = h[:-n] * _ODD[i] + h[n:], 2 * n, i + 1
    h ^= h >> np.uint64(32)
    h *= _ODD[i]
    h ^= h >> np.uint64(29)
    keyed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
    owner = (_slide(np.minimum, keyed, LENGTH - ANCHOR + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(owner)]
    owner[np.arange(len(owner)) + LENGTH > offsets[row + 1]] = -1  # would cross a text's end
    begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    end = np.append(begin[1:], len(owner)) - 1
    real = owner[begin] >= 0
    begin, end = begin[real], end[real]
    p, r = owner[begin], row[begin]
    return r, h[p].view(np.int64), p - offsets[r], begin - offsets[r], end - offsets[r]


def merged(key: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The unions of intervals of each key that overlap or touch."""
    order = np.lexsort((start, key))
    key, start, stop = key[order], start[order], stop[order]
    if not len(key):
        return key, start, stop
    rank = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]).astype(np.int64)])) << 40
    reach = np.maximum.accumulate(rank + stop)
    new = np.concatenate([[True], rank[1:] + start[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return key[first], start[first], reach[np.append(first[1:], len(key)) - 1] - rank[first]


#: at: start of the owner << 16 | bytes from the first window to it << 8 | windows after the first.
_ROWS = pa.schema([("owner", pa.int64()), ("same", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("stop", pa.int64())])
_DDL = "owner long, same long, doc long, at long, stop long"
#: stop of rows that aren't intervals: a context, or the size of a crowd.
CONTEXT, CROWDED = 0, -1


def _first_of_each(a, b, doc, at) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows sorted by (a, b, doc, at) and which of them begin a new (a, b)."""
    order = np.lexsort((at, doc, b, a))
    x, y = a[order], b[order]
    return order, np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])[: len(order)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of texts, each hash once in a lot, and intervals that the lot itself shows to be covered."""
    for batch in batches:
        for a, b in lots(batch["text"]):
            part = batch.slice(a, b - a)
            data, offsets = text_bytes(part["text"])
            row, owner, p, first, last = contexts(data, offsets)
            whole, base = data.tobytes(), offsets[row]
            ends = (base + last + LENGTH).tolist()
            digest = xxhash.xxh3_64_intdigest
            same = np.array([digest(whole[i:j], k) for i, j, k in zip((base + first).tolist(), ends, (p - first).tolist())], np.uint64).view(np.int64)
            doc = part["doc"].to_numpy(zero_copy_only=False)[row] if len(row) else np.zeros(0, np.int64)
            at = (p << 16) | ((p - first) << 8) | (last - first)
            order, new = _first_of_each(owner, same, doc, at)
            kept, again = order[new], order[~new]
            key, start, stop = merged(doc[again], first[again], last[again] + LENGTH)
            yield pa.RecordBatch.from_pydict(
                {
                    "owner": np.concatenate([owner[kept], key * 0x9E3779B1 + start]),  # intervals ride along, spread
                    "same": np.concatenate([same[kept], np.zeros(len(key), np.int64)]),
                    "doc": np.concatenate([doc[kept], key]),
                    "at": np.concatenate([at[kept], start]),
                    "stop": np.concatenate([np.full(len(kept), CONTEXT), stop]),
                },
                schema=_ROWS,
            )


def _window_span(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of a context."""
    first = (at >> 16) - ((at >> 8) & 255)
    return first, first + (at & 255) + LENGTH


class _Owners:
    """Follows sorted contexts from batch to batch; keeps one row and a count, however large an owner is."""

    def __init__(self, crowd: int) -> None:
        self.crowd = crowd
        self.owner = self.same = self.waiting = None
        self.count = 0  # different contexts of the current owner

    def close(self) -> list[tuple]:
        """The CROWDED row of the current owner, if it has so many contexts."""
        crowd = [tuple(np.array([x], np.int64) for x in (self.owner, 0, 0, 0, CROWDED))] if self.count > self.crowd else []
        self.waiting, self.count = None, 0
        return crowd

    def batch(self, owner, same, doc, at) -> list[tuple]:
        out = []
        goes_on = owner[0] == self.owner
        if not goes_on:
            out += self.close()
        new_owner = np.concatenate([[not goes_on], owner[1:] != owner[:-1]])
        new = new_owner | np.concatenate([[same[0] != self.same], same[1:] != same[:-1]])
        start, end = _window_span(at[~new])
        key, start, end = merged(doc[~new], start, end)
        out.append((key, key, key, start, end))
        group = np.cumsum(new_owner) - new_owner[0]  # 0: the owner that the batch begins with
        sizes = np.bincount(group[new], minlength=group[-1] + 1)
        sizes[0] += self.count
        send = new & (sizes[group] > 1)
        if self.waiting is not None and sizes[0] > 1:
            out.append(self.waiting)
            self.waiting = None
        out.append((owner[send], same[send], doc[send], at[send], np.full(int(send.sum()), CONTEXT)))
        for g in np.flatnonzero(sizes[:-1] > self.crowd).tolist():
            out.append(tuple(np.array([x], np.int64) for x in (owner[np.searchsorted(group, g)], 0, 0, 0, CROWDED)))
        if group[-1] > 0:
            self.waiting = None
        self.count = int(sizes[-1])
        if self.count == 1 and (lone := np.flatnonzero(new & (group == group[-1]))).size:
            self.waiting = tuple(x[lone] for x in (owner, same, doc, at)) + (np.full(1, CONTEXT),)
        self.owner, self.same = owner[-1], same[-1]
        return out


def _meet(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (owner, same, doc, at). Gives intervals, the first of each context of
    owners that have several, and a CROWDED row for owners that have more than crowd."""
    owners = _Owners(crowd)
    for batch in batches:
        columns = [batch[c].to_numpy() for c in _ROWS.names]
        plain = columns[-1] > 0
        out = [tuple(x[plain] for x in columns)]
        if not plain.all():
            out += owners.batch(*(x[~plain] for x in columns[:-1]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], schema=_ROWS)
    if last := owners.close():
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in last[0]], schema=_ROWS)


_FETCHED = pa.schema([("owner", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("crowded", pa.bool_()), ("bytes", pa.binary())])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, wanted) -> the bytes of each wanted context."""
    for batch in batches:
        for a, b in lots(batch["text"]):
            part = batch.slice(a, b - a)
            out: list[tuple] = []
            for doc, text, wanted in zip(*(part[c].to_pylist() for c in ("doc", "text", "wanted"))):
                data = text.encode()
                for w in wanted:
                    at = w["at"]
                    first = (at >> 16) - ((at >> 8) & 255)
                    out.append((w["owner"], doc, at, w["crowded"], data[first : first + (at & 255) + LENGTH]))
            yield pa.RecordBatch.from_pydict(dict(zip(_FETCHED.names, map(list, zip(*out)))) if out else {c: [] for c in _FETCHED.names}, schema=_FETCHED)


_COVERED = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def covered(owner: np.ndarray, doc: np.ndarray, at: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, stop) of windows that an earlier window of the same owner equals, merged.

    Contexts of one owner are neighbours. Their texts are one text, in which the owner's bytes, and
    those beside them that all of an owner's contexts share, are one symbol that stands for the owner.
    A window is then a string of what is left of it; equal windows also begin as far before the owner.
    """
    left = ((at >> 8) & 255).tolist()
    edges = np.append(np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])), len(owner)).tolist()
    parts, starts, befores, widths, members = [], [], [], [], []
    base = 0
    for number, (lo, hi) in enumerate(zip(edges, edges[1:])):
        mine = range(lo, hi)
        tails, heads = [texts[i][left[i] + ANCHOR :] for i in mine], [texts[i][: left[i]][::-1] for i in mine]
        shared_right, shared_left = (len(commonprefix([min(x), max(x)])) for x in (tails, heads))
        symbol = np.array([257 + number], np.int64)
        for i, tail, head in zip(mine, tails, heads):
            rest = np.frombuffer(head[shared_left:][::-1], np.uint8).astype(np.int64) + 1
            parts += [rest, symbol, np.frombuffer(tail[shared_right:], np.uint8).astype(np.int64) + 1, _END]
            before = left[i] - np.arange((int(at[i]) & 255) + 1)  # bytes of each window before the owner
            kept = np.maximum(before - shared_left, 0)
            starts.append(base + len(rest) - kept)
            widths.append(kept + 1 + np.maximum(LENGTH - ANCHOR - before - shared_right, 0))
            befores.append(before)
            members.append(np.full(len(before), i))
            base += len(rest) + 2 + len(tail) - shared_right
    whole = np.concatenate(parts)
    start, before, width, member = map(np.concatenate, (starts, befores, widths, members))
    rank = np.empty(len(whole), np.int64)
    rank[np.array(suffix_array(whole), np.int64)] = np.arange(len(whole))
    order = np.lexsort((rank[start], before))
    start, before, width, member = (x[order] for x in (start, before, width, member))
    most = LENGTH - ANCHOR + 1
    strings = np.lib.stride_tricks.sliding_window_view(np.concatenate([whole, np.zeros(most, np.int64)]), most)
    equal = [np.zeros(0, bool)]
    for k in range(0, len(start) - 1, 20_000):
        a, b = slice(k, min(k + 20_000, len(start) - 1)), slice(k + 1, min(k + 20_000, len(start) - 1) + 1)
        same = (strings[start[b]] == strings[start[a]]) | (np.arange(most) >= width[a, None])
        equal.append(same.all(1) & (before[a] == before[b]))
    run = np.concatenate([[0], np.cumsum(~np.concatenate(equal))])
    where = (at[member] >> 16) - before
    back = np.lexsort((where, doc[member], run))
    run, d, w = run[back], doc[member][back], where[back]
    first = np.maximum.accumulate(np.where(np.concatenate([[True], run[1:] != run[:-1]]), np.arange(len(run)), 0))
    later = (d != d[first]) | (w != w[first])
    return merged(d[later], w[later], w[later] + LENGTH)


_END = np.zeros(1, np.int64)


def _compare(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[pa.RecordBatch]:
    """Contexts come sorted by owner; owners are compared in lots of so many symbols."""
    held: list[list] = [[], [], [], []]

    def done(n: int) -> pa.RecordBatch:
        owner, doc, at = (np.array(x[:n], np.int64) for x in held[:3])
        found = covered(owner, doc, at, held[3][:n])
        for x in held:
            del x[:n]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=_COVERED)

    size = 0
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("owner", "doc", "at", "bytes"))):
            if size >= symbols and row[0] != held[0][-1]:
                yield done(len(held[0]))
                size = 0
            for x, v in zip(held, row):
                x.append(v)
            size += len(row[3]) - ANCHOR + 2
    if held[0]:
        yield done(len(held[0]))


_WINDOWS = pa.schema([("owner", pa.int64()), ("same", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of a crowded owner's contexts by hash, each hash once a batch, and intervals of the others."""
    for batch in batches:
        owner, doc, at = (batch[c].to_numpy() for c in ("owner", "doc", "at"))
        texts = batch["bytes"].to_pylist()
        n = (at & 255) + 1
        same = np.array([xxhash.xxh3_64_intdigest(t[k : k + LENGTH]) for t, m in zip(texts, n.tolist()) for k in range(m)], np.uint64).view(np.int64)
        owner, doc = np.repeat(owner, n), np.repeat(doc, n)
        start = np.repeat(_window_span(at)[0], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        order, new = _first_of_each(owner, same, doc, start)
        kept, again = order[new], order[~new]
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))][~new] if len(order) else again
        again = again[(doc[again] != doc[head]) | (start[again] != start[head])]
        key, a, b = merged(doc[again], start[again], start[again] + LENGTH)
        zero = np.zeros(len(key), np.int64)
        cols = [np.concatenate(x) for x in ((owner[kept], key), (same[kept], zero), (doc[kept], key), (start[kept], a), (np.zeros(len(kept), np.int64), b))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], schema=_WINDOWS)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, spans) -> the merged spans and what is left."""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in _DONE.names}
        for doc, text, spans in zip(*(batch[c].to_pylist() for c in ("doc", "text", "spans"))):
            data = (text or "").encode()
            spans = spans or []
            start, stop = (np.array([s[k] for s in spans], np.int64) for k in ("start", "stop"))
            _, start, stop = merged(np.zeros(len(spans), np.int64), start, stop)
            edges = [0, *(x for ab in zip(start.tolist(), stop.tolist()) for x in ab), len(data)]
            kept = hashlib.sha256()
            for a, b in zip(edges[::2], edges[1::2]):
                kept.update(data[a:b])
            for c, v in zip(_DONE.names, (doc, len(data), int((stop - start).sum()), len(start), kept.hexdigest(), [{"start": int(a), "stop": int(b)} for a, b in zip(start, stop)])):
                out[c].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=_DONE)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_DONE = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", _SPANS)])
_DONE_DDL = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>"


def _numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """doc_id, text, doc, where doc is unique and orders rows as doc_id does; and whether they had to be numbered.

    doc is doc_id where ids are unique and not null. Otherwise rows are numbered in the order of
    doc_id (null first), then text; of equal rows each has its own number.
    """
    rows = docs.select("doc_id", "text")
    ids = rows.groupBy("doc_id").count()
    odd = ids.where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return rows.withColumn("doc", F.col("doc_id")), False
    rows = cut(rows.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))
    part = F.spark_partition_id().alias("part")
    sizes = dict(rows.groupBy(part).count().collect())  # a row per partition
    ahead, total = {}, 0
    for p in sorted(sizes):
        ahead[p], total = total, total + sizes[p]
    first = F.element_at(F.create_map(*(x for p, n in ahead.items() for x in (F.lit(p), F.lit(n)))), F.spark_partition_id())
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return cut(rows.withColumn("doc", (first + within).cast("long"))), True


def dedup(docs: DataFrame, crowd: int = CROWD, symbols: int = SYMBOLS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed, in bytes) of every row of docs (doc_id, text).

    A null text is empty. Matches never cross texts. Rows that share a doc_id, or have none, are
    texts of their own, in the order of _numbered. Texts under LENGTH bytes lose nothing.
    """
    spark = docs.sparkSession
    rows, numbered = _numbered(docs)
    scanned = rows.select("doc", "text").mapInArrow(_scan, _DDL)
    met = cut(scanned.repartition("owner").sortWithinPartitions("owner", "same", "doc", "at").mapInArrow(lambda batches: _meet(batches, crowd), _DDL))
    del scanned
    release(spark)
    crowds = met.where(F.col("stop") == CROWDED).select("owner").distinct().withColumn("crowded", F.lit(True))
    asked = met.where(F.col("stop") == CONTEXT).join(crowds, "owner", "left")
    wanted = asked.groupBy("doc").agg(F.collect_list(F.struct("owner", "at", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("wanted"))
    fetched = cut(rows.select("doc", "text").join(wanted.hint("merge"), "doc").select("doc", "text", "wanted").mapInArrow(_fetch, "owner long, doc long, at long, crowded boolean, bytes binary"))
    release(spark)
    compared = fetched.where(~F.col("crowded")).repartition("owner").sortWithinPartitions("owner").mapInArrow(lambda batches: _compare(batches, symbols), "doc long, start long, stop long")
    windows = fetched.where("crowded").mapInArrow(_windows, "owner long, same long, doc long, start long, stop long")
    windows = cut(windows)
    firsts = windows.where("stop = 0").groupBy("owner", "same").agg(F.min(F.struct("doc", "start")).alias("first"))
    later = windows.where("stop = 0").join(firsts, ["owner", "same"]).where(F.struct("doc", "start") != F.col("first"))
    spans = (
        met.where("stop > 0").select("doc", F.col("at").alias("start"), "stop")
        .unionAll(compared)
        .unionAll(windows.where("stop > 0").select("doc", "start", "stop"))
        .unionAll(later.select("doc", "start", (F.col("start") + LENGTH).alias("stop")))
    )
    gathered = cut(spans.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans")))
    release(spark)
    joined = rows.join(gathered.hint("merge"), "doc", "left")
    found = joined.select("doc", "text", "spans").mapInArrow(_finish, _DONE_DDL)
    found = found.join(rows.select("doc", "doc_id"), "doc") if numbered else found.withColumn("doc_id", F.col("doc"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("spans")


OP5_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT doc_id, b, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, s, array_slice(b, s + 1, s + 100) AS x FROM n, LATERAL (SELECT unnest(generate_series(0, n - 100)) AS s) WHERE n >= 100),
f AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, s) > 1),
g AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS new FROM f),
h AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g),
sp AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS z FROM h GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, z FROM sp UNION ALL SELECT doc_id, -1, 0 FROM n),
keep AS (SELECT doc_id, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS e FROM cuts),
kept AS (SELECT doc_id, string_agg(hex(array_slice(b, a + 1, coalesce(e, n))), '' ORDER BY a) AS x FROM keep JOIN n USING (doc_id) WHERE coalesce(e, n) > a GROUP BY doc_id),
r AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM sp GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(x, ''))) AS kept_sha256
FROM n LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
