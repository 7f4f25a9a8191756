import hashlib
import random

import numpy as np
import pytest

from tidelake.llm import suffix_dedup as s


def test_suffix_array():
    rng = random.Random(13)
    for _ in range(2000):
        t = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(40))]
        assert s.suffix_array(np.array(t, np.int64)) == sorted(range(len(t)), key=lambda i: t[i:])


def brute(rows):
    """rows: (doc_id, text) in order."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        hit = bytearray(len(data))
        for i in range(len(data) - 99):
            w = data[i : i + 100]
            if w in seen:
                hit[i : i + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(b for b, h in zip(data, hit) if not h)
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((doc_id, len(data), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(rng):
    piece = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared = [piece(rng.randrange(60, 400)) for _ in range(8)]
    line = piece(70)
    out = []
    for i in range(250):
        parts = [piece(rng.randrange(120)) for _ in range(rng.randrange(4))] + [rng.choice(shared) for _ in range(rng.randrange(3))]
        if i % 3 == 0:
            parts += [rng.choice("xyz") + line + rng.choice("xyz")]
        if i % 11 == 0:
            parts += [rng.choice(["-" * 300, "ab" * 150, piece(17) * 20])]
        rng.shuffle(parts)
        out.append("".join(parts))
    return out + [out[0], out[5], "", "x" * 99, "x" * 100, "x" * 100, "long " * 3000]


@pytest.mark.parametrize("crowd,symbols", [(1500, 200_000), (5, 300)])
def test_spans_match_brute_force(spark, crowd, symbols):
    rng = random.Random(14)
    rows = list(enumerate(texts(rng)))
    got = s.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), crowd, symbols)
    assert sorted(map(tuple, got.drop("spans").collect()), key=str) == brute(rows)


def test_owners_follow_batches():
    """Any cut into batches gives the same rows, with crowds and without."""
    import pyarrow as pa

    rng = random.Random(15)
    rows = sorted((rng.randrange(12) ** 2 // 12, rng.randrange(6), rng.randrange(50), 1 << 16 | rng.randrange(3), 0) for _ in range(300))
    want = None
    for size in (300, 1, 2, 7, 50):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size])], schema=s._ROWS) for i in range(0, len(rows), size)]
        got = [r for b in s._meet(iter(batches), 3) for r in zip(*(b[c].to_pylist() for c in s._ROWS.names))]
        cover = {(r[2], x) for r in got if r[4] > 0 for x in range(r[3], r[4])}
        found = (sorted(r for r in got if r[4] <= 0), cover)
        want = want or found
        assert found == want
    contexts = {}
    for r in rows:
        contexts.setdefault(r[0], {}).setdefault(r[1], r)
    assert [r for r in want[0] if r[4] == 0] == sorted(r for m in contexts.values() if len(m) > 1 for r in m.values())
    assert [r[0] for r in want[0] if r[4] == -1] == sorted(o for o, m in contexts.items() if len(m) > 3)


def test_ids_null_or_repeated(spark):
    a, b = "".join(map(chr, range(33, 126))) * 2, "q" * 150
    rows = [(3, a), (3, a), (None, None), (None, b), (1, b), (3, b + a), (2, None), (2, "")]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    got = s.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.drop("spans").collect()), key=str) == brute(ordered)
    assert s.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
