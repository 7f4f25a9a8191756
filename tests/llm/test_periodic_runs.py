import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from tidelake.llm import periodic_runs as p


def brute(words):
    """Every run of words, by definition."""
    out, n = set(), len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            if len(part) >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.add((i, len(part), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def report(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        q = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % q] for i, w in enumerate(words)]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    said = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, n, len(found), *said, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(kept))


def cases():
    rng = random.Random(11)
    out = ["", " \t\n", "a", "a a a a a", "a a a a a a", "a b " * 4 + "a", "a b " * 3 + "a", "x " + "a a b " * 5 + "a y", "ab " * 40 + "c " + "d e f " * 9]
    for size in (2, 3, 5, 40):
        for _ in range(60):
            words = [rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP"[:size]) for _ in range(rng.randrange(1, 90))]
            if rng.random() < 0.6:
                unit = words[: rng.randrange(1, 9)]
                words[rng.randrange(len(words)) :] = unit * rng.randrange(3, 8) + unit[: rng.randrange(len(unit) + 1)] + words[:5]
            out.append(rng.choice([" ", "\n", "  \t"]).join(words) + rng.choice(["", " ", " é中"]))
    return out


def test_runs_are_those_of_the_definition():
    for text in cases():
        words = text.split()
        codes = np.unique(words, return_inverse=True)[1].astype(np.int64) if words else np.zeros(0, np.int64)
        assert p.runs_of(codes, np.zeros(len(codes), np.int64)) == brute(words), text
        assert p.scan(codes) == brute(words), text  # splitting loses nothing and adds nothing


def test_prose_leaves_no_segment_to_scan():
    rng = np.random.default_rng(2)
    codes = (rng.zipf(1.3, 20000) % 5000).astype(np.int64)
    starts, ends = p.segments(codes, np.zeros(len(codes), np.int64))
    assert (ends - starts).sum() <= len(codes)
    assert p.runs_of(codes, np.zeros(len(codes), np.int64)) == p.scan(codes)


def test_query_rows_are_those_of_the_definition(spark):
    rows = [*enumerate(cases()), (5, None), (None, "a a a a a a a"), (3, "a b a b a b a b"), (3, "a b a b a b a b"), (10, "w " * 3000)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_runs int, start string")
    key = lambda r: tuple((x is not None, x) for x in r)
    for plant in (True, False):
        got = [tuple(r) for r in p.periodic_runs(frame, plant).collect()]
        assert sorted(got, key=key) == sorted((report(*r, plant) for r in rows), key=key)
    assert p.periodic_runs(frame.limit(0)).count() == 0
    texts = {r.doc_id: r.text for r in p.collapsed(frame.where("doc_id in (3, 10)")).collect()}
    assert texts[10] == "w" and texts[3] == "a b" and p.collapsed(frame.limit(0)).count() == 0


def test_a_long_text_with_few_words_is_scanned(spark):
    rng = random.Random(4)
    text = " ".join(rng.choice("ab") for _ in range(40000)) + " c d" * 30000 + " zzzz" * 20
    got = p.periodic_runs(spark.createDataFrame([(2, text)], "doc_id long, text string")).collect()[0]
    assert got.n_words == 100020 and got.length == 60000 and got.period == 2 and got.n_runs > 500
