import random

import numpy as np
import xxhash

from tidelake.llm import simhash as s


def brute_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints):
    """prints: id -> fingerprint."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprints():
    for t in (None, "", " \n", "a", "A b", "É a\tB c", "x y z x y z x", "one two three " * 50):
        assert s.fingerprint(t) == brute_print(t)


def test_index_finds_all_links_and_no_others():
    rng = np.random.default_rng(8)
    for spread in (1, 3, 6):
        centers = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
        fps = np.concatenate([centers, centers ^ np.uint64(1)])
        for _ in range(spread):
            fps = np.concatenate([fps, fps ^ (np.uint64(1) << rng.integers(0, 64, len(fps)).astype(np.uint64))])
        fps = np.unique(fps)
        buckets = (fps % np.uint64(3)).astype(np.int64)
        index = s.GrayIndex(buckets, fps)
        got = set()
        for i, j in index.links():
            got |= {frozenset((int(index.fps[a]), int(index.fps[b]))) for a, b in zip(i, j)}
        d = np.bitwise_count(fps[:, None] ^ fps[None, :])
        a, b = np.nonzero((d <= 2) & (buckets[:, None] == buckets[None, :]))
        assert got == {frozenset((int(fps[x]), int(fps[y]))) for x, y in zip(a, b) if x < y}


def test_components_of_documents(spark, monkeypatch):
    rng = random.Random(9)
    base = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(200)) for _ in range(20)]
    rows = []
    for i in range(300):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "zz"
        rows.append((i, " ".join(words), 1))
    rows += [(900, None, 1), (901, "", 1), (902, " \t", 1), (903, "Hello", 1), (903, "Hello", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    monkeypatch.setattr(s, "table", lambda *_: docs)
    got = s.op8_simhash(spark, "").collect()
    want = brute_components({i: brute_print(t) for i, t, _ in rows})
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want[r.doc_id]
    prints = {i: brute_print(t) for i, t, _ in rows}
    assert all(r.fingerprint == f"{prints[r.doc_id]:016x}" for r in got)
    assert sorted(r.doc_id for r in s.keep_first(docs).collect()) == sorted(set(want.values()))
    assert s.group(docs.limit(0)).count() == 0


def test_chain_is_one_component(spark):
    fps = [(1 << (2 * i)) - 1 for i in range(32)]
    edges = s.components(s.links(spark.createDataFrame([(x,) for x in fps], "fp long"))).collect()
    assert {r.node for r in edges} == set(fps) and {r.root for r in edges} == {0}


def test_rows_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (1, "a b c d")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in s.group(docs).collect()) == [(-1, -1), (-1, 1), (-1, 1), (1, 1)]
    assert sorted((r.doc_id or -1, r.text) for r in s.keep_first(docs).collect()) == [(-1, "q r s t u"), (1, "a b c d")]


def test_hot_buckets_are_dealt_again(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = 0x1234_5678_0000_0000
    fps = sorted({base | int(x) for x in rng.integers(0, 1 << 32, 150)} | {(base | int(x)) ^ (1 << int(b)) for x, b in zip(rng.integers(0, 1 << 12, 150), rng.integers(0, 32, 150))})
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    whole = {tuple(r) for r in s.components(s.links(frame)).collect()}
    monkeypatch.setattr(s, "HOT", 10)
    assert {tuple(r) for r in s.components(s.links(frame)).collect()} == whole and whole


def test_each_group_keeps_one_row_whatever_its_ids(spark):
    rows = [(1, "a b c d", {"k": 1}, 5), (1, "q r s t u", {"k": 2}, 6), (2, "q r s t u", None, 7), (1, "a b c d", {"k": 3}, 5), (None, "z z z y", None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, __content int")
    kept = s.keep_first(docs).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == [(-1, "z z z y"), (1, "a b c d"), (1, "q r s t u")]
    assert [r.tags for r in kept if r.text == "a b c d"] == [{"k": 1}]
    assert {r["__content"] for r in kept} == {5, 6, 8}
