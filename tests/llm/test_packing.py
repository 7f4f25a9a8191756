import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidelake.llm import packing as p


def texts():
    rng = random.Random(3)
    alphabet = list("ab é\n\t .,'s!1ñ") + ["  ", " \n", "\xa0", "don't", "<|endoftext|>", "中文", "\x1c", " ", " "]
    return ["", "a", "a  b", "a   b \n c ", " x", "x ", "<|endoftext|> a"] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 400))) for _ in range(300)]


def test_ids_are_those_of_the_tokenizers_library():
    path = public_tokenizers.path(p.VOCABULARY)
    plain, ours = Tokenizer.from_file(path), p.Tokens(path)
    for t in texts():
        assert np.frombuffer(ours(t), np.uint32).tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_nnls_recovers_an_exact_mix():
    rng = np.random.default_rng(0)
    a = rng.random((20, 30))
    x = np.where(np.arange(30) % 5 == 0, 2.0, 0.0)
    assert np.allclose(a @ p.nnls(a, a @ x), a @ x, atol=1e-6)


def test_patterns_use_every_piece_once_and_fill_windows():
    rng = np.random.default_rng(1)
    for scale in (0, 1, 3, 4000):
        counts = rng.integers(0, scale + 1, p.LEVELS + 1)
        counts[0] = 0
        used, total = np.zeros_like(counts), 0
        for levels, times in p.patterns(counts):
            assert times > 0 and sum(levels) <= p.LEVELS
            total += times
            for v in levels:
                used[v] += times
        assert (used == counts).all()
        assert total <= 1.01 * first_fit(counts) + 1


def first_fit(counts):
    """Windows that first-fit decreasing (by free room) needs."""
    free, total = np.zeros(p.LEVELS + 1, np.int64), 0
    for v in range(p.LEVELS, 0, -1):
        n = int(counts[v])
        while n:
            room = next((r for r in range(v, p.LEVELS + 1) if free[r]), 0)
            if not room:
                free[p.LEVELS] += n
                total += n
                room = p.LEVELS
            k = min(n, int(free[room]))
            free[room] -= k
            free[room - v] += k
            n -= k
    return total


def test_pieces_and_places(spark):
    path = public_tokenizers.path(p.VOCABULARY)
    plain = Tokenizer.from_file(path)
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(7, None, "n"), (None, "long " * 9000, "n"), (900, "long " * 9000, "n"), (900, "long " * 9000, "n")]
    got = p.pack(spark.createDataFrame(rows, "doc_id long, text string, offset string")).collect()
    pieces = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for doc_id, text, _ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        mine = pieces[(doc_id, len(ids))]
        want = [(s, min(2048, len(ids) - s), zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes())) for s in range(0, len(ids), 2048)]
        assert all(w in mine for w in want) and len(mine) % len(want) == 0
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert p.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
