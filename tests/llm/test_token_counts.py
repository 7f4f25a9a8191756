import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidelake.llm import token_counts as t
from tidelake.llm.packing import VOCABULARY

PATH = public_tokenizers.path(VOCABULARY)


def texts():
    rng = random.Random(13)
    parts = ["word ", "the", " ", "  ", "\n", "\n \n", "don't", "'re", "12", "!?", "é", "中文", "🙂", "<|endoftext|>", "<|endof", "text|>", "\x1c", "\xa0", "a" * 30]
    mixed = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 900))) for _ in range(60)]
    one_word = ["x" * 5000, "中" * 3000, " " * 4000, "ab" * 100 + " some words here " * 40 + "z" * 1500 + " and more words" * 60, "!" * 700 + "<|endoftext|>" * 200]
    return ["", "a", *mixed, *one_word]


def counted(rows):
    return sorted(((r.doc_id if r.doc_id is not None else -1), r.n_bytes, r.n_tokens, r.over_limit) for r in rows)


@pytest.mark.parametrize("chunk, overlap", [(200, 60), (301, 100), (1 << 16, 256)])
def test_counts_are_those_of_whole_texts(spark, chunk, overlap):
    plain = Tokenizer.from_file(PATH)
    rows = [*enumerate(texts()), (7, None), (None, "null id " * 200), (5, "twice " * 100), (5, "twice " * 100)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, uid string, n_bytes int")
    want = []
    for doc_id, text in rows:
        n = len(plain.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id if doc_id is not None else -1, len((text or "").encode()), n, n > 100))
    assert counted(t.token_counts(frame, limit=100, chunk=chunk, overlap=overlap).collect()) == sorted(want)
    assert t.token_counts(frame.limit(0), chunk=chunk, overlap=overlap).count() == 0


def test_an_overlap_within_one_word_is_widened_and_then_its_cut_dropped():
    data = memoryview(b"a" * 1000)
    assert t.cuts(data, 200, 50, {}) == [(200, 50), (400, 50), (600, 50), (800, 50)]
    assert t.cuts(data, 200, 50, {400: 150}) == [(200, 50), (400, 150), (600, 50), (800, 50)]
    assert t.cuts(data, 200, 50, {400: 200, 800: 800}) == [(200, 50), (600, 50)]
    assert t.cuts(memoryview("中".encode() * 100), 100, 20, {}) == [(99, 20), (198, 20)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_are_not_cut(spark, name):
    path = public_tokenizers.path(name)
    assert t.splits(PATH) and not t.splits(path)
    text = "Some words, and some more. " * 40
    if name.endswith(".json"):
        want = len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    else:
        from sentencepiece import SentencePieceProcessor

        want = len(SentencePieceProcessor(model_file=path).encode(text))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert t.token_counts(frame, path, chunk=100, overlap=30).collect()[0].n_tokens == want
