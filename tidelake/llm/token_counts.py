"""Token counts of texts of any length, by overlap resynchronisation.

A text of at most CHUNK bytes is encoded whole. A longer one is cut every CHUNK bytes, and each chunk
is encoded on its own, anywhere on the cluster, with the first bytes of the chunk after it: an overlap
that both chunks have encoded. The library gives the offset of every token and the word it belongs to.
A place where a word begins in both encodings of an overlap is stable, and there the two are spliced:

- Words are found from left to right without looking back, so a scan depends only on where it begins.
  The left chunk's words are those of the whole text up to its end, but for a margin of the longest
  special token and three characters, beyond which the cut may change what a word looks ahead to.
- The right chunk's scan, once it begins a word where the whole text does, goes on as the whole text.

An overlap without such a place (it lies in one word) is widened and its text is encoded again, until
it reaches the next cut; then its cut is dropped, and the two chunks are one.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import LOT, per_batch, table, written
from tidelake.llm.packing import Tokens, default_vocabulary

CHUNK = 1 << 16
#: Bytes of the first overlap, and how many times wider the next one is.
OVERLAP, WIDER = 256, 16
LIMIT = 1024

_COUNTS = "doc_id long, n_bytes long, n_tokens long"
_COUNTS_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
_CHUNKS = "uid long, at long, width long, next long, next_width long, piece binary"
_CHUNKS_ARROW = pa.schema([(c, pa.int64()) for c in ("uid", "at", "width", "next", "next_width")] + [("piece", pa.binary())])
_ENDS = "uid long, tail long, seams array<struct<at: long, width: long, place: long, n: long>>"
_SEAM = pa.struct([(c, pa.int64()) for c in ("at", "width", "place", "n")])
_ENDS_ARROW = pa.schema([("uid", pa.int64()), ("tail", pa.int64()), ("seams", pa.list_(_SEAM))])


def _whole(path: str):
    """What counts the tokens of a whole text: the library's own count."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text, num_threads=1))
    if os.path.exists(path.removesuffix(".json") + ".tiktoken"):
        tokens = Tokens(path)  # the same ids from a rank table and a cache of words
        return lambda text: len(tokens(text)) // 4
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    return lambda text: len(plain.encode(text, add_special_tokens=False))


def splits(path: str) -> bool:
    """Whether stable places are proven for the vocabulary at path.

    That is so for byte-level BPE over the words of its pattern, without a normalizer, and with added
    tokens that take no blanks with them.
    """
    if not path.endswith(".json"):
        return False
    from tokenizers import Tokenizer, pre_tokenizers

    t = Tokenizer.from_file(path)
    plain = all(not (a.lstrip or a.rstrip or a.single_word) for a in t.get_added_tokens_decoder().values())
    kind = t.pre_tokenizer
    return plain and t.normalizer is None and isinstance(kind, pre_tokenizers.ByteLevel) and kind.use_regex and not kind.add_prefix_space


def _counted(path: str):
    def make():
        count = _whole(path)

        def each(batch: pa.RecordBatch) -> dict:
            texts = batch["text"].to_pylist()
            return {"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": [count(t) if t else 0 for t in texts]}

        return each

    return per_batch(make, _COUNTS_ARROW)


def cuts(data: memoryview, chunk: int, overlap: int, widths: dict[int, int]) -> list[tuple[int, int]]:
    """(place, width of overlap) of each cut, at starts of characters; widths has those that were widened.

    An overlap ends before the next cut and before the text; a cut whose overlap can't is dropped.
    """
    out: list[tuple[int, int]] = []
    for at in range((len(data) - 1) // chunk * chunk, 0, -chunk):
        at = _start(data, at)
        width = widths.get(at, overlap)
        if at + width < (out[-1][0] if out else len(data)) and at > 0:
            out.append((at, width))
    return out[::-1]


def _start(data: memoryview, at: int) -> int:
    """at, or the start of the character that at lies in."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for uid, marks, text in zip(batch["uid"].to_pylist(), batch["marks"].to_pylist(), batch["text"]):
                data = memoryview(text.as_buffer())
                at, width = 0, 0
                found = cuts(data, chunk, overlap, {m["at"]: m["width"] for m in marks or []})
                for to, wide in [*found, (len(data), 0)]:
                    piece = bytes(data[at : _start(data, to + wide)])
                    rows.append((uid, at, width, to, wide, piece))
                    size += len(piece)
                    at, width = to, wide
                    if size >= LOT:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHUNKS_ARROW)], schema=_CHUNKS_ARROW)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHUNKS_ARROW)], schema=_CHUNKS_ARROW)

    return run


def word_starts(encoding) -> list[tuple[int, int]]:
    """(character, tokens before it) of each word's first token."""
    words, offsets = encoding.word_ids, encoding.offsets
    return [(offsets[i][0], i) for i, w in enumerate(words) if i == 0 or w != words[i - 1]]


def _ends(path: str):
    """For mapInArrow: chunks to what is left of them: the last chunk's count, and the word starts in their overlaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        margin = 3 + max((len(a.content) for a in tokenizer.get_added_tokens_decoder().values()), default=0)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text = r["piece"].decode("utf-8", "replace")
                encoding = tokenizer.encode(text, add_special_tokens=False)
                starts, seams = word_starts(encoding), []
                if r["at"]:
                    wide = len(r["piece"][: r["width"]].decode("utf-8", "ignore"))
                    for place, n in starts:
                        if place > wide:
                            break
                        seams.append((r["at"], r["width"], place, -n))
                if r["next_width"]:
                    skip = len(r["piece"][: r["next"] - r["at"]].decode("utf-8", "replace"))
                    for place, n in reversed(starts):
                        if place < skip:
                            break
                        if place <= len(text) - margin:
                            seams.append((r["next"], r["next_width"], place - skip, n))
                rows.append((r["uid"], None if r["next_width"] else len(encoding), [dict(zip(("at", "width", "place", "n"), s)) for s in seams]))
            uid, tail, seams = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((uid, tail, seams), _ENDS_ARROW)], schema=_ENDS_ARROW)

    return run


def _long_counts(docs: DataFrame, path: str, chunk: int, overlap: int) -> list[DataFrame]:
    """uid, n_tokens of docs (uid, text): a table for each round, of the texts that were aligned in it."""
    spark, out = docs.sparkSession, []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = spark.createDataFrame([], "uid long, marks array<struct<at: long, width: long>>")
    while True:
        todo = docs.join(marks, "uid", "left" if not out else "inner")
        chunks = todo.select("uid", "marks", "text").mapInArrow(_cut(chunk, overlap), _CHUNKS)
        ends = written(chunks.repartition(parts, "uid", "at").mapInArrow(_ends(path), _ENDS))
        met = ends.select("uid", F.inline("seams")).groupBy("uid", "at", "width", "place").agg(F.count("*").alias("sides"), F.sum("n").alias("n"))
        first = F.min(F.when(F.col("sides") == 2, F.struct("place", "n")))
        seams = written(met.groupBy("uid", "at", "width").agg(first.alias("first")))
        wider = F.when(F.col("first").isNull(), F.col("width") * WIDER).otherwise(F.col("width"))
        by_text = seams.groupBy("uid").agg(
            F.bool_or(F.col("first").isNull()).alias("again"), F.sum("first.n").alias("n"), F.collect_list(F.struct("at", wider.alias("width"))).alias("marks")
        )
        tails = ends.where("tail is not null").select("uid", "tail")
        known = marks.withColumnRenamed("marks", "before")  # those of cuts that were dropped have no seam any more
        met = written(tails.join(by_text, "uid", "left").join(known, "uid", "left"))
        out.append(met.where("again is null or not again").select("uid", (F.col("tail") + F.coalesce("n", F.lit(0))).alias("n_tokens")))
        marks = met.where("again").select("uid", F.concat(F.coalesce("before", F.array()), "marks").alias("marks"))
        if marks.isEmpty():
            return out


def token_counts(
    docs: DataFrame, tokenizer_path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row of docs (doc_id, text).

    Tokens are those of the library for the vocabulary at tokenizer_path (tokenizers for .json,
    sentencepiece for .model), without added ones; special strings within a text count as that library
    takes them. A null text is empty and has none. Repeated rows and null ids have a row each; other
    columns are ignored. Executors read the vocabulary, at the same path. Texts over chunk bytes are cut
    where stable places are proven for the vocabulary, and else encoded whole.
    """
    path = tokenizer_path or default_vocabulary()
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    docs = docs.select("doc_id", size.alias("n_bytes"), "text")
    cutting = splits(path)
    found = (docs.where(F.col("n_bytes") <= chunk) if cutting else docs).mapInArrow(_counted(path), _COUNTS)
    if cutting:
        long = written(docs.where(F.col("n_bytes") > chunk).withColumn("uid", F.monotonically_increasing_id()))
        if not long.isEmpty():
            for part in _long_counts(long.select("uid", "text"), path, chunk, overlap):
                found = found.unionByName(long.select("uid", "doc_id", "n_bytes").join(part, "uid").drop("uid"))
    return found.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document; see token_counts."""
    return token_counts(table(spark, sf_dir, "documents"))
