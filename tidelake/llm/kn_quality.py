"""A quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Grams are of ORDER bytes of UTF-8, unfolded, in integers of 9 bits a symbol (0 stands before a text).
Trusted documents fall into two folds by their text's hash, and a document is scored by the model of
the other fold, so no text is scored by a model that has seen it, copies included, and every trusted
document counts for the thresholds.

Counts, continuation counts of lower orders, discounts and context sums are tables in Spark, keyed by
gram and fold and joined by shards; nothing but four counts of counts an order and fold reaches the
driver. Documents meet in lots of neighbouring rows, LOT_BYTES of text each, shuffled in compressed
pieces. A lot gives its distinct grams and its trusted texts' counts of them; all lots' grams are
resolved once (seen, or backed off order by order), and the answers meet the lot's texts again, where
each document's perplexity is summed.

A document is kept if its perplexity is at most its language's quantile among trusted documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import LOT, cut, lots, release, small_batches, table, text_bytes, written

#: Bits of a symbol: bytes are 1 to 256.
BITS, ORDER = 9, 5
SYMBOLS = 256
FOLDS = 2
#: Bytes of text of a lot, about; lots bound how often a gram is asked for, results don't depend on them.
LOT_BYTES = 1 << 26
#: Grams that a task counts before it hands them on.
HELD = 4_000_000
_FOLD_AT = BITS * ORDER
#: Turns a gram of one fold's model into the other's.
OTHER = 1 << _FOLD_AT


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The gram that ends at each byte; each text begins after ORDER - 1 zeros."""
    n, rows = len(data), len(offsets) - 1
    at = np.arange(n) + (ORDER - 1) * np.repeat(np.arange(1, rows + 1), np.diff(offsets))
    padded = np.zeros(n + (ORDER - 1) * rows, np.int64)
    padded[at] = data
    padded[at] += 1
    whole = padded.copy()
    for k in range(1, ORDER):
        whole[k:] |= padded[:-k] << (BITS * k)
    return whole[at]


def fold_of(text: str | Column) -> Column:
    """The fold of a text's document: 0 or 1."""
    return F.pmod(F.xxhash64(F.lit(29), text), F.lit(FOLDS)).cast("int")


def _pieces(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams with the model's number, offsets of rows), at once; a text over LOT bytes comes in pieces. A row's model is its column fold."""
    data, offsets = text_bytes(part["text"])
    fold = part["fold"].to_numpy(zero_copy_only=False).astype(np.int64) << _FOLD_AT
    if len(part) > 1 or len(data) <= LOT:
        yield grams(data, offsets) | np.repeat(fold, np.diff(offsets)), offsets
        return
    for at in range(0, len(data), LOT):
        lead = min(at, ORDER - 1)
        piece = data[at - lead : at + LOT]
        keys = grams(piece, np.array([0, len(piece)]))[lead:] | fold[0]
        yield keys, np.array([0, len(keys)])


class _Tally:
    """Distinct keys and their counts, merged lot by lot."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found = np.unique(keys, return_counts=True)
        self.parts.append(found)
        self.size += len(found[0])

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate([p[i] for p in self.parts]) if self.parts else np.zeros(0, np.int64) for i in (0, 1))
        whole, at = np.unique(keys, return_inverse=True)
        total = np.zeros(len(whole), np.int64)
        np.add.at(total, at, counts)
        self.parts, self.size = [(whole, total)], len(whole)
        return whole, total


_BUNDLED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("lang", pa.string()), ("text", pa.string()), ("fold", pa.int32())])


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lot, rows): a lot's rows (_BUNDLED) in compressed pieces."""
    for batch in batches:
        lot = batch["lot"].to_numpy()
        edges = (np.flatnonzero(np.diff(lot)) + 1).tolist()
        out: dict[str, list] = {"lot": [], "rows": []}
        for i, j in zip([0, *edges], [*edges, len(lot)]):
            if j > i:
                to = pa.BufferOutputStream()
                with pa.ipc.new_stream(to, _BUNDLED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_batch(batch.slice(i, j - i).select(_BUNDLED.names).cast(_BUNDLED))
                out["lot"].append(int(lot[i]))
                out["rows"].append(to.getvalue().to_pybytes())
        yield pa.RecordBatch.from_pydict(out, pa.schema([("lot", pa.int64()), ("rows", pa.binary())]))


def _opened(rows: pa.Array) -> Iterator[pa.RecordBatch]:
    """What _bundle put together, in lots of LOT bytes."""
    for row in rows:
        for some in pa.ipc.open_stream(row.as_buffer()):
            for a, b in lots(some["text"]):
                yield some.slice(a, b - a)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(lot, doc, rows) of the runs of rows of one lot and kind."""
    for batch in batches:
        lot, doc = batch["lot"].to_numpy(), batch["doc"].to_numpy(zero_copy_only=False)
        edges = (np.flatnonzero((np.diff(lot) != 0) | np.diff(doc)) + 1).tolist()
        for i, j in zip([0, *edges], [*edges, len(lot)]):
            if j > i:
                yield int(lot[i]), bool(doc[i]), batch.slice(i, j - i)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lot, gram, n): each lot's distinct grams, and how often its trusted texts have them.

    Rows come sorted by lot, first the numbers of its trusted rows, then its texts.
    """
    schema = pa.schema([("lot", pa.int64()), ("gram", pa.int64()), ("n", pa.int64())])
    now, marks, trusted, others = None, [], _Tally(), _Tally()

    def done() -> pa.RecordBatch:
        (keys, n), (more, _) = trusted.merge(), others.merge()
        more = np.setdiff1d(more, keys, assume_unique=True)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(keys) + len(more), now, np.int64), np.concatenate([keys, more]), np.concatenate([n, more * 0]))], schema=schema)

    for lot, doc, part in _parts(batches):
        if lot != now:
            if now is not None:
                yield done()
            now, marks, trusted, others = lot, [], _Tally(), _Tally()
        if not doc:
            marks.append(part["row"].to_numpy())
            continue
        flagged = np.concatenate(marks) if marks else np.zeros(0, np.int64)
        for some in _opened(part["rows"]):
            hit = np.isin(some["row"].to_numpy(), flagged)
            for tally, mask in ((trusted, hit), (others, ~hit)):
                for keys, _ in _pieces(some.filter(pa.array(mask))) if mask.any() else ():
                    tally.add(keys)
            if trusted.size + others.size > HELD and len(trusted.merge()[0]) + len(others.merge()[0]) > HELD // 2:
                yield done()
                trusted, others = _Tally(), _Tally()
    if now is not None:
        yield done()


def _order(df: DataFrame, k: int) -> Column:
    """The fold and last k symbols of gram."""
    return F.shiftleft(F.shiftright("gram", _FOLD_AT), _FOLD_AT).bitwiseOR(F.col("gram").bitwiseAND((1 << BITS * k) - 1))


def _context(k: int) -> Column:
    """The fold and first k - 1 of the last k symbols of gram."""
    return F.shiftleft(F.shiftright("gram", _FOLD_AT), _FOLD_AT).bitwiseOR(F.shiftright(F.col("gram").bitwiseAND((1 << BITS * k) - 1), BITS))


def _discounts(counts: DataFrame) -> list[list[float]]:
    """D1, D2, D3+ of each fold from its counts of counts; of absolute discounting where they are too few."""
    found = {(f, c): n for f, c, n in counts.where("c <= 4").groupBy(F.shiftright("gram", _FOLD_AT).cast("int"), "c").count().collect()}
    out = []
    for fold in range(FOLDS):
        n1, n2, n3, n4 = (found.get((fold, i), 0) for i in range(1, 5))
        if not (n1 and n2 and n3 and n4):
            out.append([0.5, 0.75, 0.75])
            continue
        y = n1 / (n1 + 2 * n2)
        ds = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        out.append([min(max(d, 0.05), i - 0.05) for i, d in enumerate(ds, 1)])
    return out


class Model:
    """Of each order 1 to ORDER: seen, (gram, p) of the grams with a count, and backoff, (gram, weight) of contexts."""

    def __init__(self, counts: DataFrame) -> None:
        """counts: gram (with the number of the model that counts it), c; only c > 0."""
        tables = {ORDER: counts}
        for k in range(ORDER - 1, 0, -1):  # how many different symbols come before the gram
            tables[k] = written(tables[k + 1].groupBy(_order(tables[k + 1], k).alias("gram")).agg(F.count("*").alias("c")))
        self.seen, self.backoff = {}, {}
        for k in range(1, ORDER + 1):
            discounts = _discounts(tables[k])
            by_fold = F.array(*(F.array(*map(F.lit, d)) for d in discounts))
            d = F.element_at(F.element_at(by_fold, F.shiftright("gram", _FOLD_AT).cast("int") + 1), F.least("c", F.lit(3)).cast("int"))
            keyed = tables[k].select("gram", "c", _context(k).alias("context"), d.alias("d"))
            sums = keyed.groupBy("context").agg(F.sum("c").alias("all"), F.sum("d").alias("held"))
            self.backoff[k] = written(sums.select(F.col("context").alias("gram"), (F.col("held") / F.col("all")).alias("weight"), "all"))
            met = keyed.join(self.backoff[k].withColumnRenamed("gram", "context"), "context")
            if k == 1:
                met = met.withColumn("below", F.lit(1.0 / SYMBOLS))
            else:
                met = met.withColumn("tail", _order(met, k - 1)).join(self.seen[k - 1].select(F.col("gram").alias("tail"), F.col("p").alias("below")), "tail")
            self.seen[k] = written(met.select("gram", ((F.col("c") - F.col("d")) / F.col("all") + F.col("weight") * F.col("below")).alias("p")))

    def p(self, asked: DataFrame, k: int = ORDER) -> DataFrame:
        """gram, p of every gram of asked (distinct): its own where it was seen, else its tail's, weighed by its context."""
        met = asked.join(self.seen[k], "gram", "left")
        if k == 1:
            known = met.join(self.backoff[1].select(F.col("gram").alias("context"), "weight"), F.col("context") == _context(1), "left")
            return known.select("gram", F.coalesce("p", F.coalesce("weight", F.lit(1.0)) / SYMBOLS).alias("p"))
        met = written(met)
        unseen = met.where("p is null").select("gram", _order(met, k - 1).alias("tail"), _context(k).alias("context"))
        tails = self.p(unseen.select(F.col("tail").alias("gram")).distinct(), k - 1)
        weighed = unseen.join(self.backoff[k].select(F.col("gram").alias("context"), "weight"), "context", "left")
        backed = weighed.join(tails.select(F.col("gram").alias("tail"), "p"), "tail")
        return met.where("p is not null").select("gram", "p").unionByName(backed.select("gram", (F.coalesce("weight", F.lit(1.0)) * F.col("p")).alias("p")))


_SCORED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_symbols", pa.int64()), ("nll", pa.float64())])


class _Answers:
    """Looks grams up: by a table of slots, and by halving where two grams share one."""

    def __init__(self, keys: np.ndarray, nll: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        self.keys, self.nll = keys[order], nll[order]
        bits = min(22, len(keys).bit_length() + 3)
        self.shift, self.slots = np.uint64(64 - bits), np.zeros(1 << bits, np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(keys)]
        other = np.flatnonzero(self.keys[at] != keys)
        at[other] = np.searchsorted(self.keys, keys[other])
        return self.nll[at]


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by lot, answers before documents; gives each document's mean surprise under the other fold's model."""
    now, held, answers = None, [], None
    for lot, doc, part in _parts(batches):
        if lot != now:
            now, held, answers = lot, [], None
        if not doc:
            held.append((part["gram"].to_numpy(), part["nll"].to_numpy()))
            continue
        if answers is None:
            keys, nll = map(np.concatenate, zip(*held)) if held else (np.zeros(0, np.int64), np.zeros(0, np.float32))
            answers, held = _Answers(keys, nll), []
        for rows in _opened(part["rows"]):
            n, total = np.zeros(len(rows), np.int64), np.zeros(len(rows))
            for keys, offsets in _pieces(rows):
                upto = np.concatenate([[0.0], np.cumsum(answers(keys ^ OTHER) if len(keys) else np.zeros(0), dtype=np.float64)])
                n += np.diff(offsets)
                total += upto[offsets[1:]] - upto[offsets[:-1]]
            yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["lang"], pa.array(n), pa.array(total / np.maximum(n, 1), mask=n == 0)], schema=_SCORED)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, file: Column | None = None, row: Column | None = None) -> DataFrame:
    """doc_id, lang, n_symbols (bytes), perplexity, threshold, kept of every row of docs.

    docs: doc_id, text, lang; labels: doc_id, quality (1: trusted). Empty and null texts have no
    perplexity and aren't kept. A null language is one of its own. A language without any trusted
    text takes the quantile of all trusted texts; without those there is no threshold and every
    text is kept. Repeated rows come as often as they do in docs; a repeated id that is trusted is
    trusted in all its rows.

    file, row: of each row of docs, and the same when docs is read again; by default docs is cut
    first and numbered as it lies.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), *([] if row is None else [file.alias("file"), row.alias("row")]))
    if row is None:
        rows = cut(rows).withColumns({"file": F.lit(0), "row": F.monotonically_increasing_id()})
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).head()
    in_lot = max(1, LOT_BYTES * n // max(1, size or 0))
    rows = rows.withColumns({"lot": F.xxhash64("file", F.floor(F.col("row") / in_lot)), "fold": fold_of("text")}).drop("file")
    ids = cut(labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct())
    null = lambda kind, name: F.lit(None).cast(kind).alias(name)
    texts = rows.select("lot", "row", "doc_id", "lang", "text", "fold").mapInArrow(_bundle, "lot long, rows binary").select("lot", F.lit(True).alias("doc"), "rows")
    # labels grow with the corpus; they meet rows without their texts
    marks = rows.select("doc_id", "lot", "row").join(ids.hint("merge"), "doc_id", "left_semi").select("lot", F.lit(False).alias("doc"), "row", null("binary", "rows"))
    met = marks.unionByName(texts.withColumn("row", null("long", "row"))).repartition("lot").sortWithinPartitions("lot", "doc")
    found = written(met.mapInArrow(_gather, "lot long, gram long, n long"))
    release(spark)
    every = written(found.groupBy("gram").agg(F.sum("n").alias("c")))
    model = Model(every.where("c > 0"))
    release(spark)
    # what the other fold's model says: bit _FOLD_AT is turned
    known = written(model.p(every.select(F.col("gram").bitwiseXOR(F.lit(OTHER)).alias("gram"))))
    del model
    release(spark)
    answers = found.select("lot", F.col("gram").bitwiseXOR(F.lit(OTHER)).alias("gram")).join(known, "gram")
    answers = answers.select("lot", F.lit(False).alias("doc"), "gram", (-F.log("p")).cast("float").alias("nll"), null("binary", "rows"))
    met = answers.unionByName(texts.withColumns({"gram": null("long", "gram"), "nll": null("float", "nll")})).repartition("lot").sortWithinPartitions("lot", "doc")
    scored = met.mapInArrow(_sum, "doc_id long, lang string, n_symbols long, nll double")
    scored = written(scored)
    held = scored.where("nll is not null").join(ids, "doc_id", "left_semi").select("lang", F.exp("nll").alias("perplexity"))
    cutoff = F.percentile_approx("perplexity", quantile, 10_000)
    limits = cut(held.groupBy("lang").agg(cutoff.alias("own")))
    common = held.agg(cutoff).head()[0]
    joined = scored.alias("s").join(limits.alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang")), "left")
    joined = joined.select("s.doc_id", "s.lang", "n_symbols", F.exp("nll").alias("perplexity"), F.coalesce("own", F.lit(common).cast("double")).alias("threshold"))
    return joined.withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.col("perplexity").isNotNull()))


def op9_kn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, threshold and verdict of every document; lots are runs of rows of a file."""
    docs = table(spark, sf_dir, "documents")
    return classify(docs, table(spark, sf_dir, "labels"), file=F.col("_metadata.file_path"), row=F.col("_metadata.row_index"))
