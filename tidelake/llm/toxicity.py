"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of labelled rows (EXAMPLES of each class at most, by hash). Terms are
all words of the examples, and those word beginnings that the labels single out; document
frequencies are counted over all documents. Terms that the labels don't single out weigh PLAIN as
much, since else the many words that say nothing about toxicity decide who is near. Examples are
weighed by TF-IDF, normed and ordered by class and direction into blocks. The index has dense rows
for the DENSE commonest terms and postings for the others, and each dense term's largest weight of
each block. A search adds up the postings and those maxima to a bound for each block, scores blocks
from the highest bound on, and leaves out those whose bound can't beat the K-th best, so the
neighbours are exactly the K nearest.

Near examples vote with weights that fall with distance. Votes become scores by isotonic
calibration on examples left out of their own vote; a text without any word of an example gets the
rate of all labelled rows. Neighbours are handed on as evidence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import crc_of_id, cut, give_back, lots, per_batch, table

#: Bound of the labelled sample: rows of each class.
EXAMPLES = 4000
#: How many of the commonest terms have dense rows in the index; a layout that results don't depend on.
DENSE = 256
BLOCK = 128
K = 15
#: Blocks that a search scores at a time, and texts that are searched together.
TOGETHER = 16
TEXTS = 64
#: More than a cosine in single precision can be off: a sum of DENSE products of numbers up to 1, of 6e-8 each.
ERROR = 5e-5
#: Word beginnings of so many characters are terms, and whole words.
HEADS = range(3, 9)
LEAST = 4
#: What parts words: a word is a run of letters, digits and underscores.
BETWEEN = r"[^\pL\pN_]+"
#: Weight of a term that the labels don't single out, where one that they do weighs 1 + log(n / df).
PLAIN = 0.1
TELLING = 3.0


#: Terms, their counts and the root of the summed squares of all other words' counts.
Encoded = tuple[np.ndarray, np.ndarray, float]


def terms_of(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in HEADS if len(word) > n)]


def doc_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text, word, times) of each text's words, sorted by text, and the words by number, in lower case.

    Texts are split at blanks first, and only the different pieces at all else that parts words.
    """
    pieces = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    row = np.repeat(np.arange(len(texts)), pieces.value_lengths().to_numpy(zero_copy_only=False))
    coded = pieces.flatten().dictionary_encode()
    split = pc.split_pattern_regex(coded.dictionary, BETWEEN)
    n, inner = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), split.flatten().dictionary_encode()
    words, of = inner.dictionary, inner.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    piece = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row, word = np.repeat(row, n[piece]), of[_runs((np.cumsum(n) - n)[piece], n[piece])]
    row, word = row[real[word]], word[real[word]]
    pairs, times = np.unique(row * max(1, len(words)) + word, return_counts=True)
    return pairs // max(1, len(words)), pairs % max(1, len(words)), times, words


def _runs(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... of each run, one after another."""
    return np.repeat(begin - np.cumsum(length) + length, length) + np.arange(length.sum())


def _term_rows():
    def each(batch: pa.RecordBatch) -> dict:
        terms, toxic = [], []
        row, word, _, words = doc_words(batch["text"])
        words, begins = words.to_pylist(), np.searchsorted(row, np.arange(len(batch) + 1)).tolist()
        for i, label in enumerate(batch["toxic"].to_pylist()):
            found = {t for w in word[begins[i] : begins[i + 1]].tolist() for t in terms_of(words[w])}
            terms += found
            toxic += [label] * len(found)
        return {"term": terms, "toxic": pa.array(toxic, pa.int32())}

    return each


def pick_terms(sample: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """The terms of the examples, and which of them are telling.

    Terms are all words and the telling beginnings. Telling are those in LEAST examples or more whose
    rate of toxic ones is above all examples' by a z-score of TELLING. Of telling beginnings that the
    same numbers of examples have, one being the other's beginning, the longest stands for all.
    """
    sizes = dict(sample.groupBy("toxic").count().collect())
    n, bad = sum(sizes.values()), sizes.get(1, 0)
    p = bad / max(1, n)
    rows = sample.mapInArrow(per_batch(_term_rows, pa.schema([("term", pa.string()), ("toxic", pa.int32())])), "term string, toxic int")
    z = (F.col("bad") - p * F.col("n")) / F.sqrt(p * (1 - p) * F.col("n") + 1)
    scored = rows.groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).withColumn("telling", (F.col("n") >= LEAST) & (z >= TELLING))
    found = scored.where(F.col("telling") | F.col("term").endswith("$")).select("term", "n", "bad", "telling").toArrow().combine_chunks()
    some = found.filter(found["telling"])  # few, unlike the words
    telling = set(zip(*(some[c].to_pylist() for c in ("term", "n", "bad"))))
    longer = {(t[:i], n, b) for t, n, b in telling for i in range(min(HEADS), len(t))}
    kept = pa.array([t for t, n, b in telling if t.endswith("$") or (t, n, b) not in longer], pa.string())
    plain = found.filter(pc.and_not(pc.ends_with(found["term"], "$"), found["telling"]))["term"].combine_chunks()
    terms = pa.concat_arrays([x.cast(pa.string()) for x in (kept, plain)])
    order = pc.sort_indices(terms)
    return terms.take(order), order.to_numpy() < len(kept)


class Encoder:
    """Texts' terms and their counts, and what a text's other words add to its norm."""

    def __init__(self, terms: pa.Array | list[str]) -> None:
        self.terms = terms if isinstance(terms, pa.Array) else pa.array(terms, pa.string())
        whole, length = pc.ends_with(self.terms, "$"), pc.utf8_length(self.terms)
        #: (length of beginnings, or 0 for whole words; what they are; their places among terms)
        self.known = []
        for n in (0, *HEADS):
            place = pc.indices_nonzero(whole if not n else pc.and_(pc.invert(whole), pc.equal(length, n)))
            if not n or len(place):
                some = self.terms.take(place)
                self.known.append((n, some if n else pc.utf8_slice_codeunits(some, 0, -1), place.to_numpy().astype(np.int64)))

    @property
    def at(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.terms.to_pylist())}

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, length, terms): a word's terms are a run of terms."""
        word, term = [], []
        for n, known, ids in self.known:
            some = words if not n else pc.if_else(pc.greater(pc.utf8_length(words), n), pc.utf8_slice_codeunits(words, 0, n), pa.scalar(None, pa.string()))
            place = pc.fill_null(pc.index_in(some, value_set=known, skip_nulls=True), -1).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(place >= 0)
            word.append(hit)
            term.append(ids[place[hit]])
        word, term = np.concatenate(word), np.concatenate(term)
        order = np.argsort(word, kind="stable")
        length = np.bincount(word, minlength=len(words)) if len(words) else np.zeros(0, np.int64)
        return np.cumsum(length) - length, length, term[order]

    def lot(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(begins, terms, tf, rest): text i's terms are terms[begins[i]:begins[i + 1]]."""
        row, word, times, words = doc_words(texts)
        begin, length, terms = self._of_words(words)
        k = length[word]
        lone = k == 0
        rest = np.sqrt(np.bincount(row[lone], times[lone].astype(float) ** 2, len(texts)))
        size = len(self.terms) + 1
        pairs, back = np.unique(np.repeat(row, k) * size + terms[_runs(begin[word], k)], return_inverse=True)
        tf = np.bincount(back, np.repeat(times, k), len(pairs))
        return np.searchsorted(pairs // size, np.arange(len(texts) + 1)), pairs % size, tf, rest

    def all(self, texts: pa.Array) -> list[Encoded]:
        out = []
        for a, b in lots(texts):
            begins, terms, tf, rest = self.lot(texts.slice(a, b - a))
            out += [(terms[i:j], tf[i:j], r) for i, j, r in zip(begins[:-1].tolist(), begins[1:].tolist(), rest.tolist())]
        return out

    def __call__(self, text: str | None) -> Encoded:
        return self.all(pa.array([text], pa.string()))[0]


class Index:
    """Examples as a block-max inverted index; search is exact."""

    def __init__(self, encoded: list[Encoded], labels: np.ndarray, ids: np.ndarray, size: int, weights: np.ndarray | None = None) -> None:
        """weights: of each term and, last, of other words; by default from the examples alone."""
        n, self.size = len(encoded), size + 1
        df = np.zeros(self.size, np.int64)
        for found, _, rest in encoded:
            df[found] += 1
            df[size] += rest > 0
        self.weights = np.append(np.log((1 + n) / (1 + df[:size])) + 1, PLAIN) if weights is None else weights
        rows = [self.vector(e) for e in encoded]
        lead = np.array([t[np.argmax(w)] if len(t) else size for t, w in rows], np.int64)
        order = np.lexsort((ids, lead, labels))
        self.labels, self.ids = labels[order], ids[order]
        self.n, self.blocks = n, -(-n // BLOCK)
        lengths = [len(rows[i][0]) for i in order.tolist()]
        terms, w = (np.concatenate([np.zeros(0, kind), *(rows[i][part] for i in order.tolist())]) for part, kind in enumerate((np.int64, float)))
        places = np.repeat(np.arange(n), lengths)
        common = np.argsort(-df, kind="stable")[:DENSE]
        common = common[df[common] > 0]
        #: a common term's row, or -1
        self.row = np.full(self.size, -1)
        self.row[common] = np.arange(len(common))
        #: the common terms' weights in each example, from which cosines are taken in the end
        self.exact = np.zeros((n, len(common)))
        row = self.row[terms]
        here = row >= 0
        self.exact[places[here], row[here]] = w[here]
        #: the same in single precision, block by block; the last block is filled up
        self.dense = np.zeros((self.blocks, BLOCK, len(common)), np.float32)
        self.dense[places[here] // BLOCK, places[here] % BLOCK, row[here]] = w[here]
        self.most = self.dense.max(axis=1).T if n else np.zeros((len(common), 0))
        #: postings of the other terms: those of t are begins[t] to begins[t + 1]
        terms, places, w = terms[~here], places[~here], w[~here]
        by_term = np.argsort(terms, kind="stable")
        self.places, self.posted = places[by_term].astype(np.int32), w[by_term]
        self.begins = np.searchsorted(terms[by_term], np.arange(self.size + 1))

    def vector(self, encoded: Encoded) -> tuple[np.ndarray, np.ndarray]:
        t, tf, rest = encoded
        if rest:
            t, tf = np.append(t, self.size - 1), np.append(tf, rest)
        w = tf * self.weights[t]
        norm = math.sqrt(float(w @ w))
        return t, w / norm if norm else w

    def nearest(self, encoded: Encoded, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        return self.nearest_of([encoded], k, [skip])[0]

    def nearest_of(self, encoded: list[Encoded], k: int, skips: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places, cosines) of the k nearest of each, ties by place; skips are the places to leave out.

        Blocks are scored TOGETHER at a time, from each text's highest bound on, as long as they can
        still have one of the k nearest, in single precision. Who
        may be among the k nearest within ERROR, which is more than that can be off, is scored anew
        in double precision.
        """
        m, width = len(encoded), self.blocks * BLOCK
        vectors = [self.vector(e) for e in encoded]
        of = np.repeat(np.arange(m), [len(t) for t, _ in vectors])
        terms, w = (np.concatenate([v[i] for v in vectors]) for i in (0, 1))
        row = self.row[terms]
        dense, rare = row >= 0, np.flatnonzero(row < 0)
        exact = np.zeros((m, len(self.most)))
        exact[of[dense], row[dense]] = w[dense]
        common = exact.astype(np.float32)
        edge = np.searchsorted(of[rare], np.arange(m + 1)).tolist()
        posted = np.zeros((m, width))
        for r, (i, j) in enumerate(zip(edge, edge[1:])):  # one text at a time: a long one has many postings
            t, x = terms[rare[i:j]], w[rare[i:j]]
            length = self.begins[t + 1] - self.begins[t]
            at = _runs(self.begins[t], length)
            posted[r] = np.bincount(self.places[at], np.repeat(x, length) * self.posted[at], width)
        score = posted.astype(np.float32)
        score[:, self.n :] = -1e9
        for r, skip in enumerate(skips or []):
            if skip >= 0:
                score[r, skip] = -1e9
        bound = common @ self.most + score.reshape(m, self.blocks, BLOCK).max(axis=2, initial=-1e9)
        turn = np.argsort(-bound, axis=1, kind="stable")
        done, kth = np.zeros((m, self.blocks), bool), np.full((m, 1), -1e9)
        for first in range(0, self.blocks, TOGETHER):
            now = np.zeros_like(done)
            np.put_along_axis(now, turn[:, first : first + TOGETHER], True, axis=1)
            now &= bound + ERROR >= kth
            if not now.any():
                break
            for b in np.flatnonzero(now.any(axis=0)).tolist():
                some = np.flatnonzero(now[:, b])
                score[some, b * BLOCK : (b + 1) * BLOCK] += common[some] @ self.dense[b].T
            done |= now
            # weights aren't negative: in blocks not scored yet, what the postings add up to is a lower bound
            kth = np.partition(score, width - k, axis=1)[:, width - k, None] if width > k else kth
        score.reshape(m, self.blocks, BLOCK)[~done] = -1e9
        out = []
        for r in range(m):
            places = np.flatnonzero((score[r] >= kth[r] - ERROR) & (score[r] > -1))
            cosines = posted[r, places] + self.exact[places] @ exact[r]
            best = np.lexsort((places, -np.round(cosines, 12)))[:k]
            out.append((places[best], cosines[best]))
        return out


#: Distances are 1 - cosine; a vote weighs 1 / (distance + NEAR).
NEAR = 0.01


def vote(labels: np.ndarray, cosines: np.ndarray) -> float:
    weight = 1 / (np.maximum(0, 1 - cosines) + NEAR)
    return float(weight @ labels / weight.sum()) if len(labels) else 0.0


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, rate) of the weighed non-decreasing fit of y over x (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    stack: list[list[float]] = []  # [weighed sum of y, weight, last x]
    for a, b, w in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist()):
        stack.append([b * w, w, a])
        while len(stack) > 1 and (stack[-2][0] * stack[-1][1] >= stack[-1][0] * stack[-2][1] or stack[-2][2] == stack[-1][2]):
            s, n, last = stack.pop()
            stack[-1] = [stack[-1][0] + s, stack[-1][1] + n, last]
    return np.array([s[2] for s in stack]), np.array([s[0] / s[1] for s in stack])


class Model:
    """Everything that scoring needs; of bounded size."""

    def __init__(self, encoder: Encoder, weights: np.ndarray, rows: list[tuple[int, int, Encoded]], rate: float) -> None:
        """rows: doc_id, label and what Encoder gives. rate: of toxic rows among all labelled ones,
        to which the sample's classes are weighed back.
        """
        self.encoder, self.rate = encoder, rate
        labels = np.array([y for _, y, _ in rows], float)
        share = labels.mean() if rows else 0.0
        weight = np.where(labels == 1, rate / share, (1 - rate) / (1 - share)) if 0 < share < 1 else np.ones(len(rows))
        self.index = Index([e for *_, e in rows], labels, np.array([i for i, *_ in rows], np.int64), len(weights) - 1, weights)
        where = {i: p for p, i in enumerate(self.index.ids.tolist())}
        votes = []
        for at in range(0, len(rows), TEXTS):
            some = rows[at : at + TEXTS]
            found = self.index.nearest_of([e for *_, e in some], K, [where[i] for i, *_ in some])
            votes += [vote(self.index.labels[near], cosines) for near, cosines in found]
        self.x, self.y = isotonic(np.array(votes), labels, weight) if rows else (np.zeros(1), np.array([rate]))

    def __call__(self, texts: pa.Array | list[str | None]) -> list[tuple[float, list[int], list[float]]]:
        """score, and ids and cosines of the neighbours it rests on, of each text."""
        out = []
        encoded = self.encoder.all(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        for at in range(0, len(encoded), TEXTS):
            for near, cosines in self.index.nearest_of(encoded[at : at + TEXTS], K):
                if not len(near) or cosines[0] <= 0:
                    out.append((self.rate, [], []))
                    continue
                v = vote(self.index.labels[near], cosines)
                fit = float(self.y[min(int(np.searchsorted(self.x, v)), len(self.y) - 1)])
                out.append((min(1.0, max(0.0, 0.98 * fit + 0.02 * v)), self.index.ids[near].tolist(), cosines.tolist()))
        return out


def _encode(shared):
    def make():
        encoder = Encoder(shared.value)

        def each(batch: pa.RecordBatch) -> dict:
            found = encoder.all(batch["text"])
            return {"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": [f[0].astype(np.int32).tobytes() for f in found], "tf": [f[1].astype(np.float32).tobytes() for f in found], "rest": [f[2] for f in found]}

        return each

    return per_batch(make, pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("terms", pa.binary()), ("tf", pa.binary()), ("rest", pa.float64())]))


def _in_documents(shared):
    """Of a task's texts: how many there are (term -1) and how many have each term."""

    def run(batches):
        encoder, batch = Encoder(shared.value), None
        df, n = np.zeros(len(encoder.terms), np.int64), 0
        for batch in batches:
            for a, b in lots(batch["text"]):
                df += np.bincount(encoder.lot(batch["text"].slice(a, b - a))[1], minlength=len(df))
                n += b - a
        del batch
        give_back()
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.append(-1, seen).astype(np.int32), "n": np.append(n, df[seen])}, pa.schema([("term", pa.int32()), ("n", pa.int64())]))

    return run


def document_weights(docs: DataFrame, shared, telling: np.ndarray) -> np.ndarray:
    """Each term's weight by its document frequency in docs, and last that of words that no example has."""
    found = docs.where("text is not null").select("text").mapInArrow(_in_documents(shared), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    terms, n = found["term"].to_numpy(), found["n"].to_numpy()
    df = np.zeros(len(telling) + 1)
    df[terms[terms >= 0]] = n[terms >= 0]
    total = n[terms < 0].sum()
    return (np.log((1 + total) / (1 + df)) + 1) * np.where(np.append(telling, False), 1.0, PLAIN)


def train(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    """A model of at most `examples` labelled rows of each class, the first by a hash of doc_id.

    Rows whose crc32(doc_id) mod 4 is 2 are held out. Null labels, ids and texts train nothing; a
    doc_id labelled or written more than once counts once (its largest label, its least text). The
    driver gets the examples' terms and counts, which are bounded by the sample.
    """
    learn = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_of_id("doc_id") % 4 != 2))
    learn = cut(learn.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    sizes = dict(learn.groupBy("toxic").count().collect())
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    mixed = F.xxhash64("doc_id", F.lit(17))
    first = lambda label: learn.where(F.col("toxic") == label).orderBy(mixed, "doc_id").limit(examples)
    chosen = first(0).unionByName(first(1))  # 2 * examples rows at most
    sample = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    sample = cut(sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    terms, telling = pick_terms(sample)
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    weights = document_weights(docs, shared, telling)
    rows = sample.mapInArrow(_encode(shared), "doc_id long, toxic int, terms binary, tf binary, rest double").orderBy("doc_id").toArrow().to_pylist()
    shared.unpersist()
    return Model(Encoder(terms), weights, [(r["doc_id"], r["toxic"], (np.frombuffer(r["terms"], np.int32), np.frombuffer(r["tf"], np.float32), r["rest"])) for r in rows], rate)


def _score(shared):
    def make():
        model = shared.value

        def each(batch: pa.RecordBatch) -> dict:
            found = model(batch["text"])
            return {"doc_id": batch["doc_id"], "score": [f[0] for f in found], "evidence": [[{"doc_id": i, "cosine": c} for i, c in zip(*f[1:])] for f in found]}

        return each

    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))
    return per_batch(make, pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", evidence)]))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (the nearest examples) for every row of docs.

    docs: doc_id, text; labels: doc_id, toxic (0 or 1). Whole texts are scored. Null and empty texts
    get the rate of toxic rows among the labelled ones; a null doc_id is scored and not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, examples))
    found = docs.select("doc_id", "text").mapInArrow(_score(shared), "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double>>")
    held = F.coalesce(crc_of_id("doc_id") % 4 == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def _keep(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = part = None
        for batch in batches:
            for a, b in lots(batch["text"]):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array([f[0] < threshold for f in shared.value(part["text"])], pa.bool_()))
        del batch, part
        give_back()

    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """docs without the rows whose score reaches threshold; all other rows and all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return docs.mapInArrow(_keep(shared, threshold), docs.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document, and the nearest example (the contract's digest columns)."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted", F.get("evidence", 0)["doc_id"].alias("nearest"))
