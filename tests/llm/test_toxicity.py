import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidelake.llm import toxicity as t


def test_search_is_exact():
    rng = random.Random(11)
    terms = [f"t{i}" for i in range(40)]
    encoder = t.Encoder([x + "$" for x in terms])
    texts = [" ".join(rng.choice(terms + ["plain"] * 30) for _ in range(rng.randrange(5, 60))) for _ in range(400)]
    encoded = [encoder(x) for x in texts]
    index = t.Index(encoded, np.array([i % 2 for i in range(400)], float), np.arange(400), len(terms))

    def dense(e):
        out = np.zeros(index.size)
        at, w = index.vector(e)
        out[at] = w
        return out

    rows = {int(i): dense(encoded[int(i)]) for i in index.ids}
    matrix = np.array([rows[int(i)] for i in index.ids])
    for e in [encoder(" ".join(rng.choice(terms + ["x"] * 9) for _ in range(20))) for _ in range(60)]:
        near, cosines = index.nearest(e, 15)
        want = np.sort(matrix @ dense(e))[::-1][:15]
        assert np.allclose(np.sort(cosines)[::-1], want, atol=1e-9)
        assert len(set(near.tolist())) == 15


def test_isotonic():
    x, y = t.isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]), np.ones(5))
    assert x.tolist() == [1, 3, 4] and y.tolist() == [0, 0.5, 1]


def rows():
    rng = random.Random(12)
    words = ["w%d" % i for i in range(300)]
    out, labels = [], []
    for i in range(900):
        toxic = int(i % 6 == 0)
        text = [rng.choice(words) for _ in range(50)]
        if toxic:
            for _ in range(4):
                text[rng.randrange(50)] = rng.choice(["nastyxa", "nastyob", "foul"])
        out.append((i, " ".join(text), 0.5))
        labels.append((i, toxic))
    return out, labels


def test_held_out_rows_are_scored_right(spark):
    docs, labels = rows()
    docs += [(None, "foul foul foul", 0.1), (5000, None, 0.1), (5001, "", 0.1), (5001, "", 0.1), (5002, "foul " * 30000, 0.1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = t.score(frame, marks).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]) > 0.97
    assert not any(r.predicted for r in got if r.doc_id in (5000, 5001))
    learned = {e.doc_id for r in got for e in r.evidence}
    assert not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in learned)
    kept = t.drop_toxic(frame, marks)
    assert kept.columns == frame.columns and kept.count() == sum(not r.predicted for r in got)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in t.score(docs, none).collect()] == [0]
    assert t.score(docs.limit(0), none).count() == 0


def test_every_word_of_an_example_is_a_term(spark):
    docs, labels = rows()
    docs += [(7000 + i, f"lone{i} solo{i}", 0.5) for i in range(40)]  # examples whose words the labels don't single out
    labels += [(7000 + i, 0) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    model = t.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    trained = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(model.index.ids.tolist()) == trained
    texts = dict((i, x) for i, x, _ in docs)
    assert {w + "$" for i in trained for w in texts[i].split()} <= model.encoder.at.keys()
    one = next(i for i in trained if i >= 7000)
    (_, ids, cosines), (_, none, _) = model([texts[one], "unheard"])
    assert ids[0] == one and abs(cosines[0] - 1) < 1e-9 and none == []
    df = sum("w7" in x.split() for x in texts.values())  # over all documents, held-out ones too
    assert np.isclose(model.index.weights[model.encoder.at["w7$"]], t.PLAIN * (np.log((1 + len(docs)) / (1 + df)) + 1))


def brute_score(text, examples, weights, terms, rate, model):
    """A text's score by plain dictionaries: TF-IDF, all cosines, the K nearest, votes, calibration."""
    def vector(x):
        tf, rest = {}, 0
        for w, n in Counter(re.findall(r"[^\W]+", (x or "").lower())).items():
            of = [p for p in t.terms_of(w) if p in terms]
            rest += 0 if of else n * n
            for p in of:
                tf[p] = tf.get(p, 0) + n
        v = {p: n * weights[terms[p]] for p, n in tf.items()} | {None: math.sqrt(rest) * weights[-1]}
        norm = math.sqrt(sum(z * z for z in v.values()))
        return {p: z / norm for p, z in v.items()} if norm else {}

    mine = vector(text)
    found = sorted(((-round(sum(z * v.get(p, 0) for p, z in mine.items()), 12), place, y) for place, (v, y) in enumerate((vector(x), y) for x, y in examples)))[: t.K]
    if not found or found[0][0] >= 0:
        return rate
    near = [(1 / (max(0, 1 + c) + t.NEAR), y) for c, _, y in found]
    v = sum(w * y for w, y in near) / sum(w for w, _ in near)
    fit = next((y for x, y in zip(model.x, model.y) if x >= v - 1e-9), model.y[-1])
    return min(1, max(0, 0.98 * fit + 0.02 * v))


def test_whole_score_by_brute_force(spark):
    docs, labels = rows()
    docs += [(9000, None, 0.0), (9001, "unheard-of zzz", 0.0), (9002, "Foul, W7 w8!", 0.0), (9003, "", 0.0), (9004, "nastyxab\u00a0w1", 0.0)]
    frame, marks = spark.createDataFrame(docs, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model, texts, truth = t.train(frame, marks), {i: x for i, x, _ in docs}, dict(labels)
    examples = [(texts[i], truth[i]) for i in model.index.ids.tolist()]
    terms = model.encoder.at
    held = [i for i in texts if i >= 9000 or zlib.crc32(str(i).encode()) % 4 == 2][-60:]
    got = {r.doc_id: r for r in t.score(frame, marks).where(F.col("doc_id").isin(held)).collect()}
    for i in held:
        want = brute_score(texts[i], examples, model.index.weights, terms, model.rate, model)
        assert abs(got[i].score - want) < 1e-6, i
        assert got[i].predicted == (got[i].score >= 0.3)


def test_words_are_runs_of_letters_digits_and_underscores():
    row, word, times, words = t.doc_words(pa.array(["Ab-ab c_1\u2003é.É", None, "", " \t- ", "x" * 100000, "a a"]))
    names = words.to_pylist()
    assert [(int(r), names[w], int(n)) for r, w, n in sorted(zip(row, word, times), key=lambda z: (z[0], names[z[1]]))] == [
        (0, "ab", 2), (0, "c_1", 1), (0, "é", 2), (4, "x" * 100000, 1), (5, "a", 2),
    ]
