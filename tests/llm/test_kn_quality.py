import math
import random
from collections import Counter, defaultdict

import pytest

from tidelake.llm import kn_quality as k


def symbols_of(text):
    return [0] * (k.ORDER - 1) + [b + 1 for b in text.encode()]


def brute(texts):
    """p(last | before) of modified Kneser-Ney by its definition."""
    counts = {k.ORDER: Counter()}
    for t in texts:
        s = symbols_of(t or "")
        counts[k.ORDER].update(tuple(s[i - k.ORDER + 1 : i + 1]) for i in range(k.ORDER - 1, len(s)))
    for n in range(k.ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    ds = {}
    for n, c in counts.items():
        of = Counter(c.values())
        n1, n2, n3, n4 = (of[i] for i in range(1, 5))
        if n1 and n2 and n3 and n4:
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            ds[n] = [min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1)]
        else:
            ds[n] = [0.5, 0.75, 0.75]
    sums, held = defaultdict(int), defaultdict(float)
    for n, c in counts.items():
        for g, v in c.items():
            sums[g[:-1], n] += v
            held[g[:-1], n] += ds[n][min(v, 3) - 1]

    def p(g):
        n = len(g)
        if not n:
            return 1 / k.SYMBOLS
        h = (g[:-1], n)
        if h not in sums:
            return p(g[1:])
        v = counts[n].get(g, 0)
        return ((v - ds[n][min(v, 3) - 1]) if v else 0) / sums[h] + held[h] / sums[h] * p(g[1:])

    return p


def perplexities(spark, texts):
    """text -> perplexity under the model of the other fold, by the definition, and its fold."""
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    fold = {r.text: r.fold for r in frame.withColumn("fold", k.fold_of("text")).collect()}

    def of(trusted, text):
        p = of.models.setdefault(fold[text], brute([t for t in trusted if fold[t] != fold[text]]))
        s = symbols_of(text)
        return math.exp(-sum(math.log(p(tuple(s[i - k.ORDER + 1 : i + 1]))) for i in range(k.ORDER - 1, len(s))) / (len(s) - k.ORDER + 1))

    of.models = {}
    return of


def test_perplexity_thresholds_and_kept_match_the_definition(spark, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("aabbcd eÉ.") for _ in range(rng.randrange(1, 60))) for _ in range(90)] + ["é", "zzA qqq", "\0\0a"]
    docs = [(i, t, ["la", "xx", None, "few"][0 if i > 60 else i % 3 if i else 3]) for i, t in enumerate(texts)] + [(200, None, "la"), (201, "", "xx"), (202, texts[5], "none")]
    labels = [(i, int(i % 5 != 1)) for i in range(90)] + [(None, 1), (0, 1), (300, 1)]
    trusted = {i for i, q in labels if q and i is not None}
    learned = [t for i, t, _ in docs if i in trusted]
    of = perplexities(spark, texts)
    want = {i: of(learned, t) for i, t, _ in docs if t}
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in k.classify(frame, spark.createDataFrame(labels, "doc_id long, quality int"), 0.9).collect()}
    assert got.keys() == {i for i, *_ in docs}
    limit, pools = {}, defaultdict(list)
    for i, _, lang in docs:
        if i in trusted:
            pools[lang].append(got[i].perplexity)
    for lang, xs in pools.items():
        limit[lang] = sorted(xs)[math.ceil(0.9 * len(xs)) - 1]
    every = sorted(x for xs in pools.values() for x in xs)
    for i, t, lang in docs:
        assert got[i].threshold == pytest.approx(limit.get(lang, every[math.ceil(0.9 * len(every)) - 1]))
        if not t:
            assert got[i].perplexity is None and not got[i].kept
            continue
        assert got[i].perplexity == pytest.approx(want[i], rel=1e-4)
        assert got[i].kept == (got[i].perplexity <= got[i].threshold) and got[i].n_symbols == len(t.encode())
    monkeypatch.setattr(k, "LOT_BYTES", 200)
    monkeypatch.setattr(k, "HELD", 20)
    monkeypatch.setattr(k, "LOT", 7)  # texts come in pieces
    monkeypatch.setattr("tidelake.llm.common.LOT", 7)
    again = {r.doc_id: r for r in k.classify(frame, spark.createDataFrame(labels, "doc_id long, quality int"), 0.9).collect()}
    assert all(again[i].kept == r.kept and (r.perplexity is None or again[i].perplexity == pytest.approx(r.perplexity, rel=1e-6)) for i, r in got.items())


def test_probabilities_of_a_context_sum_to_one():
    p = brute(["abab cab", "é a b", ""])
    for context in ((0, 0, 0, 0), (98, 99, 98, 99), (5, 5, 5, 5), (0, 0, 98, 99)):
        assert sum(p((*context, s)) for s in range(1, k.SYMBOLS + 1)) == pytest.approx(1, rel=1e-6)


def test_junk_goes_and_clean_stays(spark):
    rng = random.Random(7)
    words = ["lorem", "ipsum", "dolor", "amet", "vita", "nota"]
    good = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(900)]
    bad = ["".join(rng.choice("#@%QXZ19!") for _ in range(200)) for _ in range(20)]
    rows = [(i, t, [None, "la"][i % 2], 0.5) for i, t in enumerate(good + bad)] + [(5000, None, "la", 0.0), (5001, "", "xx", 0.0), (None, good[0], "la", 0.0), (3, good[3], None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, 1) for i in range(900)] + [(1, 1)], "doc_id long, quality int")
    got = k.classify(docs, labels).collect()
    assert len(got) == len(rows)
    assert not any(r.kept for r in got if r.doc_id is not None and 900 <= r.doc_id < 920)
    assert sum(not r.kept for r in got if r.doc_id is not None and r.doc_id < 900) < 900 * 0.04
    assert not any(r.kept for r in got if r.doc_id in (5000, 5001))
    assert k.classify(docs, labels.limit(0)).where("kept").count() == len(rows) - 2
    assert k.classify(docs.limit(0), labels).count() == 0
