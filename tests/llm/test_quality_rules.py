import random
import re
from math import comb

from tidelake.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit)


def test_measures_match_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "a b\x1cc", "x\n\nx\n x\n", "one two three four five one two three four five"]
    for _ in range(200):
        texts.append("".join(rng.choice(["a", "b", " ", "\n", " ", "#", "é", "A"]) for _ in range(rng.randrange(120))))
    for t in texts:
        assert q.measures(t)[:5] == brute(t), repr(t)


def test_most_errors_is_the_exact_bound():
    cdf = lambda n, p, k: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    for n, risk, level in ((50, 0.1, 0.05), (300, 0.02, 0.01), (20, 0.02, 0.01), (400, 0.05, 0.001), (0, 0.1, 0.05)):
        k = q.most_errors(n, risk, level)
        assert k < 0 or cdf(n, risk, k) <= level
        assert k >= n or cdf(n, risk, k + 1) > level


def test_rules_reject_junk_and_keep_good(spark):
    rng = random.Random(2)
    words = ["w%d" % i for i in range(500)]
    rows, labels = [], []
    for i in range(1200):
        text = " ".join(rng.choice(words) for _ in range(60))
        rows.append((i, text, ["en", None][i % 2]))
        labels.append((i, 1))
    for i in range(1200, 1240):
        rows.append((i, " ".join(rng.choice(words) + "%%%" for _ in range(60)), ["en", None][i % 2]))
        labels.append((i, 0))
    rows += [(None, None, "xx"), (5000, "", "xx"), (5001, "a b", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = q.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert sum(not kept[i] for i in range(1200)) <= 1200 * 0.08
    assert not any(kept[i] for i in range(1200, 1240))
    assert not kept[None] and not kept[5000] and not kept[5001]


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, " ".join("abcdefghijklm"), "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.kept for r in q.judge(docs, none).collect()] == [True]
    assert q.judge(docs.limit(0), none).count() == 0
