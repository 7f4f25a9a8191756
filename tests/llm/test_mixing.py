import re
from collections import Counter, defaultdict

import numpy as np

from tidelake.llm import mixing as m


def share(sizes):
    """Shares by weight, stopping at 3 times the size and sharing the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        for s in over or open_:
            target[s] = 3.0 * sizes[s] if over else level * weight[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def rows():
    rng = np.random.default_rng(4)
    out = []
    for i in range(600):
        source = ["big", "mid", None, "tiny", "é", ""][0 if i % 3 == 0 else i % 6]
        if source == "tiny" and i > 30:
            source = "big"
        out.append((i, " ".join(["w"] * int(rng.integers(0, 40))), source, i))
    return out + [(0, None, "big", 1), (None, "a\tb\x0bc", "mid", 2), (5, "x y", "nul", 3), (5, "x y", "nul", 3), (6, "", "void", 0)]


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_targets_and_taken_words(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string, size long")
    totals = Counter()
    for _, t, s, _ in rows():
        totals[s] += size(t)
    want = share(totals)
    got = m.weigh(docs).collect()
    assert len(got) == len(rows())
    assert sorted((r.doc_id or -1, r["size"]) for r in got) == sorted((i or -1, size(t)) for i, t, *_ in rows())
    by = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        by[(r.source_size, round(r.target, 6))] += r.taken
    groups = defaultdict(float)
    for s in totals:
        groups[(totals[s], round(want[s], 6))] += want[s]
    assert set(by) == set(groups)
    for k in by:
        assert abs(by[k] - groups[k]) <= 2
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, m.weigh(docs.repartition(3)).collect()), key=str)


def test_mix_takes_the_words_weighed(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string, size long")
    mixed = m.mix(docs, shards=4)
    assert mixed.columns == docs.columns
    taken = sum(r.taken for r in m.weigh(docs).collect())
    assert sum(size(r.text) for r in mixed.collect()) == taken
    assert mixed.where("doc_id = 6").count() >= 1
    assert m.mix(docs.limit(0)).count() == 0 and m.weigh(docs.limit(0)).count() == 0


def test_tree_keeps_quotas_and_evens_shards(spark):
    quotas = np.array([1000, 37, 0, 411])
    below = m.split_node(quotas, 1, 3, 1)
    shares = np.array([held for _, held in below])
    assert [n for n, _ in below] == list(range(8, 16))
    assert (shares.sum(axis=0) == quotas).all() and (shares >= 0).all()
    assert np.ptp(shares.sum(axis=1)) <= 1
    drawn = m.draw(spark.createDataFrame([(i, int(q)) for i, q in enumerate(quotas)], "list int, quota long"), 8, 1).collect()
    assert {(r.list, r.shard): r.n for r in drawn} == {(i, s): n for s in range(8) for i, n in enumerate(shares[s].tolist()) if n}


def test_each_document_by_a_plain_mix(spark):
    """taken of each document, and its shards, by a plain walk over blocks."""
    docs = spark.createDataFrame([(i, t, s, i) for i, (_, t, s, _) in enumerate(rows())], "doc_id long, text string, source string, __row long")
    keyed = m._sized(docs, ["doc_id", "source"]).collect()
    totals = Counter()
    for r in keyed:
        totals[r.source] += r["size"]
    target, got = share(totals), {r.doc_id: r for r in m.given(docs, "__row", shards=16).collect()}
    plan = m.Plan(docs, 16)
    deals = {(r["__source"], r["__block"]): [tuple(d) for d in r.dealt] for r in plan.deals.collect()}
    per_shard = Counter()
    for source, words in totals.items():
        mine = sorted(((r.key % 2**64 >> 20) % m.LEAST_BLOCKS, r.key, r["size"], r.doc_id) for r in keyed if r.source == source)
        left = round(target[source]) - (full := round(target[source]) // words if words else 0) * words
        for block, _, size, i in mine:
            part = min(size, left)
            left -= part
            assert got[i].taken == full * size + part
            passes = deals.get((source, block), [])
            want = {s for p, s in passes if p < full or part}
            assert not size or set(got[i].shards) == want
    goals = plan.goals.collect()
    drawn = m.draw(plan.goals.groupBy("list").agg(m.F.sum("quota").alias("quota")), 16, 7).collect()
    for r in drawn:
        per_shard[r.shard] += r.n
    assert sum(per_shard.values()) == sum(g.quota for g in goals) and max(per_shard.values()) - min(per_shard.values()) <= 1


def test_what_is_not_drawn_is_not_taken(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c", "s", i) for i in range(50)], "doc_id long, text string, source string, __row long")
    assert sum(r.taken for r in m.given(docs, "__row").collect()) == 150
    monkeypatch.setattr(m, "draw", lambda quotas, shards, seed: spark.createDataFrame([], "list int, shard int, n long"))
    assert sum(r.taken for r in m.given(docs, "__row").collect()) == 0


def test_registered_query_counts_what_the_mix_gives(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(i % 290, "w " * (1 + i % 13), "abc"[i % 7 % 3]) for i in range(300)] + [(7, None, "a"), (8, "", None), (9, "x y", None), (9, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    every = lambda: sorted(tuple(r)[:-1] for r in m.op2_mixing(spark, str(tmp_path)).collect())
    assert every() == sorted(map(tuple, m.weigh(docs).collect()))
    whole = sum(r[4] for r in every())
    monkeypatch.setattr(m, "first_words", lambda text, n: F.when(n.isNull(), text).otherwise(F.lit("")))
    assert sum(r[4] for r in every()) < whole


def test_the_query_takes_tables_with_any_column(spark, tmp_path):
    rows = [(1, "one two three", "a", "x"), (2, "four", "b", "y"), (2, "four", "b", "y"), (3, None, None, "z")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, __row string").write.parquet(str(tmp_path / "documents.parquet"))
    got = m.op2_mixing(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == [(1, 3), (2, 1), (2, 1), (3, 0)]
