from collections import Counter

import corpus_pipeline as p
import pytest
from tidelake.llm import mixing, secrets, simhash, toxicity

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and gave."""
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    for name, stage in p.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, DIR).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_columns_and_names(spark, stages):
    assert [n for n, _ in p.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scan", "mixing", "packing"]
    for docs, got in stages[:-1]:
        assert got.columns == docs.columns


def test_stages_do_what_their_operators_say(spark, stages):
    (docs, safe), (_, single), (_, clean), (_, mixed), (_, packed) = stages
    marks = {r.doc_id: r.predicted for r in toxicity.score(docs, spark.read.parquet(f"{DIR}/labels.parquet")).collect()}
    assert Counter(r.doc_id for r in safe.collect()) == Counter(r.doc_id for r in docs.collect() if not marks[r.doc_id])
    assert Counter(r.doc_id for r in single.collect()) == Counter({r.component_id for r in simhash.group(safe).collect()})
    before, after = {r.doc_id: r for r in single.collect()}, {r.doc_id: r for r in clean.collect()}
    assert before.keys() == after.keys()
    for i, r in before.items():
        hit = any(secrets.find(r.text, v) for v in secrets.RULES)
        assert (after[i].text != r.text) == hit and after[i].n_chars == len(after[i].text)
    size = lambda t: len((t or "").encode().split())
    taken = {r.doc_id: r.taken for r in mixing.weigh(clean).collect()}
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += size(r.text)
    assert +words == +Counter(taken)
    rows = packed.collect()
    assert sum(r.length for r in rows) > 0 and max(r.offset + r.length for r in rows) <= 2048


def test_run_gives_the_stages_rows(spark, stages):
    got = Counter(map(tuple, p.run(spark, DIR).drop("sequence_id", "offset").collect()))
    assert got == Counter(map(tuple, stages[-1][1].drop("sequence_id", "offset").collect()))
