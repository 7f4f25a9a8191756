import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.operators import asof, experiments, ordered
from tidelake.sources import catalogs as S


def test_the_wider_type_holds_both():
    dec = T.DecimalType
    cases = [
        (T.IntegerType(), T.LongType(), T.LongType()), (T.IntegerType(), dec(9, 2), dec(12, 2)), (T.LongType(), dec(38, 20), T.DoubleType()),
        (dec(10, 2), dec(14, 4), dec(14, 4)), (dec(10, 0), dec(5, 4), dec(14, 4)), (T.LongType(), T.DoubleType(), T.DoubleType()),
        (T.FloatType(), T.IntegerType(), T.DoubleType()), (T.NullType(), T.StringType(), T.StringType()), (T.DateType(), T.TimestampType(), T.TimestampType()),
    ]
    for a, b, want in cases:
        assert S.wider(a, b) == S.wider(b, a) == want
    with pytest.raises(ValueError):
        S.wider(T.StringType(), T.LongType())


def test_files_of_three_schemas_are_one_table_with_filters_at_the_scan(spark, tmp_path):
    for i, kind in enumerate(["int", "long", "decimal(12,3)"]):
        frame = spark.range(5).select(F.col("id").cast(kind).alias("n"), F.lit(i).alias("of"), *([F.lit("x").alias("note")] if i else []))
        frame.write.parquet(str(tmp_path / str(i)))
    found = S.promoted(spark, [str(tmp_path / str(i)) for i in range(3)])
    assert dict(found.dtypes) == {"n": "decimal(23,3)", "of": "int", "note": "string"}
    assert sorted((float(r.n), r.of, r.note) for r in found.collect()) == sorted((float(n), i, "x" if i else None) for i in range(3) for n in range(5))
    plan = found.where("of = 1").select("n")._jdf.queryExecution().toString()
    assert plan.count("EqualTo(of,1)") >= 3 and "note" not in plan.split("== Physical Plan ==")[1]
    with pytest.raises(ValueError):
        S.promoted(spark, [])


def test_content_ids_group_files_as_whole_digests_do(spark, tmp_path):
    texts = {"a": "1\n2\n3\n", "b": "1\n2\n3\n", "c": "1\n2\n3", "d": "1\n3\n2\n", "e": "\n", "f": "\n", "g": "x" * 5000 + "\ny", "h": "x" * 5000 + "\ny"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = {r.object.rpartition("/")[2]: r.content for r in S.content_ids(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    sha = {n: hashlib.sha256(t.encode()).hexdigest() for n, t in texts.items()}
    assert got.keys() == texts.keys()
    assert all((got[a] == got[b]) == (sha[a] == sha[b]) for a in texts for b in texts)


def test_a_text_in_parts_has_the_content_of_its_whole(spark, tmp_path):
    whole = [f"{i},{'é' * (i % 5)}\n" for i in range(50)]
    cuts = {"one": [50], "even": [10, 20, 30, 40, 50], "odd": [1, 33, 50], "short": [20, 49]}
    for name, ends in cuts.items():
        (tmp_path / "cut" / name).mkdir(parents=True)
        for n, (start, end) in enumerate(zip([0, *ends], ends)):
            (tmp_path / "cut" / name / f"part-{n:05d}-x.c000.txt").write_bytes("".join(whole[start:end]).encode())
    got = {r.object.rpartition("/")[2]: r for r in S.content_ids(spark, str(tmp_path / "cut" / "*"), parts=True).collect()}
    assert got.keys() == cuts.keys() and got["one"].content == got["even"].content == got["odd"].content != got["short"].content
    assert {n: (r.bytes, r.lines) for n, r in got.items()} == {n: (len("".join(whole[: e[-1]]).encode()), e[-1]) for n, e in cuts.items()}
    assert got["one"].content == S.content_ids(spark, str(tmp_path / "cut" / "one")).first().content


def test_equal_rows_are_equal_files_in_whatever_order_they_come(spark):
    from tidelake.plans import archives

    rows = [(0, 1, "a"), (0, 1, "b"), (0, 0, "c"), (1, 1, "b"), (1, 0, "c"), (1, 1, "a")]
    found = S.content_ids(spark, archives.files(spark.createDataFrame(rows, "shelf long, place long, line string").coalesce(1)), parts=True)
    assert [r.copies for r in S.duplicates(found).collect()] == [2, 2]


def test_a_store_is_not_asked_about_later_times(spark):
    asks = spark.createDataFrame([(1,), (9,)], "t long")
    assert asof.asked_by(asks, 9).count() == 2
    with pytest.raises(Exception, match="cut at 5"):
        asof.asked_by(asks, 5).collect()


def test_quantiles_are_exact(spark):
    import numpy as np

    values = [3.0, 1.0, 1.0, 7.5, 2.0, 9.0, 4.25, 1.0]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = ordered.quantiles(frame, "x", {"a": 0.5, "b": 0.9, "c": 0.0, "d": 1.0}).first()
    assert np.allclose(list(got), np.quantile(values, [0.5, 0.9, 0.0, 1.0]))
    assert list(ordered.quantiles(frame.limit(0), "x", {"a": 0.5}).first()) == [None]


def test_a_holdout_with_a_fault_is_invalid(spark):
    rows = [(s, t, 1000.0 * 1.01 ** (t + 1)) for s in ("good", "short", "lies") for t in range(8) if s != "short" or t < 5]
    path = spark.createDataFrame(rows, "session string, t long, equity double")
    reported = spark.createDataFrame([("good", 1.01**8 - 1), ("short", 1.01**5 - 1), ("lies", 0.5)], "session string, total double")
    got = {r.session: r for r in experiments.holdout(path, reported, 1000.0, 8, 200, 3, 7).collect()}
    assert (got["good"].fault, got["good"].verdict) == (None, "ACCEPT")  # equal returns: no resample of centred ones comes near
    assert (got["short"].fault, got["lies"].fault) == ("decision_count", "reported_mismatch") and got["lies"].verdict == "INVALID"
    assert abs(got["good"].total - (1.01**8 - 1)) < 1e-9 and got["good"].exceedances == 0
