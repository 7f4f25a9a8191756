import random

from pyspark.sql import functions as F

from tidelake.functions import wide


def test_numbers_of_256_bits(spark):
    rng = random.Random(5)
    edge = [0, 1, 2**32 - 1, 2**32, 2**64 - 1, 2**112 - 1, 2**112, 2**128, 2**255, 2**256 - 1]
    numbers = edge + [rng.getrandbits(rng.randrange(1, 257)) for _ in range(60)]
    pairs = [(f"{a:064x}", f"{b:064X}") for a in edge for b in edge] + [(f"{a:064x}", f"{rng.choice(numbers):064x}") for a in numbers]
    frame = spark.createDataFrame([*pairs, (None, "0" * 64), ("12", "x" * 64)], "a string, b string")
    frame = frame.withColumn("x", wide.u256(F.col("a"))).withColumn("y", wide.u256(F.col("b")))
    got = frame.select(
        "a", "b", wide.hexed(wide.add(F.col("x"), F.col("y"))).alias("sum"), (F.col("x") < F.col("y")).alias("less"), wide.decimal_text(F.col("x")).alias("text"),
        wide.fits(F.col("x"), 112).alias("fits"), wide.hexed(F.col("x")).alias("hexed"),
    ).collect()
    for r in got[:-2]:
        a, b = int(r.a, 16), int(r.b, 16)
        assert r["sum"] == (f"0x{a + b:064x}" if a + b < 2**256 else None)
        assert r.less == (a < b) and r.text == str(a) and r.fits == (a < 2**112) and r.hexed == f"0x{a:064x}"
    assert all(r["sum"] is None and r.text is None and r.less is None for r in got[-2:])
    data = spark.createDataFrame([("0x" + "0" * 127 + "A",), ("0x" + "0" * 126,), ("0x" + "0" * 127 + "g",), (None,)], "d string")
    assert [r[0] for r in data.select(wide.words(F.col("d"), 2)).collect()] == [["0" * 64, "0" * 63 + "a"], None, None, None]


def longest_method(df):
    """Bytes of the longest method that Spark makes for df: over 8,000 the JVM does not compile one, but reads it step by step."""
    made = df._jdf.queryExecution().debug().codegenToSeq()
    return max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size()))


def test_numbers_are_read_and_written_by_code_that_is_compiled(spark):
    from tidelake.functions.checks import hex_quantity

    words = spark.range(3).select(*(F.lpad(F.hex(F.col("id") + i), 64, "0").alias(f"w{i}") for i in range(4)))
    assert longest_method(words.select(*(wide.u256(F.col(c)) for c in words.columns))) < 8000
    assert longest_method(words.select(hex_quantity(F.col("w0")), hex_quantity(F.col("w1")))) < 8000
    text = words.select(wide.decimal_text(wide.u256(F.col("w0"))))
    assert "ArrowEvalPython" in text._jdf.queryExecution().executedPlan().toString()  # batches of numbers, not steps of each


def test_swap_logs_write_their_amounts_by_batches(spark):
    from tidelake.plans import registry

    plan = registry.queries()["s12_swap_logs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan


def test_words_are_read_without_patterns_and_limbs_by_batches(spark):
    data = spark.createDataFrame([("0x" + "0" * 64 + "\n",), ("0x" + "0" * 63 + "é",), ("0X" + "0" * 64,), ("0x" + "F" * 64,)], "d string")
    assert [r[0] for r in data.select(wide.words(F.col("d"), 1)).collect()] == [None, None, None, ["f" * 64]]
    plan = data.select(wide.u256(wide.words(F.col("d"), 1)[0]))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "RLIKE" not in plan


def test_logs_meet_headers_without_a_broadcast_and_refused_ones_are_not_dealt_whole(spark):
    from tidelake.sources import market

    logs = spark.createDataFrame([("0xp", ["t"], "0x" + "0" * 64, "0x1", "h", "0x0", tx, False) for tx in "ab"] + [("0xq", ["t"], "0x" + "0" * 64, "0x1", "h", "0x0", "a", False)],
        "address string, topics array<string>, data string, block_number string, block_hash string, log_index string, tx_hash string, removed boolean")
    headers = spark.range(1).selectExpr("concat('0x', id + 1) AS number", "'h' AS hash", "'0x1' AS timestamp")  # known to be small
    marked = market.event_logs(logs, headers, "0xp", "t", 1, 1)
    assert "Broadcast" not in marked._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.address, r.tx_hash, r.code, r.words is None, r.topics is None) for r in marked.collect())
    assert got == [("0xp", "a", "duplicate_log", False, False), ("0xp", "b", None, False, False), ("0xq", "a", "wrong_emitter", True, True)]
