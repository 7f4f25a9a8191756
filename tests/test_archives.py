import csv
import random

import pytest

from tidelake.sources import lines as L

COLUMNS = ["id", "at", "note"]


@pytest.fixture(params=["1000", "1000000000"])
def split(spark, request):
    """Whether files are read in blocks of 1 KB or whole."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], request.param)
    spark.conf.set(names[1], "100")
    yield int(request.param)
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def write(folder):
    rng = random.Random(9)
    files = {}
    for name, tail in (("a", "\n"), ("b", ""), ("c", "\r\n")):
        end = "\r\n" if name == "c" else "\n"
        lines = [",".join(COLUMNS)]
        for i in range(400):
            at = 1704067200 + i if i % 5 else (1704067200 + i) * 1000
            line = f"{rng.randrange(1000):04d},{at if i % 37 else 'never'},{'é' * (i % 9)}"
            lines.append(line + ",more" if i % 29 == 3 else '"0001",1704067200,"a, b"' if i % 31 == 0 else line)
        files[f"{name}.csv"] = (end.join(lines) + tail).encode()
    files["empty.csv"] = b""
    files["header.csv"] = b"id,at,note\n"
    for name, data in files.items():
        (folder / name).write_bytes(data)
    return files


def test_envelopes_rebuild_files_byte_for_byte(spark, tmp_path, split):
    files = write(tmp_path)
    blocks = L.lines(spark, str(tmp_path)).select("object", "block").distinct().count()
    assert (blocks > 8) == (split == 1000)
    built = {}
    for r in sorted(L.envelope(spark, str(tmp_path)).collect(), key=lambda r: (r.object, r.ordinal)):
        name = r.object.rpartition("/")[2]
        assert len(built.setdefault(name, [])) == r.ordinal
        built[name].append(",".join(r.tokens) + "\n" * r.newline)
    assert {k: "".join(v).encode() for k, v in built.items()} == {k: v for k, v in files.items() if v}


def test_an_audit_is_the_same_however_files_are_split(spark, tmp_path, split):
    files = write(tmp_path)
    audit = L.CsvAudit(COLUMNS, key=["id"], order=["id"], time="at", samples=3)
    got = {r.object.rpartition("/")[2]: r for r in audit.run(L.lines(spark, str(tmp_path))).collect()}
    assert got.keys() == {k for k, v in files.items() if v}
    for name, r in got.items():
        header, *rows = csv.reader(files[name].decode().splitlines())
        wide = [x for x in rows if len(x) == 3]
        ids = [x[0] for x in wide]
        timed = [int(x[1]) for x in wide if x[1] != "never"]
        us = [t * 1000 if t > 10**11 else t * 10**6 for t in timed]
        assert r.header == (header == COLUMNS) and r.records == len(rows) and r.valid == len(timed)
        assert (r.malformed, r.bad_times) == (len(rows) - len(timed), len(wide) - len(timed))
        assert r.violations == sum(a > b for a, b in zip(ids, ids[1:])) and r.duplicates == len(ids) - len(set(ids))
        assert (r.earliest_us, r.latest_us) == ((min(us), max(us)) if us else (None, None))
        assert r.units == sorted({"ms" if t > 10**11 else "s" for t in timed})
        assert (r.head, r.tail) == (wide[:3], wide[-3:])


def test_an_audit_names_missing_columns():
    with pytest.raises(ValueError):
        L.CsvAudit(COLUMNS, key=["gone"])


def test_a_header_is_decided_for_each_file(spark, tmp_path, split):
    names = ",".join(c for c, _ in L.columns_of("trades"))
    row = "1,2.5,3,7.5,1704067200000,true"
    for name, text in {"headed": f"{names}\n{row}\n", "bare": f"{row}\n{row}\r\n", "other": "a,b\n1,2\n", "bool": "true,x\n"}.items():
        (tmp_path / name).write_bytes(text.encode())
    rows = L.numbered(L.lines(spark, str(tmp_path)))
    states = {r.object.rpartition("/")[2]: r.state for r in L.headers(rows, "trades").collect()}
    assert states == {"headed": "HEADED", "bare": "HEADERLESS", "other": "UNKNOWN", "bool": "HEADERLESS"}
    got = [(r.object.rpartition("/")[2], r.ordinal, r.id, r.price, r.is_buyer_maker, r.width) for r in L.family_rows(rows, "trades").collect()]
    assert sorted(got, key=str) == sorted(
        [("headed", 1, 1, 2.5, True, 6), ("bare", 0, 1, 2.5, True, 6), ("bare", 1, 1, 2.5, True, 6), ("bool", 0, None, None, None, 2)], key=str
    )


def test_a_time_has_one_unit_or_none():
    bounds = (1704067200 * 10**6, 1735689600 * 10**6)
    assert L.time_of("1704067200", *bounds) == ("s", bounds[0])
    assert L.time_of("1704067200000000000", *bounds) == ("ns", bounds[0])
    assert L.time_of("12", *bounds) is None and L.time_of("x", *bounds) is None and L.time_of("1704067200", 0, 1 << 62) is None


def test_first_candles_are_found_without_a_window_over_a_file(spark, tmp_path):
    from tidelake.sources import market

    (tmp_path / "a.csv").write_text("".join(f"{1704067200000 + 60000 * i},1,2,1,1,1,{1704067200000 + 60000 * i + (58999 if i < 2 else 59999)},1,1,1,1,0\n" for i in (1, 0, 2)))
    found = market.candles(spark, str(tmp_path), 60_000_000)
    assert "Window" not in found._jdf.queryExecution().analyzed().toString()
    assert {r.open_us - 1704067200 * 10**6: len(r.issues) for r in found.collect()} == {0: 1, 60_000_000: 1, 120_000_000: 0}


def test_an_archive_in_parts_is_one_text(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidelake.plans import archives

    rows = spark.range(0, 3000, 1, 4).select((F.col("id") % 2).alias("shelf"), F.col("id").alias("place"), F.concat(F.lit("x,"), F.col("id").cast("string")).alias("line"))
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = archives.files(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert L.lines(spark, path).select("object").distinct().count() > 2  # no task writes a whole shelf
    found = L.envelope(spark, path, parts=True).collect()
    assert sorted((int(r.tokens[1]) % 2, r.ordinal, int(r.tokens[1]), r.newline) for r in found) == [(s, i, 2 * i + s, True) for s in (0, 1) for i in range(1500)]
    audit = L.CsvAudit(["x", "id"]).run(L.lines(spark, path, parts=True)).collect()
    assert sorted(r.records for r in audit) == [1499, 1499] and not any(r.header for r in audit)  # one first line each
