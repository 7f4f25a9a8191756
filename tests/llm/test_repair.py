import functools
import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from tidelake.llm import repair as r


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hurt(rows):
    """(conv_id, turn, role, text) rows after damage, by definition."""
    said = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        kind, role, text = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20, said(role), said(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(signs):
    """(cost, audit) over all ways to edit with at most two insertions, by the role initials made so far."""

    @functools.cache
    def best(i, made, inserts):
        ways = [(0, "")] if i == len(signs) and re.fullmatch("(s?(ua)+)?", made) else []
        steps = [("I", x, 5, i) for x in "ua" if inserts]
        if i < len(signs):
            initial, dead, cut = signs[i]
            steps.append(("D", "", 2, i + 1))
            if not dead:
                steps += [("R", x, 1 + 5 * cut, i + 1) for x in "ua"] + [("K", x, 5 * cut, i + 1) for x in (initial,) if x]
        for name, x, cost, to in steps:
            if re.fullmatch("(s?(ua)*u?)?", made + x):
                rest = best(to, made + x, inserts - (name == "I"))
                if rest:
                    ways.append((cost + rest[0], name + rest[1]))
        return min(ways, default=None)

    return best(0, "", 2)


def brute(rows):
    out = {}
    hurt_rows = hurt(rows)
    for conv in {x[0] for x in rows}:
        mine = sorted((x for x in hurt_rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2], hashlib.sha256(x[3].encode()).digest()))
        seen, signs, counts = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            blank = not re.search(r"[^\x20\x09-\x0D]", text)
            again = (role, text) in seen
            cut = not blank and re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?"
            counts[0] += blank
            counts[1] += not blank and again
            counts[2] += not blank and not again and cut
            signs.append((role[:1], blank or again, not (blank or again) and cut))
            seen.add((role, text))
        turns = [x[1] for x in mine if x[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
        cost, audit = cheapest(tuple(signs))
        lines, made, left = [], "", iter(mine)
        for edit in audit:
            role = "assistant" if made[-1:] == "u" else "user"
            if edit == "I":
                lines.append((role, ""))
            else:
                _, _, own, text = next(left)
                if edit != "D":
                    lines.append((own if edit == "K" else role, text))
            made = "".join(x[0][:1] for x in lines)
        assert re.fullmatch("(s?(ua)+)?", made)
        out[conv] = (gaps, *counts, illegal, cost, audit, sha("\n".join(f"{a}:{b}" for a, b in lines)))
    return out


def conversations():
    rng = random.Random(12)
    rows = []
    for c in range(250):
        for t in range(rng.randrange(1, 8)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else "system" if t == 0 and rng.random() < 0.4 else ("user", "assistant")[t % 2]
            rows.append((c, t + 2 * (rng.random() < 0.1), role, rng.choice(["Yes.", "no", "Why?", "", " \t", "More text!\n", "é…", f"own {c} {t}."])))
    rows += [(300, None, "user", "A."), (300, None, "user", "A."), (300, 5, None, "x"), (300, 9, "assistant", None), (301, 0, "", "Hm."), (301, 1, "tool", "T.")]
    rows += [(None, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(4)] + [(302, None, "user", f"{i}.") for i in range(3)]
    rows += [(c, t, "user", "lost.") for c, t in itertools.product(range(400, 460), range(2)) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    return rows + rows[:40]  # repeated rows


def test_automaton_finds_the_cheapest_least_audit():
    rng = random.Random(1)
    automaton = r.Automaton()
    words = sorted("".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(0, 8))) for _ in range(500))
    for word in words:  # sorted as read backwards
        automaton.read(word)
        signs = tuple((w.lower() if w != "x" else "u", w == "x", w.isupper()) for w in reversed(word))
        assert automaton.audit() == cheapest(signs), word


def test_conversations_are_repaired_like_brute_force(spark):
    rows = conversations()
    frame = spark.createDataFrame([(*x, 1, "y") for x in rows], "conv_id long, turn long, role string, text string, times int, audit string")
    got = {x.conv_id: tuple(x)[1:] for x in r.repair(r.damaged(frame), "times").collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv
    assert any(x[5] == 0 and x[6] == "" for x in want.values())
    assert r.repair(r.damaged(frame.limit(0)), "times").count() == 0


def test_a_conversation_over_many_tasks_is_one(spark):
    rows = [(1, t // 3, ("user", "assistant")[t % 2], f"line {t % 700}.") for t in range(3000)] + [(2, 0, "user", "Hi.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(16)
    want = {x.conv_id: tuple(x) for x in r.repair(frame.coalesce(1)).collect()}
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps the ranges apart
    try:
        pieces = r.faults(r._rows(frame, None)).repartitionByRange(7, "conv_id", "timed", "turn", "role", "print")
        assert pieces.where("conv_id = 1").select(F.spark_partition_id()).distinct().count() > 2
        assert {x.conv_id: tuple(x) for x in r.repair(frame).collect()} == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert want[1][1] == 0 and want[2][1:8] == (0, 0, 0, 0, 0, 2, "D")


def test_long_and_repeated_texts(spark):
    rows = [(1, 0, "user", "long " * 400000 + "."), (1, 1, "assistant", "ok.")] + [(2, 0, "user", "same.")] * 500
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x.conv_id: x for x in r.repair(frame).collect()}
    assert got[1].audit == "KK" and got[1].cost == 0
    assert got[2].audit == "D" * 500 and got[2].duplicate == 499 and got[2].illegal == 499


def test_the_query_equals_its_sql(spark):
    import duckdb

    at = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{at}/conversations.parquet'")
    cursor = con.execute(r.OP12_SQL)
    columns = [d[0] for d in cursor.description]
    assert sorted(cursor.fetchall()) == sorted(tuple(x) for x in r.op12_repair(spark, at).select(*columns).collect())
