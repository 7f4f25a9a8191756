import random

from tidelake.llm import chat


def brute(rows):
    convs = {}
    for c, t, r, x in set(rows):
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or "", r, x))
    seqs = {c: [(r, x) for *_, r, x in sorted(v, key=lambda y: y[:6])] for c, v in convs.items()}
    out = {}
    for c, s in seqs.items():
        if any(len(o) > len(s) and o[: len(s)] == s for o in seqs.values()) or any(o == s and d < c for d, o in seqs.items()):
            continue
        text = "".join(f"<|{'unknown' if r is None else r}|>\n{x or ''}\n" for r, x in s)
        out[c] = (len(s), sum(o == s for o in seqs.values()), text)
    return out


def test_snapshots_collapse_like_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in range(300):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, ["user", "assistant", None][rng.randrange(30) % 3 if t == 0 else t % 2], rng.choice(["a", "b", None, "", "x:1|2"])))
    rows += [(None, 0, "user", "lost"), (7, None, "user", "first"), (8, 0, "user", "a"), (8, 0, "user", "a"), (9, 0, None, None)] + [(1000, t, "user", "long " * 2000) for t in range(40)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position int")
    got = {r.conv_id: (r.n_turns, r.n_copies, r.text) for r in chat.render(frame).collect()}
    assert got == brute(rows)
    assert chat.render(frame.limit(0)).count() == 0
