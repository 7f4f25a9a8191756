"""Repair of damaged conversations over a suffix-shared automaton of their signatures.

A conversation is a string of signatures, one symbol a row: its role's initial, in capitals if the row
is truncated, or DEAD if it is blank or a duplicate. What is best for the rows from some place on
depends on those symbols alone, so suffixes are shared: conversations are sorted by their signatures
read backwards, and neighbours keep the automaton's nodes of the suffix that they have in common. A
node holds, for each state of the grammar `(s?(ua)+)?`, the cost to go and the first edit of the best
audit (the next node has the rest); both are worked out once, whatever the number of conversations
that end so. Nodes whose costs differ by a constant have the same edits and share those as well.

The edits and what they cost: Keep 0, Rerole 1, Delete 2 (all that a dead row allows), Insert 5; a
truncated row that is not deleted adds 5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import table

DEAD = "x"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5

# fixed values: states of the grammar are 0 nothing, 1 system, 2 user, 3 assistant last
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: "user", 1: "user", 2: "assistant", 3: "user"}
STATES = range(4)
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")

_STATS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_PIECE = {
    "part": "int", "signs": "string", "opening": "string", "closing": "string", "low": "long", "high": "long", "turns": "long",
    "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long",
}
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


class Automaton:
    """The nodes of one suffix, the last row's first; push and cut keep what suffixes share."""

    def __init__(self) -> None:
        self.nodes: list[tuple[int, tuple, tuple]] = []  # (base, costs over base by state, (edit, next state) by state)
        self.word = ""  # the signature, read backwards, that nodes are for
        self.known: dict[tuple, tuple] = {}
        self.end = self._closed([(0, "", q) if q in ENDS else None for q in STATES])

    @staticmethod
    def _closed(options: list) -> tuple[int, tuple, tuple]:
        """A node from the best (cost, edit, next state) of each state, None where there is none, and insertions."""
        best = list(options)
        for _ in STATES:
            for q in STATES:
                to = NEXT[q, WANTED[q][0]]
                if best[to] is not None:
                    insert = (best[to][0] + INSERT, "I", to)
                    if best[q] is None or insert[:2] < best[q][:2]:
                        best[q] = insert
        base = min(b[0] for b in best)
        return base, tuple(b[0] - base for b in best), tuple(b[1:] for b in best)

    def _node(self, sign: str, after: tuple[int, tuple, tuple]) -> tuple[int, tuple, tuple]:
        found = self.known.get((sign, after[1]))
        if found is None:
            costs, late = after[1], CUT_OFF if sign.isupper() else 0
            options = []
            for q in STATES:
                ways = [(costs[q] + DELETE, "D", q)]
                if sign != DEAD:
                    if (q, sign.lower()) in NEXT:
                        to = NEXT[q, sign.lower()]
                        ways.append((costs[to] + KEEP + late, "K", to))
                    to = NEXT[q, WANTED[q][0]]
                    ways.append((costs[to] + REROLE + late, "R", to))
                options.append(min(ways))
            found = self.known[sign, after[1]] = self._closed(options)
        return after[0] + found[0], found[1], found[2]

    def read(self, word: str) -> None:
        """Moves to the signature that reads word backwards."""
        same, most = 0, min(len(word), len(self.word))
        while same < most and word[same : same + 64] == self.word[same : same + 64] and same + 64 <= most:
            same += 64
        while same < most and word[same] == self.word[same]:
            same += 1
        del self.nodes[same:]
        for sign in word[same:]:
            self.nodes.append(self._node(sign, self.nodes[-1] if self.nodes else self.end))
        self.word = word

    def audit(self) -> tuple[int, str]:
        """(cost, edits) of the cheapest repair, the least in ASCII of those, for the signature read last."""
        q, out = 0, []
        top = self.nodes[-1] if self.nodes else self.end
        cost = top[0] + top[1][0]
        for node in [*reversed(self.nodes), self.end]:
            edit, to = node[2][q]
            while edit == "I":
                out.append(edit)
                q = to
                edit, to = node[2][q]
            out.append(edit)
            q = to
        return cost, "".join(out)


def damaged(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) after damage by crc32('conv_id:turn') % 20, and times, how often each row stands.

    0 drops the row (times 0), 1 empties its text, 2 removes its [.!?], 3 repeats it (times 2), 4 makes
    its role user. Nulls are one space, in the hash and as role and text.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    role = F.when(kind == 4, "user").otherwise(said("role"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long")
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))


def _rows(turns: DataFrame, times: str | None) -> DataFrame:
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turn = F.col("turn").cast("long")
    often = F.col(times).cast("long") if times else F.lit(1).cast("long")
    rows = turns.select("conv_id", turn.isNotNull().alias("timed"), F.coalesce(turn, F.lit(0)).alias("turn"), said("role").alias("role"), said("text").alias("text"), often.alias("times"))
    return rows.withColumn("print", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def faults(rows: DataFrame) -> DataFrame:
    """Different rows of conversations with times, blank, truncated, and opens: no earlier row has its role and text."""
    text = F.col("text")
    blank = ~text.rlike(r"[^\x20\x09-\x0D]")
    marked = rows.select("conv_id", "timed", "turn", "role", "print", "times", blank.alias("blank"), (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))
    # both aggregates combine before the shuffle, so that rows and words that a third of the rows repeat are few
    counted = marked.groupBy("conv_id", "timed", "turn", "role", "print").agg(F.sum("times").alias("times"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"))
    firsts = counted.where("times > 0").groupBy("conv_id", "role", "print").agg(F.min(F.struct("timed", "turn")).alias("at"))
    firsts = firsts.select("conv_id", "role", "print", "at.timed", "at.turn", F.lit(True).alias("opens"))
    a, b = counted.alias("a"), firsts.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    for c in ("timed", "turn", "role", "print"):
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    return a.join(b, same, "left").select("a.*", F.coalesce("b.opens", F.lit(False)).alias("opens"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of faults() to one row for each conversation of the task."""
    part, whose, piece, signs = TaskContext.get().partitionId(), None, None, []
    started, kind = False, None

    def closed() -> tuple:
        return (whose, part, "".join(signs), *(piece[c] for c in list(_PIECE)[2:]))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = ["conv_id", *_PIECE]
        types = [kind, *(_ARROW[t] for t in _PIECE.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        out = []
        kind = batch.schema.field("conv_id").type
        for conv, timed, turn, role, times, blank, truncated, opens in zip(*(batch[c].to_pylist() for c in ("conv_id", "timed", "turn", "role", "times", "blank", "truncated", "opens"))):
            if not started or conv != whose:
                if started:
                    out.append(closed())
                started, whose, signs = True, conv, []
                piece = {"opening": None, "closing": None, "low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            if not times:
                continue
            initial = role[:1]
            alive = opens and not blank
            if alive:
                sign = initial if initial in ("s", "u", "a") else "o"
                signs.append(sign.upper() if truncated else sign)
                piece["truncated"] += truncated
            signs.append(DEAD * (times - alive))
            piece["blank" if blank else "duplicate"] += times - alive
            if piece["opening"] is None:
                piece["opening"] = initial
            else:
                piece["illegal"] += piece["closing"] + initial not in LEGAL
            piece["illegal"] += (times - 1) * (initial + initial not in LEGAL)
            piece["closing"] = initial
            if timed:
                piece["turns"] += turn != piece["high"]
                piece["low"] = turn if piece["low"] is None else piece["low"]
                piece["high"] = turn
        if out:
            yield batch_of(out)
    if started:
        yield batch_of([closed()])


def _merged(pieces: list[dict]) -> list[int]:
    """gaps, blank, duplicate, truncated, illegal of a conversation from its pieces in order."""
    blank, duplicate, truncated, illegal = (sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal"))
    held = [p for p in pieces if p["opening"] is not None]
    illegal += sum(a["closing"] + b["opening"] not in LEGAL for a, b in zip(held, held[1:]))
    timed = [p for p in held if p["low"] is not None]
    turns = sum(p["turns"] for p in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
    gaps = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
    return [gaps, blank, duplicate, truncated, illegal]


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, tail, pieces, sorted by tail, to conv_id, the statistics, cost and audit."""
    automaton, said = Automaton(), (0, "")
    fresh = True
    for batch in batches:
        out = []
        for conv, tail, pieces in zip(batch["conv_id"].to_pylist(), batch["tail"].to_pylist(), batch["pieces"].to_pylist()):
            if fresh or tail != automaton.word:
                automaton.read(tail)
                said, fresh = automaton.audit(), False
            out.append((conv, *_merged(pieces), *said))
        if out:
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * (len(_STATS) + 1), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["conv_id", *_STATS, "cost", "audit"])


class _Repaired:
    """The repaired rows of one conversation, as its rows and audit are read in order."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.empty = audit, 0, 0, True
        self.digest = hashlib.sha256()

    def _say(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + role.encode() + b":" + text.encode())
        self.state, self.empty = NEXT[self.state, role[:1]], False

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._say(WANTED[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._say(WANTED[self.state] if edit == "R" else role, text)

    def closed(self) -> str:
        self.inserted()
        return self.digest.hexdigest()


def _hashed(head: list[str]):
    """For mapInArrow: a conversation's head (tag 0) and its rows in order to the head and the hash of what they become."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first, schema = None, None, None
        for batch in batches:
            out = []
            schema = pa.schema([*(batch.schema.field(c) for c in head), pa.field("repaired_sha256", pa.string())])
            heads = list(zip(*(batch[c].to_pylist() for c in head)))
            for i, (tag, role, text, times) in enumerate(zip(*(batch[c].to_pylist() for c in ("tag", "role", "text", "times")))):
                if tag == 0:
                    if current is not None:
                        out.append((*first, current.closed()))
                    first = heads[i]
                    current = _Repaired(first[head.index("audit")])
                else:
                    for _ in range(times):
                        current.row(role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*first, current.closed()), schema)], schema=schema)

    return run


def repair(turns: DataFrame, times: str | None = None) -> DataFrame:
    """A row for every conv_id of turns (conv_id, turn, role, text): its faults, its cheapest repair, and what that gives.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. times names a column
    of how often a row stands (0: not at all; its conversation stays, with zeros, an empty audit and the
    hash of an empty text if it has no other row). Rows come by turn (null first), role and the SHA-256 of
    their text; null roles and texts are one space, rows without conv_id are one conversation, and a role
    without a known initial cannot be kept. Other columns are ignored.

    Rows are marked and brought in order without their texts. A conversation that spans several tasks is
    a few pieces with one symbol a row, which are joined; only the hash, being sequential, streams all rows
    of a conversation through one task, and holds none of them.
    """
    rows = _rows(turns, times)
    order = ["conv_id", "timed", "turn", "role", "print"]
    kind = turns.schema["conv_id"].dataType.simpleString()
    sorted_rows = faults(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = sorted_rows.select(*order[:4], "times", "blank", "truncated", "opens").mapInArrow(_pieces, f"conv_id {kind}, " + ", ".join(f"{c} {t}" for c, t in _PIECE.items()))
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*_PIECE))).alias("pieces"))
    tail = F.reverse(F.array_join(F.transform("pieces", lambda p: p["signs"]), ""))
    whole = whole.withColumn("tail", tail).withColumn("pieces", F.transform("pieces", lambda p: p.dropFields("part", "signs")))
    # the conversation breaks ties, so that an ending that a third of all share is spread over tasks
    spread = whole.repartitionByRange(F.substring("tail", 1, 64), "conv_id").sortWithinPartitions("tail", "conv_id")
    head = ["conv_id", *_STATS, "cost", "audit"]
    audits = spread.select("conv_id", "tail", "pieces").mapInArrow(_audits, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in (*_STATS, "cost")) + ", audit string")
    live = rows.where("times > 0").select(*order, "text", "times", F.lit(1).alias("tag"))
    both = audits.withColumn("tag", F.lit(0)).unionByName(live, allowMissingColumns=True)
    ready = both.repartition("conv_id").sortWithinPartitions("conv_id", "tag", *order[1:])
    types = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in (*_STATS, "cost")) + ", audit string, repaired_sha256 string"
    return ready.select(*head, "tag", "role", "text", "times").mapInArrow(_hashed(head), types)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged conversations and their repairs; see damaged and repair."""
    return repair(damaged(table(spark, sf_dir, "conversations")), "times")


def _more(cost: str, letters: str, best: str) -> str:
    """In SQL: a best (nine digits of cost, then its audit) with an edit before it."""
    return f"lpad(CAST(CAST(substr({best}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letters}' || substr({best}, 10)"


def _row_sql(q: int) -> str:
    """The least of what a row's edits lead to from state q: by cost, then by audit."""
    late = f"CASE WHEN cut THEN {CUT_OFF} ELSE 0 END"
    keep = " ".join(f"WHEN initial = '{r}' THEN {_more(f'{KEEP} + {late}', 'K', f'g{to}')}" for (a, r), to in NEXT.items() if a == q)
    reroled = _more(f"{REROLE} + {late}", "R", f"g{NEXT[q, WANTED[q][0]]}")
    return f"least({_more(str(DELETE), 'D', f'g{q}')}, CASE WHEN dead THEN NULL {keep} END, CASE WHEN NOT dead THEN {reroled} END)"


def _insert_sql(q: int) -> str:
    once = NEXT[q, WANTED[q][0]]
    twice = NEXT[once, WANTED[once][0]]
    return f"least(h{q}, {_more(str(INSERT), 'I', f'h{once}')}, {_more(str(2 * INSERT), 'II', f'h{twice}')})"


_BYTE = "CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END"
OP12_SQL = rf"""WITH RECURSIVE tb AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: {_BYTE})) AS crc),
 cv AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
 rw AS (SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(coalesce(CAST(t.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations t JOIN cv ON cv.conv_id IS NOT DISTINCT FROM t.conv_id),
 kd AS (SELECT c, turn, role, text, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b: xor(crc[1 + (xor(a, b) & 255)], a >> 8)), 4294967295) % 20 AS kind FROM rw, tb),
 dm AS (SELECT c, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM kd),
 ps AS (SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos, substr(role, 1, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank FROM dm),
 fl AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 AS again, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS short, lag(initial) OVER (PARTITION BY c ORDER BY pos) || initial AS pair,
  count(*) OVER (PARTITION BY c) AS n FROM ps),
 sg AS (SELECT *, blank OR again AS dead, NOT blank AND NOT again AND short AS cut FROM fl),
 st AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
  count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM sg GROUP BY c),
 dp AS (SELECT c, CAST(0 AS BIGINT) AS i, '000000000' AS g0, '000000010II' AS g1, '000000005I' AS g2, '000000000' AS g3 FROM cv
  UNION ALL SELECT c, i, {", ".join(f"{_insert_sql(q)} AS g{q}" for q in STATES)} FROM (
   SELECT sg.c, dp.i + 1 AS i, {", ".join(f"{_row_sql(q)} AS h{q}" for q in STATES)} FROM dp JOIN sg ON sg.c = dp.c AND sg.pos = sg.n - dp.i)),
 au AS (SELECT c, CAST(substr(last(g0 ORDER BY i), 1, 9) AS BIGINT) AS cost, substr(last(g0 ORDER BY i), 10) AS audit FROM dp GROUP BY c),
 wk AS (SELECT c, audit, CAST(1 AS BIGINT) AS j, CAST(0 AS BIGINT) AS k, 0 AS q, '' AS said FROM au
  UNION ALL SELECT c, audit, j + 1, k + CAST(e <> 'I' AS BIGINT), CASE WHEN e = 'D' THEN q WHEN substr(r, 1, 1) = 's' THEN 1 WHEN substr(r, 1, 1) = 'u' THEN 2 ELSE 3 END, CASE WHEN e = 'D' THEN said ELSE said || CASE WHEN q = 0 THEN '' ELSE chr(10) END || r || ':' || x END FROM (
   SELECT wk.*, substr(audit, j, 1) AS e, CASE WHEN substr(audit, j, 1) = 'K' THEN sg.role WHEN q = 2 THEN 'assistant' ELSE 'user' END AS r, CASE WHEN substr(audit, j, 1) = 'I' THEN '' ELSE sg.text END AS x
   FROM wk LEFT JOIN sg ON sg.c = wk.c AND sg.pos = wk.k + 1 WHERE j <= length(audit)))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, au.audit AS audit, sha256(said) AS repaired_sha256
FROM cv JOIN au ON au.c = cv.c LEFT JOIN st ON st.c = cv.c JOIN wk ON wk.c = cv.c AND wk.j = length(au.audit) + 1"""
