"""Text archives by line: exact ordinals, lossless envelopes, archive families and a CSV audit.

A large file is read by several tasks, a block each. What a task knows of its block (lines, bytes, first
and last keys, counts) is one row; blocks are folded in file order, so nothing needs a whole file in one task.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: the columns of each archive family, with the types that they are read as
FAMILIES = {
    "trades": "id long, price double, qty double, quote_qty double, time long, is_buyer_maker boolean",
    "aggTrades": "agg_trade_id long, price double, quantity double, first_trade_id long, last_trade_id long, transact_time long, is_buyer_maker boolean",
    "klines": "open_time long, open double, high double, low double, close double, volume double, close_time long, quote_volume double, "
    "count long, taker_buy_volume double, taker_buy_quote_volume double, ignore string",
    "fundingRate": "calc_time long, funding_interval_hours long, last_funding_rate double",
    "metrics": "create_time string, symbol string, sum_open_interest double, sum_open_interest_value double, count_toptrader_long_short_ratio double, "
    "sum_toptrader_long_short_ratio double, count_long_short_ratio double, sum_taker_long_short_vol_ratio double",
    "bookTicker": "update_id long, best_bid_price double, best_bid_qty double, best_ask_price double, best_ask_qty double, transaction_time long, event_time long",
    "bookDepth": "timestamp string, percentage double, depth double, notional double",
}
#: A line of names only is a header; a number, a boolean or an empty token is never a name.
NAMES = r"^(?!(?i:true|false)(?:,|$))[A-Za-z_]\w*(?:,(?!(?i:true|false)(?:,|$))[A-Za-z_]\w*)*\r?$"


def columns_of(family: str) -> list[tuple[str, str]]:
    """(name, type) of a family's columns."""
    return [tuple(c.strip().split(" ")) for c in FAMILIES[family].split(",")]  # type: ignore[misc]


#: Block numbers of an archive in parts: the part's number above that many bits, the place in it below.
PART_BITS = 40


def lines(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """object, block, size, at, line of text files: at grows within a block (a part of a file that one task reads).

    With parts an object is a folder: its files, which Spark wrote as part-N, are one text in order of N.
    """
    found = spark.read.option("lineSep", "\n").text(path).withColumn("at", F.monotonically_increasing_id())
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    size, line = F.col("_metadata.file_size").alias("size"), F.col("value").alias("line")
    if not parts:
        return found.select(file.alias("object"), start.alias("block"), size, "at", line)
    folder, part = F.regexp_extract(file, "^(.*)/", 1).alias("object"), F.regexp_extract(file, "part-([0-9]+)[^/]*$", 1).cast("long")
    return found.select(folder, (F.shiftleft(part, PART_BITS) + start).alias("block"), size, "at", line)


def numbered(found: DataFrame) -> DataFrame:
    """object, size, ordinal (from 0 in each file), line, newline of lines(); newline is false only where a file ends without one.

    size is that of the whole object: of all its files, if it is a folder.

    Blocks are counted, and each block's lines go on from those of the blocks before it. The blocks' counts, a
    row for each that a task reads, are broadcast: a join by object would bring all lines of a file to one task.
    """
    blocks = found.groupBy("object", "block").agg(
        F.min("at").alias("first"), F.count("*").alias("n"), F.sum(F.octet_length("line") + 1).alias("bytes"), F.first("size").alias("size")
    )
    whole = Window.partitionBy("object")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    size = F.sum(F.when(F.col("block") % (1 << PART_BITS) == 0, F.col("size"))).over(whole)
    placed = blocks.select(
        "object", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"), F.sum("n").over(whole).alias("total"),
        size.alias("size"), (F.sum("bytes").over(whole) > size).alias("open"),
    )
    ordinal = (F.col("at") - F.col("first") + F.col("ahead")).alias("ordinal")
    met = found.drop("size").join(F.broadcast(placed), ["object", "block"]).select("object", "size", ordinal, "line", "total", "open")
    return met.select("object", "size", "ordinal", "line", (~(F.col("open") & (F.col("ordinal") == F.col("total") - 1))).alias("newline"))


def envelope(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """object, ordinal, tokens, newline: every line of every file (or folder: see lines()), each token as it is written.

    Tokens joined by commas, in order of ordinal, each followed by a line feed where newline is true, are
    the file byte for byte; a carriage return stays in the last token.
    """
    return numbered(lines(spark, path, parts)).select("object", "ordinal", F.split("line", ",", -1).alias("tokens"), "newline")


def headers(rows: DataFrame, family: str) -> DataFrame:
    """object, state of numbered lines: HEADED, HEADERLESS, or UNKNOWN (names other than the family's), by each file's first line."""
    names = ",".join(c for c, _ in columns_of(family))
    line = F.rtrim(F.col("line"), F.lit("\r"))
    state = F.when(line == names, "HEADED").when(F.col("line").rlike(NAMES), "UNKNOWN").otherwise("HEADERLESS")
    return rows.where("ordinal = 0").select("object", state.alias("state"))


def family_rows(rows: DataFrame, family: str) -> DataFrame:
    """object, ordinal, state, width and a family's typed columns from numbered lines, without header lines.

    Files of UNKNOWN names give no rows: headers() names them. A token that is not of its column's type is
    null, and width is the number of tokens.
    """
    met = rows.join(F.broadcast(headers(rows, family).where("state <> 'UNKNOWN'")), "object").where("state = 'HEADERLESS' or ordinal > 0")
    tokens = F.split(F.rtrim(F.col("line"), F.lit("\r")), ",", -1)
    typed = [F.get(tokens, F.lit(i)).try_cast(kind).alias(c) for i, (c, kind) in enumerate(columns_of(family))]
    return met.select("object", "ordinal", "state", F.size(tokens).alias("width"), *typed)


_SUMMARY = (
    "object string, block long, header boolean, records long, valid long, malformed long, bad_times long, violations long, units array<string>, "
    "earliest_us long, latest_us long, first_key array<string>, last_key array<string>, head array<array<string>>, tail array<array<string>>"
)
_SCALE = {"s": 10**6, "ms": 1000, "us": 1}


def time_of(token: str, least_us: int, most_us: int) -> tuple[str, int] | None:
    """(unit, microseconds) of an integer token, if it falls within bounds in just one of s, ms, us and ns."""
    if not token.removeprefix("-").isascii() or not token.removeprefix("-").isdigit():
        return None
    value = int(token)
    found = [(u, value * k) for u, k in _SCALE.items() if least_us <= value * k <= most_us]
    if least_us * 1000 <= value <= most_us * 1000:
        found.append(("ns", value // 1000))
    return found[0] if len(found) == 1 else None


class _Block:
    """What one block's lines say, in their order."""

    def __init__(self, key: tuple[str, int], audit: CsvAudit) -> None:
        self.key, self.audit, self.header = key, audit, None
        self.n = dict.fromkeys(("records", "valid", "malformed", "bad_times", "violations"), 0)
        self.units: set[str] = set()
        self.earliest = self.latest = self.first = self.last = None
        self.head: list[list[str]] = []
        self.tail: list[list[str]] = []

    def take(self, line: str) -> None:
        a, tokens = self.audit, next(csv.reader([line.removesuffix("\r")]), [])
        if self.key[1] == 0 and self.header is None:
            self.header = tokens == a.columns
            return
        self.n["records"] += 1
        if len(tokens) != len(a.columns):
            self.n["malformed"] += 1
            return
        if len(self.head) < a.samples:
            self.head.append(tokens)
        self.tail = [*self.tail, tokens][-a.samples :] if a.samples else []
        if a.order:
            key = [tokens[i] for i in a.order_at]
            self.n["violations"] += self.last is not None and key < self.last
            self.first, self.last = key if self.first is None else self.first, key
        if a.time_at is not None:
            found = time_of(tokens[a.time_at], *a.bounds)
            if found is None:
                self.n["bad_times"] += 1
                self.n["malformed"] += 1
                return
            self.units.add(found[0])
            self.earliest = found[1] if self.earliest is None else min(self.earliest, found[1])
            self.latest = found[1] if self.latest is None else max(self.latest, found[1])
        self.n["valid"] += 1

    def row(self) -> tuple:
        return (*self.key, self.header, *self.n.values(), sorted(self.units), self.earliest, self.latest, self.first, self.last, self.head, self.tail)


class CsvAudit:
    """What is asked of CSV files: their columns, and optionally a key, an order and a time with its bounds (2009 to 2100)."""

    def __init__(
        self, columns: list[str], key: list[str] | None = None, order: list[str] | None = None, time: str | None = None,
        bounds: tuple[int, int] = (1230768000 * 10**6, 4102444800 * 10**6), samples: int = 5,
    ) -> None:
        missing = [c for c in [*(key or []), *(order or []), *([time] if time else [])] if c not in columns]
        if missing:
            raise ValueError(f"not among the columns: {missing}")
        self.columns, self.key, self.order, self.bounds, self.samples = columns, key or [], order or [], bounds, samples
        self.order_at = [columns.index(c) for c in self.order]
        self.time_at = columns.index(time) if time else None

    def _summaries(self, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = None
        for part in parts:
            done = []
            for name, at, line in zip(part["object"], part["block"], part["line"]):
                if block is None or block.key != (name, at):
                    if block is not None:
                        done.append(block.row())
                    block = _Block((name, at), self)
                block.take(line)
            if done:
                yield pd.DataFrame(done, columns=_names(_SUMMARY))
        if block is not None:
            yield pd.DataFrame([block.row()], columns=_names(_SUMMARY))

    def _keys(self, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, header = [self.columns.index(c) for c in self.key], ("", -1)
        for part in parts:
            out = []
            for name, block, line in zip(part["object"], part["block"], part["line"]):
                if block == 0 and header != (name, block):
                    header = (name, block)
                    continue
                header = (name, block)
                tokens = next(csv.reader([line.removesuffix("\r")]), [])
                if len(tokens) == len(self.columns):
                    out.append((name, [tokens[i] for i in at]))
            yield pd.DataFrame(out, columns=["object", "key"])

    def run(self, found: DataFrame) -> DataFrame:
        """A row for each file of lines(): counts, order, times and samples; its first line is its header.

        object, header (the line is that of the columns), records, valid, malformed (other width, or a bad time),
        bad_times, violations (records whose order is under that of the one before, by text), duplicates (records
        whose key came before, null without a key), units, earliest_us, latest_us, head and tail (the first and
        last samples of right width). A record is a line; a quoted field does not go on to the next one.
        """
        firsts = found.groupBy("object").agg(F.min("block").alias("first"))  # a row for each file
        each = found.join(F.broadcast(firsts), "object").select("object", (F.col("block") - F.col("first")).alias("block"), "line")
        blocks = each.mapInPandas(self._summaries, _SUMMARY)
        before = Window.partitionBy("object").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        across = F.col("first_key") < F.last("last_key", ignorenulls=True).over(before)  # between two blocks
        met = blocks.withColumn("violations", F.col("violations") + F.coalesce(across.cast("long"), F.lit(0)))
        ends = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", c))), lambda x: x[c]))
        folded = met.groupBy("object").agg(
            F.bool_or("header").alias("header"), *(F.sum(c).alias(c) for c in ("records", "valid", "malformed", "bad_times", "violations")),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("units")))).alias("units"), F.min("earliest_us").alias("earliest_us"),
            F.max("latest_us").alias("latest_us"), F.slice(ends("head"), 1, max(self.samples, 1)).alias("head"), F.reverse(F.slice(F.reverse(ends("tail")), 1, max(self.samples, 1))).alias("tail"),
        )
        if not self.key:
            return folded.withColumn("duplicates", F.lit(None).cast("long"))
        keys = each.mapInPandas(self._keys, "object string, key array<string>").groupBy("object", "key").agg(F.count("*").alias("n"))
        again = keys.groupBy("object").agg(F.sum(F.col("n") - 1).alias("duplicates"))
        return folded.join(again, "object", "left").withColumn("duplicates", F.coalesce("duplicates", F.lit(0)))


def _names(ddl: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in ddl.split(", ")]


def ends(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first and last n rows of each key by order (which must be unique within a key), with side and place (from 1).

    Spark keeps n rows of a key in each task before the shuffle, so a key of any size costs n rows a task.
    A row within n of both ends comes twice.
    """
    out = []
    for side, by in (("head", [F.col(c).asc() for c in order]), ("tail", [F.col(c).desc() for c in order])):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
        out.append(df.withColumn("place", place).where(F.col("place") <= n).withColumn("side", F.lit(side)))
    return out[0].unionByName(out[1])
