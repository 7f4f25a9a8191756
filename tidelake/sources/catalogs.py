"""Datasets as they lie in folders: views, loads that promote schemas, and files with equal content."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.sources.lines import lines, numbered

# fixed values: the logical tables and where each lies under a root
VIEWS = {
    "market_bars": "canonical/market_bars", "funding_cashflows": "canonical/funding_cashflows", "reference_assets": "canonical/reference_assets",
    "reference_instruments": "canonical/reference_instruments", "universe_snapshot": "derived/universe_snapshot",
    "factor_value": "derived/factor_value", "label_return": "derived/label_return",
}


def register_views(spark: SparkSession, root: str, names: Sequence[str] = tuple(VIEWS)) -> list[str]:
    """Temporary views of the tables under root, partition folders (a=b) as columns, so that filters on them leave files out."""
    for name in names:
        spark.read.parquet(f"{root}/{VIEWS[name]}").createOrReplaceTempView(name)
    return list(names)


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds values of both: integers, decimals, float and double, date and timestamp; else an error.

    A decimal of over 38 digits, and any number beside a float or double, become double.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE[max(_WHOLE.index(a), _WHOLE.index(b))]
    exact = [T.DecimalType(_DIGITS[t], 0) if t in _WHOLE else t for t in (a, b)]
    if all(isinstance(t, T.DecimalType) for t in exact):
        scale = max(t.scale for t in exact)
        digits = max(t.precision - t.scale for t in exact) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if all(isinstance(t, T.NumericType) for t in (a, b)):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def promoted(spark: SparkSession, paths: Sequence[str], at_once: int = 16) -> DataFrame:
    """All rows of the Parquet files or folders of one dataset, with every column that any has, in the wider type.

    A path that lacks a column has nulls there. Schemas are read from one footer a path, several at a
    time; paths of one schema are one scan, and scans are joined by a union of casts, through which
    Spark still hands filters and columns down to each scan.
    """
    if not paths:
        raise ValueError("no paths")
    with ThreadPoolExecutor(at_once) as pool:
        schemas = list(pool.map(lambda p: spark.read.parquet(p).schema, paths))
    target: dict[str, T.DataType] = {}
    for field in (f for s in schemas for f in s.fields):
        target[field.name] = wider(target[field.name], field.dataType) if field.name in target else field.dataType
    scans: dict[str, list[str]] = {}
    for path, schema in zip(paths, schemas):
        scans.setdefault(schema.json(), []).append(path)
    parts = []
    for shape, members in scans.items():
        schema = T.StructType.fromJson(json.loads(shape))
        held = {f.name: f.dataType for f in schema.fields}
        column = lambda n, t, held=held: F.lit(None).cast(t) if n not in held else F.col(f"`{n}`").cast(t) if held[n] != t else F.col(f"`{n}`")
        parts.append(spark.read.schema(schema).parquet(*members).select(*(column(n, t).alias(n) for n, t in target.items())))
    return reduce(DataFrame.unionByName, parts)


def classified(path: Column, rules: Sequence[tuple[str, str]], other: str = "OTHER") -> Column:
    """The first class whose pattern a path holds."""
    found = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, pattern in rules:
        found = found.when(path.rlike(pattern), name)
    return found.otherwise(other)


def content_ids(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """object, bytes, lines, content of text files: files have the same content id if, but for collisions, they are equal.

    The id adds up SHA-256 words of (ordinal, line) over a file, with its size and whether it ends in a line
    feed, so files of any size are read in blocks, partly added up where they lie, and no value holds a file.
    With parts an object is a folder (see lines()), whose id is that of its one text, wherever its parts end.
    """
    rows = numbered(lines(spark, path, parts))
    digest = F.sha2(F.concat_ws("|", F.col("ordinal").cast("string"), F.col("newline").cast("string"), "line").cast("binary"), 256)
    word = lambda i: F.bit_xor(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("long"))
    summed = rows.groupBy("object").agg(F.first("size").alias("bytes"), F.count("*").alias("lines"), *(word(i).alias(f"w{i}") for i in range(4)))
    text = F.concat_ws(":", "bytes", "lines", *(F.lpad(F.lower(F.hex(f"w{i}")), 15, "0") for i in range(4)))
    return summed.select("object", "bytes", "lines", text.alias("content"))


def duplicates(files: DataFrame, key: str = "object") -> DataFrame:
    """key, copies, stands of files (key, content): how many have that content, and the first of them."""
    same = files.groupBy("content").agg(F.count("*").alias("copies"), F.min(key).alias("stands"))
    return files.join(same, "content").select(key, "copies", "stands")
