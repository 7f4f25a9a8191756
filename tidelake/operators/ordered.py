"""Global orders without a window over the whole table: ranges of the order, and offsets between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _free(df: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def running_sums(df: DataFrame, order: list[str], sums: list[str], within: str | None = None) -> DataFrame:
    """df with each of sums replaced by its sum over all rows up to this one, by order (which must be unique).

    within names a first column of order at whose change the sums begin anew. Rows are dealt by ranges of
    the order, each range is summed on its own, and the totals of the ranges before are added: their
    number is that of partitions, which one task can rank. The ranges are kept by checkpoint().
    """
    part = _free(df, "part")
    dealt = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()).checkpoint()
    keys = [within] if within else []
    upto = Window.partitionBy(part, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = dealt.groupBy(part, *keys).agg(*(F.sum(c).alias(f"{part}_{i}") for i, c in enumerate(sums)))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(part, *keys, *(F.coalesce(F.sum(f"{part}_{i}").over(before), F.lit(0)).alias(f"{part}_{i}") for i in range(len(sums))))
    local = dealt.withColumns({c: F.sum(c).over(upto) for c in sums})
    met = local.join(ahead, [part, *keys])
    return met.select(*((F.col(c) + F.col(f"{part}_{sums.index(c)}")).alias(c) if c in sums else c for c in df.columns))


def ranked(df: DataFrame, order: list[str], name: str = "rank", within: str | None = None) -> DataFrame:
    """df with name, each row's rank from 0 by order (which must be unique); within: ranks begin anew at its change."""
    return running_sums(df.withColumn(name, F.lit(1).cast("long")), order, [name], within).withColumn(name, F.col(name) - 1)


def quantiles(df: DataFrame, column: str, wanted: dict[str, float]) -> DataFrame:
    """One row with a column for each wanted share: the exact quantile of column, interpolated between neighbours; null without values.

    Different values are counted and ranked by ranges, so no buffer holds a whole column.
    """
    levels = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).withColumn("upto", F.col("n"))
    placed = running_sums(levels, ["value"], ["upto"])
    total = placed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    met = placed.crossJoin(F.broadcast(total))  # one row
    at = lambda rank: F.max(F.when((rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")), F.col("value")))
    found = []
    for name, share in wanted.items():
        place = F.lit(share) * (F.col("total") - 1)
        part = F.max(place - F.floor(place))
        low, high = at(F.floor(place)), at(F.ceil(place))
        found.append((low + (high - low) * part).alias(name))
    return met.agg(*found)
