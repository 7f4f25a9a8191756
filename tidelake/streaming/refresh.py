"""Streams that refresh published tables: versioned snapshots, corrections of finished bars, repeated ids, serving order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.streaming.twins import Folded


class Snapshots:
    """Full snapshots of a keyed table at path, a version for each micro-batch; no version is ever changed.

    A version holds data only for the partitions that its batch touched, and a manifest that says which
    version each partition is in. Batch n reads version n - 1 and writes version n, whatever stands there,
    so a batch that is run again gives the same. The manifest is written last: without it a version is not there.
    """

    def __init__(self, path: str, keys: list[str], part: str, order: str) -> None:
        self.path, self.keys, self.part, self.order = path.rstrip("/"), keys, part, order

    def _manifest(self, spark: SparkSession, n: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/manifest/n={n}")

    def _rows(self, spark: SparkSession, manifest: DataFrame) -> DataFrame:
        # both columns are folders, so the join prunes files before they are read
        return spark.read.parquet(f"{self.path}/data").join(manifest, [self.part, "version"], "left_semi")

    def merge(self, batch: DataFrame, n: int) -> None:
        """Version n: version n - 1 with the rows of batch, which win over older ones of their key (the last by order wins in the batch)."""
        spark, columns = batch.sparkSession, batch.columns
        row = F.struct(*columns)
        newest = batch.groupBy(*self.keys).agg(F.max_by(row, self.order).alias("row")).select("row.*").withColumn("rank", F.lit(1))
        touched = batch.select(self.part).distinct()
        manifest = self._manifest(spark, n - 1) if n else None
        if manifest is not None:
            old = self._rows(spark, manifest.join(touched, self.part, "left_semi")).select(*columns).withColumn("rank", F.lit(0))
            newest = old.unionByName(newest).groupBy(*self.keys).agg(F.max_by(row, "rank").alias("row")).select("row.*")
        to = newest.select(*columns).repartition(self.part).sortWithinPartitions(self.part, *self.keys)
        to.write.mode("overwrite").partitionBy(self.part).parquet(f"{self.path}/data/version={n}")
        now = touched.withColumn("version", F.lit(n))
        if manifest is not None:
            now = now.unionByName(manifest.join(touched, self.part, "left_anti"))
        now.write.mode("overwrite").parquet(f"{self.path}/manifest/n={n}")

    def read(self, spark: SparkSession, n: int | None = None) -> DataFrame:
        """The rows of version n, the latest by default."""
        if n is None:
            n = spark.read.parquet(f"{self.path}/manifest").agg(F.max("n")).first()[0]
        return self._rows(spark, self._manifest(spark, n)).drop("version")

    def follow(self, stream: DataFrame, log: str) -> None:
        """Merges every micro-batch that there is now; log: the stream's checkpoint, one for this path."""
        writer = stream.writeStream.foreachBatch(self.merge).trigger(availableNow=True).option("checkpointLocation", log)
        writer.start().awaitTermination()


def corrected_bars(trades: DataFrame, interval_us: int, late_us: int) -> Folded:
    """A stream's bars, once, when they are finished, and every later change to one as a correction; nothing is mutated.

    trades: instrument_id, known_at (timestamp, when a trade came to be known: the stream's order), known_us,
    ts_us, trade_id, price, quantity. A bar is finished late_us after its end, by known_at. Rows: kind FINAL
    (revision 0), with the bar of what was known by then, or CORRECTION (revisions from 1), one for each
    trade known later, with before_close and before_volume; a bar that nothing was known of at its finish has
    corrections only. The state of a bar is a few numbers, whatever its trades, and rows do not depend on
    where micro-batches begin. A bar's state stays, since a correction may always come; a source with a last
    date for corrections drops them before. A trade that comes after later ones counts as known with the last of them.
    """
    key = ["instrument_id", "period_us"]
    finish = F.col("period_us") + interval_us + late_us

    def fold(batch: DataFrame, made: DataFrame | None) -> DataFrame:
        seen = made.agg(F.max("known_us")).first()[0] if made is not None else None
        known = F.greatest("known_us", F.lit(seen).cast("long"))
        top = batch.agg(F.max("known_us")).first()[0]
        mark = max((x for x in (seen, top) if x is not None), default=None)
        rows = batch.withColumns({"period_us": F.col("ts_us") - F.pmod("ts_us", F.lit(interval_us)), "known_us": known}).select(
            *key, F.lit(True).alias("fresh"), "known_us", "trade_id", F.lit(1).cast("long").alias("n"), F.col("quantity").cast("double").alias("volume"), F.col("price").alias("high"), F.col("price").alias("low"),
            F.struct("ts_us", "trade_id", "price").alias("newest"), (F.col("known_us") >= finish).alias("late"), F.lit(False).alias("published"), (F.col("known_us") >= finish).cast("long").alias("revision"),
        )
        if made is not None:
            state = made.where("last_in").withColumns({"fresh": F.lit(False), "late": F.lit(False), "published": F.col("published") | F.col("due")})
            rows = rows.unionByName(state.select(*rows.columns))
        order = Window.partitionBy(*key).orderBy("fresh", "known_us", "trade_id")
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        run = rows.withColumns(
            {c: F.sum(c).over(upto) for c in ("n", "volume", "revision")} | {c: F.max(c).over(upto) for c in ("high", "newest")}
            | {"low": F.min("low").over(upto), "published": F.bool_or(F.col("published") | F.col("late")).over(upto), "last_in": F.lead("fresh").over(order).isNull()}
        )
        before = F.lag(F.struct(F.col("newest.price").alias("close"), "high", "low", "volume", "n", "published")).over(order)
        due = F.col("last_in") & ~F.col("published") & F.coalesce(F.floor(finish / 1000) < F.floor(F.lit(mark).cast("long") / 1000), F.lit(False))
        return run.withColumn("before", before).withColumn("due", due)

    def given(made: DataFrame) -> DataFrame:
        bar = ("close", "high", "low", "volume", "n")
        names = ("kind", "revision", *bar, "before_close", "before_volume")

        def row(kind: str, revision: Column, values: dict[str, Column], close: Column, volume: Column) -> Column:
            return F.struct(*(c.alias(n) for n, c in zip(names, (F.lit(kind), revision, *(values[b] for b in bar), close, volume))))

        none, old = F.lit(None).cast("double"), {c: F.col("before")[c] for c in bar}
        now = {c: F.col(c) for c in bar} | {"close": F.col("newest.price")}
        zero = F.lit(0).cast("long")
        first = F.col("fresh") & F.col("late") & F.col("before").isNotNull() & ~F.col("before.published")
        found = [
            F.when(first, row("FINAL", zero, old, none, none)), F.when(F.col("fresh") & F.col("late"), row("CORRECTION", F.col("revision"), now, old["close"], old["volume"])),
            F.when(F.col("due"), row("FINAL", zero, now, none, none)),
        ]
        return made.select(*key, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).select(*key, "x.*")

    return Folded(trades, fold, given)


def repeats(rows: DataFrame, key: str, order: str, late: str) -> Folded:
    """key, order, again of every row of a stream (with ts): false for the first of its key, true for what repeats it.

    A key is remembered until the watermark is `late` past its last row; rows of a batch come by ts and order.
    """

    def fold(batch: DataFrame, made: DataFrame | None) -> DataFrame:
        fresh = batch.select(key, order, "ts", F.lit(True).alias("fresh"))
        if made is not None:
            mark = made.agg(F.unix_micros(F.max("ts") - F.expr(f"interval {late}"))).first()[0]  # the watermark when the batch before had come
            seen = made.groupBy(key).agg(F.max("ts").alias("ts"))
            if mark is not None:
                seen = seen.where(F.col("ts").isNull() | (F.unix_micros("ts") >= mark))
            fresh = fresh.unionByName(seen.withColumn("fresh", F.lit(False)), allowMissingColumns=True)
        turn = F.row_number().over(Window.partitionBy(key).orderBy("fresh", "ts", order))
        return fresh.withColumn("again", turn > 1)

    return Folded(rows, fold, lambda made: made.where("fresh").select(key, order, "again"))


def advancing(asked: DataFrame, key: str, order: str, at: str) -> Folded:
    """key, order, at, accepted of every row of a stream: only one whose `at` is over all before it of its key, by order, is."""

    def fold(batch: DataFrame, made: DataFrame | None) -> DataFrame:
        rows = batch.select(key, order, F.col(at).cast("long").alias(at), F.lit(True).alias("fresh"))
        if made is not None:
            rows = rows.unionByName(made.groupBy(key).agg(F.max(at).alias(at)).withColumn("fresh", F.lit(False)), allowMissingColumns=True)
        before = Window.partitionBy(key).orderBy("fresh", order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("accepted", F.coalesce(F.col(at) > F.max(at).over(before), F.lit(True)))

    return Folded(asked, fold, lambda made: made.where("fresh").select(key, order, at, "accepted"))
