"""Object listings, storage figures, samples of objects, books and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.ordered import quantiles, ranked


def coverage_span(rows: DataFrame, keys: list[str], at: str, bad: Column | None = None) -> DataFrame:
    """keys, rows, first, last, bad: how far each key's rows reach."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(at).alias("first"), F.max(at).alias("last"), F.count_if(bad if bad is not None else F.lit(False)).alias("bad"))


def unit_distribution(rows: DataFrame, side: str, unit: str) -> DataFrame:
    """side, unit, rows, rate, dominant: which units each side's times are written in; ties go to the lesser unit."""
    counted = rows.groupBy(side, unit).agg(F.count("*").alias("rows"))
    of = Window.partitionBy(side)
    return counted.withColumn("rate", F.col("rows") / F.sum("rows").over(of)).withColumn("dominant", F.row_number().over(of.orderBy(F.desc("rows"), unit)) == 1)


def digest(rows: DataFrame, columns: list[str], parts: int = 1024) -> DataFrame:
    """rows, digest: SHA-256 of a row set, repeats included, that no order changes.

    Rows are hashed and dealt by hash to parts, each part's sorted hashes are hashed, and the parts'
    hashes in turn, so no task gathers more than a part.
    """
    text = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    hashed = rows.select(F.sha2(text, 256).alias("h"))
    part = F.pmod(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), F.lit(parts))
    each = hashed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("h"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "h"))), lambda x: F.concat_ws(":", x["part"].cast("string"), x["h"])), "\n")
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.sha2(whole, 256).alias("digest"))


def storage_stats(samples: DataFrame, upper: float, rows_ahead: dict[str, int], factor: float = 1.0) -> DataFrame:
    """median, upper, most bytes per row of samples (bytes, rows > 0) and what each named count of rows would need at the upper one."""
    per = samples.where("rows > 0").select((F.col("bytes") / F.col("rows")).alias("x"))
    found = quantiles(per, "x", {"median": 0.5, "upper": upper, "most": 1.0})
    return found.select("*", *((F.col("upper") * n * factor).alias(name) for name, n in rows_ahead.items()))


def cohorts(members: DataFrame, key: str, size: int) -> DataFrame:
    """key, cohort of the different members: so many in order of key to a cohort, the last one smaller. Ranks are counted by ranges."""
    placed = ranked(members.select(key).distinct(), [key], "cohort")
    return placed.withColumn("cohort", F.floor(F.col("cohort") / size))


def largest_ratio(samples: DataFrame, key: str, top: str, below: str) -> DataFrame:
    """key, top, below of the sample with the greatest top / below per key; equal ratios go to the greater top."""
    ratio = F.struct((F.col(top) / F.col(below)).alias("r"), F.col(top))
    return samples.where(F.col(below) > 0).groupBy(key).agg(F.max_by(F.struct(top, below), ratio).alias("x")).select(key, f"x.{top}", f"x.{below}")


def ceil_div(a: Column, b: int | Column) -> Column:
    b = F.lit(b) if isinstance(b, int) else b
    return F.ceil((a + b - 1 - F.pmod(a + b - 1, b)) / b)


def physical_bytes(claims: DataFrame, key: str, size: str) -> DataFrame:
    """objects, bytes, unknown of the different objects that claims name, each once; a null size is unknown, never zero."""
    one = claims.groupBy(key).agg(F.max(size).alias("size"))
    return one.agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"), F.count_if(F.col("size").isNull()).alias("unknown"))


def eras(objects: DataFrame, group: list[str], order: list[str], n: int = 3) -> DataFrame:
    """objects with era min(n - 1, floor(n * i / count)) in order within group, and chosen: the smallest positive one of its era."""
    of = Window.partitionBy(*group)
    i = F.row_number().over(of.orderBy(*order)) - 1
    placed = objects.withColumn("era", F.least(F.lit(n - 1), F.floor(n * i / F.count("*").over(of))).cast("int"))
    best = Window.partitionBy(*group, "era").orderBy(F.when(F.col("size") > 0, F.col("size")).asc_nulls_last(), *order)
    return placed.withColumn("chosen", (F.row_number().over(best) == 1) & (F.coalesce("size", F.lit(0)) > 0))


def regimes(objects: DataFrame, group: list[str], key: str) -> DataFrame:
    """regime (early, middle, recent) and place (smallest first, unknown sizes last) of each group's objects.

    Thirds by key with the rest in recent; of fewer than three, the first, the one at half, the last.
    """
    of = Window.partitionBy(*group)
    placed = objects.withColumn("i", F.row_number().over(of.orderBy(key)) - 1).withColumn("n", F.count("*").over(of))
    third = F.floor(F.col("n") / 3)
    name = F.when(F.col("i") < third, "early").when(F.col("i") < 2 * third, "middle").otherwise("recent")
    few = F.array_compact(F.array(F.when(F.col("i") == 0, "early"), F.when(F.col("i") == F.floor(F.col("n") / 2), "middle"), F.when(F.col("i") == F.col("n") - 1, "recent")))
    each = placed.withColumn("regime", F.explode(F.when(F.col("n") < 3, few).otherwise(F.array(name))))
    smallest = Window.partitionBy(*group, "regime").orderBy(F.col("size").asc_nulls_last(), key)
    return each.withColumn("place", F.row_number().over(smallest)).drop("i", "n")


def first_middle_last(objects: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first, the (n div 2 + 1)-th and the last of each group, each once."""
    of = Window.partitionBy(*group)
    placed = objects.withColumn("i", F.row_number().over(of.orderBy(*order))).withColumn("n", F.count("*").over(of))
    return placed.where((F.col("i") == 1) | (F.col("i") == F.floor(F.col("n") / 2) + 1) | (F.col("i") == F.col("n"))).drop("i", "n")


def month_gaps(rows: DataFrame, group: list[str], month: str) -> DataFrame:
    """group, month of the months between each group's first and last (as year * 12 + month numbers) that it lacks."""
    have = rows.select(*group, month).distinct()
    span = have.groupBy(*group).agg(F.min(month).alias("a"), F.max(month).alias("z"))
    return span.select(*group, F.explode(F.sequence("a", "z")).alias(month)).join(have, [*group, month], "left_anti")


def book_state(bid: Column, bid_qty: Column, ask: Column, ask_qty: Column) -> Column:
    """TWO_SIDED, BID_ONLY, ASK_ONLY or EMPTY; or the error NEGATIVE, SIZE_WITHOUT_PRICE or CROSSED."""
    return (
        F.when(F.least(bid, bid_qty, ask, ask_qty) < 0, "NEGATIVE").when(((bid <= 0) & (bid_qty > 0)) | ((ask <= 0) & (ask_qty > 0)), "SIZE_WITHOUT_PRICE")
        .when((bid > 0) & (ask > 0) & (bid > ask), "CROSSED").when((bid > 0) & (ask > 0), "TWO_SIDED").when(bid > 0, "BID_ONLY").when(ask > 0, "ASK_ONLY").otherwise("EMPTY")
    )


def book_verdict(quotes: DataFrame, object_: str, at: str, ordinal: str) -> DataFrame:
    """object, rows, each state's count, first, last, back_steps (times that fall), verdict PASS or FAIL."""
    step = F.col(at) < F.lag(at).over(Window.partitionBy(object_).orderBy(ordinal))
    rows = quotes.withColumn("state", book_state(*(F.col(c) for c in ("bid", "bid_qty", "ask", "ask_qty")))).withColumn("back", step)
    good = ("TWO_SIDED", "BID_ONLY", "ASK_ONLY", "EMPTY")
    found = rows.groupBy(object_).agg(
        F.count("*").alias("rows"), *(F.count_if(F.col("state") == s).alias(s.lower()) for s in good), F.count_if(~F.col("state").isin(*good)).alias("errors"),
        F.min(at).alias("first"), F.max(at).alias("last"), F.count_if("back").alias("back_steps"),
    )
    return found.withColumn("verdict", F.when((F.col("errors") == 0) & (F.col("back_steps") == 0) & (F.col("two_sided") > 0), "PASS").otherwise("FAIL"))


def integrity(objects: DataFrame, key: str, checksums: DataFrame, quarantined: DataFrame, proved: DataFrame) -> DataFrame:
    """objects with state (quarantined, sidecar_absent, checksum_proved_retained, sidecar_listed, in that order) and selectable."""
    out = objects
    for name, side in (("has_sum", checksums), ("is_bad", quarantined), ("is_proved", proved)):
        out = out.join(side.select(key).distinct().withColumn(name, F.lit(True)), key, "left")
    state = F.when(F.col("is_bad"), "quarantined").when(F.col("has_sum").isNull(), "sidecar_absent").when(F.col("is_proved"), "checksum_proved_retained").otherwise("sidecar_listed")
    return out.withColumn("state", state).withColumn("selectable", F.col("state").isin("sidecar_listed", "checksum_proved_retained")).drop("has_sum", "is_bad", "is_proved")


def tile_coverage(plans: DataFrame, receipts: DataFrame, key: str, step: int) -> DataFrame:
    """key, done, pending, misaligned: tiles of plans (key, start, end) that receipts (key, start, end) finish, and receipts that are no tile."""
    tiles = plans.select(key, F.explode(F.sequence("start", "end", F.lit(step))).alias("a"), F.col("end").alias("e")).select(key, F.col("a").alias("start"), F.least(F.col("a") + step - 1, "e").alias("end"))
    met = tiles.withColumn("tile", F.lit(1)).join(receipts.select(key, "start", "end").distinct().withColumn("done", F.lit(1)), [key, "start", "end"], "full_outer")
    return met.groupBy(key).agg(F.count_if(F.col("tile").isNotNull() & F.col("done").isNotNull()).alias("done"), F.count_if(F.col("done").isNull()).alias("pending"), F.count_if(F.col("tile").isNull()).alias("misaligned"))


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """side, rows: how many rows, repeats included, only one of two tables has."""
    only = lambda x, y, n: x.exceptAll(y).agg(F.count("*").alias("rows")).select(F.lit(n).alias("side"), "rows")
    return only(a, b, "only_a").unionByName(only(b, a, "only_b"))


def receipts(requests: DataFrame, keys: list[str]) -> DataFrame:
    """keys, attempts, throttled, latency, bytes, last_status, succeeded of request receipts (status, attempt, latency_ms, bytes)."""
    return requests.groupBy(*keys).agg(
        F.count("*").alias("attempts"), F.count_if(F.col("status") == 429).alias("throttled"), F.sum("latency_ms").alias("latency"), F.sum("bytes").alias("bytes"),
        F.max_by("status", "attempt").alias("last_status"), F.bool_or(F.col("status") == 200).alias("succeeded"),
    )


def oriented(pairs: DataFrame, stables: DataFrame) -> DataFrame:
    """pairs (token0, token1) with base, quote, quote_symbol where just one side is a stable (token, symbol); others are left out."""
    side = lambda n: F.broadcast(stables.select(F.col("token").alias(f"token{n}"), F.col("symbol").alias(f"s{n}")))  # noqa: E731  a short, reviewed list
    met = pairs.join(side(0), "token0", "left").join(side(1), "token1", "left").where("(s0 is null) <> (s1 is null)")
    zero = F.col("s0").isNotNull()
    return met.select(*pairs.columns, F.when(zero, F.col("token1")).otherwise(F.col("token0")).alias("base"), F.when(zero, F.col("token0")).otherwise(F.col("token1")).alias("quote"), F.coalesce("s0", "s1").alias("quote_symbol"))


# ---- evidence


def evidence_summary(versions: DataFrame, decisions: DataFrame, links: DataFrame) -> DataFrame:
    """hypothesis, version, lifecycle (of its last decision), evidence, supports, contradicts, qualifies."""
    last = decisions.groupBy("hypothesis").agg(F.max_by("lifecycle", F.struct("at", "decision")).alias("lifecycle"))
    counted = links.groupBy("hypothesis", "version").agg(F.count("*").alias("evidence"), *(F.count_if(F.col("direction") == d.upper()).alias(d) for d in ("supports", "contradicts", "qualifies")))
    out = versions.join(last, "hypothesis", "left").join(counted, ["hypothesis", "version"], "left")
    return out.fillna(0, ["evidence", "supports", "contradicts", "qualifies"]).select("hypothesis", "version", "lifecycle", "evidence", "supports", "contradicts", "qualifies")


def snapshot(links: DataFrame, items: DataFrame, as_of: int) -> DataFrame:
    """hypothesis, version, evidence_id, kind of what was linked, and itself registered, by as_of."""
    known = items.where(F.col("registered") <= as_of).select("evidence_id", "kind", "integrity")
    return links.where(F.col("registered") <= as_of).select("hypothesis", "version", "evidence_id").join(known, "evidence_id")


def admissible(linked: DataFrame, weak: list[str]) -> DataFrame:
    """hypothesis, version, admissible: evidence that is not of weak kinds alone, and none with integrity FAIL."""
    return linked.groupBy("hypothesis", "version").agg((F.bool_or(~F.col("kind").isin(*weak)) & ~F.bool_or(F.coalesce(F.col("integrity") == "FAIL", F.lit(False)))).alias("admissible"))


def dependency_faults(edges: DataFrame, datasets: DataFrame) -> DataFrame:
    """child, parent, fault: a parent that is no dataset, or an edge that comes twice."""
    gone = edges.join(datasets.select(F.col("dataset").alias("parent")), "parent", "left_anti").select("child", "parent").distinct().withColumn("fault", F.lit("missing_parent"))
    twice = edges.groupBy("child", "parent").count().where("count > 1").select("child", "parent", F.lit("duplicate_edge").alias("fault"))
    return gone.unionByName(twice)
