"""Quality checks: rows in; accepted rows, issues and diagnostics out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.checks import sound_ohlc, value_class
from tidelake.operators.ordered import ranked


def issue(bad: Column, code: str, severity: str = "ERROR", **context: Column) -> Column:
    """A struct (code, severity, context) where bad holds, else null."""
    entries = [x for k, v in context.items() for x in (F.lit(k), v.cast("string"))]
    held = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), held.alias("context")))


def with_issues(rows: DataFrame, *checks: Column) -> DataFrame:
    """rows with issues, the array of those that hold."""
    return rows.withColumn("issues", F.array_compact(F.array(*checks)))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(~F.exists("issues", lambda x: x["severity"] == "ERROR")).drop("issues")


def issue_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, code, severity, context: a row for each issue."""
    return rows.select(*keys, F.explode("issues").alias("x")).select(*keys, "x.*")


def assert_empty(violations: DataFrame, what: str) -> None:
    """Fail closed: an action that raises if there is any violation."""
    if first := violations.limit(1).collect():
        raise ValueError(f"{what}: {first[0].asDict()}")


def check_trades(trades: DataFrame) -> DataFrame:
    """trades with issues: price and quantity positive, an id, a time."""
    return with_issues(
        trades,
        issue(~(F.col("price") > 0), "non_positive_price", price=F.col("price")),
        issue(~(F.col("quantity") > 0), "non_positive_quantity", quantity=F.col("quantity")),
        issue(F.coalesce(F.col("trade_id").cast("string"), F.lit("")) == "", "missing_trade_id"),
        issue(F.col("ts_us").isNull(), "missing_time"),
    )


def check_candles(candles: DataFrame, interval_us: int) -> DataFrame:
    """candles (open_us, close_us, OHLC, volume) with issues: sound prices, aligned open, close one unit before the next open."""
    return with_issues(
        candles,
        issue(~sound_ohlc(*(F.col(c) for c in ("open", "high", "low", "close", "volume"))), "unsound_ohlc"),
        issue(F.pmod("open_us", F.lit(interval_us)) != 0, "misaligned_open", open_us=F.col("open_us")),
        issue(F.col("close_us") != F.col("open_us") + interval_us - 1, "close_mismatch", close_us=F.col("close_us")),
    )


def profile(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column, rows, nulls, distinct, classes (sorted list), least and most (as numbers, else null) for each column.

    Equal values of a column are counted first, partly before the shuffle, so a value is looked at once.
    """
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns)))
    levels = rows.select(each.alias("x")).groupBy("x.column", "x.v").agg(F.count("*").alias("n"))
    number = F.expr("try_cast(v AS double)")
    return levels.withColumn("kind", value_class(F.col("v"))).groupBy("column").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count("v").alias("distinct"),
        F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("classes"), F.min(number).alias("least"), F.max(number).alias("most"),
    )


# fixed values: names that tell a column's role, in any case of letters
TIME_NAMES = ("timestamp", "ts", "time", "datetime", "date", "open_time", "close_time", "event_time")
PRICE_NAMES = {"open": "open", "high": "high", "low": "low", "close": "close", "o": "open", "h": "high", "l": "low", "c": "close"}


def resolve_columns(columns: list[str], mapping: dict[str, str] | None = None) -> tuple[dict[str, str], list[tuple[str, str, str]]]:
    """(column of each role, issues): the roles are timestamp, open, high, low and close.

    A role in mapping has that column, or none if the table lacks it. Otherwise a single column with a name of
    the role has it. Issues are (code, severity, role): mapping_missing_column (ERROR), mapping_ambiguous (ERROR:
    several names fit), inferred_by_name (WARNING), mapping_absent (WARNING).
    """
    mapping, roles, issues = mapping or {}, {}, []
    for role in ("timestamp", "open", "high", "low", "close"):
        fits = [c for c in columns if (c.lower() in TIME_NAMES if role == "timestamp" else PRICE_NAMES.get(c.lower()) == role)]
        if role in mapping:
            if mapping[role] in columns:
                roles[role] = mapping[role]
            else:
                issues.append(("mapping_missing_column", "ERROR", role))
        elif len(fits) == 1:
            roles[role] = fits[0]
            issues.append(("inferred_by_name", "WARNING", role))
        else:
            issues.append(("mapping_ambiguous", "ERROR", role) if fits else ("mapping_absent", "WARNING", role))
    return roles, issues


def profile_roles(rows: DataFrame, roles: dict[str, str]) -> DataFrame:
    """One row: rows, first and last timestamp, and unsound, the rows whose prices contradict each other; null for roles that are not there."""
    prices = [roles.get(r) for r in ("open", "high", "low", "close")]
    sound = F.count_if(~sound_ohlc(*(F.col(c) for c in prices))) if all(prices) else F.lit(None).cast("long")
    at = roles.get("timestamp")
    ends = [F.min(at).alias("first"), F.max(at).alias("last")] if at else [F.lit(None).alias("first"), F.lit(None).alias("last")]
    return rows.agg(F.count("*").alias("rows"), *ends, sound.alias("unsound"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """duplicate_keys, surplus_rows: keys that come more than once and the rows beyond the first; null is a value."""
    counted = rows.groupBy(*keys).count()
    return counted.agg(F.count_if(F.col("count") > 1).alias("duplicate_keys"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("surplus_rows"))


def cadence(rows: DataFrame, key: str, at: str) -> DataFrame:
    """key, deltas, median (the lower), gaps (deltas over 3 medians), monotonic, in the order of `at`."""
    step = F.col(at) - F.lag(at).over(Window.partitionBy(key).orderBy(at))
    steps = rows.select(key, step.alias("d")).where("d is not null")
    median = steps.groupBy(key).agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY d)").cast("long").alias("median"))
    return steps.join(median, key).groupBy(key, "median").agg(F.count("*").alias("deltas"), F.count_if(F.col("d") > 3 * F.col("median")).alias("gaps"))


def ordering(rows: DataFrame, key: str, ordinal: str, at: str) -> DataFrame:
    """key, rows, ups, downs, order: ascending, descending, mixed, flat or single, of `at` in the order of ordinal."""
    before = F.lag(at).over(Window.partitionBy(key).orderBy(ordinal))
    found = rows.select(key, F.col(at).alias("x"), before.alias("b")).groupBy(key).agg(F.count("*").alias("rows"), F.count_if(F.col("x") > F.col("b")).alias("ups"), F.count_if(F.col("x") < F.col("b")).alias("downs"))
    kind = F.when(F.col("rows") == 1, "single").when((F.col("ups") > 0) & (F.col("downs") > 0), "mixed").when(F.col("ups") > 0, "ascending").when(F.col("downs") > 0, "descending").otherwise("flat")
    return found.withColumn("order", kind)


def gaps(rows: DataFrame, key: str, at: str, step: int) -> DataFrame:
    """key, after, before, missing: neighbours further apart than step."""
    after = F.lag(at).over(Window.partitionBy(key).orderBy(at))
    near = rows.select(key, after.alias("after"), F.col(at).alias("before"))
    return near.where(F.col("before") - F.col("after") > step).withColumn("missing", F.floor((F.col("before") - F.col("after") - 1) / step))


def contiguous_prefix(rows: DataFrame, key: str, at: str, step: int) -> DataFrame:
    """key, prefix_end, length: how far each key's times go on step by step from its first."""
    order = Window.partitionBy(key).orderBy(at)
    distinct = rows.select(key, at).distinct()
    marked = distinct.withColumn("bad", (F.coalesce(F.col(at) - F.lag(at).over(order), F.lit(step)) != step).cast("int"))
    run = marked.withColumn("broken", F.max("bad").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return run.where("broken = 0").groupBy(key).agg(F.max(at).alias("prefix_end"), F.count("*").alias("length"))


def missing(rows: DataFrame, bounds: DataFrame, key: str, at: str, step: int) -> DataFrame:
    """key, at: expected times of bounds (key, first, last) that rows lack."""
    grid = bounds.select(key, F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(step))).alias(at))
    return grid.join(rows.select(key, at), [key, at], "left_anti")


def interval_union(intervals: DataFrame, key: str) -> DataFrame:
    """key, covered, has_gap, has_overlap, first, last of closed integer intervals (key, start, end)."""
    order = Window.partitionBy(key).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("reach", reach)
    new = F.greatest(F.lit(0).cast("long"), F.col("end") - F.greatest(F.col("start") - 1, F.coalesce("reach", F.col("start") - 1)))
    return marked.groupBy(key).agg(
        F.sum(new).alias("covered"), F.coalesce(F.bool_or(F.col("start") > F.col("reach") + 1), F.lit(False)).alias("has_gap"),
        F.coalesce(F.bool_or(F.col("start") <= F.col("reach")), F.lit(False)).alias("has_overlap"), F.min("start").alias("first"), F.max("end").alias("last"),
    )


def transitions(log: DataFrame, allowed: DataFrame, key: str, order: list[str]) -> DataFrame:
    """log rows whose state may not follow the one before: key, order, before (null at the start), state.

    allowed: before (null: may be first), state.
    """
    before = F.lag("state").over(Window.partitionBy(key).orderBy(*order))
    steps = log.select(key, *order, before.alias("before"), "state")
    a = F.broadcast(allowed.select(F.col("before").alias("b"), F.col("state").alias("s")))
    return steps.join(a, F.col("before").eqNullSafe(F.col("b")) & (F.col("state") == F.col("s")), "left_anti")


def conflicting_ids(rows: DataFrame, id_: str, content: list[str], object_: str) -> DataFrame:
    """id, occurrences, objects, kind (exact or conflicting) of ids that come more than once."""
    print_ = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    found = rows.groupBy(id_).agg(F.count("*").alias("occurrences"), F.count_distinct(print_).alias("kinds"), F.count_distinct(object_).alias("objects"))
    return found.where("occurrences > 1").select(id_, "occurrences", "objects", F.when(F.col("kinds") == 1, "exact").otherwise("conflicting").alias("kind"))


def page_diagnostics(pages: DataFrame, page: str, position: str, id_: str, order: str) -> DataFrame:
    """page, rows, disordered, repeats (ids seen on another page), boundary_overlap (its first id is the last of the page before)."""
    inside = Window.partitionBy(page).orderBy(position)
    rows = pages.select(page, position, id_, (F.col(order) < F.lag(order).over(inside)).alias("down"))
    seen = rows.groupBy(id_).agg(F.count_distinct(page).alias("on")).where("on > 1").select(id_, F.lit(1).alias("again"))
    per = rows.join(seen, id_, "left").groupBy(page).agg(F.count("*").alias("rows"), F.count_if("down").alias("disordered"), F.count_if(F.col("again") == 1).alias("repeats"), F.min_by(id_, position).alias("head"), F.max_by(id_, position).alias("tail"))
    placed = ranked(per, [page], "__place")
    before = placed.select((F.col("__place") + 1).alias("__place"), F.col("tail").alias("__before"))
    met = placed.drop("tail").join(before, "__place", "left")
    return met.withColumn("boundary_overlap", F.coalesce(F.col("head") == F.col("__before"), F.lit(False))).drop("head", "__before", "__place")
