"""Point-in-time access: what was known at a decision time, for all keys and times at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.checks import close_to


def observation_eligible(t: Column, availability: Column, valid_from: Column | None = None, valid_to: Column | None = None) -> Column:
    """Available at t and valid at t, both bounds included; a null bound is open, a null availability is never."""
    test = F.coalesce(availability <= t, F.lit(False))
    for bound, fits in ((valid_from, lambda b: b <= t), (valid_to, lambda b: b >= t)):
        if bound is not None:
            test = test & (bound.isNull() | fits(bound))
    return test


def reference_eligible(t: Column, k: Column, valid_from: Column, valid_to: Column, known_from: Column, known_to: Column) -> Column:
    """valid_from <= t < valid_to and known_from <= k < known_to, and known_from <= t; null ends are open, null beginnings never."""
    test = (valid_from <= t) & (known_from <= k) & (known_from <= t)
    return F.coalesce(test, F.lit(False)) & (valid_to.isNull() | (t < valid_to)) & (known_to.isNull() | (k < known_to))


def latest(decisions: DataFrame, facts: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """decisions (key, t) with fields of the latest fact of the key at t; decisions without one are left out.

    facts: key, period_start, availability, fields. Latest is by (period_start, availability) among
    facts with both at or before t. Decisions and facts are one stream by key and time, over which a
    running maximum carries the latest fact: one shuffle, and no row for every (decision, fact) pair.
    A fact of the key and time of a decision comes first.
    """
    payload = F.struct("period_start", "availability", *fields)
    f = facts.where("period_start is not null and availability is not null").select(key, F.greatest("period_start", "availability").alias("t"), F.lit(0).alias("tag"), payload.alias("fact"))
    d = decisions.select(key, "t", F.lit(1).alias("tag"), F.lit(None).cast(f.schema["fact"].dataType).alias("fact"))
    running = Window.partitionBy(key).orderBy("t", "tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = f.unionByName(d).withColumn("fact", F.max("fact").over(running))
    return seen.where("tag = 1 and fact is not null").select(key, "t", "fact.*")


def latest_within(decisions: DataFrame, facts: DataFrame, key: str, fields: list[str], max_age: int) -> DataFrame:
    """latest(), among facts that became available at most max_age before t.

    The age bounds each fact before the latest is chosen, so a running maximum can't be used; facts
    meet the decisions they can serve by max_age-wide buckets of time, two for each decision.
    """
    bucket = lambda c: F.floor(c / max_age)
    f = facts.where("period_start is not null and availability is not null").withColumn("bucket", bucket(F.col("availability")))
    d = decisions.withColumn("bucket", F.explode(F.array(bucket(F.col("t")), bucket(F.col("t")) - 1)))
    met = d.join(f.select(key, "bucket", "period_start", "availability", *fields).hint("merge"), [key, "bucket"])  # see in_intervals
    met = met.where((F.col("availability") <= F.col("t")) & (F.col("period_start") <= F.col("t")) & (F.col("availability") >= F.col("t") - max_age))
    best = met.groupBy(key, "t").agg(F.max(F.struct("period_start", "availability", *fields)).alias("fact"))
    return best.select(key, "t", "fact.*")


#: Stands for the end of an interval that has none.
FAR = 2**62
#: Lengths of a level differ by that many bits at most: more levels repeat points, fewer meet more in vain.
LEVEL_BITS = 3


def in_intervals(points: DataFrame, intervals: DataFrame, key: str, at: Column, start: Column, end: Column) -> DataFrame:
    """Every point with every interval [start, end) of its key that it lies in; a null end is none.

    An interval's level is the power of 2 ** LEVEL_BITS that its length fits in; at that level it touches one
    or two buckets, and a point lies in one. So pairs meet by (key, level, bucket), once, and an interval meets
    points of its own length's surroundings only, not all of its key. Points are repeated for each level
    there is: at most 63 / LEVEL_BITS, which is all that reaches the driver. Sides are sorted and merged: their
    sizes are guessed from before rows are repeated, so a side taken for small may not fit a broadcast.
    """
    to = F.least(F.coalesce(end, F.lit(FAR)), F.lit(FAR))
    sized = intervals.withColumns({"__from": start, "__to": to}).where("__from < __to")
    level = F.when(F.col("__to") - F.col("__from") <= 1, 0).otherwise(F.length(F.bin(F.col("__to") - F.col("__from") - 1)))
    sized = sized.withColumn("__level", F.least(F.ceil(level / LEVEL_BITS) * LEVEL_BITS, F.lit(62)).cast("int"))
    there = sorted(r[0] for r in sized.select("__level").distinct().collect())
    if not there:
        there = [0]
    bucket = lambda c: F.expr(f"{c} >> __level")  # noqa: E731  # rounds down, below zero too
    dealt = sized.withColumn("__last", F.col("__to") - 1).withColumn("__bucket", F.explode(F.array_distinct(F.array(bucket("__from"), bucket("__last")))))
    asked = points.withColumn("__at", at).withColumn("__level", F.explode(F.array(*map(F.lit, there)))).withColumn("__bucket", bucket("__at"))
    met = asked.join(dealt.hint("merge"), [key, "__level", "__bucket"]).where((F.col("__from") <= F.col("__at")) & (F.col("__at") < F.col("__to")))
    return met.drop("__level", "__bucket", "__from", "__to", "__last", "__at")


def all_eligible(decisions: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Every fact (availability, valid_from, valid_to) with every decision (key, t) at which it is eligible."""
    known = F.when(F.col("availability").isNotNull(), F.greatest("availability", "valid_from"))  # a null valid_from is open
    met = in_intervals(decisions, facts, key, F.col("t"), known, F.col("valid_to") + 1)
    return met.where(observation_eligible(F.col("t"), F.col("availability"), F.col("valid_from"), F.col("valid_to")))


def _reference_met(asks: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    known = F.when(F.col("valid_from").isNotNull() & F.col("known_from").isNotNull(), F.greatest("valid_from", "known_from"))
    met = in_intervals(asks, facts, key, F.col("t"), known, F.col("valid_to"))
    return met.where(reference_eligible(*(F.col(c) for c in ("t", "k", "valid_from", "valid_to", "known_from", "known_to"))))


def reference_at(asks: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Bitemporal facts with every ask (key, t, k) at which they are eligible."""
    return _reference_met(asks, facts, key)


def reference_latest(asks: DataFrame, facts: DataFrame, key: str, order: list[str], within: list[str] = ()) -> DataFrame:
    """The eligible fact of each ask (and within) that is greatest by order."""
    each = Window.partitionBy(key, "t", "k", *within).orderBy(*(F.desc(c) for c in order))
    return reference_at(asks, facts, key).withColumn("turn", F.row_number().over(each)).where("turn = 1").drop("turn")


def conflicts(facts: DataFrame, key: str, id_: str) -> DataFrame:
    """Pairs (key, a, b) of facts of a key whose valid windows overlap and whose known windows overlap."""
    far = F.lit(2**62)
    sides = []
    for s in ("a", "b"):
        f = facts.select(F.col(key), F.col(id_).alias(s), *(F.coalesce(c, far).alias(f"{s}_{c}") if c.endswith("to") else F.col(c).alias(f"{s}_{c}") for c in ("valid_from", "valid_to", "known_from", "known_to")))
        sides.append(f)
    # of two windows that overlap the later start lies in the other; ties go by id
    met = in_intervals(sides[1], sides[0], key, F.col("b_valid_from"), F.col("a_valid_from"), F.col("a_valid_to"))
    met = met.where((F.col("a_valid_from") < F.col("b_valid_from")) | ((F.col("a_valid_from") == F.col("b_valid_from")) & (F.col("a") < F.col("b"))))
    for kind in ("valid", "known"):
        met = met.where((F.col(f"a_{kind}_from") < F.col(f"b_{kind}_to")) & (F.col(f"b_{kind}_from") < F.col(f"a_{kind}_to")))
    return met.select(key, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def resolve_alias(asks: DataFrame, aliases: DataFrame) -> DataFrame:
    """asks (ask_id, norm, venue_id, t, k) with state, target_id, targets.

    Aliases (alias_id, norm, venue_id or null for all venues, target_id, confidence and the four
    bounds) that are eligible and of the venue or of all: none is UNRESOLVED, one target RESOLVED,
    more AMBIGUOUS. The target is that of the best alias: the venue's own, then confidence, then id.
    """
    a = aliases.withColumnRenamed("venue_id", "of_venue")
    met = _reference_met(asks, a, "norm")
    met = met.where(F.col("of_venue").isNull() | (F.col("of_venue") == F.col("venue_id")))
    rank = F.struct(F.col("of_venue").isNull(), -F.col("confidence"), F.col("alias_id"))
    found = met.groupBy("ask_id").agg(F.count_distinct("target_id").alias("targets"), F.min_by("target_id", rank).alias("best"))
    joined = asks.join(found, "ask_id", "left")
    n = F.coalesce("targets", F.lit(0))
    state = F.when(n == 0, "UNRESOLVED").when(n == 1, "RESOLVED").otherwise("AMBIGUOUS")
    return joined.select("ask_id", state.alias("state"), F.when(n == 1, F.col("best")).alias("target_id"), n.alias("targets"))


def alias_collisions(aliases: DataFrame) -> DataFrame:
    """Pairs (norm, a, b) of aliases of one scope with different targets and overlapping windows."""
    scoped = aliases.withColumn("scope", F.concat_ws("|", "norm", F.coalesce(F.concat(F.lit("v"), "venue_id"), F.lit("all"))))
    pairs = conflicts(scoped, "scope", "alias_id")
    side = lambda n: aliases.select(F.col("alias_id").alias(n), F.col("target_id").alias(f"target_{n}"), *(["norm"] if n == "a" else []))
    named = pairs.join(side("a"), "a").join(side("b"), "b")
    return named.where("target_a <> target_b").select("norm", "a", "b")


def truncated(facts: DataFrame, most: int) -> DataFrame:
    """The facts that were available at `most`: a store that knows nothing later."""
    return facts.where(F.col("availability") <= most)


def asked_by(asks: DataFrame, most: int) -> DataFrame:
    """asks, none of which may be at a time after `most`: such a one stops the job."""
    late = F.raise_error(F.concat(F.lit(f"asked of a store cut at {most}: t = "), F.col("t").cast("string")))
    return asks.withColumn("t", F.when(F.col("t") <= most, F.col("t")).otherwise(late.cast("long")))


def truncated_parity(
    decisions: DataFrame, facts: DataFrame, store: DataFrame, evaluate: Callable[[DataFrame, DataFrame], DataFrame], value: str, rel: float
) -> DataFrame:
    """instrument_id, t, status: evaluate(decisions, facts), all at once, against evaluate() at each time with the store cut there.

    status: equal (within rel), different, only_a (all at once only) or only_b. One evaluation for each
    decision time: their number is the schedule's, not the data's, and the times are read from it.
    """
    whole, parts = evaluate(decisions, facts), None
    for (t,) in decisions.select("t").distinct().orderBy("t").collect():
        part = evaluate(asked_by(decisions.where(F.col("t") == t), t), truncated(store, t))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        parts = whole.limit(0)
    a, b = (x.select("instrument_id", "t", F.col(value).alias(n), F.lit(True).alias(f"in_{n}")) for x, n in ((whole, "a"), (parts, "b")))
    status = F.when(F.col("in_b").isNull(), "only_a").when(F.col("in_a").isNull(), "only_b").when(close_to(F.col("a"), F.col("b"), rel), "equal").otherwise("different")
    return a.join(b, ["instrument_id", "t"], "full_outer").select("instrument_id", "t", status.alias("status"))
