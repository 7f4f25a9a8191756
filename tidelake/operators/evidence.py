"""Evidence that decisions rest on: contracts, settlements, reviewed identities, series, coverage and restored rows.

Each operator gives a row with a code or reasons for everything it is handed, so that a caller can stop on
violations (quality.assert_empty) or keep what is sound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.checks import sound_ohlc
from tidelake.functions.times import DAY
from tidelake.operators.inventory import integrity
from tidelake.operators.universe import canonical_objects

_CONTRACT = (
    "symbol string, pair string, contractType string, status string, underlyingType string, baseAsset string, quoteAsset string, marginAsset string, "
    "onboardDate bigint, deliveryDate bigint"
)
_TEXTS = ["pair", "contractType", "status", "underlyingType", "baseAsset", "quoteAsset", "marginAsset"]


def reasons(*tests: tuple[Column, str]) -> Column:
    """The names of the tests that hold, in order."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in tests)))


def contracts(payloads: DataFrame, statuses: Sequence[str], underlyings: Sequence[str], others: Sequence[str] = ()) -> DataFrame:
    """Contract rows of listing payloads (json: {"symbols": [...]}): their fields, code, state and perpetual.

    Names and enums are trimmed and upper case. code: missing_identity (a blank or absent text),
    bad_lifecycle (a date that is not positive), duplicate_symbol, else null. state: unsupported_underlying_type,
    unsupported_contract_status, incoherent_contract_identity (the pair is not base and quote, the margin is not
    the quote, or a perpetual is not named as its pair), else supported. perpetual: PERPETUAL, supported,
    without a code, and neither its type nor its underlying in others.
    """
    each = payloads.select(F.inline(F.from_json("json", f"symbols array<struct<{_CONTRACT.replace(' ', ':').replace(',:', ', ')}>>")["symbols"]))
    name = lambda c: F.upper(F.trim(F.col(c)))
    rows = each.select(name("symbol").alias("symbol"), *(name(c).alias(c) for c in _TEXTS), "onboardDate", "deliveryDate")
    blank = F.coalesce(F.col("symbol"), F.lit("")) == ""
    for c in _TEXTS:
        blank = blank | (F.coalesce(F.col(c), F.lit("")) == "")
    dated = F.coalesce((F.col("onboardDate") > 0) & (F.col("deliveryDate") > 0), F.lit(False))
    twice = F.count("*").over(Window.partitionBy("symbol")) > 1  # a listing names a symbol once: few rows a key
    code = F.when(blank, "missing_identity").when(~dated, "bad_lifecycle").when(twice, "duplicate_symbol")
    perpetual = F.col("contractType") == "PERPETUAL"
    odd = (F.col("pair") != F.concat("baseAsset", "quoteAsset")) | (F.col("marginAsset") != F.col("quoteAsset")) | (perpetual & (F.col("symbol") != F.col("pair")))
    state = (
        F.when(~F.coalesce(F.col("underlyingType").isin(*underlyings), F.lit(False)), "unsupported_underlying_type")
        .when(~F.coalesce(F.col("status").isin(*statuses), F.lit(False)), "unsupported_contract_status")
        .when(F.coalesce(odd, F.lit(True)), "incoherent_contract_identity").otherwise("supported")
    )
    marked = rows.withColumn("code", code).withColumn("state", state)
    other = F.col("contractType").isin(*others) | F.col("underlyingType").isin(*others) if others else F.lit(False)
    return marked.withColumn("perpetual", F.coalesce(perpetual & (F.col("state") == "supported") & F.col("code").isNull() & ~other, F.lit(False)))


def settlements(payloads: DataFrame) -> DataFrame:
    """pair, delivery_date, price, code of settlement payloads (pair, json: a list of deliveryTime in ms and deliveryPrice).

    code: bad_time or bad_price (not positive and finite), repeated_date within the pair, else null.
    """
    each = payloads.select("pair", F.inline(F.from_json("json", "array<struct<deliveryTime: bigint, deliveryPrice: double>>")))
    price, date = F.col("deliveryPrice"), F.to_date(F.timestamp_millis("deliveryTime"))
    sound = price.isNotNull() & ~F.isnan(price) & (price > 0) & (price < float("inf"))
    twice = F.count("*").over(Window.partitionBy("pair", date)) > 1
    code = F.when(~F.coalesce(F.col("deliveryTime") > 0, F.lit(False)), "bad_time").when(~sound, "bad_price").when(twice, "repeated_date")
    return each.select("pair", date.cast("string").alias("delivery_date"), price.alias("price"), code.alias("code"))


def settled_symbols(reviewed: DataFrame, settled: DataFrame) -> DataFrame:
    """reviewed (symbol, pair, delivery_date) with matched: whether a sound settlement has that pair and date."""
    dates = settled.where("code is null").select("pair", "delivery_date").distinct().withColumn("matched", F.lit(True))
    return reviewed.join(dates, ["pair", "delivery_date"], "left").fillna({"matched": False})


def delivery_identities(reviewed: DataFrame, objects: DataFrame, funding: DataFrame, settled: DataFrame, families: int = 2, direct: str = "direct") -> DataFrame:
    """reviewed (symbol, pair, delivery_date, authority) with family_count, object_count, resolved, reasons, proved anew.

    objects: family, symbol of archive objects; funding: symbol of realized funding. A name is resolved if it lies in
    enough families, shows no funding and, with direct authority, has a settlement of its date.
    """
    seen = objects.groupBy("symbol").agg(F.count_distinct("family").alias("family_count"), F.count("*").alias("object_count"))
    paid = funding.select("symbol").distinct().withColumn("paid", F.lit(True))
    met = settled_symbols(reviewed, settled).join(seen, "symbol", "left").join(paid, "symbol", "left").fillna({"family_count": 0, "object_count": 0, "paid": False})
    why = reasons(
        (F.col("family_count") < families, "archive_multi_family_lifecycle_unproved"), (F.col("paid"), "realized_funding_observed"),
        ((F.col("authority") == direct) & ~F.col("matched"), "official_settlement_price_date_absent"),
    )
    return met.withColumn("reasons", why).withColumn("resolved", F.size("reasons") == 0).drop("paid")


def settlement_aliases(reviewed: DataFrame, authorities: DataFrame, objects: DataFrame) -> DataFrame:
    """reviewed (alias, base, base_authority) with observed, object_count, resolved, reasons: an alias stands on its base's evidence only.

    authorities: base, observed (what now shows the base to be a perpetual), a row a base.
    """
    seen = objects.groupBy(F.col("symbol").alias("alias")).agg(F.count("*").alias("object_count"))
    met = reviewed.join(authorities, "base", "left").join(seen, "alias", "left").fillna({"object_count": 0})
    none = F.col("observed").isNull()
    why = reasons((none, "base_has_no_affirmative_perpetual_evidence"), (~none & (F.col("observed") != F.col("base_authority")), "base_authority_changed_since_review"))
    return met.withColumn("reasons", why).withColumn("resolved", F.size("reasons") == 0)


def binding_series(evidence: DataFrame, decisions: DataFrame, required: Sequence[str]) -> DataFrame:
    """run, decision_time, status: evidence (run, decision_time, required fields) against the decisions (run, decision_time) that ran.

    status: ok, missing_entry (a decision without evidence), stray_entry (evidence of no decision),
    repeated_entry, or null_field:<name>, the first required field that is null.
    """
    null = F.coalesce(*(F.when(F.col(c).isNull(), F.lit(f"null_field:{c}")) for c in required))
    per = evidence.groupBy("run", "decision_time").agg(F.count("*").alias("n"), F.min(null).alias("fault"))
    ran = decisions.select("run", "decision_time").distinct().withColumn("ran", F.lit(True))
    met = per.join(ran, ["run", "decision_time"], "full_outer")
    status = F.when(F.col("n").isNull(), "missing_entry").when(F.col("ran").isNull(), "stray_entry").when(F.col("n") > 1, "repeated_entry")
    return met.select("run", "decision_time", F.coalesce(status, F.col("fault"), F.lit("ok")).alias("status"))


def observation_window(
    promotions: DataFrame, periods: DataFrame, least_days: float, max_leverage: float, max_weight: float
) -> DataFrame:
    """A row for each promotion (artifact, state, effective_us, evaluated_us): what its paper period showed.

    periods: artifact, t_us, net_return, leverage, weight. Only periods from effective_us to evaluated_us count.
    duration_days, periods, net_return (compounded), max_leverage, max_weight, complete, meets_risk, fault:
    not_paper_approved or evaluated_before_start, else null.
    """
    inside = promotions.select("artifact", "effective_us", "evaluated_us").join(periods, "artifact").where("t_us between effective_us and evaluated_us")
    gone = F.count_if(F.col("net_return") <= -1) > 0
    grown = F.expm1(F.sum(F.log1p(F.when(F.col("net_return") > -1, F.col("net_return")))))
    seen = inside.groupBy("artifact").agg(
        F.count("*").alias("periods"), F.when(gone, -1.0).otherwise(grown).alias("net_return"), F.max("leverage").alias("max_leverage"), F.max("weight").alias("max_weight")
    )
    met = promotions.join(seen, "artifact", "left").fillna({"periods": 0, "net_return": 0.0, "max_leverage": 0.0, "max_weight": 0.0})
    days = (F.col("evaluated_us") - F.col("effective_us")) / DAY
    fault = F.when(F.col("state") != "PAPER_APPROVED", "not_paper_approved").when(F.col("evaluated_us") < F.col("effective_us"), "evaluated_before_start")
    return met.select(
        "artifact", days.alias("duration_days"), "periods", "net_return", "max_leverage", "max_weight", (days >= least_days).alias("complete"),
        ((F.col("max_leverage") <= max_leverage) & (F.col("max_weight") <= max_weight)).alias("meets_risk"), fault.alias("fault"),
    )


def retained_coverage(points: DataFrame, lifecycles: DataFrame) -> DataFrame:
    """A row for each symbol of points (symbol, at_us, size) or lifecycles (symbol, first_day, last_day): what retained history covers.

    days (different days inside the lifecycle), outside, misaligned (not at a day's start), gaps (steps of more
    than a day), bytes_per_point (rounded up), lifecycle_days, supported (it has a lifecycle).
    """
    day = F.floor(F.col("at_us") / DAY)
    step = day - F.lag(day).over(Window.partitionBy("symbol").orderBy("at_us"))
    met = points.withColumn("day", day).withColumn("step", step).join(lifecycles, "symbol", "left")
    inside = F.col("day").between(F.col("first_day"), F.col("last_day"))
    per = met.groupBy("symbol").agg(
        F.count_distinct(F.when(inside, F.col("day"))).alias("days"), F.count_if(~inside).alias("outside"), F.count_if(F.pmod("at_us", F.lit(DAY)) != 0).alias("misaligned"),
        F.count_if(F.col("step") > 1).alias("gaps"), F.ceil(F.sum("size") / F.count("*")).alias("bytes_per_point"),
    )
    out = per.join(lifecycles, "symbol", "full_outer").fillna({"days": 0, "outside": 0, "misaligned": 0, "gaps": 0})
    return out.select(
        "symbol", "days", "outside", "misaligned", "gaps", "bytes_per_point", F.greatest(F.col("last_day") - F.col("first_day") + 1, F.lit(0)).alias("lifecycle_days"),
        F.col("first_day").isNotNull().alias("supported"),
    )


def storage_projection(coverage: DataFrame) -> DataFrame:
    """series, points_needed, bytes_per_point, projected_bytes of a retained_coverage(): the dearest series' charge for every lifecycle day."""
    found = coverage.where("supported").agg(F.count("*").alias("series"), F.coalesce(F.sum("lifecycle_days"), F.lit(0)).alias("points_needed"), F.max("bytes_per_point").alias("bytes_per_point"))
    return found.withColumn("projected_bytes", F.col("points_needed") * F.col("bytes_per_point"))


def restored_rows(rows: DataFrame, lineage: DataFrame, interval_us: int, providers: Sequence[str]) -> DataFrame:
    """rows (key, at_us, open, high, low, close, volume, provider, raw_id) of a published snapshot with code: each is checked as if new.

    code: unknown_provider, undeclared_lineage (raw_id is not in lineage), misaligned, unsound_values,
    repeated_identity (key and at_us come more than once), else null. Rows are merged only once none has one.
    """
    known = lineage.select("raw_id").distinct().withColumn("declared", F.lit(True))
    met = rows.join(known, "raw_id", "left").withColumn("n", F.count("*").over(Window.partitionBy("key", "at_us")))
    code = (
        F.when(~F.coalesce(F.col("provider").isin(*providers), F.lit(False)), "unknown_provider").when(F.col("declared").isNull(), "undeclared_lineage")
        .when(F.pmod("at_us", F.lit(interval_us)) != 0, "misaligned")
        .when(~sound_ohlc(*(F.col(c) for c in ("open", "high", "low", "close", "volume"))), "unsound_values").when(F.col("n") > 1, "repeated_identity")
    )
    return met.withColumn("code", code).select(*rows.columns, "code")


def file_evidence(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """provider, file, status of declared against observed files (provider, file, sha256, bytes): ok, missing, undeclared, size_mismatch or hash_mismatch."""
    a, b = (x.select("provider", "file", F.struct("sha256", "bytes").alias(n)) for x, n in ((declared, "d"), (observed, "o")))
    status = (
        F.when(F.col("o").isNull(), "missing").when(F.col("d").isNull(), "undeclared").when(F.col("d.bytes") != F.col("o.bytes"), "size_mismatch")
        .when(F.col("d.sha256") != F.col("o.sha256"), "hash_mismatch").otherwise("ok")
    )
    return a.join(b, ["provider", "file"], "full_outer").select("provider", "file", status.alias("status"))


def provider_coverage(evidence: DataFrame) -> DataFrame:
    """provider, files, ok, faulty, complete of file_evidence()."""
    ok = F.count_if(F.col("status") == "ok")
    return evidence.groupBy("provider").agg(F.count("*").alias("files"), ok.alias("ok"), (F.count("*") - ok).alias("faulty"), (ok == F.count("*")).alias("complete"))


def false_aliases(entries: DataFrame, objects: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """entries (alias, key, fields) that do not equal the object (key, fields) they name: alias, key, fault (unknown_object or the first field that differs)."""
    known = objects.select(F.col(key), F.struct(*fields).alias("of"))
    met = entries.join(known, key, "left")
    differs = F.coalesce(*(F.when(~F.col(f).eqNullSafe(F.col(f"of.{f}")), F.lit(f)) for f in fields))
    return met.withColumn("fault", F.when(F.col("of").isNull(), "unknown_object").otherwise(differs)).where("fault is not null").select("alias", key, "fault")


def acquisition_manifest(objects: DataFrame, members: DataFrame, checksums: DataFrame, quarantined: DataFrame, proved: DataFrame) -> DataFrame:
    """objects (family, symbol, month, day: null for monthly, key, bytes) with state, selection, validation and consumable.

    members: symbol; checksums, quarantined, proved: key. selection: OUTSIDE (not a member), REJECTED (its
    integrity state is not selectable), SUPERSEDED (a daily object of a month that a selectable monthly one
    covers), COLLISION (several left for one family, symbol and interval), else SELECTED. A selected object is
    PROVED and consumable once its checksum is, else PENDING; others have neither.
    """
    inside = members.select("symbol").distinct().withColumn("__member", F.lit(True))
    marked = integrity(objects, "key", checksums, quarantined, proved).join(inside, "symbol", "left")
    kept = F.col("selectable") & F.col("__member").isNotNull()
    placed = canonical_objects(marked.withColumn("__kept", kept), ("family", "symbol"), F.col("__kept")).withColumn("chosen", F.col("chosen") & F.col("__kept"))
    interval = Window.partitionBy("family", "symbol", "month", "day")  # objects of one day or month: few
    met = placed.withColumn("n", F.count_if("chosen").over(interval))
    selection = (
        F.when(F.col("__member").isNull(), "OUTSIDE").when(~F.col("selectable"), "REJECTED").when(~F.col("chosen"), "SUPERSEDED").when(F.col("n") > 1, "COLLISION").otherwise("SELECTED")
    )
    is_proved = F.col("state") == "checksum_proved_retained"
    validation = F.when(F.col("selection") == "SELECTED", F.when(is_proved, "PROVED").otherwise("PENDING"))
    met = met.withColumn("selection", selection).withColumn("validation", validation)
    return met.withColumn("consumable", F.coalesce(F.col("validation") == "PROVED", F.lit(False))).drop("__member", "__kept", "chosen", "n", "selectable")


def manifest_report(manifest: DataFrame) -> DataFrame:
    """family, symbol, objects, selected, consumable, bytes (of selected objects whose size is known), unknown, collisions, rejected of a manifest."""
    is_selected = F.col("selection") == "SELECTED"
    return manifest.where("selection <> 'OUTSIDE'").groupBy("family", "symbol").agg(
        F.count("*").alias("objects"), F.count_if(is_selected).alias("selected"), F.count_if("consumable").alias("consumable"),
        F.coalesce(F.sum(F.when(is_selected, F.col("bytes"))), F.lit(0)).alias("bytes"), F.count_if(is_selected & F.col("bytes").isNull()).alias("unknown"),
        F.count_if(F.col("selection") == "COLLISION").alias("collisions"), F.count_if(F.col("selection") == "REJECTED").alias("rejected"),
    )


def set_parity(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side (only_a or only_b) of what just one of two sets has; repeats do not count."""
    one = lambda x, n: x.select(key).distinct().withColumn(n, F.lit(True))
    met = one(a, "a").join(one(b, "b"), key, "full_outer").where("a is null or b is null")
    return met.select(key, F.when(F.col("b").isNull(), "only_a").otherwise("only_b").alias("side"))


def weekly_times(spans: DataFrame, weekday: int = 4) -> DataFrame:
    """spans (start_us, end_us, other columns) with t: each week's start of the given day (Monday 0; Friday by default) from start_us to end_us."""
    first = F.ceil(F.col("start_us") / DAY)
    at = first + F.pmod(F.lit(weekday) - (first + 3), F.lit(7))  # day 0 was a Thursday
    times = F.when(at * DAY <= F.col("end_us"), F.sequence(at * DAY, F.col("end_us"), F.lit(7 * DAY)))
    return spans.withColumn("t", F.explode(times))


def token_decimals(results: DataFrame) -> DataFrame:
    """results (token, result: 0x and one word) with decimals, 0 to 255, or null where the word is malformed or over."""
    plain = F.col("result").rlike("^0x0{62}[0-9a-fA-F]{2}$")
    return results.withColumn("decimals", F.when(plain, F.conv(F.substring("result", 65, 2), 16, 10).cast("int")))
