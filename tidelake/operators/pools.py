"""Pools, listings and the merges that build their registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.inventory import oriented
from tidelake.operators.ordered import ranked

from tidelake.operators.universe import first_reason

#: How addresses of the two chain families are written.
EVM_ADDRESS = r"\A0x[a-fA-F0-9]{40}\z"
BASE58_ADDRESS = r"\A[1-9A-HJ-NP-Za-km-z]{32,44}\z"
#: Fixed values of the ticker screen: what a symbol must not contain, and bases that are stable themselves.
LEVERAGED_MARKS = ("UP", "DOWN", "BEAR", "BULL")
STABLE_BASES = ("USDC", "BUSD", "TUSD", "FDUSD", "DAI")


def valid_address(chain: Column, address: Column) -> Column:
    """Whether address is written as its chain family writes pool addresses; false for null."""
    fits = F.when(F.lower(F.trim(chain)) == "solana", address.rlike(BASE58_ADDRESS)).otherwise(address.rlike(EVM_ADDRESS))
    return F.coalesce(fits, F.lit(False))


def fee_tier(labels: Column) -> Column:
    """The first label with a percent sign; null without one."""
    return F.get(F.filter(labels, lambda x: x.contains("%")), F.lit(0))


def priority_score(liquidity: Column, volume: Column) -> Column:
    """sqrt(liquidity * volume), what is missing counting as 0."""
    return F.sqrt(F.coalesce(liquidity, F.lit(0.0)) * F.coalesce(volume, F.lit(0.0)))


def filter_pairs(pairs: DataFrame, aliases: DataFrame, chains: Sequence[str], quotes: Sequence[str]) -> DataFrame:
    """(target, pairs) whose chain is allowed, whose address is valid, whose base is an alias of target and that have a quote token.

    pairs: chain, address, base, quote; aliases: target, alias, one row per name (a target's own too).
    """
    sound = pairs.where(F.lower("chain").isin(*chains) & valid_address(F.col("chain"), F.col("address")))
    named = sound.withColumn("alias", F.upper("base")).where(F.col("alias").isin(*quotes) | F.upper("quote").isin(*quotes))
    return named.join(aliases, "alias").drop("alias")


def listing_screen(chain: Column, liquidity: Column, chains: Sequence[str], least: float) -> Column:
    """Why a listing is left out; null if it passes. An empty allow-list allows every chain."""
    barred = ~chain.isin(*chains) if chains else F.lit(False)
    why = F.when(barred, F.concat(F.lit("chain_not_allowed:"), chain))
    return F.coalesce(why, first_reason((F.coalesce(liquidity, F.lit(0.0)) < least, "low_liquidity")))


def ticker_screen(tickers: DataFrame, least: float, known: DataFrame) -> DataFrame:
    """Tickers (symbol, status, quote_volume) that trade against USDT above a volume, without leveraged ones, stable bases and known symbols.

    The leveraged test is by substring, so a base that merely contains a mark goes too: kept for its
    results, first_reason over leveraged() is the sound one. A missing status trades, a missing volume is 0.
    """
    s = F.col("symbol")
    base = F.substr(s, F.lit(1), F.length(s) - 4)
    marked = F.lit(False)
    for mark in LEVERAGED_MARKS:
        marked = marked | s.contains(mark)
    fit = s.endswith("USDT") & (s == F.upper(s)) & ~marked & ~base.isin(*STABLE_BASES) & (F.coalesce("status", F.lit("TRADING")) == "TRADING")
    found = tickers.where(fit & (F.coalesce("quote_volume", F.lit(0.0)) >= least))
    return found.join(known.select(F.upper("symbol").alias("symbol")), "symbol", "left_anti")


def merge_providers(records: DataFrame, priority: dict[str, int], last: int = 99) -> DataFrame:
    """records (provider, pool, ts, ordinal, ...) with one row of each (lower-case pool, ts): the first provider's by priority, its first record."""
    rank = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in priority.items() for x in kv)), F.col("provider")), F.lit(last))
    others = [c for c in records.columns if c not in ("pool", "ts")]
    best = records.groupBy(F.lower("pool").alias("pool"), "ts").agg(F.min_by(F.struct(*others), F.struct(rank, "ordinal")).alias("x"))
    return best.select("pool", "ts", "x.*")


def active_first(rows: DataFrame, key: str = "id", ordinal: str = "ordinal") -> DataFrame:
    """One row of each key: an active one before an inactive one, the last of each kind."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct("active", ordinal)).alias("x")).select(key, "x.*")


BIRTH = ("tx_hash", "log_index", "creation_block", "token0", "token1")


def births(rows: DataFrame) -> DataFrame:
    """pool, its birth, copies and code: null, or conflicting_birth where rows of a pool tell different births.

    Exact repeats count once. Of a conflict the least birth stands in the row; callers keep rows without a code.
    """
    birth = F.struct(*BIRTH)
    found = rows.groupBy("pool").agg(F.min(birth).alias("b"), F.max(birth).alias("other"), F.count("*").alias("copies"))
    return found.select("pool", "b.*", "copies", F.when(F.col("b") != F.col("other"), "conflicting_birth").alias("code"))


def registry(records: DataFrame, stables: DataFrame, declared: int, block_us: int, lag_us: int) -> tuple[DataFrame, DataFrame]:
    """(pools, refused) of births (pool, BIRTH): from a checked source to the pools quoted in a stable, in order of birth.

    records must be as many as declared, or an error stops it. Exact repeats count once; a pool of different
    births is refused, with code. Pools with just one stable (token, symbol) stay, as base and quote, with
    birth_order from 0 by (creation_block, log_index, pool) and available_us, lag_us after their block.
    """
    found = records.count()
    if found != declared:
        raise ValueError(f"{found} records, but {declared} are declared")
    born = births(records)
    pools = ranked(oriented(born.where("code is null").drop("code", "copies"), stables), ["creation_block", "log_index", "pool"], "birth_order")
    return pools.withColumn("available_us", F.col("creation_block") * block_us + lag_us), born.where("code is not null").select("pool", "code", "copies")


def translate(rows: DataFrame, names: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with venue_symbol and venue_id, rows whose symbol has no name): names has symbol, venue_symbol, venue_id, one row per symbol."""
    met = rows.join(names.withColumnRenamed("symbol", column), column, "left")
    return met.where("venue_id is not null"), met.where("venue_id is null").select(*rows.columns)


def invalid_artifact(artifact: Column, prefixes: Sequence[str]) -> Column:
    """Whether an artifact's id is one of prefixes, or begins with one and a space."""
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | (artifact == p) | artifact.startswith(p + " ")
    return hit


def live_ready(mode: Column, net_return: Column, meets_limits: Column, complete: Column) -> Column:
    return F.coalesce((mode == "real_asof") & (net_return > 0) & meets_limits & complete, F.lit(False))


def between(rows: DataFrame, keys: DataFrame, key: str, at: str, first: int, last: int) -> DataFrame:
    """rows of the keys at times first to last, both ends in; no keys give no rows."""
    return rows.where(F.col(at).between(first, last)).join(keys.select(key).distinct(), key, "left_semi")


def listed_by(events: DataFrame, at: str, t: int, chain: str | None = None) -> DataFrame:
    """Distinct instruments with a listing event at or before t, of one chain or of all."""
    found = events.where(F.col(at) <= t)
    return (found.where(F.col("chain") == chain) if chain else found).select("instrument_id").distinct()


def times_go_back(rows: DataFrame, key: str, ordinal: str, times: Sequence[str]) -> DataFrame:
    """key, ordinal, field of rows with a time under the one before it, in the order of ordinal."""
    order = Window.partitionBy(key).orderBy(ordinal)
    back = F.filter(F.array(*(F.when(F.lag(c).over(order) > F.col(c), F.lit(c)) for c in times)), lambda x: x.isNotNull())
    return rows.select(key, ordinal, back.alias("back")).select(key, ordinal, F.explode("back").alias("field"))


def classify_members(universe: DataFrame, evidence: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """universe (symbol) with state: the first of evidence (name, symbols) that has the symbol, else unresolved."""
    out, tests = universe, []
    for name, symbols in evidence:
        out = out.join(symbols.select("symbol").distinct().withColumn(f"in_{name}", F.lit(True)), "symbol", "left")
        tests.append((F.col(f"in_{name}"), name))
    return out.withColumn("state", F.coalesce(first_reason(*tests), F.lit("unresolved"))).drop(*(f"in_{n}" for n, _ in evidence))


def set_faults(supported: DataFrame, unmapped: DataFrame, inventory: DataFrame, universe: DataFrame) -> DataFrame:
    """symbol, code of what breaks: supported and unmapped are disjoint, and both lie in inventory and in universe."""
    named = supported.select("symbol").distinct().withColumn("kind", F.lit("supported")).unionByName(unmapped.select("symbol").distinct().withColumn("kind", F.lit("unmapped")))
    both = named.groupBy("symbol").agg(F.count("*").alias("n")).where("n > 1").select("symbol", F.lit("supported_and_unmapped").alias("code"))
    outside = lambda whole, name: named.join(whole.select("symbol").distinct(), "symbol", "left_anti").select("symbol", F.concat("kind", F.lit(f"_not_in_{name}")).alias("code"))
    return both.unionByName(outside(inventory, "inventory")).unionByName(outside(universe, "universe"))


def object_inventory(objects: DataFrame) -> DataFrame:
    """family, objects, bytes, without_checksum, lone_checksums of a listing (family, key, size); a checksum is its object's key and .CHECKSUM."""
    is_sum = F.col("key").endswith(".CHECKSUM")
    stem = F.when(is_sum, F.expr("substr(key, 1, length(key) - 9)")).otherwise(F.col("key"))
    met = objects.groupBy("family", stem.alias("stem")).agg(F.bool_or(~is_sum).alias("object"), F.bool_or(is_sum).alias("sum"), F.sum(F.when(~is_sum, F.col("size"))).alias("size"))
    count = lambda test: F.count_if(test)
    return met.groupBy("family").agg(
        count(F.col("object")).alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        count(F.col("object") & ~F.col("sum")).alias("without_checksum"), count(F.col("sum") & ~F.col("object")).alias("lone_checksums"),
    )


def feasibility(plans: DataFrame, key: str, free: int) -> DataFrame:
    """key, new_bytes, shortfall, state of plans (key, bytes, credit): an unknown size leaves the whole unknown, never zero."""
    unknown = F.count("bytes") < F.count("*")
    need = F.sum(F.greatest(F.lit(0), F.col("bytes") - F.coalesce("credit", F.lit(0))))
    found = plans.groupBy(key).agg(F.when(~unknown, need).alias("new_bytes"))
    short = F.greatest(F.lit(0), F.col("new_bytes") - free)
    return found.select(key, "new_bytes", F.when(F.col("new_bytes").isNotNull(), short).alias("shortfall"), F.when(F.col("new_bytes").isNull(), "unknown").when(F.col("new_bytes") > free, "short").otherwise("fits").alias("state"))


def funding_members(objects: DataFrame) -> DataFrame:
    """symbol, families (sorted, joined), objects, example (least key) of symbols with realized objects."""
    return objects.groupBy("symbol").agg(F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.count("*").alias("objects"), F.min("key").alias("example"))


def retained_credit(objects: DataFrame, valid: DataFrame) -> DataFrame:
    """keys, digests, bytes, unverified of objects (key, sha256, size): valid keys, their unique digests, those digests' bytes once, and keys that aren't valid."""
    marked = objects.join(valid.select("key").distinct().withColumn("ok", F.lit(True)), "key", "left")
    per = marked.groupBy("ok", "sha256").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    good = F.coalesce("ok", F.lit(False))
    zero = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    return per.agg(zero(F.when(good, F.col("n"))).alias("keys"), F.count_if(good & F.col("sha256").isNotNull()).alias("digests"), zero(F.when(good, F.col("size"))).alias("bytes"), zero(F.when(~good, F.col("n"))).alias("unverified"))


def clamped_blocks(pools: DataFrame, first: int, last: int) -> DataFrame:
    """pools (pool, birth) with blocks: how many of blocks first to last it lives in."""
    return pools.withColumn("blocks", F.greatest(F.lit(0), F.lit(last) - F.greatest("birth", F.lit(first)) + 1).cast("long"))


def registry_coverage(receipts: DataFrame, pools: DataFrame, first: int, last: int) -> DataFrame:
    """pool, topic, needed, covered, complete for each pool and each topic that any receipt of it names.

    receipts: addresses, topics (arrays), from_block, to_block. A pool needs blocks first to last from
    its birth on; blocks that several receipts tell count once.
    """
    cells = receipts.select(F.explode("addresses").alias("pool"), "topics", "from_block", "to_block").select("pool", F.explode("topics").alias("topic"), "from_block", "to_block")
    met = cells.join(clamped_blocks(pools, first, last), "pool")
    low = F.greatest("from_block", "birth", F.lit(first))
    clear = met.select("pool", "topic", "blocks", low.alias("a"), F.least("to_block", F.lit(last)).alias("z"))
    reach = F.max("z").over(Window.partitionBy("pool", "topic").orderBy("a", "z").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("z") - F.greatest("a", F.coalesce(reach + 1, F.col("a"))) + 1)
    found = clear.select("pool", "topic", "blocks", fresh.alias("fresh")).groupBy("pool", "topic").agg(F.max("blocks").alias("needed"), F.sum("fresh").alias("covered"))
    return found.withColumn("complete", F.col("covered") == F.col("needed"))
