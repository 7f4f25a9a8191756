"""Forward labels and purged chronological splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.asof import latest
from tidelake.operators.ordered import ranked


def forward_labels(decisions: DataFrame, bars: DataFrame, gap_us: int, horizon_us: int, threshold: float = 0.0) -> DataFrame:
    """Entry and exit as-of prices, return, sign and binary label of each decision that has both prices.

    Entry is known at t, exit at t + gap + horizon. The event runs from t + gap to t + gap + horizon.
    """
    ahead = gap_us + horizon_us
    entry = latest(decisions, bars, "instrument_id", ["close"]).select("instrument_id", "t", F.col("close").alias("entry_price"))
    later = latest(decisions.select("instrument_id", (F.col("t") + ahead).alias("t")), bars, "instrument_id", ["close"])
    exit_ = later.select("instrument_id", (F.col("t") - ahead).alias("t"), F.col("close").alias("exit_price"))
    value = F.col("exit_price") / F.col("entry_price") - 1
    return entry.join(exit_, ["instrument_id", "t"]).where("entry_price > 0").select(
        "instrument_id", "t", (F.col("t") + gap_us).alias("event_start"), (F.col("t") + ahead).alias("event_end"), "entry_price", "exit_price",
        value.alias("label_return"), F.signum(value).cast("int").alias("label_sign"), (value > threshold).cast("int").alias("label_binary"),
    )


def purge(train: DataFrame, test: DataFrame, embargo_us: int) -> DataFrame:
    """train events (fold_id, instrument_id, event_id, t, event_start, event_end) that leak nothing into their fold's test.

    Left out: events that end after, or are decided at or after, the first test decision less the
    embargo; events that overlap a test event of their instrument; events that overlap the time from
    that boundary to the last test event's end. Folds without test events keep all.
    """
    bounds = test.groupBy("fold_id").agg((F.min("t") - embargo_us).alias("edge"), F.max("event_end").alias("last_end"))
    joined = train.join(bounds, "fold_id", "left")
    edge = F.col("edge")
    early = edge.isNull() | ((F.col("event_end") <= edge) & (F.col("t") < edge) & ~((F.col("event_start") < F.col("last_end")) & (edge < F.col("event_end"))))
    kept = joined.where(early).drop("edge", "last_end")
    peers = test.select(F.col("fold_id").alias("f"), F.col("instrument_id").alias("i"), F.col("event_start").alias("s"), F.col("event_end").alias("e"))
    clash = (F.col("fold_id") == F.col("f")) & (F.col("instrument_id") == F.col("i")) & (F.col("event_start") < F.col("e")) & (F.col("s") < F.col("event_end"))
    return kept.join(peers, clash, "left_anti")


def _sized(train: DataFrame, test: DataFrame, least_train: int, least_test: int) -> DataFrame:
    members = train.withColumn("role", F.lit("train")).unionByName(test.withColumn("role", F.lit("test")))
    sizes = members.groupBy("fold_id").agg(F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "test").alias("n_test"))
    return members.join(sizes.where((F.col("n_train") >= least_train) & (F.col("n_test") >= least_test)).select("fold_id"), "fold_id")


def walk_forward(events: DataFrame, train_us: int, test_us: int, embargo_us: int, expanding: bool = False, least_train: int = 1, least_test: int = 1) -> DataFrame:
    """fold_id, role and the events of each fold: test windows of test_us in turn, each after its training window and embargo.

    Folds with too few events are left out and the others numbered from 0.
    """
    span = events.agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    first = F.col("t0") + train_us + embargo_us
    starts = F.when(first + test_us <= F.col("t1") + 1, F.sequence(first, F.col("t1") + 1 - test_us, F.lit(test_us)))
    folds = span.select("t0", F.posexplode(starts).alias("raw", "test_start")).withColumn("train_end", F.col("test_start") - embargo_us)
    folds = folds.withColumn("train_start", F.col("t0") if expanding else F.col("train_end") - train_us)
    # fold windows are a few rows, made from the events' span; an event falls into one test and several trainings
    met = lambda test: events.join(F.broadcast(folds.select(F.col("raw").alias("fold_id"), "train_start", "train_end", "test_start")), test)
    test = met((F.col("t") >= F.col("test_start")) & (F.col("t") < F.col("test_start") + test_us)).select("fold_id", *events.columns)
    pool = met((F.col("t") >= F.col("train_start")) & (F.col("t") < F.col("train_end"))).select("fold_id", *events.columns)
    members = _sized(purge(pool, test, embargo_us), test, least_train, least_test)
    number = members.select("fold_id").distinct().withColumn("n", F.row_number().over(Window.orderBy("fold_id")) - 1)
    return members.join(F.broadcast(number), "fold_id").withColumn("fold_id", F.col("n").cast("int")).drop("n")


def purged_kfold(events: DataFrame, folds: int, embargo_us: int, least_train: int = 0, least_test: int = 1) -> DataFrame:
    """fold_id, role and events: contiguous blocks of equal event counts in time order, the rest in the last; training is strictly earlier.

    Numbers of folds that are left out stay unused.
    """
    total = F.broadcast(events.agg(F.count("*").alias("__n")))  # one row
    placed = ranked(events, ["t", "event_end", "instrument_id", "event_id"], "__rank").crossJoin(total)
    placed = placed.withColumn("fold_id", F.least(F.lit(folds - 1), F.floor(F.col("__rank") / F.floor(F.col("__n") / folds))).cast("int"))
    test = placed.select("fold_id", *events.columns)
    edges = test.groupBy("fold_id").agg((F.min("t") - embargo_us).alias("edge"))
    # edges are a row for each of `folds`
    pool = events.join(F.broadcast(edges), F.col("t") < F.col("edge")).select("fold_id", *events.columns)
    return _sized(purge(pool, test, embargo_us), test, least_train, least_test)
