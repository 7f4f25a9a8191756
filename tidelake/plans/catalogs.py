"""Queries over folders of files: views, promoted schemas and duplicate contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.plans import inputs as I
from tidelake.plans.archives import files, shelf
from tidelake.sources import catalogs as S
from tidelake.streaming.twins import folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


@query("""SELECT l_orderkey * 10 + l_linenumber AS k, CAST(l_quantity AS DOUBLE) AS quantity, round(CASE WHEN l_orderkey % 4 = 3 THEN l_extendedprice + 0.0001 ELSE l_extendedprice END, 4) AS price,
 CASE WHEN l_orderkey % 4 = 0 THEN l_returnflag END AS note FROM lineitem""")
def s2_promoted_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four folders of one dataset: quantities as int, long, double and decimal, prices of two scales, a column that one has."""
    line, path = I.table(spark, sf_dir, "lineitem"), folder(spark)
    price, key = F.col("l_extendedprice"), F.col("l_orderkey") * 10 + F.col("l_linenumber")
    kinds = ["int", "long", "double", "decimal(9,2)"]
    for i, kind in enumerate(kinds):
        part = line.where(F.col("l_orderkey") % 4 == i)
        cost = (price + 0.0001).cast("decimal(14,4)") if i == 3 else price.cast("decimal(10,2)")
        note = [F.col("l_returnflag").alias("note")] if i == 0 else []
        part.select(key.alias("k"), F.col("l_quantity").cast(kind).alias("quantity"), cost.alias("price"), *note).write.parquet(f"{path}/{i}")
    found = S.promoted(spark, [f"{path}/{i}" for i in range(len(kinds))])
    return found.withColumn("price", F.round(F.col("price").cast("double"), 4))


# each view is a table of its own: (name, SQL of id and value, table)
PARTS = {
    "market_bars": ("event_id", "value", "events"), "funding_cashflows": ("event_id * 2", "value / 2", "events"), "reference_assets": ("p_partkey", "p_retailprice", "part"),
    "reference_instruments": ("s_suppkey", "s_acctbal", "supplier"), "universe_snapshot": ("c_custkey", "c_acctbal", "customer"),
    "factor_value": ("o_orderkey", "o_totalprice", "orders"), "label_return": ("o_orderkey", "o_totalprice / 4", "orders"),
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, CAST({k} AS BIGINT) AS id, round({v}, 4) AS value, CAST(({k}) % 3 AS BIGINT) AS shelf FROM {t} WHERE ({k}) % 3 > 0" for n, (k, v, t) in PARTS.items()))
def s1_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven views, read in SQL with a filter on their partition."""
    root = folder(spark)
    for name, (key, value, table) in PARTS.items():
        rows = I.table(spark, sf_dir, table).selectExpr(f"CAST({key} AS BIGINT) AS id", f"{value} AS value", f"CAST(({key}) % 3 AS BIGINT) AS shelf")
        rows.write.partitionBy("shelf").parquet(f"{root}/{S.VIEWS[name]}")
    names = S.register_views(spark, root)
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS name, id, round(value, 4) AS value, CAST(shelf AS BIGINT) AS shelf FROM {n} WHERE shelf > 0" for n in names))


@query("""WITH s AS (SELECT DISTINCT user_id % 6 AS shelf FROM events) SELECT CAST(shelf AS VARCHAR) AS shelf, 'ARCHIVE' AS kind, CASE WHEN shelf IN (2, 5) THEN 1 ELSE 2 END AS copies,
 CAST(CASE WHEN shelf IN (2, 5) THEN shelf ELSE shelf % 3 END AS VARCHAR) AS stands FROM s""")
def q15_duplicate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six texts, each in as many part files as it fills: 0 and 3, and 1 and 4, are equal; 2 and 5 differ in one line."""
    e = I.table(spark, sf_dir, "events")
    copies = e.withColumn("shelf", F.explode(F.array(*map(F.lit, range(6))))).where((F.col("event_id") % 3) == (F.col("shelf") % 3))
    line = F.concat_ws(",", "event_id", "user_id", F.when((F.col("shelf") == 5) & (F.col("event_id") == 5), "other").otherwise(F.col("event_type")))
    found = S.content_ids(spark, files(copies.select("shelf", F.col("event_id").alias("place"), line.alias("line"))), parts=True)
    kind = S.classified(F.col("object"), [("ARCHIVE", r"/shelf=\d+$"), ("NOTE", r"\.md$")])
    return S.duplicates(found).select(shelf().alias("shelf"), kind.alias("kind"), F.col("copies").cast("long").alias("copies"), shelf("stands").alias("stands"))
