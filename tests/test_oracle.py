"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from tidelake.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if x is None or isinstance(x, (bool, str)):
            return str(x)
        f = float(x) if not hasattr(x, "isoformat") else x
        return str(f if not isinstance(f, float) or math.isnan(f) else round(f, 5) + 0.0)

    return sorted(tuple(value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    cursor = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert plain(map(tuple, df.collect()), df.columns) == plain(want, columns)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert registry.queries()[name](spark, DIR).limit(1).count()
