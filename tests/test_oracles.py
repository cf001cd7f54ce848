"""Every registered query runs, and equals its DuckDB SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


def sorted_rows(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline"))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    spark.catalog.clearCache()
    if name not in entry.oracle_sql():
        assert rows
        return
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})")
    assert sorted(duck.sql(entry.oracle_sql()[name]).columns) == columns
    assert [KINDS[str(t)] for t in want.types] == [dict(df.dtypes)[c] for c in columns]
    assert sorted_rows(rows) == sorted_rows(want.fetchall())
