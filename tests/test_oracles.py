"""Every query of the core that has SQL gives SQL's rows, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("VOXMETER_TABLES", "/root/testdata/sf0.001")
if not os.path.isdir(FOLDER):
    pytest.skip("no tables", allow_module_level=True)
TABLES = [f[: -len(".parquet")] for f in os.listdir(FOLDER)]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 8) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


CORE = [k for k in entry.queries() if k in entry.oracle_sql()]


@pytest.mark.parametrize("name", CORE)
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(entry.oracle_sql()[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
