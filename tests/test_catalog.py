"""Every registered query with SQL gives the SQL's rows on the smallest tables; the others run and keep their keys."""

import math

import duckdb
import pytest

from skyflow.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def one(x):
        if isinstance(x, float) and (math.isnan(x)):
            return "NaN"
        return f"{float(x):.6g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(tuple("" if r[k] is None else one(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, DIR)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name in catalog.ORACLE:
        want = db.sql(catalog.ORACLE[name])
        assert plain(rows, df.columns) == plain(want.fetchall(), want.columns)
    else:
        assert rows
