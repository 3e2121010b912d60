"""Every registered query against an independent SQL engine, on whole tables."""

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

from namewake.plans.oracles import ORACLES  # noqa: E402
from namewake.plans.queries import QUERIES  # noqa: E402

SF = os.environ.get("NAMEWAKE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6))
        return repr(v)

    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    expected = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    theirs = canonical(expected.fetchall(), columns)
    assert len(ours) == len(theirs) > 0
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
