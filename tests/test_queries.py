"""Registered queries against DuckDB on the smallest tables, and the entry point without the corpus subpackage."""

import datetime
import decimal
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
from tidemark.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def rows(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    sql = db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(sql.columns)
    assert rows(df.columns, df.collect()) == rows(list(sql.columns), sql.fetchall())


def test_names_match():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries()) and len(QUERIES) > 150


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_entry_point_without_the_corpus_subpackage():
    code = "import sys; sys.modules['tidemark.llm'] = sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 150 and not any(x.startswith('op1') for x in q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
