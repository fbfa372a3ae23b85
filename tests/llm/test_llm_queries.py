"""Corpus queries with SQL against DuckDB on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, sql = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(sql.columns)
    at = [list(sql.columns).index(c) for c in df.columns]
    close = lambda v: round(v, 6) if isinstance(v, float) else v
    assert sorted(tuple(map(close, r)) for r in df.collect()) == sorted(tuple(close(r[i]) for i in at) for r in sql.fetchall())


def test_language_is_told_on_held_out_rows(spark):
    """In total and in each language."""
    known = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op10_langid"](spark, "/root/testdata/sf0.01").collect() if r.held_out and known[r.doc_id] is not None]
    right, seen = Counter(), Counter()
    for r in got:
        seen[known[r.doc_id]] += 1
        right[known[r.doc_id]] += known[r.doc_id] == r.lang_pred
    assert sum(right.values()) >= 0.95 * len(got) > 0 and all(right[x] >= 0.9 * seen[x] for x in seen), (right, seen)


def test_toxic_rows_are_told_on_held_out_labels(spark):
    """Fitted without a fifth of the labels, by a hash of the doc_id, and measured on that fifth."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(5)) == 0
    truth = {r.doc_id: bool(r.toxic) for r in labels.where(out & F.col("toxic").isNotNull()).collect()}
    held = docs.join(labels.where(out).select("doc_id"), "doc_id", "left_semi")
    categories = ["low_quality", "toxic"]
    chain = toxicity.fit_chain(toxicity.labelled_sample(docs, labels.where(~out)), categories)
    got = {r.doc_id: r.p_toxic >= toxicity.THRESHOLD for r in toxicity.score(held, chain, categories).collect()}
    toxic = [d for d in got if truth[d]]
    assert len(toxic) > 20 and sum(got[d] for d in toxic) >= 0.9 * len(toxic)
    assert sum(got[d] == truth[d] for d in got) >= 0.97 * len(got)
