"""The pipeline's stages on a small corpus, each against a brute-force version on its own input."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from test_llm_operators import WORD, corpus, jaccard_brute, leak_brute, mix_brute, profile_brute, winner

COLUMNS = corpus_pipeline.COLUMNS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(9)
    rows = [r[:5] for r in corpus(n=90)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{out}/documents.parquet")
    long = rows[7][1].split()
    bench = [(1, " ".join(long[100:130])), (2, " ".join(rng.choice(long) for _ in range(25)))]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, rows, bench


def test_stages(spark, folder):
    out, rows, bench = folder
    docs = spark.read.parquet(f"{out}/documents.parquet")
    texts = lambda df: sorted((r.doc_id, r.text) for r in df.collect())

    known = corpus_pipeline.language(spark, docs, out)
    assert known.columns == COLUMNS
    assert texts(known) == sorted((r[0], r[1]) for r in rows if any(c.isalpha() for c in r[1] or ""))
    told = profile_brute([(r[1], r[2]) for r in rows if r[1] is not None and r[2] is not None], [r[1] for r in rows])
    want = sorted((r[0], r[2] or lang) for r, (lang, _) in zip(rows, told) if lang != "und")
    assert sorted((r.doc_id, r.lang) for r in known.collect()) == want

    single = corpus_pipeline.near_duplicates(spark, known, out)
    have = [(r.doc_id, r.text) for r in known.collect()]
    assert single.columns == COLUMNS and sorted(r.doc_id for r in single.collect()) == sorted({c for _, c, _ in jaccard_brute(have)})

    clean = corpus_pipeline.decontaminated(spark, single, out)
    have = [(r.doc_id, r.text) for r in single.collect()]
    assert clean.columns == COLUMNS and sorted(r.doc_id for r in clean.collect()) == [x[0] for x in leak_brute(have, bench) if not x[5]]
    assert 0 < clean.count() < single.count()

    mix = corpus_pipeline.mixed(spark, clean, out)
    copies = Counter(r.doc_id for r in mix.collect())
    size = {r.doc_id: len(WORD.findall(r.text)) for r in clean.collect()}
    taken = mix_brute([(r.doc_id, r.text, r.source) for r in clean.collect()])
    assert mix.columns == COLUMNS and copies == {i: -(-n // size[i]) for i, n in taken.items() if n}

    shards = corpus_pipeline.sharded(spark, mix, out).collect()
    assert Counter(r.doc_id for r in shards) == copies and {r.law for r in shards} == {"key"}
    assert all((r.shard, r.grown_shard) == (winner(r.doc_id, 40), winner(r.doc_id, 41)) for r in shards)


def test_run_and_empty_tables(spark, folder, tmp_path):
    out, _, _ = folder
    assert corpus_pipeline.run(spark, out).count() > 0
    docs = spark.read.parquet(f"{out}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{out}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
