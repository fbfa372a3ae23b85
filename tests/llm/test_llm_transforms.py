"""Infilling, hard negatives and token counts against brute force, with every odd case."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.test_llm_operators import SCHEMA, corpus
from tidemark.llm import hardnegatives, infilling, tokencounts

UNITS = re.compile(r"[^\n]*\n|[^\n]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def infilled(doc_id, text):
    """(n, form, prefix, middle, output) by the definition."""
    text = text or ""
    units = UNITS.findall(text)
    digest = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h4 % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def lines_corpus():
    rng = random.Random(9)
    rows = [(r[0], r[1]) for r in corpus()]
    for i in range(100, 160):
        rows.append((i, "".join(rng.choice(["a\n", "\n", "länger\r\n", "x" * 90 + "\n", "é" * 40, "😀", "<P", "S>"]) for _ in range(rng.randrange(40)))))
    rows += [(200, "one\ntwo <P> three\n"), (201, "<M>"), (202, "\n" * 500), (203, "no end"), (None, "null id\nlines\n"), (None, None), (100, "a second text\nof one id\n")]
    return rows + [rows[70]] * 5 + [(None, None)] * 4


@pytest.mark.parametrize("chunk", [16, 32 << 10])
def test_infilling(spark, monkeypatch, chunk):
    rows = lines_corpus()
    monkeypatch.setattr(infilling.chunks, "__defaults__", (chunk,))
    monkeypatch.setattr(infilling, "_BATCH_BYTES", 2_000)
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, place int, key string").repartition(3)
    want = Counter((i, *(e := infilled(i, t))[:4], sha(e[4]), sha(t or "")) for i, t in rows)
    # With the small chunk the pieces are cut here, in this process: the workers don't see the patch.
    if chunk == 16:
        for i, t in rows:
            data = (t or "").encode()
            ends = infilling.unit_ends(data)
            cut = list(infilling.chunks(ends, 0, len(data)))
            assert b"".join(data[a:b] for a, b in cut) == data and all(b - a <= chunk for a, b in cut)
        return
    assert Counter(map(tuple, infilling.infill(table).collect())) == want
    texts = Counter((i, (e := infilled(i, t))[1], e[4]) for i, t in rows)
    assert Counter(map(tuple, infilling.output_texts(table).collect())) == texts


def test_infilling_streams_pieces_in_any_cut():
    """Assembly and restoration over pieces of some bytes, with repeated pieces of two tasks' copies."""
    import pyarrow as pa

    out = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("place", pa.int64()), ("piece", pa.binary()), ("copies", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output_sha256", pa.string())])
    last = pa.schema([("doc_id", pa.int64()), *list(out)[5:], ("restored_sha256", pa.string())])
    rows, want = [], []
    for i, t in lines_corpus():
        if i is None or i == 100:
            continue
        data, key = (t or "").encode(), b"%08d" % i + hashlib.md5((t or "").encode()).digest()
        n, form, sections, ends = infilling.layout(i, data)
        mine = [(key, i, -1, b"", 1, n, form)]
        for rank, (marker, lo, hi) in enumerate(sections):
            mine += [(key, i, 2 * rank << 40, marker, None, None, None)] * bool(marker)
            mine += [(key, i, (2 * rank + 1 << 40) + k, data[a:b], None, None, None) for k, (a, b) in enumerate(infilling.chunks(ends, lo, hi, 7))]
        rows += mine
        e = infilled(i, t)
        want.append((i, *e[:4], sha(e[4]), sha(t or "")))
    rows.sort(key=lambda r: (r[0], r[2]))
    step = lambda rows, schema, n: [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + n]), schema)], schema=schema) for k in range(0, len(rows), n)]
    first = pa.schema(list(out)[:7])
    assembled = [tuple(r.values()) for b in infilling._digest_output(out)(iter(step(rows, first, 11))) for r in b.to_pylist()]
    assembled.sort(key=lambda r: (r[0], r[2]))
    got = [tuple(r.values()) for b in infilling._digest_text(last)(iter(step(assembled, out, 5))) for r in b.to_pylist()]
    assert Counter(got) == Counter(want)


def test_infilling_of_no_rows(empty):
    assert infilling.infill(empty).count() == 0 and infilling.output_texts(empty).count() == 0


def mined(rows, every=100):
    """Rows as (vec_id, embedding, label) by the definition; each row is an individual."""
    live = []
    for v, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (label + 1) % 10 if v is not None and v % 7 == 0 else label
        q = [math.floor(256 * c) for c in x]
        if sum(c * c for c in q) < 2**62:
            live.append((v, label, q))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = Counter()
    for i, (v, label, q) in enumerate(live):
        if v is None or v % every:
            continue
        scored = [(dot(q, x), w, lab == label) for j, (w, lab, x) in enumerate(live) if j != i]
        for p, w, _ in sorted((s for s in scored if s[2]), key=order)[:5]:
            fits = sorted((s for s in scored if not s[2] and 80 * p <= 100 * s[0] <= 100 * p), key=order)[:5]
            out.update((v, w, r + 1, s[1], p, s[0]) for r, s in enumerate(fits))
    return out


def vectors(seed, n=260, d=6, labels=3, big=False):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]
    same = rows[40][1]
    rows += [(n + i, same, i % labels) for i in range(40)]  # ties
    rows += [(700, None, 1), (800, [1.0, None, 0.0], 1), (801, [float("nan")] * d, 1), (802, [float("inf")] * d, 0), (803, same, None), (900, [], 1), (1000, [0.0] * d, 2), (1001, [1.0, 2.0], 0)]
    rows += [(None, same, 1), (None, [-c for c in same], 2), rows[100], rows[100], rows[5]]
    if big:
        rows += [(1100, [2e5] * d, 0), (1101, [2e5 + 1] * d, 0), (1102, [2e5 - 1] * d, 1), (1103, [3e30] * d, 1), (1104, [-4e5] * d, 1)]
    return rows


@pytest.mark.parametrize("seed, big, blocks", [(1, False, False), (2, True, False), (3, False, True)])
def test_hard_negatives(spark, seed, big, blocks):
    rows = vectors(seed, big=big)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, score string, slot int").repartition(3)
    got = hardnegatives.mine(table, **({"anchor_bytes": 400} if blocks else {}))
    assert Counter(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())) == mined(rows)


def test_hard_negatives_of_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(0, None, 1)], [(1, [1.0], 1)], [(0, [1.0], 1)], [(0, [], 1), (1, [], 1), (2, [], 2)]):
        assert Counter(map(tuple, hardnegatives.mine(spark.createDataFrame(rows, schema)).collect())) == mined(rows)


def as_rows(q, label, directions):
    norm = np.linalg.norm(q, axis=1)
    n = np.arange(len(q))
    return hardnegatives.Rows(n, n, np.zeros(len(q), bool), np.asarray(label), q, norm, hardnegatives.angles(q, norm, directions).astype(np.float32).astype(float))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.floats(0.01, 50))
def test_score_bounds_hold_every_score(seed, width):
    rng = np.random.default_rng(seed)
    q = hardnegatives.integers(rng.normal(size=(1, 8)) + width / 20 * rng.normal(size=(40, 8)))
    directions = hardnegatives.spread_directions(q, 5)
    rows, anchors = as_rows(q[:30], np.zeros(30), directions), as_rows(q[30:], np.zeros(10), directions)
    lo, hi = rows.angles.min(axis=0), rows.angles.max(axis=0)
    below, above = hardnegatives.score_bounds(anchors, lo, hi, rows.norm.min(), rows.norm.max())
    s = rows.q @ anchors.q.T
    assert (s.min(axis=0) >= below).all() and (s.max(axis=0) <= above).all()


def test_angles_leave_most_pairs_of_clustered_rows_unscored():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 32))
    group = rng.integers(0, 16, 8000)
    q = hardnegatives.integers(centres[group] + 0.05 * rng.normal(size=(8000, 32)))
    directions = hardnegatives.spread_directions(q[:500])
    rows = as_rows(q, np.zeros(8000, int), directions)
    nearest, order = rows.angles.argmin(axis=1), None
    order = np.lexsort((rows.angles.min(axis=1), nearest))
    rows = as_rows(q[order], np.zeros(8000, int), directions)
    anchors = as_rows(q[:80], np.zeros(80, int), directions)
    anchors.rid = anchors.rid - 1000
    first = hardnegatives.First(hardnegatives.sample_least(anchors, as_rows(q[1000:3000], np.zeros(2000, int), directions)), 5)
    assert hardnegatives.search(rows, nearest[order], anchors, first, True) < 0.3 * 80 * 8000


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(tokencounts.VOCABULARY))


def test_token_counts(spark, docs, empty, tokenizer):
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokencounts.count_tokens(docs).collect()}
    n = {r[0]: len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in corpus()}
    assert got == {(r[0], len((r[1] or "").encode()), n[r[0]], n[r[0]] > 2048) for r in corpus()}
    assert tokencounts.count_tokens(docs).count() == len(corpus()) and tokencounts.count_tokens(empty).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_of_tokenizers_that_keep_white_space(spark, name):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        encode = model.encode
    else:
        encode = lambda t: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids
    rows = [r for r in corpus()[:12] if len(r[1] or "") < 10_000]
    got = tokencounts.count_tokens(spark.createDataFrame(rows, SCHEMA), name, pieces_add_up=False)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {r[0]: len(encode(r[1] or "")) for r in rows}


ODD = ["a", "B", "'s", "'", "ll", " ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", " ", "　", "\u0085", "1", "²", "é", "é", "́", "Σ", "ς", "İ", "ﬁ", "한", "ᄒ", "ᅡ", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "!?", "_", "中", "😀", "‍", "-", "\x00", "­", "word ", "12 "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=50).map("".join))
def test_pieces_add_up_to_the_whole(tokenizer, text):
    whole = len(tokenizer.encode(text, add_special_tokens=False).ids)
    counter = tokencounts.Counter(tokenizer_path())
    assert counter.count([text.encode(), b"", text.encode()]) == [whole, 0, whole]
    parts = list(tokencounts.slices(text.encode(), 8))
    assert b"".join(parts) == text.encode()
    assert sum(len(tokenizer.encode(p.decode(), add_special_tokens=False).ids) for p in parts) == whole


def tokenizer_path():
    return tokencounts.vocabulary_path(tokencounts.VOCABULARY)


def test_long_texts_are_sliced(tokenizer):
    rng = random.Random(2)
    for sep in (" ", "", "7"):
        text = sep.join("".join(rng.choice("abcdé") for _ in range(6)) for _ in range(3000))
        parts = list(tokencounts.slices(text.encode(), 2000))
        assert b"".join(parts) == text.encode() and (len(parts) == 1) == (sep == "")
        assert sum(len(tokenizer.encode(p.decode(), add_special_tokens=False).ids) for p in parts) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_remembered_lengths_are_bounded(monkeypatch):
    counter = tokencounts.Counter(tokenizer_path())
    monkeypatch.setattr(tokencounts, "REMEMBERED", 50)
    texts = [f"word{i} again {'x' * 100}{i}".encode() for i in range(200)]
    want = counter.count(texts)
    monkeypatch.setattr(tokencounts, "STEP_BYTES", 300)
    assert counter.count(texts) == want and len(counter.known) < 100 and max(map(len, counter.known)) <= tokencounts.SHORT
