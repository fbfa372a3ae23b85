"""Suffix-array dedup: remove every byte covered by a string of ``LENGTH`` bytes that also starts in an earlier document.

Two documents that share such a string share an *anchor* in it: the k-gram of least hash among the string's k-grams.
So each text is cut into segments, one per run of windows with the same anchor, and only segments that meet another
document's at their anchor are looked at further.

0. Equal texts are one text, of the least doc_id that has it; the others are covered whole and only named. The texts
   move once: into a table bucketed by that doc_id, which the later steps join without moving it again.
1. Which anchors stand in two documents? Only (anchor key, document) is shuffled; the key has just enough bits for the
   corpus (false meetings cost work, not correctness). An anchor in many documents of one Arrow batch is known to be
   shared there, so two rows stand for the batch and no task gathers all its documents.
2. Texts get their shared anchors back, and their segments meet by (anchor, segment hash): 128 bits, dealt out by both.
   Of equal segments in a batch only the earliest document's go on; the others are covered by it. Segments equal to an
   earlier document's are covered whole; the first of several unequal segments at one anchor are undecided.
3. The undecided segments' bytes are gathered by anchor into blocks, and each block gets a suffix array by two-stage
   sorting: suffixes smaller than their successor are sorted directly, all others are induced from them by one scan over
   the buckets of first bytes; common prefixes of adjacent suffixes then show which windows start in which documents.
   An anchor with more than ``ANCHOR_BYTES`` has none: its windows are dealt out by their bytes, and each is covered if
   the least document with it is an earlier one.
4. The covered ranges of a text are united and cut out of it, and the rows of ``docs`` take their text's result.

Defined results: null text is empty; a row without doc_id has no place in the order and is left whole; rows of equal
doc_id do not remove each other, whether their texts are equal (then so are their results) or not; an empty table gives
an empty result; other columns are not read; a doc_id that is not a whole number is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytetext import mix, span_hashes, text_steps
from tidemark.sources.tables import discard, staged

LENGTH = 50
GRAM = 20
#: Bytes of segments sorted together.
BLOCK_BYTES = 1 << 20
#: Bytes of one anchor's segments up to which a block holds them; beyond, their windows are dealt out by their bytes.
ANCHOR_BYTES = 1 << 20
#: Documents of a batch from which an anchor counts as shared without meeting others.
COMMON = 8
#: Bytes of text in a bucket, about.
BUCKET_BYTES = 64 << 20


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text index, first window, windows, anchor hash, segment hash) of all segments of some texts."""
    none = np.empty(0, np.int64)
    raw = b"".join(texts)
    if len(raw) < length:
        return none, none, none, none, none
    buf = np.frombuffer(raw, np.uint8)
    at = np.arange(len(buf) - gram + 1)
    hashes = span_hashes(buf, at, at + gram)
    packed = ((hashes >> np.uint64(32)) << np.uint64(32)) | at.astype(np.uint64)
    anchor = (_sliding_min(packed, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[: len(anchor)]
    inside = np.arange(len(anchor)) + length <= ends[owner]
    fresh = np.empty(len(anchor), bool)
    fresh[0] = True
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh & inside)
    stop = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~fresh[1:], [False]])) + 1
    whole = span_hashes(buf, first, stop - 1 + length)
    return owner[first], first - begins[owner[first]], stop - first, hashes[anchor[first]].view(np.int64), whole.view(np.int64)


def _key(k: np.ndarray, bits: int) -> np.ndarray:
    return (k.view(np.uint64) >> np.uint64(64 - bits)).view(np.int64)


def _anchor_rows(texts: DataFrame, length: int, gram: int, bits: int) -> DataFrame:
    """k (anchor key), doc: once per document and key; ``sure`` has the key where it is known to be shared, and k is spread then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column("doc"), np.int64)
            parts = []
            for lo, hi, texts in text_steps(batch, "text"):
                owner, _, _, k, _ = segments(texts, length, gram)
                parts.append((_key(k, bits), ids[lo:hi][owner]))
            k, doc = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 2
            if not len(k):
                continue
            order = np.lexsort((doc, k))
            k, doc = k[order], doc[order]
            once = np.concatenate([[True], (k[1:] != k[:-1]) | (doc[1:] != doc[:-1])])
            k, doc = k[once], doc[once]
            head = np.concatenate([[True], k[1:] != k[:-1]])
            group = np.cumsum(head) - 1
            common = (np.bincount(group) > COMMON)[group]
            plain = ~common | head | np.concatenate([[False], head[:-1]])  # two documents stand for a common anchor
            sure = k[common]
            spread = _key(mix(sure.view(np.uint64) + mix(doc[common].view(np.uint64))).view(np.int64), bits)
            rows = int(plain.sum())
            keys, ids = np.concatenate([k[plain], spread]), np.concatenate([doc[plain], doc[common]])
            known = np.concatenate([np.zeros(rows, np.int64), sure])
            unknown = np.arange(len(keys)) < rows
            for a in range(0, len(keys), 500_000):
                s = slice(a, a + 500_000)
                yield pa.RecordBatch.from_arrays([pa.array(keys[s]), pa.array(ids[s]), pa.array(known[s], mask=unknown[s])], ["k", "doc", "sure"])

    return texts.select("doc", "text").mapInArrow(run, "k long, doc long, sure long")


def _shared_segments(rows: DataFrame, length: int, gram: int, bits: int) -> DataFrame:
    """doc, nth, los (first windows), n (windows), k (anchor), seg, known: covered by an earlier document of the batch.

    ``rows``: doc, nth, text, keys (of the shared anchors of the document).
    """
    pair = lambda key, text: mix(key.view(np.uint64) + mix(text.astype(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, nths = np.array(batch.column("doc"), np.int64), np.array(batch.column("nth"), np.int32)
            wanted = batch.column("keys")
            parts = []
            for lo, hi, texts in text_steps(batch, "text"):
                owner, first, n, k, seg = segments(texts, length, gram)
                lists = wanted.slice(lo, hi - lo)
                of = np.repeat(np.arange(hi - lo), [len(x) for x in lists])
                on = np.isin(pair(_key(k, bits), owner), pair(np.asarray(lists.flatten()).astype(np.int64), of))
                parts.append((owner[on] + lo, first[on], n[on], k[on], seg[on]))
            text, first, n, k, seg = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 5
            if not len(text):
                continue
            doc = ids[text]
            order = np.lexsort((text, doc, mix(k.view(np.uint64) + seg.view(np.uint64))))
            text, doc, first, n, k, seg = text[order], doc[order], first[order], n[order], k[order], seg[order]
            head = np.concatenate([[True], (k[1:] != k[:-1]) | (seg[1:] != seg[:-1])])
            known = doc > doc[head][np.cumsum(head) - 1]
            # A text's repeats of one segment are one row with all their places.
            own = np.flatnonzero(np.concatenate([[True], head[1:] | (text[1:] != text[:-1])]))
            places = np.append(own, len(text))
            k, doc, nth, n, seg, known = k[own], doc[own], nths[text[own]], n[own], seg[own], known[own]
            # Covered segments need no meeting; they are dealt out evenly by a key of their own.
            k = np.where(known, mix(doc.view(np.uint64) * np.uint64(31) + first[own].view(np.uint64)).view(np.int64), k)
            seg = np.where(known, 0, seg)
            for a in range(0, len(doc), 200_000):
                s = slice(a, a + 200_000)
                cut = places[a : a + 200_001]
                lists = pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), pa.array(first[cut[0] : cut[-1]].astype(np.int32)))
                made = [pa.array(k[s]), pa.array(doc[s]), pa.array(nth[s]), lists, pa.array(n[s].astype(np.int16)), pa.array(seg[s]), pa.array(known[s])]
                yield pa.RecordBatch.from_arrays(made, ["k", "doc", "nth", "los", "n", "seg", "known"])

    return rows.mapInArrow(run, "k long, doc long, nth int, los array<int>, n short, seg long, known boolean")


def suffix_array(text: np.ndarray, depth: int = LENGTH + 6) -> np.ndarray:
    """Positions of all suffixes in the order of their first ``depth`` bytes at least (two-stage sorting)."""
    size = len(text)
    if not size:
        return np.empty(0, np.int64)
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    word = np.zeros(size + depth, np.uint64)
    for j in range(8):
        word = (word << np.uint64(8)) | padded[j : j + size + depth].astype(np.uint64)
    # Type of a suffix: set by the next byte that differs; the last one is larger than the empty suffix after it.
    follow = np.append(text[1:].astype(np.int16), -1)
    differs = np.where(follow != text, np.arange(size), size - 1)
    decided = np.minimum.accumulate(differs[::-1])[::-1]
    small = text[decided] < follow[decided]
    # Stage 1: suffixes smaller than their successor, by words of eight bytes; each word sorts what is still tied.
    sa = np.flatnonzero(small)
    sa = sa[np.argsort(word[sa], kind="stable")]
    group = np.cumsum(np.concatenate([[0], word[sa[1:]] != word[sa[:-1]]])) if len(sa) else np.empty(0, np.int64)
    for k in range(8, depth, 8):
        tied = np.zeros(len(sa), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            break
        keys = word[np.minimum(sa[at] + k, len(word) - 1)]
        order = np.lexsort((keys, group[at]))
        sa[at], keys = sa[at][order], keys[order]
        cut = np.zeros(len(sa), np.int64)
        cut[1:] = ~same
        cut[at[1:]] |= keys[1:] != keys[:-1]
        group = np.cumsum(cut)
    # Stage 2: all others, bucket by bucket of their first byte, from the suffixes that follow them.
    heads = text[sa]
    cuts = np.searchsorted(heads, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[size - 1]].append(np.array([size - 1]))
    out: list[np.ndarray] = []
    for c in np.unique(text).tolist():
        induced = waiting[c]
        new = np.concatenate(induced) if induced else np.empty(0, np.int64)
        large = [new]
        while len(new):
            new = new[new > 0] - 1
            new = new[(text[new] == c) & ~small[new]]
            large.append(new)
        bucket = np.concatenate([*large, sa[cuts[c] : cuts[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        if len(before):
            order = np.argsort(text[before], kind="stable")
            before = before[order]
            lead = text[before]
            edge = np.flatnonzero(np.concatenate([[True], lead[1:] != lead[:-1]]))
            for part in np.split(before, edge[1:]):
                waiting[text[part[0]]].append(part)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int = LENGTH) -> np.ndarray:
    """Bytes (``cap`` at most) that each suffix of ``order`` shares with the one before it; 0 for the first."""
    padded = np.concatenate([text, np.zeros(cap, np.uint8)])
    shared = np.zeros(len(order), np.int64)
    on = np.arange(1, len(order))
    for j in range(cap):
        on = on[padded[order[on] + j] == padded[order[on - 1] + j]]
        if not len(on):
            break
        shared[on] = j + 1
    return shared


def covered_windows(parts: list[bytes], docs: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(part, window in it) of every window that also starts in a part of a smaller document, by suffix array."""
    text = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(parts)), sizes)
    order = suffix_array(text, length + 6)
    order = order[order + length <= ends[owner[order]]]
    if not len(order):
        return order, order
    fresh = common_prefixes(text, order, length) < length
    fresh[0] = True
    least = np.minimum.reduceat(docs[owner[order]], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
    hit = np.sort(order[least < docs[owner[order]]])
    return owner[hit], hit - (ends - sizes)[owner[hit]]


def _resolve(segs: DataFrame, length: int) -> DataFrame:
    """doc, nth, los, n: covered runs of n windows from each of los on. ``segs``: k, doc, nth, los, bytes; sorted by k inside partitions."""

    def block(docs: list, nths: list, los: list, parts: list[bytes]) -> pa.RecordBatch:
        ids, nths = np.array(docs, np.int64), np.array(nths, np.int32)
        part, window = covered_windows(parts, ids, length)
        head = np.concatenate([[True], (part[1:] != part[:-1]) | (window[1:] != window[:-1] + 1)])[: len(part)]
        tail = np.concatenate([head[1:], [True]])[: len(part)]
        part, begin, n = part[head], window[head], window[tail] - window[head] + 1
        places = [[x + b for x in los[p]] for p, b in zip(part.tolist(), begin.tolist())]  # a run holds at every place of its segment
        made = [pa.array(ids[part]), pa.array(nths[part]), pa.array(places, pa.list_(pa.int32())), pa.array(n.astype(np.int16))]
        return pa.RecordBatch.from_arrays(made, ["doc", "nth", "los", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size, last = 0, None
        for batch in batches:
            for k, *row in zip(*(batch.column(c).to_pylist() for c in ("k", "doc", "nth", "los", "bytes"))):
                if size >= BLOCK_BYTES and k != last:
                    yield block(*held)
                    held, size = [[], [], [], []], 0
                for column, value in zip(held, row):
                    column.append(value)
                size, last = size + len(row[3]), k
        if held[0]:
            yield block(*held)

    return segs.mapInArrow(run, "doc long, nth int, los array<int>, n short")


def _resolve_dealt(segs: DataFrame, length: int) -> DataFrame:
    """doc, nth, los, n of covered windows, for anchors too large for a block. Equal windows have equal anchors, so the bytes suffice."""
    windows = segs.select("doc", "nth", "los", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("i"))
    windows = windows.select("doc", "nth", "los", "i", F.expr(f"substring(bytes, i + 1, {length})").alias("window"))
    first = windows.groupBy("window").agg(F.min("doc").alias("first_doc"))
    covered = windows.join(first, "window").where("doc > first_doc")
    return covered.select("doc", "nth", F.expr("transform(los, x -> x + i)").alias("los"), F.lit(1).cast("short").alias("n"))


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """Unite the ranges of each text and cut them out. ``rows``: doc, nth, h1, h2, text, r (structs nth, los, n of the doc's covered runs, or null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column("text").cast(pa.binary())
            for i, (nth, runs) in enumerate(zip(batch.column("nth").to_pylist(), batch.column("r"))):
                text = texts[i].as_py()
                keep, removed, spans, at = hashlib.sha256(), 0, 0, 0
                if runs.is_valid:
                    runs = runs.values
                    runs = runs.filter(pc.equal(runs.field("nth"), nth))
                    lists = runs.field("los")
                    lo = np.asarray(lists.flatten()).astype(np.int64)
                    hi = lo + np.repeat(np.asarray(runs.field("n")).astype(np.int64), np.asarray(lists.value_lengths())) + length - 1
                    order = np.argsort(lo, kind="stable")
                    lo, reach = lo[order], np.maximum.accumulate(hi[order])
                    head = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]])[: len(lo)])
                    for a, b in zip(lo[head].tolist(), reach[np.append(head[1:], len(lo))[: len(head)] - 1].tolist()):
                        keep.update(text[at:a])
                        removed, spans, at = removed + b - a, spans + 1, b
                keep.update(text[at:])
                out.append((removed, spans, keep.hexdigest()))
            columns = list(zip(*out)) or [()] * 3
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("h1"), batch.column("h2"), *made], ["doc", "h1", "h2", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, "doc long, h1 long, h2 long, n_removed long, n_spans long, kept_sha256 string")


def _names(text: Column) -> tuple[Column, Column]:
    """128 bits that name a text."""
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(0x5EED), text).alias("h2")


def _bucketed_texts(docs: DataFrame, rows: DataFrame, length: int, parts: int) -> DataFrame:
    """doc (least doc_id of the text), nth (of the doc's texts), h1, h2, text: every text once, in ``parts`` buckets by doc."""
    of_doc = rows.where(F.col("doc_id").isNotNull() & (F.col("n_bytes") >= length))
    named = of_doc.groupBy("doc_id", "h1", "h2").agg(F.count(F.lit(1)).alias("copies"))
    named = named.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "copies")).alias("m"))
    nth = F.row_number().over(Window.partitionBy("doc").orderBy("h1", "h2"))
    texts = staged(named.select(F.col("m.doc_id").alias("doc"), "h1", "h2", F.col("m.copies").alias("copies")).withColumn("nth", nth), "texts")
    most = texts.agg(F.max("copies")).first()[0] or 1
    own = docs.select(F.col("doc_id").cast("long").alias("doc"), *_names(F.col("text")), "text").where(F.octet_length("text") >= length)
    light = texts.select("doc", "nth", F.col("h1").alias("t1"), F.col("h2").alias("t2")).repartition(parts, "doc")
    # The texts' names are no join keys here: rows stay dealt out by doc alone, as the buckets are.
    same = (F.col("h1").bitwiseXOR(F.col("t1")) == 0) & (F.col("h2").bitwiseXOR(F.col("t2")) == 0)
    found = own.repartition(parts, "doc").join(light.hint("SHUFFLE_HASH"), "doc").where(same).select("doc", "nth", "h1", "h2", "text")
    if most > 1:  # rows that repeat doc_id and text: one stands for them, found before the shuffle
        found = found.groupBy("doc", "nth", "h1", "h2").agg(F.first("text").alias("text")).repartition(parts, "doc")
    out = staged(found, "bucketed-texts", "doc", parts)
    discard(texts)
    return out


def _covered_runs(texts: DataFrame, total: int, length: int, gram: int, parts: int) -> DataFrame:
    """doc, r: structs (nth, los, n) of runs of n windows, from each of los on, that also start in an earlier document.

    ``texts``: bucketed; ``total``: their bytes.
    """
    bits = min(63, max(24, total.bit_length() + 4))  # an anchor per 18 bytes: about 1 false meeting in 256 anchors
    by_key = Window.partitionBy("k")
    shared = (
        _anchor_rows(texts, length, gram, bits)
        .withColumn("meets", F.max("doc").over(by_key) > F.min("doc").over(by_key))
        .where(F.col("sure").isNotNull() | F.col("meets"))
        .select("doc", F.coalesce("sure", "k").alias("k"))
    )
    keys = staged(shared.repartition(parts, "doc").groupBy("doc").agg(F.collect_list("k").alias("keys")), "keys", "doc", parts)
    at_shared = texts.join(keys.hint("SHUFFLE_HASH"), "doc").select("doc", "nth", "text", "keys")
    first = F.first("doc").over(Window.partitionBy("k", "seg").orderBy("doc"))
    met = _shared_segments(at_shared, length, gram, bits).withColumn("closed", F.col("known") | (F.col("doc") > first))
    met = staged(met.select(F.when(~F.col("closed"), F.col("k")).alias("k"), "doc", "nth", "los", "n"), "segments")
    discard(keys)
    closed, firsts = met.where("k IS NULL").drop("k"), met.where("k IS NOT NULL")
    anchors = firsts.groupBy("k").agg(F.count(F.lit(1)).alias("segs"), F.sum(F.col("n") - 1 + length).alias("size")).where("segs > 1")
    undecided = firsts.join(anchors, "k").withColumn("large", F.col("size") > ANCHOR_BYTES)
    undecided = undecided.repartition(parts, "doc").groupBy("doc").agg(F.collect_list(F.struct("k", "large", "nth", "los", "n")).alias("open"))
    undecided = staged(undecided, "undecided", "doc", parts)

    def segs(large: bool) -> DataFrame:
        wanted = undecided.select("doc", F.filter("open", lambda x: x["large"] == large).alias("open")).where(F.size("open") > 0)
        start, size = (F.get("x.los", F.lit(0)) + 1).cast("int"), (F.col("x.n") - 1 + length).cast("int")
        return (
            texts.join(wanted.hint("SHUFFLE_HASH"), "doc")
            .select("doc", "nth", F.col("text").cast("binary").alias("b"), F.explode(F.filter("open", lambda x: x["nth"] == F.col("nth"))).alias("x"))
            .select(F.col("x.k").alias("k"), "doc", "nth", F.col("x.los").alias("los"), F.substring("b", start, size).alias("bytes"))
        )

    runs = closed.unionByName(_resolve(segs(False).repartition("k").sortWithinPartitions("k"), length))
    if not undecided.where(F.exists("open", lambda x: x["large"])).isEmpty():
        runs = runs.unionByName(_resolve_dealt(segs(True), length))
    by_doc = runs.repartition(parts, "doc").groupBy("doc").agg(F.collect_list(F.struct("nth", "los", "n")).alias("r"))
    out = staged(by_doc, "covered", "doc", parts)
    discard(met, undecided)
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"doc_id must be a whole number, not {kind}")
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    whole = F.when(F.col("doc_id").isNull() | (size < length), F.sha2(text, 256))
    rows = staged(docs.select("doc_id", *_names(text), size.alias("n_bytes"), whole.alias("whole")), "rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    texts = _bucketed_texts(docs, rows, length, parts)
    covered = _covered_runs(texts, total, length, gram, parts)
    found = staged(_cut(texts.join(covered.hint("SHUFFLE_HASH"), "doc", "left"), length), "cut")
    discard(texts, covered)
    # Of equal texts only the earliest document's has bytes of its own.
    own = F.col("doc_id") == F.col("doc")
    left = rows.join(found, ["h1", "h2"], "left")
    return left.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("whole").isNotNull(), F.lit(0)).when(own, F.col("n_removed")).otherwise(F.col("n_bytes")).cast("long").alias("n_removed"),
        F.when(F.col("whole").isNotNull(), F.lit(0)).when(own, F.col("n_spans")).otherwise(F.lit(1)).cast("long").alias("n_spans"),
        F.coalesce("whole", F.when(own, F.col("kept_sha256")).otherwise(F.sha2(F.lit(""), 256))).alias("kept_sha256"),
    )
