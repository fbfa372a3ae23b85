"""Benchmark decontamination: Wu-Manber search for benchmark windows in documents, on words as symbols.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window. Windows of
equal length form one Wu-Manber table: a block of two words at the end of the search position looks up how far the
search may move on (block shift table); at shift 0 the suffix-hash bucket of the block names the windows that may end
there; a direct comparison of the words confirms them. All positions of a batch move at once, in numpy.

The window table is broadcast only up to ``MAX_WINDOWS`` windows. A larger benchmark is written as blocks of about that
many, dealt out by the windows' hashes; one block at a time comes to the driver and is broadcast, searched in all
documents and let go, and what it found (texts with a hit only) is written and joined by the hash of the text.

Defined results: null or empty text has no words and no hits; windows found in several items count for each of them; items
without an id hit as others do, count as one item together, and are left out of the list of ids; a document is contaminated
if a word is hit, whatever the items are called;
an empty benchmark hits nothing; repeated rows give repeated results; ``drop_contaminated`` keeps all columns of the
documents whatever they are called, other columns of either table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytetext import Words, mix, text_steps
from tidemark.sources.tables import discard, staged

WINDOW = 10
#: Windows held by a task at once (about 200 bytes each).
MAX_WINDOWS = 500_000
#: Words of a text searched as one lane; lanes overlap by a window.
LANE_WORDS = 512
_TABLE_BITS = 22


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, window (lower-cased words with single spaces), n (its words); distinct."""
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    with_words = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return (
        with_words.select("item_id", "w", F.explode(starts).alias("s"))
        .select("item_id", F.array_join(F.slice("w", F.col("s") + 1, size), " ").alias("window"), F.least(F.size("w"), F.lit(size)).alias("n"))
        .distinct()
    )


class WuManber:
    """Shift and bucket tables for windows of one length of ``n`` words."""

    def __init__(self, windows: list[bytes], ids: list[int], n: int):
        self.n, self.block = n, min(2, n)
        self.texts, self.ids = windows, np.asarray(ids)
        hashes = Words(windows).hashes().reshape(len(windows), n)
        self.shift = np.full(1 << _TABLE_BITS, n - self.block + 1, np.int16)
        for end in range(self.block - 1, n):
            np.minimum.at(self.shift, self._slot(self._blocks(hashes[:, : end + 1])), n - 1 - end)
        suffix = self._blocks(hashes)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.by_suffix = suffix[order], order
        self.whole = self._whole(hashes)

    def _blocks(self, hashes: np.ndarray) -> np.ndarray:
        last = hashes[..., -1]
        return last if self.block == 1 else mix(hashes[..., -2] * np.uint64(0x9E3779B97F4A7C15) + last)

    @staticmethod
    def _whole(hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.uint64)
        for j in range(hashes.shape[1]):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[:, j])
        return out

    @staticmethod
    def _slot(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def search(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words and window indexes of all occurrences."""
        n = self.n
        begin, end = words.ptr[:-1], words.ptr[1:]
        lanes = np.maximum(0, -(-(end - begin - n + 1) // LANE_WORDS))
        which = np.repeat(np.arange(len(begin)), lanes)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = begin[which] + nth * LANE_WORDS + n - 1
        stop = np.minimum(pos + LANE_WORDS, end[which])
        found: list[np.ndarray] = []
        if self.block == 1:
            blocks_at = lambda p: hashes[p]
        else:
            blocks_at = lambda p: mix(hashes[p - 1] * np.uint64(0x9E3779B97F4A7C15) + hashes[p])
        while len(pos):
            blocks = blocks_at(pos)
            move = self.shift[self._slot(blocks)].astype(np.int64)
            hit = move == 0
            if hit.any():
                found.append(np.stack([pos[hit], blocks[hit].view(np.int64)]))
            pos = pos + np.maximum(move, 1)
            on = pos < stop
            if not on.all():
                pos, stop = pos[on], stop[on]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at, blocks = np.concatenate(found, axis=1)
        lo = np.searchsorted(self.suffix, blocks.view(np.uint64), "left")
        size = np.searchsorted(self.suffix, blocks.view(np.uint64), "right") - lo
        firsts, windows = [], []
        for k in range(0, len(at), 65_536):  # a bucket may be large; pairs are made for some positions at a time
            s = size[k : k + 65_536]
            a, l = at[k : k + 65_536][s > 0], lo[k : k + 65_536][s > 0]
            s = s[s > 0]
            if not len(a):
                continue
            text = self._whole(hashes[(a - n + 1)[:, None] + np.arange(n)])
            pair = np.repeat(np.arange(len(a)), s)
            w = self.by_suffix[np.arange(len(pair)) - np.repeat(np.cumsum(s) - s, s) + l[pair]]
            same = self.whole[w] == text[pair]
            firsts.append(a[pair[same]] - n + 1)
            windows.append(w[same])
        if not firsts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        first, window = np.concatenate(firsts), np.concatenate(windows)
        sure = np.fromiter((words.joined(f, n) == self.texts[w] for f, w in zip(first.tolist(), window.tolist())), bool, len(first))
        return first[sure], window[sure]


Block = list[tuple[bytes, int, list[str | None]]]


def _free_name(taken: list[str]) -> str:
    name = "found"
    while name in taken:
        name += "_"
    return name


def _search_block(docs: DataFrame, windows: Broadcast[Block], keep: list[str], found: str = "found") -> DataFrame:
    """The columns in ``keep`` and ``found``: n_words, hit_spans (maximal runs [first, end) of hit words), items, unnamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = windows.value
        by_n: dict[int, list[int]] = {}
        for i, (_, n, _) in enumerate(table):
            by_n.setdefault(n, []).append(i)
        tables = [WuManber([table[i][0] for i in ids], ids, n) for n, ids in by_n.items()]
        for batch in batches:
            for lo, hi, texts in text_steps(batch, "text"):
                words = Words(texts)
                hashes = words.hashes()
                edge = np.zeros(len(hashes) + 1, np.int64)
                items: list[set[str | None]] = [set() for _ in texts]
                for wm in tables:
                    first, window = wm.search(words, hashes)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + wm.n, -1)
                    owner = np.searchsorted(words.ptr, first, "right") - 1
                    for doc, w in {*zip(owner.tolist(), wm.ids[window].tolist())}:
                        items[doc].update(table[w][2])  # None: an item without an id
                hit = np.cumsum(edge[:-1]) > 0
                starts, ends = np.empty(0, np.int64), np.empty(0, np.int64)
                if hit.any():
                    fresh = np.zeros(len(hit), bool)
                    fresh[words.ptr[:-1][words.count() > 0]] = True
                    on = np.flatnonzero(hit & (fresh | ~np.concatenate([[False], hit[:-1]])))
                    last = np.flatnonzero(hit & (np.concatenate([fresh[1:], [True]]) | ~np.concatenate([hit[1:], [False]])))
                    starts, ends = on, last + 1
                cut = np.searchsorted(starts, words.ptr)
                spans = [
                    [{"first": int(s - words.ptr[d]), "end": int(e - words.ptr[d])} for s, e in zip(starts[cut[d] : cut[d + 1]], ends[cut[d] : cut[d + 1]])]
                    for d in range(len(texts))
                ]
                result = pa.StructArray.from_arrays(
                    [
                        pa.array(words.count(), pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(i - {None}) for i in items], pa.list_(pa.string())), pa.array([None in i for i in items], pa.bool_()),
                    ],
                    ["n_words", "hit_spans", "items", "unnamed"],
                )
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in keep), result], [*keep, found])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    schema = f"{kinds}`{found}` struct<n_words:long,hit_spans:array<struct<first:long,end:long>>,items:array<string>,unnamed:boolean>"
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def _merged(hits: DataFrame) -> DataFrame:
    """``hits`` with hit_spans, in any order and overlapping, as maximal runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("hit_spans")
            first, end = (spans.flatten().field(c).to_numpy() for c in ("first", "end"))
            owner = np.repeat(np.arange(len(spans)), np.asarray(spans.value_lengths()))
            order = np.lexsort((first, owner))
            owner, first, end = owner[order], first[order], end[order]
            # Spans of a later text lie beyond all of an earlier one's, so that one running maximum serves all texts.
            wide = int(end.max(initial=0)) + 1
            reach = np.maximum.accumulate(end + owner * wide) if len(end) else end
            begins = np.flatnonzero(np.concatenate([[True], first[1:] + owner[1:] * wide > reach[:-1]]) if len(end) else np.empty(0, bool))
            last = np.append(begins[1:], len(end)) - 1
            ends = (reach[last] - owner[last] * wide) if len(end) else end
            offsets = np.searchsorted(owner[begins], np.arange(len(spans) + 1))
            runs = pa.StructArray.from_arrays([pa.array(first[begins], pa.int64()), pa.array(ends, pa.int64())], ["first", "end"])
            at = batch.schema.names.index("hit_spans")
            yield batch.set_column(at, "hit_spans", pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs))

    return hits.mapInArrow(run, hits.schema)


def _window_blocks(benchmark: DataFrame, window: int, max_windows: int) -> tuple[int, Iterator[Broadcast[Block]]]:
    """Number of blocks, and all windows with their items in blocks of about ``max_windows``; only one is held at a time."""
    windows = item_windows(benchmark, window)
    by_window = windows.groupBy("window", "n").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.bool_or(F.col("item_id").isNull()).alias("unnamed"))
    table = staged(by_window, "windows")
    blocks = max(1, -(-table.count() // max_windows))

    def each() -> Iterator[Broadcast[Block]]:
        for i in range(blocks):
            rows = table.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == i).toLocalIterator()
            yield table.sparkSession.sparkContext.broadcast([(r["window"].encode(), r["n"], [*r["items"], *[None] * r["unnamed"]]) for r in rows])
        discard(table)

    return blocks, each()


def _names() -> tuple[Column, Column]:
    """128 bits that name a row's text."""
    text = F.coalesce("text", F.lit(""))
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(0x5EED), text).alias("h2")


def _hits_by_text(docs: DataFrame, blocks: Iterator[Broadcast[Block]]) -> DataFrame:
    """h1, h2, hit_spans, items, unnamed: one row for each text with a hit word in any block; staged block by block."""
    named = docs.select(*_names(), "text")
    parts = []
    for block in blocks:
        found = _search_block(named, block, ["h1", "h2"]).where(F.size("found.hit_spans") > 0)
        parts.append(staged(found.dropDuplicates(["h1", "h2"]).select("h1", "h2", "found.hit_spans", "found.items", "found.unnamed"), "hits"))
        block.destroy()
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    return _merged(every.groupBy("h1", "h2").agg(F.flatten(F.collect_list("hit_spans")).alias("hit_spans"), items.alias("items"), F.bool_or("unnamed").alias("unnamed")))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, hit_spans, items (ids of the benchmark items with occurring windows), unnamed (one without an id has)."""
    n, blocks = _window_blocks(benchmark, window, max_windows)
    if n == 1:
        (block,) = blocks
        return _search_block(docs, block, ["doc_id"]).select("doc_id", "found.*")
    hits = _hits_by_text(docs, blocks)
    n_words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    rows = docs.select("doc_id", *_names(), n_words.cast("long").alias("n_words"))
    none = F.array().cast("array<struct<first:long,end:long>>")
    return rows.join(hits, ["h1", "h2"], "left").select(
        "doc_id", "n_words", F.coalesce("hit_spans", none).alias("hit_spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("unnamed", F.lit(False)).alias("unnamed")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Rows without any window, all columns as they are. No row is shuffled for a benchmark of one block."""
    n, blocks = _window_blocks(benchmark, window, max_windows)
    if n == 1:
        (block,) = blocks
        found = _free_name(docs.columns)
        return _search_block(docs, block, docs.columns, found).where(F.size(F.col(f"{found}.hit_spans")) == 0).drop(found)
    h1, h2 = _names()
    hits = _hits_by_text(docs, blocks).select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"))
    return docs.join(hits, (h1 == F.col("__h1")) & (h2 == F.col("__h2")), "left_anti")


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_contamination(docs, benchmark, window, max_windows)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def items_digest(items: list[str]) -> str:
    """The digest of a list of item ids, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
