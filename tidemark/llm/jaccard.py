"""N-gram Jaccard join by chosen paths: near-duplicate texts at ``THRESHOLD`` over shingles of ``SHINGLE`` words.

Texts with the same set of shingles form one class and are represented once. Every representative has a signature of
``COORDS`` sampled tokens (its minimum shingle under as many hash orders: a random shared token agrees with probability
equal to the Jaccard similarity). A run starts with all representatives in one node; a node chooses one coordinate, at
times a second (1 / THRESHOLD on average), and sends each member to the child named by its token there. Nodes of at
most ``SMALL`` members, and nodes at depth ``DEPTH``, are joined by brute force, cut into blocks of pairs where they are large.
Runs are repeated until a pair at the threshold is found with probability ``RECALL``.

In a node, pairs whose signatures agree far less than the threshold are set aside and the others are verified on their
whole shingle sets; the few pairs at the threshold that are set aside are part of what ``RECALL`` allows. A pair that
meets in several nodes counts in the one of least number only, so links are counted without writing out pairs. Links
inside a block become one edge per member (to the block's root); connected components of these edges are the groups.

A block is bounded in rows (``BLOCK``) and bytes (``BLOCK_BYTES``). A set in a large node goes to each block of pairs that
it is in: a node of m members moves each set m / ``BLOCK`` times, for m comparisons.

Defined results: a text of fewer than ``SHINGLE`` words, but not none, is one shingle; null text or text without a word
is a class of its own with no link; a row without doc_id is a document like others, and a group of such rows only has
class null; rows repeating a doc_id are documents of their own, with equal or other texts; doc_id may have any type that
can be ordered; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytetext import Words, mix, text_steps
from tidemark.sources.tables import discard, staged

SHINGLE = 5
THRESHOLD = 0.8
COORDS = 64
SMALL = 256
DEPTH = 3
RECALL = 0.999
BLOCK = 256
BLOCK_BYTES = 8 << 20
#: Standard deviations of the signature's estimate below the threshold at which a pair is set aside.
SLACK = 4.0
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH, coords: int = COORDS) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall`` at this depth.

    All runs draw from the same ``coords`` coordinates, so the chance is averaged over how many of them the pair shares;
    below ``least_agreement`` a pair is missed however often it meets.
    """
    extra = 1 / threshold - 1
    agree = np.arange(coords + 1) / coords
    step = (1 - extra) * agree + extra * (1 - (1 - agree) ** 2)
    seen = agree >= least_agreement(threshold, coords)
    share = np.array([math.comb(coords, k) * threshold**k * (1 - threshold) ** (coords - k) for k in range(coords + 1)])
    if share[~seen].sum() > 1 - recall:
        raise ValueError(f"a recall of {recall} needs more than {coords} coordinates")
    runs = 1
    while share @ np.where(seen, (1 - step**depth) ** runs, 1.0) > 1 - recall:
        runs += 1
    return runs


def least_agreement(threshold: float = THRESHOLD, coords: int = COORDS) -> float:
    """Share of equal coordinates from which a pair is verified."""
    return threshold - SLACK * math.sqrt(threshold * (1 - threshold) / coords)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(texts)
    h = words.hashes()
    out = []
    rolled = h.copy()
    for j in range(1, size):
        rolled = mix(rolled[: len(rolled) - 1] * _GOLD + h[j:]) if len(rolled) else rolled
    for a, b in zip(words.ptr[:-1].tolist(), words.ptr[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            one = h[a : a + 1]
            for x in h[a + 1 : b]:
                one = mix(one * _GOLD + x)
            out.append(mix(one + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _orders(coords: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * coords + 1, dtype=np.uint64) * _GOLD)
    return seeds[:coords] | np.uint64(1), seeds[coords:]


def signature(tokens: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """32 bits of the token of least hash under each order."""
    mul, add = _orders(coords)
    least = np.full(coords, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(tokens), 4096):
        t = tokens[lo : lo + 4096, None] * mul + add
        np.minimum(least, (t ^ (t >> np.uint64(31))).min(axis=0), out=least)
    return (mix(least) >> np.uint64(32)).astype(np.uint32)


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    if not len(tokens):
        return 0, 0
    a = mix(np.array([np.bitwise_xor.reduce(mix(tokens)) + np.uint64(len(tokens))], np.uint64))
    b = mix(np.array([np.add.reduce(mix(tokens * _GOLD + np.uint64(1)))], np.uint64))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def text_names() -> tuple[Column, Column]:
    """h1, h2: 128 bits that name a row's text, to find it again."""
    text = F.coalesce("text", F.lit(""))
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(0x5EED), text).alias("h2")


def _sign(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, h1, h2, n (shingles), k1, k2 (name of the set), sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_steps(batch, "text"):
                sets = shingle_sets(texts, size)
                keys = [set_key(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "h1", "h2")), pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                        pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "h1", "h2", "n", "k1", "k2", "sig"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *text_names(), "text").mapInArrow(run, f"doc_id {kind}, h1 long, h2 long, n int, k1 long, k2 long, sig binary")


def _children(nodes: np.ndarray, sigs: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for each row's node and signature."""
    chance = np.uint64(int((1 / threshold - 1) * 2**32))
    rows, out = [], []
    for j in range(2):
        pick = mix(nodes + np.uint64(11 + j))
        on = np.arange(len(nodes)) if j == 0 else np.flatnonzero((mix(nodes) >> np.uint64(32)) < chance)
        coord = (pick[on] % np.uint64(sigs.shape[1])).astype(np.int64)
        token = sigs[on, coord].astype(np.uint64)
        rows.append(on)
        out.append(mix(mix(nodes[on] + np.uint64(7)) ^ mix((coord.astype(np.uint64) << np.uint64(32)) | token)))
    return np.concatenate(rows), np.concatenate(out)


def _split(df: DataFrame, runs: int, threshold: float) -> DataFrame:
    """rep, n, node: the children of each row's node, or of the root of every run where there is no ``node`` yet."""
    first = "node" not in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            if first:
                roots = [np.full(batch.num_rows, r, np.uint64) for r in mix(np.arange(1, runs + 1, dtype=np.uint64))]
            else:
                roots = [np.array(batch.column("node"), np.int64).view(np.uint64)]
            for nodes in roots:
                rows, child = _children(nodes, sigs, threshold)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays([batch.column("rep").take(at), batch.column("n").take(at), pa.array(child.view(np.int64))], ["rep", "n", "node"])

    return df.mapInArrow(run, "rep long, n int, node long")


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[list]]:
    """Rows of each (node, b1, b2) from partitions sorted by them; a block holds 2 * BLOCK rows at most, about."""
    held: list[list] = [[] for _ in columns]
    key = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if row[:3] != key:
                if len(held[0]) > 1:
                    yield held
                held, key = [[] for _ in columns], row[:3]
            for column, value in zip(held, row):
                column.append(value)
    if len(held[0]) > 1:
        yield held


def _meets_first(node: int, paths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether this node is the least of the nodes that both rows of a pair are in. ``paths``: padded with distinct values."""
    first = np.ones(len(i), bool)
    for k in range(0, len(i), 8192):
        a, b = paths[i[k : k + 8192]], paths[j[k : k + 8192]]
        both = (a[:, :, None] == b[:, None, :]) & (a < node)[:, :, None]
        first[k : k + 8192] = ~both.any(axis=(1, 2))
    return first


def _padded(lists: list[list[int]]) -> np.ndarray:
    """Rows of unequal length as a matrix; a row is filled up with its own first value."""
    width = max(map(len, lists))
    return np.array([x + x[:1] * (width - len(x)) for x in lists], np.int64)


def _across(b1: int, b2: int, side: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of a block of two parts only the pairs between them count; their inner pairs belong to other blocks."""
    return np.ones(len(i), bool) if b1 == b2 else side[i] != side[j]


def _sketch(rows: DataFrame, threshold: float) -> DataFrame:
    """The rows (rep, node, b1, b2, side) that have a pair to verify in their block."""
    least = least_agreement(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["node", "b1", "b2", "side", "rep", "sig", "n", "paths"]
        for node, b1, b2, side, rep, sig, n, paths in _groups(batches, columns):
            sigs = np.frombuffer(b"".join(sig), np.uint32).reshape(len(sig), -1)
            size, sides = np.array(n), np.array(side)
            wanted = np.zeros(len(rep), bool)
            padded = _padded(paths)
            for lo in range(0, len(rep), 64):
                agree = np.zeros((min(64, len(rep) - lo), len(rep)), np.int16)
                for c in range(sigs.shape[1]):
                    agree += sigs[lo : lo + 64, c, None] == sigs[None, :, c]
                i, j = np.nonzero(agree >= least * sigs.shape[1])
                i += lo
                on = (i < j) & (np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]))
                i, j = i[on], j[on]
                on = _across(b1[0], b2[0], sides, i, j)
                i, j = i[on], j[on]
                on = _meets_first(node[0], padded, i, j)
                wanted[i[on]] = True
                wanted[j[on]] = True
            if wanted.any():
                at = np.flatnonzero(wanted).tolist()
                pick = lambda x: [x[k] for k in at]
                yield pa.RecordBatch.from_pydict({"rep": pick(rep), "node": pick(node), "b1": pick(b1), "b2": pick(b2), "side": pick(side), "paths": pick(paths)}, schema=arrow)

    arrow = pa.schema([("rep", pa.int64()), ("node", pa.int64()), ("b1", pa.int32()), ("b2", pa.int32()), ("side", pa.int32()), ("paths", pa.list_(pa.int64()))])
    return rows.mapInArrow(run, "rep long, node long, b1 int, b2 int, side int, paths array<long>")


def _shingled(rows: DataFrame, size: int) -> DataFrame:
    """One row per (rep, node, block) with the representative's whole shingle set; of repeated rows one a task goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for lo, hi, texts in text_steps(batch, "text"):
                part = batch.slice(lo, hi - lo)
                sets = shingle_sets(texts, size)
                keys = list(zip(part.column("k1").to_pylist(), part.column("k2").to_pylist()))
                rep, weight, places, paths = (part.column(c).to_pylist() for c in ("rep", "weight", "places", "paths"))
                for d in range(hi - lo):
                    if rep[d] in done:
                        continue
                    done.add(rep[d])
                    if set_key(sets[d]) != keys[d]:
                        raise ValueError(f"the text of {rep[d]} has another shingle set than before")
                    data = sets[d].tobytes()
                    for a in range(0, len(places[d]), max(1, (4 << 20) // max(len(data), 1))):
                        some = places[d][a : a + max(1, (4 << 20) // max(len(data), 1))]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "node": [p["node"] for p in some], "b1": [p["b1"] for p in some], "b2": [p["b2"] for p in some],
                                "side": [p["side"] for p in some], "rep": [rep[d]] * len(some), "weight": [weight[d]] * len(some),
                                "paths": [paths[d]] * len(some), "tokens": [data] * len(some),
                            },
                            schema=arrow,
                        )

    arrow = pa.schema([("node", pa.int64()), ("b1", pa.int32()), ("b2", pa.int32()), ("side", pa.int32()), ("rep", pa.int64()), ("weight", pa.int64()), ("paths", pa.list_(pa.int64())), ("tokens", pa.binary())])
    return rows.mapInArrow(run, "node long, b1 int, b2 int, side int, rep long, weight long, paths array<long>, tokens binary")


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of tokens that two sets share."""
    size = len(sets)
    out = np.zeros((size, size), np.float32)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(size), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    column = np.cumsum(np.concatenate([[0], tokens[1:] != tokens[:-1]]))
    often = np.bincount(column) > 1
    on = often[column]
    column, owner = (np.cumsum(often) - 1)[column[on]], owner[on]
    if not len(column):
        return out
    for lo in range(0, int(column[-1]) + 1, 4096):
        a, b = np.searchsorted(column, (lo, lo + 4096))
        tile = np.zeros((size, 4096), np.float32)
        tile[owner[a:b], column[a:b] - lo] = 1
        out += tile @ tile.T
    return out


def _roots(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least row that each row is connected to."""
    root = np.arange(size)
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _verify(rows: DataFrame, threshold: float) -> DataFrame:
    """rep, links (documents, counted in this block), root (a connected representative of the block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, b1, b2, side, rep, weight, paths, tokens in _groups(batches, ["node", "b1", "b2", "side", "rep", "weight", "paths", "tokens"]):
            order = np.unique(np.array(rep), return_index=True)[1]
            rep, weight, sides = np.array(rep)[order], np.array(weight)[order], np.array(side)[order]
            sets = [np.frombuffer(tokens[k], np.uint64) for k in order.tolist()]
            size = np.array([len(s) for s in sets], np.float32)
            shared = _shared_counts(sets)
            i, j = np.nonzero(np.triu(shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-3, 1))
            both = np.rint(shared[i, j]).astype(np.int64)
            union = size[i].astype(np.int64) + size[j].astype(np.int64) - both
            on = (both >= threshold * union) & _across(b1[0], b2[0], sides, i, j)
            i, j = i[on], j[on]
            if not len(i):
                continue
            first = _meets_first(node[0], _padded([paths[k] for k in order.tolist()]), i, j)
            links = np.bincount(i[first], weight[j[first]], len(rep)) + np.bincount(j[first], weight[i[first]], len(rep))
            root = rep[_roots(len(rep), i, j)]
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(links.astype(np.int64)), pa.array(root)], ["rep", "links", "root"])

    return rows.mapInArrow(run, "rep long, links long, root long")


def components(edges: DataFrame) -> DataFrame:
    """v, label: least vertex of each vertex's connected component, staged. ``edges``: a, b (any order, any number of times)."""
    once = staged(edges.where("a <> b").distinct().select("a", "b"), "edges")
    both = once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = staged(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("label")), "labels")
    while True:
        seen = label.select(F.col("v").alias("b"), F.col("label").alias("near"))
        near = both.join(seen, "b").groupBy(F.col("a").alias("v")).agg(F.min("near").alias("near"))
        hooked = label.join(near, "v", "left").select("v", F.least("label", "near").alias("new"), F.col("label").alias("old"))
        jump = label.select(F.col("v").alias("new"), F.col("label").alias("far"))
        moved = staged(hooked.join(jump, "new", "left").select("v", "old", F.least("new", "far").alias("label")), "labels")
        changed = not moved.where("label <> old").isEmpty()
        discard(label)
        label = moved
        if not changed:
            discard(once)
            return label


def _leaves(classes: DataFrame, runs: int, threshold: float) -> DataFrame:
    """rep, node, members, tokens: the nodes of all runs that are to be joined by brute force, with more than one member; staged."""
    rows = staged(_split(classes.select("rep", "n", "sig"), runs, threshold), "nodes")
    done = []
    for depth in range(1, DEPTH + 1):
        # Written by itself, so that nothing but the join meets a node's rows, and Spark can deal out a large one.
        counts = staged(rows.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens")).where("members > 1"), "members")
        full = staged(rows.join(counts, "node").select("rep", "n", "node", "members", "tokens"), "leaves")
        discard(rows, counts)
        large = full.where(F.col("members") > SMALL)
        last = depth == DEPTH or large.isEmpty()
        done.append((full, full if last else full.where(F.col("members") <= SMALL)))
        if last:
            break
        rows = staged(_split(large.select("rep", "node").join(classes.select("rep", "n", "sig"), "rep"), runs, threshold), "nodes")
    leaves = done[0][1]
    for _, part in done[1:]:
        leaves = leaves.unionByName(part)
    out = staged(leaves.select("rep", "node", "members", "tokens"), "leaves")
    discard(*(full for full, _ in done))
    return out


def _links(docs: DataFrame, classes: DataFrame, leaves: DataFrame, threshold: float, size: int) -> DataFrame:
    """rep, links (documents linked with it, counted once a block), root (a connected representative); staged."""
    held = leaves.groupBy("rep").agg(F.collect_list(F.struct("node", "members", "tokens")).alias("l")).join(classes.select("rep", "n", "sig"), "rep")
    parts = F.greatest(F.ceil(F.col("x.members") / BLOCK), F.ceil(8 * F.col("x.tokens") / BLOCK_BYTES)).cast("int")
    parts = F.least(parts, F.col("x.members").cast("int"))
    mine = F.pmod(F.xxhash64("rep", "x.node"), parts).cast("int")
    blocks = (
        held.select("rep", "sig", "n", F.array_distinct(F.col("l.node")).alias("paths"), F.explode(F.array_distinct("l")).alias("x"))
        .select("*", mine.alias("side"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
        .select(F.col("x.node").alias("node"), F.least("side", "other").alias("b1"), F.greatest("side", "other").alias("b2"), "side", "rep", "sig", "n", "paths")
    )
    place = ["node", "b1", "b2"]
    flagged = _sketch(blocks.repartition(*place).sortWithinPartitions(*place), threshold)
    by_rep = flagged.groupBy("rep").agg(F.collect_list(F.struct("node", "b1", "b2", "side")).alias("places"), F.first("paths").alias("paths"))
    by_rep = staged(by_rep.join(classes.drop("n", "sig"), "rep"), "flagged")
    mine = by_rep.withColumnsRenamed({"doc_id": "__id", "h1": "__h1", "h2": "__h2"})
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))
    texts = docs.select("doc_id", *text_names(), "text").join(mine, same).select("rep", "weight", "k1", "k2", "places", "paths", "text")
    sets = _shingled(texts, size)
    out = staged(_verify(sets.repartition(*place).sortWithinPartitions(*place), threshold), "checked")
    discard(by_rep)
    return out


def _grouped(docs: DataFrame, threshold: float, size: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """(one row per document: doc_id, h1, h2, n, k1, k2; one row per set: k1, k2, group, class_id, n_links), both staged."""
    runs = runs_needed(threshold, recall)
    signed = staged(_sign(docs, size), "signed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h1", "h2")).alias("m")
    sets = signed.where("n > 0").groupBy("k1", "k2").agg(least, F.count(F.lit(1)).alias("weight"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    # A set's number is written with it, so that it is the same wherever it is read.
    classes = staged(sets.select(F.monotonically_increasing_id().alias("rep"), "k1", "k2", "m.doc_id", "m.h1", "m.h2", "weight", "n", "sig"), "classes")
    leaves = _leaves(classes, runs, threshold)
    checked = _links(docs, classes, leaves, threshold, size)
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(checked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    joined = classes.select("rep", "k1", "k2", "doc_id", "weight").join(links, "rep", "left").join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left")
    joined = joined.withColumn("group", F.coalesce("label", "rep"))
    least_ids = joined.groupBy("group").agg(F.min("doc_id").alias("class_id"))
    named = joined.join(least_ids, "group").select("k1", "k2", "group", "class_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = staged(named, "groups")
    discard(classes, leaves, checked, labels)
    return signed, named


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its group), n_links (other documents at the threshold or more)."""
    signed, named = _grouped(docs, threshold, size, recall)
    has = F.col("n") > 0
    return signed.drop("sig").join(named, ["k1", "k2"], "left").select(
        "doc_id",
        F.when(has, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(has, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """One row of each group: of the least doc_id (null last), then of the least text hash. All columns as they are.

    Rows whose text has no word are not alike: each text of a doc_id stays once.
    """
    signed, named = _grouped(docs, threshold, size, recall)
    rows = signed.select("doc_id", "h1", "h2", "n", "k1", "k2").groupBy("doc_id", "h1", "h2", "n", "k1", "k2").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.join(named, ["k1", "k2"], "left")
    key = [F.col("doc_id").isNull().alias("last"), "doc_id", "h1", "h2", "copies"]
    firsts = rows.where("n > 0").groupBy("group").agg(F.min(F.struct(*key)).alias("m")).select("m.doc_id", "m.h1", "m.h2", "m.copies")
    firsts = firsts.unionByName(rows.where("n = 0").select("doc_id", "h1", "h2", "copies"))
    first = staged(firsts.select(F.col("doc_id").alias("__id"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), "copies"), "firsts")
    discard(signed, named)
    h1, h2 = text_names()
    keyed = docs.withColumns({"__t1": h1, "__t2": h2})
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t1") == F.col("__h1")) & (F.col("__t2") == F.col("__h2"))
    # Only texts of repeated rows are dealt out again, one of each key a task.
    alone = keyed.join(first.where("copies = 1"), same, "left_semi")
    repeated = keyed.join(first.where("copies > 1"), same, "left_semi").dropDuplicates(["doc_id", "__t1", "__t2"])
    return alone.unionByName(repeated).select(*docs.columns)
