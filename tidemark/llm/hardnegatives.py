"""Hard-negative mining over labelled vectors, with angular triangle filtering.

Vectors become integers (``floor(256 * x)``), and each row is stored with its norm and its angles to ``REFERENCES`` fixed
directions, dealt out in ranges of (label, nearest direction, angle to it). Neighbours in that order form *runs*; a run has an
interval for each angle and for the norm. By the triangle inequality for angles, the angle between an anchor and any row of
a run lies between the largest gap and the smallest sum of their angles to a direction; its cosines times the norms, widened
by more than any rounding, bound the integer scores from both sides. Only runs whose bounds overlap the window of scores that
an anchor still looks for get integer scoring: for positives, scores not below the anchor's fifth so far; for negatives,
those between 80 % and 100 % of a positive's score, not below the fifth so far.

Anchors (a stated query set) are held in blocks of ``ANCHOR_BYTES``; a block is broadcast and meets all rows in one pass for
the positives and one for the negatives. A task keeps the first five of each anchor or pair, so what is shuffled is at most
five rows a task and pair, whatever the groups are. The directions, and the scores that a block begins with, come from at most
``SAMPLE_ROWS`` rows; they decide how much is skipped, never what is found.

Defined results: rows with a null label or vector, or a null or non-finite component, take no part, nor do those with an
integer norm of 2^31 or more, whose scores need not fit a long; missing components of shorter vectors are 0; a null vec_id is
no anchor, comes last among ties and keeps its label; "other rows" are all but the anchor's own row, so repeated rows count
repeatedly, and an anchor's vec_id in several rows makes as many anchors; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import discard, staged

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: Directions that angles are stored to, and the rows that they are chosen from.
REFERENCES, SAMPLE_ROWS = 16, 2048
#: Rows of a run; bytes of the anchors held at once; anchors scored at once.
RUN_ROWS, ANCHOR_BYTES, LANE = 256, 48 << 20, 2048
#: Radians by which every angle is widened: stored angles are single floats, and arccos near 1 loses half the digits.
SLACK = 1e-5
#: Candidates held by a task before all but the first of each slot go.
HELD = 500_000
_NONE = np.iinfo(np.int64).max


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label (changed where vec_id is divisible by 7), embedding as doubles; rows that take no part are left out."""
    whole = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    typed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return typed.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(whole)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; short rows are filled with 0."""
    sizes = np.asarray(column.value_lengths())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def integers(x: np.ndarray) -> np.ndarray:
    """floor(256 * x); whole numbers held as doubles."""
    with np.errstate(over="ignore"):
        return np.floor(SCALE * x)


def angles(q: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angle of each row to each direction; a zero row counts as at a right angle."""
    with np.errstate(invalid="ignore", divide="ignore"):
        cos = np.where(norms[:, None] > 0, (q / norms[:, None]) @ directions.T, 0.0)
    return np.arccos(np.clip(cos, -1, 1))


def spread_directions(q: np.ndarray, k: int = REFERENCES) -> np.ndarray:
    """Up to ``k`` unit vectors among the rows, each the farthest in angle from those before it."""
    norms = np.linalg.norm(q, axis=1)
    unit = q[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.zeros((1, q.shape[1]))
    chosen = [0]
    near = unit @ unit[0]
    while len(chosen) < min(k, len(unit)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


def with_angles(rows: DataFrame, width: int, directions: np.ndarray) -> DataFrame:
    """vec_id, label, q, norm, angles, nearest (direction), own (angle to it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = integers(matrix(batch.column("embedding"), width))
            norms = np.linalg.norm(q, axis=1)
            fits = norms < 2.0**31
            q, norms = q[fits], norms[fits]
            theta = angles(q, norms, directions)
            nearest = theta.argmin(axis=1) if len(theta) else np.empty(0, np.int64)
            lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), kind))
            kept = batch.filter(pa.array(fits))
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column("vec_id"), kept.column("label"), lists(q, pa.float64()), pa.array(norms), lists(theta, pa.float32()),
                    pa.array(nearest, pa.int32()), pa.array(theta[np.arange(len(theta)), nearest], pa.float32()),
                ],
                ["vec_id", "label", "q", "norm", "angles", "nearest", "own"],
            )

    return rows.mapInArrow(run, "vec_id long, label long, q array<double>, norm double, angles array<float>, nearest int, own float")


@dataclass
class Rows:
    """Some rows as arrays. ``null`` marks a vec_id that is null."""

    rid: np.ndarray
    vec: np.ndarray
    null: np.ndarray
    label: np.ndarray
    q: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, width: int, k: int) -> Rows:
        column = lambda c: batch.column(c).combine_chunks() if isinstance(batch, pa.Table) else batch.column(c)
        vec = column("vec_id")
        plain = lambda c: column(c).to_numpy(zero_copy_only=False)
        null = vec.is_null().to_numpy(zero_copy_only=False)
        return cls(plain("rid"), vec.fill_null(0).to_numpy(zero_copy_only=False), null, plain("label"), matrix(column("q"), width), plain("norm"), matrix(column("angles"), k))


def score_bounds(anchors: Rows, lo: np.ndarray, hi: np.ndarray, least_norm: float, most_norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer score that each anchor can have with a row whose angles lie in [lo, hi] and norm in the two norms."""
    a = anchors.angles
    near = np.maximum(np.maximum(lo - a, a - hi).max(axis=1) - SLACK, 0)
    far = np.minimum(np.minimum(a + hi, 2 * np.pi - a - lo).min(axis=1) + SLACK, np.pi)
    most, least = np.cos(near), np.cos(np.maximum(far, near))
    above = anchors.norm * np.where(most >= 0, most_norm, least_norm) * most
    below = anchors.norm * np.where(least >= 0, least_norm, most_norm) * least
    pad = 1 + 1e-9 * anchors.norm * most_norm
    return np.floor(below - pad), np.ceil(above + pad)


def scores(q: np.ndarray, anchors: np.ndarray, most: float) -> np.ndarray:
    """Integer inner products; ``most``: a bound on their size. Doubles hold whole numbers up to 2^53 exactly."""
    if most < 2.0**53:
        return (q @ anchors.T).astype(np.int64)
    return q.astype(np.int64) @ anchors.T.astype(np.int64)


class First:
    """The first ``k`` candidates of each slot, by score downwards and vec_id upwards."""

    def __init__(self, least: np.ndarray, k: int):
        self.least, self.k, self.parts, self.n = least.copy(), k, [], 0

    def add(self, slot: np.ndarray, score: np.ndarray, rows: Rows, at: np.ndarray) -> None:
        if len(slot):
            self.parts.append((slot, score, rows.null[at], rows.vec[at], rows.rid[at]))
            self.n += len(slot)
        if self.n > HELD:
            self.cut()

    def cut(self) -> None:
        if not self.parts:
            return
        slot, score, null, vec, rid = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((rid, vec, null, -score, slot))
        s = slot[order]
        begins = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        rank = np.arange(len(s)) - np.repeat(begins, np.diff(np.append(begins, len(s))))
        last = order[rank == self.k - 1]
        self.least[slot[last]] = np.maximum(self.least[slot[last]], score[last])
        kept = order[rank < self.k]
        self.parts = [(slot[kept], score[kept], null[kept], vec[kept], rid[kept])]
        self.n = len(kept)


def runs_of(rows: Rows, nearest: np.ndarray) -> Iterator[slice]:
    """Runs of at most ``RUN_ROWS`` neighbours with one label and one nearest direction."""
    change = np.flatnonzero((np.diff(rows.label) != 0) | (np.diff(nearest) != 0)) + 1
    edges = np.concatenate([[0], change, [len(rows.label)]])
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        for at in range(lo, hi, RUN_ROWS):
            yield slice(at, min(at + RUN_ROWS, hi))


def search(rows: Rows, nearest: np.ndarray, anchors: Rows, first: First, same: bool, top: np.ndarray | None = None) -> int:
    """Hand the candidates among ``rows`` to ``first`` and return the number of pairs scored.

    With ``same`` a slot is an anchor, and rows of its label but its own are candidates. Without, a slot is an anchor and one of
    its positives, and rows of other labels that score at most ``top`` of the slot are.
    """
    slots = len(first.least) // max(len(anchors.rid), 1)
    scored = 0
    for run in runs_of(rows, nearest):
        least = first.least.reshape(-1, slots).min(axis=1)
        most = np.full(len(least), _NONE) if same else top.reshape(-1, slots).max(axis=1)
        theta, norm = rows.angles[run], rows.norm[run]
        below, above = score_bounds(anchors, theta.min(axis=0), theta.max(axis=0), norm.min(), norm.max())
        own = anchors.label == rows.label[run.start]
        chosen = np.flatnonzero((own if same else ~own) & (above >= least) & (below <= most))
        for k in range(0, len(chosen), LANE):
            lane = chosen[k : k + LANE]
            s = scores(rows.q[run], anchors.q[lane], norm.max() * anchors.norm[lane].max())
            scored += s.size
            at, which = np.nonzero((s >= least[lane]) & (s <= most[lane]))
            score, who, at = s[at, which], lane[which], at + run.start
            if same:
                other = rows.rid[at] != anchors.rid[who]
                first.add(who[other], score[other], rows, at[other])
                continue
            for j in range(slots):
                slot = who * slots + j
                fits = (score >= first.least[slot]) & (score <= top[slot])
                first.add(slot[fits], score[fits], rows, at[fits])
    first.cut()
    return scored


def _pass(table: DataFrame, block: Broadcast, width: int, k: int, same: bool) -> DataFrame:
    """slot, score, vec_id, rid: the first of each slot in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, least, top = block.value
        first = First(least, POSITIVES if same else NEGATIVES)
        for batch in batches:
            if batch.num_rows:
                search(Rows.of(batch, width, k), batch.column("nearest").to_numpy(), anchors, first, same, top)
        for slot, score, null, vec, rid in first.parts:
            yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(score, pa.int64()), pa.array(vec, pa.int64(), mask=null), pa.array(rid, pa.int64())], ["slot", "score", "vec_id", "rid"])

    found = table.mapInArrow(run, "slot long, score long, vec_id long, rid long")
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= (POSITIVES if same else NEGATIVES))


def sample_least(anchors: Rows, sample: Rows) -> np.ndarray:
    """A score that an anchor's fifth positive has at least: that of its fifth among the sampled rows of another vec_id."""
    out = np.full(len(anchors.rid), np.iinfo(np.int64).min)
    for label in np.unique(sample.label):
        mine, theirs = np.flatnonzero(anchors.label == label), np.flatnonzero((sample.label == label) & ~sample.null)
        for k in range(0, len(mine) if len(theirs) >= POSITIVES else 0, LANE):
            lane = mine[k : k + LANE]
            s = scores(anchors.q[lane], sample.q[theirs], anchors.norm[lane].max() * sample.norm[theirs].max())
            s = np.where(anchors.vec[lane][:, None] == sample.vec[theirs], np.iinfo(np.int64).min, s)
            out[lane] = np.partition(s, -POSITIVES, axis=1)[:, -POSITIVES]
    return out


def _sampled(rows: DataFrame, width: int) -> Rows:
    """Rows of least hash, at most ``SAMPLE_ROWS``; their angles are left out."""
    table = rows.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(SAMPLE_ROWS).toArrow()
    q = integers(matrix(table.column("embedding").combine_chunks(), width))
    norm = np.linalg.norm(q, axis=1)
    fits = norm < 2.0**31
    vec = table.column("vec_id").combine_chunks()
    plain = lambda x: x.to_numpy(zero_copy_only=False)[fits]
    n = int(fits.sum())
    return Rows(np.arange(n), plain(vec.fill_null(0)), plain(vec.is_null()), plain(table.column("label").combine_chunks()), q[fits], norm[fits], np.zeros((n, 1)))


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, every: int = 100, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors are rows whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    width = rows.agg(F.max(F.size("embedding"))).first()[0]
    if width is None:
        return spark.createDataFrame([], _RESULT)
    sample = _sampled(rows, width)
    directions = spread_directions(sample.q)
    k = len(directions)
    # A row's number is written with it, so that it is the same wherever it is read; it also deals out equal vectors.
    numbered = with_angles(rows, width, directions).withColumn("rid", F.monotonically_increasing_id())
    order = ["label", "nearest", "own", "rid"]
    table = staged(numbered.repartitionByRange(*order).sortWithinPartitions(*order), "angles")
    anchors = table.where(F.col("vec_id") % every == 0)
    per_block = max(1, anchor_bytes // (8 * (width + k) + 200))
    blocks = -(-anchors.count() // per_block)
    mined = []
    for i in range(blocks):
        held = Rows.of(anchors.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == i).toArrow(), width, k)
        if not len(held.rid):
            continue
        block = spark.sparkContext.broadcast((held, sample_least(held, sample), None))
        positives = _pass(table, block, width, k, True).toArrow()  # at most five an anchor of the block
        block.destroy()
        slot = positives.column("slot").to_numpy() * POSITIVES + positives.column("rank").to_numpy() - 1
        top = np.full(len(held.rid) * POSITIVES, np.iinfo(np.int64).min)
        least = np.full(len(top), _NONE)
        top[slot] = positives.column("score").to_numpy()
        least[slot] = -((-4 * top[slot]) // 5)
        block = spark.sparkContext.broadcast((held, least, top))
        ids = pa.table({"slot": slot, "anchor_id": held.vec[positives.column("slot").to_numpy()], "positive_id": positives.column("vec_id"), "positive_score": positives.column("score")})
        named = F.broadcast(spark.createDataFrame(ids))  # a row for each pair of the block
        found = _pass(table, block, width, k, False).join(named, "slot")
        mined.append(staged(found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "mined"))
        block.destroy()
    discard(table)
    if not mined:
        return spark.createDataFrame([], _RESULT)
    out = mined[0]
    for part in mined[1:]:
        out = out.unionByName(part)
    return out
