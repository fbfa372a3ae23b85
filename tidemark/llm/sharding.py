"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a pseudo-random score ``weight / -ln(u)``; a record goes to its highest-scoring shard.
The choice depends on the key and the shard list alone, so a shard that is added takes records only into itself, and
shards receive records in proportion to their weights.

Slots number the records of a shard from 0 without gaps. They come from two levels: a row number inside each
(shard, block) and the running total of block sizes, so no task holds a whole shard.

Defined results: a null key is a key of its own (all its rows go to one shard); a null text has size 16 and crc 0;
repeated rows each get a slot of their own; an empty table gives an empty result; other columns pass through
``assign_shards`` untouched, and its own columns are named by parameters so that they cannot clash; ``keep`` refuses columns
called like results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import staged

#: Blocks of a shard that are numbered apart from each other; n_shards * BLOCKS rows of offsets are broadcast.
BLOCKS = 256


def shard_score(key: Column, shard: Column, weight: Column, seed: int = 0) -> Column:
    """Score of a shard for a key: the highest one wins."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, shard.cast("int")), 11)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return weight / -F.log(u)


def best_shard(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """Struct (score, shard) of the winning shard among ``len(weights)``; a weight of 0 is never chosen."""
    live = [(i, float(w)) for i, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("no shard has a positive weight")
    shards = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in live])
    return F.array_max(
        F.transform(shards, lambda s: F.struct(shard_score(key, s["i"], s["w"], seed).alias("score"), s["i"].alias("shard")))
    )


def assign_shards(
    df: DataFrame,
    key: Column,
    weights: Sequence[float],
    shard_col: str = "shard",
    grown_col: str | None = None,
    grown_weight: float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """Add ``shard_col``; with ``grown_col`` also the shard if one more of ``grown_weight`` were added."""
    stable = key.cast("string")
    out = df.withColumn("__best", best_shard(stable, weights, seed)).withColumn(shard_col, F.col("__best.shard"))
    if grown_col:
        n = len(weights)
        score = shard_score(stable, F.lit(n), F.lit(float(grown_weight)), seed)
        out = out.withColumn(grown_col, F.when(score >= F.col("__best.score"), F.lit(n)).otherwise(F.col("__best.shard")))
    return out.drop("__best")


def number_slots(df: DataFrame, shard: str, order: Sequence[str], slot_col: str = "slot", blocks: int = BLOCKS) -> DataFrame:
    """Add a gapless number from 0 inside each shard. Rows that tie in ``order`` are numbered in any order.

    ``df`` should be a stored table of light columns: it is read twice and both reads must agree.
    """
    parts = df.withColumn("__block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    sizes = parts.groupBy(shard, "__block").agg(F.count(F.lit(1)).alias("__n"))
    running = Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(shard, "__block", F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(shard, "__block").orderBy(*order)
    return (
        parts.withColumn("__row", F.row_number().over(inside))
        .join(F.broadcast(before), [shard, "__block"])  # at most n_shards * blocks rows
        .withColumn(slot_col, (F.col("__before") + F.col("__row") - 1).cast("long"))
        .drop("__block", "__row", "__before")
    )


def shard_documents(docs: DataFrame, n_shards: int = 40, weights: Sequence[float] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ('key'), shard, slot, grown_shard, and the columns in ``keep``."""
    if weights is not None and len(weights) != n_shards:
        raise ValueError("one weight per shard")
    if clash := {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"} & set(keep):
        raise ValueError(f"columns called like results: {sorted(clash)}")
    light = docs.select(
        "doc_id",
        *keep,
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
    )
    placed = staged(assign_shards(light, F.col("doc_id"), weights or [1.0] * n_shards, "shard", "grown_shard"), "shards")
    numbered = number_slots(placed, "shard", ["doc_id", "size", "text_crc32"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", *keep)
