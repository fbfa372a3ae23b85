"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Inside a source the documents are taken in key order: whole epochs first, then
as far as the rest of the source's budget goes, the last document in part. The order is cut into ranges of the key
(its first three hex digits, uniform because the key is a hash), so the prefix sums are a window inside each
(source, range) plus the running total of range sums; a source that holds most rows is spread over 4096 ranges.

Targets: sources by code point, null last, have the weights in turn; the total is shared by weight, a target stops at
``max_epochs`` times its source's size, and the excess is reshared by weight until none is above. That fixed point is
a water level: sources in order of cap / weight are full up to some place, and the rest get level * weight.

Defined results: null or empty text has size 0 and takes 0; a null source is a source of its own; identical rows are
interchangeable and each is taken by the same rule; an empty table gives an empty result; other columns are ignored
by ``plan_mix`` except those named in ``keep``. The same input gives the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes``: source, source_size, one row per source. Adds ``target``.

    Its windows see one row per source (a summary), not documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    everything = Window.partitionBy()
    caps = (
        sizes.withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
        .withColumn("__cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("__want", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("__all_w", F.sum("__w").over(everything))
    )
    before = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("__want") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / (
        F.col("__all_w") - F.coalesce(F.sum("__w").over(before), F.lit(0.0))
    )
    filled = caps.withColumn("__level", level).withColumn("__full", F.col("__cap") <= F.col("__level") * F.col("__w"))
    water = F.max(F.when(~F.col("__full"), F.col("__level"))).over(everything)
    return filled.withColumn("target", F.when(F.col("__full"), F.col("__cap")).otherwise(water * F.col("__w"))).select(
        "source", "source_size", "target"
    )


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted), and ``keep``.

    ``keep`` refuses columns called like results. Rows that repeat doc_id and text are cut in any order among themselves.
    """
    if clash := {"doc_id", "source", "size", "source_size", "target", "taken"} & set(keep):
        raise ValueError(f"columns called like results: {sorted(clash)}")
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    light = staged(
        docs.select("doc_id", "source", *keep, count_words(F.col("text")).alias("size"), key.alias("__key")).withColumn(
            "__range", F.substring("__key", 1, 3)
        ),
        "mix",
    )
    targets = source_targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    ranges = light.groupBy("source", "__range").agg(F.sum("size").alias("__sum"))
    earlier = Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__offset", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    t = targets.withColumnRenamed("source", "__t_source")
    ranges = ranges.join(t, F.col("source").eqNullSafe(F.col("__t_source"))).drop("__t_source")
    r = ranges.withColumnsRenamed({"source": "__r_source", "__range": "__r_range"})
    rows = light.join(r, F.col("source").eqNullSafe(F.col("__r_source")) & (F.col("__range") == F.col("__r_range"))).drop("__r_source", "__r_range")
    inside = Window.partitionBy("source", "__range").orderBy("__key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor("target").cast("long") - F.col("__epochs") * F.col("source_size")
    return (
        rows.withColumn("__start", start)
        .withColumn("__epochs", epochs)
        .withColumn("__rest", rest)
        .withColumn(
            "taken",
            (F.col("__epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("__rest") - F.col("__start")))).cast("long"),
        )
        .select("doc_id", "source", "size", "source_size", "target", "taken", *keep)
    )
