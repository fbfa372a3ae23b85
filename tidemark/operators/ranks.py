"""Running totals, ranks and exact percentiles over whole tables.

Running totals: rows are counted by value first. The distinct values are dealt out in ranges and written; a range's totals
give the offset of the next one, and inside a range a window adds up, so no task holds more than a range. The offsets are a
row per group and range. Percentiles need no ranks but their own and come from brackets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import staged

#: Relative accuracy of the sketch that brackets percentiles: a bracket holds some 4 / ACCURACY of the rows, ties apart.
ACCURACY = 10_000


def _same(groups: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__of_{g}")) for g in groups], F.lit(True))


def running_totals(df: DataFrame, value: str, totals: Sequence[str], groups: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Adds ``<t>_upto`` for every column t of ``totals``: its sum over the group's rows up to and with this one by ``value``.

    ``df`` has one row per group and value.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranged = staged(df.repartitionByRange(*groups, order).withColumn("__range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(*groups, "__range").agg(*[F.sum(t).alias(f"__before_{t}") for t in totals])
    earlier = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    names = {"__range": "__of_range", **{g: f"__of_{g}" for g in groups}}
    offsets = sums.withColumns({f"__before_{t}": F.coalesce(F.sum(f"__before_{t}").over(earlier), F.lit(0)) for t in totals}).withColumnsRenamed(names)
    inside = Window.partitionBy(*groups, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumns({f"{t}_upto": F.sum(t).over(inside) for t in totals})
    out = out.join(offsets, _same(groups) & (F.col("__range") == F.col("__of_range")))
    return out.select(*df.columns, *[(F.col(f"{t}_upto") + F.col(f"__before_{t}")).alias(f"{t}_upto") for t in totals])


def percentiles(df: DataFrame, value: str, at: Sequence[float], groups: Sequence[str] = (), name: str = "percentiles", accuracy: int = ACCURACY) -> DataFrame:
    """groups..., ``name``: array of the exact percentiles of the known values, between ranks by linear interpolation.

    Groups without a value have no row; without groups there is one row always.

    Two passes over ``df``, nothing is written. A sketch, whose size is bounded by ``accuracy``, brackets every percentile;
    then each value inside a bracket is counted by itself, and those of each gap between brackets together. Running counts over
    these few rows give the exact ranks. The brackets are one row per group and go to all tasks, so groups must be few:
    features, months, runs. A rank that falls inside a gap would mean a sketch worse than promised; the job fails then.
    """
    slack = 2.0 / accuracy
    bounds = [min(max(p + d, 0.0), 1.0) for p in sorted(set(at)) for d in (-slack, slack)]
    known = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("__v"))
    sketch = known.groupBy(*groups).agg(F.percentile_approx("__v", bounds, accuracy).alias("__b"), F.count(F.lit(1)).alias("__size"))
    of = F.broadcast(sketch.withColumnsRenamed({g: f"__of_{g}" for g in groups}))
    # Texts of expressions, as there are several for each percentile. In a gap the number of bounds below the value names the gap.
    inside = F.expr(" OR ".join(f"__v BETWEEN __b[{i}] AND __b[{i + 1}]" for i in range(0, len(bounds), 2)))
    below = F.expr(" + ".join(f"if(__b[{i}] < __v, 1, 0)" for i in range(len(bounds))))
    cells = known.join(of, _same(groups)).select(*groups, "__size", "__v", F.when(inside, F.col("__v")).alias("__own"), F.when(~inside, below).alias("__gap"))
    held = cells.groupBy(*groups, "__own", "__gap").agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__least"), F.max("__v").alias("__most"), F.max("__size").alias("__size"))
    upto = F.sum("__n").over(Window.partitionBy(*groups).orderBy("__least").rowsBetween(Window.unboundedPreceding, 0))
    ranked = held.withColumn("__upto", upto).withColumn("__from", F.col("__upto") - F.col("__n"))
    last = "cast(__size - 1 AS DOUBLE)"
    lost = "cast(raise_error('a percentile lies outside its bracket') AS DOUBLE)"
    ends = []
    for i, p in enumerate(at):
        for side in ("floor", "ceil"):
            rank = f"{side}({last} * {float(p)!r}D)"
            own = f"CASE WHEN __least = __most OR {rank} = __from THEN __least WHEN {rank} = __upto - 1 THEN __most ELSE {lost} END"
            ends.append(F.expr(f"max(CASE WHEN __upto > {rank} AND __from <= {rank} THEN {own} END) AS __{side}_{i}"))
    found = ranked.groupBy(*groups).agg(F.max("__size").alias("__size"), *ends)
    values = []
    for i, p in enumerate(at):
        h = f"({last} * {float(p)!r}D)"
        values.append(f"CASE WHEN floor({h}) = ceil({h}) OR __floor_{i} = __ceil_{i} THEN __floor_{i} ELSE (ceil({h}) - {h}) * __floor_{i} + ({h} - floor({h})) * __ceil_{i} END")
    return found.select(*groups, F.expr(f"array({', '.join(values)})").alias(name))
