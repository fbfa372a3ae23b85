"""Monitoring: profiles on quantile edges, PSI and KS on their bins, score statistics, backtests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.eda import long_form, quantile_edges
from tidemark.operators.ranks import percentiles
from tidemark.operators.windows import robust_anomaly
from tidemark.sources.tables import staged

EPS = 1e-8


def profile_edges(v: DataFrame, bins: int = 10) -> DataFrame:
    """feature, edges; fewer than three distinct quantiles give one bin around the values."""
    edges = quantile_edges(v, ["feature"], bins)
    near = F.array(F.array_min("edges") - 1e-6, F.array_max("edges") + 1e-6)
    return edges.select("feature", F.when(F.size("edges") >= 3, F.col("edges")).otherwise(near).alias("edges"))


def counts_on_edges(v: DataFrame, edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by..., feature, bin (from 1), n: histogram on the edges, closed on the left, the last bin on both sides; outside values are left out; every bin has a row."""
    x = F.col("value")
    inside = (x >= F.get("edges", F.lit(0))) & (x <= F.element_at("edges", -1))
    bin_ = F.when(inside, F.least(F.size(F.filter("edges", lambda e: e <= x)), F.size("edges") - 1))
    # One row of edges per feature: small by its nature. A group's counts are as many as its bins, and one row from here on.
    cells = v.join(F.broadcast(edges), "feature").groupBy(*by, "feature", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    packed = cells.groupBy(*by, "feature").agg(F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).alias("__n"))
    bins = packed.join(F.broadcast(edges.select("feature", F.size("edges").alias("__k"))), "feature")
    each = bins.select(*by, "feature", "__n", F.explode(F.sequence(F.lit(1), F.col("__k") - 1)).alias("bin"))
    return each.select(*by, "feature", "bin", F.coalesce(F.try_element_at("__n", F.col("bin")), F.lit(0)).cast("long").alias("n"))


def _probability(n: str, by: Sequence[str]) -> Column:
    total = F.sum(n).over(Window.partitionBy(*by))
    return F.when(total > 0, F.greatest(F.least(F.col(n) / total, F.lit(1.0)), F.lit(EPS))).otherwise(F.lit(0.0))


def psi_ks(train: DataFrame, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by..., feature, psi, ks, severity. ``train``: feature, bin, n; ``current``: the same with ``by``.

    Probabilities are clipped after normalising and not normalised again.
    """
    both = current.join(train.select("feature", "bin", F.col("n").alias("n_train")), ["feature", "bin"])
    keys = [*by, "feature"]
    p = both.withColumns({"c": _probability("n", keys), "t": _probability("n_train", keys)})
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumns({"__psi": (F.col("c") - F.col("t")) * F.log(F.col("c") / F.col("t")), "__ks": F.abs(F.sum("t").over(upto) - F.sum("c").over(upto))})
    return p.groupBy(*keys).agg(F.sum("__psi").alias("psi"), F.max("__ks").alias("ks")).withColumn("severity", severity(F.col("psi")))


def severity(psi: Column) -> Column:
    """A missing figure (the feature is gone) is an alert."""
    return F.when(psi.isNull() | (psi > 0.2), "ALERT").when(psi > 0.1, "WARN").otherwise("OK")


def monthly_drift(df: DataFrame, columns: Sequence[str], month: str, bins: int = 10) -> DataFrame:
    """month, feature, psi, ks, severity of every later month against the earliest one."""
    v = long_form(df, columns, [month])
    first = F.lit(df.agg(F.min(month)).first()[0])
    edges = staged(profile_edges(v.where(F.col(month) == first).select("feature", "value"), bins), "edges")  # a row per feature
    counts = staged(counts_on_edges(v, edges, [month]), "counts")  # months x features x bins
    return psi_ks(counts.where(F.col(month) == first).drop(month), counts.where(F.col(month) > first), [month])


def category_profile(df: DataFrame, columns: Sequence[str], top: int = 30) -> DataFrame:
    """feature, value, n of the ``top`` most frequent values per column."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])).alias("c")).select("c.*")
    by = cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("feature").orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    return by.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= top).drop("__r")


def feature_drift(current: DataFrame, reference: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """feature, psi, ks, severity, is_anomaly of current rows against reference rows; a column that is gone is an alert."""
    ref = long_form(reference, columns)
    edges = staged(profile_edges(ref, bins), "edges")
    have = [c for c in columns if c in current.columns]
    found = psi_ks(counts_on_edges(ref, edges), counts_on_edges(long_form(current, have), edges))
    out = edges.select("feature").join(found, "feature", "left").withColumn("severity", severity(F.col("psi")))
    return out.withColumn("is_anomaly", F.col("severity") == "ALERT")


def score_stats(scored: DataFrame, by: Sequence[str] = (), p: str = "p", flag: str = "churn_flag") -> DataFrame:
    out = scored.groupBy(*by).agg(F.avg(p).alias("mean"), F.coalesce(F.sum(flag), F.lit(0)).cast("long").alias("risk_count"), F.count(F.lit(1)).alias("active_count"))
    q = percentiles(scored, p, [0.5, 0.9, 0.99], by, "__q")
    out = out.join(q, list(by), "left") if by else out.join(F.broadcast(q), F.lit(True), "left")  # one row a group
    ratio = F.coalesce(F.try_divide(F.col("risk_count").cast("double"), F.col("active_count").cast("double")), F.lit(0.0))
    return out.select(*by, "mean", *[F.get("__q", F.lit(i)).alias(n) for i, n in enumerate(("p50", "p90", "p99"))], "risk_count", "active_count", ratio.alias("risk_ratio"))


def score_drift(stats: DataFrame, order: str) -> DataFrame:
    """Score statistics per run with is_anomaly and a reason, by the runs before."""
    out = robust_anomaly(stats, "risk_ratio", order)
    text = F.format_string("risk_ratio %.4f > median+3*MAD (%.4f) over last %d", F.col("risk_ratio"), F.col("threshold"), F.col("n_history"))
    return out.withColumn("anomaly_reason", F.when(F.col("is_anomaly"), text)).drop("threshold", "n_history")


def backtest(listed: DataFrame, truth: DataFrame, active: DataFrame) -> DataFrame:
    """One row: list_size, churned_in_list, churned_total, precision, recall, f1. ``truth``: cust_id, churned."""
    t = truth.select("cust_id", F.col("churned").cast("long").alias("y"))
    a = active.select("cust_id").join(t, "cust_id", "left").join(listed.select("cust_id", F.lit(1).alias("l")), "cust_id", "full")
    hit = (F.col("l") == 1) & (F.coalesce("y", F.lit(0)) == 1)
    out = a.agg(F.count("l").alias("list_size"), F.count_if(hit).alias("churned_in_list"), F.count_if(F.coalesce("y", F.lit(0)) == 1).alias("churned_total"))
    ratio = lambda x, y: F.try_divide(F.col(x).cast("double"), F.col(y).cast("double"))
    out = out.withColumns({"precision": ratio("churned_in_list", "list_size"), "recall": ratio("churned_in_list", "churned_total")})
    return out.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).where("list_size > 0")
