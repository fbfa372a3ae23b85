"""Feature profiling: every statistic of all features comes from one grouped pass over unpivoted values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import finite
from tidemark.functions.special import t_pvalue
from tidemark.operators.ranks import percentiles, running_totals
from tidemark.sources.sinks import audit_append
from tidemark.sources.tables import staged

PERCENTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """feature, value (finite double or null) and ``keep``: one row per cell."""
    if not columns:
        return df.select(*keep, F.lit("").alias("feature"), F.lit(0.0).alias("value")).limit(0)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), finite(F.col(c)).alias("value")) for c in columns]))
    return df.select(*keep, cells.alias("__c")).select(*keep, "__c.feature", "__c.value")


def describe_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, bias-corrected skew and kurtosis, min, max and percentiles per feature, of finite values."""
    v = long_form(df, columns)
    n = F.col("count").cast("double")
    out = v.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.skewness("value").alias("__g1"), F.kurtosis("value").alias("__g2"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    out = out.join(percentiles(v, "value", PERCENTILES, ["feature"], "__p"), "feature", "left")  # one row per feature
    skew = F.when(n > 2, F.col("__g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("__g2") + 6))
    flat = F.coalesce(F.col("std") == 0, F.lit(False))
    return out.select(
        "feature", "count", "mean", "std", F.when(flat, 0.0).otherwise(skew).alias("skewness"), F.when(flat, 0.0).otherwise(kurt).alias("kurtosis"), "min", "max",
        *[F.get("__p", F.lit(i)).alias("median" if p == 0.5 else f"p{int(p * 100):02d}") for i, p in enumerate(PERCENTILES)],
    )


def missing_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, total, missing, missing_pct, has_inf in one wide pass."""
    rows = []
    for c in columns:
        d = F.col(c).try_cast("double")
        gone = F.count_if(d.isNull() | F.isnan(d))
        rows.append(F.struct(F.lit(c).alias("feature"), F.count(F.lit(1)).alias("total"), gone.alias("missing"), (F.count_if(F.abs(d) == float("inf")) > 0).alias("has_inf")))
    out = df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    return out.withColumn("missing_pct", F.round(F.coalesce(F.try_divide(F.col("missing").cast("double"), F.col("total").cast("double")), F.lit(0.0)), 6))


def missing_patterns(df: DataFrame, columns: Sequence[str], top: int | None = 10) -> DataFrame:
    """pattern_id, columns, n, pct of the sets of columns that are null together; the ``top`` most frequent."""
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in sorted(columns)])
    total = F.sum("n").over(Window.partitionBy())
    out = df.groupBy(names.alias("columns")).agg(F.count(F.lit(1)).alias("n")).withColumn("pct", F.round(F.col("n") / total, 6)).where("columns <> ''")
    out = out.select(F.substring(F.md5("columns"), 1, 12).alias("pattern_id"), "columns", "n", "pct")
    return out if top is None else out.orderBy(F.col("n").desc(), "columns").limit(top)


def outlier_stats(df: DataFrame, columns: Sequence[str], factor: float = 1.5, z: float = 3.0) -> DataFrame:
    """IQR fences and z-score counts per feature; no values: null bounds and 0 counts."""
    v = long_form(df, columns)
    q = v.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"), F.count("value").alias("n"))
    q = q.join(percentiles(v, "value", [0.25, 0.75], ["feature"], "__q"), "feature", "left").withColumns({"q1": F.get("__q", F.lit(0)), "q3": F.get("__q", F.lit(1))})
    q = q.withColumns({"lower": F.col("q1") - factor * (F.col("q3") - F.col("q1")), "upper": F.col("q3") + factor * (F.col("q3") - F.col("q1"))})
    out = v.join(F.broadcast(q), "feature")  # one row per feature
    x = F.col("value")
    return out.groupBy("feature").agg(
        F.first("lower").alias("lower"), F.first("upper").alias("upper"), F.count_if((x < F.col("lower")) | (x > F.col("upper"))).alias("iqr_outliers"),
        F.count_if((F.col("s") > 0) & (F.abs((x - F.col("m")) / F.nullif(F.col("s"), F.lit(0.0))) > z)).alias("z_outliers"), F.first("n").alias("n"),
    )


def mean_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` only, every known value replaced by its rank in its column (ties: mean rank). Rows come in any order.

    All columns are ranked together as (feature, value) and turned back into rows once, so there are as many shuffles for
    many features as for one. Ranks come from distinct values with their counts, in ranges of values; a frequent value is
    one row of the ranks, and the join with them can be split. Rows are named when they are written.
    """
    own = staged(df.select(*[F.col(c).try_cast("double").alias(c) for c in columns], F.monotonically_increasing_id().alias("__row")), "ranked")
    cells = long_form(own, columns, ["__row"]).where("value IS NOT NULL")
    counts = cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("__n"))
    ranks = running_totals(counts, "value", ["__n"], ["feature"]).select("feature", "value", (F.col("__n_upto") - (F.col("__n") - 1) / 2).alias("__r"))
    ranked = cells.join(ranks, ["feature", "value"])
    return ranked.groupBy("__row").agg(*[F.max(F.when(F.col("feature") == c, F.col("__r"))).alias(c) for c in columns]).drop("__row")


def correlation_pairs(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """feature_a < feature_b, r over rows where both are known; one aggregation. ``spearman`` ranks first (ties: mean rank)."""
    names = sorted(columns)
    if method == "spearman":
        df = mean_ranks(df, names)
    value = lambda c: finite(F.col(c))
    pairs = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), _corr(value(a), value(b)).alias("r")) for i, a in enumerate(names) for b in names[i + 1 :]]
    return df.agg(F.array(*pairs).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def _corr(a: Column, b: Column) -> Column:
    both = a.isNotNull() & b.isNotNull()
    r = F.corr(F.when(both, a), F.when(both, b))
    return F.when(~F.isnan(r), r)


def high_correlations(pairs: DataFrame, threshold: float = 0.8) -> DataFrame:
    return pairs.where(F.abs("r") >= threshold)


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    pos = F.sum(F.col(target)).cast("long")
    out = df.agg(F.count(target).alias("total"), F.coalesce(pos, F.lit(0)).alias("positive"))
    neg = F.col("total") - F.col("positive")
    rate = F.round(F.coalesce(F.try_divide(F.col("positive").cast("double"), F.col("total").cast("double")), F.lit(0.0)), 6)
    return out.select("total", "positive", neg.alias("negative"), rate.alias("rate"), F.coalesce(F.try_divide(neg.cast("double"), F.col("positive").cast("double")), F.lit(float("inf"))).alias("imbalance"))


def point_biserial(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """feature, n, r, p_value of the correlation with a 0/1 target; under 3 rows all null."""
    v = long_form(df, columns, [target]).where(F.col("value").isNotNull() & F.col(target).isNotNull())
    out = v.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.corr("value", F.col(target).cast("double")).alias("r"))
    r = F.when((F.col("n") >= 3) & ~F.isnan("r"), F.col("r"))
    t = F.col("r") * F.sqrt((F.col("n") - 2) / F.greatest(1 - F.col("r") * F.col("r"), F.lit(1e-300)))
    return out.withColumn("r", r).withColumn("p_value", t_pvalue(t, F.col("n") - 2))


def quantile_edges(v: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """by..., edges: distinct quantiles of ``value`` at 0, 1/bins, ..., 1."""
    found = percentiles(v, "value", [i / bins for i in range(bins + 1)], list(by), "edges")
    return found.withColumn("edges", F.array_distinct("edges"))


def woe_iv(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10, smooth: float = 0.5) -> DataFrame:
    """feature, bin, event, non_event, woe, iv_bin: quantile bins closed on the right (the first on both sides), no bins if one class is empty."""
    v = long_form(df, columns, [target]).where(F.col("value").isNotNull() & F.col(target).isNotNull())
    edges = quantile_edges(v, ["feature"], bins)
    binned = v.join(F.broadcast(edges), "feature").withColumn("bin", F.greatest(F.size(F.filter("edges", lambda e: e < F.col("value"))), F.lit(1)))
    by = binned.groupBy("feature", "bin").agg(F.sum(target).cast("double").alias("event"), F.count(F.lit(1)).cast("double").alias("total")).withColumn("non_event", F.col("total") - F.col("event"))
    w = Window.partitionBy("feature")
    k = F.count(F.lit(1)).over(w)
    e, n = F.sum("event").over(w), F.sum("non_event").over(w)
    out = by.withColumns({"__e": (F.col("event") + smooth) / (e + smooth * k), "__n": (F.col("non_event") + smooth) / (n + smooth * k), "__ok": (e > 0) & (n > 0)}).where("__ok")
    woe = F.log(F.col("__n") / F.col("__e"))
    return out.select("feature", "bin", F.col("event").cast("long").alias("event"), F.col("non_event").cast("long").alias("non_event"), woe.alias("woe"), ((F.col("__n") - F.col("__e")) * woe).alias("iv_bin"))


def iv_strength(iv: Column) -> Column:
    return F.when(iv < 0.02, "useless").when(iv < 0.10, "weak").when(iv < 0.30, "medium").when(iv < 0.50, "strong").otherwise("suspicious")


def iv_ranking(woe: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, iv (6 places), strength; features without bins have 0."""
    names = woe.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("feature"))
    total = woe.groupBy("feature").agg(F.round(F.sum("iv_bin"), 6).alias("iv"))
    return names.join(total, "feature", "left").na.fill({"iv": 0.0}).withColumn("strength", iv_strength(F.col("iv")))


def feature_trends(df: DataFrame, columns: Sequence[str], month: str, p_max: float = 0.05) -> DataFrame:
    """feature, n_months, slope, r2, p_value, trending: line through the monthly medians on month number; under 3 months null."""
    med = percentiles(long_form(df, columns, [month]), "value", [0.5], ["feature", month], "__m").withColumn("med", F.get("__m", F.lit(0)))
    x = (F.dense_rank().over(Window.partitionBy("feature").orderBy(month)) - 1).cast("double")
    fit = med.withColumn("x", x).groupBy("feature").agg(F.count(F.lit(1)).alias("n_months"), F.regr_slope("med", "x").alias("slope"), F.regr_r2("med", "x").alias("r2"))
    ok = F.col("n_months") >= 3
    out = fit.select("feature", "n_months", F.when(ok, F.col("slope")).alias("slope"), F.when(ok, F.when(F.isnan("r2"), 0.0).otherwise(F.col("r2"))).alias("r2"))
    t = F.sqrt(F.col("r2") * (F.col("n_months") - 2) / F.greatest(1 - F.col("r2"), F.lit(1e-300)))
    out = out.withColumn("p_value", t_pvalue(t, F.col("n_months") - 2))
    return out.withColumn("trending", F.coalesce(F.col("p_value") < p_max, F.lit(False)))


def compare_to_baseline(current: DataFrame, baseline: DataFrame, stats: Sequence[str]) -> DataFrame:
    """feature, stat, current, baseline, delta, delta_pct (null where the baseline is 0) of two summary tables."""
    cells = lambda df, n: df.select("feature", F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias(n)) for s in stats])).alias("c")).select("feature", "c.*")
    both = cells(current, "current").join(cells(baseline, "baseline"), ["feature", "stat"])
    delta = F.col("current") - F.col("baseline")
    return both.select("feature", "stat", "current", "baseline", delta.alias("delta"), F.try_divide(delta, F.col("baseline")).alias("delta_pct"))


def eda_report(df: DataFrame, columns: Sequence[str], target: str | None = None, month: str | None = None) -> dict[str, DataFrame]:
    """All profile tables; those on the target and on months only if these are given."""
    out = {
        "descriptive": describe_features(df, columns), "missing": missing_stats(df, columns), "patterns": missing_patterns(df, columns),
        "outliers": outlier_stats(df, columns), "correlations": high_correlations(correlation_pairs(df, columns)),
    }
    if target:
        woe = woe_iv(df, columns, target)
        out |= {"classes": class_distribution(df, target), "point_biserial": point_biserial(df, columns, target), "woe": woe, "iv": iv_ranking(woe, columns)}
    if month:
        out["trends"] = feature_trends(df, columns, month)
    return out


def persist_report(report: dict[str, DataFrame], path: str, run_id: str) -> None:
    """Write each table of a report under ``path``, and a log row (run_id, table, n, at) for each that is there."""
    for name, df in report.items():
        place = f"{path}/tables/{name}/run={run_id}"
        df.write.mode("overwrite").parquet(place)
        n = df.sparkSession.read.schema(df.schema).parquet(place).agg(F.count(F.lit(1)).alias("n"))
        audit_append(n.select(F.lit(run_id).alias("run_id"), F.lit(name).alias("table"), "n", F.current_timestamp().alias("at")), f"{path}/log")


def eda_summary(report: dict[str, DataFrame]) -> DataFrame:
    """metric, value: counts over the report's summary tables."""
    count = lambda name, table, condition: report[table].agg(F.count_if(F.expr(condition)).cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")
    parts = [count("high_missing", "missing", "missing_pct > 0.1"), count("high_outliers", "outliers", "iqr_outliers > 0.05 * n"), count("high_corr_pairs", "correlations", "r IS NOT NULL")]
    if "iv" in report:
        parts += [count("useful_iv", "iv", "strength IN ('medium', 'strong')"), report["classes"].select(F.lit("churn_rate").alias("metric"), F.col("rate").alias("value"))]
    if "trends" in report:
        parts.append(count("trending", "trends", "trending"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
