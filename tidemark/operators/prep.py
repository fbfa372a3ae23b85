"""Training-set preparation for learning from positive and unlabelled customers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.month_arrays import dealt_by_customer
from tidemark.operators.ranks import percentiles
from tidemark.sources.tables import discard, staged


def activity_recency(cust_month: DataFrame, t_obs: str) -> DataFrame:
    """cust_id, last_month, recency_days to the month of observation."""
    return (
        cust_month.where(F.col("report_month") <= F.lit(t_obs).cast("date"))
        .groupBy("cust_id")
        .agg(F.max("report_month").alias("last_month"))
        .withColumn("recency_days", F.datediff(F.lit(t_obs).cast("date"), "last_month"))
    )


def join_recency(working: DataFrame, recency: DataFrame, missing: int = 9999) -> DataFrame:
    return working.join(recency.select("cust_id", "recency_days"), "cust_id", "left").na.fill({"recency_days": missing})


def tier(recency: Column, active: int = 90, at_risk: int = 180) -> Column:
    return F.when(recency <= active, "active").when(recency <= at_risk, "at_risk").otherwise("churned")


def pu_weight(n_confirmed: Column, n_active: Column, none: float = 0.05, least: float = 0.01) -> Column:
    """Weight of unlabelled rows from the share of confirmed ones."""
    share = n_confirmed.cast("double") / F.greatest(n_active - n_confirmed, F.lit(1)).cast("double")
    return F.when(n_confirmed > 0, F.greatest(share, F.lit(least))).otherwise(F.lit(none))


def horizon_activity(cust_month: DataFrame, ends: DataFrame | None, horizon: int) -> DataFrame:
    """cust_id, window_end, items, fee in the ``horizon`` months after each end (None: after any). A month belongs to at most
    ``horizon`` ends, so the rows are generated; the join with the ends wanted is an equi-join."""
    back = F.sequence(F.add_months("report_month", -horizon), F.add_months("report_month", -1), F.expr("INTERVAL 1 MONTH"))
    rows = cust_month.select("cust_id", F.explode(back).alias("window_end"), "item_count", "total_fee")
    wanted = rows if ends is None else rows.join(ends.select("window_end").distinct(), "window_end", "left_semi")
    return wanted.groupBy("cust_id", "window_end").agg(F.sum("item_count").alias("items"), F.sum("total_fee").alias("fee"))


def build_label(features: DataFrame, cust_month: DataFrame, horizon: int) -> DataFrame:
    """Adds y_raw: 1 for customers without items and fee in the months after their window (absent counts as none)."""
    by = horizon_activity(dealt_by_customer(cust_month), None, horizon).where("items > 0 OR fee > 0")
    # Of a customer there is one row, with at most ``horizon`` ends a month; windows that are dealt out by customer stay where they are.
    seen = by.groupBy("cust_id").agg(F.collect_set("window_end").alias("__seen"))
    y = F.when(F.array_contains("__seen", F.col("window_end")), 0).otherwise(1)
    rest = [c for c in features.columns if c not in ("cust_id", "window_end")]
    return features.join(seen.hint("shuffle_hash"), "cust_id", "left").select("cust_id", "window_end", *rest, y.alias("y_raw"))


def training_windows(features: DataFrame, cust_month: DataFrame, size: int | None, first: str, last: str, horizon: int, min_orders: int = 1) -> DataFrame:
    """Labelled rows of one window size (None: all) whose end leaves room for the horizon before ``last``; rows that have a y_raw, that
    of the same horizon, keep it: no month after ``last`` takes part in it."""
    newest = F.add_months(F.lit(last).cast("date"), -(horizon + 1))
    oldest = F.add_months(F.lit(first).cast("date"), F.col("window_size") - 1)
    wanted = F.lit(True) if size is None else F.col("window_size") == size
    own = features.where(wanted & F.col("window_end").between(oldest, newest) & (F.col("item_sum") >= min_orders))
    return own if "y_raw" in features.columns else build_label(own, cust_month, horizon)


def confirmed_ids(raw: DataFrame, direct: DataFrame, keys: DataFrame) -> DataFrame:
    """cust_id: direct keys, raw keys, and raw keys resolved through ``keys`` (crm, cust_id); without blanks or repeats."""
    norm = lambda c: F.nullif(F.trim(c), F.lit(""))
    a = direct.select(norm(F.col("key")).alias("cust_id"))
    b = raw.select(norm(F.col("key")).alias("crm"))
    c = b.join(keys.select(norm(F.col("crm")).alias("crm"), "cust_id"), "crm").select("cust_id")
    return a.union(c).where("cust_id IS NOT NULL").distinct()


def mean_and_covariance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature_a, feature_b, mean_a, cov (sample): all pairs from one aggregation; the result is features squared. A pair and its
    mirror image are one covariance."""
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    cov = lambda i, j: F.covar_samp(cols[min(i, j)], cols[max(i, j)])
    aggs = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.avg(cols[i]).alias("mean_a"), cov(i, j).alias("cov")) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.agg(F.array(*aggs).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def fit_prototype(confirmed: DataFrame, columns: Sequence[str], ridge: float = 0.01, least: int = 10) -> dict | None:
    """Mean, inverse covariance (+ ridge) and median squared distance of confirmed rows; None under ``least`` rows.

    The rows are written once, as they are read several times. The sums are distributed; only features squared numbers are inverted
    on the driver.
    """
    own = staged(confirmed.select(*columns), "confirmed")
    try:
        if own.limit(least).count() < least:
            return None
        rows = mean_and_covariance(own, columns).collect()
        at = {c: i for i, c in enumerate(columns)}
        mu, cov = np.zeros(len(columns)), np.zeros((len(columns), len(columns)))
        for r in rows:
            mu[at[r["feature_a"]]] = r["mean_a"]
            cov[at[r["feature_a"]], at[r["feature_b"]]] = r["cov"]
        cov += ridge * np.eye(len(columns))
        try:
            inverse = np.linalg.inv(cov)
        except np.linalg.LinAlgError:
            inverse = np.linalg.pinv(cov)
        proto = {"features": list(columns), "mu": mu.tolist(), "inverse": inverse.tolist(), "sigma2": 1.0}
        middle = percentiles(own.select(distance2(proto).alias("d")), "d", [0.5]).first()["percentiles"][0]
        proto["sigma2"] = float(middle) if middle and middle > 0 else 1.0
        return proto
    finally:
        discard(own)


def distance2(proto: dict) -> Column:
    """Squared Mahalanobis distance of a row to the prototype, at least 0."""
    mu, inverse = np.array(proto["mu"]), np.array(proto["inverse"])

    @F.pandas_udf("double")
    def d2(*x: pd.Series) -> pd.Series:
        diff = np.column_stack(x) - mu
        return pd.Series(np.maximum(np.einsum("ij,ij->i", diff @ inverse, diff), 0.0))

    return d2(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in proto["features"]])


def distance2_sql(proto: dict) -> Column:
    """The same as one expression; for few features."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(m) for c, m in zip(proto["features"], proto["mu"])]
    total = F.lit(0.0)
    for a, row in zip(x, proto["inverse"]):
        for b, w in zip(x, row):
            total = total + a * b * F.lit(float(w))
    return F.greatest(total, F.lit(0.0))


def similarity(d2: Column, sigma2: float) -> Column:
    """exp(-d2 / (2 sigma2)) with the exponent kept in [-700, 0]."""
    return F.exp(F.greatest(F.least(-d2 / F.lit(2.0 * sigma2), F.lit(0.0)), F.lit(-700.0)))


def prototype_as_of(cache: DataFrame, runs: DataFrame, max_age: int = 3) -> DataFrame:
    """For each (run_month, horizon) the newest cached prototype of that horizon at most ``max_age`` months old; YYMM numbers.

    Each run looks at the few months it may use, so this is an equi-join, not a range join.
    """
    from tidemark.functions.scalars import add_months_yymm

    wanted = runs.select("run_month", "horizon", F.explode(F.sequence(F.lit(0), F.lit(max_age))).alias("age"))
    wanted = wanted.withColumn("proto_month", add_months_yymm(F.col("run_month"), -F.col("age")))
    have = cache.select(F.col("run_month").alias("proto_month"), "horizon", F.struct(*[c for c in cache.columns if c != "horizon"]).alias("proto"))
    found = wanted.join(have, ["proto_month", "horizon"])
    return found.groupBy("run_month", "horizon").agg(F.min_by("proto", "age").alias("proto"), F.min("age").alias("age"))


def prototype_or_fallback(cache: DataFrame, runs: DataFrame, max_age: int = 3) -> DataFrame:
    """Every run with the prototype it uses: proto, age, fallback (not its own), failed (none young enough)."""
    found = runs.join(prototype_as_of(cache, runs, max_age), ["run_month", "horizon"], "left")
    return found.withColumns({"fallback": F.coalesce(F.col("age") > 0, F.lit(True)), "failed": F.col("age").isNull()})


def require_prototypes(found: DataFrame) -> DataFrame:
    """The runs of ``prototype_or_fallback``; raises if one has no prototype."""
    bad = found.where("failed").select("run_month", "horizon").limit(5).collect()
    if bad:
        raise ValueError("no prototype for " + ", ".join(f"{r['run_month']} at horizon {r['horizon']}" for r in bad))
    return found


def label_source(sim: Column, sim_min: float = 0.8, recent: int = 30, ratio: float = 0.85) -> Column:
    """confirmed over reliable_neg over pseudo_churn over pu_unlabeled; needs is_confirmed, delta_ewma, item_avg, item_last, recency_days."""
    down = (F.col("item_avg") > 0) & (F.col("item_last") < F.col("item_avg") * ratio)
    pseudo = (sim > sim_min) & (F.col("delta_ewma") < 0) & down
    negative = (F.col("recency_days") <= recent) & (F.col("delta_ewma") >= 0)
    return F.when(F.col("is_confirmed"), "confirmed").when(negative, "reliable_neg").when(pseudo, "pseudo_churn").otherwise("pu_unlabeled")


def weights_and_smoothing(df: DataFrame, c: Column, eps_confirmed: float = 0.0, eps_other: float = 0.1) -> DataFrame:
    """Adds y_label, sample_weight, y_smooth by label_source."""
    s = F.col("label_source")
    y = F.when(s.isin("confirmed", "pseudo_churn"), 1.0).otherwise(0.0)
    w = F.when(s == "confirmed", 1.0).when(s == "pseudo_churn", 0.5).when(s == "reliable_neg", 0.8).otherwise(c)
    eps = F.when(s == "confirmed", eps_confirmed).otherwise(eps_other)
    return df.withColumns({"y_label": y, "sample_weight": w, "y_smooth": y * (1 - eps) + eps / 2})


def split_stratified(df: DataFrame, key: str, label: str = "y_label", share: float = 0.2, seed: str = "split") -> DataFrame:
    """Adds split: confirmed rows are ``eval``, and of the others a fixed share of each label by the hash of their key; the rest is ``train``.

    The share is by hash threshold: no sort, the same for any order of the input.
    """
    u = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"), F.col(label).cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    return df.withColumn("split", F.when(F.col("label_source") == "confirmed", "eval").when(u < share, "eval").otherwise("train"))


def merge_history(current: DataFrame, history: DataFrame) -> DataFrame:
    """Current rows and past windows (weight 1; label 1 if confirmed, else as observed); absent numbers are 0."""
    past = history.withColumns({"y_label": F.when(F.col("is_confirmed"), 1.0).otherwise(F.col("y_raw").cast("double")), "sample_weight": F.lit(1.0), "split": F.lit("train")})
    past = past.withColumn("y_smooth", F.col("y_label"))
    return zeros_for_absent(current.unionByName(past.drop("y_raw"), allowMissingColumns=True))


def zeros_for_absent(df: DataFrame) -> DataFrame:
    return df.na.fill(0, [c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint")])


def scale_on_train(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns minus the train rows' mean, over their population deviation (0 counts as 1); one summary row is broadcast."""
    own = lambda c: F.when(F.col("split") == "train", F.col(c).cast("double"))
    stats = df.agg(*[F.avg(own(c)).alias(f"__m_{c}") for c in columns], *[F.stddev_pop(own(c)).alias(f"__s_{c}") for c in columns])
    scaled = {c: (F.col(c) - F.col(f"__m_{c}")) / F.when(F.col(f"__s_{c}") > 0, F.col(f"__s_{c}")).otherwise(1.0) for c in columns}
    out = df.join(F.broadcast(stats), F.lit(True))  # one row
    return out.withColumns(scaled).select(*df.columns)


def sanity_checks(df: DataFrame, columns: Sequence[str], low: float = 0.03, high: float = 0.35, min_eval: int = 1, scaled: Sequence[str] = ()) -> DataFrame:
    """check, passed, critical: one aggregation over the final set.

    ``scaled`` columns must have mean 0 and deviation 1 (or 0) on the train rows, as a scaler fitted on them gives.
    """
    train = F.col("split") == "train"
    nulls = F.lit(0)
    for c in columns:
        nulls = nulls + F.count_if(train & F.col(c).isNull())
    rate = F.avg(F.when(train, F.col("y_label")))
    fitted = F.lit(True)
    for c in scaled:
        mean, dev = F.avg(F.when(train, F.col(c))), F.stddev_pop(F.when(train, F.col(c)))
        fitted = fitted & F.coalesce((F.abs(mean) < 1e-6) & ((dev < 1e-6) | (F.abs(dev - 1) < 1e-6)), F.lit(False))
    checks = [
        ("no_overlap", F.count_if(train & (F.col("label_source") == "confirmed")) == 0, True), ("train_rate", F.coalesce(rate.between(low, high), F.lit(False)), False),
        ("no_null_weight", F.count_if(train & F.col("sample_weight").isNull()) == 0, True), ("no_null_feature", nulls == 0, True),
        ("train_not_empty", F.count_if(train) > 0, True), ("eval_not_empty", F.count_if(~train) > 0, False),
        ("eval_size", F.count_if(~train) >= min_eval, False), ("scaler_fitted", fitted, True),
    ]
    packed = df.agg(F.array(*[F.struct(F.lit(n).alias("check"), ok.alias("passed"), F.lit(crit).alias("critical")) for n, ok, crit in checks]).alias("c"))
    return packed.select(F.explode("c").alias("c")).select("c.*")


def require(checks: DataFrame) -> bool:
    """Raise if a critical check failed; else whether all passed."""
    failed = [r for r in checks.where("NOT passed").collect()]
    bad = [r["check"] for r in failed if r["critical"]]
    if bad:
        raise ValueError("failed: " + ", ".join(sorted(bad)))
    return not failed


def max_window(n_months: int, horizon: int, min_train: int, w_min: int = 3) -> int:
    """Largest window size worth a search."""
    return max(w_min, n_months - horizon - min_train + 1)
