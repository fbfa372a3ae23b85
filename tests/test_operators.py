"""Hand-computed cases and invariants of the feature, preparation, model and monitoring operators."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import eda, features, ingest, model, monitor, month_arrays, pipeline, prep, reasons, windows
from tidemark.sources import readers, sinks, tables
from tidemark.sources.published import is_published, publish, published, vacuum
from tidemark.sources.readers import copy_drops
from tidemark.sources.tables import discard, shared_path, staged, tables_end
from tidemark.streaming import drops, feeds

D = datetime.date


def test_ewma(spark):
    rows = [("a", [10.0, 20.0], 0.3), ("b", [100.0, 200.0, 300.0], 0.5), ("c", [42.0], 0.5), ("d", [], 0.5), ("e", [None, 4.0], 0.5)]
    want = {"a": (13.0, 3.0), "b": (225.0, 75.0), "c": (42.0, 0.0), "d": (0.0, 0.0), "e": (2.0, 2.0)}
    for key, months, alpha in rows:
        r = spark.createDataFrame([(months,)], "x array<double>").select(features.ewma(F.col("x"), alpha).alias("e")).first().e
        assert (r.ewma, r.delta) == pytest.approx(want[key])


def months(spark, seed=1, customers=12):
    rng = random.Random(seed)
    rows = []
    for c in range(customers):
        for m in range(18):
            if rng.random() < 0.7:
                rows.append((c, D(2024 + m // 12, m % 12 + 1, 1), rng.randrange(1, 9), rng.randrange(1000), rng.randrange(3), 0, 0, 0.5, None if rng.random() < 0.2 else 0.9))
    df = spark.createDataFrame(rows, "cust_id long, report_month date, item_count long, total_fee long, total_complaint long, delay_count long, nodone long, order_score double, satisfaction_score double")
    extra = {c: F.lit(0) for c in ("weight_kg", "delay_day", "refunded", "noaccepted", "lost_order", "intra_province", "international", "lastday", *[f"ser_{s}" for s in features.SERVICES])}
    return df.withColumns(extra), rows


def test_windows_hold_the_months_of_their_range(spark):
    df, rows = months(spark)
    held = features.to_windows(features.agg_monthly(df), F.col("report_month"), "2024-01-01", "2025-06-01", [3, 6])
    got = {(r.cust_id, r.window_size, r.window_end): r.n for r in held.groupBy(*features.WINDOW_KEY).agg(F.sum("item_sum").alias("n")).collect()}
    index = lambda d: d.year * 12 + d.month
    want = {}
    for c, d, n, *_ in rows:
        for size in (3, 6):
            for e in range(index(d), index(d) + size):
                if e <= index(D(2025, 6, 1)) and e - size + 1 >= index(D(2024, 1, 1)):
                    key = (c, size, D((e - 1) // 12, (e - 1) % 12 + 1, 1))
                    want[key] = want.get(key, 0) + n
    assert got == want


def test_extremes_and_series(spark):
    df, _ = months(spark, 2)
    held = features.to_windows(features.agg_monthly(df.repartition(5)), F.col("report_month"), "2024-01-01", "2025-06-01", [3])
    wide = features.win_pivot_months(held, 3).orderBy(*features.WINDOW_KEY).collect()
    arrays = features.month_series_arrays(features.agg_monthly(df), "2024-01-01", "2025-06-01", [3]).orderBy(*features.WINDOW_KEY).collect()
    for w, a in zip(wide, arrays, strict=True):
        assert a.item_months == [w.item_2m_ago, w.item_1m_ago, w.item_last]
    ties = spark.createDataFrame([(1, D(2024, m, 1), 5, None) for m in (1, 2, 3)], "cust_id long, report_month date, item_sum long, revenue_sum long")
    ties = ties.withColumns({"complaint_sum": F.lit(None).cast("long"), "order_score_avg": F.lit(0.1), "satisfaction_avg": F.lit(None).cast("double"), "month_key": 2400 + F.month("report_month")})
    sums = {c: F.lit(0.0) for c in (*month_arrays.LONG_SUMS, *month_arrays.DOUBLE_SUMS) if c not in ties.columns}
    r = features.win_extreme_months(ties.withColumns(sums), "2024-01-01", "2024-03-01", [3]).first()
    assert r.item_max_month == r.item_min_month == 2403 and r.revenue_max_month is None and r.complaint_max_month == 2403


def test_windows_of_arrays_equal_aggregated_copies(spark):
    """Differences of running sums and slices against aggregations of the copied rows, nulls and large offsets included."""
    df, _ = months(spark)
    shifted = df.withColumns({"total_fee": F.col("total_fee") + 10**9, "item_count": F.when(F.col("item_count") > 2, F.col("item_count"))})
    monthly = features.agg_monthly(shifted)
    held = features.to_windows(monthly, F.col("report_month"), "2024-01-01", "2025-06-01", [1, 3, 12])
    x = F.unix_date("report_month").cast("double") * 86400
    wanted = {"month_count": F.count(F.lit(1)), "active_months": F.count_if(F.col("item_sum") > 0)}
    for m, c in (("item", "item_sum"), ("revenue", "revenue_sum"), ("complaint", "complaint_sum")):
        wanted |= {c: F.sum(c), f"{m}_avg": F.avg(c), f"{m}_std": F.stddev_pop(c), f"{m}_median": F.percentile(c, 0.5), f"{m}_max": F.max(c), f"{m}_min": F.min(c)}
    wanted |= {"satisfaction_avg": F.avg("satisfaction_avg"), "satisfaction_std": F.stddev_pop("satisfaction_avg"), "order_score_std": F.stddev_pop("order_score_avg"), "weight_sum": F.sum("weight_sum")}
    lines = {n: F.coalesce(F.regr_slope(F.col(c).cast("double"), x), F.lit(0.0)) for n, c in month_arrays.SLOPES.items()}
    key = list(features.WINDOW_KEY)
    want = held.groupBy(*key).agg(*[e.alias(n) for n, e in {**wanted, **lines}.items()])
    args = (monthly, "2024-01-01", "2025-06-01", [1, 3, 12])
    got = features.agg_window_base(*args).select(*key, *wanted).join(features.window_slopes(*args), key)
    a, b = (sorted((r.asDict() for r in t.collect()), key=lambda r: tuple(map(str, (r[k] for k in key)))) for t in (got, want))
    assert len(a) == len(b) > 100
    for g, w in zip(a, b):
        for n in w:
            assert g[n] == w[n] if not isinstance(w[n], float) else g[n] == pytest.approx(w[n], rel=1e-6, abs=1e-9), (n, g, w)
    one = features.agg_window_base(*args, [(3, D(2024, 5, 1))])
    assert {(r.window_size, r.window_end) for r in one.collect()} == {(3, D(2024, 5, 1))}


def test_label_sources_and_weights(spark):
    rows = [("a", True, 0.9, -1.0, 10.0, 1.0, 200), ("b", False, 0.9, -1.0, 10.0, 1.0, 200), ("c", False, 0.9, 1.0, 10.0, 1.0, 10), ("d", False, 0.1, -1.0, 10.0, 9.0, 200)]
    df = spark.createDataFrame(rows, "k string, is_confirmed boolean, sim double, delta_ewma double, item_avg double, item_last double, recency_days int")
    out = prep.weights_and_smoothing(df.withColumn("label_source", prep.label_source(F.col("sim"))), F.lit(0.07))
    got = {r.k: (r.label_source, r.y_label, r.sample_weight, round(r.y_smooth, 6)) for r in out.collect()}
    assert got == {"a": ("confirmed", 1, 1, 1), "b": ("pseudo_churn", 1, 0.5, 0.95), "c": ("reliable_neg", 0, 0.8, 0.05), "d": ("pu_unlabeled", 0, 0.07, 0.05)}
    split = prep.split_stratified(out, "k").collect()
    assert [r.split for r in split if r.k == "a"] == ["eval"]


def test_scaling_and_sanity(spark):
    rows = [("train", float(i), 1.0 if i % 5 == 0 else 0.0, 1.0, "x") for i in range(20)] + [("eval", 1e9, 1.0, 1.0, "confirmed")]
    df = spark.createDataFrame(rows, "split string, f double, y_label double, sample_weight double, label_source string")
    own = prep.scale_on_train(df, ["f"]).where("split = 'train'").agg(F.avg("f").alias("m"), F.stddev_pop("f").alias("s")).first()
    assert own.m == pytest.approx(0) and own.s == pytest.approx(1)
    assert prep.require(prep.sanity_checks(df, ["f"])) is True
    with pytest.raises(ValueError, match="no_null_feature"):
        prep.require(prep.sanity_checks(df.withColumn("f", F.lit(None).cast("double")), ["f"]))
    assert prep.require(prep.sanity_checks(df.withColumn("y_label", F.lit(0.0)), ["f"])) is False


def test_prototype(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.gauss(5, 2), rng.gauss(1, 1)) for _ in range(80)], "a double, b double")
    proto = prep.fit_prototype(df, ["a", "b"])
    out = df.select(prep.distance2(proto).alias("v"), prep.distance2_sql(proto).alias("e"), prep.similarity(prep.distance2(proto), proto["sigma2"]).alias("s")).collect()
    assert all(r.v >= 0 and r.v == pytest.approx(r.e) and 0 <= r.s <= 1 for r in out)
    assert prep.fit_prototype(df.limit(5), ["a", "b"]) is None


def test_thresholds(spark):
    def best(y, p):
        return model.fbeta_threshold(spark.createDataFrame(list(zip(y, p)), "y int, p double")).first().threshold

    assert best([0, 0, 0, 1, 1, 1], [0.1, 0.2, 0.3, 0.7, 0.8, 0.9]) == 0.7
    assert best([1, 1], [0.2, 0.6]) == 0.2 and 0 <= best([0, 0], [0.2, 0.6]) <= 1
    scored = spark.createDataFrame([(0, 0.1), (1, 0.4), (0, 0.35), (1, 0.8)], "y int, p double")
    r = model.evaluate(scored).first()
    assert r.roc_auc == pytest.approx(1.0) and r.pr_auc == pytest.approx(1.0)
    grid = model.f1_grid(scored, 11).collect()
    assert len(grid) == 11 and max(x.f1 for x in grid) == 1.0


def test_gate(spark):
    runs = spark.createDataFrame([(1, 0.8, 0.8), (2, 0.8, 0.9), (3, 0.9, 0.76), (4, 0.95, None), (5, 0.91, 0.8)], "at int, f05 double, pr_auc double").withColumn("h", F.lit(1))
    out = {r.at: r for r in model.accept(model.guardrail(runs), "at", ["h"]).collect()}
    assert [out[i].accepted for i in (1, 2, 3, 4, 5)] == [True, False, True, False, True]
    assert out[4].gate_reasons.startswith("pr_auc") and out[1].gate_reasons == ""


def test_training_and_scores(spark):
    rng = random.Random(4)
    rows = [(float(x), rng.random(), 0.95 if x > 5 else 0.05, 1.0) for x in [rng.uniform(0, 10) for _ in range(300)]]
    df = spark.createDataFrame(rows, "a double, b double, y_smooth double, sample_weight double")
    m = model.train_model(df, ["a", "b"], model.ModelConfig(max_depth=3, rounds=5, learning_rate=0.3))
    assert model.feature_importance(m, ["a", "b"])[0][0] == "a"
    p = model.score(m, df, ["a", "b"]).agg(F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    assert 0 <= p.lo < 0.3 and 0.7 < p.hi <= 1
    with pytest.raises(ValueError):
        model.ModelConfig(learning_rate=0)


def test_monthly_run_obeys_its_gate(spark, tmp_path):
    rng = random.Random(6)
    ends = [D(2024, m, 1) for m in range(3, 13)]
    rows, months_of = [], []
    for c in range(60):
        stays = c % 2 == 0
        for e in ends:
            rows.append((c, 3, e, 9.0 if stays else 1.0 + rng.random()))
        if stays:
            months_of += [(c, D(2024, m, 1), 3, 100) for m in range(1, 13)]
    series = {f"{x}_months": F.array(*[F.lit(1.0)] * 3) for x in ("item", "revenue", "complaint", "delay", "nodone", "order", "satisfaction")}
    others = [c for c in (*pipeline.FEATURES, "complaint_diversity", "cv_item", "service_types_used", "dominant_service_ratio", "item_slope", "revenue_slope") if c != "item_sum" and "ewma" not in c]
    table = spark.createDataFrame(rows, "cust_id long, window_size int, window_end date, item_sum double").withColumns(series).withColumns({c: F.lit(1.0) for c in others})
    past = spark.createDataFrame(months_of, "cust_id long, report_month date, item_count long, total_fee long")
    small = dict(max_depth=2, rounds=2, learning_rate=0.3)
    run = lambda history=None, path=None, **gates: pipeline.monthly_run(table, past, pipeline.RunConfig("2024-12-01", "2024-01-01", model=model.ModelConfig(**small, **gates)), history, risk_path=path)
    path = str(tmp_path / "risk")
    good = run(path=path)
    assert good["run"].first().accepted and good["scored"].count() == 60
    assert published(spark, path).count() == good["risk"].count() == good["scored"].where("churn_flag = 1").count() > 0
    failed = run(min_f05=1.1, path=path)
    assert not failed["run"].first().passed and failed["scored"].count() == failed["risk"].count() == 0
    assert published(spark, path).count() > 0
    better = spark.createDataFrame([("2024-11-01", 2, 1.0, 0.9), ("2025-01-01", 2, 2.0, 0.9)], "as_of string, horizon int, f05 double, pr_auc double")
    rejected = run(better)
    assert rejected["run"].first().passed and not rejected["run"].first().accepted and rejected["scored"].count() == 0


def test_monthly_runs_share_a_store(spark):
    """The second run is refused and scores with the stored model; DuckDB recomputes gate, acceptance, cut and reasons from what is
    stored. Known leavers take part (``confirmed=``), validation is out of time."""
    import duckdb

    rng = random.Random(7)
    rows, months_of = [], []
    for c in range(80):
        stays = c % 3 > 0
        for m in range(3, 13):
            rows.append((c, 3, D(2024, m, 1), (6.0 if stays else 2.0) + rng.random() * 3, rng.random()))
        if stays:
            months_of += [(c, D(2024, m, 1), 3, 100) for m in range(1, 13)]
    series = {f"{x}_months": F.array(*[F.lit(1.0)] * 3) for x in ("item", "revenue", "complaint", "delay", "nodone", "order_score", "satisfaction")}
    others = [c for c in (*pipeline.FEATURES, "complaint_diversity") if c not in ("item_sum", "recency") and "ewma" not in c]
    table = spark.createDataFrame(rows, "cust_id long, window_size int, window_end date, item_sum double, recency double").withColumns(series).withColumns({c: F.lit(1.0) for c in dict.fromkeys(others)})
    past = spark.createDataFrame(months_of, "cust_id long, report_month date, item_count long, total_fee long")
    known = spark.createDataFrame([(c,) for c in range(0, 80, 6)], "cust_id long")
    path, risk = shared_path(spark, "store"), shared_path(spark, "risk")
    settings = model.ModelConfig(max_depth=2, rounds=3, learning_rate=0.3, min_f05=0.3, min_pr_auc=0.3)
    run = lambda t_obs: pipeline.monthly_run(
        table.where(F.col("window_end") <= F.lit(t_obs).cast("date")), past.where(F.col("report_month") <= F.lit(t_obs).cast("date")),
        pipeline.RunConfig(t_obs, "2024-01-01", model=settings, eval_months=2), confirmed=known, store_path=path, risk_path=risk,
    )
    first, second = run("2024-11-01"), run("2024-12-01")
    a, b = first["run"].first(), second["run"].first()
    assert a.accepted and b.passed and not b.accepted and b.prev_f05 == a.f05
    assert second["scored"].count() == 80 and second["threshold"] == a.threshold
    kept, threshold = pipeline.last_accepted(spark, path, "2024-12-01", 2)
    now = pipeline._observed(pipeline.add_ewma(table), pipeline.RunConfig("2024-12-01", "2024-01-01"))
    by_kept = {r.cust_id: r.p for r in model.score(kept, now, pipeline.FEATURES).select("cust_id", "p").collect()}
    assert by_kept == {r.cust_id: r.p for r in second["scored"].select("cust_id", "p").collect()}
    assert pipeline.last_accepted(spark, path, "2024-11-01", 2) is None and pipeline.last_accepted(spark, path, "2025-01-01", 3) is None
    stored, scored = shared_path(spark, "runs"), shared_path(spark, "scored")
    published(spark, f"{path}/runs").write.parquet(stored)
    second["scored"].select("cust_id", "p", "churn_flag", "reason_1", "reason_2", "reason_3", "reactive_reasons", "proactive_reasons").write.parquet(scored)
    db = duckdb.connect()
    view = lambda p: f"read_parquet('{p.removeprefix('file://')}/*.parquet')"
    assert db.sql(f"SELECT count(*), bool_and(passed = (f05 >= 0.3 AND pr_auc >= 0.3)), bool_and(accepted = (passed AND (best IS NULL OR f05 > best + 1e-6))) FROM (SELECT *, max(CASE WHEN passed THEN f05 END) OVER (ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM {view(stored)})").fetchall()[0] == (2, True, True)
    cut = f"greatest({threshold!r}::DOUBLE, (SELECT quantile_cont(p, 0.9) FROM {view(scored)}))"
    assert db.sql(f"SELECT bool_and((churn_flag = 1) = (p >= {cut})) FROM {view(scored)}").fetchall()[0] == (True,)
    codes = "string_split(concat_ws('|', nullif(reactive_reasons, ''), nullif(proactive_reasons, '')), '|')"
    assert db.sql(f"SELECT bool_and(coalesce(reason_{{k}}, '') = coalesce({codes}[{{k}}], '')) FROM {view(scored)}".format(k=1)).fetchall()[0] == (True,)
    assert published(spark, risk).count() == second["risk"].count() == sum(r.churn_flag for r in second["scored"].select("churn_flag").collect())


def test_profiles(spark):
    values = [float(i) for i in range(100)] + [999.0]
    df = spark.createDataFrame([(v, 5.0, None) for v in values], "x double, c double, n double")
    out = {r.feature: r for r in eda.outlier_stats(df, ["x", "c", "n"]).collect()}
    assert out["x"].iqr_outliers == 1 and out["x"].z_outliers == 1 and out["c"].z_outliers == 0 and out["n"].lower is None and out["n"].n == 0
    d = {r.feature: r for r in eda.describe_features(spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 10.0)], "x double"), ["x"]).collect()}
    assert d["x"].skewness == pytest.approx(1.7636, abs=1e-4) and d["x"].kurtosis == pytest.approx(3.2280, abs=1e-4)
    missing = eda.missing_stats(spark.createDataFrame([(1.0, float("inf")), (None, 1.0)], "a double, b double"), ["a", "b"]).collect()
    assert [(r.feature, r.missing, r.has_inf) for r in missing] == [("a", 1, False), ("b", 0, True)]


def test_drift(spark):
    rows = [(2501, float(i)) for i in range(150)] + [(2502, float(i)) for i in range(150)] + [(2503, float(i + 120)) for i in range(150)]
    got = {r.month: r for r in monitor.monthly_drift(spark.createDataFrame(rows, "month int, x double"), ["x"], "month").collect()}
    assert got[2502].psi == pytest.approx(0) and got[2502].severity == "OK" and got[2503].severity == "ALERT" and 0 < got[2503].ks <= 1
    gone = monitor.feature_drift(spark.createDataFrame([(1.0,)], "y double"), spark.createDataFrame(rows, "month int, x double"), ["x"]).first()
    assert gone.severity == "ALERT" and gone.psi is None


def test_robust_anomaly(spark):
    df = spark.createDataFrame([(i, 0.1 + 0.001 * (i % 3)) for i in range(8)] + [(8, 0.9)], "m int, v double")
    got = {r.m: r.is_anomaly for r in windows.robust_anomaly(df.repartition(3), "v", "m").collect()}
    assert got[8] and not any(got[i] for i in range(4))


def test_scores_and_reasons(spark):
    df = spark.createDataFrame([(p, f) for p, f in zip((0.1, 0.3, 0.5, 0.7, 0.9), (0, 0, 0, 1, 1))], "p double, churn_flag int")
    r = monitor.score_stats(df).first()
    assert (r.mean, r.p50, r.risk_count, r.risk_ratio) == (pytest.approx(0.5), 0.5, 2, 0.4)
    assert monitor.score_stats(df.limit(0)).first().risk_ratio == 0
    g = reasons.global_reasons(spark.createDataFrame([(10.0,), (20.0,), (30.0,)], "feat_a double"), ["feat_a", "gone"]).orderBy("feat_a").collect()
    assert [x.reason_1 for x in g] == ["Low feat_a", "Low feat_a", "High feat_a"] and g[0].reason_2 == "Feature: gone"
    r = reasons.rule_reasons(spark.createDataFrame([([10.0, 10.0, 10.0, 1.0], [2.0, 2.0, 2.0, 9.0])], "item_months array<double>, complaint_months array<double>")).first()
    assert r.churn_type == "mixed" and r.reason_1 == "R_COMPLAINT_SPIKE" and "P_ITEM_DROP" in r.proactive_reasons


def test_idempotency(spark):
    log = spark.createDataFrame([("b", "success", D(2024, 1, 1), "h"), ("c", "success", D(2024, 1, 1), "old"), ("d", "failed", D(2024, 1, 2), "h"), ("d", "success", D(2024, 1, 1), "h")], "zip_name string, status string, finished_at date, md5_hash string")
    files = spark.createDataFrame([(x, "h") for x in "abcd"], "zip_name string, md5_hash string")
    got = {r.zip_name: (r.action, r.reason) for r in ingest.plan_files(files, log).collect()}
    assert got == {"a": ("process", "new"), "b": ("skip", "unchanged"), "c": ("process", "changed"), "d": ("process", "retry")}


def test_names_and_labels(spark):
    names = ["bccp_orderitem_2501.zip", "cas_customer_update_250322.zip", "x.zip"]
    got = [tuple(r) for r in spark.createDataFrame([(n,) for n in names], "n string").select(*ingest.parse_drop_name(F.col("n"))).collect()]
    assert got == [("bccp_orderitem", "monthly", "202501"), ("cas_customer", "snapshot", "20220325"), ("x", None, None)]
    labels = spark.createDataFrame([(n,) for n in ("Roi_bo_03_25.csv", "label_2503.csv", "other.csv")], "n string").select(readers.label_file_period(F.col("n")).alias("v")).collect()
    assert [r.v for r in labels] == [2503, 2503, None]
    keys = ingest.key_fallback(spark.createDataFrame([(" ", " R001 "), (" C002 ", None), (None, "nan")], "cms_code_enc string, crm_code_enc string")).collect()
    assert sorted((r.key, r.key_type) for r in keys) == [("C002", "cms_code_enc"), ("R001", "crm_code_enc")]


def test_guard_and_delimited_files(spark, tmp_path):
    df = spark.createDataFrame([("=1",), ("+1",), ("ok",), (None,)], "c string")
    assert [r.c for r in ingest.guard_cells(df, ["c"])[0].collect()] == ["'=1", "+1", "ok", None]
    kept, bad = ingest.guard_cells(df, ["c"], "strict")
    assert kept.count() == 2 and bad.count() == 2
    (tmp_path / "a.csv").write_bytes("﻿id;name\n1;é\n2;x;extra\n".encode())
    good, rejects = readers.split_ragged(readers.read_delimited(spark, str(tmp_path), ["id", "name"]).cache())
    assert [tuple(r) for r in good.collect()] == [("1", "é")] and rejects.count() == 1


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z")], "k int, v string, w string")
    assert sorted(map(tuple, sinks.upsert(old, new, ["k"]).collect())) == [(1, "a", "x"), (2, "B", "Y"), (3, "C", "Z")]
    assert sorted(map(tuple, sinks.partial_upsert(old, new, ["k"], ["v"]).collect())) == [(1, "a", "x"), (2, "B", "y"), (3, "C", "Z")]


def test_stream_equals_batch_and_batches_repeat(spark):
    path = shared_path(spark, "events")
    at = datetime.datetime
    events = spark.createDataFrame([(i, at(2024, 1, 1 + i % 5, i % 24), i % 3, i / 7) for i in range(200)], "event_id long, ts timestamp, user_id long, value double")
    events.repartition(4).write.parquet(path)
    out = {}
    stream = feeds.daily_rollup(feeds.file_stream(spark, path, "event_id long, ts timestamp, user_id long, value double", per_trigger=1))
    feeds.run_once(stream, f"{path}-check", lambda b, i: out.update(rows=sorted(map(tuple, b.collect()))), mode="complete")
    assert out["rows"] == sorted(map(tuple, feeds.daily_rollup(events).collect()))


def file_of(spark, rows, path, schema="k long, v long, seq long"):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def test_drops_are_gathered_skipped_and_set_aside(spark):
    """A month's parts in two micro-batches, an unchanged and a changed re-delivery, a file that can't be read; a batch repeats."""
    path = shared_path(spark, "feed")
    name, month = r"regexp_extract(path, '(m=[^/]+/p=[^/]+)/', 1)", r"regexp_extract(path, '/m=([^/]+)/', 1)"
    make = lambda: drops.DropLoader(f"{path}/table", f"{path}/ledger", "k long, v long, seq long", name, month, ["k"], ["seq"])
    take = lambda loader: feeds.run_once(drops.drop_stream(spark, f"{path}/in", 1, "part-*"), f"{path}/check", loader)
    file_of(spark, [(1, 10, 0), (2, 20, 0)], f"{path}/in/a/m=1/p=1")
    file_of(spark, [(3, 30, 0)], f"{path}/in/a/m=1/p=2")
    spark.createDataFrame([("not parquet",)], "v string").coalesce(1).write.text(f"{path}/in/a/m=2/p=1")
    file_of(spark, [(9, 90, 0)], f"{path}/in/a/m=3/p=1")
    loader = make()
    take(loader)
    assert [c["total"] for c in loader.counters] == [1, 1, 1, 1]
    rows = lambda: sorted((r.drop_month, r.k, r.v) for r in published(spark, f"{path}/table").collect())
    assert rows() == [("1", 1, 10), ("1", 2, 20), ("1", 3, 30), ("3", 9, 90)]
    copy_drops(spark, f"{path}/in/a", f"{path}/in/b", "m=3")
    file_of(spark, [(3, 31, 1)], f"{path}/in/c/m=1/p=2")
    again = make()
    take(again)
    assert rows() == [("1", 1, 10), ("1", 2, 20), ("1", 3, 31), ("3", 9, 90)]
    got = {r.month: (r.total, r.success, r.skipped, r.failed) for r in drops.counters(drops.ledger_rows(spark, f"{path}/ledger")).collect()}
    assert got == {"1": (3, 3, 0, 0), "2": (1, 0, 0, 1), "3": (2, 1, 1, 0)}
    reasons = {(r.name, r.status): r.reason for r in drops.ledger_rows(spark, f"{path}/ledger").collect()}
    assert reasons["m=3/p=1", "skipped"] == "unchanged" and "FAILED_READ_FILE" in reasons["m=2/p=1", "failed"]
    last = max(r.batch for r in drops.ledger_rows(spark, f"{path}/ledger").collect())
    files = drops.ledger_rows(spark, f"{path}/ledger").where(F.col("batch") == last).select("path", "md5")
    again(staged(files, "batch"), last)  # a repeated batch decides as before
    assert drops.ledger_rows(spark, f"{path}/ledger").count() == 6 and len(rows()) == 4


def test_staged_tables_end(spark):
    """Whatever queries and operators stage inside a block is gone after it; a kept table stays."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    exists = lambda p: jvm.org.apache.hadoop.fs.Path(p).getFileSystem(conf).exists(jvm.org.apache.hadoop.fs.Path(p))
    df = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    with tables_end(spark) as keep:
        inside = staged(df, "inside"), staged(df, "bucketed", "x", 2)
        outlier = eda.outlier_stats(df, ["x"]).collect()
        keep.append(staged(df, "kept"))
        made = [x.staged_at for x in tables._live]
    assert outlier and len(made) > 3 and [p for p in made if exists(p)] == [p for p in made if p in {x.staged_at for x in tables._live}]
    assert keep[0].count() == 50 and not any(exists(x.staged_at) for x in inside) and not spark.catalog.tableExists(inside[1].staged_name)
    discard(*keep)
    assert not exists(keep[0].staged_at)


def test_published_tables_change_at_once(spark):
    path = shared_path(spark, "table")
    one = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], "k long, v string, p int")
    assert publish(one, path, ["p"]) == 1
    rows = lambda: sorted(tuple(r) for r in published(spark, path).collect())
    bad = spark.createDataFrame([(5, "x", 1), (6, "y", 3)], "k long, v string, p int").repartition(2, "k")
    with pytest.raises(Exception, match="planned"):
        publish(bad.withColumn("v", F.when(F.col("k") == 6, F.raise_error(F.lit("planned"))).otherwise(F.col("v"))), path, ["p"])
    assert rows() == [(1, "a", 1), (2, "b", 1), (3, "c", 2)]
    assert publish(spark.createDataFrame([(7, "z", 2), (8, "n", None)], "k long, v string, p int"), path, ["p"]) == 2
    assert rows() == [(1, "a", 1), (2, "b", 1), (7, "z", 2), (8, "n", None)]
    assert sorted(r.k for r in published(spark, path, 1).collect()) == [1, 2, 3]
    vacuum(spark, path, 1)
    assert len(rows()) == 4
    keyed = shared_path(spark, "keyed")
    sinks.upsert_published(one.select("k", "v"), keyed, ["k"])
    assert sorted(map(tuple, sinks.upsert_published(spark.createDataFrame([(1, "new"), (4, "d")], "k long, v string"), keyed, ["k"]).collect())) == [(1, "new"), (2, "b"), (3, "c"), (4, "d")]
    assert not is_published(spark, shared_path(spark, "nothing"))


def test_windows_are_built_incrementally(spark):
    """The second build writes new partitions alone, and all is what one build gives."""
    extra = {c: F.lit(0) for c in ("weight_kg", "delay_day", "refunded", "noaccepted", "lost_order", "intra_province", "international", "lastday", *[f"ser_{s}" for s in features.SERVICES])}
    rng = random.Random(8)
    rows = [(c, D(2024, m, 1), rng.randrange(9), rng.randrange(500), rng.randrange(2), 0, 0, rng.random(), rng.random()) for c in range(12) for m in range(1, 13) if rng.random() < 0.6]
    months = features.agg_monthly(spark.createDataFrame(rows, "cust_id long, report_month date, item_count long, total_fee long, total_complaint long, delay_count long, nodone long, order_score double, satisfaction_score double").withColumns(extra))
    specs = features.window_grid(spark, "2024-01-01", "2024-12-01", [3, 6]).select("window_size", "window_end")
    path, once = shared_path(spark, "windows"), shared_path(spark, "windows")
    first = feeds.build_windows(months, specs.where("window_end <= DATE '2024-09-01'"), path)
    old = {(r.window_size, r.window_end) for r in first.collect()}
    second = {(r.window_size, r.window_end) for r in feeds.build_windows(months, specs, path).collect()}
    assert len(old) == 11 and len(second) == 6 and not old & second
    assert feeds.build_windows(months, specs, path).count() == 0
    feeds.build_windows(months, specs, once)
    # Running sums begin with the months of a build, so doubles may differ in their last bits.
    close = lambda v: round(v, 9) + 0.0 if isinstance(v, float) else v
    whole = lambda p: sorted(str([close(v) for v in r]) for r in published(spark, p).collect())
    assert whole(path) == whole(once) and len(whole(path)) > 50
    versions = {(r.window_size, r.window_end): r.v for r in published(spark, path).select("window_size", "window_end", F.regexp_extract(F.input_file_name(), r"__v=(\d+)", 1).alias("v")).distinct().collect()}
    assert {versions[w] for w in old if w in versions} == {"1"} and {versions[w] for w in second if w in versions} == {"2"}


def test_built_windows_hold_the_measures_asked_for(spark):
    df, _ = months(spark, 9)
    monthly, path = features.agg_monthly(df), shared_path(spark, "windows")
    specs = features.window_grid(spark, "2024-01-01", "2024-06-01", [3]).select("window_size", "window_end")
    feeds.build_windows(monthly.select("cust_id", "report_month", "item_sum"), specs.where("window_end < DATE '2024-05-01'"), path, measures=["item_sum"])
    feeds.build_windows(monthly.select("cust_id", "report_month", "item_sum"), specs, path, measures=["item_sum"])
    want = features.agg_window_base(monthly, "2024-01-01", "2024-06-01", [3])
    got = published(spark, path)
    assert sorted(got.columns) == sorted([*features.WINDOW_KEY, "item_sum"])
    assert sorted(map(tuple, got.select(*features.WINDOW_KEY, "item_sum").collect())) == sorted(map(tuple, want.select(*features.WINDOW_KEY, "item_sum").collect()))


def test_ranks_over_ranges(spark):
    """Running totals and percentiles against numpy: ties, nulls, groups of one value, a null group, no rows."""
    import numpy as np

    from tidemark.operators import ranks

    rng = random.Random(3)
    rows = [(g, None if rng.random() < 0.1 else float(rng.randrange(1, 40))) for g in ("a", "b", None) for _ in range(300)] + [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    at = [0.0, 0.05, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {r.g: r.q for r in ranks.percentiles(df, "v", at, ["g"], "q").collect()}
    assert set(got) == {"a", "b", None, "one"}
    for g, q in got.items():
        assert np.allclose(q, np.percentile([v for x, v in rows if x == g and v is not None], [100 * p for p in at]))
    every = ranks.percentiles(df, "v", at).collect()
    assert np.allclose(every[0].percentiles, np.percentile([v for _, v in rows if v is not None], [100 * p for p in at]))
    assert [r.percentiles for r in ranks.percentiles(df.where("v < 0"), "v", [0.5]).collect()] == [[None]]
    counts = df.where("v IS NOT NULL").groupBy("g", "v").count().withColumnRenamed("count", "n")
    for r in ranks.running_totals(counts, "v", ["n"], ["g"], descending=True).collect():
        assert r.n_upto == sum(1 for g, v in rows if g == r.g and v is not None and v >= r.v)


def test_percentiles_from_narrow_brackets(spark):
    """Most values lie outside the brackets: ties of a third of all rows, far outliers, one value only, few rows."""
    import numpy as np

    from tidemark.operators import ranks

    rng = np.random.default_rng(5)
    groups = {"ties": np.where(rng.random(9000) < 1 / 3, 7.0, rng.normal(size=9000)), "far": rng.pareto(0.3, 9000), "sorted": np.arange(9000.0), "flat": np.full(500, 2.0), "two": np.array([1.0, 4.0])}
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v], "g string, v double").repartition(7)
    at = [0.0, 0.001, 0.1, 0.5, 0.5, 0.77, 0.999, 1.0]
    for accuracy in (50, 1000):
        got = {r.g: r.q for r in ranks.percentiles(df, "v", at, ["g"], "q", accuracy).collect()}
        for g, v in groups.items():
            assert np.allclose(got[g], np.percentile(v, [100 * p for p in at]), rtol=1e-12)


def test_spearman_ranks_once(spark):
    """Mean ranks of several columns against pandas, with nulls and ties; more columns take no more shuffles."""
    import numpy as np
    import pandas as pd

    from tidemark.operators import eda

    rng = np.random.default_rng(6)
    own = pd.DataFrame({c: np.where(rng.random(400) < 0.1, np.nan, rng.integers(0, 30, 400) * (1.0 + k)) for k, c in enumerate("abcd")})
    df = spark.createDataFrame([tuple(None if x != x else float(x) for x in r) for r in own.itertuples(index=False)], "a double, b double, c double, d double")
    ranks = own.rank()
    got = {(r.feature_a, r.feature_b): r.r for r in eda.correlation_pairs(df, list("abcd"), "spearman").collect()}
    assert len(got) == 6
    for (x, y), r in got.items():
        assert abs(r - ranks[x].corr(ranks[y])) < 1e-9
    plan = lambda names: eda.mean_ranks(df, names)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert plan(["a", "b"]) == plan(list("abcd"))
    assert eda.correlation_pairs(df.where("a < -1"), ["a", "b"], "spearman").first().r is None


def test_folds_fitted_together(spark):
    """Every fold's AUC against a model fitted for it alone: unequal sizes, nulls, a flat column, a fold of one class."""
    import numpy as np

    from tidemark.operators import walkforward

    rng = np.random.default_rng(8)
    rows = []
    for size, months in ((3, 9), (4, 8), (9, 3)):
        for month in range(months):
            for _ in range(60):
                x = rng.normal(size=2)
                y = int(rng.random() < 1 / (1 + np.exp(-(x[0] - 0.5 * x[1] + 0.1 * month - 1)))) if (size, month) != (4, 6) else 0
                rows.append((size, f"2001-{month + 1:02d}-01", y, float(50 + 10 * x[0]), None if rng.random() < 0.05 else float(x[1]), 3.0))
    df = spark.createDataFrame(rows, "window_size int, window_end string, y int, a double, b double, flat double").repartition(5)
    got = {(r.window_size, r.fold): r.auc for r in walkforward.fold_aucs(df, ["a", "b", "flat"], "y", 5).collect()}
    wanted = {}
    for size, months in ((3, 9), (4, 8)):
        for fold in range(months - 5):
            part = lambda ends: np.array([[v or 0.0 for v in r[2:]] for r in rows if r[0] == size and int(r[1][5:7]) - 1 in ends])
            train, valid = part(range(5 + fold)), part([5 + fold])
            if valid[:, 0].min() == valid[:, 0].max():
                continue
            centre, scale = train[:, 1:].mean(axis=0), np.where(train[:, 1:].std(axis=0) > 0, train[:, 1:].std(axis=0), 1.0)
            x, y, beta = np.column_stack([np.ones(len(train)), (train[:, 1:] - centre) / scale]), train[:, 0], np.zeros(4)
            w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
            for _ in range(20000):
                beta -= 2.0 / w.sum() * (x.T @ (w * (1 / (1 + np.exp(-x @ beta)) - y)) + np.array([0.0, 1.0, 1.0, 1.0]) * beta)
            p = beta[0] + (valid[:, 1:] - centre) / scale @ beta[1:]
            pairs = p[valid[:, 0] == 1][:, None] - p[valid[:, 0] == 0][None, :]
            wanted[size, fold] = float((pairs > 0).mean() + (pairs == 0).mean() / 2)
    assert set(got) == set(wanted) and (4, 1) not in got
    assert all(abs(got[k] - wanted[k]) < 1e-9 for k in wanted)
    by_size = {r.window_size: (r.auc, r.n_folds) for r in walkforward.size_aucs(walkforward.fold_aucs(df, ["a"], "y", 5), [3, 4, 9]).collect()}
    assert by_size[9] == (None, 0) and by_size[3][1] == 4 and by_size[4][1] == 2
    assert walkforward.fold_aucs(df.where("a < -1e9"), ["a"], "y", 5).collect() == []


def test_windows_carry_no_array_of_their_customer(spark):
    """A window holds its two entries; its customer's arrays end where windows become rows."""
    df, _ = months(spark, 2)
    args = ("2024-01-01", "2025-06-01")
    customers = month_arrays.customer_months(features.agg_monthly(df), *args)
    held = month_arrays.windows_of(customers, *args, [3])
    assert not {"entries", "upto", *[c for c in customers.columns if c.startswith("values_")]} & set(held.columns)
    assert held.where("h.rows <= coalesce(l.rows, 0)").count() == 0 < held.count()


def test_window_totals_copy_no_customer_row(spark):
    """Totals equal those of copied rows; only sums by month and gap meet the windows."""
    df, _ = months(spark, 6)
    args = ("2024-01-01", "2025-06-01", [1, 3, 12])
    monthly = features.agg_monthly(df)
    copies = features.to_windows(monthly, F.col("report_month"), *args).groupBy("window_size", "window_end")
    want = copies.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("cust_id").alias("n_customers"), F.sum("item_sum").alias("items"), F.sum("revenue_sum").alias("revenue"))
    got = features.window_totals(monthly, *args)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "cust_id" not in plan[: plan.index("Generate")] and plan.count("Window ") == 1


def test_trees_are_fitted_on_partitions_of_bounded_size(spark, monkeypatch):
    data = spark.range(1000).coalesce(1).withColumns({"x": F.col("id") % 7 * 1.0, "y_smooth": F.when(F.col("id") % 7 > 3, 0.9).otherwise(0.1), "sample_weight": F.lit(1.0)})
    fitted = []
    real = model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, df: fitted.append(df) or real(self, df))
    config = model.ModelConfig(max_depth=2, rounds=2)
    plain = model.train_model(data, ["x"], config)
    monkeypatch.setattr(model, "PART_ROWS", 300)
    model.train_model(data, ["x"], config)
    assert plain.numFeatures == 1 and fitted[0].rdd.getNumPartitions() == 1
    sizes = fitted[1].rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 2000 and max(sizes) <= 300


def test_only_named_measures_are_made_and_runs_share_them(spark):
    """Measures asked for alone equal those of the full row; nothing else is summed, and windows with the same months are measured once."""
    df, _ = months(spark, 3)
    monthly, args = features.agg_monthly(df), ("2024-01-01", "2025-06-01", [3, 12])
    names = ["item_sum", "revenue_avg", "item_median"]
    some = features.agg_window_base(monthly, *args, measures=names)
    assert some.columns == [*features.WINDOW_KEY, *names]
    plain = lambda t: sorted(map(tuple, t.select(*some.columns).collect()))
    assert plain(some) == plain(features.agg_window_base(monthly, *args))
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "weight_sum" not in plan and "order_score_avg" not in plan
    assert plan.count("Generate inline") == 2 and "sort_array" not in plan[: plan.index("Generate inline")]


def test_columns_of_feature_rows_equal_the_full_row(spark):
    df, _ = months(spark, 5)
    monthly = features.agg_monthly(df)
    items = df.select("cust_id", F.date_add("report_month", 4).alias("send_date"))
    complaints = df.where("total_complaint > 0").select("cust_id", F.col("report_month").alias("create_date"), (F.col("cust_id") % 3).alias("complaint_code"))
    args = (monthly, complaints, items, "2024-01-01", "2025-06-01", [3, 6])
    names = ["cv_item", "recency", "complaint_diversity", "item_months", "item_slope", "item_max_month", "dominant_service_ratio"]
    some, full = features.window_features(*args, columns=names), features.window_features(*args)
    assert some.columns == [*features.WINDOW_KEY, *names]
    plain = lambda t: sorted(map(str, t.select(*some.columns).collect()))
    assert plain(some) == plain(full) and some.count() > 100
    light = features.window_features(*args, columns=["pct_delay"])._jdf.queryExecution().optimizedPlan().toString()
    assert "complaint_code" not in light and "send_date" not in light


def test_steps_written_out_give_the_same_trend(spark):
    df = spark.createDataFrame([([1.0, None, 2.5, 7.0],), ([0.1, 0.2, 0.3, 0.7],)], "x array<double>")
    r = df.select(features.ewma(F.col("x"), 0.3).alias("a"), features.ewma(F.col("x"), 0.3, 4).alias("b")).collect()
    assert all(tuple(x.a) == tuple(x.b) for x in r)
    assert "lambda" not in df.select(features.ewma(F.col("x"), 0.3, 4))._jdf.queryExecution().optimizedPlan().toString()


def test_customers_are_dealt_to_a_named_number_of_partitions(spark):
    """Spark puts no partitions together by the size that rows have before their windows are made."""
    df, _ = months(spark, 7)
    monthly, args = features.agg_monthly(df), ("2024-01-01", "2025-06-01", [3])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for out in (features.agg_window_base(monthly, *args, measures=["item_sum"]), features.to_windows(monthly, F.col("report_month"), *args)):
        assert out.rdd.getNumPartitions() == n


def test_a_pair_and_its_mirror_image_are_one_covariance(spark):
    df = spark.createDataFrame([(1.0, 2.0, 9.0), (2.0, 1.0, None), (4.0, 7.0, 3.0)], "a double, b double, c double")
    got = prep.mean_and_covariance(df, ["a", "b", "c"])
    cov = {(r.feature_a, r.feature_b): r.cov for r in got.collect()}
    assert len(cov) == 9 and all(cov[a, b] == cov[b, a] for a, b in cov) and cov["a", "b"] == pytest.approx(4.333333333)
    plan = prep.mean_and_covariance(df, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_covar_samp") == 6


def test_folds_read_their_rows_once(spark):
    """The rows are made once, whatever the number of steps, and fill several blocks; equal rows tie."""
    import numpy as np

    from tidemark.operators import walkforward

    made = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: made.add(1) or x, "double").asNondeterministic()
    u = lambda seed: F.rand(seed)
    rows = spark.range(9000).select(F.lit(3).alias("window_size"), F.add_months(F.lit("2001-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("window_end"), F.floor(u(1) * 50).alias("a"), (u(2) < 0.3).cast("int").alias("y"))
    rows = staged(rows.coalesce(1), "rows")
    got = {r.fold: r.auc for r in walkforward.fold_aucs(rows.withColumn("a", count(F.col("a").cast("double"))), ["a"], "y", 5).collect()}
    assert made.value == 9000 and set(got) == {0, 1}
    p = rows.toPandas()
    for fold, auc in got.items():
        train, valid = p[p.window_end < D(2001, 6 + fold, 1)], p[p.window_end == D(2001, 6 + fold, 1)]
        sign = np.sign(train[train.y == 1].a.mean() - train[train.y == 0].a.mean())
        pairs = sign * (valid[valid.y == 1].a.to_numpy()[:, None] - valid[valid.y == 0].a.to_numpy()[None, :])
        assert abs(auc - ((pairs > 0).mean() + (pairs == 0).mean() / 2)) < 1e-12


def test_labels_move_no_window(spark):
    """Windows dealt out by customer are labelled where they are, and the windows are not made again to find their ends."""
    from tidemark.operators.month_arrays import dealt_by_customer

    rows = [(c, D(2024, m, 1), float(m)) for c in (1, 2, 3, None) for m in (1, 2, 3)]
    past = spark.createDataFrame([(1, D(2024, 2, 1), 1, 10), (2, D(2024, 4, 1), 0, 0), (3, D(2024, 5, 1), 0, 5), (None, D(2024, 2, 1), 1, 1)], "cust_id int, report_month date, item_count long, total_fee long")
    df = dealt_by_customer(spark.createDataFrame(rows, "cust_id int, window_end date, item_sum double"))
    got = prep.build_label(df, past, 2)
    plan = got._jdf.queryExecution().optimizedPlan().toString(), got._jdf.queryExecution().executedPlan().toString()
    assert plan[0].count("item_sum") and plan[1].count("Exchange") == 2 and "window_end" not in " ".join(x for x in plan[1].splitlines() if "Exchange" in x)
    assert got.columns == ["cust_id", "window_end", "item_sum", "y_raw"]
    active = {(r.cust_id, r.window_end.month) for r in got.collect() if r.y_raw == 0}
    assert active == {(1, 1), (3, 3)} and got.count() == 12


def test_training_rows_are_made_once(spark):
    """The rows that trees are fitted on are assembled once after they were counted, and go when the model is there."""
    made = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: made.add(1) or x, "double").asNondeterministic()
    rows = staged(spark.range(400).select(F.rand(1).alias("a"), (F.col("id") % 2).cast("double").alias("y_smooth"), F.lit(1.0).alias("sample_weight")), "rows")
    settings = model.ModelConfig(max_depth=2, rounds=2)
    fitted = model.train_model(rows.withColumn("a", count("a")), ["a"], settings)
    assert fitted.getNumTrees >= 1 and made.value == 2 * 400
    assert not spark._jsc.getPersistentRDDs()


def test_labels_that_are_there_are_kept(spark):
    """A table that was labelled for several runs gives each of them the rows and labels that it would have made itself."""
    cells = [(c, 3, D(2024, m, 1), float(c)) for c in range(1, 5) for m in range(3, 13)]
    table = spark.createDataFrame(cells, "cust_id int, window_size int, window_end date, item_sum double")
    past = spark.createDataFrame([(c, D(2024, m, 1), 1, 10) for c in range(1, 5) for m in range(1, 13) if m % (c + 2) == 0], "cust_id int, report_month date, item_count long, total_fee long")
    labelled = prep.build_label(table, past, 2)
    for last in ("2024-11-01", "2024-12-01"):
        upto = past.where(F.col("report_month") <= F.lit(last).cast("date"))
        own = prep.training_windows(table, upto, 3, "2024-01-01", last, 2).collect()
        kept = prep.training_windows(labelled, upto, 3, "2024-01-01", last, 2).collect()
        assert sorted(own) == sorted(kept) and {r.y_raw for r in own} == {0, 1}


def test_a_row_for_each_range_of_sizes(spark):
    """Ranges of sizes give the windows of all sizes, with the same values, each once; folds are the same of either."""
    from tidemark.operators import walkforward

    sent = [(c, D(2024, m, d)) for c in range(1, 25) for m in range(1, 13) for d in (1, 9, 20) if (c * m + d) % (c % 5 + 2) == 0]
    items = spark.createDataFrame([*sent, (30, D(2024, 5, 9)), (31, D(2024, 1, 1))], "cust_id int, send_date date")
    monthly = items.groupBy("cust_id", F.trunc("send_date", "month").alias("report_month")).agg(F.count(F.lit(1)).alias("item_sum"), F.sum(F.dayofmonth("send_date") + F.col("cust_id")).alias("revenue_sum"))
    columns, sizes = ("item_sum", "recency", "revenue_avg"), tuple(range(2, 10))
    more = monthly.withColumns({c: F.lit(0.0) for c in ("delay_sum", "complaint_sum")})
    complaints = spark.createDataFrame([], "cust_id int, create_date date, complaint_code int")
    wanted = features.window_features(more, complaints, items, "2024-01-01", "2024-12-01", sizes, with_months=False, columns=columns)
    ranges = staged(features.size_range_features(monthly, items, "2024-01-01", "2024-12-01", 2, 9, columns), "ranges")
    each = ranges.select("cust_id", F.explode(F.sequence("size_from", "size_to")).alias("window_size"), "window_end", *columns)
    assert sorted(each.collect()) == sorted(wanted.collect()) and ranges.count() < 0.8 * each.count()
    with pytest.raises(ValueError, match="ranges of sizes"):
        features.size_range_features(monthly, items, "2024-01-01", "2024-12-01", 2, 9, ("item_median",))
    y = ((F.col("cust_id") * 7 + F.month("window_end")) % 3 == 0).cast("int").alias("y")
    of_rows, of_ranges, dealt = (
        {(r.window_size, r.fold): r.auc for r in walkforward.fold_aucs(df.select("*", y), columns, "y", 2, rows).collect()} for df, rows in ((each, 10**6), (ranges, 10**6), (ranges, 20))
    )
    assert of_rows.keys() == of_ranges.keys() == dealt.keys() and len(of_rows) > 30
    assert all(abs(of_ranges[k] - v) < 1e-12 and abs(dealt[k] - v) < 1e-12 for k, v in of_rows.items())


def test_confirmed_rows_are_made_once(spark):
    """A prototype takes several readings of its rows, but they are made once and go with it."""
    made = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: made.add(1) or x, "double").asNondeterministic()
    rows = staged(spark.range(200).select(F.rand(1).alias("a"), F.rand(2).alias("b")), "rows")
    before = len(tables._live)
    proto = prep.fit_prototype(rows.withColumn("a", count("a")), ["a", "b"])
    assert made.value == 200 and len(tables._live) == before
    assert proto["mu"] == pytest.approx(list(rows.agg(F.avg("a"), F.avg("b")).first()))


def test_features_name_what_they_read(spark):
    """Features can be made of the columns of the items that they are said to read, and few columns are read for few features."""
    from tidemark.plans import views

    items = spark.createDataFrame([], "cust_id int, send_date date, end_date date, total_fee long, weight_kg long, delay_day long, refunded int, noaccepted int, nodone int, lost int, complaint int, intra int, international int, service string, score_pct long, satisfy_pct long, complaint_code int")
    for column in ("item_median", "delay_sum", "avg_delayday", "satisfaction_max_month", "satisfy_slope", "most_common_complaint", "active_days", "dominant_service", "nodone_months"):
        months, codes, days = features.levels_read((column,))
        own = items.select(*views.month_reads(months), *(["end_date", "complaint_code"] if codes else []), *(["complaint"] if codes and "total_complaint" not in months else []))
        got = features.window_features(features.agg_monthly(views.months_of(own)), views.complaints_of(own) if codes else None, own, "2024-01-01", "2024-12-01", (3,), columns=(column,))
        assert got.columns == ["cust_id", "window_size", "window_end", column]
    months, codes, days = features.levels_read(("recency", "frequency", "monetary"), False)
    assert views.month_reads(months) == ["cust_id", "send_date", "total_fee"] and days and not codes
    assert features.levels_read(("item_sum", "revenue_avg", "pct_delay", "order_score_avg"), False)[1:] == (False, False)


def test_rules_call_no_function_of_arrays(spark):
    """Rules look at single months, which Spark compiles; the reasons are those of texts with and without codes."""
    df = spark.createDataFrame([([9.0, 8.0, 10.0, 2.0], [9.0, None, 10.0, 2.0], -1.0), ([None, None, None, None], [1.0, 1.0, 1.0, 1.0], 1.0), ([], [], None)], "item_months array<double>, revenue_months array<double>, item_slope double")
    got = reasons.rule_reasons(df)
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = [(r.churn_type, r.reactive_reasons, r.proactive_reasons, r.reason_1, r.reason_2, r.reason_3, r.avg_prev_item, r.n_prev_revenue) for r in got.collect()]
    assert rows[0] == ("proactive", None, "P_ITEM_DROP|P_REVENUE_DROP|P_ITEM_TREND_DOWN", "P_ITEM_DROP", "P_REVENUE_DROP", "P_ITEM_TREND_DOWN", 9.0, 2)
    assert rows[1] == (None, None, None, None, None, None, None, 3) and rows[2] == (None, None, None, None, None, None, None, 0)


def test_boosting_outlasts_a_poor_round(spark):
    """Small steps that lower the error go on to the last round; where none of some rounds does, those up to the best are kept."""
    rows = spark.range(3000).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.lit(1.0).alias("sample_weight"))
    falling = staged(rows.withColumn("y_smooth", F.when(F.col("a") + F.col("b") > 1, 0.95).otherwise(0.05)), "rows")
    assert model.train_model(falling, ["a", "b"], model.ModelConfig(max_depth=2, rounds=12)).getNumTrees == 12
    noise = staged(rows.withColumns({"y_smooth": (F.rand(3) < 0.5).cast("double"), "c": F.lit(0.0)}), "rows")
    names = ["a", "b", "c"]
    fitted = model.train_model(noise, names, model.ModelConfig(max_depth=4, rounds=40, learning_rate=0.5, patience=3))
    assert 1 <= fitted.getNumTrees < 30 and [c for c, _ in model.feature_importance(fitted, names)][2] == "c"
    assert model.score(fitted, noise, names).where("p BETWEEN 0 AND 1").count() == 3000
    assert model.best_round([5.0, 4.0, 4.5, 4.1, 3.9, 4.2, 4.0, 4.1], 3) == (5, True) and model.best_round([5.0, 4.0, 4.5], 3) == (2, False)


def test_model_queries_fit_by_the_defaults(spark, monkeypatch):
    from tidemark.plans import model_queries

    fitted, real = [], model.train_model
    monkeypatch.setattr(model, "train_model", lambda df, columns, config=model.ModelConfig(): fitted.append(config) or real(df, columns, model.ModelConfig(max_depth=2, rounds=2)))
    assert model_queries.train_model(spark, "/root/testdata/sf0.001").count() == len(model_queries.COLUMNS)
    assert fitted == [model.ModelConfig()]


def test_every_feature_has_its_importance(spark, monkeypatch):
    """None is dropped, and equal gains are in the order of their names."""
    from tidemark.plans import model_queries

    gains = [("a", 0.1), ("e", 0.0), ("c", 0.6), ("d", 0.0), ("b", 0.3)]
    monkeypatch.setattr(model_queries, "train_model", lambda spark, sf_dir: spark.createDataFrame(gains, "feature string, gain double"))
    assert [r.feature for r in model_queries.feature_importance(spark, "").collect()] == ["c", "b", "a", "d", "e"]


def test_tasks_hold_few_blocks(spark):
    """Rows of megabytes are written in groups of a few, which Spark reads one after another; they go when the folds are judged."""
    import glob

    import pyarrow.parquet as pq

    from tidemark.operators import walkforward

    blocks = spark.range(0, 23, 1, 1).select(F.expr("cast(repeat('x', 100000) AS binary)").alias("block"))
    table = staged(blocks, "blocks", group_rows=walkforward._GROUP_BLOCKS)
    (file,) = glob.glob(table.staged_at.removeprefix("file://") + "/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [4, 4, 4, 4, 4, 3] and table.where("length(block) = 100000").count() == 23
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    batch, before = spark.conf.get(name), len(tables._live)
    rows = spark.range(700).select(F.lit(3).alias("window_size"), F.add_months(F.lit("2001-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("window_end"), F.rand(1).alias("a"), (F.rand(2) < 0.3).cast("int").alias("y"))
    assert walkforward.fold_aucs(rows, ["a"], "y", 5).count() == 2
    assert spark.conf.get(name) == batch and [x.staged_at.split("/")[-1].split("-")[0] for x in tables._live[before:]] == ["aucs"]


def test_stored_windows_are_not_written_again(spark, monkeypatch):
    """A table with trends and labels is read by a run, which writes no copy of its training rows, and they are the same."""
    rows = [(c, 3, D(2024, m, 1), float(c % 5 + m % 3), c / 7) for c in range(40) for m in range(3, 13)]
    series = {f"{x}_months": F.array(*[F.lit(1.0)] * 3) for x in reasons.METRICS}
    others = [c for c in (*pipeline.FEATURES, "complaint_diversity") if c not in ("item_sum", "recency") and "ewma" not in c]
    table = spark.createDataFrame(rows, "cust_id long, window_size int, window_end date, item_sum double, recency double").withColumns(series).withColumns({c: F.lit(1.0) for c in others})
    assert {*pipeline.WINDOW_COLUMNS} <= {*table.columns}
    past = spark.createDataFrame([(c, D(2024, m, 1), 3, 100) for c in range(40) for m in range(1, 13) if c % 3], "cust_id long, report_month date, item_count long, total_fee long")
    known = spark.createDataFrame([(c,) for c in range(0, 40, 3)], "cust_id long")
    labelled = staged(prep.build_label(features.add_ewma(table), past, 2), "windows", group_rows=50)
    written, fitted, real = [], [], model.train_model
    monkeypatch.setattr(pipeline, "staged", lambda df, label, *a, **k: written.append(label) or staged(df, label, *a, **k))
    monkeypatch.setattr(model, "train_model", lambda df, *a: fitted.append(sorted(map(str, df.drop("window_size").collect()))) or real(df, *a))
    config = pipeline.RunConfig("2024-12-01", "2024-01-01", model=model.ModelConfig(max_depth=2, rounds=2), eval_months=2)
    for source in (labelled, table):
        pipeline.monthly_run(source, past, config, confirmed=known)
    assert written.count("run-split") == 1 and fitted[0] == fitted[1] and len(fitted[0]) > 100
    # One read of the stored rows in small splits serves the fit without a shuffle.
    with tables.small_splits(spark, "8k"):
        assert labelled.rdd.getNumPartitions() > 2 and model.in_parts(labelled, 100) is labelled


def test_folds_are_judged_without_moving_scores(spark, monkeypatch):
    """Rows of an end are dealt out to folds of some sizes together, up to a number of rows; scores are moved for larger folds alone."""
    import numpy as np

    from tidemark.operators import walkforward

    days = np.arange(8.0)
    models = {size: {"days": days, "folds": np.array([0, 2]), "valid": np.array([50, n])} for size, n in ((3, 40), (4, 60), (7, 100), (9, 170))}
    assert walkforward._groups(models, 5, 100) == [(5.0, [3, 4]), (5.0, [7, 9]), (7.0, [3, 4]), (7.0, [7]), (7.0, [9])]
    rows = spark.range(5000).select(
        F.lit(3).alias("size_from"), (F.col("id") % 3 + 3).cast("int").alias("size_to"), F.add_months(F.lit("2001-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("window_end"),
        F.floor(F.rand(1) * 50).alias("a"), F.rand(5).alias("b"), (F.rand(2) < 0.3).cast("int").alias("y"),
    )
    rows = staged(rows, "rows")
    by_scores = {(r.window_size, r.fold): r.auc for r in walkforward.fold_aucs(rows, ["a", "b"], "y", 5, 1).collect()}
    monkeypatch.setattr(walkforward, "_scores", None)
    got = {(r.window_size, r.fold): r.auc for r in walkforward.fold_aucs(rows, ["a", "b"], "y", 5).collect()}
    assert got.keys() == by_scores.keys() and len(got) == 6 and all(abs(got[k] - v) < 1e-12 for k, v in by_scores.items())
