"""Feature queries: the monthly level, the window grid and everything on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import features as X
from tidemark.plans import views as V
from tidemark.plans.registry import query, rounded, rounded_double, rounded_positive, sql_round
from tidemark.plans.views import DATA_START, T_OBS
from tidemark.sources.tables import staged

SIZES = (3, 6, 12)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.agg_monthly(V.cust_month(spark, sf_dir), DATA_START)


def in_windows(spark: SparkSession, sf_dir: str, sizes=SIZES) -> DataFrame:
    return X.to_windows(monthly(spark, sf_dir), F.col("report_month"), DATA_START, T_OBS, sizes)


def sent_items(spark: SparkSession, sf_dir: str, reads: Sequence[str] | None = None) -> DataFrame:
    """The items, joined once and written in the few columns that all levels read, or in those that are named."""
    items = V.items(spark, sf_dir)
    return staged(items.drop("item_code", "rec_province", "region") if reads is None else items.select(*reads), "items")


def features(spark: SparkSession, sf_dir: str, sizes=(3,), start: str = DATA_START, with_months: bool = True, columns=None, items: DataFrame | None = None) -> DataFrame:
    """``items``: those of ``sent_items``, if they are there; else they are joined in the columns that the features read, and written
    where more is read of them than months."""
    months, codes, days = X.levels_read(columns, with_months)
    if items is None:
        own = V.items(spark, sf_dir).select(*dict.fromkeys([*V.month_reads(months), *(("end_date", "complaint", "complaint_code") if codes else ())]))
        items = staged(own, "items") if codes or days else own
    return X.window_features(X.agg_monthly(V.months_of(items), start), V.complaints_of(items) if codes else None, items, start, T_OBS, sizes, with_months, columns)


def window_sums(spark: SparkSession, sf_dir: str, sizes=SIZES) -> DataFrame:
    """item_sum of every window, from one row per customer: no copy of a monthly row is made."""
    return X.agg_window_base(monthly(spark, sf_dir), DATA_START, T_OBS, sizes, measures=("item_sum",))


MONTHLY = """
monthly AS (
  SELECT cust_id, report_month, CAST(item_count AS BIGINT) AS item_sum, total_fee AS revenue_sum, total_complaint AS complaint_sum, delay_count AS delay_sum, nodone AS nodone_sum,
    order_score AS order_score_avg, satisfaction_score AS satisfaction_avg, 1 AS month_record_count, CASE WHEN total_complaint > 0 THEN 1 ELSE 0 END AS months_with_complaint,
    CAST(weight_kg AS DOUBLE) AS weight_sum, CAST(delay_day AS DOUBLE) AS delay_day_sum, CAST(refunded AS DOUBLE) AS refund_sum, CAST(noaccepted AS DOUBLE) AS noaccepted_sum,
    CAST(lost_order AS DOUBLE) AS lost_sum, CAST(intra_province AS DOUBLE) AS intra_prov_sum, CAST(international AS DOUBLE) AS intl_sum, CAST(lastday AS DOUBLE) AS avg_lastday,
    ser_c, ser_e, ser_m, ser_p, ser_r, ser_u, ser_l, ser_q, CAST(year(report_month) % 100 * 100 + month(report_month) AS INT) AS month_key
  FROM cust_month WHERE report_month >= DATE '1995-01-01')
"""


def grid_sql(sizes=SIZES, start: str = DATA_START) -> str:
    """The CTEs grid (windows) and held (monthly rows in windows)."""
    return f"""
ends AS (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{T_OBS}', INTERVAL 1 MONTH)) AS DATE) AS window_end),
sizes AS (SELECT unnest([{", ".join(map(str, sizes))}]) AS window_size),
grid AS (
  SELECT * FROM (SELECT window_size, window_end, CAST(window_end - to_months(CAST(window_size - 1 AS INT)) AS DATE) AS window_start FROM ends, sizes)
  WHERE window_start >= DATE '{start}'),
held AS (SELECT m.*, g.window_size, g.window_end FROM monthly m JOIN grid g ON m.report_month >= g.window_start AND m.report_month <= g.window_end)
"""


@query("agg_monthly", f"WITH {MONTHLY} SELECT * REPLACE ({sql_round('order_score_avg', 'satisfaction_avg')}) FROM monthly")
def agg_monthly(spark, sf_dir):
    return rounded(monthly(spark, sf_dir))


@query(
    "window_grid",
    f"WITH {MONTHLY}, {grid_sql()} SELECT window_size, window_start, window_end, 'cus_feature_' || window_size || 'm_' || strftime(window_start, '%y%m') || '_' || strftime(window_end, '%y%m') AS name"
    " FROM grid WHERE EXISTS (SELECT 1 FROM held h WHERE h.window_size = grid.window_size AND h.window_end = grid.window_end)",
)
def window_grid(spark, sf_dir):
    used = in_windows(spark, sf_dir).select("window_size", "window_end").distinct()
    return X.window_grid(spark, DATA_START, T_OBS, SIZES).join(used, ["window_size", "window_end"], "left_semi").select("window_size", "window_start", "window_end", "name")


@query(
    "join_window_range",
    f"WITH {MONTHLY}, {grid_sql()} SELECT window_size, window_end, count(*) AS n_rows, count(DISTINCT cust_id) AS n_customers, CAST(sum(item_sum) AS BIGINT) AS items, CAST(sum(revenue_sum) AS BIGINT) AS revenue FROM held GROUP BY 1, 2",
)
def join_window_range(spark, sf_dir):
    return X.window_totals(monthly(spark, sf_dir), DATA_START, T_OBS, SIZES)


@query(
    "win_sliding_months",
    f"WITH {MONTHLY}, {grid_sql()} SELECT cust_id, window_end, window_size, CAST(sum(item_sum) AS BIGINT) AS items, CAST(sum(revenue_sum) AS BIGINT) AS revenue"
    " FROM held WHERE EXISTS (SELECT 1 FROM monthly m WHERE m.cust_id = held.cust_id AND m.report_month = held.window_end) GROUP BY 1, 2, 3",
)
def win_sliding_months(spark, sf_dir):
    from tidemark.operators.windows import sliding_months

    return sliding_months(monthly(spark, sf_dir), SIZES, DATA_START, T_OBS)


_BASE_COLUMNS = """count(*) AS month_count,
  CAST(sum(item_sum) AS BIGINT) AS item_sum, avg(item_sum) AS item_avg, stddev_pop(item_sum) AS item_std, quantile_cont(item_sum, 0.5) AS item_median, max(item_sum) AS item_max, min(item_sum) AS item_min,
  CAST(sum(revenue_sum) AS BIGINT) AS revenue_sum, avg(revenue_sum) AS revenue_avg, stddev_pop(revenue_sum) AS revenue_std, quantile_cont(revenue_sum, 0.5) AS revenue_median, max(revenue_sum) AS revenue_max, min(revenue_sum) AS revenue_min,
  CAST(sum(complaint_sum) AS BIGINT) AS complaint_sum, avg(complaint_sum) AS complaint_avg, stddev_pop(complaint_sum) AS complaint_std, quantile_cont(complaint_sum, 0.5) AS complaint_median, max(complaint_sum) AS complaint_max, min(complaint_sum) AS complaint_min,
  CAST(sum(months_with_complaint) AS BIGINT) AS months_with_complaint_ct, sum(weight_sum) AS weight_sum, avg(weight_sum) AS weight_avg, stddev_pop(weight_sum) AS weight_std,
  CAST(sum(delay_sum) AS DOUBLE) AS delay_sum, count(*) FILTER (delay_sum > 0) AS delay_count_ct, sum(delay_day_sum) AS delay_day_sum, sum(refund_sum) AS refund_sum,
  sum(noaccepted_sum) AS noaccepted_sum, sum(lost_sum) AS lost_sum, CAST(sum(nodone_sum) AS DOUBLE) AS nodone_sum, sum(intra_prov_sum) AS intra_prov_sum, sum(intl_sum) AS intl_sum,
  avg(order_score_avg) AS order_score_avg, stddev_pop(order_score_avg) AS order_score_std, avg(satisfaction_avg) AS satisfaction_avg, stddev_pop(satisfaction_avg) AS satisfaction_std,
  count(DISTINCT CASE WHEN item_sum > 0 THEN month_key END) AS active_months, avg(avg_lastday) AS avg_lastday,
  CAST(sum(ser_c) AS BIGINT) AS ser_c_sum, CAST(sum(ser_e) AS BIGINT) AS ser_e_sum, CAST(sum(ser_m) AS BIGINT) AS ser_m_sum, CAST(sum(ser_p) AS BIGINT) AS ser_p_sum,
  CAST(sum(ser_r) AS BIGINT) AS ser_r_sum, CAST(sum(ser_u) AS BIGINT) AS ser_u_sum, CAST(sum(ser_l) AS BIGINT) AS ser_l_sum, CAST(sum(ser_q) AS BIGINT) AS ser_q_sum"""

_BASE_DOUBLES = (
    "item_avg item_std item_median revenue_avg revenue_std revenue_median complaint_avg complaint_std complaint_median weight_sum weight_avg weight_std delay_sum delay_day_sum"
    " refund_sum noaccepted_sum lost_sum nodone_sum intra_prov_sum intl_sum order_score_avg order_score_std satisfaction_avg satisfaction_std avg_lastday"
).split()


@query(
    "agg_window_base",
    f"WITH {MONTHLY}, {grid_sql()}, base AS (SELECT cust_id, window_size, window_end, {_BASE_COLUMNS} FROM held GROUP BY 1, 2, 3) SELECT * REPLACE ({sql_round(*_BASE_DOUBLES)}) FROM base",
)
def agg_window_base(spark, sf_dir):
    return rounded_positive(X.agg_window_base(monthly(spark, sf_dir), DATA_START, T_OBS, SIZES))


@query(
    "agg_percentile_exact",
    f"WITH {MONTHLY} SELECT cust_id, round(quantile_cont(item_sum, 0.5), 6) AS item_median, round(quantile_cont(revenue_sum, 0.9), 6) AS revenue_p90 FROM monthly GROUP BY 1",
)
def agg_percentile_exact(spark, sf_dir):
    return rounded(monthly(spark, sf_dir).groupBy("cust_id").agg(F.percentile("item_sum", 0.5).alias("item_median"), F.percentile("revenue_sum", 0.9).alias("revenue_p90")))


@query(
    "agg_count_distinct",
    "SELECT cust_id, count(DISTINCT CASE WHEN complaint = 1 THEN send_date END) AS complaint_days, count(DISTINCT complaint_code) AS codes, count(DISTINCT send_date) AS days FROM items GROUP BY 1",
)
def agg_count_distinct(spark, sf_dir):
    return V.items(spark, sf_dir).groupBy("cust_id").agg(
        F.countDistinct(F.when(F.col("complaint") == 1, F.col("send_date"))).alias("complaint_days"), F.countDistinct("complaint_code").alias("codes"), F.countDistinct("send_date").alias("days")
    )


@query(
    "agg_mode",
    "SELECT cust_id, complaint_code AS most_common FROM (SELECT cust_id, complaint_code, row_number() OVER (PARTITION BY cust_id ORDER BY count(*) DESC, complaint_code) AS r FROM complaints GROUP BY 1, 2) WHERE r = 1",
)
def agg_mode(spark, sf_dir):
    return V.complaints(spark, sf_dir).groupBy("cust_id").agg(F.mode("complaint_code", True).alias("most_common"))


@query(
    "agg_conditional",
    "SELECT cust_id, CAST(sum(CASE WHEN delay_count > 0 THEN delay_day ELSE 0 END) AS BIGINT) AS late_days, count(*) FILTER (delay_count > 0) AS late_months, count(CASE WHEN total_complaint > 0 THEN 1 END) AS complaint_months FROM cust_month GROUP BY 1",
)
def agg_conditional(spark, sf_dir):
    late = F.col("delay_count") > 0
    return V.cust_month(spark, sf_dir).groupBy("cust_id").agg(
        F.sum(F.when(late, F.col("delay_day")).otherwise(0)).alias("late_days"), F.count_if(late).alias("late_months"), F.count(F.when(F.col("total_complaint") > 0, 1)).alias("complaint_months")
    )


@query(
    "agg_ratio_of_sums",
    "SELECT cust_id, round(coalesce(CAST(sum(total_fee) AS DOUBLE) / nullif(sum(item_count), 0), 0), 6) AS fee_per_item, round(coalesce(1 - CAST(sum(nodone) AS DOUBLE) / nullif(sum(item_count), 0), 0), 6) AS done_share FROM cust_month GROUP BY 1",
)
def agg_ratio_of_sums(spark, sf_dir):
    n = F.sum("item_count")
    return rounded(V.cust_month(spark, sf_dir).groupBy("cust_id").agg(S.safe_ratio(F.sum("total_fee"), n).alias("fee_per_item"), (1 - S.safe_ratio(F.sum("nodone"), n)).alias("done_share")))


_EXTREMES = """
  SELECT cust_id, window_size, window_end,
    arg_max(month_key, (item_sum, report_month)) AS item_max_month, arg_min(month_key, (item_sum, -epoch(report_month))) AS item_min_month,
    arg_max(month_key, (revenue_sum, report_month)) AS revenue_max_month, arg_min(month_key, (revenue_sum, -epoch(report_month))) AS revenue_min_month,
    arg_max(month_key, (coalesce(complaint_sum, -1), report_month)) AS complaint_max_month, arg_min(month_key, (coalesce(complaint_sum, -1), -epoch(report_month))) AS complaint_min_month,
    arg_max(month_key, (coalesce(order_score_avg, -1), report_month)) AS order_max_month, arg_min(month_key, (coalesce(order_score_avg, -1), -epoch(report_month))) AS order_min_month,
    arg_max(month_key, (coalesce(satisfaction_avg, -1), report_month)) AS satisfaction_max_month, arg_min(month_key, (coalesce(satisfaction_avg, -1), -epoch(report_month))) AS satisfaction_min_month
  FROM held GROUP BY 1, 2, 3"""


@query("win_extreme_months", f"WITH {MONTHLY}, {grid_sql()} {_EXTREMES}")
def win_extreme_months(spark, sf_dir):
    return X.win_extreme_months(monthly(spark, sf_dir), DATA_START, T_OBS, SIZES)


def _pivot_sql(size: int) -> str:
    out = []
    for k in range(size):
        for m in X.PIVOTS:
            c = {"order_score": "order_score_avg", "satisfaction": "satisfaction_avg"}.get(m, f"{m}_sum")
            v = f"coalesce(max(CASE WHEN date_diff('month', report_month, window_end) = {k} THEN {c} END), 0)"
            out.append((f"round({v}, 9)" if c.endswith("_avg") else v) + f" AS {m}_{'last' if k == 0 else f'{k}m_ago'}")
    return ", ".join(out)


@query("win_pivot_months", f"WITH {MONTHLY}, {grid_sql()} SELECT cust_id, window_size, window_end, {_pivot_sql(3)} FROM held WHERE window_size = 3 GROUP BY 1, 2, 3")
def win_pivot_months(spark, sf_dir):
    return rounded(X.win_pivot_months(in_windows(spark, sf_dir, (3,)), 3))


def _slope_sql(c: str, name: str) -> str:
    return f"round(1e9 * CASE WHEN regr_count({c}, epoch(report_month)) > 1 THEN coalesce(regr_slope(CAST({c} AS DOUBLE), (epoch(report_month) - epoch(window_end))), 0) ELSE 0 END, 3) + 0.0::DOUBLE AS {name}"


_SLOPES = (("item_sum", "item_slope"), ("revenue_sum", "revenue_slope"), ("satisfaction_avg", "satisfy_slope"), ("complaint_sum", "complaint_slope"))


@query("agg_regr_slope", f"WITH {MONTHLY}, {grid_sql()} SELECT cust_id, window_size, window_end, {', '.join(_slope_sql(*s) for s in _SLOPES)} FROM held GROUP BY 1, 2, 3")
def agg_regr_slope(spark, sf_dir):
    got = X.window_slopes(monthly(spark, sf_dir), DATA_START, T_OBS, SIZES)
    return got.withColumns({n: F.round(F.col(n) * 1e9, 3) + F.lit(0.0) for _, n in _SLOPES})


_COMPLAINT_STATS = """
cheld AS (SELECT c.*, g.window_size, g.window_end FROM complaints c JOIN grid g ON c.create_date >= g.window_start AND c.create_date <= g.window_end),
cstats AS (
  SELECT cust_id, window_size, window_end, count(DISTINCT complaint_code) AS complaint_diversity, min(CASE WHEN r = 1 THEN complaint_code END) AS most_common_complaint
  FROM (SELECT *, row_number() OVER (PARTITION BY cust_id, window_size, window_end ORDER BY n DESC, complaint_code) AS r
        FROM (SELECT cust_id, window_size, window_end, complaint_code, count(*) AS n FROM cheld GROUP BY 1, 2, 3, 4)) GROUP BY 1, 2, 3)
"""


@query("complaint_stats", f"WITH {MONTHLY}, {grid_sql()}, {_COMPLAINT_STATS} SELECT * FROM cstats")
def complaint_stats(spark, sf_dir):
    return X.complaint_stats(V.complaints(spark, sf_dir), DATA_START, T_OBS, SIZES)


_SEND_STATS = """
sent AS (SELECT DISTINCT cust_id, send_date FROM items),
dstats AS (
  SELECT cust_id, window_size, window_end, CAST(count(*) AS INT) AS active_days, CAST(any_value(window_end - window_start) + 1 AS INT) AS window_days, CAST(window_end - max(send_date) AS INT) AS recency_days
  FROM sent s JOIN grid g ON s.send_date >= g.window_start AND s.send_date <= g.window_end GROUP BY 1, 2, 3)
"""


@query("send_day_stats", f"WITH {MONTHLY}, {grid_sql()}, {_SEND_STATS} SELECT * FROM dstats")
def send_day_stats(spark, sf_dir):
    return X.send_day_stats(V.items(spark, sf_dir), DATA_START, T_OBS, SIZES)


_SER = [f"ser_{s}_sum" for s in X.SERVICES]
_TOP = f"greatest({', '.join(_SER)})"
_MIX = (
    f"({' + '.join(f'CASE WHEN {s} > 0 THEN 1 ELSE 0 END' for s in _SER)}) AS service_types_used, "
    f"CASE {' '.join(f'WHEN {s} >= {_TOP} THEN {chr(39)}{s[4].upper()}{chr(39)}' for s in _SER)} ELSE 'E' END AS dominant_service, "
    f"round(coalesce(CAST({_TOP} AS DOUBLE) / nullif({' + '.join(_SER)}, 0), 0), 6) AS dominant_service_ratio"
)
_RATIO = lambda a, b, n: f"round(coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0), 6) AS {n}"
_RATIOS = ", ".join([
    _RATIO("revenue_sum", "item_sum", "avg_revenue_per_item"), _RATIO("weight_sum", "item_sum", "avg_weight_per_item"), _RATIO("delay_sum", "item_sum", "pct_delay"),
    _RATIO("refund_sum", "item_sum", "pct_refund"), _RATIO("noaccepted_sum", "item_sum", "pct_noaccepted"), _RATIO("lost_sum", "item_sum", "pct_lost_order"),
    _RATIO("complaint_sum", "item_sum", "pct_complaint"), _RATIO("months_with_complaint_ct", "month_count", "pct_complaint_per_item"),
    _RATIO("(item_sum - nodone_sum)", "item_sum", "pct_successful_item"), _RATIO("intra_prov_sum", "item_sum", "pct_intra_province"),
    _RATIO("intl_sum", "item_sum", "pct_international"), _RATIO("delay_day_sum", "delay_count_ct", "avg_delayday"),
])
_VOLATILITY = f"{_RATIO('item_std', 'item_avg', 'cv_item')}, {_RATIO('revenue_std', 'revenue_avg', 'cv_revenue')}, item_max - item_min AS item_range, revenue_max - revenue_min AS revenue_range"
_ACTIVITY = (
    "window_size - active_months AS inactive_months, coalesce(active_days, 0) AS active_days, window_days - coalesce(active_days, 0) AS inactive_days, "
    "round((window_days - coalesce(active_days, 0)) / greatest(ceil(window_days / 30.0), 1), 6) AS avg_noservice_days, 0 AS max_consecutive_inactive"
)
_RFM = f"coalesce(recency_days, 0) AS recency, {_RATIO('item_sum', 'active_months', 'frequency')}, {_RATIO('revenue_sum', 'active_months', 'monetary')}"
_BASE_CTE = f"base AS (SELECT cust_id, window_size, window_end, {_BASE_COLUMNS} FROM held GROUP BY 1, 2, 3)"


def _on_base(name: str, columns: Sequence[str], sql: str, extra: str = "", source: str = "base") -> None:
    @query(name, f"WITH {MONTHLY}, {grid_sql()}, {_BASE_CTE}{extra} SELECT cust_id, window_size, window_end, {sql} FROM {source}")
    def run(spark, sf_dir):
        if extra:
            return rounded_positive(features(spark, sf_dir, SIZES, with_months=False, columns=columns))
        items = V.items(spark, sf_dir)  # read for the months alone
        return rounded_positive(X.window_features(monthly(spark, sf_dir), V.complaints_of(items), items, DATA_START, T_OBS, SIZES, False, columns))


_on_base("service_mix", X.FAMILIES["service_mix"], _MIX)
_on_base("pct_family", X.FAMILIES["ratios"], _RATIOS)
_on_base("volatility", X.FAMILIES["volatility"], _VOLATILITY)
_on_base("agg_rfm_counts", X.FAMILIES["activity"], _ACTIVITY, f", {_SEND_STATS}", "base LEFT JOIN dstats USING (cust_id, window_size, window_end)")
_on_base("agg_rfm", X.FAMILIES["rfm"], _RFM, f", {_SEND_STATS}", "base LEFT JOIN dstats USING (cust_id, window_size, window_end)")
_on_base("max_consecutive_inactive", ("max_consecutive_inactive",), "0 AS max_consecutive_inactive")

_FEATURE_BASE = [c for c in _BASE_DOUBLES]
_FEATURES_SQL = (
    f"SELECT cust_id, window_size, window_end, item_sum, revenue_sum, complaint_sum, active_months, {', '.join(_SER)}, {sql_round(*_BASE_DOUBLES)}, "
    "item_max_month, item_min_month, revenue_max_month, revenue_min_month, complaint_max_month, complaint_min_month, order_max_month, order_min_month, satisfaction_max_month, satisfaction_min_month, "
    f"item_slope, revenue_slope, satisfy_slope, complaint_slope, most_common_complaint, coalesce(complaint_diversity, 0) AS complaint_diversity, {_RATIOS}, {_VOLATILITY}, {_ACTIVITY}, {_MIX}, {_RFM} "
    "FROM base LEFT JOIN ext USING (cust_id, window_size, window_end) LEFT JOIN slopes USING (cust_id, window_size, window_end) "
    "LEFT JOIN cstats USING (cust_id, window_size, window_end) LEFT JOIN dstats USING (cust_id, window_size, window_end)"
)
_ALL_PARTS = (
    f"{MONTHLY}, {grid_sql()}, {_BASE_CTE}, ext AS ({_EXTREMES}), "
    f"slopes AS (SELECT cust_id, window_size, window_end, {', '.join(_slope_sql(*s) for s in _SLOPES)} FROM held GROUP BY 1, 2, 3), {_COMPLAINT_STATS}, {_SEND_STATS}"
)
#: The feature rows as a CTE for other queries' oracles.
FEATURES_CTE = f"{_ALL_PARTS}, features AS ({_FEATURES_SQL})"


@query("window_features", f"WITH {FEATURES_CTE} SELECT * FROM features")
def window_features(spark, sf_dir):
    got = features(spark, sf_dir, SIZES, with_months=False)
    slopes = [n for _, n in _SLOPES]
    scaled = [(F.round(F.col(n) * 1e9, 3) + F.lit(0.0)).alias(n) for n in slopes]
    return rounded_positive(got.withColumns({n: F.struct(c.alias("v")) for n, c in zip(slopes, scaled)})).withColumns({n: F.col(f"{n}.v") for n in slopes})


@query("join_left_star", f"WITH {FEATURES_CTE} SELECT cust_id, window_size, window_end, item_sum, recency, complaint_diversity, item_max_month, item_slope FROM features WHERE window_size = 6")
def join_left_star(spark, sf_dir):
    got = features(spark, sf_dir, (6,), with_months=False, columns=("item_sum", "recency", "complaint_diversity", "item_max_month", "item_slope"))
    return got.select(*X.WINDOW_KEY, "item_sum", "recency", "complaint_diversity", "item_max_month", (F.round(F.col("item_slope") * 1e9, 3) + F.lit(0.0)).alias("item_slope"))


def _ewma_sql(metric: str, size: int, alpha: float = 0.3) -> str:
    """Closed form of the recursion over months ago."""
    c = {"order_score": "order_score_avg", "satisfaction": "satisfaction_avg"}.get(metric, f"{metric}_sum")
    v = lambda k: f"coalesce(max(CASE WHEN date_diff('month', report_month, window_end) = {k} THEN {c} END), 0)"
    terms = lambda first: " + ".join([f"{alpha * (1 - alpha) ** (k - first)!r}::DOUBLE * {v(k)}" for k in range(first, size - 1)] + [f"{(1 - alpha) ** (size - 1 - first)!r}::DOUBLE * {v(size - 1)}"])
    return f"round({terms(0)}, {11 if metric in X._PIVOT_SOURCE else 6}) + 0.0::DOUBLE AS ewma_{{n}}, round(({terms(0)}) - ({terms(1)}), {11 if metric in X._PIVOT_SOURCE else 6}) + 0.0::DOUBLE AS delta_ewma_{{n}}"


def _trend(name: str, trends: dict[str, str]) -> None:
    sql = ", ".join(_ewma_sql(source, 6).format(n=n) for n, source in trends.items())

    @query(name, f"WITH {MONTHLY}, {grid_sql((6,))} SELECT cust_id, window_size, window_end, {sql} FROM held GROUP BY 1, 2, 3")
    def run(spark, sf_dir):
        series = X.month_series_arrays(monthly(spark, sf_dir), DATA_START, T_OBS, (6,), list(dict.fromkeys(trends.values())))
        got = series
        for n, source in trends.items():
            got = got.withColumn("__e", X.ewma(F.col(f"{source}_months"), 0.3, 6)).withColumns({f"ewma_{n}": F.col("__e.ewma"), f"delta_ewma_{n}": F.col("__e.delta")}).drop("__e")
        got = got.drop(*[f"{s}_months" for s in trends.values()])
        exact = [c for c, t in got.dtypes if t == "double" and ("score" in c or "satisf" in c)]
        return got.withColumns({c: rounded_double(c, 11 if c in exact else 6) for c, t in got.dtypes if t == "double"})


_trend("win_ewma", {("order_score" if n == "order" else n): c for n, c in X.TREND_SOURCES.items()})
_trend("win_ewma_delta", {"item": "item", "revenue": "revenue"})

AS_OF = "2001-09-01"
_LIFE_RATE = lambda c, n: f"round(coalesce(CAST(sum({c}) AS DOUBLE) / nullif(sum(item_count), 0), 0), 6) AS {n}"
_LIFE_SER = [f"ser_{s}" for s in X.SERVICES]
_LIFE_TOP = f"greatest({', '.join(_LIFE_SER)})"
LIFETIME_CTE = f"""
life AS (
  SELECT cust_id, CAST(sum(item_count) AS BIGINT) AS lifetime_total_items, CAST(sum(total_fee) AS BIGINT) AS lifetime_total_revenue, CAST(sum(weight_kg) AS DOUBLE) AS lifetime_total_weight,
    CAST(sum(total_complaint) AS BIGINT) AS lifetime_total_complaint, {_LIFE_RATE('total_fee', 'lifetime_avg_revenue_per_item')}, {_LIFE_RATE('weight_kg', 'lifetime_avg_weight_per_item')},
    count(report_month) AS lifetime_months_active, min(report_month) AS first_month, {_LIFE_RATE('delay_count', 'lifetime_pct_delay')}, {_LIFE_RATE('refunded', 'lifetime_pct_refund')},
    {_LIFE_RATE('noaccepted', 'lifetime_pct_noaccepted')}, {_LIFE_RATE('lost_order', 'lifetime_pct_lost_order')}, {_LIFE_RATE('total_complaint', 'lifetime_pct_complaint')},
    round(coalesce(1 - CAST(sum(nodone) AS DOUBLE) / nullif(sum(item_count), 0), 0), 6) AS lifetime_pct_successful_item,
    round(coalesce(CAST(sum(CASE WHEN delay_count > 0 THEN delay_day ELSE 0 END) AS DOUBLE) / nullif(count(*) FILTER (delay_count > 0), 0), 0), 6) AS lifetime_avg_delayday,
    round(coalesce(avg(order_score), 0), 9) AS lifetime_avg_order_score, round(coalesce(avg(satisfaction_score), 0), 9) AS lifetime_avg_satisfaction,
    {_LIFE_RATE('international', 'lifetime_pct_international')}, round(coalesce(CAST(count(*) FILTER (intra_province = 1) AS DOUBLE) / nullif(sum(item_count), 0), 0), 6) AS lifetime_pct_intra_province,
    {', '.join(f'CAST(sum({s}) AS BIGINT) AS {s}' for s in _LIFE_SER)}
  FROM cust_month GROUP BY cust_id),
ranked AS (SELECT cust_id, rec_province, row_number() OVER (PARTITION BY cust_id ORDER BY count(*) DESC, rec_province) AS r FROM items GROUP BY 1, 2),
rankedr AS (SELECT cust_id, region, row_number() OVER (PARTITION BY cust_id ORDER BY count(*) DESC, region) AS r FROM items GROUP BY 1, 2),
sent_l AS (
  SELECT cust_id, count(DISTINCT send_date) AS lifetime_days_active, coalesce(CAST(count(*) FILTER (complaint > 0) AS DOUBLE) / nullif(count(*), 1), 0) AS lifetime_pct_complaint_per_item FROM items GROUP BY 1),
lifetime AS (
  SELECT cust_id, substr(CAST(cust_id AS VARCHAR), 1, 1) = 'T' AS is_corporate, coalesce(custype, 1) AS custype, coalesce(contract_date, first_month) AS contract_sig_first,
    coalesce(tenure, CAST(date_diff('month', coalesce(contract_date, first_month), DATE '{AS_OF}') - CASE WHEN day(coalesce(contract_date, first_month)) > 1 THEN 1 ELSE 0 END AS INT)) AS tenure,
    province AS cus_province, life.* EXCLUDE (cust_id, first_month, {', '.join(_LIFE_SER)}), coalesce(lifetime_days_active, 0) AS lifetime_days_active,
    round(coalesce(lifetime_pct_complaint_per_item, 0), 6) AS lifetime_pct_complaint_per_item, {' + '.join(f'CASE WHEN {s} > 0 THEN 1 ELSE 0 END' for s in _LIFE_SER)} AS lifetime_service_types_count,
    CASE WHEN {_LIFE_TOP} = 0 THEN 'U' {' '.join(f"WHEN {s} >= {_LIFE_TOP} THEN '{s[4].upper()}'" for s in _LIFE_SER)} ELSE 'U' END AS lifetime_dominant_service,
    coalesce(ranked.rec_province, 0) AS most_common_rec_province, coalesce(CAST(rankedr.region AS VARCHAR), 'N/A') AS most_common_region
  FROM life LEFT JOIN cust_info USING (cust_id) LEFT JOIN sent_l USING (cust_id) LEFT JOIN (SELECT * FROM ranked WHERE r = 1) ranked USING (cust_id) LEFT JOIN (SELECT * FROM rankedr WHERE r = 1) rankedr USING (cust_id))
"""


def lifetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = staged(V.items(spark, sf_dir), "items")
    return X.lifetime_features(V.months_of(items), V.cust_info(spark, sf_dir), items, AS_OF)


@query("lifetime_features", f"WITH {LIFETIME_CTE} SELECT * FROM lifetime")
def lifetime_features(spark, sf_dir):
    return rounded(lifetime(spark, sf_dir))


@query("join_left_lifetime", f"WITH {LIFETIME_CTE} SELECT cust_id, lifetime_total_items, lifetime_days_active, custype, tenure FROM lifetime")
def join_left_lifetime(spark, sf_dir):
    return lifetime(spark, sf_dir).select("cust_id", "lifetime_total_items", "lifetime_days_active", "custype", "tenure")


@query("lifetime_complaint_per_item", f"WITH {LIFETIME_CTE} SELECT cust_id, lifetime_pct_complaint_per_item FROM lifetime")
def lifetime_complaint_per_item(spark, sf_dir):
    return rounded(lifetime(spark, sf_dir).select("cust_id", "lifetime_pct_complaint_per_item"))


@query(
    "agg_distinct_on",
    "SELECT o_custkey AS cust_id, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1",
    views=False,
)
def agg_distinct_on(spark, sf_dir):
    from tidemark.operators.ingest import dedup_natural_key

    newest = dedup_natural_key(V.table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()])
    return newest.select(F.col("o_custkey").alias("cust_id"), "o_orderkey", "o_totalprice")


_MOMENTS = ("item_sum", "item_avg", "revenue_avg", "complaint_sum", "pct_delay", "order_score_avg", "satisfaction_avg", "active_months", "cv_item", "recency", "frequency", "monetary")
_PAIR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(avg(coalesce({a}, 0)), 4) + 0.0::DOUBLE AS mean_a, round(covar_samp(coalesce({b}, 0), coalesce({a}, 0)), 2) + 0.0::DOUBLE AS cov FROM f" for a in _MOMENTS for b in _MOMENTS
)


@query("agg_two_level_moments", f"WITH {FEATURES_CTE}, f AS (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _MOMENTS)} FROM features WHERE window_size = 3) {_PAIR_SQL}")
def agg_two_level_moments(spark, sf_dir):
    """Means and covariances of window features over all windows of three months."""
    from tidemark.operators.prep import mean_and_covariance

    got = mean_and_covariance(rounded(features(spark, sf_dir, (3,), with_months=False, columns=_MOMENTS)), _MOMENTS)
    return got.withColumns({"mean_a": F.round("mean_a", 4) + F.lit(0.0), "cov": F.round("cov", 2) + F.lit(0.0)})
