"""Queries on predicates, joins, training sets, profiles, monitoring, models and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import eda as E
from tidemark.operators import features as X
from tidemark.operators import model as M
from tidemark.operators import monitor as N
from tidemark.operators import pipeline as L
from tidemark.operators import prep as P
from tidemark.operators import reasons as Y
from tidemark.operators import report as T
from tidemark.operators import walkforward as C
from tidemark.operators import windows as W
from tidemark.operators.ranks import percentiles
from tidemark.plans import views as V
from tidemark.plans.feature_queries import FEATURES_CTE, LIFETIME_CTE, MONTHLY, SIZES, grid_sql, in_windows, lifetime, monthly, sent_items, window_sums
from tidemark.plans.feature_queries import features as feature_rows
from tidemark.plans.registry import query, rounded, sql_round
from tidemark.plans.views import DATA_START, T_OBS
from tidemark.sources import readers as R
from tidemark.sources import sinks as K
from tidemark.sources.published import published
from tidemark.sources.tables import methods_that_compile, shared_path, staged

#: Month of observation of the monthly run before the last one.
EARLIER_OBS = "2001-06-01"

# A rule-based score per customer; the same text in both engines but for the difference of days.
_SCORED = """
SELECT cust_id, recency_days, round(recency_days / (recency_days + 120.0), 6) AS p, CASE WHEN cust_id * 7919 % 100 < floor(100.0 * recency_days / (recency_days + 120.0)) THEN 1 ELSE 0 END AS y,
  round(100.0 * recency_days / (recency_days + 120.0), 4) AS churn_rate, items AS item_last, revenue AS revenue_last,
  CASE WHEN recency_days > 180 THEN 'Not seen' WHEN complaints > 2 THEN 'Complaints' END AS reason_1, CASE WHEN delays > 6 THEN 'Delays' END AS reason_2, CASE WHEN items < 25 THEN 'Few items' END AS reason_3,
  CASE WHEN recency_days >= 90 THEN 1 ELSE 0 END AS churn_flag, last_month
FROM (SELECT cust_id, CAST({days} AS DOUBLE) AS recency_days, max(report_month) AS last_month, CAST(sum(item_count) AS BIGINT) AS items, CAST(sum(total_fee) AS BIGINT) AS revenue, sum(total_complaint) AS complaints, sum(delay_count) AS delays
      FROM {t} WHERE report_month <= DATE '2001-07-01' GROUP BY cust_id)"""
SCORED = f"scored AS ({_SCORED.format(days='DATE ' + chr(39) + T_OBS + chr(39) + ' - max(report_month)', t='cust_month')}), risk AS (SELECT * FROM scored WHERE churn_flag = 1)"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = spark.sql(_SCORED.format(days="datediff(DATE '2001-07-01', max(report_month))", t="{m}"), m=V.cust_month(spark, sf_dir))
    return got.withColumns({"p": F.col("p").cast("double"), "churn_rate": F.col("churn_rate").cast("double")})


def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).where("churn_flag = 1")


# Predicates and projections


@query("filter_date_range", "SELECT cust_id, report_month, item_count FROM cust_month WHERE report_month BETWEEN DATE '1997-02-01' AND DATE '1999-05-01'")
def filter_date_range(spark, sf_dir):
    return R.scan_months(V.cust_month(spark, sf_dir), "report_month", "1997-02-01", "1999-05-01").select("cust_id", "report_month", "item_count")


@query("filter_activity_or", "SELECT cust_id, report_month FROM cust_month WHERE total_complaint > 0 OR total_fee > 300000")
def filter_activity_or(spark, sf_dir):
    return V.cust_month(spark, sf_dir).where("total_complaint > 0 OR total_fee > 300000").select("cust_id", "report_month")


@query("filter_min_orders", f"WITH {MONTHLY}, {grid_sql((3,))} SELECT cust_id, window_end, CAST(sum(item_sum) AS BIGINT) AS item_sum FROM held GROUP BY 1, 2 HAVING sum(item_sum) >= 5")
def filter_min_orders(spark, sf_dir):
    return window_sums(spark, sf_dir, (3,)).select("cust_id", "window_end", "item_sum").where("item_sum >= 5")


@query("filter_tier", f"WITH {SCORED} SELECT cust_id, recency_days FROM scored WHERE recency_days <= 90")
def filter_tier(spark, sf_dir):
    return scored(spark, sf_dir).where(P.tier(F.col("recency_days")) == "active").select("cust_id", "recency_days")


@query("proj_case_bucket", f"WITH {SCORED} SELECT cust_id, CASE WHEN churn_rate >= 90 THEN '90-100%' WHEN churn_rate >= 80 THEN '80-90%' WHEN churn_rate >= 70 THEN '70-80%' ELSE '<70%' END AS b FROM scored")
def proj_case_bucket(spark, sf_dir):
    return scored(spark, sf_dir).select("cust_id", S.bucket(F.col("churn_rate"), T.BUCKETS, "<70%").alias("b"))


@query("proj_safe_ratio", "SELECT cust_id, report_month, round(coalesce(CAST(delay_day AS DOUBLE) / nullif(delay_count, 0), 0), 6) AS late FROM cust_month")
def proj_safe_ratio(spark, sf_dir):
    return rounded(V.cust_month(spark, sf_dir).select("cust_id", "report_month", S.safe_ratio(F.col("delay_day"), F.col("delay_count")).alias("late")))


@query("safe_div_null", "SELECT cust_id, report_month, round(CAST(delay_day AS DOUBLE) / nullif(delay_count, 0), 6) AS late FROM cust_month")
def safe_div_null(spark, sf_dir):
    return rounded(V.cust_month(spark, sf_dir).select("cust_id", "report_month", S.safe_div(F.col("delay_day"), F.col("delay_count").cast("string")).alias("late")))


@query("proj_is_corporate", "SELECT c_name, left(c_name, 1) = 'T' AS is_corporate, left(c_name, 1) = 'C' AS starts_c FROM customer", views=False)
def proj_is_corporate(spark, sf_dir):
    first = F.substring("c_name", 1, 1)
    return V.table(spark, sf_dir, "customer").select("c_name", (first == "T").alias("is_corporate"), (first == "C").alias("starts_c"))


@query("proj_default_fill", "SELECT cust_id, coalesce(custype, 1) AS custype, coalesce(tenure, 0) AS tenure, coalesce(contract_date, DATE '1995-01-01') AS contract_date FROM cust_info")
def proj_default_fill(spark, sf_dir):
    start = F.lit(DATA_START).cast("date")
    return V.cust_info(spark, sf_dir).select("cust_id", F.coalesce("custype", F.lit(1)).alias("custype"), F.coalesce("tenure", F.lit(0)).alias("tenure"), F.coalesce("contract_date", start).alias("contract_date"))


@query("fill_missing_features", "SELECT cust_id, coalesce(tenure, 0) AS tenure, coalesce(custype, 0) AS custype, CAST(0.0 AS DOUBLE) AS absent FROM cust_info")
def fill_missing_features(spark, sf_dir):
    got = V.cust_info(spark, sf_dir).select("cust_id", "tenure", "custype").na.fill(0)
    return got if "absent" in got.columns else got.withColumn("absent", F.lit(0.0))


@query("yymm_math", "WITH m AS (SELECT DISTINCT report_month AS d FROM cust_month) SELECT d, CAST(year(d) % 100 * 100 + month(d) AS INT) AS ym, CAST(year(d + INTERVAL 14 MONTH) % 100 * 100 + month(d + INTERVAL 14 MONTH) AS INT) AS later, CAST(year(d - INTERVAL 5 MONTH) % 100 * 100 + month(d - INTERVAL 5 MONTH) AS INT) AS earlier FROM m")
def yymm_math(spark, sf_dir):
    m = V.cust_month(spark, sf_dir).select(F.col("report_month").alias("d")).distinct().withColumn("ym", S.yymm(F.col("d")))
    return m.withColumns({"later": S.add_months_yymm(F.col("ym"), 14), "earlier": S.add_months_yymm(F.col("ym"), -5)})


@query("month_series", "WITH b AS (SELECT cust_id, min(report_month) AS a, max(report_month) AS z FROM cust_month GROUP BY 1) SELECT cust_id, CAST(unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS DATE) AS m FROM b")
def month_series(spark, sf_dir):
    b = V.cust_month(spark, sf_dir).groupBy("cust_id").agg(F.min("report_month").alias("a"), F.max("report_month").alias("z"))
    return b.select("cust_id", F.explode(F.sequence("a", "z", F.expr("INTERVAL 1 MONTH"))).alias("m"))


@query("scan_table_projection", f"WITH {LIFETIME_CTE} SELECT cust_id, lifetime_total_items, tenure FROM lifetime WHERE lifetime_total_items >= 30")
def scan_table_projection(spark, sf_dir):
    return R.load_working_set(staged(lifetime(spark, sf_dir), "life"), 30).select("cust_id", "lifetime_total_items", "tenure")


_WINDOW_ROWS = f"WITH {MONTHLY}, {grid_sql()}, w AS (SELECT cust_id, window_size, window_end, CAST(sum(item_sum) AS BIGINT) AS item_sum FROM held GROUP BY 1, 2, 3)"


@query("scan_window_features", _WINDOW_ROWS + " SELECT * FROM w WHERE window_size = 6 AND window_end = DATE '2000-10-01'")
def scan_window_features(spark, sf_dir):
    path = shared_path(spark, "windows")
    window_sums(spark, sf_dir).write.partitionBy("window_size", "window_end").parquet(path)
    return R.load_window(spark.read.parquet(path), 6, "2000-10-01").select("cust_id", F.col("window_size").cast("int").alias("window_size"), "window_end", "item_sum")


@query("scan_monthly_snapshots", _WINDOW_ROWS + " SELECT * FROM w WHERE window_size = 3 AND window_end >= DATE '2001-04-01'")
def scan_monthly_snapshots(spark, sf_dir):
    return R.load_snapshots(staged(window_sums(spark, sf_dir), "windows"), 3, 4).select("cust_id", "window_size", "window_end", "item_sum")


# Joins


@query("join_left_label", "WITH f AS (SELECT cust_id, item_count FROM cust_month WHERE report_month = DATE '2001-04-01'), l AS (SELECT DISTINCT cust_id FROM cust_month WHERE report_month BETWEEN DATE '2001-05-01' AND DATE '2001-06-01') SELECT f.*, CASE WHEN l.cust_id IS NULL THEN 0 ELSE 1 END AS active FROM f LEFT JOIN l USING (cust_id)")
def join_left_label(spark, sf_dir):
    m = V.cust_month(spark, sf_dir)
    f = m.where("report_month = DATE '2001-04-01'").select("cust_id", "item_count")
    later = m.where("report_month BETWEEN DATE '2001-05-01' AND DATE '2001-06-01'").select("cust_id").distinct().withColumn("active", F.lit(1))
    return f.join(later, "cust_id", "left").na.fill({"active": 0})


@query("join_left_recency", f"WITH {SCORED} SELECT c_custkey AS cust_id, CAST(coalesce(recency_days, 9999) AS INT) AS recency_days FROM customer LEFT JOIN scored ON c_custkey = cust_id")
def join_left_recency(spark, sf_dir):
    working = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust_id"))
    return P.join_recency(working, P.activity_recency(V.cust_month(spark, sf_dir), T_OBS))


@query("agg_recency", "SELECT cust_id, max(report_month) AS last_month, CAST(DATE '2001-07-01' - max(report_month) AS INT) AS recency_days FROM cust_month WHERE report_month <= DATE '2001-07-01' GROUP BY 1")
def agg_recency(spark, sf_dir):
    return P.activity_recency(V.cust_month(spark, sf_dir), T_OBS)


@query("join_inner_predict", f"WITH {SCORED} SELECT m.cust_id, m.item_count, s.p FROM cust_month m JOIN scored s USING (cust_id) WHERE m.report_month = DATE '2001-06-01'")
def join_inner_predict(spark, sf_dir):
    now = V.cust_month(spark, sf_dir).where("report_month = DATE '2001-06-01'").select("cust_id", "item_count")
    return now.join(scored(spark, sf_dir).select("cust_id", "p"), "cust_id")


_KEYS = "keys AS (SELECT concat(' ', c_custkey) AS crm, concat('C', c_custkey % 700) AS cms FROM customer)"


def _keys(spark, sf_dir):
    c = V.table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit(" "), "c_custkey").alias("crm"), F.concat(F.lit("C"), F.col("c_custkey") % 700).alias("cms"))


@query("join_inner_expr_key", f"WITH {_KEYS} SELECT trim(c.key) AS crm, k.cms FROM confirmed c JOIN keys k ON nullif(trim(c.key), '') = nullif(trim(k.crm), '')")
def join_inner_expr_key(spark, sf_dir):
    a = V.confirmed(spark, sf_dir).select(S.null_key(F.col("key")).alias("crm")).where("crm IS NOT NULL")
    b = _keys(spark, sf_dir).select(S.null_key(F.col("crm")).alias("crm"), "cms").where("crm IS NOT NULL")
    return a.join(b, "crm")


def _confirmed_set(spark, sf_dir):
    return V.confirmed(spark, sf_dir).select(S.null_key(F.col("key")).cast("long").alias("cust_id")).where("cust_id IS NOT NULL").distinct()


_CONF = "conf AS (SELECT DISTINCT CAST(nullif(trim(key), '') AS BIGINT) AS cust_id FROM confirmed WHERE trim(key) <> '')"


@query("join_semi", f"WITH {_CONF} SELECT cust_id, report_month, item_count FROM cust_month WHERE cust_id IN (SELECT cust_id FROM conf)")
def join_semi(spark, sf_dir):
    return V.cust_month(spark, sf_dir).join(_confirmed_set(spark, sf_dir), "cust_id", "left_semi").select("cust_id", "report_month", "item_count")


@query("join_anti", f"WITH {_CONF} SELECT cust_id, report_month, item_count FROM cust_month WHERE cust_id NOT IN (SELECT cust_id FROM conf)")
def join_anti(spark, sf_dir):
    return V.cust_month(spark, sf_dir).join(_confirmed_set(spark, sf_dir), "cust_id", "left_anti").select("cust_id", "report_month", "item_count")


@query("distinct_ids", f"WITH {_CONF} SELECT cust_id FROM conf")
def distinct_ids(spark, sf_dir):
    return _confirmed_set(spark, sf_dir)


@query("set_union_all", "SELECT cust_id, 'a' AS part FROM cust_month WHERE item_count > 5 UNION ALL SELECT cust_id, 'b' AS part FROM cust_month WHERE total_complaint > 0")
def set_union_all(spark, sf_dir):
    m = V.cust_month(spark, sf_dir)
    return m.where("item_count > 5").select("cust_id", F.lit("a").alias("part")).unionByName(m.where("total_complaint > 0").select("cust_id", F.lit("b").alias("part")))


@query("set_union_distinct", f"WITH {_KEYS} SELECT DISTINCT nullif(trim(key), '') AS cust_id FROM confirmed WHERE trim(key) <> '' UNION SELECT DISTINCT cms FROM confirmed c JOIN keys k ON trim(c.key) = trim(k.crm)")
def set_union_distinct(spark, sf_dir):
    raw = V.confirmed(spark, sf_dir)
    return P.confirmed_ids(raw, raw, _keys(spark, sf_dir).withColumnRenamed("cms", "cust_id"))


@query("set_intersect", f"WITH {_CONF} SELECT cust_id FROM conf INTERSECT SELECT cust_id FROM cust_month")
def set_intersect(spark, sf_dir):
    return _confirmed_set(spark, sf_dir).intersect(V.cust_month(spark, sf_dir).select("cust_id"))


@query("set_except", f"WITH {_CONF} SELECT cust_id FROM cust_month EXCEPT SELECT cust_id FROM conf")
def set_except(spark, sf_dir):
    return V.cust_month(spark, sf_dir).select("cust_id").subtract(_confirmed_set(spark, sf_dir))


@query("agg_resolution_stats", f"WITH {_KEYS}, r AS (SELECT nullif(trim(c.key), '') AS crm, count(DISTINCT k.cms) AS n FROM confirmed c LEFT JOIN keys k ON trim(c.key) = trim(k.crm) WHERE trim(c.key) <> '' GROUP BY 1) SELECT count(*) AS total, count(*) FILTER (n > 0) AS resolved, count(*) FILTER (n = 0) AS unresolved, count(*) FILTER (n > 1) AS ambiguous FROM r")
def agg_resolution_stats(spark, sf_dir):
    a = V.confirmed(spark, sf_dir).select(S.null_key(F.col("key")).alias("crm")).where("crm IS NOT NULL")
    b = _keys(spark, sf_dir).select(S.null_key(F.col("crm")).alias("crm"), "cms")
    n = a.join(b, "crm", "left").groupBy("crm").agg(F.countDistinct("cms").alias("n"))
    return n.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("n") > 0).alias("resolved"), F.count_if(F.col("n") == 0).alias("unresolved"), F.count_if(F.col("n") > 1).alias("ambiguous"))


_HORIZON = "SELECT m.cust_id, e.window_end, CAST(sum(m.item_count) AS BIGINT) AS items, CAST(sum(m.total_fee) AS BIGINT) AS fee FROM ends3 e JOIN cust_month m ON m.report_month > e.window_end AND m.report_month <= e.window_end + INTERVAL 2 MONTH GROUP BY 1, 2"
_ENDS3 = f"{MONTHLY}, {grid_sql((3,))}, ends3 AS (SELECT DISTINCT window_end FROM held)"


def _ends(spark, sf_dir):
    return in_windows(spark, sf_dir, (3,)).select("window_end").distinct()


@query("join_label_horizon", f"WITH {_ENDS3} {_HORIZON}")
def join_label_horizon(spark, sf_dir):
    return P.horizon_activity(V.cust_month(spark, sf_dir), _ends(spark, sf_dir), 2)


@query("agg_label", f"WITH {_ENDS3}, h AS ({_HORIZON}) SELECT window_end, count(*) AS customers, CAST(sum(items) AS BIGINT) AS items FROM h GROUP BY 1")
def agg_label(spark, sf_dir):
    return P.horizon_activity(V.cust_month(spark, sf_dir), _ends(spark, sf_dir), 2).groupBy("window_end").agg(F.count(F.lit(1)).alias("customers"), F.sum("items").alias("items"))


_LABELS = f"WITH {_ENDS3}, h AS ({_HORIZON}), w AS (SELECT cust_id, window_end, window_size, CAST(sum(item_sum) AS BIGINT) AS item_sum FROM held GROUP BY 1, 2, 3), labelled AS (SELECT w.*, CASE WHEN h.items > 0 OR h.fee > 0 THEN 0 ELSE 1 END AS y_raw FROM w LEFT JOIN h USING (cust_id, window_end))"


def _windows3(spark, sf_dir):
    return window_sums(spark, sf_dir, (3,))


@query("build_label", _LABELS + " SELECT * FROM labelled")
def build_label(spark, sf_dir):
    return P.build_label(_windows3(spark, sf_dir), V.cust_month(spark, sf_dir), 2)


@query("training_windows", _LABELS + " SELECT * FROM labelled WHERE window_end BETWEEN DATE '1995-03-01' AND DATE '2001-04-01' AND item_sum >= 4")
def training_windows(spark, sf_dir):
    return P.training_windows(_windows3(spark, sf_dir), V.cust_month(spark, sf_dir), 3, DATA_START, T_OBS, 2, 4)


_CACHE = "SELECT CAST(year(o_orderdate) % 100 * 100 + month(o_orderdate) AS INT) AS run_month, CAST(o_orderkey % 3 AS INT) AS horizon, max(o_totalprice) AS sigma2 FROM {t} GROUP BY 1, 2 HAVING 5 * sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) > count(*)"
_RUNS = "SELECT DISTINCT CAST(year(o_orderdate) % 100 * 100 + month(o_orderdate) AS INT) AS run_month, CAST(o_orderkey % 3 AS INT) AS horizon FROM {t}"


@query("join_asof_prototype", f"WITH c AS ({_CACHE.format(t='orders')}), r AS ({_RUNS.format(t='orders')}), j AS (SELECT r.run_month, r.horizon, c.sigma2, ((r.run_month // 100 + 30) % 100 - (c.run_month // 100 + 30) % 100) * 12 + r.run_month % 100 - c.run_month % 100 AS age FROM r JOIN c ON r.horizon = c.horizon), k AS (SELECT *, row_number() OVER (PARTITION BY run_month, horizon ORDER BY age) AS n FROM j WHERE age BETWEEN 0 AND 3) SELECT run_month, horizon, sigma2, CAST(age AS INT) AS age FROM k WHERE n = 1", views=False)
def join_asof_prototype(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders")
    got = P.prototype_as_of(spark.sql(_CACHE.format(t="{o}"), o=o), spark.sql(_RUNS.format(t="{o}"), o=o))
    return got.select("run_month", "horizon", F.col("proto.sigma2").alias("sigma2"), "age")


_TRUTH = "truth AS (SELECT cust_id, y AS actual_churn FROM scored)"


def _truth(spark, sf_dir):
    return scored(spark, sf_dir).select("cust_id", F.col("y").alias("actual_churn"))


@query("join_truth", f"WITH {SCORED}, {_TRUTH} SELECT CASE WHEN actual_churn = 1 AND r.cust_id IS NOT NULL THEN 'True Positive' WHEN actual_churn = 1 THEN 'False Negative' WHEN r.cust_id IS NOT NULL THEN 'False Positive' ELSE 'True Negative' END AS prediction_type, count(*) AS n FROM truth t LEFT JOIN risk r USING (cust_id) GROUP BY 1")
def join_truth(spark, sf_dir):
    return T.confusion(_truth(spark, sf_dir), risk(spark, sf_dir))


_BACK = f"WITH {SCORED}, b AS (SELECT count(*) FILTER (churn_flag = 1) AS list_size, count(*) FILTER (churn_flag = 1 AND y = 1) AS churned_in_list, count(*) FILTER (y = 1) AS churned_total FROM scored)"


@query("backtest_in_list", _BACK + " SELECT *, round(churned_in_list / list_size, 6) AS precision, round(churned_in_list / churned_total, 6) AS recall, round(2.0 * churned_in_list / (list_size + churned_total), 6) AS f1 FROM b")
def backtest_in_list(spark, sf_dir):
    s = scored(spark, sf_dir)
    return rounded(N.backtest(risk(spark, sf_dir), s.select("cust_id", F.col("y").alias("churned")), s.select("cust_id")))


@query("join_backtest", f"WITH {SCORED}, t AS (SELECT cust_id, y FROM scored WHERE y = 1) SELECT s.cust_id, coalesce(t.y, 0) AS churned, CASE WHEN r.cust_id IS NULL THEN 0 ELSE 1 END AS listed FROM scored s LEFT JOIN t USING (cust_id) LEFT JOIN risk r USING (cust_id)")
def join_backtest(spark, sf_dir):
    s = scored(spark, sf_dir)
    truth = s.where("y = 1").select("cust_id", F.lit(1).alias("churned"))
    return s.select("cust_id").join(truth, "cust_id", "left").join(risk(spark, sf_dir).select("cust_id", F.lit(1).alias("listed")), "cust_id", "left").na.fill(0)


@query("scalar_subquery_pct", f"WITH {SCORED} SELECT reason_1, count(*) AS frequency, round(count(*) * 100.0 / (SELECT count(*) FROM risk), 2) AS pct FROM risk WHERE reason_1 IS NOT NULL GROUP BY 1")
def scalar_subquery_pct(spark, sf_dir):
    return T.reason_frequency(risk(spark, sf_dir))


# Aggregates, tops and window functions on the score table


@query("agg_bucket", f"WITH {SCORED} SELECT CASE WHEN churn_rate >= 90 THEN '90-100%' WHEN churn_rate >= 80 THEN '80-90%' WHEN churn_rate >= 70 THEN '70-80%' ELSE '<70%' END AS risk_bucket, count(*) AS num_customers, round(avg(churn_rate), 2) AS avg_churn_rate, min(churn_rate) AS min_rate, max(churn_rate) AS max_rate FROM risk GROUP BY 1")
def agg_bucket(spark, sf_dir):
    return T.risk_buckets(risk(spark, sf_dir))


@query("agg_value_counts", "WITH c AS (SELECT 'service' AS feature, service AS value FROM items UNION ALL SELECT 'region', CAST(region AS VARCHAR) FROM items), n AS (SELECT feature, value, count(*) AS n FROM c GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS r FROM n) SELECT feature, value, n FROM r WHERE r <= 3")
def agg_value_counts(spark, sf_dir):
    return N.category_profile(V.items(spark, sf_dir).select("service", "region"), ["service", "region"], 3)


_SUMMARY = """SELECT 'Total Customers' AS metric, CAST(count(*) AS VARCHAR) AS value FROM risk UNION ALL SELECT 'Avg Churn Rate (%)', printf('%.2f', avg(churn_rate)) FROM risk
UNION ALL SELECT 'Median Churn Rate (%)', printf('%.2f', quantile_cont(churn_rate, 0.5)) FROM risk UNION ALL SELECT 'Max Churn Rate (%)', printf('%.2f', max(churn_rate)) FROM risk
UNION ALL SELECT 'Min Churn Rate (%)', printf('%.2f', min(churn_rate)) FROM risk UNION ALL SELECT 'Customers with reason_1', CAST(count(reason_1) AS VARCHAR) FROM risk
UNION ALL SELECT 'Customers with reason_2', CAST(count(reason_2) AS VARCHAR) FROM risk UNION ALL SELECT 'Customers with reason_3', CAST(count(reason_3) AS VARCHAR) FROM risk"""


@query("agg_summary_rows", f"WITH {SCORED} {_SUMMARY}")
def agg_summary_rows(spark, sf_dir):
    return T.summary(risk(spark, sf_dir))


_RISK_COLUMNS = "cust_id, churn_rate, item_last, reason_1, reason_2, reason_3"


def _columns(df):
    return df.select("cust_id", "churn_rate", "item_last", "reason_1", "reason_2", "reason_3")


@query("topk_risk", f"WITH {SCORED} SELECT {_RISK_COLUMNS} FROM risk ORDER BY churn_rate DESC, cust_id LIMIT 20")
def topk_risk(spark, sf_dir):
    return _columns(T.top_risk(risk(spark, sf_dir)))


@query("risk_reports", f"WITH {SCORED} SELECT 'with_reason' AS report, CAST(cust_id AS VARCHAR) AS key, churn_rate AS value FROM (SELECT * FROM risk WHERE reason_1 = 'Not seen' ORDER BY churn_rate DESC, cust_id LIMIT 20) UNION ALL SELECT 'threshold', '70% Threshold', CAST(count(*) FILTER (churn_rate >= 70) AS DOUBLE) FROM risk UNION ALL SELECT 'threshold', '75% Threshold', CAST(count(*) FILTER (churn_rate >= 75) AS DOUBLE) FROM risk UNION ALL SELECT 'threshold', '80% Threshold', CAST(count(*) FILTER (churn_rate >= 80) AS DOUBLE) FROM risk UNION ALL SELECT 'inventory', 'risk', CAST(count(*) AS DOUBLE) FROM risk")
def risk_reports(spark, sf_dir):
    r = risk(spark, sf_dir)
    a = T.with_reason(r, "Not seen").select(F.lit("with_reason").alias("report"), F.col("cust_id").cast("string").alias("key"), F.col("churn_rate").alias("value"))
    b = T.threshold_counts(r).select(F.lit("threshold").alias("report"), F.col("threshold").alias("key"), F.col("num_customers").cast("double").alias("value"))
    c = r.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("inventory").alias("report"), F.lit("risk").alias("key"), "value")
    return a.unionByName(b).unionByName(c)


@query("view_risk_levels", f"WITH {SCORED} SELECT cust_id, churn_rate, CASE WHEN churn_rate >= 90 THEN 'Critical' WHEN churn_rate >= 80 THEN 'High' WHEN churn_rate >= 70 THEN 'Medium' ELSE 'Low' END AS risk_level FROM risk WHERE churn_rate >= 80")
def view_risk_levels(spark, sf_dir):
    T.levels_view(risk(spark, sf_dir), "v_risk_summary")
    return spark.sql("SELECT cust_id, churn_rate, risk_level FROM v_risk_summary WHERE risk_level IN ('Critical', 'High')")


@query("sink_risk_list", f"WITH {SCORED} SELECT cust_id, p, CAST(0.5 AS DOUBLE) AS threshold, 3 AS window_size, 2 AS horizon FROM risk")
def sink_risk_list(spark, sf_dir):
    path = shared_path(spark, "risk")
    K.full_reload(K.risk_list(scored(spark, sf_dir), 0.5, 3, 2), path)
    return published(spark, path).select("cust_id", "p", "threshold", "window_size", "horizon")


@query("sink_csv_export", f"WITH {SCORED} SELECT CAST(cust_id AS VARCHAR) AS cust_id, round(churn_rate, 2) AS churn_rate, round(revenue_last / 1e6, 2) AS revenue_last_m, reason_1 FROM risk WHERE churn_rate >= 75")
def sink_csv_export(spark, sf_dir):
    path = shared_path(spark, "export")
    K.csv_export(T.export_rows(risk(spark, sf_dir)).select("cust_id", "churn_rate", "revenue_last_m", "reason_1"), path)
    return spark.read.schema("cust_id string, churn_rate double, revenue_last_m double, reason_1 string").option("header", True).csv(path)


_CUT = f"WITH {SCORED}, c AS (SELECT greatest(0.5, quantile_cont(p, 0.9)) AS t FROM scored) SELECT cust_id, p, CASE WHEN p >= t THEN 1 ELSE 0 END AS churn_flag FROM scored, c"


@query("top_percentile_cut", _CUT)
def top_percentile_cut(spark, sf_dir):
    return M.top_percentile_cut(scored(spark, sf_dir).select("cust_id", "p"), 0.5)


_CURVE = f"WITH {SCORED}, g AS (SELECT p, CAST(sum(y) AS BIGINT) AS pos, count(*) AS n FROM scored GROUP BY 1), c AS (SELECT p, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w - sum(pos) OVER w AS BIGINT) AS fp, CAST(sum(pos) OVER w AS DOUBLE) / sum(n) OVER w AS precision, CAST(sum(pos) OVER w AS DOUBLE) / sum(pos) OVER () AS recall FROM g WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"


@query("win_cum_curve", _CURVE + " SELECT p, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall FROM c")
def win_cum_curve(spark, sf_dir):
    return rounded(W.cumulative_curve(scored(spark, sf_dir)))


@query("fbeta_threshold", _CURVE + ", f AS (SELECT p, round(coalesce(1.25 * precision * recall / nullif(0.25 * precision + recall, 0), 0), 12) AS f FROM c) SELECT p AS threshold, round(f, 6) AS fbeta FROM f ORDER BY f DESC, p DESC LIMIT 1")
def fbeta_threshold(spark, sf_dir):
    return rounded(M.fbeta_threshold(scored(spark, sf_dir)))


@query("prf_at_threshold", f"WITH {SCORED}, c AS (SELECT count(*) FILTER (p >= 0.6 AND y = 1) AS tp, count(*) FILTER (p >= 0.6 AND y = 0) AS fp, count(*) FILTER (p < 0.6 AND y = 1) AS fn FROM scored), d AS (SELECT *, tp / (tp + fp + 1e-9) AS precision, tp / (tp + fn + 1e-9) AS recall FROM c) SELECT tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(2 * precision * recall / (precision + recall + 1e-9), 6) AS f1 FROM d")
def prf_at_threshold(spark, sf_dir):
    return rounded(M.prf_at(scored(spark, sf_dir), 0.6))


@query("evaluate_model", _CURVE + ", e AS (SELECT *, tp - coalesce(lag(tp) OVER (ORDER BY p DESC), 0) AS dtp, fp - coalesce(lag(fp) OVER (ORDER BY p DESC), 0) AS dfp, recall - coalesce(lag(recall) OVER (ORDER BY p DESC), 0) AS dr FROM c) SELECT max(tp) AS positives, max(fp) AS negatives, round(sum(precision * dr), 6) AS pr_auc, round(1 - sum(dtp * (fp - dfp / 2.0)) / (max(tp) * max(fp)), 6) AS roc_auc FROM e")
def evaluate_model(spark, sf_dir):
    return rounded(M.evaluate(scored(spark, sf_dir)))


@query("score_stats", f"WITH {SCORED} SELECT round(avg(p), 6) AS mean, round(quantile_cont(p, 0.5), 6) AS p50, round(quantile_cont(p, 0.9), 6) AS p90, round(quantile_cont(p, 0.99), 6) AS p99, CAST(sum(churn_flag) AS BIGINT) AS risk_count, count(*) AS active_count, round(sum(churn_flag) / count(*), 6) AS risk_ratio FROM scored")
def score_stats(spark, sf_dir):
    return rounded(N.score_stats(scored(spark, sf_dir)))


_MONTH_RATIO = "SELECT CAST(year(report_month) * 100 + month(report_month) AS INT) AS m, CAST(sum(total_complaint) AS DOUBLE) / sum(item_count) AS risk_ratio FROM {t} GROUP BY 1"
_ANOMALY = (
    f"WITH r AS ({_MONTH_RATIO.format(t='cust_month')}), n AS (SELECT *, row_number() OVER (ORDER BY m) AS i FROM r), h AS (SELECT a.m, a.risk_ratio, b.risk_ratio AS v FROM n a LEFT JOIN n b ON b.i BETWEEN a.i - 6 AND a.i - 1), "
    "md AS (SELECT m, any_value(risk_ratio) AS risk_ratio, count(v) AS n_history, quantile_cont(v, 0.5) AS med FROM h GROUP BY 1), mad AS (SELECT h.m, quantile_cont(abs(v - med), 0.5) + 1e-9 AS mad FROM h JOIN md USING (m) GROUP BY 1) "
    "SELECT m, round(risk_ratio, 6) AS risk_ratio, CAST(n_history AS INT) AS n_history, round(CASE WHEN n_history >= 4 THEN med + 3 * mad END, 6) AS threshold, coalesce(n_history >= 4 AND risk_ratio > med + 3 * mad, false) AS is_anomaly FROM md JOIN mad USING (m)"
)


@query("win_robust_anomaly", _ANOMALY)
def win_robust_anomaly(spark, sf_dir):
    return rounded(W.robust_anomaly(spark.sql(_MONTH_RATIO.format(t="{m}"), m=V.cust_month(spark, sf_dir)), "risk_ratio", "m"))


@query("score_drift", f"WITH q AS (WITH {_ANOMALY[5:]}) SELECT m, risk_ratio, is_anomaly, CASE WHEN is_anomaly THEN printf('risk_ratio %.4f > median+3*MAD (%.4f) over last %d', risk_ratio, threshold, n_history) END AS anomaly_reason FROM q")
def score_drift(spark, sf_dir):
    return rounded(N.score_drift(spark.sql(_MONTH_RATIO.format(t="{m}"), m=V.cust_month(spark, sf_dir)), "m"))


# Training-set steps


@query("assign_tier", f"WITH {SCORED} SELECT cust_id, CASE WHEN recency_days <= 90 THEN 'active' WHEN recency_days <= 180 THEN 'at_risk' ELSE 'churned' END AS tier FROM scored")
def assign_tier(spark, sf_dir):
    return scored(spark, sf_dir).select("cust_id", P.tier(F.col("recency_days")).alias("tier"))


@query("pu_weight", f"WITH {SCORED}, {_CONF}, a AS (SELECT count(*) AS n_active, count(conf.cust_id) AS n_confirmed FROM scored LEFT JOIN conf USING (cust_id) WHERE recency_days <= 90) SELECT n_active, n_confirmed, round(CASE WHEN n_confirmed > 0 THEN greatest(n_confirmed / greatest(n_active - n_confirmed, 1), 0.01) ELSE 0.05 END, 6) AS c FROM a")
def pu_weight(spark, sf_dir):
    active = scored(spark, sf_dir).where("recency_days <= 90").join(_confirmed_set(spark, sf_dir).withColumn("c", F.lit(1)), "cust_id", "left")
    n = active.agg(F.count(F.lit(1)).alias("n_active"), F.count("c").alias("n_confirmed"))
    return rounded(n.withColumn("c", P.pu_weight(F.col("n_confirmed"), F.col("n_active"))))


# Columns that pseudo-labels read, as plain SQL for both engines.
_ACTIVE = """SELECT s.cust_id, s.recency_days, CASE WHEN c.cust_id IS NULL THEN false ELSE true END AS is_confirmed, CAST(s.cust_id % 21 - 10 AS DOUBLE) AS delta_ewma, CAST(s.item_last AS DOUBLE) / 12 AS item_avg,
  CAST(s.cust_id % 5 AS DOUBLE) AS item_last, 1 - s.p / 2 AS sim FROM {scored} s LEFT JOIN {conf} c ON s.cust_id = c.cust_id"""
_SOURCES = f"active AS ({_ACTIVE.format(scored='scored', conf='conf')}), src AS (SELECT *, CASE WHEN is_confirmed THEN 'confirmed' WHEN recency_days <= 30 AND delta_ewma >= 0 THEN 'reliable_neg' WHEN sim > 0.8 AND delta_ewma < 0 AND item_avg > 0 AND item_last < item_avg * 0.85 THEN 'pseudo_churn' ELSE 'pu_unlabeled' END AS label_source FROM active)"
_WEIGHTS = "wts AS (SELECT *, CASE WHEN label_source IN ('confirmed', 'pseudo_churn') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y_label, CASE label_source WHEN 'confirmed' THEN 1.0 WHEN 'pseudo_churn' THEN 0.5 WHEN 'reliable_neg' THEN 0.8 ELSE 0.05 END::DOUBLE AS sample_weight FROM src), smooth AS (SELECT *, CASE WHEN label_source = 'confirmed' THEN y_label ELSE y_label * 0.9 + 0.05 END AS y_smooth FROM wts)"
_SPLIT = "spl AS (SELECT *, CASE WHEN label_source = 'confirmed' THEN 'eval' WHEN ('0x' || substr(md5('split' || cust_id || CASE WHEN y_label = 1 THEN '1.0' ELSE '0.0' END), 1, 8))::BIGINT / 4294967296.0 < 0.2 THEN 'eval' ELSE 'train' END AS split FROM smooth)"


def _active(spark, sf_dir):
    return spark.sql(_ACTIVE.format(scored="{s}", conf="{c}"), s=scored(spark, sf_dir), c=_confirmed_set(spark, sf_dir))


def _labelled(spark, sf_dir):
    return _active(spark, sf_dir).withColumn("label_source", P.label_source(F.col("sim")))


def _weighted(spark, sf_dir):
    return P.weights_and_smoothing(_labelled(spark, sf_dir), F.lit(0.05))


@query("pseudo_labels", f"WITH {SCORED}, {_CONF}, {_SOURCES} SELECT cust_id, label_source FROM src")
def pseudo_labels(spark, sf_dir):
    return _labelled(spark, sf_dir).select("cust_id", "label_source")


@query("weights_smoothing", f"WITH {SCORED}, {_CONF}, {_SOURCES}, {_WEIGHTS} SELECT cust_id, y_label, sample_weight, round(y_smooth, 6) AS y_smooth FROM smooth")
def weights_smoothing(spark, sf_dir):
    return rounded(_weighted(spark, sf_dir).select("cust_id", "y_label", "sample_weight", "y_smooth"))


@query("split_stratified", f"WITH {SCORED}, {_CONF}, {_SOURCES}, {_WEIGHTS}, {_SPLIT} SELECT cust_id, label_source, split FROM spl")
def split_stratified(spark, sf_dir):
    return P.split_stratified(_weighted(spark, sf_dir), "cust_id").select("cust_id", "label_source", "split")


@query("merge_history", f"WITH {SCORED}, {_CONF}, {_SOURCES}, {_WEIGHTS}, {_SPLIT} SELECT cust_id, item_last, y_label, sample_weight, split FROM spl UNION ALL SELECT m.cust_id, CAST(0 AS DOUBLE), CASE WHEN conf.cust_id IS NOT NULL THEN 1.0 WHEN m.total_complaint > 0 THEN 1.0 ELSE 0.0 END::DOUBLE, 1.0::DOUBLE, 'train' FROM cust_month m LEFT JOIN conf USING (cust_id)")
def merge_history(spark, sf_dir):
    now = P.split_stratified(_weighted(spark, sf_dir), "cust_id")
    past = V.cust_month(spark, sf_dir).join(_confirmed_set(spark, sf_dir).withColumn("c", F.lit(True)), "cust_id", "left")
    past = past.select("cust_id", F.coalesce("c", F.lit(False)).alias("is_confirmed"), F.when(F.col("total_complaint") > 0, 1).otherwise(0).alias("y_raw"))
    return P.merge_history(now, past).select("cust_id", "item_last", "y_label", "sample_weight", "split")


@query("scale_train_only", f"WITH {SCORED}, {_CONF}, {_SOURCES}, {_WEIGHTS}, {_SPLIT}, st AS (SELECT avg(recency_days) AS m1, stddev_pop(recency_days) AS s1, avg(delta_ewma) AS m2, stddev_pop(delta_ewma) AS s2 FROM spl WHERE split = 'train') SELECT cust_id, split, round((recency_days - m1) / s1, 6) AS recency_days, round((delta_ewma - m2) / s2, 6) + 0.0::DOUBLE AS delta_ewma FROM spl, st")
def scale_train_only(spark, sf_dir):
    now = P.split_stratified(_weighted(spark, sf_dir), "cust_id").select("cust_id", "split", "recency_days", "delta_ewma")
    return rounded(P.scale_on_train(now, ["recency_days", "delta_ewma"]))


@query("sanity_gate", f"WITH {SCORED}, {_CONF}, {_SOURCES}, {_WEIGHTS}, {_SPLIT} SELECT 'no_overlap' AS check, count(*) FILTER (split = 'train' AND label_source = 'confirmed') = 0 AS passed, true AS critical FROM spl UNION ALL SELECT 'train_rate', coalesce(avg(y_label) FILTER (split = 'train') BETWEEN 0.03 AND 0.35, false), false FROM spl UNION ALL SELECT 'no_null_weight', count(*) FILTER (split = 'train' AND sample_weight IS NULL) = 0, true FROM spl UNION ALL SELECT 'no_null_feature', count(*) FILTER (split = 'train' AND item_avg IS NULL) = 0, true FROM spl UNION ALL SELECT 'train_not_empty', count(*) FILTER (split = 'train') > 0, true FROM spl UNION ALL SELECT 'eval_not_empty', count(*) FILTER (split <> 'train') > 0, false FROM spl UNION ALL SELECT 'eval_size', count(*) FILTER (split <> 'train') >= 20, false FROM spl UNION ALL SELECT 'scaler_fitted', true, true")
def sanity_gate(spark, sf_dir):
    now = P.split_stratified(_weighted(spark, sf_dir), "cust_id")
    now = P.scale_on_train(now.withColumn("scaled_recency", F.col("recency_days")), ["scaled_recency"])
    return P.sanity_checks(now, ["item_avg", "delta_ewma"], min_eval=20, scaled=["scaled_recency"])


@query("prototype_fallback", f"WITH c AS ({_CACHE.format(t='orders')}), r AS ({_RUNS.format(t='orders')}), j AS (SELECT r.run_month, r.horizon, ((r.run_month // 100 + 30) % 100 - (c.run_month // 100 + 30) % 100) * 12 + r.run_month % 100 - c.run_month % 100 AS age FROM r JOIN c ON r.horizon = c.horizon), k AS (SELECT run_month, horizon, min(age) AS age FROM j WHERE age BETWEEN 0 AND 3 GROUP BY 1, 2) SELECT run_month, horizon, coalesce(age, 1) > 0 AS fallback, age IS NULL AS failed FROM r LEFT JOIN k USING (run_month, horizon)", views=False)
def prototype_fallback(spark, sf_dir):
    """Runs whose own prototype is missing fall back to one cached up to three months before, or are reported as failed."""
    o = V.table(spark, sf_dir, "orders")
    return P.prototype_or_fallback(spark.sql(_CACHE.format(t="{o}"), o=o), spark.sql(_RUNS.format(t="{o}"), o=o)).select("run_month", "horizon", "fallback", "failed")


_PROTO = ("item_sum", "revenue_avg", "pct_delay", "order_score_avg")


def _proto_rows(spark, sf_dir):
    table = staged(feature_rows(spark, sf_dir, (3,), with_months=False, columns=_PROTO), "proto")
    return table, P.fit_prototype(table.join(_confirmed_set(spark, sf_dir), "cust_id", "left_semi"), _PROTO)


@query("fit_prototype")
def fit_prototype(spark, sf_dir):
    table, proto = _proto_rows(spark, sf_dir)
    return P.mean_and_covariance(table, _PROTO).withColumn("sigma2", F.lit(proto["sigma2"] if proto else None))


#: A prototype as one is kept between runs: its mean and inverse covariance. Like a fitted one it has no short decimals, with
#: which distances would lie halfway between two rounded values.
_KEPT = {
    "features": list(_PROTO), "mu": [9.1373719, 203411.7353, 0.153371937, 3.07193313], "sigma2": 2.5173391,
    "inverse": [[0.0413717931, -1.0371e-7, 0.021739313, 0.0], [-1.0371e-7, 4.1739e-11, 0.0, 1.1937e-7], [0.021739313, 0.0, 6.13793197, -0.10379313], [0.0, 1.1937e-7, -0.10379313, 0.51793713]],
}
_KEPT_SQL = (
    f"WITH {FEATURES_CTE}, x AS (SELECT cust_id, window_end, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) - {m!r}::DOUBLE AS x{i}" for i, (c, m) in enumerate(zip(_PROTO, _KEPT["mu"]))) + " FROM features WHERE window_size = 3), "
    "d AS (SELECT cust_id, window_end, greatest(" + " + ".join(f"x{i} * x{j} * {w!r}::DOUBLE" for i, row in enumerate(_KEPT["inverse"]) for j, w in enumerate(row) if w) + ", 0) AS d2 FROM x)"
)


@query("similarity", _KEPT_SQL + f" SELECT cust_id, window_end, round(d2, 6) AS d2, round(exp(greatest(least(-d2 / {2 * _KEPT['sigma2']!r}, 0), -700)), 6) AS sim FROM d")
def similarity(spark, sf_dir):
    """Distance and similarity of every window of three months to a kept prototype."""
    table = rounded(feature_rows(spark, sf_dir, (3,), with_months=False, columns=_PROTO))  # as in the oracle
    out = table.select("cust_id", "window_end", P.distance2(_KEPT).alias("d2"))
    return rounded(out.withColumn("sim", P.similarity(F.col("d2"), _KEPT["sigma2"])))


@query("udf_mahalanobis", _KEPT_SQL + " SELECT cust_id, window_end, round(d2, 6) AS d2, round(d2, 6) AS d2_expression FROM d")
def udf_mahalanobis(spark, sf_dir):
    """The vectorised distance to a kept prototype and the same as an expression, side by side."""
    table = rounded(feature_rows(spark, sf_dir, (3,), with_months=False, columns=_PROTO))  # as in the oracle
    return rounded(table.select("cust_id", "window_end", P.distance2(_KEPT).alias("d2"), P.distance2_sql(_KEPT).alias("d2_expression")))


# Profiles

_FACTS = "SELECT cust_id, CAST(item_count AS DOUBLE) AS items, CAST(total_fee AS DOUBLE) AS fee, CAST(delay_day AS DOUBLE) AS late, order_score AS score, CASE WHEN lastday > 28 THEN NULL ELSE CAST(lastday AS DOUBLE) END AS lastday, CASE WHEN lastday > 28 OR item_count > 8 THEN NULL ELSE CAST(weight_kg AS DOUBLE) END AS weight, CASE WHEN total_complaint > 0 THEN 1 ELSE 0 END AS y, CAST(year(report_month) AS INT) AS yr FROM {t}"
FACTS = f"facts AS ({_FACTS.format(t='cust_month')})"
COLUMNS = ("items", "fee", "late", "score", "lastday", "weight")
LONG = f"{FACTS}, v AS ({' UNION ALL '.join(f'SELECT {chr(39)}{c}{chr(39)} AS feature, {c} AS value, y, yr FROM facts' for c in COLUMNS)})"


def facts(spark, sf_dir):
    return spark.sql(_FACTS.format(t="{m}"), m=V.cust_month(spark, sf_dir))


def stored_facts(spark, sf_dir):
    """The facts as a stored table, for profiles that read them several times."""
    return staged(facts(spark, sf_dir), "facts")


@query("describe_features", f"WITH {LONG} SELECT feature, count(value) AS count, round(avg(value), 5) AS mean, round(stddev_samp(value), 5) AS std, round(skewness(value), 5) AS skewness, round(kurtosis(value), 5) AS kurtosis, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.05), 5) AS p05, round(quantile_cont(value, 0.25), 5) AS p25, round(quantile_cont(value, 0.5), 5) AS median, round(quantile_cont(value, 0.75), 5) AS p75, round(quantile_cont(value, 0.95), 5) AS p95 FROM v GROUP BY 1")
def describe_features(spark, sf_dir):
    got = E.describe_features(facts(spark, sf_dir), COLUMNS)
    return got.withColumns({c: F.round(c, 5) for c in ("mean", "std", "skewness", "kurtosis", "p05", "p25", "median", "p75", "p95")})


@query("missing_stats", f"WITH {LONG} SELECT feature, count(*) AS total, count(*) FILTER (value IS NULL) AS missing, false AS has_inf, round(count(*) FILTER (value IS NULL) / count(*), 6) AS missing_pct FROM v GROUP BY 1")
def missing_stats(spark, sf_dir):
    return E.missing_stats(facts(spark, sf_dir), COLUMNS)


_PATTERNS = f"WITH {FACTS}, p AS (SELECT concat_ws(',', CASE WHEN lastday IS NULL THEN 'lastday' END, CASE WHEN weight IS NULL THEN 'weight' END) AS columns FROM facts), n AS (SELECT columns, count(*) AS n FROM p GROUP BY 1), q AS (SELECT *, round(n / sum(n) OVER (), 6) AS pct FROM n)"


@query("missing_patterns", _PATTERNS + " SELECT substr(md5(columns), 1, 12) AS pattern_id, columns, n, pct FROM q WHERE columns <> ''")
def missing_patterns(spark, sf_dir):
    return E.missing_patterns(facts(spark, sf_dir), COLUMNS, None)


@query("topk_patterns", _PATTERNS + " SELECT columns, n FROM q WHERE columns <> '' ORDER BY n DESC, columns LIMIT 10")
def topk_patterns(spark, sf_dir):
    return E.missing_patterns(facts(spark, sf_dir), COLUMNS).select("columns", "n")


@query("outlier_stats", f"WITH {LONG}, q AS (SELECT feature, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, avg(value) AS m, stddev_samp(value) AS s, count(value) AS n FROM v GROUP BY 1) SELECT feature, round(any_value(a - 1.5 * (b - a)), 6) AS lower, round(any_value(b + 1.5 * (b - a)), 6) AS upper, count(*) FILTER (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) AS iqr_outliers, count(*) FILTER (s > 0 AND abs((value - m) / s) > 3) AS z_outliers, any_value(n) AS n FROM v JOIN q USING (feature) GROUP BY 1")
def outlier_stats(spark, sf_dir):
    return rounded(E.outlier_stats(facts(spark, sf_dir), COLUMNS))


_PAIRS = " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM facts" for i, a in enumerate(sorted(COLUMNS)) for b in sorted(COLUMNS)[i + 1 :])


@query("correlation_matrix", f"WITH {FACTS}, c AS ({_PAIRS}) SELECT feature_a, feature_b, round(r, 6) AS r FROM c")
def correlation_matrix(spark, sf_dir):
    return rounded(E.correlation_pairs(facts(spark, sf_dir), COLUMNS))


@query("correlation_spearman", f"WITH {FACTS}, k AS (SELECT rank() OVER (ORDER BY items) + (count(*) OVER (PARTITION BY items) - 1) / 2.0 AS a, rank() OVER (ORDER BY fee) + (count(*) OVER (PARTITION BY fee) - 1) / 2.0 AS b FROM facts) SELECT 'fee' AS feature_a, 'items' AS feature_b, round(corr(b, a), 6) AS r FROM k")
def correlation_spearman(spark, sf_dir):
    return rounded(E.correlation_pairs(facts(spark, sf_dir), ["items", "fee"], "spearman"))


@query("high_correlations", f"WITH {FACTS}, c AS ({_PAIRS}) SELECT feature_a, feature_b, round(r, 6) AS r FROM c WHERE abs(r) >= 0.5")
def high_correlations(spark, sf_dir):
    return rounded(E.high_correlations(E.correlation_pairs(facts(spark, sf_dir), COLUMNS), 0.5))


@query("sort_abs_corr", f"WITH {FACTS}, c AS ({_PAIRS}) SELECT feature_a, feature_b, round(r, 6) AS r FROM c ORDER BY abs(r) DESC LIMIT 5")
def sort_abs_corr(spark, sf_dir):
    return rounded(E.correlation_pairs(facts(spark, sf_dir), COLUMNS).orderBy(F.abs("r").desc()).limit(5))


@query("class_distribution", f"WITH {FACTS} SELECT count(y) AS total, CAST(sum(y) AS BIGINT) AS positive, CAST(count(y) - sum(y) AS BIGINT) AS negative, round(sum(y) / count(y), 6) AS rate, round((count(y) - sum(y)) / sum(y), 6) AS imbalance FROM facts")
def class_distribution(spark, sf_dir):
    return rounded(E.class_distribution(facts(spark, sf_dir), "y"))


@query("point_biserial", f"WITH {LONG} SELECT feature, count(value) AS n, round(corr(value, y), 6) AS r FROM v WHERE value IS NOT NULL GROUP BY 1")
def point_biserial(spark, sf_dir):
    """The p-values are tested apart, as SQL has no t distribution."""
    return rounded(E.point_biserial(facts(spark, sf_dir), COLUMNS, "y").select("feature", "n", "r"))


@query("udf_t_pvalue")
def udf_t_pvalue(spark, sf_dir):
    return E.point_biserial(facts(spark, sf_dir), COLUMNS, "y")


_QS = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"
_WOE = (
    f"WITH {LONG}, e AS (SELECT feature, list_distinct(quantile_cont(value, {_QS})) AS edges FROM v WHERE value IS NOT NULL GROUP BY 1), b AS (SELECT v.feature, greatest(len(list_filter(edges, lambda q: q < value)), 1) AS bin, y FROM v JOIN e USING (feature) WHERE value IS NOT NULL), "
    "g AS (SELECT feature, bin, sum(y) AS event, count(*) - sum(y) AS non_event FROM b GROUP BY 1, 2), d AS (SELECT *, (event + 0.5) / (sum(event) OVER w + 0.5 * count(*) OVER w) AS de, (non_event + 0.5) / (sum(non_event) OVER w + 0.5 * count(*) OVER w) AS dn FROM g WINDOW w AS (PARTITION BY feature)), "
    "woe AS (SELECT feature, CAST(bin AS INT) AS bin, CAST(event AS BIGINT) AS event, CAST(non_event AS BIGINT) AS non_event, ln(dn / de) AS woe, (dn - de) * ln(dn / de) AS iv_bin FROM d)"
)


@query("woe_iv", _WOE + " SELECT feature, bin, event, non_event, round(woe, 6) + 0.0::DOUBLE AS woe, round(iv_bin, 6) AS iv_bin FROM woe")
def woe_iv(spark, sf_dir):
    return rounded(E.woe_iv(stored_facts(spark, sf_dir), COLUMNS, "y"))


_IV = _WOE + ", iv AS (SELECT feature, round(sum(iv_bin), 6) AS iv FROM woe GROUP BY 1), ranked AS (SELECT feature, iv, CASE WHEN iv < 0.02 THEN 'useless' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium' WHEN iv < 0.5 THEN 'strong' ELSE 'suspicious' END AS strength FROM iv)"


@query("iv_ranking", _IV + " SELECT * FROM ranked")
def iv_ranking(spark, sf_dir):
    return E.iv_ranking(E.woe_iv(stored_facts(spark, sf_dir), COLUMNS, "y"), COLUMNS)


@query("topk_features", _IV + " SELECT feature, iv FROM ranked ORDER BY iv DESC, feature LIMIT 3")
def topk_features(spark, sf_dir):
    return E.iv_ranking(E.woe_iv(stored_facts(spark, sf_dir), COLUMNS, "y"), COLUMNS).orderBy(F.col("iv").desc(), "feature").limit(3).select("feature", "iv")


_TRENDS = f"WITH {LONG}, m AS (SELECT feature, yr, quantile_cont(value, 0.5) AS med FROM v GROUP BY 1, 2), x AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY yr) - 1 AS DOUBLE) AS x FROM m WHERE med IS NOT NULL)"


@query("feature_trends", _TRENDS + " SELECT feature, count(*) AS n_months, round(regr_slope(med, x), 6) + 0.0::DOUBLE AS slope, round(regr_r2(med, x), 6) AS r2 FROM x GROUP BY 1")
def feature_trends(spark, sf_dir):
    return rounded(E.feature_trends(facts(spark, sf_dir), COLUMNS, "yr").select("feature", "n_months", "slope", "r2"))


@query("join_stats", f"WITH {LONG} SELECT feature, round(avg(value), 5) AS mean, count(*) FILTER (value IS NULL) AS missing FROM v GROUP BY 1")
def join_stats(spark, sf_dir):
    f = facts(spark, sf_dir)
    both = E.describe_features(f, COLUMNS).join(E.missing_stats(f, COLUMNS), "feature", "left").join(E.outlier_stats(f, COLUMNS).drop("n"), "feature", "left")
    return both.select("feature", F.round("mean", 5).alias("mean"), "missing")


_BASELINE = f"WITH {LONG}, c AS (SELECT feature, avg(value) AS mean, max(value) AS max FROM v WHERE yr >= 1999 GROUP BY 1), b AS (SELECT feature, avg(value) AS mean, max(value) AS max FROM v WHERE yr < 1999 GROUP BY 1), j AS (SELECT feature, 'mean' AS stat, c.mean AS current, b.mean AS baseline FROM c JOIN b USING (feature) UNION ALL SELECT feature, 'max', c.max, b.max FROM c JOIN b USING (feature)) SELECT feature, stat, round(current, 5) AS current, round(baseline, 5) AS baseline, round(current - baseline, 5) + 0.0::DOUBLE AS delta, round((current - baseline) / nullif(baseline, 0), 5) + 0.0::DOUBLE AS delta_pct FROM j"


def _baseline(spark, sf_dir):
    f = facts(spark, sf_dir)
    saved = staged(E.describe_features(f.where("yr < 1999"), COLUMNS), "baseline")
    got = E.compare_to_baseline(E.describe_features(f.where("yr >= 1999"), COLUMNS), saved, ["mean", "max"])
    return got.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("current", "baseline", "delta", "delta_pct")})


query("join_baseline_compare", _BASELINE)(_baseline)
query("baseline_snapshot", _BASELINE)(_baseline)


@query("eda_summary", f"WITH {LONG}, {_IV[_IV.index('e AS (SELECT feature'):]}, ms AS (SELECT feature, count(*) FILTER (value IS NULL) / count(*) AS pct FROM v GROUP BY 1), q AS (SELECT feature, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, count(value) AS n FROM v GROUP BY 1), o AS (SELECT feature, count(*) FILTER (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) / any_value(n) AS share FROM v JOIN q USING (feature) GROUP BY 1), c AS ({_PAIRS}) SELECT 'high_missing' AS metric, CAST(count(*) FILTER (pct > 0.1) AS DOUBLE) AS value FROM ms UNION ALL SELECT 'high_outliers', CAST(count(*) FILTER (share > 0.05) AS DOUBLE) FROM o UNION ALL SELECT 'high_corr_pairs', CAST(count(*) FILTER (abs(r) >= 0.8) AS DOUBLE) FROM c UNION ALL SELECT 'useful_iv', CAST(count(*) FILTER (strength IN ('medium', 'strong')) AS DOUBLE) FROM ranked UNION ALL SELECT 'churn_rate', round(avg(y), 6) FROM facts")
def eda_summary(spark, sf_dir):
    return E.eda_summary(E.eda_report(facts(spark, sf_dir), COLUMNS, "y"))


_REPORT = {
    "descriptive": "count(DISTINCT feature) FROM v", "missing": "count(DISTINCT feature) FROM v", "patterns": "least(count(*), 10) FROM q WHERE columns <> ''", "outliers": "count(DISTINCT feature) FROM v",
    "correlations": "count(*) FROM c WHERE abs(r) >= 0.8", "classes": "1", "point_biserial": "count(DISTINCT feature) FROM v WHERE value IS NOT NULL", "woe": "count(*) FROM woe", "iv": "count(DISTINCT feature) FROM v",
    "trends": "count(DISTINCT feature) FROM v WHERE value IS NOT NULL",
}


@query("eda_report", f"{_WOE}, {_PATTERNS[_PATTERNS.index('p AS (SELECT concat_ws'):]}, c AS ({_PAIRS}) " + " UNION ALL ".join(f"SELECT '{t}' AS \"table\", CAST({n.split(' FROM')[0]} AS BIGINT) AS n{n[len(n.split(' FROM')[0]):]}" for t, n in _REPORT.items()))
def eda_report(spark, sf_dir):
    """The full report written table by table with its run log, and the log read back."""
    path = shared_path(spark, "report")
    E.persist_report(E.eda_report(stored_facts(spark, sf_dir), COLUMNS, "y", "yr"), path, "run-1")
    return spark.read.parquet(f"{path}/log").select("table", "n")


# Monitoring

_EDGES = f"WITH {LONG}, ref AS (SELECT * FROM v WHERE yr = 1995 AND value IS NOT NULL), e AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {_QS}))) AS edges FROM ref GROUP BY 1), bins AS (SELECT feature, unnest(range(1, len(edges))) AS bin FROM e)"
_HIST = "SELECT {k} h.feature, least(len(list_filter(edges, lambda q: q <= value)), len(edges) - 1) AS bin, count(*) AS n FROM {t} h JOIN e USING (feature) WHERE value >= edges[1] AND value <= edges[len(edges)] GROUP BY ALL"
_TRAIN = _EDGES + f", tr0 AS ({_HIST.format(k='', t='ref')}), tr AS (SELECT feature, bin, coalesce(n, 0) AS n FROM bins LEFT JOIN tr0 USING (feature, bin)), later AS (SELECT * FROM v WHERE yr > 1995 AND value IS NOT NULL), cu0 AS ({_HIST.format(k='yr, ', t='later')}), cu AS (SELECT g.yr, g.feature, b.bin, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT yr, feature FROM later) g JOIN bins b USING (feature) LEFT JOIN cu0 c ON c.yr = g.yr AND c.feature = g.feature AND c.bin = b.bin)"
_PSI = _TRAIN + ", pr AS (SELECT c.yr, c.feature, c.bin, greatest(c.n / sum(c.n) OVER w, 1e-8) AS c, greatest(t.n / sum(t.n) OVER w, 1e-8) AS t FROM cu c JOIN tr t USING (feature, bin) WINDOW w AS (PARTITION BY c.yr, c.feature)), k AS (SELECT *, abs(sum(t) OVER x - sum(c) OVER x) AS ks FROM pr WINDOW x AS (PARTITION BY yr, feature ORDER BY bin)), drift AS (SELECT yr, feature, sum((c - t) * ln(c / t)) AS psi, max(ks) AS ks FROM k GROUP BY 1, 2)"


def _ref(spark, sf_dir):
    v = E.long_form(facts(spark, sf_dir), COLUMNS, ["yr"])
    ref = v.where("yr = 1995").select("feature", "value")
    return v, ref, N.profile_edges(ref)


@query("numeric_profile", _TRAIN + " SELECT feature, CAST(bin AS INT) AS bin, n FROM tr")
def numeric_profile(spark, sf_dir):
    _, ref, edges = _ref(spark, sf_dir)
    return N.counts_on_edges(ref, edges).select("feature", "bin", "n")


@query("feature_profile", _EDGES + " SELECT feature, CAST(len(edges) AS INT) AS n_edges, round(edges[1], 6) AS low, round(edges[len(edges)], 6) AS high FROM e")
def feature_profile(spark, sf_dir):
    _, _, edges = _ref(spark, sf_dir)
    return rounded(edges.select("feature", F.size("edges").alias("n_edges"), F.get("edges", F.lit(0)).alias("low"), F.element_at("edges", -1).alias("high")))


@query("counts_on_profile", _TRAIN + " SELECT yr, feature, CAST(bin AS INT) AS bin, n FROM cu")
def counts_on_profile(spark, sf_dir):
    v, _, edges = _ref(spark, sf_dir)
    return N.counts_on_edges(v.where("yr > 1995 AND value IS NOT NULL").select("yr", "feature", "value"), edges, ["yr"]).select("yr", "feature", "bin", "n")


_SEVERITY = "CASE WHEN psi > 0.2 THEN 'ALERT' WHEN psi > 0.1 THEN 'WARN' ELSE 'OK' END AS severity"


@query("monthly_drift", _PSI + f" SELECT yr, feature, round(psi, 6) AS psi, round(ks, 6) AS ks, {_SEVERITY} FROM drift")
def monthly_drift(spark, sf_dir):
    return rounded(N.monthly_drift(stored_facts(spark, sf_dir), COLUMNS, "yr"))


@query("psi", _PSI + " SELECT yr, feature, round(psi, 6) AS psi FROM drift")
def psi(spark, sf_dir):
    return rounded(N.monthly_drift(stored_facts(spark, sf_dir), COLUMNS, "yr").select("yr", "feature", "psi"))


@query("ks_discrete", _PSI + " SELECT yr, feature, round(ks, 6) AS ks FROM drift")
def ks_discrete(spark, sf_dir):
    return rounded(N.monthly_drift(stored_facts(spark, sf_dir), COLUMNS, "yr").select("yr", "feature", "ks"))


@query("win_cum_dist", _TRAIN + " SELECT feature, CAST(bin AS INT) AS bin, round(CAST(sum(n) OVER (PARTITION BY feature ORDER BY bin) AS DOUBLE) / sum(n) OVER (PARTITION BY feature), 6) AS cdf FROM tr")
def win_cum_dist(spark, sf_dir):
    _, ref, edges = _ref(spark, sf_dir)
    counts = N.counts_on_edges(ref, edges)
    w = Window.partitionBy("feature")
    return rounded(counts.select("feature", "bin", (F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(w)).alias("cdf")))


@query("feature_drift", _PSI.replace("yr > 1995", "yr > 1995 AND yr < 1997").replace("yr = 1995", "yr = 1995") + f" SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, {_SEVERITY}, psi > 0.2 AS is_anomaly FROM drift UNION ALL SELECT 'weight', NULL, NULL, 'ALERT', true WHERE false")
def feature_drift(spark, sf_dir):
    f = facts(spark, sf_dir)
    return rounded(N.feature_drift(f.where("yr = 1996"), f.where("yr = 1995"), COLUMNS))


# Models and reasons

_HISTORY = "SELECT CAST(o_custkey % 4 AS INT) AS horizon, o_orderkey AS as_of, o_custkey % 100 / 100.0 AS f05, o_orderkey % 97 / 97.0 AS pr_auc FROM {t}"


def _history(spark, sf_dir):
    return spark.sql(_HISTORY.format(t="{o}"), o=V.table(spark, sf_dir, "orders")).withColumns({"f05": F.col("f05").cast("double"), "pr_auc": F.col("pr_auc").cast("double")}).dropDuplicates(["horizon", "as_of"])


_RUNS_SQL = f"WITH h AS (SELECT horizon, as_of, CAST(f05 AS DOUBLE) AS f05, CAST(pr_auc AS DOUBLE) AS pr_auc FROM ({_HISTORY.format(t='orders')}) GROUP BY ALL), g AS (SELECT *, f05 >= 0.7 AND pr_auc >= 0.75 AS passed FROM h), a AS (SELECT *, max(CASE WHEN passed THEN f05 END) OVER (PARTITION BY horizon ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_f05 FROM g), acc AS (SELECT *, passed AND (prev_f05 IS NULL OR f05 > prev_f05 + 1e-6) AS accepted FROM a)"


@query("guardrail", _RUNS_SQL + " SELECT horizon, as_of, passed, concat_ws('; ', CASE WHEN f05 < 0.7 THEN printf('f05 %.4f < %.4f', f05, 0.7) END, CASE WHEN pr_auc < 0.75 THEN printf('pr_auc %.4f < %.4f', pr_auc, 0.75) END) AS gate_reasons FROM g", views=False)
def guardrail(spark, sf_dir):
    return M.guardrail(_history(spark, sf_dir)).select("horizon", "as_of", "passed", "gate_reasons")


def _accepted(spark, sf_dir):
    return M.accept(M.guardrail(_history(spark, sf_dir)), "as_of", ["horizon"])


@query("accept_reject", _RUNS_SQL + " SELECT horizon, as_of, accepted FROM acc", views=False)
def accept_reject(spark, sf_dir):
    return _accepted(spark, sf_dir).select("horizon", "as_of", "accepted")


@query("win_prev_config", _RUNS_SQL + ", r AS (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY as_of DESC) AS r FROM acc WHERE accepted) SELECT horizon, as_of, CAST(r AS INT) AS nth FROM r WHERE r <= 2", views=False)
def win_prev_config(spark, sf_dir):
    a = _accepted(spark, sf_dir)
    pick = lambda n: M.nth_accepted(a, ["horizon"], "as_of", n).select("horizon", "as_of", F.lit(n).alias("nth"))
    return pick(1).unionByName(pick(2))


@query("config_history", _RUNS_SQL + " SELECT horizon, as_of, CASE WHEN as_of % 10 = 0 THEN 1.0::DOUBLE ELSE f05 END AS f05 FROM h", views=False)
def config_history(spark, sf_dir):
    """A table of configurations of which every tenth is written again with other metrics."""
    old = _history(spark, sf_dir).select("horizon", "as_of", "f05")
    return K.upsert(old, old.where("as_of % 10 = 0").withColumn("f05", F.lit(1.0)), ["horizon", "as_of"])


@query("argmax_w", "WITH a AS (SELECT CAST(o_custkey % 10 + 3 AS INT) AS window_size, avg(o_totalprice) AS auc FROM orders GROUP BY 1) SELECT window_size AS w_star FROM a ORDER BY auc DESC, window_size LIMIT 1", views=False)
def argmax_w(spark, sf_dir):
    a = V.table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 10 + 3).cast("int").alias("window_size")).agg(F.avg("o_totalprice").alias("auc"))
    return M.argmax_window(a)


@query("win_baseline_mean", f"WITH {MONTHLY}, {grid_sql((6,))} SELECT cust_id, window_end, round(sum(CASE WHEN k BETWEEN 1 AND 3 THEN item_sum ELSE 0 END) / 3.0, 6) AS item_prev, 3 AS n_prev FROM (SELECT *, date_diff('month', report_month, window_end) AS k FROM held) GROUP BY 1, 2")
def win_baseline_mean(spark, sf_dir):
    series = X.month_series_arrays(monthly(spark, sf_dir), DATA_START, T_OBS, (6,), ["item"])
    mean, n = W.baseline_mean(F.col("item_months"), 1, 3)
    return rounded(series.select("cust_id", "window_end", mean.alias("item_prev"), n.alias("n_prev")))


_REF = lambda m, k: f"coalesce(max(CASE WHEN k = {k} THEN {m} END), 0)"
_PREV = lambda m: f"({_REF(m, 1)} + {_REF(m, 2)} + {_REF(m, 3)}) / 3.0::DOUBLE"
_RULES = (
    f"WITH {FEATURES_CTE}, kk AS (SELECT *, date_diff('month', report_month, window_end) AS k FROM held WHERE window_size = 6), "
    "mm AS (SELECT cust_id, window_end, " + ", ".join(f"{_REF(c, 0)} AS {n}_ref, {_PREV(c)} AS {n}_prev" for n, c in (("item", "item_sum"), ("revenue", "revenue_sum"), ("complaint", "complaint_sum"), ("delay", "delay_sum"), ("nodone", "nodone_sum"), ("order", "order_score_avg"), ("sat", "satisfaction_avg")))
    + ", avg(CASE WHEN k BETWEEN 1 AND 3 AND item_sum > 0 THEN CAST(revenue_sum AS DOUBLE) / item_sum END) AS value_prev FROM kk GROUP BY 1, 2), "
    "rr AS (SELECT cust_id, window_end, concat_ws('|', CASE WHEN complaint_ref > 1.15 * complaint_prev AND complaint_prev >= 1 THEN 'R_COMPLAINT_SPIKE' END, CASE WHEN delay_ref > 1.15 * delay_prev AND delay_prev >= 1 THEN 'R_DELAY_SPIKE' END, CASE WHEN nodone_ref > 1.15 * nodone_prev AND nodone_prev >= 1 THEN 'R_NODONE_SPIKE' END, "
    "CASE WHEN sat_ref < 0.85 * sat_prev THEN 'R_SATISFACTION_DROP' END, CASE WHEN order_ref < 0.85 * order_prev THEN 'R_ORDER_SCORE_DROP' END, CASE WHEN complaint_diversity >= 3 THEN 'R_COMPLAINT_DIVERSITY_HIGH' END) AS r, "
    "concat_ws('|', CASE WHEN item_ref < 0.5 * item_prev AND item_prev >= 5 THEN 'P_ITEM_DROP' END, CASE WHEN revenue_ref < 0.5 * revenue_prev AND revenue_prev > 0 THEN 'P_REVENUE_DROP' END, CASE WHEN revenue_ref / CASE WHEN item_ref > 0 THEN item_ref ELSE 1 END < 0.85 * value_prev THEN 'P_VALUE_PER_ITEM_DROP' END, "
    "CASE WHEN item_slope < 0 THEN 'P_ITEM_TREND_DOWN' END, CASE WHEN revenue_slope < 0 THEN 'P_REVENUE_TREND_DOWN' END, CASE WHEN cv_item >= 1 THEN 'P_CV_ITEM_HIGH' END, CASE WHEN service_types_used <= 1 THEN 'P_SERVICE_TYPES_LOW' END, CASE WHEN dominant_service_ratio >= 0.85 THEN 'P_DOMINANT_SERVICE_HIGH' END) AS p FROM mm JOIN (SELECT * FROM features WHERE window_size = 6) f USING (cust_id, window_end)) "
    "SELECT cust_id, window_end, CASE WHEN r <> '' AND p <> '' THEN 'mixed' WHEN r <> '' THEN 'reactive' WHEN p <> '' THEN 'proactive' END AS churn_type, nullif(r, '') AS reactive_reasons, nullif(p, '') AS proactive_reasons, "
    "string_split(concat_ws('|', nullif(r, ''), nullif(p, '')), '|')[1] AS reason_1 FROM rr"
)


@query("rule_reasons", _RULES)
def rule_reasons(spark, sf_dir):
    """Slopes and ratios are compared as rounded, as in the oracle."""
    read = (*[f"{m}_months" for m in Y.METRICS], "item_slope", "revenue_slope", "cv_item", "dominant_service_ratio", "service_types_used", "complaint_diversity")
    got = feature_rows(spark, sf_dir, (6,), columns=read).withColumns({c: F.round(F.col(c) * 1e9, 3) + F.lit(0.0) for c in ("item_slope", "revenue_slope")})
    got = Y.rule_reasons(got.withColumns({c: F.round(c, 6) for c in ("cv_item", "dominant_service_ratio")}))
    return got.select("cust_id", "window_end", "churn_type", "reactive_reasons", "proactive_reasons", F.coalesce("reason_1", F.lit("")).alias("reason_1"))


@query("global_reasons", f"WITH {SCORED}, m AS (SELECT quantile_cont(recency_days, 0.5) AS a, quantile_cont(item_last, 0.5) AS b FROM scored) SELECT cust_id, CASE WHEN recency_days > a THEN 'High recency_days' ELSE 'Low recency_days' END AS reason_1, CASE WHEN item_last > b THEN 'High item_last' ELSE 'Low item_last' END AS reason_2, 'Feature: gone' AS reason_3 FROM scored, m")
def global_reasons(spark, sf_dir):
    return Y.global_reasons(scored(spark, sf_dir).select("cust_id", "recency_days", "item_last"), ["recency_days", "item_last", "gone", "fourth"]).drop("recency_days", "item_last")


def _model_table(spark, sf_dir):
    f = facts(spark, sf_dir).na.fill(0.0)
    return f.withColumns({"y_smooth": F.col("y") * 0.9 + 0.05, "sample_weight": F.lit(1.0)})


_SMALL = M.ModelConfig(max_depth=4, rounds=10, learning_rate=0.1)


@query("train_model")
def train_model(spark, sf_dir):
    """Features by importance of a model trained on fractional labels."""
    model = M.train_model(staged(_model_table(spark, sf_dir), "train"), COLUMNS)
    return spark.createDataFrame(M.feature_importance(model, COLUMNS), "feature string, gain double")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Every feature with its gain, the largest first."""
    return train_model(spark, sf_dir).orderBy(F.col("gain").desc(), "feature")


@query("score_all")
def score_all(spark, sf_dir):
    table = staged(_model_table(spark, sf_dir), "train")
    got = M.top_percentile_cut(M.score(M.train_model(table, COLUMNS, _SMALL), table, COLUMNS), 0.5)
    return got.select("cust_id", "yr", "p", "churn_flag")


_FOLD_MIN = 5
_SEARCH_COLUMNS = ("item_sum", "recency", "revenue_avg")


def _fold_rows(spark, sf_dir, sizes):
    items = sent_items(spark, sf_dir)
    rows = feature_rows(spark, sf_dir, sizes, with_months=False, columns=_SEARCH_COLUMNS, items=items)
    return P.training_windows(rows, V.months_of(items), None, DATA_START, T_OBS, 2)


@query("walkforward_folds", _LABELS + f", own AS (SELECT window_size, window_end, dense_rank() OVER (ORDER BY window_end) - 1 AS k FROM labelled WHERE window_end BETWEEN DATE '1995-03-01' AND DATE '2001-04-01' AND item_sum >= 1), m AS (SELECT max(k) AS last FROM own), f AS (SELECT CAST(unnest(range(0, last - {_FOLD_MIN} + 1)) AS INT) AS fold FROM m) SELECT window_size, window_end, fold, CASE WHEN k < fold + {_FOLD_MIN} THEN 'train' ELSE 'valid' END AS part, count(*) AS n FROM own JOIN f ON k <= fold + {_FOLD_MIN} GROUP BY ALL")
def walkforward_folds(spark, sf_dir):
    """Rows of every part of every monthly fold."""
    rows = P.training_windows(_windows3(spark, sf_dir), V.cust_month(spark, sf_dir), 3, DATA_START, T_OBS, 2)
    n = rows.groupBy("window_size", "window_end").agg(F.count(F.lit(1)).alias("n"))
    return C.fold_plan(rows, _FOLD_MIN).join(n, ["window_size", "window_end"])


@query("walkforward_auc")
def walkforward_auc(spark, sf_dir):
    """AUC of every monthly fold of the windows of three months."""
    return C.fold_aucs(_fold_rows(spark, sf_dir, (3,)), _SEARCH_COLUMNS, "y_raw", _FOLD_MIN)


@query("window_search")
def window_search(spark, sf_dir):
    """Mean AUC over monthly folds of each size from 3 to the largest worth a search, and the best one."""
    months = (int(T_OBS[:4]) - int(DATA_START[:4])) * 12 + int(T_OBS[5:7]) - int(DATA_START[5:7]) + 1
    sizes = tuple(range(3, P.max_window(months, 2, _FOLD_MIN) + 1))
    sent = sent_items(spark, sf_dir, ("cust_id", "send_date", "total_fee"))
    by = sent.groupBy("cust_id", F.trunc("send_date", "month").alias("report_month")).agg(F.count(F.lit(1)).alias("item_count"), F.sum("total_fee").alias("total_fee"))
    measured = by.select("cust_id", "report_month", F.col("item_count").alias("item_sum"), F.col("total_fee").alias("revenue_sum"))
    rows = X.size_range_features(measured, sent, DATA_START, T_OBS, sizes[0], sizes[-1], _SEARCH_COLUMNS)
    # Every window begins inside the data, and its end leaves room for the horizon.
    own = rows.where((F.col("window_end") <= F.add_months(F.lit(T_OBS).cast("date"), -3)) & (F.col("item_sum") >= 1))
    table = staged(C.size_aucs(C.fold_aucs(P.build_label(own, by, 2), _SEARCH_COLUMNS, "y_raw", _FOLD_MIN), sizes), "search")
    return table.join(F.broadcast(M.argmax_window(table)), F.lit(True))  # one row


def monthly_runs(spark, sf_dir, path: str | None = None) -> tuple[str, list[dict]]:
    """Two monthly runs with one store: the month before the last, and the last one. Returns the store and both results."""
    path = path or shared_path(spark, "monthly")
    with methods_that_compile(spark):
        items, known, horizon = sent_items(spark, sf_dir), _confirmed_set(spark, sf_dir), 2
        months = staged(V.months_of(items), "run-months")
        # Labelled where the windows are made, once for both runs; so no run deals windows out again.
        windows = feature_rows(spark, sf_dir, (3,), columns=L.WINDOW_COLUMNS, items=items)
        table = staged(P.build_label(X.add_ewma(windows, size=3), months, horizon), "run-windows", group_rows=M.PART_ROWS // 2)
        gates = M.ModelConfig(max_depth=4, rounds=10, learning_rate=0.1, min_f05=0.10, min_pr_auc=0.05)
        runs = []
        for t_obs in (EARLIER_OBS, T_OBS):
            config = L.RunConfig(t_obs, DATA_START, horizon=horizon, model=gates, eval_months=3)
            upto = F.lit(t_obs).cast("date")
            runs.append(L.monthly_run(table.where(F.col("window_end") <= upto), months.where(F.col("report_month") <= upto), config, confirmed=known, store_path=path))
    return path, runs


@query("monthly_pipeline")
def monthly_pipeline(spark, sf_dir):
    """Customers scored by the last accepted model of the store, with reasons, in the second of two monthly runs."""
    _, runs = monthly_runs(spark, sf_dir)
    return runs[-1]["scored"].select("cust_id", "p", "churn_flag", "churn_type", "reason_1", "reason_2", "reason_3")


@query("flagship_revenue_drop", f"WITH {MONTHLY}, {grid_sql((3, 6))}, w AS (SELECT cust_id, window_size, avg(revenue_sum) AS r FROM held WHERE window_end = DATE '{T_OBS}' GROUP BY 1, 2) SELECT a.cust_id, round(b.r - a.r, 6) AS revenue_drop FROM w a JOIN w b ON a.cust_id = b.cust_id AND a.window_size = 3 AND b.window_size = 6")
def flagship_revenue_drop(spark, sf_dir):
    """Customers by how far their revenue of the last three months lies under that of the last six."""
    held = in_windows(spark, sf_dir, (3, 6)).where(F.col("window_end") == F.lit(T_OBS).cast("date"))
    by = held.groupBy("cust_id").agg(F.avg(F.when(F.col("window_size") == 3, F.col("revenue_sum"))).alias("a"), F.avg(F.when(F.col("window_size") == 6, F.col("revenue_sum"))).alias("b"))
    return rounded(by.where("a IS NOT NULL").select("cust_id", (F.col("b") - F.col("a")).alias("revenue_drop")))


# Extras


@query("label_multi_signal", f"WITH {FEATURES_CTE} SELECT cust_id, window_end, CASE WHEN item_sum = 0 OR cv_item >= 1 OR (item_range > 5 AND revenue_range > 300000) THEN 1 ELSE 0 END AS y FROM features WHERE window_size = 3")
def label_multi_signal(spark, sf_dir):
    f = rounded(feature_rows(spark, sf_dir, (3,), with_months=False, columns=("item_sum", "cv_item", "item_range", "revenue_range")))
    bad = (F.col("item_sum") == 0) | (F.col("cv_item") >= 1) | ((F.col("item_range") > 5) & (F.col("revenue_range") > 300000))
    return f.select("cust_id", "window_end", F.when(bad, 1).otherwise(0).alias("y"))


@query("clip_outliers", f"WITH {FACTS}, q AS (SELECT quantile_cont(fee, 0.001) AS a, quantile_cont(fee, 0.999) AS b FROM facts) SELECT cust_id, yr, round(greatest(least(fee, b), a), 6) AS fee FROM facts, q")
def clip_outliers(spark, sf_dir):
    f = facts(spark, sf_dir)
    q = percentiles(f, "fee", [0.001, 0.999]).select(F.get("percentiles", F.lit(0)).alias("a"), F.get("percentiles", F.lit(1)).alias("b"))
    return rounded(f.join(F.broadcast(q), F.lit(True)).select("cust_id", "yr", F.greatest(F.least("fee", "b"), "a").alias("fee")))  # one row


@query("lifetime_ratio_features", f"WITH {LIFETIME_CTE} SELECT m.cust_id, round(m.item_count / nullif(l.lifetime_total_items, 0), 6) AS item_share FROM cust_month m JOIN lifetime l USING (cust_id) WHERE m.report_month = DATE '{T_OBS}'")
def lifetime_ratio_features(spark, sf_dir):
    now = V.cust_month(spark, sf_dir).where(F.col("report_month") == F.lit(T_OBS).cast("date"))
    return rounded(now.join(lifetime(spark, sf_dir), "cust_id").select("cust_id", S.safe_ratio(F.col("item_count"), F.col("lifetime_total_items")).alias("item_share")))


@query("active_count_guard", f"WITH {SCORED} SELECT count(*) FILTER (recency_days <= 90) AS n_active, count(*) AS n, count(*) FILTER (recency_days <= 90) < 0.8 * count(*) AS blocked FROM scored")
def active_count_guard(spark, sf_dir):
    a = F.count_if(F.col("recency_days") <= 90)
    n = F.count(F.lit(1))
    return scored(spark, sf_dir).agg(a.alias("n_active"), n.alias("n"), (a < 0.8 * n).alias("blocked"))


@query("prevalence_guard", _LABELS + " SELECT round(avg(y_raw), 6) AS prevalence, avg(y_raw) > 0.45 AS blocked FROM labelled")
def prevalence_guard(spark, sf_dir):
    y = P.build_label(_windows3(spark, sf_dir), V.cust_month(spark, sf_dir), 2)
    return rounded(y.agg(F.avg("y_raw").alias("prevalence"), (F.avg("y_raw") > 0.45).alias("blocked")))
