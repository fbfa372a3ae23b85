"""Parcel views over the order tables, as DataFrames and as the same SQL for the oracle.

Customers send items (order lines); months, complaints, profiles and confirmed leavers follow from them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: First month of data and the month of observation; windows and labels stay inside.
DATA_START, T_OBS = "1995-01-01", "2001-07-01"
#: Letters of services in the order that breaks ties.
SERVICES = "cemprulq"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per parcel. The dimension sides are small tables; whether they are broadcast is left to Spark's size check."""
    t = lambda n: table(spark, sf_dir, n)
    home = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("home_region"))
    away = t("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("away_region"))
    flag = lambda c: F.when(c, 1).otherwise(0)
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return (
        t("lineitem")
        .join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(home, "c_nationkey")
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(away, "s_nationkey")
        .select(
            F.col("o_custkey").alias("cust_id"),
            F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("item_code"),
            F.to_date("o_orderdate").alias("send_date"),
            F.to_date("l_shipdate").alias("end_date"),
            F.floor("l_extendedprice").cast("long").alias("total_fee"),
            F.col("l_quantity").cast("long").alias("weight_kg"),
            F.greatest(days - 60, F.lit(0)).cast("long").alias("delay_day"),
            flag(F.col("l_returnflag") == "R").alias("refunded"),
            flag(F.col("l_returnflag") == "A").alias("noaccepted"),
            flag(F.col("o_orderstatus") == "P").alias("nodone"),
            flag(F.col("l_tax") >= 0.08).alias("lost"),
            flag((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("complaint"),
            flag(F.col("home_region") == F.col("away_region")).alias("intra"),
            flag(F.col("home_region") != F.col("away_region")).alias("international"),
            F.element_at(F.array(*map(F.lit, "CEMPR")), F.substring("o_orderpriority", 1, 1).cast("int")).alias("service"),
            F.round(F.col("l_discount") * 100).cast("long").alias("score_pct"),
            F.round((1 - F.col("l_tax")) * 100).cast("long").alias("satisfy_pct"),
            (F.col("l_suppkey") % 14).alias("complaint_code"),
            F.col("s_nationkey").alias("rec_province"),
            F.col("away_region").alias("region"),
        )
    )


def cust_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months_of(items(spark, sf_dir))


def _month_parts() -> dict[str, tuple[str | None, Column]]:
    """Measures of a month, the column of the items that each is made of (None: of the rows alone), and how."""
    total = lambda c: (c, F.sum(c).cast("long"))
    mean = lambda c: (c, F.sum(c).cast("double") / F.count(F.lit(1)) / 100)
    return {
        "item_count": (None, F.count(F.lit(1))),
        "weight_kg": total("weight_kg"),
        "total_fee": total("total_fee"),
        "intra_province": total("intra"),
        "international": total("international"),
        **{f"ser_{s}": ("service", F.count_if(F.col("service") == s.upper())) for s in SERVICES},
        "delay_day": total("delay_day"),
        "delay_count": ("delay_day", F.count_if(F.col("delay_day") > 0)),
        "nodone": total("nodone"),
        "refunded": total("refunded"),
        "noaccepted": total("noaccepted"),
        "lost_order": total("lost"),
        "lastday": (None, F.max(F.dayofmonth("send_date")).cast("long")),
        "order_score": mean("score_pct"),
        "satisfaction_score": mean("satisfy_pct"),
        "total_complaint": total("complaint"),
    }


def month_reads(measures: Iterable[str]) -> list[str]:
    """Columns of the items that these measures of a month are made of."""
    parts = _month_parts()
    return list(dict.fromkeys(["cust_id", "send_date", *(c for m in measures if (c := parts[m][0]))]))


def months_of(sent: DataFrame) -> DataFrame:
    """One row per customer and month of sending; measures of columns that ``sent`` doesn't have are left out."""
    parts = {n: e for n, (c, e) in _month_parts().items() if c is None or c in sent.columns}
    return sent.groupBy("cust_id", F.trunc("send_date", "month").alias("report_month")).agg(*[e.alias(n) for n, e in parts.items()])


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complaints_of(items(spark, sf_dir))


def complaints_of(sent: DataFrame) -> DataFrame:
    return sent.where("complaint = 1").select("cust_id", F.col("end_date").alias("create_date"), "complaint_code")


def cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("cust_id"),
        F.when(F.col("c_custkey") % 3 == 0, F.length("c_mktsegment")).alias("custype"),
        F.col("c_nationkey").alias("province"),
        F.when(F.col("c_custkey") % 4 == 0, (F.col("c_custkey") % 120).cast("int")).alias("tenure"),
        F.when(F.col("c_custkey") % 5 == 0, F.date_add(F.lit("1995-06-15").cast("date"), (F.col("c_custkey") % 900).cast("int"))).alias("contract_date"),
    )


def confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of confirmed leavers as text, some padded and some blank."""
    k = F.col("c_custkey")
    text = F.when(k % 60 == 0, F.concat(F.lit("  "), k.cast("string"), F.lit(" "))).when(k % 100 == 0, F.lit("  ")).otherwise(k.cast("string"))
    return table(spark, sf_dir, "customer").where(k % 20 == 0).select(text.alias("key"))


#: The same views as CTEs; used as ``WITH {VIEWS} SELECT ...``.
VIEWS = """
items AS (
  SELECT o_custkey AS cust_id, concat(l_orderkey, '-', l_linenumber) AS item_code, CAST(o_orderdate AS DATE) AS send_date,
    CAST(l_shipdate AS DATE) AS end_date, CAST(floor(l_extendedprice) AS BIGINT) AS total_fee, CAST(l_quantity AS BIGINT) AS weight_kg,
    CAST(greatest(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) - 60, 0) AS BIGINT) AS delay_day,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS refunded, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS noaccepted,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS nodone, CASE WHEN l_tax >= 0.08 THEN 1 ELSE 0 END AS lost,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS complaint,
    CASE WHEN h.n_regionkey = a.n_regionkey THEN 1 ELSE 0 END AS intra, CASE WHEN h.n_regionkey <> a.n_regionkey THEN 1 ELSE 0 END AS international,
    substr('CEMPR', CAST(substr(o_orderpriority, 1, 1) AS INT), 1) AS service,
    CAST(round(l_discount * 100) AS BIGINT) AS score_pct, CAST(round((1 - l_tax) * 100) AS BIGINT) AS satisfy_pct,
    l_suppkey % 14 AS complaint_code, s_nationkey AS rec_province, a.n_regionkey AS region
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation h ON c_nationkey = h.n_nationkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON s_nationkey = a.n_nationkey),
cust_month AS (
  SELECT cust_id, CAST(date_trunc('month', send_date) AS DATE) AS report_month, count(*) AS item_count, CAST(sum(weight_kg) AS BIGINT) AS weight_kg,
    CAST(sum(total_fee) AS BIGINT) AS total_fee, CAST(sum(intra) AS BIGINT) AS intra_province, CAST(sum(international) AS BIGINT) AS international,
    count(*) FILTER (service = 'C') AS ser_c, count(*) FILTER (service = 'E') AS ser_e, count(*) FILTER (service = 'M') AS ser_m,
    count(*) FILTER (service = 'P') AS ser_p, count(*) FILTER (service = 'R') AS ser_r, count(*) FILTER (service = 'U') AS ser_u,
    count(*) FILTER (service = 'L') AS ser_l, count(*) FILTER (service = 'Q') AS ser_q,
    CAST(sum(delay_day) AS BIGINT) AS delay_day, count(*) FILTER (delay_day > 0) AS delay_count, CAST(sum(nodone) AS BIGINT) AS nodone,
    CAST(sum(refunded) AS BIGINT) AS refunded, CAST(sum(noaccepted) AS BIGINT) AS noaccepted, CAST(sum(lost) AS BIGINT) AS lost_order,
    CAST(max(day(send_date)) AS BIGINT) AS lastday, CAST(sum(score_pct) AS DOUBLE) / count(*) / 100 AS order_score,
    CAST(sum(satisfy_pct) AS DOUBLE) / count(*) / 100 AS satisfaction_score, CAST(sum(complaint) AS BIGINT) AS total_complaint
  FROM items GROUP BY 1, 2),
complaints AS (SELECT cust_id, end_date AS create_date, complaint_code FROM items WHERE complaint = 1),
cust_info AS (
  SELECT c_custkey AS cust_id, CASE WHEN c_custkey % 3 = 0 THEN length(c_mktsegment) END AS custype, c_nationkey AS province,
    CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 120 AS INT) END AS tenure,
    CASE WHEN c_custkey % 5 = 0 THEN DATE '1995-06-15' + CAST(c_custkey % 900 AS INT) END AS contract_date FROM customer),
confirmed AS (
  SELECT CASE WHEN c_custkey % 60 = 0 THEN concat('  ', c_custkey, ' ') WHEN c_custkey % 100 = 0 THEN '  ' ELSE CAST(c_custkey AS VARCHAR) END AS key
  FROM customer WHERE c_custkey % 20 = 0)
"""
