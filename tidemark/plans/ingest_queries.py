"""Ingest, source and sink queries. Text that casts work on is made from the order tables by the same SQL in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import ingest as I
from tidemark.plans import views as V
from tidemark.plans.registry import query, rounded
from tidemark.plans.views import DATA_START, T_OBS
from tidemark.sources import readers as R
from tidemark.sources import sinks as K
from tidemark.sources.published import published
from tidemark.sources.tables import shared_path, staged


def _sql(spark: SparkSession, sf_dir: str, text: str, **views: DataFrame) -> DataFrame:
    """Spark SQL over named DataFrames (of the order tables unless given)."""
    return spark.sql(text, **views)


_TEXT = """
SELECT o_orderkey AS k,
  CASE o_orderkey % 9 WHEN 0 THEN concat(' ', CAST(o_custkey AS {s}), ' ') WHEN 1 THEN 'true' WHEN 2 THEN 'NO' WHEN 3 THEN 'N/A' WHEN 4 THEN ''
    WHEN 5 THEN concat(CAST(o_custkey AS {s}), '.5') WHEN 6 THEN concat('-', CAST(o_custkey AS {s})) WHEN 7 THEN concat(CAST(o_custkey AS {s}), ' 000') ELSE 'x' END AS number_text,
  CASE o_orderkey % 6 WHEN 0 THEN concat(CAST(o_custkey AS {s}), ',', CAST(o_orderkey % 1000 AS {s})) WHEN 1 THEN 'NULL' WHEN 2 THEN 'abc'
    WHEN 3 THEN concat(CAST(o_custkey AS {s}), '.25 kg') WHEN 4 THEN 'none' ELSE concat('-', CAST(o_custkey AS {s})) END AS decimal_text,
  CASE o_orderkey % 8 WHEN 0 THEN concat(substr(CAST(o_orderdate AS {s}), 3, 8)) WHEN 1 THEN substr(CAST(o_orderdate AS {s}), 1, 10) WHEN 2 THEN replace(substr(CAST(o_orderdate AS {s}), 1, 10), '-', '/')
    WHEN 3 THEN concat(substr(CAST(o_orderdate AS {s}), 9, 2), '/', substr(CAST(o_orderdate AS {s}), 6, 2), '/', substr(CAST(o_orderdate AS {s}), 1, 4)) WHEN 4 THEN 'bad'
    WHEN 5 THEN concat(substr(CAST(o_orderdate AS {s}), 1, 10), ' 12:30:15.250000') WHEN 6 THEN concat(substr(CAST(o_orderdate AS {s}), 1, 10), ' 01:02:03') ELSE 'nan' END AS time_text,
  CASE o_orderkey % 7 WHEN 0 THEN ' NULL ' WHEN 1 THEN 'None' WHEN 2 THEN '#n/a' WHEN 3 THEN '<NA>' WHEN 4 THEN concat('  ', o_orderpriority, '  ') WHEN 5 THEN 'nat' ELSE o_orderpriority END AS word,
  CASE o_orderkey % 5 WHEN 0 THEN concat('call 12345678 ', o_orderpriority, chr(10), 'x') WHEN 1 THEN concat('a', chr(92), 'n b  ', o_orderstatus) WHEN 2 THEN '87654321' WHEN 3 THEN concat('=', o_orderpriority) ELSE concat('@', o_orderstatus) END AS note
FROM {t}"""


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_TEXT.format(s="STRING", t="{orders}"), orders=V.table(spark, sf_dir, "orders"))


TEXT = f"raw AS ({_TEXT.format(s='VARCHAR', t='orders')})"

_INT = r"""CASE WHEN upper(trim({c})) IN ('', 'NULL', 'NAN', 'N/A', 'NONE') THEN NULL WHEN upper(trim({c})) IN ('T', 'TRUE', 'Y', 'YES', '1') THEN 1
  WHEN upper(trim({c})) IN ('F', 'FALSE', 'N', 'NO', '0') THEN 0 ELSE TRY_CAST(nullif(regexp_replace(upper(trim({c})), '[^0-9\-]', '', 'g'), '') AS BIGINT) END"""
_DEC = r"""CASE WHEN upper(trim({c})) IN ('', 'NULL', 'NAN', 'N/A') THEN NULL ELSE CAST(round(TRY_CAST(nullif(regexp_replace(replace(upper(trim({c})), ',', '.'), '[^0-9.\-]', '', 'g'), '') AS DOUBLE), 3) AS DECIMAL(18,3)) END"""
_TIME = """CASE WHEN lower(trim({c})) IN ('', 'null', 'nan') THEN NULL ELSE coalesce(
  CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} [0-9:]+\\.\\d+') THEN date_trunc('second', TRY_CAST({c} AS TIMESTAMP)) END,
  CASE WHEN regexp_full_match({c}, '\\d{{2}}-\\d{{2}}-\\d{{2}}') THEN try_strptime({c}, '%y-%m-%d') END,
  CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}} [0-9:]+') THEN try_strptime({c}, '%Y-%m-%d %H:%M:%S') END,
  CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_strptime({c}, '%Y-%m-%d') END,
  CASE WHEN regexp_full_match({c}, '\\d{{4}}/\\d{{2}}/\\d{{2}}') THEN try_strptime({c}, '%Y/%m/%d') END,
  CASE WHEN regexp_full_match({c}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN try_strptime({c}, '%d/%m/%Y') END) END"""
_STR = "CASE WHEN upper(trim({c})) IN ('', 'NULL', 'NAN', 'N/A', 'NONE', '#N/A') THEN NULL ELSE trim({c}) END"
_CELL = "CASE WHEN lower(trim({c})) IN ('', 'nan', 'none', 'nat', '<na>') THEN NULL ELSE trim({c}) END"


def _cast_query(name: str, column: str, expression: str, function) -> None:
    @query(name, f"WITH {TEXT} SELECT k, {expression.format(c=column)} AS v FROM raw", views=False)
    def run(spark, sf_dir):
        return raw_text(spark, sf_dir).select("k", function(F.col(column)).alias("v"))


def _plain(name: str, sql: str):
    return query(name, sql, views=False)


_cast_query("cast_int_safe", "number_text", _INT, S.to_int)
_cast_query("cast_decimal_safe", "decimal_text", _DEC, S.to_decimal)
_cast_query("cast_timestamp_safe", "time_text", _TIME, S.to_timestamp_any)
_cast_query("cast_month", "time_text", f"CAST({_TIME} AS DATE)", S.to_report_month)
_cast_query("clean_string", "word", _STR, S.clean_string)
_cast_query("clean_label_cell", "word", _CELL, S.clean_label_cell)
_cast_query("clean_free_text", "note", r"nullif(trim(regexp_replace(regexp_replace({c}, '[0-9]{{8}}|\\n|\\r\\n|\\r|[\r\n]|\\\\', ' ', 'g'), '\s+', ' ', 'g')), '')", S.clean_free_text)
_cast_query(
    "pseudonymise_key", "word", "CASE WHEN trim({c}) <> '' THEN 'ENC_' || upper(substr(md5(upper(trim({c})) || 'salt'), 1, 16)) END", lambda c: S.pseudonymise_key(c, "salt")
)
_cast_query("proj_null_key_norm", "word", "nullif(trim({c}), '')", S.null_key)


def _typed_query(name: str, which: str, columns: dict[str, tuple[str, str]]) -> None:
    """A raw table with some columns of its contract filled from the text; the rest is null and left out of the result."""
    sql = ", ".join(f"{expression.format(c=source)} AS {c}" for c, (source, expression) in columns.items())

    @query(name, f"WITH {TEXT} SELECT k, {sql} FROM raw", views=False)
    def run(spark, sf_dir):
        raw = raw_text(spark, sf_dir).withColumns({c: F.col(s) for c, (s, _) in columns.items()})
        return I.typed(raw, which, ["k"]).select("k", *columns)


_typed_query("typed_orderitem", "orderitem", {"item_code": ("word", _STR), "total_fee": ("number_text", _INT), "weight_kg": ("decimal_text", _DEC), "sending_time": ("time_text", _TIME), "lost_order": ("number_text", _INT)})
_typed_query("typed_customer_month", "customer_month", {"cms_code_enc": ("word", _STR), "report_month": ("time_text", f"CAST({_TIME} AS DATE)"), "item_count": ("number_text", _INT), "order_score": ("decimal_text", _DEC)})
_typed_query("typed_customer_info", "customer_info", {"cms_code_enc": ("word", _STR), "tenure": ("number_text", _INT), "contract_sig_first": ("time_text", _TIME)})
_typed_query("typed_complaint", "complaint", {"cms_code_enc": ("word", _STR), "complaint_code": ("number_text", _INT), "create_complaint_date": ("time_text", _TIME), "complaint_content": ("note", _STR)})


@_plain("guard_formula_cells", f"WITH {TEXT} SELECT k, CASE WHEN substr(note, 1, 1) IN ('=', '@') THEN chr(39) || note ELSE note END AS note FROM raw")
def guard_formula_cells(spark, sf_dir):
    return I.guard_cells(raw_text(spark, sf_dir).select("k", "note"), ["note"])[0]


@query("dedup_natural_key", "SELECT item_code, send_date, total_fee, cust_id FROM (SELECT *, row_number() OVER (PARTITION BY item_code ORDER BY send_date DESC, total_fee DESC, cust_id, weight_kg) AS r FROM items) WHERE r = 1")
def dedup_natural_key(spark, sf_dir):
    got = I.dedup_natural_key(V.items(spark, sf_dir), ["item_code"], [F.col("send_date").desc(), F.col("total_fee").desc(), F.col("cust_id"), F.col("weight_kg")])
    return got.select("item_code", "send_date", "total_fee", "cust_id")


@query("win_dedup", "SELECT cust_id, send_date, max(total_fee) AS total_fee FROM items GROUP BY 1, 2")
def win_dedup(spark, sf_dir):
    got = I.dedup_natural_key(V.items(spark, sf_dir), ["cust_id", "send_date"], [F.col("total_fee").desc(), F.col("item_code")])
    return got.select("cust_id", "send_date", "total_fee")


@query("dedup_all_columns", "SELECT DISTINCT cust_id, service, region FROM items")
def dedup_all_columns(spark, sf_dir):
    return I.dedup_all_columns(V.items(spark, sf_dir).select("cust_id", "service", "region"))


@query("delete_using", "SELECT cust_id, report_month, item_count FROM cust_month c WHERE NOT EXISTS (SELECT 1 FROM complaints x WHERE x.cust_id = c.cust_id AND date_trunc('month', x.create_date) = c.report_month)")
def delete_using(spark, sf_dir):
    late = V.complaints(spark, sf_dir).select("cust_id", F.trunc("create_date", "month").alias("report_month"))
    return I.delete_using(V.cust_month(spark, sf_dir).select("cust_id", "report_month", "item_count"), late, ["cust_id", "report_month"])


@query(
    "ingest_reconcile",
    "WITH f AS (SELECT concat('items_', year(send_date), '.csv') AS file, item_code FROM items) SELECT file, count(*) AS rows_in_csv, count(*) AS rows_staged, count(DISTINCT item_code) AS rows_inserted, count(*) - count(DISTINCT item_code) AS rows_deduplicated, CAST(0 AS DOUBLE) AS diff_pct, true AS passed FROM f GROUP BY 1",
)
def ingest_reconcile(spark, sf_dir):
    read = V.items(spark, sf_dir).select(F.concat(F.lit("items_"), F.year("send_date"), F.lit(".csv")).alias("file"), "item_code")
    return I.reconcile(read, read, read.dropDuplicates(), ["file"])


_FILES = "SELECT concat('drop_', CAST(o_custkey AS {s}), '.zip') AS zip_name, md5(concat('c', CAST(o_custkey % 3 AS {s}))) AS md5_hash FROM {t} WHERE o_orderkey % 2 = 0 GROUP BY o_custkey"
_LOG = "SELECT concat('drop_', CAST(o_custkey AS {s}), '.zip') AS zip_name, CASE WHEN o_orderkey % 4 = 1 THEN 'failed' ELSE 'success' END AS status, CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderdate AS DATE) END AS finished_at, md5(concat('c', CAST(o_orderkey % 3 AS {s}))) AS md5_hash FROM {t} WHERE o_orderkey % 5 < 2"
_LAST = f"files AS ({_FILES.format(s='VARCHAR', t='orders')}), log AS ({_LOG.format(s='VARCHAR', t='orders')}), last AS (SELECT zip_name, status, finished_at, md5_hash FROM (SELECT *, row_number() OVER (PARTITION BY zip_name ORDER BY finished_at DESC NULLS LAST, md5_hash, status) AS r FROM log) WHERE r = 1)"


def _files(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o = V.table(spark, sf_dir, "orders")
    log = spark.sql(_LOG.format(s="STRING", t="{orders}"), orders=o)
    # Several log rows of one file can finish on one day; one of each (file, day, hash) is enough.
    log = log.groupBy("zip_name", "finished_at", "md5_hash").agg(F.min("status").alias("status"))
    return spark.sql(_FILES.format(s="STRING", t="{orders}"), orders=o), log


@_plain("win_latest_status", f"WITH {_LAST} SELECT * FROM last")
def win_latest_status(spark, sf_dir):
    return I.latest_status(_files(spark, sf_dir)[1]).select("zip_name", "status", "finished_at", "md5_hash")


@_plain(
    "content_idempotency",
    "SELECT o_orderpriority AS drop_name, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'skip' ELSE 'process' END AS action, "
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'unchanged' WHEN '2' THEN 'changed' WHEN '3' THEN 'retry' WHEN '4' THEN 'changed' ELSE 'new' END AS reason FROM orders GROUP BY o_orderpriority",
)
def content_idempotency(spark, sf_dir):
    """Orders come as a file for each priority. Of the second delivery 1 and 3 have the same bytes as in the first, 2 and 4
    have others, 5 is new; the first load of 3 failed. Hashes are of the bytes on disk."""
    path = shared_path(spark, "delivery")
    o = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("drop"))
    digit = F.substring("drop", 1, 1)
    R.write_drops(o.where(digit != "5"), f"{path}/first", ["drop"])
    R.write_drops(o.where(~digit.isin("1", "3")).withColumn("o_totalprice", F.col("o_totalprice") + 1), f"{path}/second", ["drop"])
    R.copy_drops(spark, f"{path}/first", f"{path}/second", "drop=[13]*")
    name = F.regexp_extract("path", r"/drop=([^/]+)/", 1)
    log = R.file_hashes(spark, f"{path}/first").select(name.alias("zip_name"), F.when(name.startswith("3"), "failed").otherwise("success").alias("status"), F.current_date().alias("finished_at"), F.col("md5").alias("md5_hash"))
    files = R.file_hashes(spark, f"{path}/second").select(name.alias("zip_name"), F.col("md5").alias("md5_hash"))
    return I.plan_files(files, log).select(F.col("zip_name").alias("drop_name"), "action", "reason")


_DROPS = "SELECT concat(o_orderpriority, '_', {ym}, '.zip') AS zip_name, o_orderpriority AS base, CASE WHEN o_orderpriority = '5-LOW' THEN 'snapshot' ELSE 'monthly' END AS mode, {ym} AS period, max(CASE WHEN o_orderkey % 400 = 0 THEN 1 ELSE 0 END) AS ok FROM {t} GROUP BY 1, 2, 3, 4"


@_plain(
    "select_drops",
    f"WITH d AS ({_DROPS.format(ym=chr(115) + 'trftime(o_orderdate, ' + chr(39) + '%y%m' + chr(39) + ')', t='orders')}), r AS (SELECT *, row_number() OVER (PARTITION BY base, mode ORDER BY period DESC, zip_name) AS r FROM d) SELECT zip_name, base, mode, period FROM r WHERE (mode = 'snapshot' AND r = 1) OR (mode = 'monthly' AND (r <= 2 OR ok = 0))",
)
def select_drops(spark, sf_dir):
    drops = spark.sql(_DROPS.format(ym="date_format(o_orderdate, 'yyMM')", t="{orders}"), orders=V.table(spark, sf_dir, "orders"))
    return I.select_drops(drops.drop("ok"), drops.where("ok = 1")).select("zip_name", "base", "mode", "period")


@_plain(
    "parse_drop_name",
    "WITH n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN concat('cas_customer_', strftime(o_orderdate, '%y%m'), '.zip') WHEN o_orderkey % 3 = 1 THEN concat('cas_info_update_', strftime(o_orderdate, '%d%m%y'), '.zip') ELSE 'readme.txt' END AS name, o_orderdate AS d FROM orders) "
    "SELECT k, CASE k % 3 WHEN 0 THEN 'cas_customer' WHEN 1 THEN 'cas_info' ELSE 'readme' END AS base, CASE k % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'snapshot' END AS mode, CASE k % 3 WHEN 0 THEN '20' || strftime(d, '%y%m') WHEN 1 THEN '20' || strftime(d, '%y%m%d') END AS period FROM n",
)
def parse_drop_name(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    name = F.when(k % 3 == 0, F.concat(F.lit("cas_customer_"), F.date_format(d, "yyMM"), F.lit(".zip"))).when(k % 3 == 1, F.concat(F.lit("cas_info_update_"), F.date_format(d, "ddMMyy"), F.lit(".zip"))).otherwise("readme.txt")
    return V.table(spark, sf_dir, "orders").select(k.alias("k"), *I.parse_drop_name(name))


_PARTS = "SELECT DISTINCT concat(CASE WHEN o_orderkey % 40 = 0 THEN 'other' ELSE 'bccp' END, '_0101_', {md}, '-0131.csv') AS name FROM {t} WHERE {m} = 1"


@_plain(
    "order_parts",
    "WITH p AS (" + _PARTS.format(md="strftime(o_orderdate, '%m%d')", m="month(o_orderdate)", t="orders") + ") SELECT name, row_number() OVER (ORDER BY CASE WHEN name LIKE 'bccp%' THEN 0 ELSE 1 END, name) AS file_seq FROM p",
)
def order_parts(spark, sf_dir):
    names = spark.sql(_PARTS.format(md="date_format(o_orderdate, 'MMdd')", m="month(o_orderdate)", t="{orders}"), orders=V.table(spark, sf_dir, "orders"))
    return I.order_parts(names, "name", "bccp", "0101")


@query("dup_check", "WITH p AS (SELECT cust_id, send_date, count(*) AS n FROM items GROUP BY 1, 2) SELECT max(n) AS max_rows_per_key, count(*) AS n_keys, count(*) FILTER (n > 1) AS n_dup_keys, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_in_dup_keys FROM p")
def dup_check(spark, sf_dir):
    return I.dup_check(V.items(spark, sf_dir), ["cust_id", "send_date"])


@_plain(
    "proj_key_fallback",
    f"WITH {TEXT}, c AS (SELECT k, {_CELL.format(c='word')} AS a, {_CELL.format(c='number_text')} AS b FROM raw) SELECT k, coalesce(a, b) AS key, CASE WHEN a IS NOT NULL THEN 'word' ELSE 'number_text' END AS key_type FROM c WHERE coalesce(a, b) IS NOT NULL",
)
def proj_key_fallback(spark, sf_dir):
    return I.key_fallback(raw_text(spark, sf_dir), "word", "number_text").select("k", "key", "key_type")


# Sources


@_plain("scan_delimited", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def scan_delimited(spark, sf_dir):
    """The customers written as delimited text with a header, and read back."""
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    path = shared_path(spark, "delimited")
    V.table(spark, sf_dir, "customer").select(*columns).write.options(sep=";", header=True).csv(path)
    return R.split_ragged(R.read_delimited(spark, path, columns))[0]


@_plain("reject_ragged", "SELECT concat(c_custkey, ';', c_name, ';extra') AS line FROM customer WHERE c_custkey % 10 = 0")
def reject_ragged(spark, sf_dir):
    """A tenth of the lines has a column too many; those are the rejects."""
    k = F.col("c_custkey")
    path = shared_path(spark, "ragged")
    lines = V.table(spark, sf_dir, "customer").select(F.concat(k, F.lit(";"), "c_name", F.when(k % 10 == 0, ";extra").otherwise("")).alias("line"))
    lines.write.text(path)
    read = spark.read.schema("k string, name string, _ragged string").options(sep=";", header=False, columnNameOfCorruptRecord="_ragged").csv(path)
    return R.split_ragged(staged(read, "ragged"))[1].select(F.col("_ragged").alias("line"))


def _written_heads(spark, lines, order: str, head: int = R.HEAD_LINES):
    """Lines (file, ``order``, line) written as one text file per name, and the heads of the files as they are read."""
    path = shared_path(spark, "texts")
    lines.repartition("file").sortWithinPartitions("file", order, "line").select("file", "line").write.partitionBy("file").text(path)
    return R.read_head(spark, path, head).withColumn("file", F.url_decode(F.url_decode(F.regexp_extract("file", "/file=([^/]+)/", 1))))


_LINES = "SELECT o_orderpriority AS file, o_orderkey AS n, concat(CAST(o_orderkey AS {s}), {d}, CAST(o_custkey AS {s}), {d}, o_orderstatus) AS line FROM {t}"
_D = "CASE o_orderpriority WHEN '1-URGENT' THEN ',' WHEN '2-HIGH' THEN ';' WHEN '3-MEDIUM' THEN '|' ELSE chr(9) END"


@_plain(
    "scan_sniffed",
    "WITH l AS (" + _LINES.format(s="VARCHAR", d=_D, t="orders") + "), h AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY n, line) - 1 AS line_no FROM l), "
    "c AS (SELECT file, min(length(line) - length(replace(line, ',', ''))) AS a, min(length(line) - length(replace(line, ';', ''))) AS b, min(length(line) - length(replace(line, chr(9), ''))) AS t, min(length(line) - length(replace(line, '|', ''))) AS p FROM h WHERE line_no < 1000 GROUP BY 1) "
    "SELECT file, CASE WHEN a >= greatest(b, t, p) THEN ',' WHEN b >= greatest(t, p) THEN ';' WHEN t >= p THEN chr(9) ELSE '|' END AS delimiter, greatest(a, b, t, p) AS least FROM c",
)
def scan_sniffed(spark, sf_dir):
    """The orders written as one text file per priority, each with its own delimiter, and their heads read."""
    lines = spark.sql(_LINES.format(s="STRING", d=_D, t="{orders}"), orders=V.table(spark, sf_dir, "orders"))
    return R.sniff_delimiters(_written_heads(spark, lines, "n"))


_HEADERS = "SELECT DISTINCT concat('f', CAST(c_custkey % 50 AS {s}), '.csv') AS file, CASE WHEN c_custkey % 50 % 7 = 0 THEN 'a;b' WHEN c_custkey % 50 % 11 = 0 THEN 'a;b;x' ELSE 'a; b;c' END AS header FROM {t}"


@_plain(
    "header_contract",
    "WITH h AS (" + _HEADERS.format(s="VARCHAR", t="customer") + ") SELECT file, CASE WHEN header = 'a;b' THEN 'bad_count' WHEN header <> (SELECT header FROM h ORDER BY file LIMIT 1) THEN 'differs_from_first' WHEN header = 'a;b;x' THEN 'renamed' ELSE 'ok' END AS status, len(string_split(header, ';')) AS n_columns, CASE WHEN header = 'a;b;x' THEN 1 WHEN header = 'a; b;c' THEN 0 END AS renamed FROM h",
)
def header_contract(spark, sf_dir):
    """The customers written as fifty files with a header, and the headers read."""
    customer = V.table(spark, sf_dir, "customer")
    headers = spark.sql(_HEADERS.format(s="STRING", t="{customer}"), customer=customer).select("file", F.lit(-1).cast("long").alias("n"), F.col("header").alias("line"))
    body = customer.select(F.concat(F.lit("f"), (F.col("c_custkey") % 50).cast("string"), F.lit(".csv")).alias("file"), F.col("c_custkey").cast("long").alias("n"), F.concat_ws(";", "c_custkey", "c_name", "c_mktsegment").alias("line"))
    heads = _written_heads(spark, headers.unionByName(body), "n", 1)
    return R.check_headers(heads.select("file", F.col("line").alias("header")), ["a", "b", "c"])


@query("scan_monthly_partitions", "SELECT cust_id, report_month, item_count FROM cust_month WHERE report_month BETWEEN DATE '1998-03-01' AND DATE '1998-08-01'")
def scan_monthly_partitions(spark, sf_dir):
    """Months written as partitions, but for one; the scan reads five of them and takes the missing one from the base table."""
    path = shared_path(spark, "months")
    base = V.cust_month(spark, sf_dir).select("cust_id", "report_month", "item_count")
    base.where("report_month <> DATE '1998-06-01'").write.partitionBy("report_month").parquet(path)
    return R.scan_months_or_base(spark.read.parquet(path), base, "report_month", "1998-03-01", "1998-08-01").select("cust_id", "report_month", "item_count")


@_plain("scan_labels", "SELECT CAST(c_custkey AS VARCHAR) AS cms_code_enc, concat('label_24', CASE WHEN c_custkey % 3 + 1 < 10 THEN '0' ELSE '' END, c_custkey % 3 + 1) AS drop_name, CAST(2401 + c_custkey % 3 AS INT) AS yymm FROM customer")
def scan_labels(spark, sf_dir):
    """Customers written as one label drop per month, and read by file name."""
    path = shared_path(spark, "labels")
    c = V.table(spark, sf_dir, "customer")
    for m in range(3):
        c.where(F.col("c_custkey") % 3 == m).select(F.col("c_custkey").alias("cms_code_enc")).write.option("header", True).csv(f"{path}/label_24{m + 1:02d}")
    return R.read_labels(spark, path).select("cms_code_enc", F.col("source_file").alias("drop_name"), "yymm")


@query("discover_latest_month", "SELECT CAST(max(date_trunc('month', report_month)) AS DATE) AS t_obs FROM cust_month")
def discover_latest_month(spark, sf_dir):
    return R.detect_t_obs(V.cust_month(spark, sf_dir), "report_month")


# Sinks


@query("sink_full_reload", "SELECT cust_id, CASE WHEN year(report_month) = 2000 THEN item_count * 2 ELSE item_count END AS item_count, CAST(year(report_month) AS INT) AS y, report_month FROM cust_month")
def sink_full_reload(spark, sf_dir):
    """All years are loaded, then the year 2000 again with other values: only its partition changes."""
    path = shared_path(spark, "reload")
    months = V.cust_month(spark, sf_dir).select("cust_id", "report_month", "item_count", F.year("report_month").alias("y"))
    K.full_reload(months, path, ["y"])
    K.full_reload(months.where("y = 2000").withColumn("item_count", F.col("item_count") * 2), path, ["y"])
    return published(spark, path)


_OLD, _NEW = "SELECT o_custkey AS k, max(o_orderkey) AS v, count(*) AS n FROM {t} WHERE o_orderkey % 3 = 0 GROUP BY 1", "SELECT o_custkey AS k, max(o_orderkey) AS v, count(*) AS n FROM {t} WHERE o_orderkey % 3 = 1 GROUP BY 1"


def _old_new(spark, sf_dir):
    o = V.table(spark, sf_dir, "orders")
    return spark.sql(_OLD.format(t="{orders}"), orders=o), spark.sql(_NEW.format(t="{orders}"), orders=o)


@_plain("sink_upsert", f"WITH a AS ({_OLD.format(t='orders')}), b AS ({_NEW.format(t='orders')}) SELECT * FROM b UNION ALL SELECT * FROM a WHERE k NOT IN (SELECT k FROM b)")
def sink_upsert(spark, sf_dir):
    """Two loads into one published table."""
    path = shared_path(spark, "upsert")
    old, new = _old_new(spark, sf_dir)
    K.upsert_published(old, path, ["k"])
    return K.upsert_published(new, path, ["k"])


@_plain("sink_partial_upsert", f"WITH a AS ({_OLD.format(t='orders')}), b AS ({_NEW.format(t='orders')}) SELECT k, coalesce(b.v, a.v) AS v, coalesce(a.n, b.n) AS n FROM a FULL JOIN b USING (k)")
def sink_partial_upsert(spark, sf_dir):
    return K.partial_upsert(*_old_new(spark, sf_dir), ["k"], ["v"])


_EVENTS = "SELECT o_custkey AS run_id, o_orderdate AS ts, o_orderkey AS seq, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS notes FROM {t}"


@_plain("run_log", f"WITH e AS ({_EVENTS.format(t='orders')}) SELECT run_id, arg_max(seq, (ts, seq)) AS seq, arg_max(status, (ts, seq)) FILTER (status IS NOT NULL) AS status, arg_max(notes, (ts, seq)) FILTER (notes IS NOT NULL) AS notes FROM e GROUP BY 1")
def run_log(spark, sf_dir):
    return K.run_log(spark.sql(_EVENTS.format(t="{orders}"), orders=V.table(spark, sf_dir, "orders")), at="ts", order=["seq"])


@query("audit_append", "SELECT CAST(year(send_date) AS INT) AS y, count(*) AS rows_inserted FROM items GROUP BY 1")
def audit_append(spark, sf_dir):
    """One audit row per year of items, appended in two runs."""
    path = shared_path(spark, "audit")
    rows = V.items(spark, sf_dir).groupBy(F.year("send_date").alias("y")).agg(F.count(F.lit(1)).alias("rows_inserted"))
    K.audit_append(rows.where("y < 1998"), path)
    K.audit_append(rows.where("y >= 1998"), path)
    return spark.read.parquet(path)
