"""Ingest operators: typed projections, guards, dedup, idempotency and the choice of drops. All inputs are DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S

#: Complaint codes that have a column of their own.
COMPLAINT_CODES = ("114", "115", "116", "134", "194", "554", "595", "314", "594", "274", "614", "654", "234", "174")

_KINDS = {"s": S.clean_string, "i": S.to_int, "d": S.to_decimal, "t": S.to_timestamp_any, "m": S.to_report_month}


def _codes(kind: str = "i") -> str:
    return " ".join(f"complaint{c}:{kind}" for c in COMPLAINT_CODES)


#: Raw contracts as ``column:kind`` (s text, i whole number, d decimal of 3 places, t time, m date).
CONTRACTS: dict[str, str] = {
    "orderitem": (
        "crm_code_enc:s cms_code_enc:s item_code:s service_code:s weight_kg:d length_size:i width_size:i height_size:i total_fee:i is_domestic:i country_code:s "
        "send_province_code:i send_district_code:i send_commune_code:i rec_province_code:i rec_district_code:i rec_commune_code:i region:s sending_time:t ending_time:t "
        f"rec_success:i refunded:i no_accepted:i lost_order:i delay_day:i done:i total_complaint:i {_codes()} order_score:d bccp_update_date:t"
    ),
    "customer_month": (
        "cms_code_enc:s report_month:m item_count:i weight_kg:d total_fee:i intra_province:i international:i ser_c:i ser_e:i ser_m:i ser_p:i ser_r:i ser_u:i ser_l:i ser_q:i "
        "delay_day:i delay_count:i nodone:i refunded:i noaccepted:i lost_order:i lastday:i noservice:i dev_item:d order_score:d satisfaction_score:d total_complaint:i "
        f"{_codes()} updated_at:t"
    ),
    "complaint": (
        "cms_code_enc:s item_code:s create_complaint_date:t exp_complaint_date:t close_complaint_date:t delay_complaint:i complaint_code:i complaint_content:s "
        "complaint_content_bit:i complaint_update_date:t etl_date:t"
    ),
    "customer_info": (
        "cms_code_enc:s crm_code_enc:s cus_province:i contract_service:i contract_sig_first:t tenure:i custype:i contract_classify:i contract_mgr_org:i cus_poscode:i customer_update_date:t"
    ),
}

#: Natural keys.
KEYS = {"complaint": ("cms_code_enc", "item_code", "complaint_code", "create_complaint_date"), "customer_month": ("cms_code_enc", "report_month"), "customer_info": ("cms_code_enc",)}


def contract(name: str) -> list[tuple[str, str]]:
    return [tuple(x.split(":")) for x in CONTRACTS[name].split()]


def typed(raw: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Typed projection of a table of text by its contract; an absent column is null. One select, no Python.

    Columns in ``keep`` go through unchanged. ``orderitem`` takes ``item_code_enc`` for ``item_code`` where that is present and not blank.
    """
    have = set(raw.columns)
    out = []
    for column, kind in contract(name):
        source = F.col(column) if column in have else F.lit(None).cast("string")
        if name == "orderitem" and column == "item_code" and "item_code_enc" in have:
            source = F.coalesce(S.clean_string(F.col("item_code_enc")), source)
        out.append(_KINDS[kind](source).alias(column))
    return raw.select(*keep, *out)


def guard_cells(df: DataFrame, text_cols: Sequence[str], mode: str = "sanitize") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected). A text cell that starts with ``=`` or ``@`` (``strict``: also ``+`` or ``-``) could run as a formula.

    ``off`` keeps all, ``sanitize`` prefixes such cells with a quote, ``text_only`` and ``strict`` reject their rows.
    """
    if mode == "off":
        return df, df.limit(0)
    marks = ("=", "@", "+", "-") if mode == "strict" else ("=", "@")
    risky = lambda c: F.coalesce(F.substring(c, 1, 1).isin(*marks), F.lit(False))
    if mode == "sanitize":
        return df.withColumns({c: F.when(risky(c), F.concat(F.lit("'"), F.col(c))).otherwise(F.col(c)) for c in text_cols}), df.limit(0)
    if mode not in ("text_only", "strict"):
        raise ValueError(f"unknown mode {mode}")
    any_risky = F.lit(False)
    for c in text_cols:
        any_risky = any_risky | risky(c)
    return df.where(~any_risky), df.where(any_risky)


def dedup_natural_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (for drops: last file, then last row)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def dedup_all_columns(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def delete_using(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key isn't in staging."""
    return target.join(staging.select(*keys).distinct(), list(keys), "left_anti")


def reconcile(read: DataFrame, staged: DataFrame, inserted: DataFrame, by: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Per file: rows read, staged, inserted, dropped as duplicates; passed if read and staged differ by at most ``tolerance``."""
    n = lambda df, name: df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    out = n(read, "rows_in_csv").join(n(staged, "rows_staged"), list(by), "left").join(n(inserted, "rows_inserted"), list(by), "left").na.fill(0)
    diff = F.abs(F.col("rows_in_csv") - F.col("rows_staged")) / F.greatest(F.col("rows_in_csv"), F.lit(1))
    return out.select("*", (F.col("rows_staged") - F.col("rows_inserted")).alias("rows_deduplicated"), diff.alias("diff_pct"), (diff <= tolerance).alias("passed"))


def latest_status(log: DataFrame) -> DataFrame:
    """Newest log row per file, unfinished ones last."""
    return dedup_natural_key(log, ["zip_name"], [F.col("finished_at").desc_nulls_last(), F.col("md5_hash")])


def plan_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """zip_name, md5_hash, action, reason by comparing each file's content hash with its newest log row."""
    last = latest_status(log).select("zip_name", F.col("status").alias("__s"), F.col("md5_hash").alias("__h"))
    same = F.col("md5_hash").eqNullSafe(F.col("__h"))
    done = F.col("__s") == "success"
    reason = F.when(F.col("__s").isNull(), "new").when(done & same, "unchanged").when(~same, "changed").otherwise("retry")
    out = files.join(last, "zip_name", "left").withColumn("reason", reason)
    return out.select("zip_name", "md5_hash", F.when(F.col("reason") == "unchanged", "skip").otherwise("process").alias("action"), "reason")


def select_drops(files: DataFrame, done: DataFrame, top_n: int = 2, batch: int | None = None) -> DataFrame:
    """Files to process. Snapshots: the newest period per base. Monthly: the newest ``top_n`` periods per base, and older
    ones without a successful run, oldest first and at most ``batch`` of them per base if that is given (a feature of the feed)."""
    newest = Window.partitionBy("base", "mode").orderBy(F.col("period").desc(), F.col("zip_name"))
    ranked = files.withColumn("__r", F.row_number().over(newest))
    snapshot = ranked.where("mode = 'snapshot' AND __r = 1")
    recent = ranked.where((F.col("mode") == "monthly") & (F.col("__r") <= top_n))
    gaps = ranked.where((F.col("mode") == "monthly") & (F.col("__r") > top_n)).join(done.select("zip_name").distinct(), "zip_name", "left_anti")
    if batch is not None:
        oldest = Window.partitionBy("base").orderBy("period", "zip_name")
        gaps = gaps.withColumn("__g", F.row_number().over(oldest)).where(F.col("__g") <= batch).drop("__g")
    return snapshot.unionByName(recent).unionByName(gaps).drop("__r")


def parse_drop_name(name: Column) -> list[Column]:
    """base, mode, period of ``<base>_YYMM`` (monthly) and ``<base>_update_YYMMDD`` or ``<base>_DDMMYY`` (snapshot) names."""
    stem = F.regexp_replace(name, r"\.[A-Za-z]+$", "")
    digits = F.regexp_extract(stem, r"_(\d+)$", 1)
    base = F.regexp_replace(F.regexp_replace(stem, r"_\d+$", ""), "_update$", "")
    mode = F.when(F.length(digits) == 4, "monthly").when(F.length(digits) == 6, "snapshot")
    month = F.when((F.substring(digits, 3, 2) >= "01") & (F.substring(digits, 3, 2) <= "12"), F.concat(F.lit("20"), digits))
    day = F.date_format(F.try_to_timestamp(digits, F.lit("ddMMyy")), "yyyyMMdd")
    return [base.alias("base"), mode.alias("mode"), F.when(mode == "monthly", month).when(mode == "snapshot", day).alias("period")]


def order_parts(files: DataFrame, name: str, base: str, yymm: str) -> DataFrame:
    """Adds file_seq from 1: part files of a month by their first day; others last, by name.

    The names of one month's drop are a handful of files, so one window orders them.
    """
    start = F.regexp_extract(name, rf"^{base}_(\d{{4}})_(\d{{4}})-(\d{{4}})", 2)
    mine = (F.regexp_extract(name, rf"^{base}_(\d{{4}})_", 1) == yymm) & (start != "")
    key = F.struct(F.when(mine, 0).otherwise(1), F.when(mine, start).otherwise(F.lit("")), F.col(name))
    return files.withColumn("file_seq", F.row_number().over(Window.orderBy(key)))


def dup_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in the largest key, keys, keys with several rows, rows in those."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    many = F.col("n") > 1
    return per.agg(
        F.max("n").alias("max_rows_per_key"), F.count(F.lit(1)).alias("n_keys"), F.count_if(many).alias("n_dup_keys"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("rows_in_dup_keys"),
    )


def key_fallback(df: DataFrame, cms: str = "cms_code_enc", crm: str = "crm_code_enc") -> DataFrame:
    """Adds key, key_type: the cleaned cms key, else the cleaned crm key; rows without either are left out."""
    a, b = S.clean_label_cell(F.col(cms)), S.clean_label_cell(F.col(crm))
    kind = F.when(a.isNotNull(), cms).when(b.isNotNull(), crm)
    return df.withColumns({"key": F.coalesce(a, b), "key_type": kind}).where(F.col("key").isNotNull())
