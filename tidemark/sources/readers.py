"""Readers of delimited files, labels, monthly tables and feature windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Delimiters in the order that breaks ties.
DELIMITERS = (",", ";", "\t", "|")
HEAD_LINES = 1000


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Files with a header row as text columns; a byte-order mark before the header does no harm, as names are ours.

    Rows of another width are kept with nulls and marked in ``_ragged``.
    """
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _ragged string"
    return (
        spark.read.schema(schema)
        .options(sep=sep, header=True, encoding="UTF-8", enforceSchema=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_ragged", emptyValue="", nullValue="")
        .csv(path)
    )


def split_ragged(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines) of ``read_delimited``."""
    return df.where(F.col("_ragged").isNull()).drop("_ragged"), df.where(F.col("_ragged").isNotNull()).select("_ragged")


def read_head(spark: SparkSession, path: str, head: int = HEAD_LINES) -> DataFrame:
    """file (its path), line_no (from 0), line: the first ``head`` lines of all text files, as far as a file's first block has them.

    Later blocks aren't numbered, and of a first block no more than ``head`` lines are shuffled.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__at"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("__i")
    )
    by = Window.partitionBy("file").orderBy("__i")
    return lines.where("__at = 0").withColumn("__r", F.row_number().over(by)).where(F.col("__r") <= head).select("file", (F.col("__r") - 1).alias("line_no"), "line")


def sniff_delimiters(lines: DataFrame, head: int = HEAD_LINES) -> DataFrame:
    """file, delimiter, least: the delimiter with the largest least count per line over each file's head lines."""
    count = lambda d: F.length("line") - F.length(F.replace(F.col("line"), F.lit(d), F.lit("")))
    mins = lines.where(F.col("line_no") < head).groupBy("file").agg(*[F.min(count(d)).alias(f"__{i}") for i, d in enumerate(DELIMITERS)])
    best = F.array_max(F.array(*[F.struct(F.col(f"__{i}").alias("least"), F.lit(-i).alias("o"), F.lit(d).alias("d")) for i, d in enumerate(DELIMITERS)]))
    return mins.select("file", best["d"].alias("delimiter"), best["least"].alias("least"))


def check_headers(headers: DataFrame, expected: Sequence[str], sep: str = ";") -> DataFrame:
    """file, status, n_columns, renamed of a (file, header) table: a wrong count fails, other names are mapped by position.

    A file whose header differs from the first file's is a mismatch too.
    """
    names = F.transform(F.split("header", sep if sep != "|" else r"\|"), lambda x: F.trim(F.replace(x, F.lit("﻿"), F.lit(""))))
    want = F.array(*map(F.lit, expected))
    first = headers.agg(F.min_by("header", "file").alias("__first"))
    out = headers.join(F.broadcast(first), F.lit(True)).withColumn("n", names)  # one row
    renamed = F.size(F.filter(F.zip_with("n", want, lambda a, b: ~a.eqNullSafe(b)), lambda x: x))
    ok = F.size("n") == len(expected)
    status = F.when(~ok, "bad_count").when(F.col("header") != F.col("__first"), "differs_from_first").when(renamed > 0, "renamed").otherwise("ok")
    return out.select("file", status.alias("status"), F.size("n").alias("n_columns"), F.when(ok, renamed).alias("renamed"))


def label_file_period(name: Column) -> Column:
    """YYMM number in a label file's name: ``Roi_bo_MM_YY`` or ``label_YYMM``; null if neither."""
    a = F.regexp_extract(name, r"(?i)roi_bo_(\d{1,2})_(\d{2})", 1).try_cast("int")
    b = F.regexp_extract(name, r"(?i)roi_bo_(\d{1,2})_(\d{2})", 2).try_cast("int")
    c = F.regexp_extract(name, r"(?i)label_(\d{2})(\d{2})", 1).try_cast("int")
    d = F.regexp_extract(name, r"(?i)label_(\d{2})(\d{2})", 2).try_cast("int")
    return F.when(a.between(1, 12), b * 100 + a).when(d.between(1, 12), c * 100 + d)


def read_labels(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All label drops of a folder (files, or folders of part files) as text columns, with source_file and yymm from the name. Drops share one header."""
    df = spark.read.options(header=True, sep=sep, recursiveFileLookup=True).csv(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"(?i)([^/]*(?:roi_bo_|label_)\d[^/]*)", 1)
    return df.select("*", name.alias("source_file")).withColumn("yymm", label_file_period(F.col("source_file")))


def scan_months(df: DataFrame, month: str, start: str, end: str) -> DataFrame:
    """Rows of the months in [start, end]; on a table partitioned by month only those partitions are read."""
    return df.where(F.col(month).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def scan_months_or_base(parts: DataFrame, base: DataFrame, month: str, start: str, end: str) -> DataFrame:
    """The months in [start, end] from the partitioned table; months that it doesn't have come from the base table."""
    own, rest = scan_months(parts, month, start, end), scan_months(base, month, start, end)
    have = own.select(month).distinct()  # a row per month
    return own.unionByName(rest.join(F.broadcast(have), month, "left_anti").select(*own.columns))


def load_working_set(lifetime: DataFrame, min_orders: int = 3) -> DataFrame:
    """Customers with at least ``min_orders`` items in their life."""
    return lifetime.where(F.col("lifetime_total_items") >= min_orders)


def load_window(features: DataFrame, size: int, end: str) -> DataFrame:
    """Rows of one window; none if it isn't there."""
    return features.where((F.col("window_size") == size) & (F.col("window_end") == F.lit(end).cast("date")))


def load_snapshots(features: DataFrame, size: int, n: int) -> DataFrame:
    """Rows of the latest ``n`` windows of one size. The window ends are found first: one row per end is ranked, not one per customer."""
    own = features.where(F.col("window_size") == size)
    ends = own.select("window_end").distinct().orderBy(F.col("window_end").desc()).limit(n)
    return own.join(F.broadcast(ends), "window_end", "left_semi")  # n rows


def detect_t_obs(df: DataFrame, month: str, override: str | None = None, today: str | None = None) -> DataFrame:
    """One row: t_obs, the override or else the latest month or else today."""
    return df.agg(F.coalesce(F.lit(override).cast("date"), F.trunc(F.max(month), "month"), F.trunc(F.lit(today).cast("date"), "month")).alias("t_obs"))


def file_hashes(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """path, length, md5 (of the bytes) of every file below a folder; the bytes stay in the tasks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.md5("content").alias("md5"))


def write_drops(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """A file for each value of ``by``, in folders named after it: what a delivery of drops looks like."""
    df.repartition(*by).sortWithinPartitions(*df.columns).write.partitionBy(*by).parquet(path)


def copy_drops(spark: SparkSession, source: str, target: str, folders: str) -> None:
    """Copy the folders of a delivery that match a pattern, byte for byte."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(source).getFileSystem(conf)
    for f in fs.globStatus(at(f"{source}/{folders}")) or []:
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, f.getPath(), fs, at(f"{target}/{f.getPath().getName()}"), False, conf)
