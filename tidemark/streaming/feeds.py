"""Structured Streaming: file feeds, windowed sums of events, and windows built as months come."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.features import agg_window_base
from tidemark.sources.published import is_published, publish, published


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", per_trigger: int | None = None, **options: str) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(path)


def daily_rollup(events: DataFrame, key: str = "user_id", value: str = "value", delay: str = "2 days") -> DataFrame:
    """key, day, n, total of events; the same expression for a batch and for a stream with its watermark.

    Sums are over thousandths as whole numbers, so they don't depend on the order of rows.
    """
    own = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    out = own.groupBy(key, F.window("ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col(value) * 1000).cast("long")).alias("total_milli"))
    return out.select(key, F.to_date("w.start").alias("day"), "n", "total_milli")


def run_once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, path: str | None = None, mode: str = "append") -> StreamingQuery:
    """Process everything that is there, in order, and stop."""
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").start(path)
    query.awaitTermination()
    return query


def missing_windows(specs: DataFrame, existing: DataFrame) -> DataFrame:
    """Windows of the grid that have no partition yet."""
    return specs.join(existing.select("window_size", "window_end").distinct(), ["window_size", "window_end"], "left_anti")


def empty_windows(specs: DataFrame, existing: DataFrame, last: int = 0) -> DataFrame:
    """Windows without rows, and the newest ``last`` ends of every size: those to build again."""
    newest = Window.partitionBy("window_size").orderBy(F.col("window_end").desc())
    recent = specs.withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= last).drop("__r")
    return missing_windows(specs, existing).unionByName(recent).distinct()


def build_windows(monthly: DataFrame, specs: DataFrame, path: str, again: int = 0, measures: Sequence[str] | None = None) -> DataFrame:
    """Bring a published table of window rows, partitioned by size and end, up to ``specs`` (window_size, window_end), and return
    the windows that were built. ``measures`` are those of the table (None: all of level 2); a table has the same in every build.

    Only windows without a partition, and the newest ``again`` ends of every size, are made, from the months that they need; the
    other partitions are neither read nor written. Running sums begin with those months, so doubles may differ in their last bits
    from those of another build. The windows of a grid are some hundreds, so their list is collected.
    """
    spark = monthly.sparkSession
    done = published(spark, path).select("window_size", "window_end") if is_published(spark, path) else specs.where(F.lit(False))
    todo = [(r["window_size"], r["window_end"]) for r in empty_windows(specs, done, again).orderBy("window_size", "window_end").collect()]
    wanted = spark.createDataFrame(todo, specs.select("window_size", "window_end").schema)
    if todo:
        bounds = wanted.agg(F.min(F.add_months("window_end", 1 - F.col("window_size"))).cast("string"), F.max("window_end").cast("string")).first()
        rows = agg_window_base(monthly, bounds[0], bounds[1], sorted({w for w, _ in todo}), todo, measures)
        publish(rows, path, ["window_size", "window_end"])
    return wanted
