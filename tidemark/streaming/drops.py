"""A feed of drops: files that belong to months, taken in as they come, with a ledger that decides what is loaded.

The stream is one of files: path, length and md5 of the bytes. For each micro-batch the ledger is asked which files are new or
changed; an unchanged re-delivery is skipped. Files that can't be read are set aside with their reason, and the others go on.
A month is made of all its parts that the ledger knows as loaded, whichever micro-batches they came in, so a later part adds
to the month. Months are published together. The ledger is a table with a folder for each batch: a batch that is repeated
after a failure decides as before and replaces its own entries. The list of a batch's files is collected; ``per_trigger``
bounds it.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.published import publish

_BINARY = "path string, modificationTime timestamp, length long, content binary"
LEDGER = "path string, name string, month string, md5 string, status string, reason string"


def drop_stream(spark: SparkSession, path: str, per_trigger: int | None = None, pattern: str = "*.parquet") -> DataFrame:
    """path, length, md5 of every file below a folder."""
    reader = spark.readStream.schema(_BINARY).format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    files = (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(path)
    return files.select("path", "length", F.md5("content").alias("md5"))


def ledger_rows(spark: SparkSession, path: str) -> DataFrame:
    """All entries, with the batch that made them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(conf).exists(at):
        return spark.createDataFrame([], LEDGER + ", batch long")
    return spark.read.schema(LEDGER + ", batch long").parquet(path)


class DropLoader:
    """Batch function of a feed of drops. ``name`` and ``month`` are SQL over ``path``: what a re-delivery has in common with the
    first delivery, and the month that a file is part of. Of rows with the same ``keys`` the last by ``order`` stays.

    ``counters`` has what each batch observed: total, success, skipped, failed.
    """

    def __init__(self, target: str, ledger: str, schema: str, name: str, month: str, keys: Sequence[str], order: Sequence[str], fmt: str = "parquet"):
        self.target, self.ledger, self.schema, self.fmt = target, ledger, schema, fmt
        self.name, self.month, self.keys, self.order = name, month, list(keys), list(order)
        self.counters: list[dict] = []

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return spark.read.schema(self.schema).format(self.fmt).option("ignoreCorruptFiles", False).load(paths)

    def _failures(self, spark: SparkSession, paths: list[str]) -> dict[str, str]:
        """Paths that can't be read, with the reason: all in one job, and halves of them only where it fails."""
        if not paths:
            return {}
        try:
            self._read(spark, paths).write.format("noop").mode("overwrite").save()
            return {}
        except (Py4JJavaError, PySparkException) as e:
            if len(paths) == 1:
                text = e.java_exception.getMessage() if isinstance(e, Py4JJavaError) else str(e)
                return {paths[0]: (text or type(e).__name__).strip().split("\n")[0][:300]}
        half = len(paths) // 2
        return self._failures(spark, paths[:half]) | self._failures(spark, paths[half:])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = Window.partitionBy("name").orderBy(F.col("batch").desc(), F.col("path").desc())
        known = ledger_rows(spark, self.ledger).where((F.col("batch") < batch_id) & (F.col("status") == "success"))
        known = known.withColumn("__r", F.row_number().over(newest)).where("__r = 1")
        own = batch.select("path", "md5", F.expr(self.name).alias("name"), F.expr(self.month).alias("month"))
        joined = own.join(known.select("name", F.col("md5").alias("old")), "name", "left")
        files = [r.asDict() for r in joined.withColumn("seen", F.col("md5").eqNullSafe(F.col("old"))).orderBy("path").collect()]
        last_in_batch = {f["name"]: f["path"] for f in files}
        for f in files:
            again = any(g["name"] == f["name"] and g["md5"] == f["md5"] and g["path"] < f["path"] for g in files)
            f["status"], f["reason"] = ("skipped", "unchanged") if f["seen"] or again else ("success", "new" if f["old"] is None else "changed")
        bad = self._failures(spark, [f["path"] for f in files if f["status"] == "success"])
        for f in files:
            if f["path"] in bad:
                f["status"], f["reason"] = "failed", bad[f["path"]]
        loaded = [f for f in files if f["status"] == "success"]
        months = sorted({f["month"] for f in loaded})
        if months:
            parts = {r["name"]: (r["path"], r["month"]) for r in known.where(F.col("month").isin(months)).select("name", "path", "month").collect()}
            parts |= {f["name"]: (f["path"], f["month"]) for f in loaded if last_in_batch[f["name"]] == f["path"] or f["name"] not in parts}
            rows = self._read(spark, [p for p, _ in parts.values()])
            last = Window.partitionBy(*self.keys).orderBy(*[F.col(c).desc() for c in self.order])
            of = F.expr(self.month.replace("path", "__path"))
            rows = rows.withColumn("__path", F.input_file_name()).withColumn("drop_month", of)
            rows = rows.withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r", "__path")
            publish(rows, self.target, ["drop_month"])
        entries = spark.createDataFrame([tuple(f[c] for c in ("path", "name", "month", "md5", "status", "reason")) for f in files], LEDGER)
        seen = Observation(f"drops-{batch_id}")
        counted = entries.observe(seen, F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("success", "skipped", "failed")])
        counted.write.mode("overwrite").parquet(f"{self.ledger}/batch={batch_id}")
        self.counters.append(seen.get)


def counters(ledger: DataFrame) -> DataFrame:
    """month, total, success, skipped, failed over all batches."""
    return ledger.groupBy("month").agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("success", "skipped", "failed")])
