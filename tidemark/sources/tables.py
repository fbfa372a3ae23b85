"""Intermediate tables in the folder that the whole cluster shares: written once, read again, dropped when done with.

A table ends by ``discard``, at the end of a ``tables_end`` block, or with the application, whose own folder goes when the
driver's Python ends.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_own: list[str] = []
_live: list[DataFrame] = []
_folders: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``. Only a local session may leave it unset; it gets a temporary one then."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError(f"{_SETTING} must name a folder that driver and executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        named = _own[0]
    return named.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the application's part of the shared folder."""
    context = spark.sparkContext
    folder = f"{shared_dir(spark)}/tidemark/{context.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_delete, context._jvm, context._jsc.hadoopConfiguration(), folder, True)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def _delete(jvm, conf, path: str, at_exit: bool = False) -> None:
    try:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    except Exception:
        if not at_exit:  # the JVM may have gone before
            raise


@contextlib.contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _shuffles_end_with_the_write(spark: SparkSession) -> contextlib.AbstractContextManager:
    """What a written table was made of isn't read again, so its shuffle files go at once."""
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_splits(spark: SparkSession, size: str = "8m") -> contextlib.AbstractContextManager:
    """Files are read in small splits, so that tasks that keep their rows in memory needn't have them dealt out again. Spark splits
    files between row groups."""
    return _set(spark, "spark.sql.files.maxPartitionBytes", size)


def methods_that_compile(spark: SparkSession) -> contextlib.AbstractContextManager:
    """For jobs on rows of many columns: where Spark would make one method of a whole stage that is too long for the JVM to compile,
    it makes small ones of the single steps."""
    return _set(spark, "spark.sql.codegen.hugeMethodLimit", "8000")


def small_batches(spark: SparkSession) -> contextlib.AbstractContextManager:
    """Python gets some 8 MB of rows at once, not 64, which executors hold outside their heap several times."""
    return _set(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def staged(df: DataFrame, label: str, by: str | None = None, parts: int = 0, group_rows: int = 0) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends here and a lost executor costs no recomputation before it.

    With ``by`` the table is bucketed by that column in ``parts`` buckets, and joins on it with another table that is
    dealt out by the same column and number (``repartition(parts, by)`` or bucketed) move no row of this one.

    ``group_rows`` is the most rows of a row group. A file is split between groups; and of rows of megabytes no more are held
    together when they are written and read, while Parquet looks at a group's size after 100 rows and Spark reads 4096 at once.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, label)
    with _shuffles_end_with_the_write(spark):
        if by is None:
            limits = {"parquet.block.row.count.limit": group_rows, "parquet.page.row.count.limit": min(group_rows, 20_000)} if group_rows else {}
            df.write.options(compression="zstd", **limits).parquet(path)
            out = spark.read.schema(df.schema).parquet(path)
        else:
            name = f"tidemark_{uuid.uuid4().hex}"
            try:
                df.write.bucketBy(parts, by).format("parquet").option("compression", "zstd").option("path", path).saveAsTable(name)
            except Exception:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
                raise
            out = spark.table(name)
            out.staged_name = name
    out.staged_at = path
    _live.append(out)
    return out


@contextlib.contextmanager
def tables_end(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables that are staged inside end with the block, but for those put into the list that it gives. What was made of them
    must have been written by then: run an operator and write its result inside."""
    before, keep = len(_live), []
    try:
        yield keep
    finally:
        kept = {df.staged_at for df in keep}
        discard(*[df for df in _live[before:] if df.staged_at not in kept])


def discard(*frames: DataFrame) -> None:
    """Delete staged tables; whatever was made of them must have been written."""
    for df in frames:
        spark = df.sparkSession
        if hasattr(df, "staged_name"):
            spark.sql(f"DROP TABLE IF EXISTS {df.staged_name}")
        _delete(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), df.staged_at)
        _live[:] = [x for x in _live if x.staged_at != df.staged_at]
