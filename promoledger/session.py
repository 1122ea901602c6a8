"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}

_SHORT = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 22)}
# For rows of about a megabyte each.
_LONG_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "4", "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 22)}
# Parquet looks at a page after 100 rows at first, whatever the limit.
LONG_ROW_PAGES = {"parquet.page.row.count.limit": "4", "parquet.page.size.row.check.min": "4", "parquet.page.size.row.check.max": "4"}

# Scratch paths handed out, by application; inside a ``scratch_scope`` by thread.
_written: dict[str, list[str]] = {}
_scope = threading.local()


def build_session(app_name: str = "promoledger", master: str | None = None, **conf: str) -> SparkSession:
    """Session for tests, the bench and small jobs; a cluster brings its own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates and stream checkpoints.

    It is the folder the cluster names in ``spark.checkpoint.dir``. A ``local`` session without that
    setting uses a folder in its warehouse.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch")
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    path = f"{scratch_root(spark)}/promoledger/{label}-{uuid.uuid4().hex}"
    scoped = getattr(_scope, "paths", None)
    (_written.setdefault(spark.sparkContext.applicationId, []) if scoped is None else scoped).append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete the written intermediates of this application, once its results are stored."""
    _delete(spark, _written.pop(spark.sparkContext.applicationId, []))


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the intermediates written inside the block at its end; store results before that."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        _delete(spark, paths)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    It does so when the driver's JVM collects garbage, which in a job of many rounds may come late.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def short_batches(spark: SparkSession):
    """Fewer rows and bytes per Arrow batch inside the block, for rows that hold whole texts or sets.

    A batch lies in the executor's memory outside the heap and again in the Python worker. Plans
    made inside the block must run inside it.
    """
    return _set(spark, _SHORT)


def long_rows(spark: SparkSession):
    """Few rows at once inside the block, from Parquet files and to Python, for rows of about a megabyte.

    Spark's reader otherwise holds 4,096 rows, and a page of a file as many as 100: write such tables with
    ``LONG_ROW_PAGES``. Plans made inside the block must run inside it.
    """
    return _set(spark, _LONG_ROWS)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate that no later step reads."""
    _delete(spark, [path])


def retire(spark: SparkSession, path: str) -> None:
    """Delete a written table after its last reader, and the shuffle files of plans that are done."""
    _delete(spark, [path])
    release_shuffles(spark)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder, in folders by a column if given, and read it back.

    Used where a plan must not be evaluated twice with different outcomes (sampled range bounds,
    partition numbers) or where a small result feeds several branches. The written table survives
    the loss of any executor; ``release_scratch`` deletes it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
