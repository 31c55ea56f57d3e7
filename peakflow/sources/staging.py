"""Written hand-over tables between stages."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_DIR_KEY = "spark.checkpoint.dir"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
_READ_KEY = "spark.sql.parquet.columnarReaderBatchSize"
#: Folders of local sessions that name none. The session's own setting is never touched.
_local_folders: dict[str, str] = {}


def staging_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only for a local session without it."""
    configured = spark.conf.get(_DIR_KEY, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_DIR_KEY} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="peakflow-")
    return _local_folders[application]


@contextlib.contextmanager
def _held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The settings hold inside only; the session gets its own ones back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stage(df: DataFrame, name: str, batch_bytes: int | None = None, read_rows: int | None = None) -> DataFrame:
    """Write a table once and read it back.

    Later steps scan only the columns they need, lineage is cut, and the loss of an executor never
    causes the earlier stages to run again. The shuffle files behind the table go when it is written, not when the
    driver happens to collect its garbage. `batch_bytes` bounds the Arrow batches that its tasks hand to Python; without it
    only their rows are bounded, and long values make large buffers in the executor. `read_rows` bounds the rows that a task
    reads from Parquet at a time."""
    spark = df.sparkSession
    path = f"{staging_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    bounds = {_BATCH_KEY: batch_bytes, _READ_KEY: read_rows}
    with _held(spark, {_CLEANUP_KEY: "true"} | {k: str(v) for k, v in bounds.items() if v}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def observed_stage(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """`stage`, and aggregates of the same rows, taken in the pass that writes them: no job of their own.

    The metrics should not change when a lost task runs again (any-of, minimum, maximum)."""
    seen = Observation(name)
    staged = stage(df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), name)
    return staged, seen.get
