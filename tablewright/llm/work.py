"""Written work tables: cut lineage through the shared folder, so lost executors cost a reread only."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tablewright.session import shared_dir

# Arrow batches of the Python stages: rows and bytes in one batch.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


_scopes: list[list[str]] = []


def work_dir(spark: SparkSession) -> str:
    """A fresh folder for the work tables of one call."""
    folder = shared_dir(spark, "work", uuid.uuid4().hex)
    for scope in _scopes:
        scope.append(folder)
    return folder


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the work tables of the calls made inside.

    For a caller that has written what those calls returned: their results are lazy
    and read the work tables.
    """
    mine: list[str] = []
    _scopes.append(mine)
    try:
        yield
    finally:
        _scopes.remove(mine)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in mine:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``folder`` and read it back."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and bytes: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
