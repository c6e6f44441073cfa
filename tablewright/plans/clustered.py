"""Q9 as a sink: rows in the global order of their keys, in files that know what they hold.

``write_clustered`` deals the rows into ranges of the keys by sampled quantiles, sorts
each and writes a file a range, so reading the files in the order of their names gives
the table in order. The least and greatest first key of every file are kept beside
them; ``read_range`` opens only the files that can hold a key of the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATS = "_file_stats"


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int) -> str:
    """Write ``df`` sorted by ``keys`` in about ``files`` files (nulls first)."""
    order = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(path)
    spark, first = df.sparkSession, F.col(f"`{keys[0]}`")
    stats = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(first).alias("least"), F.max(first).alias("greatest"), F.count(F.lit(1)).alias("n_rows"),
        F.count_if(first.isNull()).alias("n_null"),
    )
    stats.withColumn("key", F.lit(keys[0])).coalesce(1).write.parquet(f"{path}/{STATS}")
    return path


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """``file, least, greatest, n_rows, n_null, key`` of every file of a clustered table."""
    return spark.read.parquet(f"{path}/{STATS}")


def read_range(spark: SparkSession, path: str, low, high) -> DataFrame:
    """Rows whose first key lies in ``[low, high]``, from the files that can hold one."""
    stats = file_stats(spark, path)
    found = stats.where((F.col("greatest") >= F.lit(low)) & (F.col("least") <= F.lit(high))).select("file").collect()
    schema = spark.read.parquet(path).schema
    if not found:
        return spark.createDataFrame([], schema)
    key = F.col(f"`{stats.select('key').first().key}`")
    return spark.read.schema(schema).parquet(*(f"{path}/{r.file}" for r in found)).where(
        (key >= F.lit(low)) & (key <= F.lit(high))
    )
