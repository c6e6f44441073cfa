"""Do rows physically lie in the order 0, 1, ..., n-1?

Rows of a DataFrame have no order, but rows of Parquet files do: the position of a
row is the number of rows in the files before its own (files in the order of their
paths) plus its row number in its file, both from the file source's metadata.

One pass over the ordinal alone sums up every file: its rows, and the least and the
greatest difference between ordinal and row number. A file whose differences are all
equal is in order, and wrong as a whole or not at all, by where the files before it
end. Only files with differences of several kinds are read again, row by row. Nothing
is sorted, and what is shuffled or written is one row a file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir

CHECK = "index_is_monotonically_increasing"


def file_summary(spark: SparkSession, ordinal: str, *paths: str) -> DataFrame:
    """One row a file: ``file, start`` (its first row's position), ``n_rows``, ``shift`` (null if of several kinds)."""
    ahead = F.col(f"`{ordinal}`").cast("decimal(20,0)") - F.col("_metadata.row_index")
    files = spark.read.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.when((F.min(ahead) == F.max(ahead)) & (F.count(ahead) == F.count(F.lit(1))), F.min(ahead)).alias("shift"),
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("start"), "n_rows", "shift")


def order_report(spark: SparkSession, ordinal: str, *paths: str) -> DataFrame:
    """One report row: how many rows of the files do not hold their own position in ``ordinal``."""
    place = shared_dir(spark, "work", uuid.uuid4().hex)
    file_summary(spark, ordinal, *paths).write.parquet(place)
    files = spark.read.parquet(place)
    misplaced = F.when(F.col("shift") != F.col("start"), F.col("n_rows")).otherwise(0)  # null shifts are counted below
    wrong = files.agg(F.coalesce(F.sum(misplaced), F.lit(0)).alias("wrong"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total"))
    mixed = files.where("shift IS NULL").select("file", "start")
    if not mixed.isEmpty():
        rows = spark.read.parquet(*paths).select(
            F.col(f"`{ordinal}`").alias("ordinal"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row_index"),
        )
        odd = rows.join(mixed, "file").where(~F.col("ordinal").eqNullSafe(F.col("start") + F.col("row_index")))
        wrong = wrong.unionByName(odd.agg(F.count(F.lit(1)).alias("wrong"), F.lit(0).cast("long").alias("total")))
    failed = F.sum("wrong")
    return wrong.agg(
        F.lit(CHECK).alias("check"), F.lit(ordinal).alias("column"), failed.alias("failed_rows"),
        F.sum("total").alias("total_rows"), (failed == 0).alias("passed"),
    )
