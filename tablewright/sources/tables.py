"""Make source tables visible to the SQL queries.

The reference runs its queries inside an external database. Here every source
is a temporary view in the session, so the queries run in Spark SQL and
Catalyst pushes their filters and column lists into the scans.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def register_parquet_views(
    spark: SparkSession, root: str, names: Iterable[str] = TEST_TABLES
) -> dict[str, DataFrame]:
    """Register ``<root>/<name>.parquet`` (file or folder) as view ``name``."""
    frames = {}
    for name in names:
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
        df.createOrReplaceTempView(name)
        frames[name] = df
    return frames


def register_tables(spark: SparkSession, tables: Mapping[str, str]) -> None:
    """Expose catalog tables under the names the queries use."""
    for view, table in tables.items():
        spark.read.table(table).createOrReplaceTempView(view)


def register_jdbc_view(
    spark: SparkSession,
    view: str,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    user_env: str = "DB_USER",
    password_env: str = "DB_PASSWORD",
    fetch_size: int = 10_000,
) -> DataFrame:
    """Register a database table as a view, read in parallel by key ranges.

    Credentials come from the environment, never from code. Filters of the
    queries that run on the view are pushed into the database by Spark.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
    )
    if os.environ.get(user_env):
        reader = reader.option("user", os.environ[user_env])
    if os.environ.get(password_env):
        reader = reader.option("password", os.environ[password_env])
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    df = reader.load()
    df.createOrReplaceTempView(view)
    return df
