"""A folder of SQL files becomes an ordered ``{name: text}`` mapping."""

from __future__ import annotations

import glob
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

PACKAGE_SQL = str(Path(__file__).parent / "sql" / "*.sql")


def load_sql_files(pattern: str = PACKAGE_SQL) -> dict[str, str]:
    """Read every file matching ``pattern`` (``**`` recurses) into ``{stem: text}``.

    Files are taken in path order, which is also the join order and the column
    order of the assembled table. Two files with the same stem are an error
    rather than a silent overwrite.
    """
    paths = [Path(p) for p in sorted(glob.glob(pattern, recursive=True))]
    queries: dict[str, str] = {}
    for path in paths:
        if not path.is_file():
            continue
        if path.stem in queries:
            raise ValueError(f"two SQL files share the name {path.stem!r}: {path}")
        queries[path.stem] = path.read_text(encoding="utf-8")
    return queries


def load_sql_texts(spark: SparkSession, path: str) -> dict[str, str]:
    """Same as :func:`load_sql_files` for folders on object storage.

    The files are read by Spark (one row per file) and only the query texts,
    which are small by nature, come back to the driver.
    """
    rows = (
        spark.read.text(path, wholetext=True)
        .select(F.input_file_name().alias("path"), F.col("value").alias("text"))
        .orderBy("path")
        .collect()
    )
    queries: dict[str, str] = {}
    for row in rows:
        name = row.path.rsplit("/", 1)[-1]
        if not name.endswith(".sql"):
            continue
        stem = name[: -len(".sql")]
        if stem in queries:
            raise ValueError(f"two SQL files share the name {stem!r}: {row.path}")
        queries[stem] = row.text
    return queries
