"""J1 over stored frames: every query's result bucketed and sorted by the identifiers.

``assemble_bucketed`` keeps the result of each query as a bucketed table in the shared
folder and joins the tables bucket by bucket: no exchange stands above the scans, and
the one-to-one check, grouped by the same identifiers, needs none either. A frame is
known by its SQL, the parameters it uses, the versions of what it reads and its
layout, so a later run, in this session or another, computes only the frames that
changed; all others, and the shuffles they took, are reused.

Frames are written to a folder of their own and published with a marker only after
their keys proved unique, so a failed or concurrent writer is never read. Identifiers
are compared with ``=``: a null identifier of the index keeps its row and finds no
features (``assemble(null_safe=True)`` matches nulls).
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assemble import Assembly, NotUniqueError, assemble_frames, run_queries
from ..session import file_versions, list_names, shared_dir
from ..sources.params import SqlParams, markers

FORMAT = 1


def frame_key(spark: SparkSession, query: str, params: SqlParams | None, df: DataFrame, ids: list[str], buckets: int) -> str:
    """Hash of all that a stored frame depends on."""
    files = df.inputFiles()
    sources = file_versions(spark, files) if files else [spark.sparkContext.applicationId, str(df.semanticHash())]
    used = set(markers(query))
    payload = [FORMAT, query, sorted((k, repr(v)) for k, v in dict(params or {}).items() if k in used), sources, ids, buckets]
    return hashlib.sha256(json.dumps(payload).encode()).hexdigest()


class FrameStore:
    """Bucketed frames under ``root/<key>/<run>``, published by ``root/<key>/published/<time>_<run>``."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or shared_dir(spark, "frames")

    def find(self, key: str) -> str | None:
        """Folder of the newest published run of a frame."""
        runs = list_names(self.spark, f"{self.root}/{key}/published")
        return f"{self.root}/{key}/{max(runs).split('_', 1)[1]}" if runs else None

    def _table(self, path: str, schema, ids: list[str], buckets: int) -> DataFrame:
        """The bucketed table at ``path``, made known to this session's catalog."""
        name = "frame_" + hashlib.sha256(path.encode()).hexdigest()[:32]
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(f"`{c}`" for c in ids)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {buckets} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(name)

    def load_or_write(self, name: str, key: str, df: DataFrame, ids: list[str], buckets: int) -> DataFrame:
        found = self.find(key)
        if found:
            return self._table(found, df.schema, ids, buckets)
        run = uuid.uuid4().hex
        path, table = f"{self.root}/{key}/{run}", f"frame_write_{run}"
        columns = [F.col(f"`{c}`") for c in ids]
        # one sorted file a bucket: the rows are dealt as the buckets are
        (
            df.repartition(buckets, *columns).sortWithinPartitions(*columns)
            .write.format("parquet").option("compression", "zstd").option("path", path)
            .bucketBy(buckets, *ids).sortBy(*ids).saveAsTable(table)
        )
        self.spark.sql(f"DROP TABLE {table}")  # an external table: the files stay
        stored = self._table(path, df.schema, ids, buckets)
        twice = stored.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").limit(20).collect()
        if twice:
            keys = [tuple(r[c] for c in ids) for r in twice]
            raise NotUniqueError(f"Merge keys are not unique in {name}: {keys}")
        now = f"{time.time_ns():020d}"
        self.spark.createDataFrame([(name, path)], "name string, path string").coalesce(1).write.parquet(
            f"{self.root}/{key}/published/{now}_{run}"
        )
        return stored


def assemble_bucketed(
    spark: SparkSession,
    queries: Mapping[str, str],
    params: SqlParams | None = None,
    *,
    buckets: int | None = None,
    store: FrameStore | None = None,
) -> Assembly:
    """Left-join every query onto the ``index`` query, from stored buckets.

    ``buckets`` fixes the layout (all frames of one assembly share it); state it for
    frames that several runs should share. It defaults to the session's number of
    shuffle partitions.
    """
    queries = dict(queries)
    if "index" not in queries:
        raise KeyError("index")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = store or FrameStore(spark)
    ordered = {"index": queries.pop("index"), **queries}
    frames = run_queries(spark, ordered, params)
    ids = list(frames["index"].columns)
    assemble_frames(frames)  # J3 and J4 raise before anything is written
    stored = {
        name: store.load_or_write(name, frame_key(spark, ordered[name], params, df, ids, buckets), df, ids, buckets)
        for name, df in frames.items()
    }
    # merge joins: the files are far smaller than the rows, so by its size a frame of any length may be sent to every task
    return assemble_frames({name: df.hint("merge") for name, df in stored.items()})
