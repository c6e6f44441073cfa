"""Parquet sinks and the snapshot cache of assembled tables.

``fetch_data`` is the table builder of the reference re-expressed for Spark:
assemble (one lazy plan), check one-to-one on the keys, write the joined table
once to a new snapshot folder (the scalar checks ride along as an observation),
and only then publish the snapshot in an append-only manifest. A later call with the same parameters, SQL texts and
data model reads the snapshot while it is younger than the time-to-live.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assemble import assemble
from ..operators.conform import ml_conform
from ..operators.model import DataModel, ValidationError, _message, observe_checks, unique_rows
from ..session import file_versions, list_names, path_exists, shared_dir
from ..sources.params import SqlParams
from .records import RunStore

TTL = timedelta(hours=6)
# How long data outlives its clearing or expiry, and a fetched table its fetch.
GRACE = timedelta(days=1)
# Bumped whenever what a snapshot holds changes, so older ones are never reused.
SNAPSHOT_FORMAT = 3
MANIFEST_SCHEMA = "key string, path string, kind string, created_at timestamp"


def write_parquet(df: DataFrame, path: str, *, mode: str = "errorifexists") -> str:
    """Parquet with zstd, no index column; one folder per run."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def snapshot_key(
    params: SqlParams,
    queries: Mapping[str, str],
    model: type[DataModel],
    sources: list[str] | None = None,
    null_safe: bool = False,
) -> str:
    """Hash of everything the table depends on.

    ``sources`` are the versions of what the plan reads (no job): the same SQL
    over other or rewritten data must never hit this snapshot. The data model
    counts with its whole declaration.
    """
    payload = {
        "format": SNAPSHOT_FORMAT,
        "null_safe": bool(null_safe),
        "sources": sorted(sources or []),
        "params": {k: repr(v) for k, v in sorted(dict(params or {}).items())},
        "queries": sorted(queries.items()),
        "model": model.declaration(),
    }
    return hashlib.sha256(json.dumps(payload, sort_keys=True, default=str).encode()).hexdigest()


class SnapshotCache:
    """Snapshots under ``root/data/key=<k>/<run>``, entries under ``root/manifest``.

    A published snapshot is one folder ``manifest/key=<k>/<created_ms>_<run>``
    (holding its manifest row for auditing); ``clear`` adds
    ``manifest/clear/<created_ms>_<id>``. A lookup lists only the folder of its
    own key and the clear markers -- metadata calls, no Spark job -- so it stays
    cheap however many snapshots exist. Entries are never rewritten, so
    concurrent publishers cannot collide.

    Invalidating and deleting are two things. ``clear`` and expiry only stop lookups
    from returning a snapshot; :meth:`purge` deletes files, and never those that the
    run log names as a run's raw data, that a lease (``leases/<until_ms>_<run>``, one
    for every fetch) still covers, or that were valid less than ``grace`` ago.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, ttl: timedelta = TTL, grace: timedelta = GRACE):
        self.spark = spark
        self.root = root or shared_dir(spark, "snapshots")
        self.ttl = ttl
        self.grace = grace

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    def entries(self) -> DataFrame | None:
        """Every manifest row, for auditing (a Spark read of the manifest)."""
        if not path_exists(self.spark, self.manifest):
            return None
        return self.spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").parquet(
            self.manifest
        )

    @staticmethod
    def _stamps(names: list[str]) -> list[tuple[int, str]]:
        out = []
        for name in names:
            stamp, _, run = name.partition("_")
            if stamp.isdigit() and run:
                out.append((int(stamp), run))
        return out

    def lookup(self, key: str) -> str | None:
        now_ms = int(datetime.now(timezone.utc).timestamp() * 1000)
        cleared = max((t for t, _ in self._stamps(list_names(self.spark, f"{self.manifest}/clear"))), default=0)
        fresh = [
            (t, run)
            for t, run in self._stamps(list_names(self.spark, f"{self.manifest}/key={key}"))
            if t > cleared and now_ms - t < self.ttl.total_seconds() * 1000
        ]
        if not fresh:
            return None
        return self.data_path(key, max(fresh)[1])

    def data_path(self, key: str, run: str) -> str:
        return f"{self.root}/data/key={key}/{run}"

    def new_path(self, key: str) -> str:
        return self.data_path(key, uuid.uuid4().hex)

    def publish(self, key: str, path: str, kind: str = "snapshot") -> None:
        now = datetime.now(timezone.utc)
        stamp = int(now.timestamp() * 1000)
        run = path.rstrip("/").rsplit("/", 1)[-1] if path else uuid.uuid4().hex
        folder = f"{self.manifest}/clear" if kind == "clear" else f"{self.manifest}/key={key}"
        row = self.spark.createDataFrame([(key, path, kind, now.replace(tzinfo=None))], MANIFEST_SCHEMA)
        row.coalesce(1).write.parquet(f"{folder}/{stamp}_{run}")

    def lease(self, path: str, duration: timedelta | None = None) -> None:
        """Keep a snapshot's files until ``duration`` (the grace time) from now, whatever is cleared."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        until = datetime.now(timezone.utc) + (self.grace if duration is None else duration)
        run = path.rstrip("/").rsplit("/", 1)[-1]
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/leases/{int(until.timestamp() * 1000)}_{run}")
        folder.getFileSystem(conf).mkdirs(folder)

    def recorded(self) -> set[str]:
        """Folders that the run log names as raw data."""
        rows = RunStore(self.spark).runs().select(F.col("params")["raw_data"].alias("path")).where("path IS NOT NULL")
        return {_plain(r.path) for r in rows.distinct().collect()}

    def clear(self, recorded: Iterable[str] | None = None) -> list[str]:
        """Invalidate every snapshot published so far, then :meth:`purge`."""
        self.publish("", "", kind="clear")
        return self.purge(recorded)

    def purge(self, recorded: Iterable[str] | None = None, grace: timedelta | None = None) -> list[str]:
        """Delete the data of snapshots that no lookup can return; the folders removed.

        These are snapshots cleared or expired longer than the grace time ago, and
        writes that failed that long ago and longer than the time-to-live. What the run
        log records and what is leased stays, and so does everything outside this
        cache's root. A caller that passes ``recorded`` says what is in use: then those
        paths stay, and the rest goes without grace or leases.
        """
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        now_ms = int(datetime.now(timezone.utc).timestamp() * 1000)
        if recorded is not None:
            keep, leased, wait = {_plain(p) for p in recorded}, set(), timedelta(0)
        else:
            keep = self.recorded()
            leases = self._stamps(list_names(self.spark, f"{self.root}/leases"))
            leased, wait = {run for t, run in leases if t > now_ms}, self.grace
            for t, run in leases:
                if t <= now_ms:  # run out: the marker goes too
                    lease = jvm.org.apache.hadoop.fs.Path(f"{self.root}/leases/{t}_{run}")
                    lease.getFileSystem(conf).delete(lease, True)
        wait_ms = (wait if grace is None else grace).total_seconds() * 1000
        clears = sorted(t for t, _ in self._stamps(list_names(self.spark, f"{self.manifest}/clear")))
        ttl_ms, gone = self.ttl.total_seconds() * 1000, []
        for folder in list_names(self.spark, f"{self.root}/data"):
            stamps = {run: t for t, run in self._stamps(list_names(self.spark, f"{self.manifest}/{folder}"))}
            for run in list_names(self.spark, f"{self.root}/data/{folder}"):
                path = f"{self.root}/data/{folder}/{run}"
                if run in leased or _plain(path) in keep:
                    continue
                hpath = jvm.org.apache.hadoop.fs.Path(path)
                fs = hpath.getFileSystem(conf)
                if run in stamps:  # invalid since the next clearing or its expiry
                    since = min([stamps[run] + ttl_ms, *(t for t in clears if t >= stamps[run])])
                else:  # not published: being written, or failed
                    since = fs.getFileStatus(hpath).getModificationTime() + ttl_ms
                if since + wait_ms <= now_ms and fs.delete(hpath, True):
                    gone.append(path)
        return gone


def _plain(path: str) -> str:
    """A path without the local scheme and a closing slash, for comparison."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def fetch_data(
    spark: SparkSession,
    params: SqlParams,
    queries: Mapping[str, str],
    *,
    data_model: type[DataModel],
    cache: SnapshotCache | None = None,
    use_cache: bool = True,
    null_safe: bool | None = None,
) -> DataFrame:
    """Assemble, check and snapshot in one pass; returns the typed table.

    ``null_safe=None`` joins null-safely only if an identifier may be null
    under ``data_model``.

    Schema failures (missing columns, wrong types) raise before any job. Then one
    job counts the keys of every frame (one-to-one), and one write computes the
    joins, the coerced values and every scalar check of the model (observed; an
    empty table, whose observation the optimiser drops, is checked directly). Uniqueness of the
    identifiers follows from the one-to-one join; other uniqueness sets take
    one grouped count over the written snapshot. Raises ``NotUniqueError`` or
    ``ValidationError``; a failed snapshot is never published. The snapshot
    holds the declared types, so readers get plain columns and their filters
    reach the Parquet scan.
    """
    cache = cache or SnapshotCache(spark)
    if null_safe is None:
        null_safe = _ids_may_be_null(spark, queries, params, data_model)
    asm = assemble(spark, queries, params, null_safe=null_safe)
    key = snapshot_key(params, queries, data_model, _source_versions(spark, asm), null_safe)
    if use_cache:
        hit = cache.lookup(key)
        if hit:
            cache.lease(hit)
            return _read_snapshot(spark, hit, data_model)

    proven = [n for n, cols in data_model._unique.items() if sorted(cols) == sorted(asm.identifiers)]
    checks = observe_checks(asm.joined, _declared(data_model), skip=proven)
    if checks.static:
        raise ValidationError(_message(checks.static), checks.static)

    asm.check_one_to_one()
    path = cache.new_path(key)
    write_parquet(checks.frame, path)
    rows = checks.rows() + unique_rows(spark.read.parquet(path), checks.unique)
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise ValidationError(_message(failed), failed)
    cache.lease(path)
    cache.publish(key, path)
    return _read_snapshot(spark, path, data_model)


def _source_versions(spark: SparkSession, asm) -> list[str]:
    """State of every source: files with length and modification time.

    A frame without files (a view over memory or JDBC) is known by its plan
    only, and only inside this session.
    """
    out = file_versions(spark, asm.joined.inputFiles())
    for name, df in asm.frames.items():
        if not df.inputFiles():
            out.append(f"{name}:{spark.sparkContext.applicationId}:{df.semanticHash()}")
    return out


def _ids_may_be_null(spark, queries, params, model: type[DataModel]) -> bool:
    """Null-safe joins only when an identifier may be null under the model.

    When every identifier is declared non-null a null one fails the checks
    anyway, and a plain ``=`` keeps grouped feature frames partitioned.
    """
    if "index" not in queries:
        raise KeyError("index")
    from ..sources.params import run_sql

    ids = run_sql(spark, queries["index"], params).columns
    fields = model.fields()
    return any(c not in fields or fields[c].nullable for c in ids)


def _declared(model: type[DataModel]) -> type[DataModel]:
    """The model without the ML conversion: snapshots keep the declared types."""
    if not model._ml_conform:
        return model
    return type(model.__name__, (model,), {"_ml_conform": False})


def _read_snapshot(spark: SparkSession, path: str, model: type[DataModel]) -> DataFrame:
    df = spark.read.parquet(path)
    if model._ml_conform:
        df = ml_conform(df, levels=model.category_levels(), keep=model._ml_keep)
    return df
