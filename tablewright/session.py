"""Session defaults and the shared work folder.

Everything the library writes (snapshots, run records, saved models, staging
tables) goes below one shared folder. On a cluster that is the folder named in
``spark.checkpoint.dir``; a machine-local temporary folder is only created when
the setting is absent (local tests, the smoke check).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library relies on: UTC wall clock for all
# timestamp conversions, ANSI casts, adaptive execution with skew handling.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(
    master: str | None = None,
    app_name: str = "tablewright",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster leave them unset and let the deployment decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL defaults on an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)


def require_utc(spark: SparkSession) -> None:
    """Timestamp coercion converts through the session zone; insist on UTC."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(
            f"session time zone must be UTC for timestamp coercion, found {tz!r}; "
            "set spark.sql.session.timeZone=UTC"
        )


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Shared folder for everything this library writes.

    Read from ``spark.checkpoint.dir``; only when it is unset (tests) a temporary
    folder is created and registered as the checkpoint folder as well.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder every executor can reach; "
                "a temporary folder is only used for local sessions"
            )
        root = tempfile.mkdtemp(prefix="tablewright-")
        _LOCAL_ROOTS[sc.applicationId] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_join(root, "checkpoints"))
    return _join(root, *parts) if parts else root


# Fallback roots of sessions started without spark.checkpoint.dir (tests only).
_LOCAL_ROOTS: dict[str, str] = {}


def _join(root: str, *parts: str) -> str:
    """Join path parts for local paths and URIs alike."""
    out = root.rstrip("/")
    for part in parts:
        out = f"{out}/{part.strip('/')}"
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on any Hadoop-compatible file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below ``path`` (empty when it is absent)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath)]


def file_versions(spark: SparkSession, files: list[str]) -> list[str]:
    """``path:length:modification time`` of the given files, one listing per folder."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    wanted, out = set(files), []
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        hpath = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        for st in hpath.getFileSystem(conf).listStatus(hpath):
            name = f"{folder}/{st.getPath().getName()}"
            if name in wanted:
                out.append(f"{name}:{st.getLen()}:{st.getModificationTime()}")
                wanted.discard(name)
    return sorted([*out, *wanted])
