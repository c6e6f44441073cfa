"""S10 by days: windows that overlap compute every day once.

A daily query is one whose rows of a day depend on that day's data only. ``DayStore``
keeps such results by day: a window takes the days that are covered and runs the query
for the gaps alone, each gap (a run of missing days) as one window of its own. What a
day depends on, the query, its other parameters and the version of its data, is part
of its marker, so changed data or SQL is a gap again.

Rows go to ``<key>/data/<run>/__day=...``, markers to
``<key>/days/<day>_<version>_<time>_<run>`` after the rows are complete; a failed fill
covers nothing, and of two fills of one day the newest counts.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assemble import Assembly, assemble_frames, run_queries
from ..session import file_versions, list_names, shared_dir
from ..sources.params import SqlParams, markers

DAY = "__day"
START, END = "start_date", "end_date"


def days_between(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def gaps(wanted: Sequence[date], covered: set[date]) -> list[tuple[date, date]]:
    """Runs of consecutive days that are not covered."""
    out: list[tuple[date, date]] = []
    for day in wanted:
        if day in covered:
            continue
        if out and out[-1][1] + timedelta(days=1) == day:
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


class DayStore:
    """Results of daily queries by day, below ``root``."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or shared_dir(spark, "days")

    def key(self, query: str, params: SqlParams | None) -> str:
        """Hash of the query and its parameters but for the window."""
        used = set(markers(query)) - {START, END}
        payload = [query, sorted((k, repr(v)) for k, v in dict(params or {}).items() if k in used)]
        return hashlib.sha256(json.dumps(payload).encode()).hexdigest()

    def covered(self, key: str) -> dict[tuple[date, str], str]:
        """(day, version) -> newest run that holds it."""
        out: dict[tuple[date, str], tuple[str, str]] = {}
        for name in list_names(self.spark, f"{self.root}/{key}/days"):
            day, version, stamp, run = name.split("_")
            at = (date.fromisoformat(day), version)
            out[at] = max(out.get(at, ("", "")), (stamp, run))
        return {at: run for at, (_, run) in out.items()}

    def _source_version(self, frame: DataFrame) -> str:
        files = frame.inputFiles()
        known = file_versions(self.spark, files) if files else [self.spark.sparkContext.applicationId, str(frame.semanticHash())]
        return hashlib.sha256(json.dumps(known).encode()).hexdigest()[:16]

    def fetch(
        self,
        query: str,
        start: date,
        end: date,
        params: SqlParams | None = None,
        *,
        date_col: str = "date",
        version_of: Callable[[date], str] | None = None,
    ) -> DataFrame:
        """Rows of the window ``[start, end]``; only days that are not covered are computed.

        ``version_of`` names the version of a day's data (letters and digits), for a
        source that changes by days; by default every day has that of all files read.
        """
        params = dict(params or {})
        frame = run_queries(self.spark, {"q": query}, {**params, START: start, END: end})["q"]
        if version_of is None:
            same = self._source_version(frame)
            version_of = lambda day: same
        key, wanted = self.key(query, params), days_between(start, end)
        version = {day: version_of(day) for day in wanted}
        have = self.covered(key)
        for lo, hi in gaps(wanted, {d for d in wanted if (d, version[d]) in have}):
            self._fill(key, query, {**params, START: lo, END: hi}, date_col, {d: version[d] for d in days_between(lo, hi)})
        have = self.covered(key)
        by_run: dict[str, list[date]] = {}
        for day in wanted:
            by_run.setdefault(have[day, version[day]], []).append(day)
        out = None
        for run, days in sorted(by_run.items()):
            stored = self.spark.read.schema(frame.schema.add(DAY, "date")).parquet(f"{self.root}/{key}/data/{run}")
            part = stored.where(F.col(DAY).isin(days)).drop(DAY)
            out = part if out is None else out.unionByName(part)
        return out

    def _fill(self, key: str, query: str, params: dict, date_col: str, version: Mapping[date, str]) -> None:
        run = uuid.uuid4().hex
        frame = run_queries(self.spark, {"q": query}, params)["q"]
        day = F.to_date(F.col(f"`{date_col}`"))
        rows = frame.withColumn(DAY, day)
        outside = F.count_if(F.col(DAY).isNull() | ~F.col(DAY).between(F.lit(params[START]), F.lit(params[END])))
        rows.write.partitionBy(DAY).option("compression", "zstd").parquet(f"{self.root}/{key}/data/{run}")
        stored = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{key}/data/{run}")
        if stored.agg(outside).first()[0]:
            raise ValueError(f"a daily query gave rows outside its window {params[START]} to {params[END]}")
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        now = f"{time.time_ns():020d}"
        for d, v in version.items():
            marker = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}/days/{d.isoformat()}_{v}_{now}_{run}")
            marker.getFileSystem(conf).mkdirs(marker)


def entity_index(entities: DataFrame, start: date, end: date, *, id_col: str = "id", date_col: str = "date") -> DataFrame:
    """Every entity of the window on every day of it: the index of a panel, from daily entity rows."""
    days = F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day")))
    return entities.select(F.col(f"`{id_col}`")).distinct().select(F.col(f"`{id_col}`"), days.alias(date_col))


def assemble_window(
    spark: SparkSession,
    queries: Mapping[str, str],
    start: date,
    end: date,
    *,
    entities: str,
    params: SqlParams | None = None,
    store: DayStore | None = None,
    version_of: Callable[[date], str] | None = None,
) -> Assembly:
    """The panel of a window from daily queries: ``entities`` makes the index, all others are joined to it.

    Equal to a cold assembly of the window, but days that an earlier window computed
    are read from the store.
    """
    store = store or DayStore(spark)
    frames = {name: store.fetch(q, start, end, params, version_of=version_of) for name, q in queries.items() if name != entities}
    found = store.fetch(queries[entities], start, end, params, version_of=version_of)
    # merge joins: stored days are far smaller than their rows, so by its size a frame of any length may be sent to every task
    return assemble_frames({"index": entity_index(found, start, end), **{name: df.hint("merge") for name, df in frames.items()}})
