"""The user-day panel over the ``events`` table: data models and defaults.

This is the worked example the queries, tests and benchmark share: identifiers
are every user with events in the window crossed with every day of the window
(``sources/sql/index.sql``); daily features and the target come from
``features.sql`` and ``target.sql``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.assemble import Assembly, assemble
from ..operators.model import DataModel, Field
from ..sources.sql_files import load_sql_files
from ..sources.tables import register_parquet_views

# The event types.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
IDS = ("id", "date")
TARGET = "target"


class EventPanelInputs(DataModel):
    """Identifiers and features, without the target."""

    id = Field("bigint")
    date = Field("date")
    spend = Field("double", nullable=True, ge=0)
    clicks = Field("bigint", nullable=True, ge=0)
    err = Field("boolean", nullable=True)
    top_type = Field("category", nullable=True, levels=EVENT_TYPES)
    _unique = {"identifiers_are_unique": ["id", "date"]}


class EventPanelRaw(EventPanelInputs):
    target = Field("double", nullable=True)


class EventPanelProcessed(EventPanelRaw):
    """Raw checks, then the ML types; identifiers keep their exact type."""

    _ml_conform = True
    _ml_keep = ("id",)


class EventPanelPredict(EventPanelInputs):
    """For prediction windows, where no target exists yet (V10 would fail)."""

    _ml_conform = True
    _ml_keep = ("id",)


def register_events(spark: SparkSession, sf_dir: str) -> None:
    register_parquet_views(spark, sf_dir, ["events"])


def window(spark: SparkSession) -> dict[str, date]:
    """Parameters of the panel: the first and last day of the registered events."""
    first, last = spark.table("events").agg(
        F.min(F.col("ts").cast("date")), F.max(F.col("ts").cast("date"))
    ).first()
    return {"start_date": first, "end_date": last}


def panel_queries() -> dict[str, str]:
    return load_sql_files()


def panel_assembly(spark: SparkSession, sf_dir: str, params=None) -> Assembly:
    register_events(spark, sf_dir)
    return assemble(spark, panel_queries(), params or window(spark))


def panel(spark: SparkSession, sf_dir: str, params=None) -> DataFrame:
    return panel_assembly(spark, sf_dir, params).panel


def raw_panel(spark: SparkSession, sf_dir: str, params=None) -> DataFrame:
    """The validated panel read from its snapshot (built once, then reused)."""
    from .snapshot import fetch_data

    register_events(spark, sf_dir)
    return fetch_data(spark, params or window(spark), panel_queries(), data_model=EventPanelRaw)


def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-typed panel rows with a known target, over the snapshot.

    Fitting scans its input several times (means, levels, trees); reading a
    written snapshot instead of re-running the joins keeps each scan cheap and
    cuts the lineage, so a lost executor never recomputes the assembly.
    """
    from ..operators.process import process_frame

    return process_frame(
        raw_panel(spark, sf_dir),
        data_model=EventPanelProcessed,
        filters=[F.col(TARGET).isNotNull()],
        proven_unique=list(EventPanelProcessed._unique),
    )
