"""Day spines and the training / prediction windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRAINING_DAYS = 365 * 5
PREDICTION_DAYS = 60


def day_sequence(start: Column, end: Column) -> Column:
    """Array of every day from ``start`` to ``end``, both included."""
    return F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))


def calendar_spine(spark: SparkSession, start_date: date, end_date: date, name: str = "date") -> DataFrame:
    """One row per day, inclusive on both ends; no cap on the length."""
    return spark.range(1).select(
        F.explode(day_sequence(F.lit(start_date), F.lit(end_date))).alias(name)
    )


def entity_day_panel(entities: DataFrame, start: Column, end: Column, name: str = "date") -> DataFrame:
    """Q4: entities x days, as a projection: every entity row explodes its own days.

    No join and nothing to broadcast; the entities keep their partitions.
    """
    return entities.withColumn(name, F.explode(day_sequence(start, end)))


def training_window(cutoff: date | None = None, num_samples: int = TRAINING_DAYS) -> tuple[date, date]:
    """``[cutoff - (n - 1) days, cutoff]``; cutoff defaults to yesterday."""
    if cutoff is None:
        cutoff = date.today() - timedelta(days=1)
    _check_window(num_samples)
    if cutoff >= date.today():
        raise ValueError(f"training_cutoff must be in the past, got {cutoff}")  # F20
    return cutoff - timedelta(days=num_samples - 1), cutoff


def prediction_window(start: date | None = None, num_samples: int = PREDICTION_DAYS) -> tuple[date, date]:
    """``[start, start + (n - 1) days]``; start defaults to today."""
    if start is None:
        start = date.today()
    _check_window(num_samples)
    return start, start + timedelta(days=num_samples - 1)


def _check_window(num_samples: int) -> None:
    if not isinstance(num_samples, int) or isinstance(num_samples, bool) or num_samples <= 0:
        raise ValueError(f"num_samples must be a positive integer, got {num_samples!r}")  # F20
