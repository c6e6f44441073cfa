"""Drop rows, validate to ML types, split features from the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from .model import DataModel, validate


def process_frame(
    raw: DataFrame,
    *,
    data_model: type[DataModel],
    filters: Sequence[Column] = (),
    proven_unique: Sequence[str] = (),
) -> DataFrame:
    """P1 then validation: the rows that pass every filter, checked and converted.

    Filters may only drop rows (no imputation); by default there are none.
    ``proven_unique`` names uniqueness checks the input already passed (for
    example a validated snapshot): dropping rows keeps keys unique, so those
    grouped counts -- a shuffle of every key -- are not repeated.
    """
    kept = raw
    for cond in filters:
        kept = kept.where(cond)
    return validate(kept, data_model, skip=proven_unique)


def process_data(
    raw: DataFrame,
    target_column: str,
    *,
    data_model: type[DataModel],
    filters: Sequence[Column] = (),
    proven_unique: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(X, y)``, the validated frame without and with only the target.

    The two frames share no key, so they cannot be re-aligned after a shuffle;
    the trainer therefore works on :func:`process_frame`'s single frame and
    this split exists for callers that need the reference's shape.
    """
    frame = process_frame(raw, data_model=data_model, filters=filters, proven_unique=proven_unique)
    if target_column not in frame.columns:
        raise KeyError(target_column)
    return frame.drop(target_column), frame.select(target_column)
