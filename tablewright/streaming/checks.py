"""Row-level checks (V15) on a streaming DataFrame.

The reference has no streams. The only piece of it that applies unchanged to
an unbounded input is the per-row part of a data model: coercion, null and
range checks and custom row checks are plain Column expressions, so incoming
micro-batches can be split into accepted and quarantined rows as they arrive.
Table-level checks (non-empty, has a value, uniqueness) need the whole table
and stay with the batch validation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.model import DataModel, _custom_specs, _prepare, _row_specs


def tag_failures(df: DataFrame, model: type[DataModel]) -> DataFrame:
    """Coerced rows plus ``failed_checks`` (row-level checks only).

    Works on batch and streaming frames alike; no aggregation, no state.
    """
    prep = _prepare(df, model)
    specs = [s for s in _row_specs(prep, model) + _custom_specs(model) if s.fails is not None]
    flags = [F.when(F.coalesce(s.fails, F.lit(False)), F.lit(s.check)) for s in specs]
    out = prep.checked.withColumn(
        "failed_checks",
        F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>"),
    )
    return out.select(*[f"`{c}`" for c in prep.frame.columns], "failed_checks")


def split_stream(
    df: DataFrame,
    model: type[DataModel],
    *,
    accepted_path: str,
    quarantine_path: str,
    checkpoint_path: str,
    trigger_once: bool = False,
) -> StreamingQuery:
    """Write passing rows to ``accepted_path`` and failing rows, with the
    names of the checks they fail, to ``quarantine_path``.

    One ``foreachBatch`` writes both outputs. Each micro-batch goes to its own
    ``batch=<id>`` folder, overwritten if the batch is replayed after a
    failure, so together with the checkpoint every row lands exactly once.
    """
    tagged = tag_failures(df, model)

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            batch.where(F.size("failed_checks") == 0).drop("failed_checks").write.mode(
                "overwrite"
            ).parquet(f"{accepted_path}/batch={epoch}")
            batch.where(F.size("failed_checks") > 0).write.mode("overwrite").parquet(
                f"{quarantine_path}/batch={epoch}"
            )
        finally:
            batch.unpersist()

    writer = tagged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
