"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Sources are ordered by code point (null last) and weigh 1, 2, 3, 1, 2, 3, ... .
The total size is shared by weight; a source stops at ``max_epochs`` times its
own size, and its excess is shared again by weight among the others until none
is above its cap. The fixed point of that repetition is the water level L with
target = min(cap, L * weight): ordered by cap / weight, the sources that reach
their cap come first, and L follows from the rest in one window over the sources
(one row per source, not per document).

A source with target / size = w + f takes every document w times whole, and one
more repetition of a seeded part f of it: documents are ordered by a seeded
digest of their id in ``SLICES`` slices; slices below the cut are repeated
whole, the slice at the cut contributes the missing words, spread over its
documents as a fractional repetition. Documents are joined with one row per source. The words taken differ from the target by
rounding only, without sorting or collecting a source. Reruns agree: everything
depends on the seed, the ids and the sizes.

Size is the number of ``[^\\x20\\x09-\\x0D]+`` in the text (null: 0). Repeated ids
are separate documents that fall into one slice; documents of size 0 take 0
words. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.work import work_dir, written

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
HEX_DIGITS = 3  # 16**3 slices
_PLAN = "__mixing_plan"  # clashes with no column of a document table


def n_words(text: Column) -> Column:
    """Number of words of a text, as a JVM expression."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def slice_of(id_col: Column, seed: str = SEED) -> Column:
    """Seeded slice of a document: the first hex digits of a digest of its id."""
    return F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null")))), 1, HEX_DIGITS)


def targets(sizes: DataFrame, *, max_epochs: int = MAX_EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight, target`` of the per-source table ``source, source_size``."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * max_epochs)
    # in the order in which a rising level reaches the caps
    rising = W.orderBy(
        (F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    )
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    left_size = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = weighed.withColumn("level", left_size / left_weight)
    # the first source whose cap the level does not reach fixes the level for all after it
    free = F.col("cap") >= F.col("level") * F.col("weight")
    level = levelled.withColumn(
        "water", F.first(F.when(free, F.col("level")), ignorenulls=True).over(rising.rowsBetween(W.unboundedPreceding, 0))
    )
    target = F.when(F.col("water").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight"))
    )
    return level.select("source", "source_size", "weight", target.alias("target"))


def _plan(sized: DataFrame, max_epochs: int, weights: tuple[int, ...]) -> DataFrame:
    """One row per source: target, whole repetitions, the slice at the cut and its fraction."""
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    per_source = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = targets(per_source, max_epochs=max_epochs, weights=weights).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.least(
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
            F.lit(max_epochs),
        ).alias("whole"),
    ).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    order = W.partitionBy("_source").orderBy("slice")
    run = slices.join(goal, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "done", F.coalesce(F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    part = F.when(F.col("words") > 0, (F.col("missing") - F.col("done")) / F.col("words")).otherwise(0.0)
    cut = F.struct(F.col("slice"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), part)).alias("part"))
    return run.groupBy("_source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.first("whole").alias("whole"),
        F.max(F.when(F.col("done") <= F.col("missing"), cut)).alias("cut"),  # the last slice that is reached
    )


def _taken(size: Column, slice_: Column, plan: str, max_epochs: int) -> Column:
    """Words taken of a document: whole repetitions, and what its slice has of one more."""
    part = (
        F.when(slice_ < F.col(f"{plan}.cut.slice"), 1.0)
        .when(slice_ == F.col(f"{plan}.cut.slice"), F.col(f"{plan}.cut.part"))
        .otherwise(0.0)
    )
    return F.least(F.col(f"{plan}.whole") * size + F.floor(part * size + F.lit(0.5)), size * max_epochs).cast("long")


def _struct_plan(plan: DataFrame, folder: str) -> DataFrame:
    return written(plan, folder, "plan").select(F.struct("*").alias(_PLAN))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_epochs: int = MAX_EPOCHS,
    weights: tuple[int, ...] = WEIGHTS,
    seed: str = SEED,
) -> DataFrame:
    """``id, size, source_size, target, taken`` for every document; ``taken`` counts words with repetitions."""
    folder = work_dir(docs.sparkSession)
    sized = written(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
            n_words(F.col(text_col)).alias("size"), slice_of(F.col(id_col), seed).alias("slice"),
        ),
        folder, "sizes",
    )
    plan = _struct_plan(_plan(sized, max_epochs, weights), folder)
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col(f"{_PLAN}._source")))
    return joined.select(
        F.col("id").alias(id_col),
        "size",
        F.col(f"{_PLAN}.source_size").alias("source_size"),
        F.col(f"{_PLAN}.target").cast("double").alias("target"),
        _taken(F.col("size"), F.col("slice"), _PLAN, max_epochs).alias("taken"),
    )


def _first_words(text: Column, n: Column) -> Column:
    """The text up to its n-th word, white space as it is."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0)
    return F.array_join(F.slice(pieces, F.lit(1), n), "")


def mix_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_epochs: int = MAX_EPOCHS,
    weights: tuple[int, ...] = WEIGHTS,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: one row of ``docs`` for every repetition it takes.

    ``repetition`` counts from 0, ``words_taken`` are the words of the row. Whole
    repetitions have the whole text; the fractional one of the slice at the cut has
    the text's first words, as many as it takes. A document that the mix takes
    nothing of gives no row (nor does one without words). Columns of those names are
    replaced. Repeated rows stay separate documents.
    """
    folder = work_dir(docs.sparkSession)
    size = n_words(F.col(text_col))
    sized = docs.select(
        F.col(source_col).cast("string").alias("source"), size.alias("size"), slice_of(F.col(id_col), seed).alias("slice")
    )
    plan = _struct_plan(_plan(sized, max_epochs, weights), folder)
    taken = _taken(size, slice_of(F.col(id_col), seed), _PLAN, max_epochs)
    joined = docs.join(plan, F.col(source_col).cast("string").eqNullSafe(F.col(f"{_PLAN}._source")))
    counted = joined.withColumn(_PLAN, F.struct(size.alias("size"), taken.alias("taken"))).where(F.col(f"{_PLAN}.taken") > 0)
    repetitions = F.sequence(F.lit(0), F.ceil(F.col(f"{_PLAN}.taken") / F.col(f"{_PLAN}.size")).cast("int") - 1)
    left = F.col(f"{_PLAN}.taken") - F.col("repetition") * F.col(f"{_PLAN}.size")
    words = F.least(left, F.col(f"{_PLAN}.size"))
    cut = F.when(words < F.col(f"{_PLAN}.size"), _first_words(F.col(text_col), words.cast("int"))).otherwise(F.col(text_col))
    return (
        counted.withColumn("repetition", F.explode(repetitions)).withColumn("words_taken", words.cast("long"))
        .withColumn(text_col, cut).drop(_PLAN)
    )
