"""Document fingerprints by winnowing, in DataFrame expressions.

The text is taken as UTF-8 bytes. Every ``K``-byte gram is hashed; of every ``W``
consecutive grams the least hash is chosen, the rightmost of equal ones. The chosen
grams with their byte positions are the fingerprint. Any ``K + W - 1`` bytes that
two texts share are one whole window of both and give both the same chosen gram,
and no agreement of under ``K`` bytes can (but for equal hashes): the guarantees of
the method. A text of fewer bytes than a gram is one gram, one of fewer grams than a
window is one window, an empty text has no gram.

A gram is one long: 33 bits of its hash, then the complement of its position, so
that the least number of a window is its least hash, rightmost on ties. Windows go
in two steps (least of 4, of those least of 4) over pieces of ``PIECE`` starts, so
that a text of any length needs the memory of a piece and of its fingerprint.

``edited_fingerprint`` reuses what the two texts share: positions chosen never go
back as windows advance, so of the kept front all chosen grams before the first one
of its last whole window stay, and only windows from there on are computed again.

The next document is found without a global window: the ids alone are dealt into
ranges, whose least keys are the bounds of buckets (a few a partition, on the
driver). A bucket's first document is also a guest at the end of the bucket before,
so every document meets its next one inside its bucket: one shuffle of the texts.

Order is the id (nulls first), for equal ids a hash of the text; the last document
is followed by the first, a lone one by itself. Null texts are empty. Two empty
fingerprints are alike (1), an empty and another are not (0). Rows equal in id and
text are rows like any other. Extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, W = 12, 16
SPAN = K + W - 1
_FIRST, _SECOND = (1, 2, 3), (4, 8, 12)  # 4 x 4 = W
PIECE_BITS = 14
PIECE = 1 << PIECE_BITS
_POSITION_BITS = 31
_LAST_POSITION = (1 << _POSITION_BITS) - 1
BUCKETS_PER_PARTITION = 3


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def position(gram: Column) -> Column:
    """Byte position of a chosen gram."""
    return F.lit(_LAST_POSITION) - gram.bitwiseAND(F.lit(_LAST_POSITION))


def gram_hash(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, _POSITION_BITS)


def _least(grams: Column, steps) -> Column:
    return F.transform(grams, lambda x, i: F.least(x, *(F.get(grams, i + s) for s in steps)))


def _chosen(piece: Column, start: Column) -> Column:
    """Chosen grams of the windows that lie in a piece of text beginning at ``start``."""
    last = F.lit(_LAST_POSITION).cast("long") + 1 - start
    grams = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length(piece) - (K - 1))),
        lambda i: F.shiftleft(F.xxhash64(F.substring(piece, i, F.lit(K))), _POSITION_BITS).bitwiseOR(last - i),
    )
    windows = lambda x: F.slice(x, F.lit(1), F.greatest(F.lit(1), F.size(x) - (W - 1)))
    second = lambda x: F.transform(windows(x), lambda y, i: F.least(y, *(F.get(x, i + s) for s in _SECOND)))
    return F.array_distinct(_let(_let(grams, lambda x: _least(x, _FIRST)), second))


def winnow(data: Column, start: Column | None = None) -> Column:
    """Chosen grams (``array<long>``) of binary ``data``, by position; ``start``: position of its first byte."""
    start = F.lit(0).cast("long") if start is None else start
    size = F.octet_length(data)
    pieces = F.sequence(F.lit(0), F.shiftright(F.greatest(F.lit(0), size - SPAN), PIECE_BITS))
    found = F.transform(
        pieces,
        lambda c: _let(
            F.substring(data, c * PIECE + 1, F.lit(PIECE + SPAN - 1)), lambda piece: _chosen(piece, start + c * PIECE)
        ),
    )
    none = F.array().cast("array<bigint>")
    return F.when(size == 0, none).otherwise(F.array_distinct(F.flatten(found)))


def fingerprint(chosen: Column) -> Column:
    """Chosen grams as text: ``hash:position`` in hexadecimal and decimal digits, separated by spaces."""
    return F.array_join(
        F.transform(chosen, lambda x: F.concat(F.lower(F.hex(gram_hash(x))), F.lit(":"), position(x).cast("string"))), " "
    )


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes among all hashes of two fingerprints."""
    hashes = lambda x: F.array_distinct(F.transform(x, gram_hash))

    def share(pair: Column) -> Column:
        both = F.size(F.array_intersect(pair["a"], pair["b"]))
        return _let(both, lambda n: F.struct(n.alias("n"), (F.size(pair["a"]) + F.size(pair["b"]) - n).alias("of")))

    found = _let(F.struct(hashes(a).alias("a"), hashes(b).alias("b")), share)
    return _let(found, lambda x: F.when(x["of"] == 0, 1.0).otherwise(x["n"] / F.greatest(x["of"], F.lit(1))))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, grams`` (``array<struct<hash, position>>``) of every document: the match index of winnowing."""
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col), winnow(data).alias("_chosen")).select(
        id_col,
        F.transform("_chosen", lambda x: F.struct(gram_hash(x).alias("hash"), position(x).alias("position"))).alias("grams"),
    )


def with_next(docs: DataFrame, columns, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text``, the ``columns`` (name -> function of the text) and all of the next document (``next_`` ...)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    n = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = keyed.select("id", "tie").repartitionByRange(n, "id", "tie")
    firsts = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("id", "tie")).alias("k")).collect()
    kind = keyed.schema["id"].dataType
    bounds = F.array(
        *(F.struct(F.lit(r.k.id).cast(kind).alias("id"), F.lit(r.k.tie).cast("long").alias("tie"))
          for r in sorted(firsts, key=lambda r: r.p))
    )
    total = max(1, len(firsts))
    key = F.struct("id", "tie")
    bucket = F.size(F.filter(bounds, lambda b: b <= F.struct(F.col("id"), F.col("tie")))) - 1 if firsts else F.lit(0)
    at = lambda b, guest: F.struct(b.alias("bucket"), F.lit(guest).alias("guest"))
    home = at(F.col("bucket"), False)
    before = at((F.col("bucket") + (total - 1)) % total, True)
    first = F.get(bounds, F.col("bucket")) == key if firsts else F.lit(False)
    dealt = (
        keyed.withColumn("bucket", bucket)
        .select("id", "text", "tie", F.explode(F.when(first, F.array(home, before)).otherwise(F.array(home))).alias("at"))
        .select("id", "text", "tie", "at.bucket", "at.guest")
        .repartition("bucket")
        .select("*", *(f(F.col("text")).alias(name) for name, f in columns.items()))
    )
    order = Window.partitionBy("bucket").orderBy("guest", "id", "tie")
    names = ["text", *columns]
    return dealt.select(
        "id", "guest", *names, *(F.lead(c).over(order).alias(f"next_{c}") for c in names)
    ).where("NOT guest").drop("guest")


def edit_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's row for each document: its fingerprint, that of its edited text, and how alike they are."""
    rows = with_next(docs, {"chosen": lambda t: winnow(t.cast("binary"))}, id_col=id_col, text_col=text_col)
    n = F.length("text")
    quarter = F.shiftright(n, 2)
    parts = rows.select(
        "*", n.cast("long").alias("n_chars"), F.substring(F.col("text"), F.lit(1), n - quarter).alias("front"),
        F.substring(F.col("next_text"), F.lit(1), quarter).alias("head"),
    ).select("*", F.concat("front", "head").alias("edited"), F.octet_length("front").alias("kept"))
    start = F.greatest(F.lit(0), F.col("kept") - SPAN)
    data = F.col("edited").cast("binary")
    tail = F.substring(data, start + 1, F.octet_length("edited") - start)
    parts = parts.select("*", winnow(tail, start.cast("long")).alias("tail"))
    front = F.filter("chosen", lambda x: position(x) < position(F.get("tail", F.lit(0))))
    edited = F.when(F.col("kept") < SPAN, F.col("tail")).otherwise(F.concat(front, F.col("tail")))
    parts = parts.select("*", edited.alias("edited_chosen"))
    return parts.select(
        F.col("id").alias(id_col), "n_chars", F.sha2(data, 256).alias("edited_sha256"),
        fingerprint(F.col("chosen")).alias("fingerprint"), fingerprint(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("chosen"), F.col("edited_chosen")).alias("near_edited"),
        likeness(F.col("chosen"), F.col("next_chosen")).alias("near_next"),
    )
