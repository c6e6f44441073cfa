"""Licence scan by canonical digests.

A text is normalised and hashed; a hash join with the digests of known licence
texts names the licence. Normalisation makes equal what licence matching treats
as equal: case, punctuation and white space, copyright lines (a line that starts
with "copyright" or "(c)", comment marks aside, and holds a year, a placeholder or
nothing but names is removed whole), a licence's title above its text, and
equivalent spellings. Only whole texts are compared: a
whole document, a whole paragraph (blank lines around it) or a whole line.

The scan is DataFrame expressions only. The known table is a fixed list of a few
dozen digests (of wordings, and the digests themselves of the long texts); it is the
broadcast side whatever the size of the documents. A
text can only match if it holds one of ``MARKERS``, as every known text does, so
documents and units without them are left out before the normalisation.

One row per document, licence and unit kind, with the number of matching units;
documents without a match give no row. Null and empty texts match nothing.
Repeated ids are counted together. Extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.license_texts import FULL_TEXTS, KNOWN, SPELLINGS

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”‘’«»–—…©"
# A line that begins with a copyright mark and has a year, a placeholder or a reservation ...
COPYRIGHT_LINE = (
    r"(?im)^[^\p{L}(©\n]*(?:(?:copyright\b|\(c\)|©)[^\n]*(?:\d|all rights reserved|[<\[{](?:year|yyyy|name|full ?name|copyright))[^\n]*"
    r"|all rights reserved[^\p{L}\n]*)$"
)
# ... or is a mark and names only: capitalised words, and what stands between them.
_BETWEEN = r"(?:[ \t]+(?:(?:and|of|the|by|&|\([cC]\)|©)[ \t]+)*"
HOLDER_LINE = (
    r"(?m)^[^\p{L}(©\n]*(?:"
    r"(?:[Cc]opyright|COPYRIGHT)(?:[ \t]*(?:\([cC]\)|©))?" + _BETWEEN + r"\p{Lu}[\p{Ll}'’.-]*,?){1,8}"
    r"|(?:\([cC]\)|©)(?:[ \t]*[Cc]opyright)?" + _BETWEEN + r"\p{Lu}[\p{L}\p{N}'’.-]*,?){1,8}"
    r")[ \t\r]*$"
)
# Titles that stand above licence texts, normalised.
TITLES = (
    "mit license", "the mit license", "the mit license mit", "mit license mit", "mit expat license", "expat license",
    "isc license", "the isc license", "isc license isc", "the isc license isc",
    "0bsd license", "bsd zero clause license", "zero clause bsd license", "bsd zero clause license 0bsd",
    "bsd license", "the bsd license", "bsd 2 clause license", "the bsd 2 clause license", "bsd 2 clause simplified license",
    "simplified bsd license", "freebsd license", "2 clause bsd license", "bsd 3 clause license", "the bsd 3 clause license",
    "bsd 3 clause new or revised license", "new bsd license", "the new bsd license", "modified bsd license",
    "revised bsd license", "3 clause bsd license",
    "zlib license", "the zlib license", "zlib libpng license", "the zlib libpng license", "unlicense", "the unlicense",
    "license", "software license", "license agreement",
)
_TITLE = "^(?:" + "|".join(sorted(TITLES, key=lambda t: (-len(t), t))) + ") "


# Each known text has at least one of these words, in any case and equivalent spelling.
# Spelled out by letter: much faster than lower-casing whole documents first.
MARKERS = r"[lL][iI][cC][eE][nN][sScC]|[sS][oO][fF][tT][wW][aA][rR][eE]|[cC][cC][^A-Za-z]*[bB][yY]"


def _pattern(variant: str) -> str:
    head = r"\b" if variant[0].isalnum() else ""
    tail = r"\b" if variant[-1].isalnum() else ""
    return head + re.escape(variant).replace(r"\ ", r"\s+") + tail


def normalised(text: Column) -> Column:
    """Canonical form of a text: words of letters and digits, one space between, no title above."""
    out = F.lower(F.regexp_replace(F.regexp_replace(text, COPYRIGHT_LINE, " "), HOLDER_LINE, " "))
    for variant, canonical in SPELLINGS:
        out = F.regexp_replace(out, _pattern(variant), canonical)
    out = F.translate(out, PUNCTUATION, " " * len(PUNCTUATION))
    return F.regexp_replace(F.trim(F.regexp_replace(out, r"\s+", " ")), _TITLE, "")


def _may_match(text: Column, known) -> Column:
    """A condition every matching text meets (always true if some known text has no marker)."""
    if not all(re.search(MARKERS, body) for _, _, body in known):
        return F.lit(True)
    return text.rlike(MARKERS)


def known_digests(spark: SparkSession, known=KNOWN, full=FULL_TEXTS) -> DataFrame:
    """``license_id, kind, chars, digest`` of the known texts, normalised by the same expressions."""
    rows = spark.createDataFrame(list(known), "license_id string, kind string, text string")
    form = normalised(F.col("text"))
    short = rows.select("license_id", "kind", F.length(form).alias("chars"), F.sha2(form, 256).alias("digest"))
    long_ = spark.createDataFrame(list(full), "license_id string, chars int, digest string").select(
        "license_id", F.lit("text").alias("kind"), "chars", "digest"
    )
    return short.unionByName(long_).distinct()


def scan_licenses(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", known=KNOWN, full=FULL_TEXTS
) -> DataFrame:
    """``id, license_id, kind, unit, n_matches``."""
    spark = docs.sparkSession
    table = known_digests(spark, known, full)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.split(text, "\n", -1)
    paragraphs = F.split(text, r"\n[\x20\t\r]*\n", -1)
    unit = lambda kind: lambda x: F.struct(F.lit(kind).alias("unit"), x.alias("body"))
    units = F.concat(
        F.array(F.struct(F.lit("document").alias("unit"), text.alias("body"))),
        F.when(F.size(paragraphs) > 1, F.transform(paragraphs, unit("paragraph"))).otherwise(F.array()),
        F.when(F.size(lines) > 1, F.transform(lines, unit("line"))).otherwise(F.array()),
    )
    bodies = (
        docs.where(_may_match(text, known))
        .select(F.col(id_col).alias("id"), F.explode(units).alias("u"))
        .select("id", "u.unit", "u.body")
    )
    form = bodies.where(_may_match(F.col("body"), known)).select("id", "unit", normalised(F.col("body")).alias("form"))
    hashed = form.where(F.col("form") != "").select("id", "unit", F.sha2("form", 256).alias("digest"))
    found = hashed.join(F.broadcast(table.select("license_id", "kind", "digest")), "digest")
    return found.groupBy(F.col("id").alias(id_col), "license_id", "kind", "unit").agg(
        F.count("*").alias("n_matches")
    )
