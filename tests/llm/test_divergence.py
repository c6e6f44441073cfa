import random

import pytest

from tablewright.llm import divergence

from ..conftest import SF001
from . import brute, edge

SCHEMA = "lang string, source string, text string"


def _got(df, **kw):
    return sorted(tuple(r) for r in divergence.audit(df, **kw).collect())


def _random_rows(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeé日" for b in "vwxyz"]
    out = []
    for _ in range(n):
        lang, source = rng.choice(["en", "fr", None, ""]), rng.choice([*"ABCDEFG", None])
        pool = words[ord(source or "A") % 7:][: rng.randrange(1, 30)]
        out.append((lang, source, rng.choice([None, "", "!!! 12", " ".join(rng.choice(pool) for _ in range(40)).upper()])))
    return out


@pytest.mark.parametrize(("seed", "min_docs"), [(1, 5), (2, 1), (3, 10_000)])
def test_audit_matches_brute_force(spark, seed, min_docs):
    rows = _random_rows(seed, 400)
    assert _got(spark.createDataFrame(rows, SCHEMA), min_docs=min_docs, top_terms=7) == brute.source_audit(rows, min_docs, 7)


def test_blocks_chunks_and_flushes_do_not_show(spark, monkeypatch):
    rows = _random_rows(4, 300)
    monkeypatch.setattr(divergence, "BLOCK", 40)
    monkeypatch.setattr(divergence, "LEAST_BLOCK", 20)
    monkeypatch.setattr(divergence, "CELLS", 10)
    monkeypatch.setattr(divergence, "FLUSH", 20)
    assert _got(spark.createDataFrame(rows, SCHEMA), min_docs=3) == brute.source_audit(rows, 3, 50)


def test_documents_match_brute_force(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("lang", "source", "text")
    assert _got(df) == brute.source_audit([tuple(r) for r in df.collect()], 30, 50)


def test_edge_rows(spark):
    rows = [(lang, source, text) for _, text, lang, source, *_ in edge.ROWS]
    assert _got(edge.table(spark), min_docs=1) == brute.source_audit(rows, 1, 50)
    assert _got(edge.table(spark)) == brute.source_audit(rows, 30, 50)
    assert _got(edge.empty(spark)) == []


def test_large_counts_stay_exact(spark):
    """The share of counts beyond what a long times 10**9 can hold."""
    from pyspark.sql import functions as F

    big = 9 * 10**15
    df = spark.range(1).select(F.lit(big).alias("n"), F.lit(2 * big).alias("size"), F.lit(3).cast("long").alias("terms"))
    got = df.select(divergence._share(F.col("n"), F.col("size"), F.col("terms")).alias("p")).first().p
    assert got == 1 + 10**9 * (big + 5) // (2 * big + 15)
