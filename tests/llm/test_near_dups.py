import random

import numpy as np
import pytest

from tablewright.llm import near_dups
from tablewright.llm.graph import components
from tablewright.llm.work import work_dir

from ..conftest import SF001
from . import brute, edge


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_matches_brute_force(spark, words, percent):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute.near_duplicates(rows, words, percent)
    got = near_dups.near_duplicates(docs, words=words, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_family_of_edits_around_the_threshold(spark):
    """Pairs just above and below the threshold, found through leaders and through the prefix join."""
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):
        words = list(base)
        for _ in range(rnd.randint(0, 9)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(40)}"
        rows.append((d, " ".join(words)))
    want = brute.near_duplicates(rows, 3, 85)
    got = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


def test_edge_cases(spark):
    got = near_dups.near_duplicates(edge.table(spark), words=3, percent=85).collect()
    assert len(got) == len(edge.ROWS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert by_id[1].component_id == 1 and by_id[2].component_id == 2  # empty sets are never linked
    assert by_id[4].component_id == by_id[5].component_id == 4
    assert by_id[6].n_shingles == 1 and by_id[7].n_shingles == 1
    assert by_id[None].component_id is None and by_id[None].kept
    assert near_dups.near_duplicates(edge.empty(spark)).collect() == []


def test_signature_is_the_minimum_of_the_shifted_permutation():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 50, dtype=np.uint64)
    sig = near_dups.signatures(values, np.array([0, 20, 50]), 8)
    assert sig.shape == (2, 8)
    # one element alone gives the permutation itself; the minimum over a set is the least of them
    alone = near_dups.signatures(values, np.arange(51), 8)
    assert (sig[0] == alone[:20].min(axis=0)).all() and (sig[1] == alone[20:].min(axis=0)).all()
    assert len({tuple(x) for x in alone}) == 50


def test_band_plan():
    bands = near_dups.band_plan(0.85)
    assert (1 - 0.85**near_dups.ROWS) ** bands <= near_dups.MISS


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (0, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df, work_dir(spark)).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long"), work_dir(spark)).collect() == []
