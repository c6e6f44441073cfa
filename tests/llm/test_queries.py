"""Registered queries against DuckDB, and the pipeline against its parts."""

import pytest

import corpus_pipeline
from tablewright.llm import queries
from tools.check_oracle import duck, rows_of

from ..conftest import SF01, SF001
from . import brute, edge


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF001)
    res = duck(SF001).execute(queries.ORACLE_SQL[name])
    want = rows_of([d[0] for d in res.description], res.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def _check_mix(before, mixed):
    """Words of the returned rows against the targets of their sources, and texts against their documents."""
    from tablewright.llm import mixing

    want = {r.doc_id: r.taken for r in mixing.mix(before).collect()}
    text = {r.doc_id: r.text for r in before.collect()}
    got, by_source = {}, {}
    for r in mixed.collect():
        assert len(brute.words(r.text)) == r.words_taken > 0
        assert text[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        got.setdefault(r.doc_id, []).append(r.repetition)
        by_source.setdefault(r.source, [0, 0])[0] += r.words_taken
        want[r.doc_id] -= r.words_taken
    assert not any(want.values()) and all(sorted(v) == list(range(len(v))) for v in got.values())
    target = {r.source: r.target for r in mixing.mix(before).join(before.select("doc_id", "source"), "doc_id").collect()}
    assert all(abs(by_source.get(s, [0])[0] - t) <= 25 for s, t in target.items())
    assert len(got) < len(text)


def test_stages_act_on_what_the_one_before_kept(spark):
    from tablewright.llm import toxicity
    from tablewright.llm.work import work_dir, written

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    columns, folder, kept = docs.columns, work_dir(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, SF01), folder, name)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{SF01}/labels.parquet"))
            scored = toxicity.score_documents(before, model).collect()
            assert kept[name] == {r.doc_id for r in scored if not r.predicted}
        if name == "line_dedup":
            assert kept[name] == kept["toxicity"]
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
            want = brute.near_duplicates(rows, 5, 80)
            assert kept[name] == {d for d, (_, c) in want.items() if d == c}
        if name == "mixing":
            assert docs.columns == [*columns, "repetition", "words_taken"]
            _check_mix(before, docs)
            rows = docs.count()
    assert corpus_pipeline.run(spark, SF01).count() == rows


def test_work_tables_are_freed_once_results_are_written(spark):
    from tablewright.llm.work import freed, work_dir, written
    from tablewright.session import path_exists

    with freed(spark):
        folder = work_dir(spark)
        written(spark.range(3), folder, "t")
        assert path_exists(spark, folder)
    assert not path_exists(spark, folder)


def test_stages_take_awkward_rows(spark):
    docs = edge.table(spark)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns and out.count() > 0
        assert stage(spark, edge.empty(spark), SF001).count() == 0
    assert corpus_pipeline.mix_sources(spark, edge.empty(spark), SF001).count() == 0
