"""Registered queries against their DuckDB oracle at sf0.01 (a representative set).

``python tools/check_oracle.py`` runs all of them.
"""

import re

import pytest

import __spark_entry__ as E
from tools.check_oracle import duck, rows_of

from .conftest import SF01

NAMES = [
    "sql_params_in_list", "scan_inline_values", "cross_join_digits", "cte_chain",
    "assemble_left_join", "check_one_to_one", "identifier_inference", "coerce_timestamp_utc",
    "validation_report", "failure_rows", "check_row_index", "pipeline_compose", "kfold_assign",
    "score_r2",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_entry_or_is_documented():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert {n for n in set(qs) - set(oracle) if not re.match(r"op\d+_|pipeline$", n)} == set()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    s_rows, s_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    o_rows, o_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "date", "spend", "clicks", "err", "top_type", "target"]
    assert df.count() > 0
