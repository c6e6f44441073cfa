"""Every check must fail on bad real data, counted like DuckDB does."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tablewright.operators.model import DataModel, Field, ValidationError, failure_rows, report, validate

from .conftest import SF01


class LineKeys(DataModel):
    l_orderkey = Field("bigint")
    l_linenumber = Field("int")
    _unique = {"identifiers_are_unique": ["l_orderkey", "l_linenumber"]}


class Balances(DataModel):
    c_custkey = Field("bigint")
    c_acctbal = Field("double", ge=0, lt=8000)


def _duck(sql):
    return duckdb.connect().execute(sql).fetchone()


def test_lineitem_pairs_are_not_unique(spark):
    df = spark.read.parquet(f"{SF01}/lineitem.parquet")
    groups, rows = _duck(
        f"select count(*), sum(n) from (select count(*) n from '{SF01}/lineitem.parquet' "
        "group by l_orderkey, l_linenumber having count(*) > 1)")
    rep = {r.check: r for r in report(df, LineKeys).collect()}
    assert rep["identifiers_are_unique"].failed_rows == rows and not rep["identifiers_are_unique"].passed
    with pytest.raises(ValidationError, match="identifiers_are_unique"):
        validate(df, LineKeys)
    flagged = failure_rows(df, LineKeys)
    assert flagged.count() == rows
    assert flagged.select("l_orderkey", "l_linenumber").distinct().count() == groups


def test_balances_out_of_range(spark):
    df = spark.read.parquet(f"{SF01}/customer.parquet")
    (bad,) = _duck(f"select count(*) from '{SF01}/customer.parquet' where c_acctbal < 0 or c_acctbal >= 8000")
    assert failure_rows(df, Balances).count() == bad
    with pytest.raises(ValidationError, match="greater_than_or_equal_to"):
        validate(df, Balances)


def test_entry_runs_on_a_bare_session(spark):
    import __spark_entry__ as E

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = E.entry(spark)
        assert df.count() > 0
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert df.where(F.col("id").isNull()).count() == 0
