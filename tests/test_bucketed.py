"""J1 from stored buckets, and J2 proven by the plan."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators.assemble import ColumnOverlapError, NotUniqueError, assemble, assemble_frames, unique_by_plan
from tablewright.plans import panel as P
from tablewright.plans.bucketed import FrameStore, assemble_bucketed
from tablewright.session import list_names

from .conftest import SF01

QUERIES = {
    "index": "select o_orderkey as k from orders",
    "lines": "select l_orderkey as k, count(*) as n from lineitem where l_quantity > :q group by l_orderkey",
    "most": "select l_orderkey as k, max(l_extendedprice) as most from lineitem group by l_orderkey",
}


@pytest.fixture
def tables(spark):
    from tablewright.sources.tables import register_parquet_views

    register_parquet_views(spark, SF01, ["orders", "lineitem", "events"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_above_the_scans_and_same_rows(tables, tmp_path):
    spark, store = tables, FrameStore(tables, str(tmp_path / "frames"))
    got = assemble_bucketed(spark, QUERIES, {"q": 10}, buckets=6, store=store).joined
    want = assemble(spark, QUERIES, {"q": 10}).panel
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "Exchange" not in _plan(got) and "SortMergeJoin" in _plan(got)
    assert "Exchange" in _plan(want)


def test_only_changed_frames_are_computed(tables, tmp_path):
    spark, root = tables, str(tmp_path / "frames")
    before = assemble_bucketed(spark, QUERIES, {"q": 10}, buckets=4, store=FrameStore(spark, root)).joined
    first = set(list_names(spark, root))
    assert len(first) == 3
    for t in spark.catalog.listTables():  # as in another session, whose catalog knows nothing
        if t.name.startswith("frame_"):
            spark.sql(f"DROP TABLE {t.name}")
    again = assemble_bucketed(spark, QUERIES, {"q": 10, "unused": 1}, buckets=4, store=FrameStore(spark, root)).joined
    assert set(list_names(spark, root)) == first
    assert all(len(list_names(spark, f"{root}/{k}/published")) == 1 for k in first)
    assert "Exchange" not in _plan(again)
    more = {**QUERIES, "lines": QUERIES["lines"].replace("count(*)", "count(l_partkey)")}
    assert assemble_bucketed(spark, more, {"q": 10}, buckets=4, store=FrameStore(spark, root)).joined.count() == again.count()
    assert len(set(list_names(spark, root)) - first) == 1
    other = assemble_bucketed(spark, QUERIES, {"q": 45}, buckets=4, store=FrameStore(spark, root)).joined
    assert len(set(list_names(spark, root)) - first) == 2
    assert other.agg(F.sum("n")).first()[0] < again.agg(F.sum("n")).first()[0]


def test_duplicates_are_never_published(tables, tmp_path):
    spark, store = tables, FrameStore(tables, str(tmp_path / "frames"))
    bad = {**QUERIES, "lines": "select l_orderkey as k, l_quantity from lineitem"}
    for _ in range(2):
        with pytest.raises(NotUniqueError, match="lines"):
            assemble_bucketed(spark, bad, buckets=3, store=store)
    with pytest.raises(KeyError):
        assemble_bucketed(spark, {"lines": QUERIES["most"]}, buckets=3, store=store)
    with pytest.raises(ColumnOverlapError):
        assemble_bucketed(spark, {**QUERIES, "twin": QUERIES["most"]}, {"q": 1}, buckets=3, store=store)


def test_null_identifiers_and_empty_frames(tables, tmp_path):
    store = FrameStore(tables, str(tmp_path / "frames"))
    got = assemble_bucketed(tables, {
        "index": "select * from values (1), (cast(null as int)) as t(k)",
        "a": "select * from values (cast(null as int), 1), (1, 2) as t(k, a)",
        "b": "select k, b from values (1, 2) as t(k, b) where k > 5",
    }, buckets=2, store=store).joined
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 2, None), (None, None, None)], key=str)


def test_grouped_frames_are_unique_by_their_plans(tables):
    spark = tables
    sql = spark.sql
    yes = ["select l_orderkey as k, count(*) as n from lineitem group by l_orderkey",
           "select distinct o_orderkey as k from orders",
           "select k, n + 1 as m from (select l_orderkey as k, count(*) as n from lineitem group by l_orderkey) where n > 1"]
    no = ["select o_orderkey as k from orders", "select l_orderkey as k, l_linenumber, count(*) as n from lineitem group by 1, 2",
          "select k % 5 as k from (select distinct o_orderkey as k from orders)",
          "select k, explode(array(1, 2)) as x from (select distinct o_orderkey as k from orders)"]
    assert all(unique_by_plan(sql(q), ["k"]) for q in yes)
    assert not any(unique_by_plan(sql(q), ["k"]) for q in no)
    assert unique_by_plan(sql(no[1]), ["k", "l_linenumber"])


def test_the_guard_counts_only_what_may_repeat(tables):
    spark = tables
    P.register_events(spark, SF01)
    asm = assemble(spark, P.panel_queries(), P.window(spark))
    assert list(asm.uncertain()) == ["index"]
    text = asm.panel._jdf.queryExecution().executedPlan().toString()
    assert text.count("functions=[partial_max(rows") <= 1
    frames = {"index": spark.range(5).withColumnRenamed("id", "k"),
              "f": spark.createDataFrame([(1, 1), (1, 2)], "k long, x int")}
    with pytest.raises(Exception, match="not unique"):
        assemble_frames(frames).panel.count()
    grouped = {n: df.groupBy("k").agg(F.count("*").alias(f"n_{n}")) for n, df in frames.items()}
    safe = assemble_frames({"index": grouped["index"].select("k"), "f": grouped["f"]})
    assert safe.uncertain() == {} and safe.panel.count() == 5 and safe.duplicates().count() == 0


def test_stored_frames_are_never_broadcast(tables, tmp_path):
    """Files that compress well look small; with broadcasts allowed the plan must still be one of merge joins."""
    tables.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")  # the fixture sets it back
    got = assemble_bucketed(tables, QUERIES, {"q": 10}, buckets=4, store=FrameStore(tables, str(tmp_path / "frames"))).joined
    plan = _plan(got)
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= 2 and "Exchange" not in plan
