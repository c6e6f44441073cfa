"""J1-J5 and the table builder, on orders, lines and events of the test tables."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewright.operators.assemble import ColumnOverlapError, NotUniqueError, assemble
from tablewright.operators.model import DataModel, Field, ValidationError, table_check
from tablewright.plans.snapshot import SnapshotCache, fetch_data

from .conftest import SF001


class OrderTable(DataModel):
    orderkey = Field("bigint")
    n_lines = Field("bigint", nullable=True, ge=1)
    paid = Field("double", nullable=True)


QUERIES = {
    "index": "select o_orderkey as orderkey from a_orders where o_orderkey <= 400",
    "lines": "select l_orderkey as orderkey, count(*) as n_lines from a_lines group by l_orderkey",
    "price": "select o_orderkey as orderkey, cast(o_totalprice as double) as paid from a_orders where o_orderkey % 2 = 0",
}
NO_ROWS = "select o_orderkey as orderkey, cast(o_totalprice as double) as paid from a_orders where o_orderkey < 0"


@pytest.fixture(scope="module")
def shop(spark):
    for view, table in (("a_orders", "orders"), ("a_lines", "lineitem")):
        spark.read.parquet(f"{SF001}/{table}.parquet").createOrReplaceTempView(view)
    return spark


def _fetch(spark, queries, params, tmp_path, model=OrderTable):
    return fetch_data(spark, params, queries, data_model=model, cache=SnapshotCache(spark, str(tmp_path / "snap")))


def test_parameters_reach_every_query_and_unused_ones_are_dropped(shop, tmp_path):
    keys = tuple(r.o_orderkey for r in shop.sql("select o_orderkey from a_orders order by 1 limit 5").collect())
    queries = {
        "index": "select o_orderkey as orderkey from a_orders where o_orderkey in :wanted",
        "lines": "select l_orderkey as orderkey, count(*) as n_lines from a_lines where l_quantity > :least group by 1",
        "price": QUERIES["price"],
    }
    out = {r.orderkey: r.n_lines for r in _fetch(shop, queries, {"wanted": keys, "least": 10, "idle": "x"}, tmp_path).collect()}
    want = shop.table("a_lines").where("l_quantity > 10").groupBy("l_orderkey").count().collect()
    counts = {r.l_orderkey: r["count"] for r in want}
    assert out == {k: counts.get(k) for k in keys}


def test_every_index_row_stays_once(shop, tmp_path):
    out = _fetch(shop, QUERIES, {}, tmp_path).collect()
    index = [r.o_orderkey for r in shop.sql("select o_orderkey from a_orders where o_orderkey <= 400").collect()]
    assert sorted(r.orderkey for r in out) == sorted(index)
    assert {r.orderkey % 2 for r in out if r.paid is not None} <= {0}


def test_missing_index_raises(shop):
    with pytest.raises(KeyError, match="index"):
        assemble(shop, {k: v for k, v in QUERIES.items() if k != "index"})


TWICE = {
    "index": {**QUERIES, "index": f"{QUERIES['index']} union all {QUERIES['index']}"},
    "matched": {**QUERIES, "price": f"{QUERIES['price']} union all {QUERIES['price']}"},
    "unmatched": {**QUERIES, "price": f"{QUERIES['price']} union all values (-1L, 1D), (-1L, 2D)"},
}


@pytest.mark.parametrize("case", sorted(TWICE))
@pytest.mark.parametrize("action", ["collect", "count", "keys"])
def test_every_action_on_the_panel_raises_on_duplicate_keys(shop, case, action):
    panel = assemble(shop, TWICE[case]).panel
    with pytest.raises(PySparkException, match="not unique"):
        panel.select("orderkey").collect() if action == "keys" else getattr(panel, action)()


@pytest.mark.parametrize("case", sorted(TWICE))
def test_the_builder_names_the_query_with_duplicates(shop, tmp_path, case):
    with pytest.raises(NotUniqueError, match="index" if case == "index" else "price"):
        _fetch(shop, TWICE[case], {}, tmp_path)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("aqe", ["true", "false"])
def test_empty_frames_go_through_the_builder(shop, tmp_path, threshold, aqe):
    shop.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    shop.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        bare = {**QUERIES, "price": NO_ROWS}
        joined = assemble(shop, bare).panel
        assert joined.count() > 0 and joined.where("paid is not null").count() == 0
        lines_only = type("LinesOnly", (DataModel,), {"orderkey": Field("bigint"), "n_lines": Field("bigint", nullable=True)})
        assert _fetch(shop, bare, {}, tmp_path / "one", lines_only).count() == joined.count()
        with pytest.raises(ValidationError, match="at_least_one_value"):  # the check of a declared column
            _fetch(shop, bare, {}, tmp_path / "declared")
        none = {"index": f"{QUERIES['index']} and false"}
        for name, queries in (("index", {**QUERIES, **none}), ("all", {**QUERIES, **none, "price": NO_ROWS})):
            with pytest.raises(ValidationError, match="(?i)empty"):
                _fetch(shop, queries, {}, tmp_path / name)
    finally:
        shop.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        shop.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_table_check_that_cannot_be_observed(shop, tmp_path):
    class Checked(OrderTable):
        @table_check("several_orders")
        def several_orders(cls):
            return F.count_distinct("orderkey") > 1

    assert _fetch(shop, QUERIES, {}, tmp_path, Checked).count() > 1


def test_missing_column_and_wrong_type_are_reported(shop, tmp_path):
    with pytest.raises(ValidationError, match="not in dataframe"):
        _fetch(shop, {k: v for k, v in QUERIES.items() if k != "price"}, {}, tmp_path)

    class Strict(OrderTable):
        orderkey = Field("bigint", coerce=False)

    text = {k: v.replace("o_orderkey as", "cast(o_orderkey as string) as").replace("l_orderkey as", "cast(l_orderkey as string) as")
            .replace("group by l_orderkey", "group by 1") for k, v in QUERIES.items()}
    with pytest.raises(ValidationError, match="to have type"):
        _fetch(shop, text, {}, tmp_path, Strict)


def test_overlapping_columns_and_missing_identifiers_raise(shop):
    with pytest.raises(ColumnOverlapError, match="overlap"):
        assemble(shop, {**QUERIES, "again": QUERIES["price"]})
    with pytest.raises(KeyError, match="identifier"):
        assemble(shop, {**QUERIES, "bare": "select o_totalprice as other from a_orders"})


def test_column_order_is_identifiers_then_queries(shop):
    asm = assemble(shop, {"index": QUERIES["index"], "z": QUERIES["price"], "a": QUERIES["lines"]})
    assert asm.identifiers == ["orderkey"] and asm.panel.columns == ["orderkey", "paid", "n_lines"]


def _variant(**options):
    base = {"orderkey": Field("bigint"), "n_lines": Field("bigint", nullable=True), "paid": Field("double", nullable=True)}
    return type("Variant", (DataModel,), {**base, **options})


def test_snapshots_are_reused_and_rebuilt_when_anything_changes(shop, tmp_path):
    cache = SnapshotCache(shop, str(tmp_path / "snap"))
    source = str(tmp_path / "prices")
    shop.sql(QUERIES["price"]).coalesce(1).write.parquet(source)

    def build(model=None, queries=None):
        shop.read.parquet(source).createOrReplaceTempView("a_prices")
        queries = queries or {**QUERIES, "price": "select orderkey, paid from a_prices"}
        return fetch_data(shop, {}, queries, data_model=model or _variant(), cache=cache).inputFiles()[0].rsplit("/", 1)[0]

    first = build()
    assert build() == first

    def many(cls):
        return F.col("paid") > 0

    from tablewright.operators.model import row_check

    changed = [
        _variant(paid=Field("double", nullable=True, ge=0)),
        _variant(_strict=False),
        _variant(_pre_rename={"missing": "other"}),
        _variant(paid=Field("double", nullable=True, coerce=False)),
        _variant(positive=row_check("positive")(many)),
        _variant(positive=row_check("positive")(lambda cls: F.col("paid") > -1)),
    ]
    assert len({first, *map(build, changed)}) == len(changed) + 1
    shop.sql(QUERIES["price"]).withColumn("paid", F.col("paid") + 1).coalesce(1).write.mode("overwrite").parquet(source)
    rewritten = build()
    assert rewritten != first
    cache.clear()
    assert build() not in (first, rewritten)


def test_clear_frees_what_no_run_recorded(shop, tmp_path):
    from datetime import timedelta

    from tablewright.session import path_exists

    cache = SnapshotCache(shop, str(tmp_path / "snap"))
    paths = []
    for least in (100, 200, 300):
        queries = {**QUERIES, "index": f"select o_orderkey as orderkey from a_orders where o_orderkey <= {least}"}
        out = fetch_data(shop, {}, queries, data_model=OrderTable, cache=cache)
        paths.append(out.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://"))
    other = tmp_path / "snap" / "elsewhere"
    other.mkdir()
    half_written = cache.new_path("k")
    shop.range(1).write.parquet(half_written)
    assert cache.purge() == []  # all fresh
    assert sorted(cache.clear(recorded=[paths[1]])) == sorted([paths[0], paths[2]])
    assert path_exists(shop, paths[1]) and other.exists() and path_exists(shop, half_written)
    cache.ttl = timedelta(seconds=0)
    assert half_written in cache.purge(recorded=[paths[1]])


def test_views_over_memory_never_hit_a_snapshot_of_other_rows(shop, tmp_path):
    cache = SnapshotCache(shop, str(tmp_path / "snap"))
    queries = {**QUERIES, "price": "select orderkey, paid from a_memory"}
    for value in (5.0, 6.0):
        shop.createDataFrame([(1, value)], "orderkey bigint, paid double").createOrReplaceTempView("a_memory")
        out = fetch_data(shop, {}, queries, data_model=OrderTable, cache=cache)
        assert [r.paid for r in out.where("paid is not null").collect()] == [value]


def test_null_safe_join_matches_null_keys(spark):
    asm = assemble(spark, {
        "index": "SELECT * FROM VALUES (1), (CAST(NULL AS INT)) AS t(k)",
        "f": "SELECT * FROM VALUES (1, 'a'), (CAST(NULL AS INT), 'n') AS t(k, v)",
    }, null_safe=True)
    got = {r.k: r.v for r in asm.panel.collect()}
    assert got == {1: "a", None: "n"}
    plain = assemble(spark, {
        "index": "SELECT * FROM VALUES (1), (CAST(NULL AS INT)) AS t(k)",
        "f": "SELECT * FROM VALUES (1, 'a'), (CAST(NULL AS INT), 'n') AS t(k, v)",
    })
    assert {r.k: r.v for r in plain.panel.collect()} == {1: "a", None: None}


def test_order_by_in_a_feature_query_adds_no_sort_shuffle(spark):
    from tablewright.plans import panel as P
    from .conftest import SF001

    P.register_events(spark, SF001)
    queries = P.panel_queries()
    queries["target"] = queries["target"].rstrip() + "\norder by id, `date`"
    plan = assemble(spark, queries, P.window(spark)).panel._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_not_unique_message_lists_at_most_twenty_keys(spark):
    from .conftest import SF001

    spark.read.parquet(f"{SF001}/orders.parquet").createOrReplaceTempView("j2_orders")
    spark.read.parquet(f"{SF001}/lineitem.parquet").createOrReplaceTempView("j2_lines")
    asm = assemble(spark, {"index": "SELECT o_orderkey FROM j2_orders",
                           "lines": "SELECT l_orderkey AS o_orderkey, l_quantity FROM j2_lines"})
    with pytest.raises(NotUniqueError) as err:
        asm.check_one_to_one()
    message = str(err.value)
    assert "lines" in message and message.endswith("...") and message.count("('lines',") == 20
