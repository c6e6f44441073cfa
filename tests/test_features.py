"""F1-F7, F17 (FIXTURES G) and the fitted column transforms."""

import pytest

from tablewright.functions.features import (
    Center,
    ColumnTransformer,
    ImputeConstant,
    OneHot,
    Toggles,
    build_columns,
    build_transformers,
    by_dtype,
    feature_list,
    select_by_dtype,
)


def test_build_columns_keeps_what_is_switched_on():
    assert build_columns(price=False, quantity=True, tax=False, discount=True) == ["quantity", "discount"]
    assert build_columns(index={7: False, 0: True, 4: True}) == [0, 4]
    assert build_columns(price=False) == build_columns() == []


def test_transformer_spec_needs_both_keys():
    with pytest.raises(KeyError, match="transformer"):
        build_transformers(a=dict(columns=["x"]))
    with pytest.raises(KeyError, match="columns"):
        build_transformers(a=dict(transformer="passthrough"))


def test_feature_list_overrides():
    assert feature_list({"a": True, "b": True, "c": True}, a=False) == ["b", "c"]
    with pytest.raises(KeyError):
        feature_list({"a": True}, z=False)


def test_toggles_resolve_against_a_schema(spark):
    schema = spark.createDataFrame([], "x int, y int, z int").schema
    assert Toggles.of({"z": True, "x": True, "y": False}).columns(schema) == ["z", "x"]
    assert Toggles.of({2: True, 0: True}).columns(schema) == ["z", "x"]
    assert Toggles.of({"x": True, "y": False}).switched(x=False, y=True).columns() == ["y"]
    with pytest.raises(KeyError):
        Toggles.of({"gone": True}).columns(schema)


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(
        [(1, 2.0, None, True, "x"), (2, None, 4.0, False, "y"), (3, 4.0, 5.0, None, None)],
        "id bigint, a double, b double, flag boolean, cat string")


def test_one_hot_refuses_a_null_it_was_not_fitted_on(frame):
    known = frame.where("cat IS NOT NULL")
    expressions = OneHot().fit(known, ["cat"])
    assert [n for _, n in expressions] == ["cat_x", "cat_y"]
    with pytest.raises(Exception, match="unknown categories in column cat: null"):
        frame.selectExpr(*[f"{e} AS `{n}`" for e, n in expressions]).collect()
    ignored = OneHot(handle_unknown="ignore").fit(known, ["cat"])
    rows = frame.orderBy("id").selectExpr(*[f"{e} AS `{n}`" for e, n in ignored]).collect()
    assert tuple(rows[2]) == (0.0, 0.0)


def test_select_by_dtype(frame):
    assert select_by_dtype(frame.schema, "number") == ["id", "a", "b"]
    assert select_by_dtype(frame.schema, "category") == ["cat"]


def test_impute_center_onehot_and_order(frame):
    imputed = ColumnTransformer(build_transformers(
        num=dict(transformer=ImputeConstant(0.0), columns=by_dtype("number"))),
        remainder="passthrough", carry=["id"]).fit_transform(frame)
    assert imputed.columns == ["id", "a", "b", "flag", "cat"]
    out = ColumnTransformer(build_transformers(
        c=dict(transformer=Center(), columns=["a", "b"]),
        o=dict(transformer=OneHot(), columns=["cat"])),
        remainder="passthrough", carry=["id"]).fit_transform(imputed)
    assert out.columns == ["id", "a", "b", "cat_x", "cat_y", "cat_nan", "flag"]
    rows = {r.id: r for r in out.collect()}
    assert rows[1].a == pytest.approx(2.0 - 2.0) and rows[2].a == pytest.approx(-2.0)
    assert rows[3].b == pytest.approx(5.0 - 3.0)
    assert (rows[1].cat_x, rows[1].cat_y, rows[3].cat_nan) == (1.0, 0.0, 1.0)


def test_unknown_level_raises_at_transform(spark, frame):
    step = ColumnTransformer(build_transformers(o=dict(transformer=OneHot(), columns=["cat"])),
                             remainder="drop", carry=["id"])
    statement = step.fit_statement(frame)
    other = spark.createDataFrame([(9, "zzz")], "id bigint, cat string")
    other.createOrReplaceTempView("__THIS__")
    with pytest.raises(Exception, match="unknown categories"):
        spark.sql(statement).collect()


def test_remainder_drop_and_positions(frame):
    out = ColumnTransformer(build_transformers(p=dict(transformer="passthrough", columns=[2, 1])),
                            remainder="drop").fit_transform(frame)
    assert out.columns == ["b", "a"]
