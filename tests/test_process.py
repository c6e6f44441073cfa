"""P1-P2 (FIXTURES F)."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators.model import DataModel, Field, ValidationError
from tablewright.operators.process import process_data


class DataModelDummy(DataModel):
    col1 = Field("string")
    target = Field("bigint")


def test_validation_error_without_feature(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "target bigint")
    with pytest.raises(ValidationError):
        process_data(df, "target", data_model=DataModelDummy)


def test_splits_features_and_target(spark):
    df = spark.createDataFrame([(5, "3"), (6, "2"), (7, "1")], "target bigint, col1 string")
    X, y = process_data(df, "target", data_model=DataModelDummy)
    assert X.columns == ["col1"] and y.columns == ["target"]
    assert sorted(r.col1 for r in X.collect()) == ["1", "2", "3"]
    assert sorted(r.target for r in y.collect()) == [5, 6, 7]


def test_filters_only_drop_rows(spark):
    df = spark.createDataFrame([(5, "3"), (None, "2"), (7, "1")], "target bigint, col1 string")

    class Nullable(DataModel):
        col1 = Field("string")
        target = Field("bigint", nullable=True)

    X, _ = process_data(df, "target", data_model=Nullable, filters=[F.col("target").isNotNull()])
    assert X.count() == 2
