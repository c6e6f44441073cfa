"""J1/J2 against pandas on random keyed frames (hypothesis)."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from tablewright.operators.assemble import NotUniqueError, assemble_frames

keys = st.lists(st.integers(min_value=0, max_value=6), min_size=1, max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(index=keys, feature=keys)
def test_left_join_matches_pandas(spark, index, feature):
    idx = pd.DataFrame({"k": index})
    feat = pd.DataFrame({"k": feature, "v": [f"v{i}" for i in range(len(feature))]})
    frames = {
        "index": spark.createDataFrame(idx, "k long"),
        "f": spark.createDataFrame(feat, "k long, v string"),
    }
    asm = assemble_frames(frames)
    try:
        expected = idx.set_index("k").join([feat.set_index("k")], validate="1:1").reset_index()
    except Exception:
        expected = None
    if expected is None:
        with pytest.raises(NotUniqueError):
            asm.check_one_to_one()
        with pytest.raises(PySparkException, match="not unique"):
            asm.panel.collect()
        return
    asm.check_one_to_one()
    rows = asm.panel.collect()
    got = sorted((r.k, r.v) for r in rows)
    want = sorted((int(k), None if pd.isna(v) else v) for k, v in zip(expected.k, expected.v))
    assert got == want
