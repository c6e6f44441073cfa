"""A key holding a third of all rows: the panel still equals a brute-force computation."""

import pandas as pd
from pyspark.sql import functions as F

from tablewright.operators.assemble import assemble
from tablewright.plans import panel as P

from .conftest import SF001


def test_hot_user_panel_matches_brute_force(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    # every third event moves to user 0: one key now holds a third of the rows
    skewed = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    skewed.createOrReplaceTempView("events")
    try:
        panel = assemble(spark, P.panel_queries(), P.window(spark)).panel
        got = panel.toPandas()
    finally:
        P.register_events(spark, SF001)

    ev = skewed.toPandas()
    ev["date"] = ev["ts"].dt.date
    days = pd.date_range(ev["date"].min(), ev["date"].max()).date
    index = pd.MultiIndex.from_product([sorted(ev["user_id"].unique()), days], names=["id", "date"])
    g = ev.groupby(["user_id", "date"])
    feats = pd.DataFrame({
        "spend": g.apply(lambda x: round(x.loc[x.event_type == "purchase", "value"].sum(), 2)
                         if (x.event_type == "purchase").any() else None, include_groups=False),
        "clicks": g.apply(lambda x: int((x.event_type == "click").sum()), include_groups=False),
        "err": g.apply(lambda x: True if (x.event_type == "error").any() else None, include_groups=False),
        "top_type": g.apply(lambda x: x.sort_values(["value", "event_id"]).iloc[-1].event_type,
                            include_groups=False),
        "target": g.apply(lambda x: int((x.event_type != "signup").sum()), include_groups=False),
    })
    feats.index.names = ["id", "date"]
    want = pd.DataFrame(index=index).join(feats).reset_index()

    assert len(got) == len(want) == len(index)
    key = ["id", "date"]
    got = got.sort_values(key).reset_index(drop=True)
    want = want.sort_values(key).reset_index(drop=True)
    assert (got["id"].values == want["id"].values).all()
    for col in ("clicks", "target"):
        assert got[col].fillna(-1).astype(int).tolist() == want[col].fillna(-1).astype(int).tolist()
    assert got["top_type"].fillna("").tolist() == want["top_type"].fillna("").tolist()
    assert got["err"].map(lambda v: v is True).tolist() == want["err"].map(lambda v: v is True).tolist()
    gs = got["spend"].tolist()
    ws = want["spend"].tolist()
    assert all((pd.isna(a) and pd.isna(b)) or abs(a - b) < 1e-9 for a, b in zip(gs, ws))
    hot = got[got["id"] == 0]
    assert len(hot) == len(days) and hot["target"].sum() > len(ev) // 4
