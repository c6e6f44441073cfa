"""Row-level checks applied to a file stream of the events table."""

from tablewright.operators.model import DataModel, Field
from tablewright.streaming.checks import split_stream, tag_failures

from .conftest import SF001


class EventsPositive(DataModel):
    event_id = Field("bigint")
    event_type = Field("category", levels=("click", "error", "purchase", "signup", "view"))
    value = Field("double", ge=0, lt=100)


def test_stream_is_split_into_accepted_and_quarantined(spark, tmp_path):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
              .parquet(SF001))
    q = split_stream(stream, EventsPositive, accepted_path=str(tmp_path / "ok"),
                     quarantine_path=str(tmp_path / "bad"), checkpoint_path=str(tmp_path / "cp"),
                     trigger_once=True)
    q.awaitTermination(120)
    ok = spark.read.parquet(str(tmp_path / "ok"))
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert ok.count() + bad.count() == events.count()
    assert bad.count() == events.where("value >= 100").count()
    assert {tuple(r.failed_checks) for r in bad.select("failed_checks").distinct().collect()} == {
        ("less_than(100)",)}
    assert set(tag_failures(events, EventsPositive).columns) == {"event_id", "event_type", "value",
                                                                "failed_checks"}
