"""Messages of the frame, detection and alert topics as columns; batch or stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: the wire form of a detection event and of an alert
EVENT = "sequence string, schema_version int, frame_index bigint, ts_frame_ms bigint, ts_infer_ms bigint, latency_ms double, model struct<name string, version string>, boxes array<struct<cls string, conf double, xywhn array<double>>>"
ALERT = "sequence string, schema_version int, rule string, cls string, window_s double, threshold double, observed double, n_frames bigint, frame_index bigint, ts_ms bigint"


def pack_frame(sequence: Column, frame_index: Column, ts_ms: Column) -> list[Column]:
    """key and headers of a frame message."""
    header = lambda name, c: F.struct(F.lit(name).alias("key"), F.encode(c.cast("string"), "utf-8").alias("value"))
    return [F.encode(sequence, "utf-8").alias("key"), F.array(header("frame_index", frame_index), header("ts_ms", ts_ms)).alias("headers")]


def parse_frames(messages: DataFrame) -> DataFrame:
    """``messages`` (key, headers, value) with sequence, frame_index, ts_ms and ok.

    Unknown headers are ignored, of one that repeats the last counts. An empty key, a missing, empty or unreadable header and a null value make
    a message not ok; it stays, so that it can be counted.
    """
    last = lambda name: F.element_at(F.filter("headers", lambda h: h["key"] == name), -1)["value"]
    some = F.size(F.filter("headers", lambda h: h["key"] == "frame_index")) > 0
    other = F.size(F.filter("headers", lambda h: h["key"] == "ts_ms")) > 0
    number = lambda name, there: F.when(there, F.decode(last(name), "utf-8").try_cast("bigint"))
    out = messages.withColumns({"sequence": F.when(F.length("key") > 0, F.decode("key", "utf-8")), "frame_index": number("frame_index", some), "ts_ms": number("ts_ms", other)})
    return out.withColumn("ok", F.expr("sequence is not null and frame_index is not null and ts_ms is not null and value is not null"))


def _parsed(messages: DataFrame, schema: str, needed: list[str], value: str) -> DataFrame:
    got = messages.withColumn("_m", F.from_json(F.col(value).cast("string"), schema))
    return got.withColumn("ok", F.expr(" and ".join(f"_m.{c} is not null" for c in needed))).select(*messages.columns, "ok", "_m.*")


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Detection events with ok; unknown fields are ignored, a missing or unreadable one makes the event not ok, and so does a box without class, conf or four numbers."""
    out = _parsed(messages, EVENT, ["sequence", "frame_index", "ts_frame_ms", "ts_infer_ms", "latency_ms", "model.name", "model.version", "boxes"], value)
    whole = F.forall("boxes", lambda b: b["cls"].isNotNull() & b["conf"].isNotNull() & (F.size(b["xywhn"]) == 4) & ~F.exists(b["xywhn"], lambda x: x.isNull()))
    return out.withColumn("ok", F.col("ok") & F.coalesce(whole, F.lit(False))).withColumn("schema_version", F.coalesce("schema_version", F.lit(1)))


def parse_alerts(messages: DataFrame, value: str = "value") -> DataFrame:
    return _parsed(messages, ALERT, ["sequence", "rule", "cls", "window_s", "threshold", "observed", "n_frames", "frame_index", "ts_ms"], value).withColumn("schema_version", F.coalesce("schema_version", F.lit(1)))


def to_value(rows: DataFrame, schema: str) -> Column:
    """The JSON value of a message with the fields of ``schema``, which ``rows`` has as columns."""
    names = [c.strip().split(" ")[0] for c in schema.replace("struct<name string, version string>", "s").replace("struct<cls string, conf double, xywhn array<double>>", "s").split(",")]
    return F.to_json(F.struct(*[n for n in names if n in rows.columns]))
