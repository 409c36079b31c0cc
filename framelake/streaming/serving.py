"""Frame messages to detection events: a user's detector over the bytes of each frame, with poison frames set apart."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import geometry as G
from framelake.sources import messages as M
from framelake.streaming.counters import watched

#: what a detector finds in a frame, in the frame's pixels
FOUND = "array<struct<x1 double, y1 double, x2 double, y2 double, conf double, cls int>>"
COUNTERS = "scored"


def _each(infer: Callable):
    """Rows of one batch with what ``infer`` finds in their bytes, its time and its fault."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for payload, fault in zip(batch["value"], batch["error"], strict=True):
                if fault is not None:
                    rows.append((None, None, None, None, None, fault))
                    continue
                began = time.perf_counter()
                try:
                    width, height, found = infer(bytes(payload))
                    took = (time.perf_counter() - began) * 1000
                    boxes = [dict(zip(("x1", "y1", "x2", "y2", "conf"), map(float, f[:5])), cls=int(f[5])) for f in found]
                    rows.append((int(width), int(height), boxes, took, time.time_ns() // 1_000_000, None))
                except Exception as e:  # noqa: BLE001  whatever a detector raises for a frame is told in that frame's row
                    rows.append((None, None, None, None, None, f"{type(e).__name__}: {e}"))
            made = pd.DataFrame(rows, columns=["width", "height", "found", "latency_ms", "ts_infer_ms", "error"], dtype=object)
            yield pd.concat([batch.drop(columns=["value", "error"]).reset_index(drop=True), made], axis=1)

    return run


def score(messages: DataFrame, infer: Callable, model: tuple[str, str], names: dict[int, str]) -> DataFrame:
    """A row for each frame message (key, headers, value), batch or stream alike: the fields of its detection event, and ``error``, null where all is well.

    ``infer(bytes)`` gives width, height and rows (x1, y1, x2, y2, conf, class) in pixels. ``latency_ms`` is the time of that call
    alone, ``ts_infer_ms`` the clock after it; ``model`` is (name, version) of what scored the frame. Boxes come out in
    the wire's form: class by name (its number where ``names`` has none) and centre and size as shares of the frame.
    A frame that can't be scored is poison: its message lacks key, a readable header or a value, or ``infer`` raises; it has
    nulls and its fault in ``error``, and doesn't stop the others. Empty bytes are the detector's to judge. Rows stay in the order of
    their partition, so those of a topic's partition keep theirs. Counts of each micro-batch are the observation ``COUNTERS``: consumed,
    events, skipped. An empty table gives none.
    """
    ok = M.parse_frames(messages).select("sequence", "frame_index", F.col("ts_ms").alias("ts_frame_ms"), "value", F.when(~F.col("ok"), "unreadable message").alias("error"))
    schema = f"sequence string, frame_index bigint, ts_frame_ms bigint, width int, height int, found {FOUND}, latency_ms double, ts_infer_ms bigint, error string"
    # whole numbers with nulls would come as floats, so that large ones lose digits; they go as text
    held = ok.withColumns({c: F.col(c).cast("string") for c in ("frame_index", "ts_frame_ms")})
    text = schema.replace("frame_index bigint", "frame_index string").replace("ts_frame_ms bigint", "ts_frame_ms string")
    rows = held.mapInPandas(_each(infer), text).withColumns({c: F.col(c).cast("bigint") for c in ("frame_index", "ts_frame_ms")})
    named = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else None

    def wire(b):
        name = b["cls"].cast("string")
        return F.struct((F.coalesce(named[b["cls"]], name) if names else name).alias("cls"), b["conf"].alias("conf"), G.wire_form(b, F.col("width"), F.col("height")).alias("xywhn"))

    known = F.struct(F.lit(model[0]).alias("name"), F.lit(model[1]).alias("version"))
    out = rows.select(
        "sequence", F.lit(1).alias("schema_version"), "frame_index", "ts_frame_ms", "ts_infer_ms", "latency_ms", F.when(F.col("error").isNull(), known).alias("model"), F.transform("found", wire).alias("boxes"), "error")
    fine = F.col("error").isNull()
    return watched(out, COUNTERS, consumed=F.lit(True), events=fine, skipped=~fine)


def events(scored: DataFrame) -> DataFrame:
    """(key, value) of the detection events of ``score``: the sequence as key, JSON as value."""
    fine = scored.where("error is null").drop("error")
    return fine.select(F.encode("sequence", "utf-8").alias("key"), M.to_value(fine, M.EVENT).alias("value"))
