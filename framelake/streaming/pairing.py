"""Detection events beside the frames that they speak of, while those frames are still pending."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType

from framelake.streaming.stateful import STRETCH, use_rocksdb

HEAD = ["sequence", "frame_index", "arrival"]
COLUMNS = [*HEAD[1:], "is_event", "valued", "payload", "detail"]  # of a row; ``valued``: its own value, a frame's payload or an event's detail, isn't null
PACK_BYTES = 16 << 20  # of rows that become rows of packs at a time


def _filled(column: str, kind):
    """Numbers without nulls, of which pandas would make floats."""
    return F.coalesce(column, F.lit(0).cast(kind)) if isinstance(kind, NumericType | BooleanType) else F.col(column)


def _emptied(column: str, kind):
    """The value that ``_filled`` took; pandas hands on what is no number as null."""
    value = F.coalesce(column, F.lit(float("nan")).cast(kind)) if isinstance(kind, DoubleType | FloatType) else F.col(column)
    return F.when(F.col(f"has_{column}"), value).alias(column)


def _plain(value):
    return value.item() if hasattr(value, "item") else value


def _behind(held: list, column: np.ndarray) -> np.ndarray:
    """A column behind the values that are held; one that is null there is the type's own null, or 0 in a column of numbers."""
    out = np.empty(len(held) + len(column), object) if column.dtype == object else np.zeros(len(held) + len(column), column.dtype)
    for k, value in enumerate(held):
        if value is not None:
            out[k] = value
    out[len(held) :] = column
    return out


class PairProcessor(StatefulProcessor):
    """A sequence's pending frames, the latest ``cap`` of them by first arrival, and the events that find theirs among them.

    State: each pending frame with its place in the queue, and both ends of the queue. A batch reads the ``cap`` frames once, walks its rows over
    them in memory and writes those that changed. Places are used once, so the queue has no gaps. The walk sees indices only and notes which
    row goes with which; values are taken by these as whole columns.
    """

    def __init__(self, cap: int, payload: str, names: list[str]):
        self.cap, self.payload, self.names = cap, payload, names

    def init(self, handle) -> None:
        self.pending = handle.getMapState("pending", "frame bigint", f"place bigint, arrival bigint, payload {self.payload}")
        self.ends = handle.getValueState("ends", "oldest bigint, free bigint")

    def columns(self, rows: Iterable) -> dict[str, np.ndarray]:
        """The batch's columns, all rows of it; without a column ``valued`` every value counts."""
        import pandas as pd

        batch = pd.concat(list(rows))
        return {c: batch[c].to_numpy() if c in batch.columns else np.ones(len(batch), bool) for c in COLUMNS}

    def frame(self, index: int, row: int) -> None:
        """A frame that is pending already takes the new row's values and stays where it is; else it is the newest, and the oldest may go."""
        if (held := self.frames.get(index)) is not None:
            self.frames[index] = (held[0], row)
            return
        self.frames[index] = (self.free, row)
        self.places[self.free] = index
        self.free += 1
        if self.free - self.oldest > self.cap:
            del self.frames[self.places.pop(self.oldest)]
            self.oldest += 1

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803  names of the interface
        import pandas as pd

        self.oldest, self.free = self.ends.get() if self.ends.exists() else (0, 0)
        before = [(k[0], *v) for k, v in self.pending.iterator()] if self.free else []  # these are the rows before the batch's first
        n, batch = len(before), self.columns(rows)
        order = np.lexsort((batch["is_event"], batch["arrival"]))
        batch = {c: v[order] for c, v in batch.items()}
        arrival = _behind([h[2] for h in before], batch["arrival"])
        payload = _behind([h[3] for h in before], batch["payload"])
        valued = _behind([h[3] is not None for h in before], batch["valued"].astype(bool))
        self.frames = {index: (place, row) for row, (index, place, *_) in enumerate(before)}
        self.places = {place: index for index, place, *_ in before}
        for k in range(0, len(order), STRETCH):
            events, found = [], []
            for row, index, event in zip(range(k, len(order)), batch["frame_index"][k : k + STRETCH].tolist(), batch["is_event"][k : k + STRETCH].tolist(), strict=False):
                if not event:
                    self.frame(index, n + row)
                elif (held := self.frames.get(index)) is not None:  # it stays pending: an event that comes again pairs again
                    events.append(row)
                    found.append(held[1])
            if events:
                own = {"frame_index": batch["frame_index"][events], "arrival": batch["arrival"][events], "detail": batch["detail"][events], "has_detail": batch["valued"][events]}
                its = {"frame_arrival": arrival[found], "payload": payload[found], "has_payload": valued[found]}
                yield pd.DataFrame({"sequence": key[0], **own, **its})[self.names]
        for index, (place, row) in self.frames.items():
            if row >= n:
                self.pending.updateValue((index,), (place, int(arrival[row]), _plain(payload[row]) if valued[row] else None))
        for index, *_ in before:
            if index not in self.frames:
                self.pending.removeKey((index,))
        self.ends.update((self.oldest, self.free))

    def close(self) -> None:
        pass


class PackedPairProcessor(PairProcessor):
    """The same over rows in packs: each column of a row is an array."""

    def columns(self, rows):
        packs = list(rows)
        return {c: np.concatenate([array for pack in packs for array in pack[c]]) for c in COLUMNS}


def _packs(batches):
    """Rows of each Arrow batch as a row for each of its sequences, with its columns as arrays."""
    import pyarrow as pa

    for whole in batches:
        step = max(1, whole.num_rows * PACK_BYTES // max(whole.nbytes, 1))
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            codes = batch.column("sequence").dictionary_encode()
            places = codes.indices.to_numpy()
            order = pa.array(np.argsort(places, kind="stable"))
            ends = np.cumsum(np.bincount(places, minlength=len(codes.dictionary)))
            offsets = pa.array(np.concatenate([[0], ends]).astype("int32"))
            arrays = [pa.ListArray.from_arrays(offsets, batch.column(c).take(order)) for c in COLUMNS]
            yield pa.RecordBatch.from_arrays([codes.dictionary, *arrays], names=["sequence", *COLUMNS])


def pairs(frames: DataFrame, events: DataFrame, payload: str, detail: str, cap: int = 64, packed: bool = False) -> DataFrame:
    """Events of a stream with the frame that they belong to: sequence, frame_index, arrival, frame_arrival, payload, detail.

    Both inputs have sequence, frame_index and arrival (a number that grows over both). An event pairs with its frame when that came
    before it (or at the same time) and is among the last ``cap`` different frames of its sequence; an event without such a frame gives no row, one
    that comes again gives another. A frame that comes again while it is pending replaces its payload, not its place. Rows with a
    null sequence, index or arrival are skipped; payload and detail are numbers, text or bytes, null or not. Within a micro-batch rows go by arrival; the two sources are to be read in step.
    ``packed``: rows are packed by sequence before they are dealt, for large micro-batches, as a replay has them; a row by itself costs Spark's
    loop over a task's rows in Python many times what the walk over it does.
    """
    kinds = {"payload": frames.schema[payload].dataType, "detail": events.schema[detail].dataType}
    texts = {c: kind.simpleString() for c, kind in kinds.items()}
    one = frames.select(*HEAD, F.lit(False).alias("is_event"), F.col(payload).alias("payload"), F.lit(None).cast(kinds["detail"]).alias("detail"))
    two = events.select(*HEAD, F.lit(True).alias("is_event"), F.lit(None).cast(kinds["payload"]).alias("payload"), F.col(detail).alias("detail"))
    both = one.union(two).na.drop(subset=HEAD).withColumns({c: F.col(c).cast("bigint") for c in HEAD[1:]})
    valued = both.withColumn("valued", F.when(F.col("is_event"), F.col("detail").isNotNull()).otherwise(F.col("payload").isNotNull()))
    rows = valued.select("sequence", *COLUMNS[:-2], *[_filled(c, kind).alias(c) for c, kind in kinds.items()])
    key = both.schema["sequence"].dataType.simpleString()
    if packed:
        arrays = {c: f"array<{rows.schema[c].dataType.simpleString()}>" for c in COLUMNS}
        rows = rows.mapInArrow(_packs, ", ".join([f"sequence {key}", *[f"{c} {kind}" for c, kind in arrays.items()]]))
    schema = f"sequence {key}, frame_index bigint, arrival bigint, frame_arrival bigint, payload {texts['payload']}, detail {texts['detail']}, has_payload boolean, has_detail boolean"
    use_rocksdb(frames.sparkSession)
    names = [*HEAD, "frame_arrival", "payload", "detail", "has_payload", "has_detail"]
    processor = (PackedPairProcessor if packed else PairProcessor)(cap, texts["payload"], names)
    found = rows.groupBy("sequence").transformWithStateInPandas(processor, schema, "Append", "None")
    return found.select(*names[:4], *[_emptied(c, kind) for c, kind in kinds.items()])
