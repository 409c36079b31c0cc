"""Aggregates of a user's own with partial aggregation and merging in levels; hashes of tables; counters of a job."""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from typing import Any, Protocol

import numpy as np
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Aggregate(Protocol):
    """What a user gives: ``add`` takes a pandas frame of one key's rows, ``extract`` gives the values of the result's columns.

    ``merge`` must not depend on order or grouping, then nor does the result on how the input is split.
    """

    def create(self) -> Any: ...
    def add(self, state: Any, rows: Any) -> Any: ...
    def merge(self, a: Any, b: Any) -> Any: ...
    def extract(self, state: Any) -> tuple: ...


def user_aggregate(rows: DataFrame, keys: Sequence[str], aggregate: Aggregate, schema: str, kept: int = 100_000, fan_in: int = 32) -> DataFrame:
    """``keys`` and the columns ``schema`` of ``aggregate`` over each key's rows.

    Each task adds its rows to one state a key before anything is shuffled (it passes on all states when it holds ``kept`` keys).
    States meet in two levels: about one in ``fan_in`` tasks' states at a time, then what is left of a key, so no task merges one
    state for each task of the input. Null keys are keys. An empty table gives no row.
    """
    keys = list(keys)
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def partial(batches):
        import pandas as pd
        from pyspark import TaskContext

        task, states = TaskContext.get().partitionId() // fan_in, {}

        def told():
            out = pd.DataFrame([(*k, task, pickle.dumps(s)) for k, s in states.items()], columns=[*keys, "_level", "_state"])
            states.clear()
            return out

        for batch in batches:
            for key, part in batch.groupby(keys, dropna=False, sort=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                states[key] = aggregate.add(states.get(key) if key in states else aggregate.create(), part)
            if len(states) >= kept:
                yield told()
        if states:
            yield told()

    def merged(frame):
        state = pickle.loads(frame["_state"].iloc[0])
        for more in frame["_state"].iloc[1:]:
            state = aggregate.merge(state, pickle.loads(more))
        return state

    def level(frame):
        return frame.iloc[:1].assign(_state=[pickle.dumps(merged(frame))])

    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def last(frame):
        return frame.iloc[:1][keys].assign(**{n: [v] for n, v in zip(names, aggregate.extract(merged(frame)), strict=True)})

    held = f"{kinds}, _level int, _state binary"
    states = rows.mapInPandas(partial, held).groupBy(*keys, "_level").applyInPandas(level, held)
    return states.groupBy(*keys).applyInPandas(last, f"{kinds}, {schema}")


class Quantiles:
    """Quantiles of positive numbers within a share ``error`` of the true value: counts of logarithmic buckets, which add up exactly.

    The q-quantile is that of the value of rank floor(q * (n - 1)). Nulls and numbers that aren't positive aren't counted. Gives n
    and each wanted quantile, null where there is no value. A state has a bucket for each factor of about 1 + 2 * ``error``
    between the least and the greatest value.
    """

    def __init__(self, value: str, wanted: Sequence[float], error: float = 0.01):
        self.value, self.wanted, self.base = value, list(wanted), (1 + error) / (1 - error)

    def create(self) -> dict[int, int]:
        return {}

    def add(self, state: dict[int, int], rows) -> dict[int, int]:
        v = rows[self.value].to_numpy(float)
        with np.errstate(invalid="ignore"):
            v = v[v > 0]
        buckets, n = np.unique(np.ceil(np.log(v) / np.log(self.base)).astype(int), return_counts=True)
        for b, k in zip(buckets.tolist(), n.tolist(), strict=True):
            state[b] = state.get(b, 0) + k
        return state

    def merge(self, a: dict[int, int], b: dict[int, int]) -> dict[int, int]:
        for k, n in b.items():
            a[k] = a.get(k, 0) + n
        return a

    def extract(self, state: dict[int, int]) -> tuple:
        if not state:
            return (0, *[None] * len(self.wanted))
        buckets = sorted(state)
        upto = np.cumsum([state[b] for b in buckets])
        n = int(upto[-1])
        at = [buckets[int(np.searchsorted(upto, int(q * (n - 1)), "right"))] for q in self.wanted]
        return (n, *[2 * self.base**b / (self.base + 1) for b in at])


def row_text(columns: Sequence[str]) -> Column:
    """A text that two rows share only if all their columns are equal: each value with its length, nulls marked."""
    told = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.concat_ws(",", *told)


def table_hash(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """n_rows and table_hash of ``rows``, for each group ``by``: equal for any order and partitions, different where a row is changed, left out or repeated.

    It is the sum of 60 bits of each row's SHA-256, twice, from different parts of it: repeated rows count as often as they come, which an
    exclusive or would cancel. Only sums are shuffled. Columns are taken in order of name. An empty table gives 0 rows and zeros.
    """
    columns = sorted(c for c in rows.columns if c not in by)
    digest = F.sha2(row_text(columns), 256)
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")
    total = lambda at: F.coalesce(F.sum(part(at)), F.lit(0).cast("decimal(38,0)")).cast("string")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", total(1), total(16)).alias("table_hash"))


def counted(rows: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """``rows`` and its counters, each how many rows hold a condition; they are taken in the pass that reads ``rows``, without another one.

    ``Observation.get`` gives them once an action on the first has ended; a stage that runs again counts anew, not twice.
    """
    seen = Observation()
    return rows.observe(seen, *[F.count_if(c).alias(n) for n, c in counters.items()]), seen


def copied_as_kept(counts: dict[str, int], kept: str = "kept", copied: str = "copied") -> list[str]:
    """A warning where not as many were copied as were kept."""
    return [] if counts[kept] == counts[copied] else [f"{counts[kept]} {kept}, but {counts[copied]} {copied}"]
