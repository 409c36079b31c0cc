"""Order-dependent operators with an explicit order, and global order without a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.sources.scratch import cut

_PLACE = 33  # bits of a row's place in its partition, as monotonically_increasing_id has them


def _placed(rows: DataFrame, order: Sequence) -> DataFrame:
    """``rows`` with ``_part`` and ``_k``: dealt by range over all of ``order``, sorted, and the place in the range.

    Rows that agree in part of the order are parted by the rest of it. The table is written, since a range
    partitioning that is computed anew may cut elsewhere.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = cut(ids, "placed")
    return placed.withColumns({"_part": F.shiftright("_id", _PLACE), "_k": F.col("_id").bitwiseAND((1 << _PLACE) - 1)}).drop("_id")


def _before(f, value: str):
    """Aggregate of the ranges before; a row for each range."""
    return f(value).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))


def global_rank(rows: DataFrame, order: Sequence) -> DataFrame:
    """``rank`` 1, 2, .. over all rows by ``order``.

    Each range is ranked by itself and shifted by the counts before it, so no task sees all rows.
    """
    placed = _placed(rows, order)
    shift = placed.groupBy("_part").count().select("_part", F.coalesce(_before(F.sum, "count"), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(shift), "_part").withColumn("rank", F.col("_k") + F.col("_before") + 1).drop("_part", "_k", "_before")


def running_max(rows: DataFrame, order: Sequence, value: str, name: str, last: int = 0) -> DataFrame:
    """``name``: highest ``value`` so far over all rows by ``order``, ranges first as in ``global_rank``; nulls are passed over, and with ``last`` -1 so is the row itself."""
    placed = _placed(rows, order)
    tops = placed.groupBy("_part").agg(F.max(value).alias("_top")).select("_part", _before(F.max, "_top").alias("_before"))
    inside = F.max(value).over(Window.partitionBy("_part").orderBy("_k").rowsBetween(Window.unboundedPreceding, last))
    return placed.withColumn("_m", inside).join(F.broadcast(tops), "_part").withColumn(name, F.greatest("_m", "_before")).drop("_part", "_k", "_m", "_before")


def segmented_scan(rows: DataFrame, keys: Sequence[str], order: Sequence[str], **columns: tuple[str, Column | str]) -> DataFrame:
    """``rows`` with running values within each key, by ``order``; ``columns`` are name=(operation, column).

    Operations take the rows of the key up to and with this one: ``sum``, ``max`` and ``last`` (the last value that isn't null; null
    where there is none), ``run`` (how many rows in a row, ending here, the condition holds). ``lag`` is the value of the
    row before, ``before`` the last value that isn't null of all rows before, ``max_before`` the highest of these. Rows that agree in key and order are in any order.

    Rows are dealt by range over key and order, so a key that holds most rows is split. Each range is scanned by itself; of each
    key in it one row of partial results goes on, and what a key brings from the ranges before is an associative combination of
    these. Only the first key of a range can have begun earlier, so there is at most one such value a range.
    """
    keys = list(keys)
    put = {f"_v{i}": F.col(c) if isinstance(c, str) else c for i, (_, c) in enumerate(columns.values())}
    placed = _placed(rows.withColumns(put), [*keys, *order])
    inside = Window.partitionBy("_part", *keys).orderBy("_k")
    upto, all_before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # rows are ranges
    here, partial, carried, joined = {"_n": F.row_number().over(inside)}, [F.count(F.lit(1)).alias("_rows")], {}, {}
    for i, (name, (op, _)) in enumerate(columns.items()):
        v, p, c = F.col(f"_v{i}"), f"_p{i}", f"_c{i}"
        if op in ("sum", "max", "max_before"):
            f = F.sum if op == "sum" else F.max
            here[f"_h{i}"] = f(v).over(all_before if op == "max_before" else upto)
            partial.append(f(v).alias(p))
            carried[c] = f(p).over(parts)
            joined[name] = F.coalesce(F.col(f"_h{i}") + F.col(c), f"_h{i}", c) if op == "sum" else F.greatest(f"_h{i}", c)
        elif op in ("last", "before"):
            here[f"_h{i}"] = F.last(v, True).over(upto if op == "last" else all_before)
            partial.append(F.max_by(v, F.when(v.isNotNull(), F.col("_k"))).alias(p))
            carried[c] = F.last(p, True).over(parts)
            joined[name] = F.coalesce(f"_h{i}", c)
        elif op == "lag":
            here[f"_h{i}"] = F.lag(v).over(inside)
            partial.append(F.max_by(F.struct(v.alias("v")), "_k").alias(p))
            carried[c] = F.last(p).over(parts)
            joined[name] = F.when(F.col("_n") > 1, F.col(f"_h{i}")).otherwise(F.col(f"{c}.v"))
        elif op == "run":
            broken = F.when(~F.coalesce(v, F.lit(False)), F.col("_k"))
            here[f"_h{i}"] = F.struct(F.max(broken).over(upto).alias("at"), F.min("_k").over(Window.partitionBy("_part", *keys)).alias("first"))
            # rows after the last break, and whether there is one
            partial.append(F.struct(F.coalesce(F.max("_k") - F.max(broken), F.count(F.lit(1))).alias("tail"), F.max(broken).isNotNull().alias("broken")).alias(p))
            rows_before = F.coalesce(F.sum("_rows").over(parts), F.lit(0))
            carried[f"{c}b"] = rows_before
            carried[f"{c}s"] = F.when(F.col(f"{p}.broken"), rows_before + F.col("_rows") - F.col(f"{p}.tail"))  # where its tail begins
            carried[c] = F.col(f"{c}b") - F.coalesce(F.last(f"{c}s", True).over(parts), F.lit(0))
            joined[name] = F.when(F.col(f"_h{i}.at").isNotNull(), F.col("_k") - F.col(f"_h{i}.at")).otherwise(F.col("_k") - F.col(f"_h{i}.first") + 1 + F.coalesce(c, F.lit(0).cast("long")))
        else:
            raise ValueError(f"unknown operation {op}")
    carry = placed.groupBy("_part", *keys).agg(*partial)
    for c, e in carried.items():
        carry = carry.withColumn(c, e)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("_part")) > 1
    names = [c for c in carried if c[-1].isdigit()]
    carry = carry.withColumn("_late", first).where("_late").select(F.col("_part").alias("_of"), *[F.col(k).alias(f"_k_{k}") for k in keys], *names)
    meets = F.col("_part") == F.col("_of")
    for k in keys:
        meets &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = placed.withColumns(here).join(F.broadcast(carry), meets, "left")  # a row for each range at most
    return out.select(*rows.columns, *[e.alias(n) for n, e in joined.items()])


def percentiles(rows: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """``keys`` with n, mean and a column for each share in ``wanted``, linear between the two rows around it.

    Nulls aren't counted. Rows are ranked over (keys, value) by range, so a key that holds most rows is split; of the ranked rows only
    the two around each share are joined.
    """
    keys = list(keys)
    ranked = global_rank(rows.where(F.col(value).isNotNull()).select(*keys, value), [*keys, value])
    group = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.min("rank").alias("_first"))
    at = group.select(*keys, "n", "_first", F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(float(q)).alias("q")) for c, q in wanted.items()])).alias("_q"))
    at = at.withColumn("_at", (F.col("n") - 1) * F.col("_q.q"))
    ends = at.select(*keys, F.col("_q.c").alias("_c"), F.expr("_at - floor(_at)").alias("_share"), F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))).alias("_place"), "_first")
    ends = ends.withColumn("rank", F.col("_first") + F.col("_place"))
    near = ranked.select("rank", F.col(value).alias("_v")).join(ends, "rank")  # a rank is one row over all keys
    flat = near.groupBy(*keys).pivot("_c", list(wanted)).agg(F.min_by("_v", "_place") + (F.max_by("_v", "_place") - F.min_by("_v", "_place")) * F.max("_share"))
    left = group.drop("_first").alias("g")
    return left.join(flat.alias("f"), [F.col(f"g.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]).select("g.*", *[f"f.{c}" for c in wanted])


def latest(rows: DataFrame, keys: list[str], *arrival: str) -> DataFrame:
    """The last row of each key by ``arrival``, nulls before all else; which of several last ones isn't defined.

    One row of a key leaves each task, so a key that comes again and again isn't gathered. An empty table gives none.
    """
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*arrival)).alias("_last"))
    return last.select(*keys, "_last.*").select(*rows.columns)


def top_k(rows: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= k).drop("_k")


def next_step(records: DataFrame, history: DataFrame, key: str, step: str = "step") -> DataFrame:
    """``key`` of each record with next_step: the highest step of its history and one, 0 where it has none."""
    last = history.groupBy(key).agg(F.max(step).alias("_last"))
    return records.select(key).join(last, key, "left").select(key, (F.coalesce("_last", F.lit(-1)) + 1).cast("long").alias("next_step"))


def sliding_mean(events: DataFrame, key: str, ts: str, value: str, window_ms: int) -> DataFrame:
    """``events`` with mean and n_frames of ``value`` over the key's rows of the last ``window_ms``, both ends in; ``ts`` and ``value`` are whole numbers.

    Each time's sum comes in at the time and goes out when the window has passed it, and a scan adds them up: the work doesn't grow with
    the rows of a window, and no task holds a key. ``events`` is read twice.
    """
    kind = events.schema[value].dataType
    if not isinstance(kind, T.IntegralType | T.DecimalType):
        raise ValueError(f"{value} must be whole numbers or decimals, whose sums are exact, not {kind.simpleString()}")
    at = events.groupBy(F.col(key).alias("_key"), F.col(ts).alias("_at")).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    out = F.coalesce(F.col("_at") + window_ms + 1, F.lit(-(1 << 63)))  # rows without a time are each other's window, before all others
    ends = F.array(F.struct(F.col("_at").cast("bigint").alias("_at"), "_s", "_n", F.lit(True).alias("_own")), F.struct(out.alias("_at"), (-F.col("_s")).alias("_s"), (-F.col("_n")).alias("_n"), F.lit(False).alias("_own")))
    net = at.select("_key", F.explode(ends).alias("_e")).select("_key", "_e.*").groupBy("_key", "_at").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"), F.bool_or("_own").alias("_own"))
    summed = segmented_scan(net, ["_key"], ["_at"], _total=("sum", "_s"), n_frames=("sum", "_n")).where("_own")
    summed = summed.select("_key", "_at", F.when(F.col("n_frames") > 0, F.col("_total").cast("double") / F.col("n_frames")).alias("mean"), "n_frames")
    meets = F.col(key).eqNullSafe(F.col("_key")) & F.col(ts).eqNullSafe(F.col("_at"))
    return events.join(summed, meets).select(*events.columns, "mean", "n_frames")


def fire_once(read: DataFrame, key: str, arrival: str, threshold: float, ts: str | None = None, clock: str | None = None, window_ms: int = 0) -> DataFrame:
    """alert where the mean crosses and the key's last reading didn't.

    With ``clock``, the highest ``ts`` of all keys before the row, a reading counts no more once all of its key's rows are older than ``window_ms``.
    """
    marked = read.withColumn("crossed", F.col("mean") > threshold)
    more = {"_newest": ("max_before", ts)} if clock else {}
    seen = segmented_scan(marked, [key], [arrival], _before=("lag", "crossed"), **more)
    before = F.coalesce("_before", F.lit(False))
    if clock:
        before = before & F.coalesce(F.col(clock) - window_ms <= F.col("_newest"), F.lit(False))
    return seen.withColumn("alert", F.col("crossed") & ~before).drop("_before", "_newest")


def index_gaps(rows: DataFrame, key: str, arrival: str, index: str) -> DataFrame:
    """gap: how many numbers lie between the index of the key's row before and this one's, 0 where none do."""
    before = segmented_scan(rows, [key], [arrival], _before=("lag", index))
    return before.withColumn("gap", F.greatest(F.coalesce(F.col(index) - F.col("_before") - 1, F.lit(0)), F.lit(0))).drop("_before")


def sessions(rows: DataFrame, arrival: str, key: str) -> DataFrame:
    """session: 1, 2, .. over all rows by arrival; another one starts where the key isn't that of the row before."""
    named = segmented_scan(rows, [], [arrival], _before=("lag", F.struct(F.col(key).alias("k"))))
    begins = F.when(F.col("_before").isNull() | ~F.col("_before.k").eqNullSafe(F.col(key)), 1).otherwise(0)
    return segmented_scan(named, [], [arrival], session=("sum", begins)).drop("_before")


def damage_drop(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Rows kept when a corrupt row or a jump of pts over duration drops all up to the next key row."""
    before = segmented_scan(rows, [key], [order], _pts=("lag", "pts"))
    jump = F.coalesce(F.col("pts") - F.col("_pts") > F.col("duration"), F.lit(False))
    bad = F.col("corrupt") | (jump & ~F.col("is_key"))
    out = segmented_scan(before, [key], [order], _damage=("max", F.when(bad, F.col(order))), _reset=("max", F.when(F.col("is_key") & ~F.col("corrupt"), F.col(order))))
    return out.where("_damage is null or _reset > _damage or (_reset = _damage and not corrupt)").drop("_pts", "_damage", "_reset")


def live_readings(events: DataFrame, window_ms: int) -> DataFrame:
    """arrival, sequence, frame_index, mean, n_frames and quiet of each event (arrival, sequence, frame_index, ts_ms, n) that finds live frames.

    A row counts from its arrival until the same frame of its sequence comes again or the clock, the highest ts_ms so far of all
    sequences, is more than ``window_ms`` past it; a row that comes too late never counts. mean is that of n over the sequence's rows
    that count at the arrival, its own included. quiet says whether at some arrival since the sequence's last such reading none
    of its rows counted. Arrivals are unique; rows with a null are passed over. An empty table gives no row.

    Each row's time is an interval of arrivals: its end by the clock is found by a scan over rows and clock readings in
    order of time, and its two ends are summed over the sequence by another one. So late, repeated and unordered rows need no state
    and no task holds a sequence.
    """
    columns = ["arrival", "sequence", "frame_index", "ts_ms", "n"]
    given = events.select(*columns).na.drop()
    again = F.lead("arrival").over(Window.partitionBy("sequence", "frame_index").orderBy("arrival"))  # rows of one frame
    clocked = cut(segmented_scan(given.withColumn("again", again), [], ["arrival"], clock=("max", "ts_ms")), "clocked")
    live = clocked.where(F.col("ts_ms") >= F.col("clock") - window_ms)
    # the first arrival whose clock is beyond ts + window: the last one seen when time goes backwards, asked before what happens at that time
    ask = live.select((-(F.col("ts_ms") + window_ms)).alias("_t"), F.lit(0).alias("_what"), "arrival", "sequence", "n", "again", F.lit(None).cast(clocked.schema["arrival"].dataType).alias("_ring"))
    ring = clocked.groupBy("clock").agg(F.min("arrival").alias("_ring"))
    ring = ring.select((-F.col("clock")).alias("_t"), F.lit(1).alias("_what"), *[F.lit(None).cast(clocked.schema[c].dataType).alias(c) for c in ("arrival", "sequence", "n", "again")], "_ring")
    told = segmented_scan(ask.unionByName(ring), [], ["_t", "_what"], _late=("last", "_ring")).where("_what = 0")
    ends = F.least("again", "_late")
    steps = told.select("sequence", F.explode(F.array(F.struct(F.col("arrival").alias("step"), F.col("n").alias("n"), F.lit(1).alias("k")), F.struct(ends.alias("step"), (-F.col("n")).alias("n"), F.lit(-1).alias("k")))).alias("d")).select("sequence", "d.*").where("step is not null")
    own = clocked.select("sequence", F.col("arrival").alias("step"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("k"), "frame_index")
    net = steps.withColumn("frame_index", F.lit(None).cast(clocked.schema["frame_index"].dataType)).unionByName(own)
    net = net.groupBy("sequence", "step").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max("frame_index").alias("frame_index"))
    summed = segmented_scan(net, ["sequence"], ["step"], total=("sum", "n"), n_frames=("sum", "k"))
    reads = F.col("frame_index").isNotNull() & (F.col("n_frames") > 0)
    mark = F.when(F.col("n_frames") == 0, F.lit(True)).when(reads, F.lit(False))
    out = segmented_scan(summed, ["sequence"], ["step"], quiet=("before", mark)).where(reads)
    return out.select(F.col("step").alias("arrival"), "sequence", "frame_index", (F.col("total") / F.col("n_frames")).alias("mean"), "n_frames", F.coalesce("quiet", F.lit(True)).alias("quiet"))


def alerts(events: DataFrame, window_ms: int, threshold: float) -> DataFrame:
    """The ``live_readings`` whose mean is above the threshold where the sequence's last reading wasn't, or lies before a quiet time."""
    read = live_readings(events, window_ms).withColumn("_crossed", F.col("mean") > threshold)
    known = segmented_scan(read, ["sequence"], ["arrival"], _was=("lag", "_crossed"))
    return known.where(F.col("_crossed") & (F.col("quiet") | ~F.coalesce("_was", F.lit(False)))).drop("_crossed", "_was", "quiet")
