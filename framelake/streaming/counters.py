"""Counters of a stream: conditions counted in the pass that reads each micro-batch, added up over batches that may run again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from framelake.sources.scratch import new_path


def watched(stream: DataFrame, name: str, **counters: Column) -> DataFrame:
    """``stream`` with an observation ``name``: of each micro-batch, how many rows hold each condition."""
    return stream.observe(name, *[F.count_if(c).alias(n) for n, c in counters.items()])


class BatchCounters(StreamingQueryListener):
    """Sums of the observation ``name`` over the micro-batches of each query.

    Batches are told by their number. The last one may be reported again, when a query starts anew before it was committed: its new
    counts replace the old ones, so no row counts twice. Of each query two lines of counts are kept, however long it runs. To
    follow queries as they run, add it by ``spark.streams.addListener``; ``follow`` reads one query's own reports instead.
    """

    def __init__(self, name: str):
        self.name = name
        self._sums: dict[str, dict[str, int]] = {}  # of batches before the last
        self._last: dict[str, tuple[int, dict[str, int]]] = {}

    def take(self, query: str, batch: int, counts: dict[str, int]) -> None:
        number, held = self._last.get(query, (-1, {}))
        if batch < number:  # an old report
            return
        if batch > number:
            sums = self._sums.setdefault(query, {})
            for k, n in held.items():
                sums[k] = sums.get(k, 0) + n
        self._last[query] = batch, dict(counts)

    def onQueryStarted(self, event) -> None:  # noqa: N802  names of the interface
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self._report(event.progress)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def _report(self, progress) -> None:
        seen = progress.observedMetrics.get(self.name)
        if seen is not None and progress.numInputRows:  # a batch without input only moves time on
            self.take(str(progress.id), progress.batchId, seen.asDict())

    def totals(self, query: str | None = None) -> dict[str, int]:
        """Sums of one query, or of all."""
        out: dict[str, int] = {}
        for q, (_, last) in self._last.items():
            if query in (None, q):
                for part in (self._sums.get(q, {}), last):
                    for k, n in part.items():
                        out[k] = out.get(k, 0) + n
        return out

    def follow(self, job: StreamingQuery, every_s: float = 1.0) -> dict[str, int]:
        """Waits for a query that ends by itself and gives its totals; Spark keeps a hundred reports, so they are read while it runs."""
        ended = False
        while not ended:
            ended = bool(job.awaitTermination(every_s))
            for progress in job.recentProgress:
                self._report(progress)
        return self.totals(str(job.id))


def drain_counted(stream: DataFrame, name: str, metric: str) -> tuple[DataFrame, dict[str, int]]:
    """All that ``stream`` gives for what its source holds now, written once and read back, and the totals of its observation ``metric``.

    A stream without rows has no totals.
    """
    path = new_path(stream.sparkSession, name)
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    job = writer.option("checkpointLocation", new_path(stream.sparkSession, f"{name}-state")).start(path)
    totals = BatchCounters(metric).follow(job)
    return stream.sparkSession.read.schema(stream.schema).parquet(path), totals
