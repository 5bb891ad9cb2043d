"""Late rows by number: what the engine's own watermark has dropped, batch by batch."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass(frozen=True)
class BatchCount:
    batch: int
    rows_in: int
    rows_dropped: int
    watermark: str | None


@dataclass
class LateCounter(StreamingQueryListener):
    """Counts of all streams, or of those named ``query``. Register with ``spark.streams.addListener``.

    The engine drops rows where it keeps state: an aggregate there has them combined by its tasks already, so late rows of one
    window, key and task count as one. ``late`` and ``streaming.carried`` keep each late row instead.
    A batch that the engine runs without new rows, to close windows, counts with 0 rows in. A batch that is reported twice
    counts once. Events come a little after the batch: read ``dropped`` after the query has ended.
    """

    query: str | None = None
    batches: dict[tuple[str, int], BatchCount] = field(default_factory=dict)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.query is not None and progress.name != self.query:
            return
        dropped = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.batches[str(progress.id), progress.batchId] = BatchCount(
            progress.batchId, progress.numInputRows, dropped, progress.eventTime.get("watermark")
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    @property
    def dropped(self) -> int:
        return sum(b.rows_dropped for b in self.batches.values())

    def seen_by(self, query: StreamingQuery) -> list[BatchCount]:
        return sorted((b for (id, _), b in self.batches.items() if id == str(query.id)), key=lambda b: b.batch)
