"""Progress of running queries as metric rows, for the backlog alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.streaming import StreamingQueryListener

MetricRow = tuple[str, str, str, float]


def metric_rows(timestamp: str, name: str | None, numbers: dict[str, float | None]) -> list[MetricRow]:
    """(ts, source, metric, value) rows; numbers Spark does not know yet are left out."""
    return [(timestamp, name or "", metric, float(n)) for metric, n in numbers.items() if n is not None and n == n]


class ProgressMetrics(StreamingQueryListener):
    """Hands each progress report to ``write`` as metric rows."""

    def __init__(self, write: Callable[[list[MetricRow]], None]) -> None:
        self.write = write

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        numbers = {
            "InputRows": p.numInputRows,
            "InputRowsPerSecond": p.inputRowsPerSecond,
            "ProcessedRowsPerSecond": p.processedRowsPerSecond,
            "BatchMs": p.durationMs.get("triggerExecution"),
            "StateRows": sum(s.numRowsTotal for s in p.stateOperators) if p.stateOperators else None,
            "LateRows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators) if p.stateOperators else None,
        }
        self.write(metric_rows(p.timestamp, p.name, numbers))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
