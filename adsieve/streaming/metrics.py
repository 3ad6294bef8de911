"""Live pipeline counters for the stream: ``observe()`` on the routed rows
and a listener that keeps each micro-batch's values (no driver-side scan of
the data; the counters are aggregated inside the batch's own tasks)."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OBSERVATION = "adsieve_metrics"


def observe_metrics(routed: DataFrame, name: str = OBSERVATION) -> DataFrame:
    st = F.col("status")
    ok = F.coalesce(F.col("persist_ok"), F.lit(True)) if "persist_ok" in routed.columns else F.lit(True)
    return routed.observe(
        name,
        F.count_if((st == "accepted") & ok).alias("processed"),
        F.count_if((st == "rejected") | ((st == "accepted") & ~ok)).alias("failed"),
        F.count_if(st == "duplicate").alias("duplicates"),
        F.count_if(st == "fraud").alias("fraud"),
        (F.count_if(st != "rejected") * 2).alias("archived"),
    )


class MetricsListener(StreamingQueryListener):
    """Sums the observed counters of every progress report; the last
    ``keep`` reports stay at hand."""

    COUNTERS = ("processed", "failed", "duplicates", "fraud", "archived")

    def __init__(self, name: str = OBSERVATION, keep: int = 100):
        self.name = name
        self.batches: deque[dict] = deque(maxlen=keep)
        self._sums = dict.fromkeys(self.COUNTERS, 0)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            report = {"batch_id": event.progress.batchId, **row.asDict()}
            self.batches.append(report)
            for k in self.COUNTERS:
                self._sums[k] += int(report.get(k) or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self) -> dict:
        out = dict(self._sums)
        out["success_rate"] = (100.0 * out["processed"] / (out["processed"] + out["failed"])
                               if out["processed"] else None)
        return out
