"""Pipeline counters over classified events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pipeline_metrics(routed: DataFrame, persist_ok: str | None = "persist_ok") -> DataFrame:
    """One row of counters over every routed message (one aggregation pass).

    ``routed`` holds all decoded events with ``status`` in rejected /
    duplicate / fraud / accepted. processed = accepted and stored; failed =
    validation rejects + storage failures (malformed messages are not
    counted); archived counts the raw and the final record of every valid
    event.
    """
    ok = F.col(persist_ok) if persist_ok and persist_ok in routed.columns else F.lit(True)
    st = F.col("status")
    acc = st == "accepted"
    valid = st != "rejected"
    # a wrong client clock must not set the time of the last processed event
    clock = F.col("arrival" if "arrival" in routed.columns else "created_at")
    return routed.agg(
        F.count_if(acc & ok).cast("long").alias("total_processed"),
        F.count_if((st == "rejected") | (acc & ~ok)).cast("long").alias("total_failed"),
        F.count_if(st == "duplicate").cast("long").alias("total_duplicates"),
        F.count_if(st == "fraud").cast("long").alias("total_fraud"),
        (F.count_if(valid) * 2).cast("long").alias("total_archived"),
        F.max(F.when(acc & ok, clock)).alias("last_processed_at"),
    )


def success_rate(metrics: DataFrame) -> DataFrame:
    """processed / (processed + failed) × 100, only when processed > 0."""
    p, f = F.col("total_processed"), F.col("total_failed")
    return metrics.select("*", F.when(p > 0, F.try_divide(p * 100.0, p + f)).alias("success_rate"))


class PipelineReport:
    """Running totals over the batches of a job, for the periodic report and
    the closing one: counters, success rate, average processing time of an
    event, time of the last processed event."""

    COUNTERS = ("total_processed", "total_failed", "total_duplicates", "total_fraud", "total_archived")

    def __init__(self) -> None:
        self.sums = dict.fromkeys(self.COUNTERS, 0)
        self.events, self.seconds, self.last, self.batches = 0, 0.0, None, 0
        self._seen: set[int] = set()

    def add(self, batch_id: int, metrics: dict) -> None:
        """A batch counts once, however often it is replayed."""
        if batch_id in self._seen:
            return
        self._seen = {b for b in self._seen if b > batch_id - 1000} | {batch_id}
        self.batches += 1
        for k in self.COUNTERS:
            self.sums[k] += int(metrics[k] or 0)
        self.events += int(metrics["n_events"] or 0)
        self.seconds += (metrics["finished_at"] - metrics["started_at"]).total_seconds()
        at = metrics["last_processed_at"]
        self.last = at if self.last is None or (at is not None and at > self.last) else self.last

    def totals(self) -> dict:
        done, failed = self.sums["total_processed"], self.sums["total_failed"]
        return self.sums | {
            "batches": self.batches,
            "success_rate": 100.0 * done / (done + failed) if done else None,
            "avg_seconds_per_event": self.seconds / self.events if self.events else None,
            "last_processed_at": None if self.last is None else self.last.isoformat(),
        }


def batch_latency(batches: DataFrame) -> DataFrame:
    """Mean processing time per event over recorded micro-batches.

    ``batches``: batch_id, n_events, started_at, finished_at.
    """
    secs = F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))
    return batches.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("n_events").alias("n_events"),
        (F.sum(secs) / F.greatest(F.sum("n_events"), F.lit(1)) / 1e6).alias("avg_seconds_per_event"),
    )
