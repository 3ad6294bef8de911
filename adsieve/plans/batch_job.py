"""Batch job: topic messages of one batch → archive, tables, stats, metrics.

decode, then validate → dedupe → IP window → route; the decoded events and the
routed rows are staged as parquet tables in the shared checkpoint folder (cuts
the lineage, so a lost executor recomputes neither the parsing nor the two
anchored scans) and every output reads the stage. Each output is written under the batch id, so replaying a
batch overwrites its own files.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve.config import DEFAULT_SCORING, ArchiveConfig, ScoringConfig
from adsieve.functions import epoch_micros, json_null_text
from adsieve.operators import latest
from adsieve.operators.archive import archive_rows
from adsieve.operators.classify import Keep, Scorer, classify, history_of, window_lengths, window_scorer
from adsieve.operators.decode import decode_messages, to_raw_event
from adsieve.operators.history import Carried, WindowHistory, carried, live
from adsieve.operators.metrics import PipelineReport, pipeline_metrics
from adsieve.operators.stats import campaign_hour_stats, merge_stats
from adsieve.operators.validate import storage_constraints
from adsieve.session import ensure_checkpoint_dir
from adsieve.sinks import segments
from adsieve.sinks import writers as W
from adsieve.sources.tables import raw_events_schema

# seq = source partition * 2**SOURCE_BITS + offset
SOURCE_BITS = 48
METRICS = ("total_processed long, total_failed long, total_duplicates long, total_fraud long, total_archived long, "
           "last_processed_at timestamp_ntz, n_events long, started_at timestamp, finished_at timestamp")
ARCHIVE_ROWS = "record string, status string, year string, month string, day string, hour string, batch_id string"
RAW_EVENT_OUT = ["event_id", "event_type", "user_id", "campaign_id", "geo_country", "device_type",
                 "created_at", "ip_address", "risk_score", "meta_data"]


@dataclass(frozen=True)
class Outputs:
    root: str

    @property
    def archive(self) -> str:
        return os.path.join(self.root, "archive")

    @property
    def raw_events(self) -> str:
        return os.path.join(self.root, "raw_events")

    @property
    def stats_delta(self) -> str:
        return os.path.join(self.root, "campaign_stats_delta")

    @property
    def latest(self) -> str:
        return os.path.join(self.root, "campaign_latest")

    @property
    def metrics(self) -> str:
        return os.path.join(self.root, "metrics")

    @property
    def windows(self) -> str:
        return os.path.join(self.root, "window_state")

    @property
    def progress(self) -> str:
        return os.path.join(self.root, "progress")

    @property
    def archive_index(self) -> str:
        return os.path.join(self.root, "archive_index")

    @property
    def quarantine(self) -> str:
        return os.path.join(self.root, "quarantine")


def decoded(messages: DataFrame) -> DataFrame:
    """Topic rows (seq, arrival, value, ...) → events."""
    return to_raw_event(decode_messages(messages))


def route_events(events: DataFrame, cfg: ScoringConfig = DEFAULT_SCORING,
                 history: WindowHistory | None = None, scorer: Scorer = window_scorer, keep: Keep = lambda df, name: df) -> DataFrame:
    """Every event with its status (rejected / duplicate / fraud / accepted)
    and storage check."""
    if "arrival" in events.columns:
        cfg = dataclasses.replace(cfg, arrival_col="arrival")  # windows follow the topic clock
    return storage_constraints(classify(events, cfg, scorer, keep_rejected=True, history=history, keep=keep))


def stage(df: DataFrame, name: str, batch_id: int | str) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and read it back.

    ``batch_id`` names the slot; a stream passes a fixed slot so each
    micro-batch overwrites the previous stage (bounded storage).
    """
    spark = df.sparkSession
    path = _stage_path(spark, name, batch_id)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _stage_path(spark: SparkSession, name: str, batch_id: int | str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "adsieve-stage", name, f"batch_id={batch_id}")


def unstage(spark: SparkSession, names: list[str], batch_id: int | str) -> None:
    """Remove stages that nothing reads any more."""
    for name in names:
        segments.remove(spark, _stage_path(spark, name, batch_id))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def write_outputs(routed: DataFrame, out: Outputs, batch_id: int, upload_ts: Column | None = None,
                  archive_cfg: ArchiveConfig = ArchiveConfig(), started: dt.datetime | None = None) -> dict:
    """Write every output of a batch; returns its metrics."""
    spark, started = routed.sparkSession, started or _now()
    valid = routed.where(F.col("status") != "rejected")
    stored = routed.where((F.col("status") == "accepted") & F.col("persist_ok"))
    archive = archive_rows(valid, upload_ts)
    W.write_archive(archive, out.archive, batch_id, archive_cfg)
    W.write_archive_index(archive, out.archive_index, batch_id)
    W.write_raw_events(
        stored.select(*RAW_EVENT_OUT[:-1], json_null_text("meta_data").alias("meta_data"),
                      F.to_date("created_at").alias("event_date")),
        out.raw_events, batch_id)
    W.write_quarantine(
        routed.where((F.col("status") == "rejected") | ((F.col("status") == "accepted") & ~F.col("persist_ok")))
        .select("seq", "status", "reject_field", "reject_message", "violation"),
        out.quarantine, batch_id)
    # the batch's own duration, for the processing time per event
    metrics = pipeline_metrics(routed).first().asDict()
    metrics["n_events"] = sum(metrics[c] for c in ("total_processed", "total_failed", "total_duplicates", "total_fraud"))
    metrics |= {"started_at": started, "finished_at": _now()}
    W.write_metrics(spark.createDataFrame([metrics], METRICS), out.metrics, batch_id)
    latest.add(spark, out.latest, campaign_hour_stats(stored), batch_id)
    # last, as its folder tells the fold that the batch is whole
    W.write_stats_delta(campaign_hour_stats(stored), out.stats_delta, batch_id)
    return metrics


def read_history(spark: SparkSession, out: Outputs, batch_id: int, lengths: dict[str, int], since: Column) -> dict[str, Carried] | None:
    """Windows that earlier batches (by id) left open for events from ``since``
    on; a replay of a batch sees what its first run saw. They are staged: the
    routing reads them several times."""
    windows = W.read_windows(spark, out.windows)
    if windows is None:
        return None
    # a segment holds closed batches only, all before this one
    earlier = windows.where(F.col("batch_id").contains("-") | (F.col("batch_id").try_cast("long") < int(batch_id)))
    slot = hashlib.sha1(out.root.encode()).hexdigest()[:12]
    found = {}
    for name, length in lengths.items():
        kept = stage(live(earlier.where(F.col("kind") == name), length, since), f"windows-{name}-{slot}", batch_id)
        found[name] = carried(kept, since)
    return found


def tables(spark: SparkSession, out: Outputs, lengths: dict[str, int]) -> list[segments.Table]:
    """How the tables of an output root are folded. Windows keep the newest one
    a key, and of these only those that an event can still reach: every source
    partition delivers in order of arrival, so no event comes before the
    lowest of the partitions' newest arrivals."""
    def open_windows(rows: DataFrame) -> DataFrame:
        low = W.read_progress(spark, out.progress).groupBy("source").agg(F.max("arrival").alias("arrival")).agg(F.min("arrival")).scalar()
        reach = F.create_map(*[F.lit(x) for name, seconds in lengths.items() for x in (name, seconds * 1_000_000)]).cast("map<string,long>")
        windows = rows.groupBy("kind", "key").agg(F.max(F.struct("anchor_us", "n")).alias("w")).select("kind", "key", "w.*")
        # a window of unknown length stays
        return windows.where(F.coalesce(F.col("anchor_us") + reach[F.col("kind")] > epoch_micros(low), F.lit(True)))

    def plain(df: DataFrame) -> DataFrame:
        return df

    def parquet(spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(path)

    def rewrite(df: DataFrame, path: str, name: str) -> None:
        W.write_partition(df, path, name)

    def windows(spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(W.WINDOWS).parquet(path)

    return [
        segments.Table(out.archive, 5, lambda s, p: s.read.schema(ARCHIVE_ROWS).text(p), plain, W.write_archive),
        segments.Table(out.archive_index, 0, lambda s, p: s.read.schema(W.INDEX).parquet(p),
                       lambda df: df.groupBy(*W.ARCHIVE_PARTS).agg(F.sum("n_records").alias("n_records")), rewrite),
        segments.Table(out.raw_events, 1, lambda s, p: s.read.schema(raw_events_schema()).parquet(p), plain, W.write_raw_events),
        segments.Table(out.quarantine, 0, parquet, plain, rewrite),
        segments.Table(out.metrics, 0, parquet, plain, rewrite),
        segments.Table(out.windows, 1, windows, open_windows, W.write_window_rows),
        segments.Table(out.progress, 0, lambda s, p: s.read.schema(W.PROGRESS).parquet(p),
                       lambda df: df.groupBy("source").agg(F.max("arrival").alias("arrival")), W.write_progress),
        segments.Table(out.stats_delta, 0, W.read_deltas, merge_stats, W.write_stats_delta),
    ]


def run_batch(spark: SparkSession, messages: DataFrame, out: Outputs, batch_id: int,
              cfg: ScoringConfig = DEFAULT_SCORING, upload_ts: Column | None = None, scorer: Scorer = window_scorer,
              report: PipelineReport | None = None, fan: int | None = segments.FAN, keep_routed: bool = True) -> DataFrame | None:
    """Process one batch of topic messages end to end; returns the staged
    routed rows (``keep_routed`` False: removes them and returns nothing).

    Archive objects are named by upload time. By default that is the
    batch's newest arrival (data-derived, so a replay writes the same
    partitions and overwrites them). Dedupe marks and the scorer's counters of
    earlier batches carry on. Batch ids of one output root form one sequence,
    whether a batch or a stream wrote them. Afterwards one due fold of closed
    batches is carried out (``fan`` None: never); a batch that was folded is
    closed, and its replay writes nothing.
    """
    started, history, lengths = _now(), None, window_lengths(cfg, scorer)
    # outputs with the same batch id elsewhere have a stage of their own
    slot = hashlib.sha1(out.root.encode()).hexdigest()[:12]
    # the anchored windows read their input more than once, a few columns at a
    # time: the decoded events are staged, so no message is parsed twice
    events = stage(decoded(messages), f"decoded-{slot}", batch_id)
    closed = segments.load(spark, out.root).closed(batch_id)
    since = events.select(F.min("arrival")).scalar() if "arrival" in events.columns and not closed else None
    if since is not None and events.select("arrival").first() is not None:
        history = read_history(spark, out, batch_id, lengths, since)
    if closed:
        return route_events(events.limit(0), cfg, scorer=scorer)
    routed = stage(route_events(events, cfg, history, scorer, lambda df, name: stage(df, f"before-{name}-{slot}", batch_id)), f"routed-{slot}", batch_id)
    unstage(spark, [f"decoded-{slot}", *(f"{what}-{name}-{slot}" for what in ("before", "windows") for name in lengths)], batch_id)
    if "arrival" in routed.columns:
        W.write_windows(history_of(routed, scorer), out.windows, batch_id)
        source = F.shiftright("seq", SOURCE_BITS).alias("source")
        W.write_progress(messages.groupBy(source).agg(F.max("arrival").alias("arrival")), out.progress, batch_id)
    if upload_ts is None:
        upload_ts = routed.select(F.max("arrival")).scalar() if "arrival" in routed.columns else None
    metrics = write_outputs(routed, out, batch_id, upload_ts, started=started)
    if report is not None:
        report.add(batch_id, metrics)
    if fan is not None and "arrival" in routed.columns:
        segments.fold(spark, out.root, tables(spark, out, lengths), segments.batches_of(spark, out.stats_delta), fan)
    if keep_routed:
        return routed
    unstage(spark, [f"routed-{slot}"], batch_id)
