"""The event stream: topic → decode → validate → dedupe → IP window →
route → foreachBatch (archive, raw_events, stats delta, quarantine,
metrics), every output keyed by the micro-batch id (replay overwrites).
Window state is either shared with the batch job or in the state store."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adsieve.config import DEFAULT_SCORING, ScoringConfig
from adsieve.operators.classify import Scorer, WindowScorer, status_col, window_scorer
from adsieve.operators.decode import decode_messages, to_raw_event
from adsieve.operators.validate import storage_constraints, validate_events
from adsieve.operators.metrics import PipelineReport
from adsieve.plans.batch_job import SOURCE_BITS, Outputs, run_batch, stage, write_outputs
from adsieve.streaming.anchored_state import stateful_anchored
from adsieve.streaming.metrics import observe_metrics

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MESSAGE_SCHEMA = "seq long, key string, arrival timestamp_ntz, value string"


def kafka_source_options(topics: str, brokers: str, starting: str = "latest",
                         max_offsets_per_trigger: int | None = 5_000_000,
                         fail_on_data_loss: bool = True) -> dict[str, str]:
    """Consumer settings: every topic of a comma list, newest offsets first;
    a bounded micro-batch keeps the per-key state step of a hot key small.
    Offsets lost to topic retention stop the stream unless the caller says
    otherwise."""
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics,
        "startingOffsets": starting,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def sequence(partition: Column, offset: Column) -> Column:
    """One number that orders rows by partition, then offset."""
    fits = (offset < F.lit(1 << SOURCE_BITS)) & (partition < F.lit(1 << (63 - SOURCE_BITS)))
    return F.when(fits, partition.cast("long") * F.lit(1 << SOURCE_BITS) + offset).otherwise(F.raise_error(F.lit("partition or offset out of range")))


def read_events_stream(spark: SparkSession, topics: str, brokers: str, starting: str = "latest",
                       max_offsets_per_trigger: int | None = 5_000_000,
                       fail_on_data_loss: bool = True) -> DataFrame:
    """Kafka consumer over a comma list of topics (needs spark-sql-kafka).

    ``seq`` orders ties: partition then offset.
    """
    raw = (
        spark.readStream.format("kafka")
        .options(**kafka_source_options(topics, brokers, starting, max_offsets_per_trigger, fail_on_data_loss))
        .load()
    )
    return raw.select(
        sequence(F.col("partition"), F.col("offset")).alias("seq"),
        F.col("key").cast("string").alias("key"),
        F.col("timestamp").cast("timestamp_ntz").alias("arrival"),
        F.col("value").cast("string").alias("value"),
    )


def read_message_files(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 1) -> DataFrame:
    """Landed topic messages as a file stream (tests, replays)."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
        .option("maxFilesPerTrigger", files_per_trigger).load(path)
    )


def route_stream(messages: DataFrame, cfg: ScoringConfig = DEFAULT_SCORING, max_stop_s: int | None = None,
                 scorer: Scorer = window_scorer) -> DataFrame:
    """One linear streaming plan over the state store; duplicates pass through
    the scorer's counters without counting (no branch-and-union).

    Window state is kept for good unless the caller sets ``max_stop_s``, the
    longest time the stream may ever stand still or lag behind: only then may
    state older than the window plus that time go. A plain scoring function is
    applied to the rows as they come."""
    def ttl(window_s: int) -> int | None:
        return None if max_stop_s is None else (window_s + max_stop_s) * 1000

    ev = validate_events(to_raw_event(decode_messages(messages)))
    rows = stateful_anchored(ev, "event_id", cfg.dedupe_ttl_s, F.col("reject_field").isNull(), "dup_pos", ttl_ms=ttl(cfg.dedupe_ttl_s))
    if isinstance(scorer, WindowScorer):
        for w in scorer.windows:
            rows = stateful_anchored(rows, w.key, w.window_s(cfg), w.counted(), w.pos, ttl_ms=ttl(w.window_s(cfg)))
        rows = scorer.finish(rows, cfg)
    else:
        rows = scorer(rows, cfg)
    return storage_constraints(rows.withColumn("status", status_col(cfg)))


def start(messages: DataFrame, out: Outputs, checkpoint: str, cfg: ScoringConfig = DEFAULT_SCORING,
          trigger: dict | None = None, max_stop_s: int | None = None, scorer: Scorer = window_scorer,
          windows: str = "shared", report: PipelineReport | None = None, first_batch_id: int = 0) -> StreamingQuery:
    """Run the stream.

    ``windows="shared"``: each micro-batch is a run of the batch job, under the
    id ``first_batch_id`` plus its own. The windows live in the output root's
    window state, which batches and streams share: a batch after a stream (or
    the reverse) continues its marks and counters, a hot key of a micro-batch
    is spread over tasks like any other, and windows that no event can reach
    any more are folded away. Each trigger reads the live windows, so give it
    time (a minute) where a day's marks are many.

    ``windows="store"``: marks and counters live in the state store, looked up
    by key, for triggers of seconds; they are the stream's own."""
    spark = messages.sparkSession
    if windows == "shared":
        def sink(batch: DataFrame, batch_id: int) -> None:
            run_batch(batch.sparkSession, batch, out, first_batch_id + batch_id, cfg, scorer=scorer, report=report, keep_routed=False)

        rows = messages
    else:
        # transformWithState keeps several column families: RocksDB store
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        rows = observe_metrics(route_stream(messages, cfg, max_stop_s, scorer))
        slot = "stream-" + hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

        def sink(batch: DataFrame, batch_id: int) -> None:
            started = dt.datetime.now(dt.timezone.utc)
            # one slot per stream, overwritten by every micro-batch
            staged = stage(batch, slot, "current")
            up = staged.select(F.max("arrival")).scalar()
            metrics = write_outputs(staged, out, first_batch_id + batch_id, upload_ts=up, started=started)
            if report is not None:
                report.add(first_batch_id + batch_id, metrics)

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(**(trigger or {"processingTime": "60 seconds" if windows == "shared" else "5 seconds"}))
    return w.start()


__all__ = ["kafka_source_options", "read_events_stream", "read_message_files", "route_stream", "sequence", "start"]
