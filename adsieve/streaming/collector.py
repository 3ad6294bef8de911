"""The collector as a stream: landed requests → acknowledgements and topic rows.

Requests land as files (``id, kind, xff, x_real_ip, remote_ip, received_at,
body``; kind ``single`` or ``batch``). A micro-batch parses every body once
into a stage; its acknowledgements and its topic rows are both taken from that
stage and written under the micro-batch id, so a replay overwrites its own
files. A request that lands again (same ``id``) is answered and published once:
Spark's state holds the ids, for good, or as long as ``within`` says after the
newest ``received_at``. Empty event ids are derived from the request id and the
position in it, so a replay publishes the same keys.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adsieve.operators.ingest import batch_ack, explode_batches, normalize_bodies, parse_batch_bodies, to_kafka_rows
from adsieve.plans.batch_job import stage, unstage
from adsieve.sinks import writers as W

REQUESTS = "id long, kind string, xff string, x_real_ip string, remote_ip string, received_at timestamp_ntz, body string"
HEADERS = ["xff", "x_real_ip", "remote_ip", "received_at", "body"]
ACKS = "id long, kind string, ack_status string, error string, n_events long, batch_id string"
TOPIC = "id long, position long, key string, value string, batch_id string"


@dataclass(frozen=True)
class CollectorOutputs:
    root: str

    @property
    def acks(self) -> str:
        return os.path.join(self.root, "acks")

    @property
    def topic(self) -> str:
        return os.path.join(self.root, "topic")


def read_request_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def once(requests: DataFrame, within: str | None = None) -> DataFrame:
    """Each request id once (streams and batches)."""
    if within is None or not requests.isStreaming:
        return requests.dropDuplicates(["id"])
    # a watermark needs a zoned time; sessions of this library run in UTC
    return requests.withColumn("_at", F.col("received_at").cast("timestamp")).withWatermark("_at", within) \
        .dropDuplicatesWithinWatermark(["id"]).drop("_at")


def collect_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed single requests, parsed batch requests): one row a request."""
    single = normalize_bodies(requests.where("kind = 'single'").select(F.col("id").alias("seq"), *HEADERS))
    batch = parse_batch_bodies(requests.where("kind = 'batch'").select(F.col("id").alias("batch_id"), *HEADERS))
    return single, batch


def acknowledgements(single: DataFrame, batch: DataFrame) -> DataFrame:
    one = single.select(F.col("seq").alias("id"), F.lit("single").alias("kind"), "ack_status", "error", F.when(F.col("ack_status").isNotNull(), F.lit(1).cast("long")).alias("n_events"))
    return one.unionByName(batch_ack(batch).select(F.col("batch_id").alias("id"), F.lit("batch").alias("kind"), "ack_status", "error", "n_events"))


def topic_rows(single: DataFrame, batch: DataFrame) -> DataFrame:
    """``id, position, key, value`` of every event to publish."""
    one = single.where(F.col("ack_status").isNotNull()).withColumn("position", F.lit(0).cast("long"))
    many = explode_batches(batch).withColumnRenamed("batch_id", "seq")
    return to_kafka_rows(one, ["seq", "position"]).unionByName(to_kafka_rows(many, ["seq", "position"])).withColumnRenamed("seq", "id")


def start_collector(requests: DataFrame, out: CollectorOutputs, checkpoint: str, trigger: dict | None = None,
                    within: str | None = None, brokers: str | None = None, topic: str = "raw-events") -> StreamingQuery:
    """Answer and publish landed requests: to Kafka where ``brokers`` are given
    (delivered at least once, with keys that repeat), else to files under the
    micro-batch id (exactly once)."""
    slot = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def sink(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        requests = stage(rows, f"requests-{slot}", batch_id)
        parsed = collect_requests(requests)
        single, batch = (stage(df, f"{kind}-{slot}", batch_id) for df, kind in zip(parsed, ("single", "batch")))
        if brokers:
            W.write_kafka(topic_rows(single, batch), brokers, topic)
        else:
            W.write_rows(topic_rows(single, batch), out.topic, batch_id)
        # the answer follows what it acknowledges
        W.write_rows(acknowledgements(single, batch), out.acks, batch_id)
        unstage(spark, [f"{kind}-{slot}" for kind in ("requests", "single", "batch")], batch_id)

    query = once(requests, within).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    return query.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def read_acks(spark: SparkSession, out: CollectorOutputs) -> DataFrame:
    return spark.read.schema(ACKS).parquet(out.acks).drop("batch_id")


def read_topic(spark: SparkSession, out: CollectorOutputs) -> DataFrame:
    return spark.read.schema(TOPIC).parquet(out.topic).drop("batch_id")
