"""Command line: run the batch job, the stream, or the campaign queries.

    python -m adsieve batch     --messages PATH --out ROOT --batch-id N
    python -m adsieve stream    --out ROOT --checkpoint DIR (--brokers B --topics T | --files PATH)
    python -m adsieve campaigns --out ROOT [--id CAMPAIGN_ID] [--json]

``--messages``/``--files`` hold topic messages as parquet with columns
``seq, key, arrival, value`` (the value is the event JSON).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from adsieve.config import DEFAULT_SCORING, LOOKUP_BAD_REQUEST, LOOKUP_NOT_FOUND, METRICS_INTERVAL_SECONDS, ScoringConfig
from adsieve.session import apply_required_conf, ensure_checkpoint_dir


def _session(master: str | None) -> SparkSession:
    b = SparkSession.builder.appName("adsieve")
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def _scoring(a) -> ScoringConfig:
    return ScoringConfig(
        dedupe_ttl_s=a.dedupe_ttl, ip_window_s=a.ip_window, ip_threshold=a.ip_threshold,
        fraud_score=DEFAULT_SCORING.fraud_score, non_fraud_score=DEFAULT_SCORING.non_fraud_score,
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="adsieve")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("batch", "stream"):
        s = sub.add_parser(name)
        s.add_argument("--out", required=True)
        s.add_argument("--dedupe-ttl", type=int, default=DEFAULT_SCORING.dedupe_ttl_s)
        s.add_argument("--ip-window", type=int, default=DEFAULT_SCORING.ip_window_s)
        s.add_argument("--ip-threshold", type=int, default=DEFAULT_SCORING.ip_threshold)
    b = sub.choices["batch"]
    b.add_argument("--messages", required=True)
    b.add_argument("--batch-id", type=int, required=True)
    st = sub.choices["stream"]
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--brokers")
    st.add_argument("--topics", default="raw-events")
    st.add_argument("--files")
    st.add_argument("--starting-offsets", default="latest")
    st.add_argument("--windows", choices=("shared", "store"), default="shared", help="window state: shared with the batch job, or in the state store")
    st.add_argument("--first-batch-id", type=int, default=0, help="added to the micro-batch ids; ids of one output root form one sequence")
    st.add_argument("--once", action="store_true", help="process what is there, then stop")
    c = sub.add_parser("campaigns")
    c.add_argument("--out", required=True)
    c.add_argument("--id", default=None)
    c.add_argument("--json", action="store_true")
    c.add_argument("--write", default=None, help="write the listing as JSON files instead of printing it")
    a = p.parse_args(argv)
    spark = _session(a.master)

    from adsieve.plans.batch_job import Outputs
    out = Outputs(a.out)
    if a.cmd == "batch":
        from adsieve.plans.batch_job import run_batch
        routed = run_batch(spark, spark.read.parquet(a.messages), out, a.batch_id, _scoring(a))
        counts = {r["status"]: r["count"] for r in routed.groupBy("status").count().collect()}
        print(json.dumps({"batch_id": a.batch_id, "statuses": counts}))
        return 0
    if a.cmd == "stream":
        from adsieve.streaming import job
        from adsieve.operators.metrics import PipelineReport
        if a.files:
            src = job.read_message_files(spark, a.files)
        elif a.brokers:
            src = job.read_events_stream(spark, a.topics, a.brokers, a.starting_offsets)
        else:
            p.error("stream needs --brokers or --files")
        report = PipelineReport()
        q = job.start(src, out, a.checkpoint, _scoring(a), windows=a.windows, report=report, first_batch_id=a.first_batch_id,
                      trigger={"availableNow": True} if a.once else None)
        try:
            while not q.awaitTermination(METRICS_INTERVAL_SECONDS):
                print(json.dumps(report.totals()), flush=True)
        except KeyboardInterrupt:
            q.stop()
        finally:
            # the last report, however the stream ends
            print(json.dumps(report.totals() | {"closing": True}), flush=True)
        return 0
    # campaigns: the query side over the stats delta log
    from pyspark.errors import AnalysisException

    from adsieve.functions import rfc3339_nano
    from adsieve.operators import latest
    from adsieve.operators import stats as S
    from adsieve.schemas import CAMPAIGN_STATS
    from adsieve.sinks.writers import read_stats
    try:
        stats = read_stats(spark, out.stats_delta)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        stats = spark.createDataFrame([], CAMPAIGN_STATS)  # before the first batch
    if a.write:
        # the whole listing goes to files, one JSON object a line
        S.all_campaigns(stats).withColumn("hour_bucket", rfc3339_nano("hour_bucket")).write.mode("errorifexists").json(a.write)
        return 0
    stats = stats.withColumn("hour_bucket", rfc3339_nano("hour_bucket")) if a.json else stats
    if a.id is not None:
        if a.id == "":
            print(json.dumps({"error": LOOKUP_BAD_REQUEST}))
            return 2
        # at most one row, from one bucket of the maintained table
        found = latest.lookup(spark, out.latest, a.id)
        if a.json:
            found = found.withColumn("hour_bucket", rfc3339_nano("hour_bucket"))
        rows = [r.asDict() for r in found.collect()]
        if not rows:
            print(json.dumps({"error": LOOKUP_NOT_FOUND}))
            return 1
        print(json.dumps({"data": rows[0]}, default=str) if a.json else str(rows[0]))
        return 0
    # printed on request, partition by partition, never held whole
    first = True
    out_stream = sys.stdout
    if a.json:
        out_stream.write('{"data":')
    for r in S.all_campaigns(stats).toLocalIterator():
        if a.json:
            out_stream.write(("[" if first else ",") + json.dumps(r.asDict(), default=str))
        else:
            out_stream.write(str(r) + "\n")
        first = False
    if a.json:
        out_stream.write("null}\n" if first else "]}\n")
    out_stream.flush()
    return 0


if __name__ == "__main__":
    sys.exit(main())
