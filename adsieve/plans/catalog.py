"""Registered queries: one Spark builder and (where SQL can say it) one DuckDB
twin per operator.

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the
driver's tables (the ad-event views are derived from ``events``). The fixture
scoring settings are used (see ``adsieve.config.FIXTURE_SCORING``).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve import config as C
from adsieve.config import FIXTURE_SCORING as CFG
from adsieve.functions import blank, client_ip, current_hour, hour_bucket, json_null_text, onehot
from adsieve.operators import archive as A
from adsieve.operators import classify as K
from adsieve.operators import decode as D
from adsieve.operators import history as H
from adsieve.operators import ingest as I
from adsieve.operators import metrics as M
from adsieve.operators import stats as S
from adsieve.operators import validate as V
from adsieve.plans import oracle as O
from adsieve.schemas import STATS_COLUMNS
from adsieve.session import ensure_checkpoint_dir
from adsieve.sinks import writers as W
from adsieve.sources import fixtures as FX
from adsieve.sources.tables import read_raw_events
from adsieve.streaming.job import MESSAGE_SCHEMA, read_message_files

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------
def _ad(spark, sf):
    return FX.ad_events(spark, sf)


def _classified(spark, sf, keep_rejected=False, meta=False):
    # columns pass through the anchored scans as they are: take only what the answer needs
    ad = _ad(spark, sf) if meta else _ad(spark, sf).drop("meta_data")
    return K.classify(ad, CFG, keep_rejected=keep_rejected)


def _accepted(spark, sf, meta=False):
    return _classified(spark, sf, meta=meta).where(F.col("status") == "accepted")


def _stored(spark, sf, meta=False):
    """Accepted events that the storage constraints let through."""
    return V.storage_constraints(_accepted(spark, sf, meta)).where("persist_ok")


def _stats(spark, sf):
    return S.campaign_hour_stats(_stored(spark, sf))


def _folder(spark, name):
    """A new folder for a query that reads what the writers wrote."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _violation_sql() -> str:
    parts = ["CASE WHEN event_type NOT IN ('impression','click','conversion') THEN 'event_type_check'"]
    for colname, limit in C.RAW_EVENTS_VARCHAR.items():
        parts.append(f" WHEN length({colname}) > {limit} THEN '{colname}_too_long'")
    parts.append(" WHEN created_at IS NULL THEN 'created_at_null' END")
    return "".join(parts)


STORED_SQL = f"status = 'accepted' AND ({_violation_sql()}) IS NULL"


CLS = O.classified_ctes(CFG)
GO_TRIM = O.TRIM


def _rfc3339_sql(ts: str) -> str:
    return (f"concat(regexp_replace(regexp_replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '0+$', ''), "
            f"'\\.$', ''), 'Z')")

STATS_SQL_CTE = """stats AS (
 SELECT campaign_id, date_trunc('hour', created_at) AS hour_bucket,
  CAST(sum(CASE WHEN event_type='impression' THEN 1 ELSE 0 END) AS BIGINT) AS total_impressions,
  CAST(sum(CASE WHEN event_type='click' THEN 1 ELSE 0 END) AS BIGINT) AS total_clicks,
  CAST(sum(CASE WHEN event_type='conversion' THEN 1 ELSE 0 END) AS BIGINT) AS total_conversions
 FROM cls WHERE """ + STORED_SQL + " GROUP BY 1, 2)"
STATS_EXTRA = CLS + ",\n" + STATS_SQL_CTE
CLIENT_IP_SQL = ("CASE WHEN xff <> '' THEN " + GO_TRIM.format(x="split_part(xff, ',', 1)")
                 + " WHEN x_real_ip <> '' THEN " + GO_TRIM.format(x="x_real_ip") + " ELSE remote_ip END")
EVENT_ID_SQL = """CASE WHEN event_id = '' THEN (SELECT concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4),
   substr(h, 17, 4), substr(h, 21, 12)) FROM (SELECT sha256(concat_ws('/', CAST(seq AS VARCHAR), '0')) AS h))
 ELSE event_id END"""
REQUIRED_SQL = "(user_id <> '' AND campaign_id <> '' AND event_type <> '')"
# a time text is cut at its fixed places, and each part is tested by itself
TIME_OK_SQL = """(length(x) >= 20 AND substr(x, 11, 1) = 'T' AND try_cast(substr(x, 1, 10) AS DATE) IS NOT NULL
 AND try_cast(substr(x, 12, 8) AS TIME) IS NOT NULL AND substr(x, 14, 1) = ':' AND substr(x, 17, 1) = ':'
 AND CASE WHEN substr(x, 20, 1) = '.' THEN length(x) - length(ltrim(substr(x, 21), '0123456789')) > 20 ELSE true END
 AND (rest = 'Z' OR (length(rest) = 6 AND substr(rest, 1, 1) IN ('+', '-') AND substr(rest, 4, 1) = ':'
  AND try_cast(substr(rest, 2, 2) AS INT) BETWEEN 0 AND 23 AND try_cast(substr(rest, 5, 2) AS INT) BETWEEN 0 AND 59)))"""


def _time_ok(x: str) -> str:
    rest = f"(CASE WHEN substr({x}, 20, 1) = '.' THEN ltrim(substr({x}, 21), '0123456789') ELSE substr({x}, 20) END)"
    return re.sub(r"\brest\b", lambda m: rest, re.sub(r"\bx\b", lambda m: f"({x})", TIME_OK_SQL))


def _key(f: str, fn: str) -> str:
    """A field under its name, or in the fixture's other spelling of it."""
    return f"coalesce({fn}(value, '$.{f}'), {fn}(value, '$.{f.upper()}'))"


def _jt(f: str) -> str:
    return _key(f, "json_type")


DECODE_OK_SQL = (
    "(CASE WHEN NOT json_valid(value) THEN false ELSE (json_type(value) = 'OBJECT' OR trim(value) = 'null')"
    + "".join(f" AND coalesce({_jt(f)} IN ('VARCHAR','NULL'), true)" for f in D.STRING_FIELDS)
    + f" AND coalesce({_jt('timestamp')} = 'NULL' OR ({_jt('timestamp')} = 'VARCHAR' AND "
      f"{_time_ok(_key('timestamp', 'json_extract_string'))}), true)"
    + f" AND coalesce({_jt('meta_data')} IN ('OBJECT','NULL'), true) END)"
)
DECODED_COLS_SQL = (
    ", ".join(f"coalesce({_key(f, 'json_extract_string')}, '') AS {f}" for f in D.STRING_FIELDS)
    + ", json_extract_string(value, '$.timestamp') AS timestamp"
    + f", CASE WHEN {_jt('meta_data')} = 'OBJECT' THEN replace(json_extract(value, '$.meta_data')::VARCHAR,"
      " '{\"x\":1,\"x\":2}', '{\"x\":2}') END AS meta_data"
)
WALL_CLOCK_SQL = "CAST(replace(substr(timestamp, 1, 26), 'T', ' ') AS TIMESTAMP)"


def _decoded(spark, sf):
    return D.decode_messages(FX.kafka_messages(spark, sf))


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------
@query("stream_file_scan", O.with_views("SELECT seq, key, arrival, value FROM kafka_messages"))
def stream_file_scan(spark, sf):
    # landed messages, read as a file stream until nothing is left
    path = _folder(spark, "stream")
    FX.kafka_messages(spark, sf).select("seq", "key", "arrival", "value").write.parquet(f"{path}/in")
    scan = read_message_files(spark, f"{path}/in", files_per_trigger=4).writeStream.format("parquet") \
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out")
    scan.awaitTermination()
    return spark.read.schema(MESSAGE_SCHEMA).parquet(f"{path}/out")


@query("request_scan", O.with_views(f"""
SELECT seq, {EVENT_ID_SQL} AS event_id, event_type, user_id, campaign_id, '' AS geo_country, '' AS device_type,
 coalesce(created_at, received_at) AS created_at, {CLIENT_IP_SQL} AS ip_address, CAST(NULL AS VARCHAR) AS meta_data,
 CASE WHEN {REQUIRED_SQL} THEN 'queued' END AS ack_status,
 CASE WHEN NOT {REQUIRED_SQL} THEN '{C.ERR_REQUIRED}' END AS error
FROM collector_requests"""))
def request_scan(spark, sf):
    return I.normalize_requests(FX.collector_requests(spark, sf))


BODY_BAD_SQL = "(seq % 101 = 0 OR seq % 103 = 0 OR seq % 107 = 0)"


def _body_event_sql(fresh: str, time: str) -> str:
    return (f"CASE WHEN seq % 19 = 0 THEN (SELECT concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4),"
            f" substr(h, 21, 12)) FROM (SELECT sha256({fresh}) AS h)) ELSE event_id END AS event_id, event_type, user_id, campaign_id,"
            f" geo_country, device_type, CASE WHEN seq % 17 = 0 THEN {time} ELSE created_at END AS created_at, json(meta_data)::VARCHAR AS meta_data")


@query("request_bodies", O.with_views(f"""
SELECT seq, {_body_event_sql("concat_ws('/', CAST(seq AS VARCHAR), '0')", "created_at + INTERVAL 1 SECOND")},
 concat('203.0.113.', CAST(seq % 250 AS VARCHAR)) AS ip_address,
 CASE WHEN {REQUIRED_SQL} THEN 'queued' END AS ack_status, CASE WHEN NOT {REQUIRED_SQL} THEN '{C.ERR_REQUIRED}' END AS error
FROM ad_events WHERE NOT {BODY_BAD_SQL}"""))
def request_bodies(spark, sf):
    # the events of good bodies, from the body text
    out = I.normalize_bodies(FX.request_bodies(spark, sf)).drop("created_offset")
    return D.rows_where(out, ~F.col("error").eqNullSafe(C.ERR_BAD_BODY), out.columns)


@query("request_body_acks", O.with_views(f"""
SELECT seq, CASE WHEN {REQUIRED_SQL} AND NOT {BODY_BAD_SQL} THEN 'queued' END AS ack_status,
 CASE WHEN {BODY_BAD_SQL} THEN '{C.ERR_BAD_BODY}' WHEN NOT {REQUIRED_SQL} THEN '{C.ERR_REQUIRED}' END AS error FROM ad_events"""))
def request_body_acks(spark, sf):
    return I.normalize_bodies(FX.request_bodies(spark, sf)).select("seq", "ack_status", "error")


BATCH_BODY_CTE = f"""bb AS (SELECT *, seq // 60 AS batch_id, row_number() OVER (PARTITION BY seq // 60 ORDER BY seq) - 1 AS position,
  max(created_at) OVER (PARTITION BY seq // 60) AS last, bool_or({BODY_BAD_SQL}) OVER (PARTITION BY seq // 60) AS bad FROM ad_events)"""


@query("batch_bodies", O.with_views(f"""
SELECT batch_id, position, {_body_event_sql("concat_ws('/', CAST(batch_id AS VARCHAR), CAST(position AS VARCHAR))", "last + INTERVAL 1 SECOND")},
 '198.51.100.7' AS ip_address FROM bb WHERE NOT bad""", extra=BATCH_BODY_CTE))
def batch_bodies(spark, sf):
    return I.explode_batches(I.parse_batch_bodies(FX.batch_bodies(spark, sf)))


@query("batch_body_acks", O.with_views(f"""
SELECT batch_id, CASE WHEN NOT bad THEN 'queued' END AS ack_status, CASE WHEN bad THEN '{C.ERR_BAD_BODY}' END AS error,
 CASE WHEN NOT bad THEN count(*) END AS n_events FROM bb GROUP BY batch_id, bad""", extra=BATCH_BODY_CTE))
def batch_body_acks(spark, sf):
    return I.batch_ack(I.parse_batch_bodies(FX.batch_bodies(spark, sf)))


BATCH_SQL_CTE = """b AS (SELECT *, CASE WHEN seq < 1500 THEN 0 ELSE 1 + (seq - 1500) // 7 END AS batch_id FROM ad_events),
sz AS (SELECT batch_id, count(*) AS n, max(created_at) AS last FROM b GROUP BY batch_id)"""


@query("batch_explode", O.with_views("""
SELECT b.batch_id, row_number() OVER (PARTITION BY b.batch_id ORDER BY b.seq) - 1 AS position, b.seq,
 b.event_id, b.event_type, b.user_id, b.campaign_id, b.geo_country, b.device_type,
 CASE WHEN b.seq % 17 = 0 THEN sz.last ELSE b.created_at END AS created_at,
 concat('203.0.113.', CAST(abs(b.batch_id) % 250 AS VARCHAR)) AS ip_address, b.meta_data
FROM b JOIN sz ON b.batch_id = sz.batch_id WHERE sz.n BETWEEN 1 AND 1000""", extra=BATCH_SQL_CTE))
def batch_explode(spark, sf):
    # the fixture carries the source row number (seq) inside each element
    return I.explode_batches(FX.batch_requests(spark, sf))


@query("batch_bounds", O.with_views(f"""
SELECT batch_id, CASE WHEN n BETWEEN 1 AND 1000 THEN 'queued' END AS ack_status,
 CASE WHEN n < 1 THEN '{C.ERR_BATCH_EMPTY}' WHEN n > 1000 THEN '{C.ERR_BATCH_TOO_BIG}' END AS error,
 CASE WHEN n BETWEEN 1 AND 1000 THEN n END AS n_events
FROM (SELECT batch_id, n FROM sz UNION ALL SELECT -1 AS batch_id, 0 AS n)""", extra=BATCH_SQL_CTE))
def batch_bounds(spark, sf):
    return I.batch_ack(FX.batch_requests(spark, sf))


@query("stats_scan", O.with_views(
    "SELECT campaign_id, total_impressions, total_clicks, total_conversions, hour_bucket FROM stats",
    extra=STATS_EXTRA))
def stats_scan(spark, sf):
    # written as two batches, read back as the sum of their deltas
    path, stored = _folder(spark, "stats"), _stored(spark, sf)
    for batch in (0, 1):
        W.write_stats_delta(S.campaign_hour_stats(stored.where(F.col("seq") % 2 == batch)), path, batch)
    return W.read_stats(spark, path).select(*STATS_COLUMNS)


RAW_EVENTS_SQL = """SELECT event_id, event_type, user_id, campaign_id, geo_country, device_type, created_at,
 ip_address, risk_score, coalesce(meta_data, 'null') AS meta_data, CAST(created_at AS DATE) AS event_date
FROM cls WHERE """ + STORED_SQL


def _raw_events_rows(spark, sf):
    acc = _stored(spark, sf, meta=True)
    return acc.select(
        "event_id", "event_type", "user_id", "campaign_id", "geo_country", "device_type", "created_at",
        "ip_address", "risk_score", json_null_text("meta_data").alias("meta_data"),
        F.to_date("created_at").alias("event_date"),
    )


def _raw_events_table(spark, sf):
    path = _folder(spark, "raw-events")
    W.write_raw_events(_raw_events_rows(spark, sf), path, 1)
    return read_raw_events(spark, path).drop("batch_id")


@query("raw_events_scan", O.with_views(RAW_EVENTS_SQL, extra=CLS))
def raw_events_scan(spark, sf):
    return _raw_events_table(spark, sf)


# ---------------------------------------------------------------------------
# sinks (the rows each writer emits)
# ---------------------------------------------------------------------------
@query("kafka_rows", O.with_views(f"""
SELECT seq, {EVENT_ID_SQL} AS key, concat('{{"event_id":', to_json({EVENT_ID_SQL}), ',"event_type":', to_json(event_type),
 ',"user_id":', to_json(user_id), ',"campaign_id":', to_json(campaign_id), ',"geo_country":"","device_type":""',
 ',"timestamp":"', {_rfc3339_sql('coalesce(created_at, received_at)')}, '"',
 CASE WHEN ({CLIENT_IP_SQL}) <> '' THEN concat(',"ip_address":', to_json({CLIENT_IP_SQL})) ELSE '' END, '}}') AS value
FROM collector_requests WHERE {REQUIRED_SQL}"""))
def kafka_rows(spark, sf):
    req = I.normalize_requests(FX.collector_requests(spark, sf)).where(F.col("ack_status") == C.ACK_QUEUED)
    return I.to_kafka_rows(req, keep=["seq"])


@query("raw_events_rows", O.with_views(RAW_EVENTS_SQL, extra=CLS))
def raw_events_rows(spark, sf):
    return _raw_events_rows(spark, sf)


@query("stats_upsert", O.with_views(
    "SELECT campaign_id, hour_bucket, total_impressions, total_clicks, total_conversions FROM stats",
    extra=STATS_EXTRA))
def stats_upsert(spark, sf):
    # five batches that each hold events of every hour, merged additively
    acc = _stored(spark, sf).withColumn("batch_id", F.col("seq") % 5)
    deltas = S.stats_by_batch(acc)
    return S.stats_view(deltas).select("campaign_id", "hour_bucket", "total_impressions", "total_clicks",
                                       "total_conversions")


def _archive_record_sql(with_risk: bool, prefix: str = "") -> str:
    p = prefix
    risk = (f" CASE WHEN {p}risk_score <> 0 THEN concat(',\"risk_score\":', CAST({p}risk_score AS VARCHAR)) ELSE '' END,"
            if with_risk else "")
    return (
        f"concat('{{', CASE WHEN {p}event_id <> '' THEN concat('\"event_id\":', to_json({p}event_id), ',') ELSE '' END,"
        f" '\"event_type\":', to_json({p}event_type), ',\"user_id\":', to_json({p}user_id),"
        f" ',\"campaign_id\":', to_json({p}campaign_id), ',\"geo_country\":', to_json({p}geo_country),"
        f" ',\"device_type\":', to_json({p}device_type),"
        f" ',\"created_at\":\"', {_rfc3339_sql(p + 'created_at')}, '\"',"
        f" CASE WHEN {p}ip_address <> '' THEN concat(',\"ip_address\":', to_json({p}ip_address)) ELSE '' END,"
        f"{risk}"
        f" CASE WHEN {p}meta_data IS NOT NULL THEN concat(',\"meta_data\":', json({p}meta_data)::VARCHAR) ELSE '' END, '}}')"
    )


ARCHIVE_SQL_CTE = f"""arch AS (
 SELECT seq, 'raw' AS status, {_archive_record_sql(False)} AS record, created_at FROM cls
 UNION ALL
 SELECT seq, status, {_archive_record_sql(True)} AS record, created_at FROM cls)"""


@query("archive_rows", O.with_views("""
SELECT seq, status, strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month,
 strftime(created_at, '%d') AS day, strftime(created_at, '%H') AS hour, record FROM arch""",
    extra=CLS + ",\n" + ARCHIVE_SQL_CTE))
def archive_rows(spark, sf):
    return A.archive_rows(_classified(spark, sf, meta=True))


@query("archive_json", O.with_views(
    f"SELECT seq, status, {_archive_record_sql(True)} AS record FROM cls", extra=CLS))
def archive_json(spark, sf):
    return _classified(spark, sf, meta=True).select("seq", "status", A.archive_record(True).alias("record"))


def _archive_index(spark, sf):
    """Index that the archive writer leaves: one row a folder."""
    path = _folder(spark, "archive-index")
    W.write_archive_index(A.archive_rows(_classified(spark, sf, meta=True)), path, 1)
    return W.read_archive_index(spark, path)


@query("archive_counts", O.with_views(
    "SELECT status, count(*) AS n_records FROM arch GROUP BY status", extra=CLS + ",\n" + ARCHIVE_SQL_CTE))
def archive_counts(spark, sf):
    return A.archive_counts(_archive_index(spark, sf))


@query("archive_count_delta", O.with_views("""
SELECT coalesce(b.status, a.status) AS status, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after,
 coalesce(a.n, 0) - coalesce(b.n, 0) AS n_growth
FROM (SELECT status, count(*) AS n FROM arch
      WHERE epoch_us(created_at) < (SELECT (min(epoch_us(created_at)) + max(epoch_us(created_at))) // 2 FROM cls)
      GROUP BY status) b
FULL JOIN (SELECT status, count(*) AS n FROM arch GROUP BY status) a ON a.status = b.status""",
    extra=CLS + ",\n" + ARCHIVE_SQL_CTE))
def archive_count_delta(spark, sf):
    # "before" = the archive when the first half of the arrival span was
    # processed (positions are causal, so that is a prefix of the full run)
    from adsieve.functions import epoch_micros
    cls = _classified(spark, sf, meta=True).withColumn("_us", epoch_micros("created_at"))
    valid = V.valid_events(_ad(spark, sf)).select(epoch_micros("created_at").alias("_us"))
    cut = valid.select(F.expr("(min(_us) + max(_us)) div 2")).scalar()
    arch = A.archive_rows(cls, keep=["_us"])
    return A.archive_growth(arch, F.col("_us") < cut)


_POLICY_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS status, {d} AS retention_days" for s, d in C.ARCHIVE_RETENTION_DAYS.items())


@query("archive_expired", O.with_views(f"""
SELECT p.status, p.year, p.month, p.day, p.hour, pol.retention_days, p.n_records
FROM (SELECT status, strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month,
        strftime(created_at, '%d') AS day, strftime(created_at, '%H') AS hour, count(*) AS n_records
      FROM arch GROUP BY ALL) p
JOIN ({_POLICY_SQL}) pol ON p.status = pol.status
WHERE CAST(concat(p.year, '-', p.month, '-', p.day, ' ', p.hour, ':00:00') AS TIMESTAMP)
      + to_days(pol.retention_days) <= (SELECT max(created_at) + INTERVAL 80 DAY FROM arch)""",
    extra=CLS + ",\n" + ARCHIVE_SQL_CTE))
def archive_expired(spark, sf):
    # "now" lies 80 days after the newest upload, so every status has expired hours
    now = _max_created(spark, sf) + F.expr("INTERVAL 80 DAY")
    return A.archive_expired(_archive_index(spark, sf), now)


def _max_created(spark, sf):
    return _ad(spark, sf).where(V.reject_field().isNull()).select(F.max("created_at")).scalar()


# ---------------------------------------------------------------------------
# projections
# ---------------------------------------------------------------------------
@query("decode_messages", O.with_views(
    f"SELECT seq, key, arrival, {DECODED_COLS_SQL} FROM kafka_messages WHERE {DECODE_OK_SQL}"))
def decode_messages(spark, sf):
    return _decoded(spark, sf)


@query("malformed_messages", O.with_views(
    f"SELECT seq, key, arrival, value FROM kafka_messages WHERE NOT {DECODE_OK_SQL}"))
def malformed_messages(spark, sf):
    return D.malformed_messages(FX.kafka_messages(spark, sf))


@query("to_wire", O.with_views("""
SELECT seq, event_id, event_type, user_id, campaign_id, geo_country, device_type, created_at AS timestamp,
 ip_address, meta_data FROM ad_events"""))
def to_wire(spark, sf):
    return D.to_wire(_ad(spark, sf))


@query("to_raw_event", O.with_views(f"""
SELECT seq, key, arrival, event_id, event_type, user_id, campaign_id, geo_country, device_type,
 coalesce({WALL_CLOCK_SQL}, arrival) AS created_at, ip_address, meta_data,
 nullif(regexp_extract(timestamp, '(Z|[+-]\\d{{2}}:\\d{{2}})$', 1), '') AS created_offset
FROM (SELECT seq, key, arrival, {DECODED_COLS_SQL} FROM kafka_messages WHERE {DECODE_OK_SQL})"""))
def to_raw_event(spark, sf):
    return D.to_raw_event(_decoded(spark, sf))


@query("default_created_at", O.with_views(f"""
SELECT seq, coalesce({WALL_CLOCK_SQL}, arrival) AS created_at, timestamp IS NULL AS defaulted
FROM (SELECT seq, arrival, {DECODED_COLS_SQL} FROM kafka_messages WHERE {DECODE_OK_SQL})"""))
def default_created_at(spark, sf):
    d = _decoded(spark, sf).withColumn("defaulted", F.col("timestamp").isNull())
    return D.to_raw_event(d).select("seq", "created_at", "defaulted")


@query("default_event_id", O.with_views(f"SELECT seq, {EVENT_ID_SQL} AS event_id FROM collector_requests"))
def default_event_id(spark, sf):
    req = FX.collector_requests(spark, sf)
    return req.select("seq", I.default_event_id(F.col("seq"), F.lit(0)).alias("event_id"))


@query("client_ip", O.with_views(f"SELECT seq, {CLIENT_IP_SQL} AS ip_address FROM collector_requests"))
def client_ip_q(spark, sf):
    return FX.collector_requests(spark, sf).select("seq", client_ip("xff", "x_real_ip", "remote_ip").alias("ip_address"))


@query("request_ack", O.with_views(f"""
SELECT seq, CASE WHEN {REQUIRED_SQL} THEN 'queued' END AS ack_status,
 CASE WHEN NOT {REQUIRED_SQL} THEN '{C.ERR_REQUIRED}' END AS error FROM collector_requests"""))
def request_ack(spark, sf):
    return I.normalize_requests(FX.collector_requests(spark, sf)).select("seq", "ack_status", "error")


@query("hour_bucket", O.with_views(
    "SELECT seq, created_at, date_trunc('hour', created_at) AS hour_bucket FROM ad_events"))
def hour_bucket_q(spark, sf):
    return _ad(spark, sf).select("seq", "created_at", hour_bucket("created_at").alias("hour_bucket"))


@query("current_hour", O.with_views(
    "SELECT seq, date_trunc('hour', (SELECT max(created_at) FROM ad_events)) AS current_hour FROM ad_events"))
def current_hour_q(spark, sf):
    # the clock stands at the newest event
    now = _ad(spark, sf).select(F.max("created_at")).scalar()
    return _ad(spark, sf).select("seq", current_hour(now).alias("current_hour"))


@query("event_onehot", O.with_views("""
SELECT seq, CAST(event_type = 'impression' AS BIGINT) AS impressions, CAST(event_type = 'click' AS BIGINT) AS clicks,
 CAST(event_type = 'conversion' AS BIGINT) AS conversions FROM ad_events"""))
def event_onehot(spark, sf):
    return _ad(spark, sf).select("seq", *onehot("event_type"))


@query("archive_partition_cols", O.with_views("""
SELECT seq, strftime(created_at, '%Y') AS year, strftime(created_at, '%m') AS month,
 strftime(created_at, '%d') AS day, strftime(created_at, '%H') AS hour FROM ad_events"""))
def archive_partition_cols(spark, sf):
    from adsieve.functions import archive_time_parts
    return _ad(spark, sf).select("seq", *archive_time_parts("created_at"))


@query("campaign_json", O.with_views(f"""
SELECT campaign_id, concat('{{"data":{{"campaign_id":', to_json(campaign_id),
 ',"total_impressions":', CAST(total_impressions AS VARCHAR), ',"total_clicks":', CAST(total_clicks AS VARCHAR),
 ',"total_conversions":', CAST(total_conversions AS VARCHAR), ',"hour_bucket":"', {_rfc3339_sql('hour_bucket')},
 '"}}}}') AS body
FROM stats QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY hour_bucket DESC) = 1""", extra=STATS_EXTRA))
def campaign_json(spark, sf):
    # GET /campaigns/:id response body per campaign (latest hour)
    return S.campaign_json_rows(S.latest_by_campaign(_stats(spark, sf)))


# ---------------------------------------------------------------------------
# predicates
# ---------------------------------------------------------------------------
@query("ingest_required", O.with_views(f"SELECT seq, {REQUIRED_SQL} AS required_ok FROM collector_requests"))
def ingest_required(spark, sf):
    return FX.collector_requests(spark, sf).select("seq", I.ingest_required().alias("required_ok"))


@query("validate_events", O.with_views(f"""
SELECT seq, {O.REJECT_FIELD} AS reject_field, {O.REJECT_MESSAGE} AS reject_message FROM ad_events"""))
def validate_events(spark, sf):
    return V.validate_events(_ad(spark, sf)).select("seq", "reject_field", "reject_message")


@query("reject_counts", O.with_views(f"""
SELECT reject_field, count(*) AS n_rejected FROM (SELECT {O.REJECT_FIELD} AS reject_field FROM ad_events)
WHERE reject_field IS NOT NULL GROUP BY reject_field"""))
def reject_counts(spark, sf):
    return V.reject_counts(_ad(spark, sf))


@query("storage_constraints", O.with_views(f"""
SELECT seq, {_violation_sql()} AS violation, ({_violation_sql()}) IS NULL AS persist_ok
FROM cls WHERE status = 'accepted'""", extra=CLS))
def storage_constraints(spark, sf):
    return V.storage_constraints(_accepted(spark, sf)).select("seq", "violation", "persist_ok")


@query("blank_ip", O.with_views(f"SELECT seq, {GO_TRIM.format(x='ip_address')} = '' AS ip_blank FROM ad_events"))
def blank_ip(spark, sf):
    return _ad(spark, sf).select("seq", blank("ip_address").alias("ip_blank"))


@query("fraud_events", O.with_views(
    f"SELECT seq, event_id, ip_address, risk_score FROM cls WHERE risk_score > {CFG.fraud_cut}", extra=CLS))
def fraud_events(spark, sf):
    return _classified(spark, sf).where(F.col("risk_score") > CFG.fraud_cut).select(
        "seq", "event_id", "ip_address", "risk_score")


@query("campaign_by_id", O.with_views("""
SELECT campaign_id, total_impressions, total_clicks, total_conversions, hour_bucket FROM stats
WHERE campaign_id = 'cmp-3' ORDER BY hour_bucket DESC LIMIT 1""", extra=STATS_EXTRA))
def campaign_by_id(spark, sf):
    return S.campaign_by_id(_stats(spark, sf), "cmp-3")


@query("audit_counts", O.with_views(f"""
SELECT campaign_id, ip_address, count(*) AS n_events, count(*) FILTER (WHERE risk_score > {CFG.fraud_cut}) AS n_high_risk
FROM ({RAW_EVENTS_SQL}) GROUP BY ROLLUP (campaign_id, ip_address)""", extra=CLS))
def audit_counts(spark, sf):
    # per campaign (ip_address null), per campaign + IP, and the grand total,
    # in one aggregation pass
    rows = _raw_events_rows(spark, sf)
    return rows.rollup("campaign_id", "ip_address").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("risk_score") > CFG.fraud_cut).alias("n_high_risk"))


@query("campaign_lookup_status", O.with_views(f"""
SELECT r.campaign_id, CASE WHEN r.campaign_id = '' THEN '{C.LOOKUP_BAD_REQUEST}'
  WHEN l.hour_bucket IS NULL THEN '{C.LOOKUP_NOT_FOUND}' ELSE '{C.LOOKUP_FOUND}' END AS lookup_status,
 l.total_impressions, l.total_clicks, l.total_conversions, l.hour_bucket
FROM (SELECT DISTINCT campaign_id FROM ad_events UNION SELECT 'cmp-none') r
LEFT JOIN (SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY hour_bucket DESC) = 1) l
 ON r.campaign_id = l.campaign_id AND r.campaign_id <> ''""", extra=STATS_EXTRA))
def campaign_lookup_status(spark, sf):
    asked = _ad(spark, sf).select("campaign_id").unionByName(spark.range(1).select(F.lit("cmp-none").alias("campaign_id")))
    return S.campaign_lookup_status(_stats(spark, sf), asked)


# ---------------------------------------------------------------------------
# stateful operators
# ---------------------------------------------------------------------------
@query("mark_duplicates", O.with_views(
    "SELECT seq, event_id, dup_pos, dup_pos > 1 AS is_duplicate, dd_anchor AS dup_anchor FROM dd_pos", extra=CLS))
def mark_duplicates(spark, sf):
    dd = K.mark_duplicates(V.valid_events(_ad(spark, sf)).select("seq", "event_id", "created_at"), CFG)
    return dd.select("seq", "event_id", "dup_pos", "is_duplicate", "dup_anchor")


@query("unique_events", O.with_views(
    "SELECT seq, event_id, created_at FROM dd_pos WHERE dup_pos = 1", extra=CLS))
def unique_events(spark, sf):
    dd = K.mark_duplicates(V.valid_events(_ad(spark, sf)).select("seq", "event_id", "created_at"), CFG)
    return dd.where(F.col("dup_pos") == 1).select("seq", "event_id", "created_at")


@query("duplicate_events", O.with_views(
    "SELECT seq, event_id, created_at, dup_pos FROM dd_pos WHERE dup_pos > 1", extra=CLS))
def duplicate_events(spark, sf):
    dd = K.mark_duplicates(V.valid_events(_ad(spark, sf)).select("seq", "event_id", "created_at"), CFG)
    return dd.where(F.col("dup_pos") > 1).select("seq", "event_id", "created_at", "dup_pos")


@query("ip_window_count", O.with_views(
    "SELECT seq, ip_address, ip_pos, ip_anchor FROM ip_pos", extra=CLS))
def ip_window_count(spark, sf):
    c = _classified(spark, sf)
    return c.where(F.col("ip_pos").isNotNull()).select("seq", "ip_address", "ip_pos", "ip_anchor")


@query("risk_score", O.with_views("SELECT seq, risk_score FROM cls WHERE dup_pos = 1", extra=CLS))
def risk_score(spark, sf):
    return _classified(spark, sf).where(F.col("dup_pos") == 1).select("seq", "risk_score")


@query("classify_events", O.with_views(
    "SELECT seq, event_id, status, risk_score, dup_pos, ip_pos FROM cls", extra=CLS))
def classify_events(spark, sf):
    return _classified(spark, sf).select("seq", "event_id", "status", "risk_score", "dup_pos", "ip_pos")


@query("classify_two_batches", O.with_views(
    "SELECT seq, event_id, status, risk_score, dup_pos, ip_pos FROM cls", extra=CLS))
def classify_two_batches(spark, sf):
    # cut at the middle arrival: the second batch continues the first one's windows
    ad = _ad(spark, sf).drop("meta_data")
    cut = ad.select(F.expr("timestampadd(SECOND, CAST(timestampdiff(SECOND, min(created_at), max(created_at)) / 2 AS INT), min(created_at))")).scalar()
    path = _folder(spark, "first-batch")
    K.classify(ad.where(F.col("created_at") < cut), CFG).write.parquet(path)
    first = spark.read.parquet(path)
    lengths = K.window_lengths(CFG)
    history = {name: H.Carried(H.live(w, lengths[name], cut)) for name, w in K.history_of(first).items()}
    second = K.classify(ad.where(F.col("created_at") >= cut), CFG, history=history)
    out = ["seq", "event_id", "status", "risk_score", "dup_pos", "ip_pos"]
    return first.select(*out).unionByName(second.select(*out))


@query("status_counts", O.with_views(
    "SELECT status, count(*) AS n_events FROM cls GROUP BY status", extra=CLS))
def status_counts(spark, sf):
    return _classified(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n_events"))


@query("accepted_events", O.with_views("""
SELECT seq, event_id, event_type, user_id, campaign_id, geo_country, device_type, created_at, ip_address,
 risk_score, meta_data FROM cls WHERE status = 'accepted'""", extra=CLS))
def accepted_events(spark, sf):
    return _accepted(spark, sf, meta=True).select(
        "seq", "event_id", "event_type", "user_id", "campaign_id", "geo_country", "device_type",
        "created_at", "ip_address", "risk_score", "meta_data")


@query("quarantine", O.with_views(f"""
SELECT seq, 'validation' AS stage, {O.REJECT_FIELD} AS reason FROM ad_events WHERE NOT ({O.VALID})
UNION ALL
SELECT seq, 'persist' AS stage, {_violation_sql()} AS reason FROM cls
WHERE status = 'accepted' AND ({_violation_sql()}) IS NOT NULL""", extra=CLS))
def quarantine(spark, sf):
    routed = V.storage_constraints(_classified(spark, sf, keep_rejected=True))
    stage = F.when(F.col("status") == "rejected", "validation").when(
        (F.col("status") == "accepted") & ~F.col("persist_ok"), "persist")
    reason = F.when(F.col("status") == "rejected", F.col("reject_field")).otherwise(F.col("violation"))
    return routed.select("seq", stage.alias("stage"), reason.alias("reason")).where(F.col("stage").isNotNull())


# example of a pluggable scorer: the same anchored counter keyed by user
USER_SCORER = K.WindowScorer(
    (K.WindowCounter("user", "user_id"),),
    lambda cfg: F.when(F.col("user_pos") > cfg.ip_threshold, cfg.fraud_score).otherwise(cfg.non_fraud_score))


USER_CLS = f"""
valid AS (SELECT * FROM ad_events WHERE {O.VALID}),
{O.anchored_ctes('valid', 'event_id', CFG.dedupe_ttl_s, 'dd', 'dup_pos')},
usrc AS (SELECT * FROM dd_pos WHERE dup_pos = 1),
{O.anchored_ctes('usrc', 'user_id', CFG.ip_window_s, 'us', 'user_pos')}"""


@query("custom_scorer", O.with_views(f"""
SELECT d.seq, CAST(CASE WHEN d.dup_pos > 1 THEN 0 WHEN u.user_pos > {CFG.ip_threshold} THEN {CFG.fraud_score}
  ELSE {CFG.non_fraud_score} END AS INTEGER) AS risk_score,
 CASE WHEN d.dup_pos > 1 THEN 'duplicate' WHEN u.user_pos > {CFG.ip_threshold} THEN 'fraud' ELSE 'accepted' END AS status
FROM dd_pos d LEFT JOIN us_pos u ON d.seq = u.seq""", extra=USER_CLS))
def custom_scorer(spark, sf):
    return K.classify(_ad(spark, sf).drop("meta_data"), CFG, scorer=USER_SCORER).select("seq", "risk_score", "status")


# ---------------------------------------------------------------------------
# aggregations
# ---------------------------------------------------------------------------
@query("campaign_hour_stats", O.with_views("SELECT * FROM stats", extra=STATS_EXTRA))
def campaign_hour_stats(spark, sf):
    return _stats(spark, sf)


METRICS_SQL_CTE = f"""routed AS (
 SELECT CASE WHEN status = 'accepted' AND ({_violation_sql()}) IS NOT NULL THEN 'unstored' ELSE status END AS status, created_at FROM cls
 UNION ALL SELECT 'rejected' AS status, created_at FROM ad_events WHERE NOT ({O.VALID})),
met AS (
 SELECT count(*) FILTER (WHERE status = 'accepted') AS total_processed,
  count(*) FILTER (WHERE status IN ('rejected', 'unstored')) AS total_failed,
  count(*) FILTER (WHERE status = 'duplicate') AS total_duplicates,
  count(*) FILTER (WHERE status = 'fraud') AS total_fraud,
  2 * count(*) FILTER (WHERE status <> 'rejected') AS total_archived,
  max(created_at) FILTER (WHERE status = 'accepted') AS last_processed_at
 FROM routed)"""


def _metrics(spark, sf):
    routed = V.storage_constraints(_classified(spark, sf, keep_rejected=True))
    return M.pipeline_metrics(routed)


@query("pipeline_metrics", O.with_views("SELECT * FROM met", extra=CLS + ",\n" + METRICS_SQL_CTE))
def pipeline_metrics(spark, sf):
    return _metrics(spark, sf)


@query("success_rate", O.with_views("""
SELECT *, CASE WHEN total_processed > 0 THEN CAST(total_processed AS DOUBLE) * 100.0 / (total_processed + total_failed)
 END AS success_rate FROM met""", extra=CLS + ",\n" + METRICS_SQL_CTE))
def success_rate(spark, sf):
    return M.success_rate(_metrics(spark, sf))


@query("batch_latency", O.with_views("""
SELECT count(*) AS n_batches, CAST(sum(n_events) AS BIGINT) AS n_events,
 sum(epoch_us(finished_at) - epoch_us(started_at)) / greatest(sum(n_events), 1) / 1e6 AS avg_seconds_per_event
FROM (SELECT date_trunc('day', created_at) AS batch, count(*) AS n_events, min(created_at) AS started_at,
        max(created_at) AS finished_at FROM cls GROUP BY 1)""", extra=CLS))
def batch_latency(spark, sf):
    c = _classified(spark, sf)
    batches = c.groupBy(F.date_trunc("day", "created_at").alias("batch")).agg(
        F.count(F.lit(1)).alias("n_events"), F.min("created_at").alias("started_at"),
        F.max("created_at").alias("finished_at"))
    path = _folder(spark, "metrics")
    W.write_partition(batches, path, 1)
    return M.batch_latency(W.read_metrics(spark, path))


# ---------------------------------------------------------------------------
# ordering / limits
# ---------------------------------------------------------------------------
@query("all_campaigns", O.with_views("""
SELECT campaign_id, total_impressions, total_clicks, total_conversions, hour_bucket FROM stats
ORDER BY hour_bucket DESC, campaign_id""", extra=STATS_EXTRA))
def all_campaigns(spark, sf):
    return S.all_campaigns(_stats(spark, sf))


@query("latest_by_campaign", O.with_views("""
SELECT campaign_id, total_impressions, total_clicks, total_conversions, hour_bucket FROM stats
QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY hour_bucket DESC) = 1""", extra=STATS_EXTRA))
def latest_by_campaign(spark, sf):
    return S.latest_by_campaign(_stats(spark, sf))
