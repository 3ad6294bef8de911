"""Collector side: landed single and batch requests → topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve import config as C
from adsieve.functions import client_ip, col_of, go_trim, nz, rfc3339_nano, utc_offset, wall_clock
from adsieve.operators.decode import JSON_OPTIONS, STRING_FIELDS, decode, entries_ok, field_columns, known_fields, lower_entries, one_value

# columns of an ingest event as carried on the topic
INGEST_FIELDS = ["event_id", "event_type", "user_id", "campaign_id", "geo_country",
                 "device_type", "created_at", "ip_address", "meta_data"]


def derived_id(request_id: Column, position: Column) -> Column:
    """A UUID-shaped id hashed from the request coordinates (never from the
    content, or equal events would collide); stable when a task is retried."""
    h = F.sha2(F.concat_ws("/", request_id.cast("string"), position.cast("string")), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def default_event_id(request_id: Column | None = None, position: Column | None = None) -> Column:
    """``event_id``, or a fresh id when empty: derived from the request
    coordinates when given, else a random UUID."""
    eid = nz("event_id")
    fresh = F.expr("uuid()") if request_id is None else derived_id(request_id, position)
    return F.when(eid == "", fresh).otherwise(eid)


def default_created_at(request_ts: Column) -> Column:
    """``created_at`` or, when absent, the request time."""
    return F.coalesce(F.col("created_at").cast("timestamp_ntz"), request_ts.cast("timestamp_ntz"))


def ingest_required() -> Column:
    """Single requests need user_id, campaign_id and event_type."""
    return (nz("user_id") != "") & (nz("campaign_id") != "") & (nz("event_type") != "")


def normalize_requests(df: DataFrame, request_ts: str | Column = "received_at",
                       request_id: Column | None = None) -> DataFrame:
    """Landed single requests → ack status + the event to publish.

    The client IP from the headers always overwrites the body's address.
    A missing ``created_at`` takes the request time (column ``received_at``
    unless named). An empty ``event_id`` gets an id derived from the request id (``seq``
    when present), so a retried task produces the same id.
    """
    rts = col_of(request_ts)
    if request_id is None and "seq" in df.columns:
        request_id = F.col("seq")
    ok = ingest_required()
    return df.select(
        *[c for c in df.columns if c not in INGEST_FIELDS and c not in ("xff", "x_real_ip", "remote_ip", "received_at")],
        default_event_id(request_id, F.lit(0) if request_id is not None else None).alias("event_id"),
        nz("event_type").alias("event_type"),
        nz("user_id").alias("user_id"),
        nz("campaign_id").alias("campaign_id"),
        (nz("geo_country") if "geo_country" in df.columns else F.lit("")).alias("geo_country"),
        (nz("device_type") if "device_type" in df.columns else F.lit("")).alias("device_type"),
        default_created_at(rts).alias("created_at"),
        client_ip("xff", "x_real_ip", "remote_ip").alias("ip_address"),
        (F.col("meta_data") if "meta_data" in df.columns else F.lit(None).cast("string")).alias("meta_data"),
        F.when(ok, C.ACK_QUEUED).otherwise(F.lit(None)).alias("ack_status"),
        F.when(ok, F.lit(None)).otherwise(F.lit(C.ERR_REQUIRED)).alias("error"),
    )


def normalize_bodies(df: DataFrame, body: str = "body", request_ts: str | Column = "received_at") -> DataFrame:
    """Landed single requests with their JSON body text → ack status, error and
    the event to publish. A body that is no JSON object of the right types is
    answered with the bad-body error and publishes nothing."""
    parsed = decode(df, body, "created_at").withColumns(
        {"created_at": wall_clock("created_at"), "created_offset": utc_offset("created_at")})
    out = normalize_requests(parsed, request_ts)
    bad = F.col("malformed")
    return out.withColumns({
        "ack_status": F.when(~bad, F.col("ack_status")),
        "error": F.when(bad, F.lit(C.ERR_BAD_BODY)).otherwise(F.col("error")),
    }).drop("malformed")


_EVENT = ("struct<event_id:string,event_type:string,user_id:string,campaign_id:string,geo_country:string,"
          "device_type:string,created_at:timestamp_ntz,created_offset:string,meta_data:string>")


def parse_batch_bodies(df: DataFrame, body: str = "body") -> DataFrame:
    """Landed batch requests with their JSON body text → ``events`` (null for a
    bad body). The body must be an array (or ``null``) whose elements are
    objects of the right types; a null element is an empty event."""
    text = go_trim(F.col(body))
    listed = F.from_json(F.when(text.startswith("["), F.col(body)), "array<variant>", JSON_OPTIONS)
    parsed = df.withColumn("_items", F.transform(listed, lambda v: F.struct(
        lower_entries(F.try_variant_get(v, "$", "map<string,variant>")).alias("e"),
        (v.isNull() | F.is_variant_null(v)).alias("empty"))))
    fine = F.forall("_items", lambda x: F.coalesce(x["empty"] | entries_ok(x["e"], "created_at"), F.lit(False)))

    def event(x: Column) -> Column:
        fields = field_columns(known_fields(x["e"]), "created_at")
        ts = fields[-2]
        return F.struct(*[c for c, n in zip(fields, [*STRING_FIELDS, "created_at", "meta_data"]) if n not in ("ip_address", "created_at", "meta_data")],
                        wall_clock(ts).alias("created_at"), utc_offset(ts).alias("created_offset"), fields[-1])

    events = F.transform("_items", event).cast(f"array<{_EVENT}>")
    good = F.coalesce(one_value(F.col(body)) & fine, F.lit(False))
    none = F.array().cast(f"array<{_EVENT}>")
    return parsed.withColumn("events", F.when(text == "null", none).when(good, events)).drop("_items", body)


def batch_bounds() -> Column:
    """Batch size within 1..1000 (whole batch rejected otherwise)."""
    n = F.coalesce(F.size("events"), F.lit(0))
    return (n >= C.BATCH_MIN_EVENTS) & (n <= C.BATCH_MAX_EVENTS)


def batch_ack(df: DataFrame) -> DataFrame:
    """One acknowledgement per batch request: queued + count, or the error."""
    n = F.coalesce(F.size("events"), F.lit(0))
    return df.select(
        "batch_id",
        F.when(batch_bounds(), C.ACK_QUEUED).alias("ack_status"),
        F.when(F.col("events").isNull(), C.ERR_BAD_BODY).when(n < C.BATCH_MIN_EVENTS, C.ERR_BATCH_EMPTY)
        .when(n > C.BATCH_MAX_EVENTS, C.ERR_BATCH_TOO_BIG).alias("error"),
        F.when(batch_bounds(), n.cast("long")).alias("n_events"),
    )


def explode_batches(df: DataFrame, request_ts: str | Column = "received_at") -> DataFrame:
    """Accepted batch requests → one row per event.

    The batch's single request time and client IP are copied to every event.
    Batch rows skip the required-field check.
    """
    ip = client_ip("xff", "x_real_ip", "remote_ip")
    now = col_of(request_ts).cast("timestamp_ntz")
    ok = df.where(batch_bounds()).select(
        "batch_id", ip.alias("_ip"), now.alias("_now"), F.posexplode("events").alias("position", "ev"))
    ev = lambda f: F.col(f"ev.{f}")
    eid = nz(ev("event_id"))
    extra = [ev("seq").alias("seq")] if "seq" in df.schema["events"].dataType.elementType.names else []
    # empty ids: derived from (batch, position), stable under task retry
    fresh = derived_id(F.col("batch_id"), F.col("position")) if "batch_id" in df.columns else F.expr("uuid()")
    return ok.select(
        "batch_id", F.col("position").cast("long").alias("position"), *extra,
        F.when(eid == "", fresh).otherwise(eid).alias("event_id"),
        nz(ev("event_type")).alias("event_type"),
        nz(ev("user_id")).alias("user_id"),
        nz(ev("campaign_id")).alias("campaign_id"),
        nz(ev("geo_country")).alias("geo_country"),
        nz(ev("device_type")).alias("device_type"),
        F.coalesce(ev("created_at").cast("timestamp_ntz"), F.col("_now")).alias("created_at"),
        F.col("_ip").alias("ip_address"),
        ev("meta_data").alias("meta_data"),
    )


def to_kafka_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(key, value) rows for the topic: key = event_id, value = wire JSON.

    ``event_id`` and ``ip_address`` are left out when empty, ``meta_data``
    when absent; the ingest ``created_at`` travels as ``timestamp`` in
    RFC 3339 form.
    """
    ts = rfc3339_nano("created_at", "created_offset" if "created_offset" in df.columns else None)
    body = F.struct(
        F.nullif(F.col("event_id"), F.lit("")).alias("event_id"),
        nz("event_type").alias("event_type"),
        nz("user_id").alias("user_id"),
        nz("campaign_id").alias("campaign_id"),
        nz("geo_country").alias("geo_country"),
        nz("device_type").alias("device_type"),
        ts.alias("timestamp"),
        F.nullif(F.col("ip_address"), F.lit("")).alias("ip_address"),
        F.parse_json(F.col("meta_data")).alias("meta_data"),
    )
    return df.select(*(keep or []), F.col("event_id").alias("key"), F.to_json(body).alias("value"))
