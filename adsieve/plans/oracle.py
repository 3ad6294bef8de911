"""DuckDB SQL for the correctness oracle.

Every registered query has a SQL twin here, written against the driver's
base views (``events`` ...). The ad-event views are inlined as CTEs so each
statement runs on its own.
"""

from __future__ import annotations

from adsieve.config import FIXTURE_SCORING, ScoringConfig
from adsieve.sources.fixtures import (
    AD_EVENTS_SQL, COLLECTOR_REQUESTS_SQL, DUCKDB_DIALECT, KAFKA_MESSAGES_SQL, render,
)

AD_EVENTS = render(AD_EVENTS_SQL, DUCKDB_DIALECT, "events")
KAFKA_MESSAGES = render(KAFKA_MESSAGES_SQL, DUCKDB_DIALECT, "ad_events")
COLLECTOR_REQUESTS = render(COLLECTOR_REQUESTS_SQL, DUCKDB_DIALECT, "ad_events")

# every white-space character of Unicode, as a list for trim()
TRIM = "trim({x}, concat(" + ", ".join(f"chr({c})" for c in (
    9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)) + "))"

VALID = (
    "event_type IN ('impression','click','conversion') AND user_id <> '' AND campaign_id <> '' "
    "AND geo_country <> '' AND strlen(geo_country) = 2 AND device_type <> ''"
)

REJECT_FIELD = """CASE
 WHEN event_type NOT IN ('impression','click','conversion') THEN 'event_type'
 WHEN user_id = '' THEN 'user_id'
 WHEN campaign_id = '' THEN 'campaign_id'
 WHEN geo_country = '' THEN 'geo_country'
 WHEN strlen(geo_country) <> 2 THEN 'geo_country'
 WHEN device_type = '' THEN 'device_type' END"""

REJECT_MESSAGE = """CASE
 WHEN event_type NOT IN ('impression','click','conversion') THEN concat('invalid event_type: ', event_type)
 WHEN user_id = '' THEN 'user_id is required'
 WHEN campaign_id = '' THEN 'campaign_id is required'
 WHEN geo_country = '' THEN 'geo_country is required'
 WHEN strlen(geo_country) <> 2 THEN 'must be 2-letter ISO code'
 WHEN device_type = '' THEN 'device_type is required' END"""


def with_views(body: str, extra: str = "") -> str:
    """Prefix a statement with the ad-event views it may use."""
    ctes = f"ad_events AS ({AD_EVENTS})"
    if "kafka_messages" in body or "kafka_messages" in extra:
        ctes += f",\nkafka_messages AS ({KAFKA_MESSAGES})"
    if "collector_requests" in body or "collector_requests" in extra:
        ctes += f",\ncollector_requests AS ({COLLECTOR_REQUESTS})"
    if extra:
        ctes += ",\n" + extra
    return f"WITH RECURSIVE {ctes}\n{body}"


def anchored_ctes(src: str, key: str, w: int, prefix: str, pos: str) -> str:
    """CTEs giving ``{prefix}_pos``: src rows + anchored position ``pos``."""
    return f"""
{prefix}_a(kk, ats) AS (
 SELECT {key}, min(created_at) FROM {src} GROUP BY {key}
 UNION ALL
 SELECT a.kk, (SELECT min(k.created_at) FROM {src} k WHERE k.{key}=a.kk AND k.created_at >= a.ats + INTERVAL {w} SECOND)
 FROM {prefix}_a a
 WHERE EXISTS (SELECT 1 FROM {src} k WHERE k.{key}=a.kk AND k.created_at >= a.ats + INTERVAL {w} SECOND)),
{prefix}_pos AS (
 SELECT k.*, a.ats AS {prefix}_anchor,
  row_number() OVER (PARTITION BY k.{key}, a.ats ORDER BY k.created_at, k.seq) AS {pos}
 FROM {src} k ASOF JOIN {prefix}_a a ON k.{key}=a.kk AND k.created_at >= a.ats)"""


def classified_ctes(cfg: ScoringConfig = FIXTURE_SCORING) -> str:
    """valid → dedupe positions → IP positions → score and status (``cls``)."""
    trim_ip = TRIM.format(x="ip_address")
    return f"""
valid AS (SELECT * FROM ad_events WHERE {VALID}),
{anchored_ctes('valid', 'event_id', cfg.dedupe_ttl_s, 'dd', 'dup_pos')},
ipsrc AS (SELECT * FROM dd_pos WHERE dup_pos = 1 AND {trim_ip} <> ''),
{anchored_ctes('ipsrc', 'ip_address', cfg.ip_window_s, 'ip', 'ip_pos')},
scored AS (
 SELECT d.*, i.ip_pos,
  CAST(CASE WHEN d.dup_pos > 1 THEN 0 WHEN {TRIM.format(x='d.ip_address')} = '' THEN {cfg.blank_ip_score}
   WHEN i.ip_pos > {cfg.ip_threshold} THEN {cfg.fraud_score} ELSE {cfg.non_fraud_score} END AS INTEGER) AS risk_score
 FROM dd_pos d LEFT JOIN ip_pos i ON d.seq = i.seq),
cls AS (
 SELECT *, CASE WHEN dup_pos > 1 THEN 'duplicate' WHEN risk_score > {cfg.fraud_cut} THEN 'fraud' ELSE 'accepted' END AS status
 FROM scored)"""
