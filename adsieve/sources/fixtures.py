"""Ad-event views derived from the driver's ``events`` table.

The driver's tables hold no ad events, so the operators run on these views.
The derivation only relabels and reshapes ``events``; every row is kept, so
the work grows with the table. Each view is one SQL text rendered for Spark
here and for DuckDB in ``adsieve.plans.oracle`` (the correctness oracle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve.sources.tables import read_table


# ---------------------------------------------------------------------------
# Fixed definitions of the derived views (FIXTURES.md), one text for both
# engines: $S is the string type, $K the JSON field k of props, $TS the
# created_at text with microseconds. {src} is the input relation.
# ---------------------------------------------------------------------------
AD_EVENTS_SQL = """
SELECT event_id AS seq,
 concat('evt-', CAST(CASE WHEN event_id % 50 = 49 THEN greatest(event_id-401,0) WHEN event_id % 10 = 3 THEN event_id-1
   WHEN event_id % 10 = 7 THEN greatest(event_id-51,0) ELSE event_id END AS $S)) AS event_id,
 CASE event_type WHEN 'view' THEN 'impression' WHEN 'signup' THEN 'impression' WHEN 'purchase' THEN 'conversion'
   ELSE event_type END AS event_type,
 CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 211 = 0 THEN concat('user-with-a-rather-long-name-', CAST(user_id AS $S))
   ELSE concat('user-', CAST(user_id AS $S)) END AS user_id,
 CASE WHEN event_id % 89 = 0 THEN '' ELSE concat('cmp-', CAST(CAST($K AS INT) % 10 AS $S)) END AS campaign_id,
 CASE WHEN event_id % 83 = 0 THEN 'GBR' WHEN event_id % 79 = 0 THEN '' WHEN user_id % 3 = 0 THEN 'US'
   WHEN user_id % 3 = 1 THEN 'IN' ELSE 'DE' END AS geo_country,
 CASE WHEN event_id % 73 = 0 THEN '' WHEN user_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device_type,
 CASE WHEN event_id % 61 = 0 THEN ' ' ELSE concat('10.0.0.', CAST(user_id % 8 AS $S)) END AS ip_address,
 ts AS created_at, CASE WHEN event_id % 71 = 0 THEN NULL ELSE props END AS meta_data
FROM {src}"""

KAFKA_MESSAGES_SQL = """
SELECT seq, event_id AS key, created_at AS arrival,
 CASE WHEN seq % 101 = 0 THEN 'not json' ELSE concat('{"event_id":"', event_id, '","event_type":"', event_type, '",',
  CASE WHEN seq % 127 = 0 THEN '"USER_ID":' ELSE '"user_id":' END,
  CASE WHEN seq % 103 = 0 THEN '123' ELSE concat('"', user_id, '"') END, ',"campaign_id":"', campaign_id, '","geo_country":',
  CASE WHEN seq % 107 = 0 THEN 'null' ELSE concat('"', geo_country, '"') END, ',"device_type":"', device_type, '"',
  CASE WHEN seq % 113 = 0 THEN '' WHEN seq % 131 = 0 THEN ',"timestamp":"2024-02-30T10:00:00Z"'
   WHEN seq % 137 = 0 THEN concat(',"timestamp":"', replace($TS, 'T', 't'), 'Z"') ELSE concat(',"timestamp":"', $TS,
   CASE WHEN seq % 149 = 0 THEN '1234567' ELSE '' END,
   CASE WHEN seq % 109 = 0 THEN '+05:30' WHEN seq % 139 = 0 THEN '+24:00' ELSE 'Z' END, '"') END,
  ',"ip_address":"', ip_address, '","meta_data":', CASE WHEN seq % 151 = 0 THEN '{"x":1,"x":2}' ELSE coalesce(meta_data, 'null') END, '}',
  CASE WHEN seq % 157 = 0 THEN ' x' ELSE '' END) END AS value
FROM {src}"""

COLLECTOR_REQUESTS_SQL = """
SELECT seq, CASE seq % 4 WHEN 0 THEN '' WHEN 1 THEN concat(' 203.0.113.', CAST(seq % 250 AS $S), ' , 198.51.100.1')
  WHEN 2 THEN concat('203.0.113.', CAST(seq % 250 AS $S)) ELSE ', 198.51.100.1' END AS xff,
 CASE WHEN seq % 8 = 0 THEN concat('198.51.100.', CAST(seq % 250 AS $S), ' ') ELSE '' END AS x_real_ip,
 concat('192.0.2.', CAST(seq % 250 AS $S)) AS remote_ip,
 CASE WHEN seq % 19 = 0 THEN '' ELSE event_id END AS event_id, event_type, user_id, campaign_id,
 CASE WHEN seq % 17 = 0 THEN NULL ELSE created_at END AS created_at, created_at + INTERVAL 1 SECOND AS received_at
FROM {src}"""

REQUEST_BODIES_SQL = """
SELECT seq, concat(' 203.0.113.', CAST(seq % 250 AS $S), ', 198.51.100.1') AS xff, '' AS x_real_ip, '192.0.2.1' AS remote_ip,
 created_at + INTERVAL 1 SECOND AS received_at,
 CASE WHEN seq % 101 = 0 THEN '{"event_id":' WHEN seq % 103 = 0 THEN '{"user_id":123}' WHEN seq % 107 = 0 THEN '[]'
  ELSE concat('{"EVENT_ID":"', CASE WHEN seq % 19 = 0 THEN '' ELSE event_id END, '","event_type":"', event_type, '","user_id":"', user_id,
   '","campaign_id":"', campaign_id, '","geo_country":"', geo_country, '","device_type":"', device_type, '"',
   CASE WHEN seq % 17 = 0 THEN '' ELSE concat(',"created_at":"', $TS, 'Z"') END,
   ',"ip_address":"1.1.1.1","meta_data":', coalesce(meta_data, 'null'), '}') END AS body
FROM {src}"""

SPARK_DIALECT = {"$S": "STRING", "$K": "get_json_object(props,'$.k')",
                 "$TS": "date_format(created_at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"}
DUCKDB_DIALECT = {"$S": "VARCHAR", "$K": "json_extract_string(props,'$.k')",
                  "$TS": "strftime(created_at,'%Y-%m-%dT%H:%M:%S.%f')"}


def render(template: str, dialect: dict, src: str | None = None) -> str:
    for token, text in dialect.items():
        template = template.replace(token, text)
    return template if src is None else template.replace("{src}", src)


def _derive(template: str, df: DataFrame) -> DataFrame:
    # one SQL text: parsed once by the JVM, no per-expression round trips;
    # ``{src}`` is bound to the DataFrame, so no named view is registered
    sql = render(template, SPARK_DIALECT).replace("{", "{{").replace("}", "}}").replace("{{src}}", "{src}")
    return df.sparkSession.sql(sql, src=df)


def ad_events_from(events: DataFrame) -> DataFrame:
    return _derive(AD_EVENTS_SQL, events)


def ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_events_from(read_table(spark, sf_dir, "events"))


def kafka_messages_from(ad: DataFrame) -> DataFrame:
    """Topic messages (key, arrival, value) carrying malformed and odd JSON."""
    return _derive(KAFKA_MESSAGES_SQL, ad)


def kafka_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka_messages_from(ad_events(spark, sf_dir))


def collector_requests_from(ad: DataFrame) -> DataFrame:
    """Single ingest requests with their proxy headers."""
    return _derive(COLLECTOR_REQUESTS_SQL, ad)


def collector_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collector_requests_from(ad_events(spark, sf_dir))


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single ingest requests as they arrive: headers and body text."""
    return _derive(REQUEST_BODIES_SQL, ad_events(spark, sf_dir))


def batch_bodies(spark: SparkSession, sf_dir: str, batch_len: int = 60) -> DataFrame:
    """Batch requests as they arrive: the bodies of ``batch_len`` single
    requests in one array; bad single bodies make bad batches."""
    one = request_bodies(spark, sf_dir).withColumn("batch_id", F.floor(F.col("seq") / batch_len))
    items = F.array_sort(F.collect_list(F.struct("seq", "body")))
    text = F.array_join(F.transform(items, lambda x: x["body"]), ",")
    return one.groupBy("batch_id").agg(F.concat(F.lit("["), text, F.lit("]")).alias("body"), F.max("received_at").alias("received_at")) \
        .select("batch_id", F.lit("").alias("xff"), F.lit(" 198.51.100.7").alias("x_real_ip"), F.lit("192.0.2.1").alias("remote_ip"), "received_at", "body")


def batch_requests_from(ad: DataFrame, first_batch: int = 1500, batch_len: int = 7) -> DataFrame:
    """Batch ingest requests: ``events`` is an array of event structs.

    Batch 0 holds the first ``first_batch`` events (over the 1000 limit from
    sf0.01 on), later batches ``batch_len`` each, and batch -1 is empty.
    The arrays are built by a grouped aggregation, bounded by construction
    (at most ``first_batch`` elements per row).
    """
    seq = F.col("seq")
    bid = F.when(seq < first_batch, F.lit(0)).otherwise(1 + F.floor((seq - first_batch) / batch_len)).cast("long")
    ev = F.struct(
        seq.alias("seq"), "event_id", "event_type", "user_id", "campaign_id", "geo_country", "device_type",
        F.when(seq % 17 != 0, F.col("created_at")).alias("created_at"), "meta_data",
    )
    batches = (
        ad.select(bid.alias("batch_id"), "created_at", ev.alias("ev"))
        .groupBy("batch_id")
        .agg(F.array_sort(F.collect_list("ev")).alias("events"), F.max("created_at").alias("received_at"))
    )
    empty = batches.sparkSession.range(1).select(
        F.lit(-1).cast("long").alias("batch_id"),
        F.filter(F.array(F.lit(None).cast(ev_schema(ad))), lambda x: x.isNotNull()).alias("events"),
        F.lit(None).cast("timestamp_ntz").alias("received_at"),
    )
    return batches.unionByName(empty).select(
        "batch_id",
        F.concat(F.lit("203.0.113."), (F.abs(F.col("batch_id")) % 250).cast("string")).alias("xff"),
        F.lit("").alias("x_real_ip"),
        F.lit("192.0.2.1").alias("remote_ip"),
        "events", "received_at",
    )


def ev_schema(ad: DataFrame) -> str:
    fields = ["seq", "event_id", "event_type", "user_id", "campaign_id",
              "geo_country", "device_type", "created_at", "meta_data"]
    return "struct<" + ",".join(f"{f}:{ad.schema[f].dataType.simpleString()}" for f in fields) + ">"


def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_requests_from(ad_events(spark, sf_dir))
