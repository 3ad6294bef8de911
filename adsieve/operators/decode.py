"""Strict decode of topic messages and the wire ↔ event projections.

A message decodes only when it is a JSON object (or the bare ``null``) whose
string fields hold strings or null, whose ``timestamp`` is an RFC 3339 text
or null and whose ``meta_data`` is an object or null. Anything else is
malformed: skipped and not counted as failed; no message makes the job fail.
JSON null and missing keys decode to the empty string. Keys match in any case.
Of repeated keys (also inside ``meta_data``) the last value that is not null
stands, and each of them must have the right type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.functions import strict_rfc3339, utc_offset, wall_clock

STRING_FIELDS = ["event_id", "event_type", "user_id", "campaign_id", "geo_country", "device_type", "ip_address"]
JSON_OPTIONS = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _text(c: Column) -> Column:
    return F.variant_get(c, "$", "string")


def _entry_ok(e: Column, time_field: str) -> Column:
    """A key's value has the type of its field; other keys are ignored."""
    text = F.to_json(e["v"])  # a string's text starts with a quote, an object's with a brace
    return (
        F.when(e["v"].isNull() | F.is_variant_null(e["v"]), True)
        .when(e["k"].isin(STRING_FIELDS), text.startswith('"'))
        .when(e["k"] == time_field, text.startswith('"') & F.coalesce(strict_rfc3339(_text(e["v"])), F.lit(False)))
        .when(e["k"] == "meta_data", text.startswith("{"))
        .otherwise(True)
    )


def lower_entries(fields: Column) -> Column:
    """Entries ``(k, v)`` of a JSON object with lower-case keys, in order."""
    return F.transform(F.map_entries(fields), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v")))


def entries_ok(entries: Column, time_field: str = "timestamp") -> Column:
    return F.forall(entries, lambda e: _entry_ok(e, time_field))


def known_fields(entries: Column) -> Column:
    """Values by lower-case key; the last one that is not null stands."""
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull() & ~F.is_variant_null(e["v"])))


def field_columns(known: Column, time_field: str = "timestamp") -> list[Column]:
    """The event's fields out of its known values."""
    at = lambda f: F.try_element_at(known, F.lit(f))
    cols = [F.coalesce(_text(at(f)), F.lit("")).alias(f) for f in STRING_FIELDS]
    cols.append(_text(at(time_field)).alias(time_field))
    meta = F.to_json(at("meta_data"))
    cols.append(F.when(meta.startswith("{"), meta).alias("meta_data"))
    return cols


def one_value(text: Column) -> Column:
    """Exactly one JSON value: the parsers accept trailing text (``{...} x``,
    two objects back to back), the reproduced decoder does not."""
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))


def _is(v: Column, kind: str) -> Column:
    """The value is missing, null, or of ``kind`` (as its schema names it)."""
    return v.isNull() | F.is_variant_null(v) | F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def decode(df: DataFrame, value: str = "value", time_field: str = "timestamp") -> DataFrame:
    """Add the decoded wire fields and a ``malformed`` flag to each message.

    Two lanes. Every message is parsed into a struct of its nine fields
    (compiled code). Only messages that spell a key with capitals or repeat one
    are parsed into a map as well, and checked entry by entry."""
    names = [*STRING_FIELDS, time_field, "meta_data"]
    text = F.col(value)
    fields = ", ".join(f"{f} variant" for f in names) + ", _bad string"
    parsed = df.select("*", F.from_json(text, fields, {**JSON_OPTIONS, "columnNameOfCorruptRecord": "_bad"}).alias("_s"),
                       F.json_object_keys(text).alias("_keys"), one_value(text).alias("_one"))
    spelled = F.array_join("_keys", "\n")
    odd = (F.size("_keys") != F.size(F.array_distinct("_keys"))) | (F.lower(spelled) != spelled)
    entries = F.when(odd, lower_entries(F.from_json(text, "map<string,variant>", JSON_OPTIONS)))
    parsed = parsed.select("*", entries.alias("_e"), F.coalesce(odd, F.lit(False)).alias("_odd"))
    one = {f: F.col(f"_s.{f}") for f in names}
    at = F.try_variant_get(one[time_field], "$", "string")
    plain = (F.col("_keys").isNotNull() & F.col("_s._bad").isNull() & _is(one["meta_data"], "OBJECT") & _is(one[time_field], "STRING")
             & (at.isNull() | F.coalesce(strict_rfc3339(at), F.lit(False))))
    for f in STRING_FIELDS:
        plain = plain & _is(one[f], "STRING")
    bare_null = text.rlike(r"^[ \t\r\n]*null[ \t\r\n]*$")
    ok = F.when(F.col("_odd"), F.col("_e").isNotNull() & entries_ok(F.col("_e"), time_field)).when(F.col("_keys").isNull(), bare_null).otherwise(plain)
    parsed = parsed.select("*", F.when(F.col("_odd"), known_fields(F.col("_e"))).alias("_m"), (F.col("_one") & F.coalesce(ok, F.lit(False))).alias("_ok"))
    slow = dict(zip(names, field_columns(F.col("_m"), time_field)))
    meta = F.when(~F.is_variant_null(one["meta_data"]), F.to_json(one["meta_data"]))
    fast = {f: F.coalesce(F.try_variant_get(one[f], "$", "string"), F.lit("")) for f in STRING_FIELDS} | {time_field: at, "meta_data": meta}
    keep = [c for c in df.columns if c not in [*names, value]]
    # a malformed message has no fields
    return parsed.select(*keep, *(F.when(F.col("_odd"), slow[f]).when(F.col("_ok"), fast[f]).alias(f) for f in names), (~F.col("_ok")).alias("malformed"))


def rows_where(df: DataFrame, condition: Column, cols: list[str]) -> DataFrame:
    """``cols`` of the decoded rows that meet ``condition``.

    The keep/drop step is a 0-or-1-row generator over the decoded struct
    rather than a filter: a filter on the flag would be pushed below the
    decode projection and parse every message again, once for each use of a
    parsed column.
    """
    packed = F.when(condition, F.array(F.struct(*cols)))
    return df.select(F.inline(packed)).select(*cols)


def decode_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages that decode; malformed ones are dropped."""
    d = decode(df, value)
    return rows_where(d, ~F.col("malformed"), [c for c in d.columns if c != "malformed"])


def malformed_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages skipped by the decoder (kept for inspection)."""
    cols = [c for c in df.columns if c != value]
    flagged = decode(df.withColumn("_raw", F.col(value)), value)
    return rows_where(flagged, F.col("malformed"), [*cols, "_raw"]).withColumnRenamed("_raw", value)


def to_wire(df: DataFrame) -> DataFrame:
    """Ingest record → wire record (``created_at`` is sent as ``timestamp``)."""
    return df.withColumnRenamed("created_at", "timestamp")


def to_raw_event(df: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Wire record → processed event.

    ``created_at`` is the wall clock of ``timestamp`` (as a zone-less
    timestamp column stores it) and ``created_offset`` keeps its offset for
    re-encoding; a missing timestamp takes the arrival time, which stands in
    for "now".
    """
    created = F.coalesce(wall_clock(F.col("timestamp")), F.col(arrival).cast("timestamp_ntz"))
    return df.withColumn("created_at", created).withColumn(
        "created_offset", utc_offset(F.col("timestamp"))).drop("timestamp")
