"""Scalar column expressions. Pure ``pyspark.sql.functions``; no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "go_trim", "blank", "nz", "hour_bucket", "current_hour", "epoch_micros",
    "client_ip", "onehot", "archive_time_parts", "json_null_text",
    "strict_rfc3339", "wall_clock", "utc_offset", "rfc3339_nano",
]



def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# the characters of Unicode's White_Space property (fixed values)
_WHITE = r"[\u0009-\u000D\u0020\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def go_trim(c) -> Column:
    """Trim all leading/trailing white space, Unicode's included."""
    return F.regexp_replace(col_of(c), f"^{_WHITE}+|{_WHITE}+$", "")


def blank(c) -> Column:
    """True when the value is null or only white space."""
    return F.coalesce(go_trim(c) == "", F.lit(True))


def nz(c) -> Column:
    """Missing string → empty string, as a decoded struct field would be."""
    return F.coalesce(col_of(c), F.lit(""))


def hour_bucket(ts) -> Column:
    """Truncate to the hour on the wall clock; result stays timestamp_ntz."""
    return F.date_trunc("hour", col_of(ts).cast("timestamp_ntz")).cast("timestamp_ntz")


def current_hour(as_of=None) -> Column:
    """Hour bucket of the current wall-clock time (session time zone), or of
    ``as_of``."""
    return hour_bucket(F.localtimestamp() if as_of is None else as_of)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (NTZ) timestamp.

    Computed without the session time zone, so DST never bends the ordering.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, col_of(ts).cast("timestamp_ntz"))


def client_ip(xff, x_real_ip, remote) -> Column:
    """First X-Forwarded-For entry, else X-Real-IP, else the peer address.

    A non-empty X-Forwarded-For wins even when its first entry is blank.
    """
    xff, xri = nz(xff), nz(x_real_ip)
    return (
        F.when(xff != "", go_trim(F.split(xff, ",", -1).getItem(0)))
        .when(xri != "", go_trim(xri))
        .otherwise(nz(remote))
    )


def onehot(event_type) -> tuple[Column, Column, Column]:
    et = col_of(event_type)
    return (
        (et == "impression").cast("long").alias("impressions"),
        (et == "click").cast("long").alias("clicks"),
        (et == "conversion").cast("long").alias("conversions"),
    )


def archive_time_parts(ts) -> list[Column]:
    """year/month/day/hour path parts (zero padded strings) of a timestamp."""
    ts = col_of(ts)
    return [
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
        F.date_format(ts, "HH").alias("hour"),
    ]


def json_null_text(c) -> Column:
    """JSON text of an optional object; an absent object is the literal null."""
    return F.coalesce(col_of(c), F.lit("null"))


# RFC 3339 date-time with a mandatory offset (Z or ±hh:mm), fraction of any
# length; hours below 24, minutes and seconds below 60. The calendar date is
# checked apart.
_RFC3339 = (r"^\d{4}-\d{2}-\d{2}T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?"
            r"(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$")


def strict_rfc3339(c) -> Column:
    """True for an RFC 3339 text that names an existing time; never throws."""
    txt = col_of(c)
    return txt.rlike(_RFC3339) & F.substring(txt, 1, 10).try_cast("date").isNotNull()


def wall_clock(c) -> Column:
    """Local wall-clock time of an RFC 3339 text, offset ignored (microsecond
    precision), as ``timestamp_ntz``; null for anything else."""
    txt = col_of(c)
    frac = F.regexp_extract(txt, r"^\S{19}\.(\d+)", 1)
    frac6 = F.substring(F.concat(frac, F.lit("000000")), 1, 6)
    parts = F.concat(F.substring(txt, 1, 10), F.lit(" "), F.substring(txt, 12, 8), F.lit("."), frac6)
    return F.when(strict_rfc3339(txt), parts.try_cast("timestamp_ntz"))


def utc_offset(c) -> Column:
    """The offset part (``Z`` or ``±hh:mm``) of an RFC 3339 text."""
    return F.nullif(F.regexp_extract(col_of(c), r"(Z|[+-]\d{2}:\d{2})$", 1), F.lit(""))


def rfc3339_nano(ts, offset=None) -> Column:
    """Wall-clock time as RFC 3339 with nanosecond style: trailing zeros of
    the fraction are dropped (and the fraction when zero); the offset is the
    event's own (``Z`` when unknown)."""
    base = F.date_format(col_of(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    trimmed = F.regexp_replace(F.regexp_replace(base, "0+$", ""), r"\.$", "")
    off = F.lit("Z") if offset is None else F.coalesce(F.upper(col_of(offset)), F.lit("Z"))
    return F.concat(trimmed, off)
