"""Strict decode == a plain-Python model of the reproduced decoder, on
random messages (types, missing and duplicate keys, trailing text)."""

import datetime as dt
import json
import random
import re

from adsieve.operators import decode as D

STRING_FIELDS = D.STRING_FIELDS
TIME = re.compile(r"(\d{4}-\d{2}-\d{2})T(\d{2}:\d{2}:\d{2})(?:\.\d+)?(?:Z|[+-](\d{2}):(\d{2}))", re.ASCII)


def _bad_constant(x):
    raise ValueError(x)


def _time_ok(text):
    m = TIME.fullmatch(text)
    try:
        dt.datetime.strptime(f"{m[1]} {m[2]}", "%Y-%m-%d %H:%M:%S")
    except (TypeError, ValueError):
        return False
    return m[3] is None or (int(m[3]) < 24 and int(m[4]) < 60)


def model(text):
    """None when malformed, else the decoded field dict."""
    try:
        obj = json.loads(text, object_pairs_hook=list, parse_constant=_bad_constant)
    except ValueError:
        return None
    if obj is None:
        obj = []
    # an object is a list of pairs here; arrays are told apart by their text
    if not isinstance(obj, list) or (text.strip() != "null" and not text.strip().startswith("{")):
        return None
    out = dict.fromkeys(STRING_FIELDS, "") | {"timestamp": None}
    for key, value in obj:
        key = key.lower()
        if value is None:
            continue  # null leaves what stands
        if key in STRING_FIELDS:
            if not isinstance(value, str):
                return None
            out[key] = value
        elif key == "timestamp":
            if not (isinstance(value, str) and _time_ok(value)):
                return None
            out[key] = value
        elif key == "meta_data" and not (isinstance(value, list) and all(isinstance(x, tuple) for x in value)):
            return None
    return out


def _value(rnd):
    return rnd.choice(['"v%d"' % rnd.randint(0, 9), '""', "null", "12", "1.5", "true", '{"x":1}', "[1]",
                       '"2024-01-02T03:04:05Z"', '"2024-02-30T03:04:05Z"', '"2024-01-02T03:04:60Z"', '"2024-01-02t03:04:05Z"',
                       '"2024-01-02T03:04:05.1234567890123+23:59"', '"2024-01-02T03:04:05-24:00"', '"2024-01-02T03:04:05.123+05:30"', '"yesterday"'])


def _message(rnd):
    kind = rnd.random()
    if kind < 0.04:
        return rnd.choice(["", "  ", "null", "[1,2]", "not json", '"s"', "7"])
    keys = rnd.sample(STRING_FIELDS + ["timestamp", "meta_data", "extra"], rnd.randint(0, 9))
    # texts where the field wants one, most of the time
    value = lambda k: '"2024-01-02T03:04:05Z"' if k == "timestamp" else '{"y":1,"y":2}' if k == "meta_data" else '"ok"'
    pick = lambda k: value(k) if rnd.random() < 0.8 else _value(rnd)
    spell = lambda k: rnd.choice([k, k, k, k.upper(), k.title()])
    parts = [f'"{spell(k)}":{pick(k)}' for k in keys]
    if parts and rnd.random() < 0.2:
        parts.append(f'"{spell(keys[0])}":{pick(keys[0])}')  # repeated key
    body = "{" + ",".join(parts) + "}"
    r = rnd.random()
    if r < 0.05:
        body += " x"
    elif r < 0.08:
        body += body
    elif r < 0.12:
        body = "  " + body + " "
    return body


def test_decode_matches_model(spark):
    rnd = random.Random(5)
    msgs = [(i, _message(rnd)) for i in range(800)]
    df = spark.createDataFrame(msgs, "seq long, value string")
    got = {r["seq"]: r.asDict() for r in D.decode_messages(df).collect()}
    for seq, text in msgs:
        want = model(text)
        if want is None:
            assert seq not in got, (text, got.get(seq))
        else:
            assert seq in got, text
            row = got[seq]
            for f in STRING_FIELDS + ["timestamp"]:
                assert row[f] == want[f], (text, f, row[f], want[f])
    assert 100 < len(got) < len(msgs) - 100
