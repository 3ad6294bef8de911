"""Anchored windows as Structured Streaming state (``transformWithStateInPandas``).

Per key the state is ``(anchor, count)`` of the live window. Each
micro-batch's rows of a key are taken in ``(arrival, order)`` order; a row at
or after ``anchor + W`` opens a new window. Rows that are not counted pass
through without touching state and are keyed by a spread bucket so they
never pile up on one task or create state.

State is kept for good by default: the window test compares arrival times, so
old state never changes a result, and a stream that stood still for days gives
the answer of an unbroken one. A caller who knows the longest stop can set a
processing-time TTL beyond the window plus that time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adsieve.functions import col_of, epoch_micros
from adsieve.operators.anchored import walk_sorted

try:  # workers need not install the package
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass

_US = 1_000_000
_STATE_SCHEMA = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("count", T.LongType())])


class AnchoredWindowProcessor(StatefulProcessor):
    def __init__(self, window_s: int, ttl_ms: int | None, out_cols: list[str]):
        self.W = int(window_s) * _US
        self.ttl_ms = ttl_ms
        self.out_cols = out_cols

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.win = handle.getValueState("window", _STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.sort_values(["aw_t", "aw_o"], kind="stable").reset_index(drop=True)
        counted = pdf["aw_counted"].fillna(False).values.astype(bool)
        t = pdf["aw_t"].fillna(0).values.astype(np.int64)
        n = len(pdf)
        pos = np.zeros(n, dtype=np.int64)
        anc = np.zeros(n, dtype=np.int64)
        if counted.any():
            reach, carry = None, 0
            if self.win.exists():
                st = self.win.get()
                reach, carry = int(st[0]) + self.W, int(st[1])
            rows_c = np.flatnonzero(counted)
            p, a, last_a, last_n = walk_sorted(t[rows_c], reach, carry, self.W)
            pos[rows_c], anc[rows_c] = p, a
            self.win.update((last_a, last_n))
        out = pdf[self.out_cols].copy()
        out["aw_pos"] = pd.array(pos, dtype="Int64")
        out["aw_anchor"] = pd.array(anc, dtype="Int64")
        out.loc[~counted, ["aw_pos", "aw_anchor"]] = pd.NA
        yield out

    def close(self) -> None:
        pass


def stateful_anchored(
    df: DataFrame, key: str | Column, window_s: int, counted: Column, pos_col: str,
    ts: str | Column = "arrival", order: str | Column = "seq", ttl_ms: int | None = None,
    spread: int = 1024,
) -> DataFrame:
    """Streaming twin of :func:`adsieve.operators.anchored.anchored_positions`."""
    cols = df.columns
    base = (
        df.withColumn("aw_t", epoch_micros(ts))
        .withColumn("aw_o", col_of(order).cast("long"))
        .withColumn("aw_counted", F.coalesce(counted & col_of(key).isNotNull(), F.lit(False)))
    )
    base = base.withColumn(
        "aw_skey",
        F.when(F.col("aw_counted"), F.concat(F.lit("k:"), col_of(key).cast("string")))
        .otherwise(F.concat(F.lit("~"), F.pmod(F.xxhash64("aw_o"), F.lit(spread)).cast("string"))),
    )
    out_schema = T.StructType(
        list(df.schema.fields)
        + [T.StructField("aw_pos", T.LongType()), T.StructField("aw_anchor", T.LongType())]
    )
    res = base.groupBy("aw_skey").transformWithStateInPandas(
        statefulProcessor=AnchoredWindowProcessor(window_s, ttl_ms, cols),
        outputStructType=out_schema,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )
    return res.withColumnRenamed("aw_pos", pos_col).drop("aw_anchor")
