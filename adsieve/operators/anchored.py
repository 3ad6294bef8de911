"""Anchored windows: per-key windows that open at the first event and are
never refreshed.

Rule, per key in arrival order ``(ts, order)``: with no live window an event
opens ``[t0, t0 + W)`` at position 1; events inside it take the next
positions; the first event at ``t >= t0 + W`` opens the next window. This is
neither a tumbling, sliding nor session window, so ``window()`` cannot
express it, and it is sequential per key.

Distributed form (exact; neither a key nor a single window has to fit in one
task). A key's timeline is cut into slices of ``S = W / parts``, and rows are
shuffled once by ``(key, slice)``. A slice holds at most one anchor.

* *Summary.* Count, first and last time of every slice; along each key (a
  window over these narrow rows) the prefix counts, and where a gap of ``W``
  or more begins a *cluster*: its first event is an anchor whatever came
  before. A slice that ends within ``W`` of its cluster's start lies in the
  cluster's first window, so its answer is the prefix count. For keys that
  rarely repeat (event ids) that settles everything, in the JVM.
* *Nodes* (`_visit`), only for the other, *hard* slices: the next anchor after
  an anchor at ``t`` is the first event at or after ``t + W``, which lies at
  the same place of the next window. So events are grouped by ``(key, place of
  the slice in its window)``: such a group follows all chains that stay at its
  place, from the first event of every slice, and hands on each event it
  visits with its successor, or none where the chain leaves the slice. Chains
  that meet are one, so the work is linear.
* *Walk* (`_walk`), per key over slices and visited events: a chain that left
  its slice goes on at the first event of the next one. Gives every hard slice
  its anchor, the window it inherits and how many events that has.
* *Positions.* A row's number in its slice, plus the inherited count or minus
  the rows before the slice's anchor: a window function over the one shuffle.
  All columns pass through, so no join back is needed.

A window that holds 370 GB is thus ``parts`` slices of rows that are sorted and
numbered by as many tasks; Python sees 8-byte times of hard slices alone, one
slice at a time. The walk's rows per key are bounded by its slices and the
chains that do not meet, not by its events.

Rows outside ``counted`` take no part and get null position/anchor.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adsieve.functions import col_of, epoch_micros

try:  # ship the worker-side functions by value: executors need not install us
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass

_US = 1_000_000
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_MAX_COORD = 2 ** 62  # keys are laid one after the other on one axis, inside int64
_SEGMENT = 1 << 18  # rows that a task handles at once

_EVENTS = "_k string, _j long, _t long"
_NODES = "_k string, _t long, _u long, _before long, _next long"
_STATE = "_k string, _u long, _prev long, _carry long, _at long, _skip long"
NO_TIME = np.iinfo(np.int64).min


def _np(col) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False)


def _ids(*columns: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... for runs of equal rows."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _whole(batches: Iterator[pa.RecordBatch], group) -> Iterator[pa.Table]:
    """Tables of about ``_SEGMENT`` rows that end where a group ends; ``group``
    gives the group numbers of a table's rows."""
    held: list[pa.RecordBatch] = []
    rows = limit = 0
    for rb in batches:
        held.append(rb)
        rows += rb.num_rows
        if rows >= max(limit, _SEGMENT):
            table = pa.Table.from_batches(held).combine_chunks()
            g = group(table)
            cut = int(np.searchsorted(g, g[-1]))
            if cut:
                yield table.slice(0, cut)
                table = table.slice(cut)
            # a group that fills the table is looked at again when it has doubled
            held, rows, limit = table.to_batches(), table.num_rows, 2 * table.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


# ---------------------------------------------------------------------------
# visited events of the hard slices
# ---------------------------------------------------------------------------
def follow(gid: np.ndarray, t: np.ndarray, S: int, m: int, led: np.ndarray):
    """Events of groups (sorted by group and time) that chains visit. Chains
    begin at the first event of every slice; ``led`` holds times in the slice
    before the first one from which chains reach into it.

    Returns (index, slice, rows of the slice before it, next time or NO_TIME,
    next time of each of ``led``)."""
    W = S * m
    u = t // S
    low, span = int(t.min()) - 2 * W, int(t.max() - t.min()) + 4 * W
    if span * (int(gid[-1]) + 1) > _MAX_COORD:
        raise OverflowError("groups leave the axis")
    X = gid * span + (t - low)
    n = len(t)
    first = np.ones(n, bool)
    first[1:] = (gid[1:] != gid[:-1]) | (u[1:] != u[:-1])
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))

    def after(x: np.ndarray, g, own: np.ndarray) -> np.ndarray:
        """First event a window after ``x``, -1 unless in the next window's slice."""
        to = np.searchsorted(X, x + W)
        at = np.minimum(to, n - 1)
        return np.where((to < n) & (gid[at] == g) & (u[at] == own + m), at, -1)

    into = after(led - low, 0, led // S) if len(led) else np.empty(0, np.int64)
    seen = first.copy()
    seen[into[into >= 0]] = True
    front = np.flatnonzero(seen)
    while len(front):  # every event is visited once, however many chains meet in it
        to = after(X[front], gid[front], u[front])
        to = np.unique(to[to >= 0])
        front = to[~seen[to]]
        seen[front] = True
    node = np.flatnonzero(seen)
    to = after(X[node], gid[node], u[node])
    same = np.searchsorted(X, X[node])  # events of one time count from the first of them
    return (node, u[node], same - start[node], np.where(to >= 0, t[to], NO_TIME), np.where(into >= 0, t[into], NO_TIME))


def _visit(S: int, m: int):
    schema = pa.schema([("_k", pa.string()), ("_t", pa.int64()), ("_u", pa.int64()), ("_before", pa.int64()), ("_next", pa.int64())])

    def slices(table: pa.Table) -> np.ndarray:
        return _ids(_np(table["_k"]), _np(table["_j"]), _np(table["_t"]) // S)

    def rows(k, t, u, before, to) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(t), pa.array(u), pa.array(before), pa.array(to)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, place, and the events visited in the last slice, whose successors are still to come
        for table in _whole(batches, slices):
            k, j, t = _np(table["_k"]), _np(table["_j"]), _np(table["_t"])
            gid = _ids(k, j)
            per = max(1, _MAX_COORD // (int(t.max() - t.min()) + 4 * S * m) - 1)
            for a in range(0, int(gid[-1]) + 1, per):
                lo, hi = np.searchsorted(gid, [a, a + per])
                goes_on = last is not None and last[0] == k[lo] and last[1] == j[lo]
                if last is not None and not goes_on:
                    yield rows([last[0]] * len(last[2]), last[2], last[3], last[4], np.full(len(last[2]), NO_TIME))
                led = last[2] if goes_on else np.empty(0, np.int64)
                node, u, before, to, into = follow(gid[lo:hi] - a, t[lo:hi], S, m, led)
                if goes_on:
                    yield rows([last[0]] * len(led), led, last[3], last[4], into)
                open_ = (gid[lo:hi][node] == gid[hi - 1] - a) & (u == t[hi - 1] // S)
                done = ~open_
                yield rows(k[lo:hi][node[done]], t[lo:hi][node[done]], u[done], before[done], to[done])
                last = k[hi - 1], j[hi - 1], t[lo:hi][node[open_]], u[open_], before[open_]
        if last is not None:
            yield rows([last[0]] * len(last[2]), last[2], last[3], last[4], np.full(len(last[2]), NO_TIME))
    return run


# ---------------------------------------------------------------------------
# walk along each key
# ---------------------------------------------------------------------------
def walk(gid: np.ndarray, t: np.ndarray, u: np.ndarray, before: np.ndarray, to: np.ndarray, slices: tuple[np.ndarray, ...], S: int, m: int):
    """Anchors of keys, from visited events (``gid, t`` order; cluster starts
    among them) and the hard slices ``(gid, u, lo, cum, start, start_cum)``:
    first time, rows of the key before it, the same of the cluster's start.

    Returns (slice index, time of the window it inherits, rows that has,
    its anchor or NO_TIME, rows before that), where the anchor is not simply
    the slice's first event."""
    W = S * m
    g, su, lo, cum, start, start_cum = slices
    low, span = int(min(t.min(), start.min())) - W, int(max(t.max(), lo.max()) - min(t.min(), start.min())) + 4 * W
    X, L = gid * span + (t - low), g * span + (lo - low)
    n = len(t)
    # the slice a visited event is in; a cluster's start is in none of them
    at = np.minimum(np.searchsorted(L, X, side="right") - 1, len(L) - 1)
    inside = (at >= 0) & (g[at] == gid) & (su[at] == u)
    # a chain that leaves its slice goes on at the first event after it
    leave = np.searchsorted(L, gid * span + ((u + m + 1) * S - low))
    there = np.minimum(leave, len(L) - 1)
    goes = (leave < len(L)) & (g[there] == gid) & (start[there] <= t)  # of the same cluster
    jump = np.where(goes, np.searchsorted(X, L[there]), n)
    nxt = np.where(to != NO_TIME, np.searchsorted(X, gid * span + (to - low)), jump)
    anchor = np.zeros(n, bool)
    here = np.unique(np.searchsorted(X, g * span + (start - low)))
    while len(here):
        anchor[here] = True
        here = nxt[here]
        here = np.unique(here[here < n])
        here = here[~anchor[here]]
    a = np.flatnonzero(anchor)
    A = X[a]
    # rows of the key before each anchor
    head = np.minimum(np.searchsorted(g * span + (start - low), A), len(g) - 1)
    rank = np.where(inside[a], cum[at[a]] + before[a], start_cum[head])
    own = np.minimum(np.searchsorted(A, L), len(a) - 1)
    has = (A[own] >= L) & (gid[a[own]] == g) & (u[a[own]] == su)
    prev = np.searchsorted(A, L) - 1
    keep = ~(has & (t[a[own]] == lo))
    return (np.flatnonzero(keep), t[a[prev]][keep], (cum - rank[prev])[keep],
            np.where(has, t[a[own]], NO_TIME)[keep], np.where(has, before[a[own]], 0)[keep])


def _walk(S: int, m: int):
    schema = pa.schema([("_k", pa.string())] + [(c, pa.int64()) for c in ("_u", "_prev", "_carry", "_at", "_skip")])

    def keys(table: pa.Table) -> np.ndarray:
        return _ids(_np(table["_k"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, keys):
            gid, k = keys(table), _np(table["_k"])
            c = {name: _np(table[name].fill_null(NO_TIME)).astype(np.int64) for name in ("_t", "_u", "_before", "_next", "_cum", "_start", "_start_cum")}
            per = max(1, _MAX_COORD // (int(c["_t"].max() - c["_t"].min()) + 8 * S * m) - 1)
            for a in range(0, int(gid[-1]) + 1, per):
                part = slice(*np.searchsorted(gid, [a, a + per]))
                v = {name: x[part] for name, x in c.items()}
                hard = v["_cum"] != NO_TIME
                node, own = ~hard, gid[part] - a
                found, prev, carry, at, skip = walk(
                    own[node], v["_t"][node], v["_u"][node], v["_before"][node], v["_next"][node],
                    tuple(x[hard] for x in (own, v["_u"], v["_t"], v["_cum"], v["_start"], v["_start_cum"])), S, m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[part][hard][found], pa.string()), pa.array(v["_u"][hard][found]), pa.array(prev), pa.array(carry),
                     pa.array(at, mask=at == NO_TIME), pa.array(skip)], schema=schema)
    return run


def walk_sorted(t: np.ndarray, reach: int | None, carry: int, W: int):
    """Positions and anchors of one key's sorted times, given the live
    window's reach (``anchor + W``, or None) and its count so far.

    Returns (pos, anchor, last_anchor, last_count). Vectorised: one
    ``searchsorted`` per window, not one step per row.
    """
    n = len(t)
    pos = np.empty(n, dtype=np.int64)
    anc = np.empty(n, dtype=np.int64)
    i = 0
    if reach is not None:
        i = int(np.searchsorted(t, reach, side="left"))
        pos[:i] = carry + np.arange(1, i + 1)
        anc[:i] = reach - W
    while i < n:
        j = int(np.searchsorted(t, t[i] + W, side="left"))
        pos[i:j] = np.arange(1, j - i + 1)
        anc[i:j] = t[i]
        i = j
    if n == 0:
        return pos, anc, (None if reach is None else reach - W), carry
    return pos, anc, int(anc[-1]), int(pos[-1])


# ---------------------------------------------------------------------------
# public operator
# ---------------------------------------------------------------------------
def window_slices(window_s: int, parts: int) -> tuple[int, int]:
    """(slice length in microseconds, slices of a window): the largest number
    up to ``parts`` that divides the window."""
    W = int(window_s) * _US
    m = next(p for p in range(min(int(parts), W), 0, -1) if W % p == 0)
    return W // m, m


def slice_state(events: DataFrame, S: int, m: int) -> DataFrame:
    """State of the slices of ``events (_k, _u, _t)`` whose anchor is not simply
    their first event: inherited window ``_prev`` with ``_carry`` rows, own
    anchor ``_at`` (null: none) after ``_skip`` rows."""
    W = S * m
    along = Window.partitionBy("_k").orderBy("_u")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = F.col
    told = (
        events.where("_k is not null").groupBy("_k", "_u").agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
        .select("*", F.lag("_hi").over(along).alias("_last"), (F.sum("_n").over(so_far) - c("_n")).alias("_cum"))
        .withColumn("_fresh", c("_last").isNull() | (c("_lo") - c("_last") >= W))
        .select("*", F.last(F.when(c("_fresh"), c("_lo")), True).over(so_far).alias("_start"),
                F.last(F.when(c("_fresh"), c("_cum")), True).over(so_far).alias("_start_cum"))
        .where(~c("_fresh"))
    )
    none = F.lit(None).cast("long")
    hard = c("_hi") >= c("_start") + W
    easy = told.where(~hard).select("_k", "_u", c("_start").alias("_prev"), (c("_cum") - c("_start_cum")).alias("_carry"), none.alias("_at"), F.lit(0).cast("long").alias("_skip"))
    rough = told.where(hard)
    # the cluster's start leads its chain: once, with the first hard slice
    begins = rough.where(c("_last") < c("_start") + W).select("_k", c("_start").alias("_t"))
    inner = events.join(rough.select("_k", "_u"), ["_k", "_u"], "left_semi").select("_k", "_t").unionByName(begins) \
        .withColumn("_j", F.expr(f"pmod((_t - pmod(_t, {S})) div {S}, {m})"))
    nodes = inner.repartition("_k", "_j").sortWithinPartitions("_k", "_j", "_t").select("_k", "_j", "_t").mapInArrow(_visit(S, m), _NODES)
    both = nodes.select("*", *(none.alias(x) for x in ("_cum", "_start", "_start_cum"))).unionByName(
        rough.select("_k", c("_lo").alias("_t"), "_u", none.alias("_before"), none.alias("_next"), "_cum", "_start", "_start_cum"))
    walked = both.repartition("_k").sortWithinPartitions("_k", "_t").mapInArrow(_walk(S, m), _STATE)
    return easy.unionByName(walked)


def anchored_positions(
    df: DataFrame,
    key: str | Column,
    window_s: int,
    ts: str | Column = "created_at",
    order: str | Column = "seq",
    counted: Column | None = None,
    pos_col: str = "pos",
    anchor_col: str | None = "anchor_ts",
    parts: int = 16,
    spread: int = 1 << 16,
) -> DataFrame:
    """Add the anchored-window position (1-based) and anchor time per row.

    ``key``: grouping key; ``ts``/``order``: arrival order with tie-break;
    ``counted``: rows that take part (others get nulls and never form state);
    ``parts``: slices that a window is cut into, so many tasks share a hot one;
    ``spread``: how many slices the non-counted rows are spread over.
    """
    S, m = window_slices(window_s, parts)
    cnt = F.lit(True) if counted is None else counted
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    t = epoch_micros(ts)
    k = F.when(cnt & col_of(key).isNotNull() & t.isNotNull(), col_of(key).cast("string"))
    # one projection (each DataFrame step re-analyses the whole plan)
    base = df.select("*", t.alias("_t"), col_of(order).cast("long").alias("_o"), k.alias("_k")).select(
        "*", F.when(F.col("_k").isNotNull(), F.expr(f"(_t - pmod(_t, {S})) div {S}"))
        .otherwise(F.pmod(F.xxhash64("_o"), F.lit(spread))).alias("_u"))
    # the one wide shuffle: summary, hard slices and positions all read it
    rows = base.repartition("_k", "_u")
    state = slice_state(rows.select("_k", "_u", "_t"), S, m)
    here = Window.partitionBy("_k", "_u").orderBy("_t", "_o")
    numbered = rows.select("*", F.row_number().over(here).cast("long").alias("_rn"), F.first("_t").over(here).alias("_lo"))
    placed = numbered.join(state, ["_k", "_u"], "left")
    c = F.col
    inherits = c("_prev").isNotNull() & (c("_at").isNull() | (c("_t") < c("_at")))
    pos = F.when(c("_k").isNull(), F.lit(None)).when(inherits, c("_carry") + c("_rn")).otherwise(c("_rn") - F.coalesce("_skip", F.lit(0).cast("long")))
    anchor = F.when(c("_k").isNull(), F.lit(None)).when(inherits, c("_prev")).otherwise(F.coalesce("_at", "_lo"))
    keep = [*cols, pos.alias(pos_col)]
    if anchor_col:
        keep.append(F.timestamp_add("MICROSECOND", anchor, F.expr(_EPOCH_NTZ)).alias(anchor_col))
    return placed.select(*keep)
