"""Dedupe, IP-window scoring and the status router."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.config import DEFAULT_SCORING, ScoringConfig
from adsieve.functions import blank
from adsieve.operators.history import DEDUPE, Carried, WindowHistory, positions, windows_of
from adsieve.operators.validate import valid_events, validate_events


@dataclass(frozen=True)
class WindowCounter:
    """State that a scorer declares: how many unique events an anchored window
    of ``key`` holds. The counter is carried by name through batch history and
    stream state, and reaches the score as the column ``{name}_pos``."""

    name: str
    key: str
    window_s: Callable[[ScoringConfig], int] = lambda cfg: cfg.ip_window_s

    @property
    def pos(self) -> str:
        return f"{self.name}_pos"

    @property
    def anchor(self) -> str:
        return f"{self.name}_anchor"

    def counted(self) -> Column:
        """Unique events whose key is not blank touch the counter."""
        return F.coalesce(F.col("dup_pos") == 1, F.lit(False)) & ~blank(self.key)


@dataclass(frozen=True)
class WindowScorer:
    """A scorer with declared state: its counters, and the score of a unique
    event as a column over them."""

    windows: tuple[WindowCounter, ...]
    score: Callable[[ScoringConfig], Column]

    def finish(self, df: DataFrame, cfg: ScoringConfig) -> DataFrame:
        unique = F.coalesce(F.col("dup_pos") == 1, F.lit(False))
        return df.withColumn("risk_score", F.when(unique, self.score(cfg)).otherwise(F.lit(0)).cast("int"))


Keep = Callable[[DataFrame, str], DataFrame]
# a plain function keeps no state between batches: it scores each batch alone
Scorer = WindowScorer | Callable[[DataFrame, ScoringConfig], DataFrame]


def mark_duplicates(df: DataFrame, cfg: ScoringConfig = DEFAULT_SCORING, counted: Column | None = None,
                    history: Carried | None = None) -> DataFrame:
    """``dup_pos`` = position in the event_id window; ``is_duplicate`` = pos > 1.

    Duplicates are kept (they are archived), not dropped. ``history`` holds
    the marks that earlier batches left.
    """
    out = positions(
        df, history, "event_id", cfg.dedupe_ttl_s, ts=cfg.arrival_col,
        counted=F.lit(True) if counted is None else counted, pos_col="dup_pos",
        anchor_col="dup_anchor", parts=cfg.dedupe_parts,
    )
    return out.withColumn("is_duplicate", F.col("dup_pos") > 1)


def count_window(df: DataFrame, window: WindowCounter, cfg: ScoringConfig = DEFAULT_SCORING, counted: Column | None = None,
                 history: Carried | None = None) -> DataFrame:
    """Position and anchor of each counted row in its window."""
    return positions(
        df, history, window.key, window.window_s(cfg), ts=cfg.arrival_col, counted=window.counted() if counted is None else counted,
        pos_col=window.pos, anchor_col=window.anchor, parts=cfg.ip_parts,
    )


def ip_window_count(df: DataFrame, cfg: ScoringConfig = DEFAULT_SCORING, counted: Column | None = None,
                    history: Carried | None = None) -> DataFrame:
    """``ip_pos`` = counter value the event sees in its IP's window.

    Only ``counted`` rows (default: non-blank IP) touch the counter; the key
    is the untrimmed address. ``history`` holds the counters that earlier
    batches left.
    """
    return count_window(df, IP_COUNTER, cfg, ~blank("ip_address") if counted is None else counted & ~blank("ip_address"), history)


def risk_score_col(cfg: ScoringConfig = DEFAULT_SCORING) -> Column:
    """Blank IP → 0; counter above threshold → fraud score; else 10."""
    return (
        F.when(blank("ip_address"), F.lit(cfg.blank_ip_score))
        .when(F.col("ip_pos") > cfg.ip_threshold, F.lit(cfg.fraud_score))
        .otherwise(F.lit(cfg.non_fraud_score))
        .cast("int")
    )


IP_COUNTER = WindowCounter("ip", "ip_address")
# default: the IP counter against its threshold
window_scorer = WindowScorer((IP_COUNTER,), risk_score_col)


def _scored(df: DataFrame, cfg: ScoringConfig, scorer: Scorer, history: WindowHistory, keep: Keep) -> DataFrame:
    if not isinstance(scorer, WindowScorer):
        if history:
            warnings.warn("a plain scoring function keeps no state between batches; declare a WindowScorer for that", stacklevel=3)
        return scorer(df, cfg)
    for window in scorer.windows:
        df = count_window(keep(df, window.name), window, cfg, history=history.get(window.name))
    return scorer.finish(df, cfg)


def history_of(routed: DataFrame, scorer: Scorer = window_scorer) -> dict[str, DataFrame]:
    """The windows a routed batch leaves behind, by name."""
    left = {DEDUPE: windows_of(routed, "event_id", "dup_pos", "dup_anchor")}
    if isinstance(scorer, WindowScorer):
        left |= {w.name: windows_of(routed, w.key, w.pos, w.anchor) for w in scorer.windows}
    return left


def window_lengths(cfg: ScoringConfig, scorer: Scorer = window_scorer) -> dict[str, int]:
    """Seconds of every window, by name."""
    own = scorer.windows if isinstance(scorer, WindowScorer) else ()
    return {DEDUPE: cfg.dedupe_ttl_s} | {w.name: w.window_s(cfg) for w in own}


def status_col(cfg: ScoringConfig) -> Column:
    return (
        F.when(F.col("dup_pos").isNull(), "rejected")
        .when(F.col("dup_pos") > 1, "duplicate")
        .when(F.col("risk_score") > cfg.fraud_cut, "fraud")
        .otherwise("accepted")
    )


def classify(
    df: DataFrame, cfg: ScoringConfig = DEFAULT_SCORING, scorer: Scorer = window_scorer,
    keep_rejected: bool = False, history: WindowHistory | None = None, keep: Keep = lambda df, name: df,
) -> DataFrame:
    """Route events to duplicate / fraud / accepted.

    One linear plan: validate → dedupe → score (unique rows only) → status.
    Invalid events never touch the dedupe or IP state. With
    ``keep_rejected`` they stay in the output with status ``rejected`` (and
    ``reject_field``/``reject_message``) instead of being filtered out.
    ``scorer`` is pluggable: a `WindowScorer` declares the counters it needs;
    a plain function receives rows with ``dup_pos`` and adds an int
    ``risk_score`` (0 for duplicates). ``history`` continues the windows of
    earlier batches, the scorer's counters included. ``keep`` may store the
    rows that a counter reads, as it reads them more than once, a few columns
    at a time.
    """
    history = history or {}
    if keep_rejected:
        dd = mark_duplicates(validate_events(df), cfg, counted=F.col("reject_field").isNull(), history=history.get(DEDUPE))
    else:
        dd = mark_duplicates(valid_events(df), cfg, history=history.get(DEDUPE))
    return _scored(dd, cfg, scorer, history, keep).withColumn("status", status_col(cfg))
