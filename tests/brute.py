"""Plain-Python reference of the anchored window rule (for tests only)."""

from __future__ import annotations


def anchored(rows, window):
    """rows: iterable of (key, t, order); returns {order: (pos, anchor_t)}.

    Per key in (t, order) order: no live window → open [t, t+window) at
    position 1; inside → next position; t >= anchor + window → new window.
    """
    out = {}
    state = {}
    for key, t, o in sorted(rows, key=lambda r: (r[1], r[2])):
        st = state.get(key)
        if st is None or t >= st[0] + window:
            st = [t, 0]
            state[key] = st
        st[1] += 1
        out[o] = (st[1], st[0])
    return out
