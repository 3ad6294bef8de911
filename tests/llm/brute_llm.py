"""Plain-Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter

WS = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in WS.split(text or "") if w]


def exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(WS.sub("", t or "").encode()).hexdigest(), []).append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), min(g)[1] == i, k) for k, g in groups.items() for _, i in g}


def substrings(rows, width, tag=lambda text: text or ""):
    """By (id, text): different texts of one id are documents of their own, in
    the order that ``tag`` gives them."""
    seen, out = set(), {}
    for i, _, t in sorted({(i, tag(t), t or "") for i, t in rows}):
        w, gone = words(t), set()
        for p in range(len(w) - width + 1):
            if tuple(w[p: p + width]) in seen:
                gone.update(range(p, p + width))
            seen.add(tuple(w[p: p + width]))
        out[i, t] = (len(w), len(gone), [x for k, x in enumerate(w) if k not in gone])
    return out


def reach(ids, near):
    comp = {}
    for i in sorted(ids):
        if i in comp:
            continue
        comp[i], stack = i, [i]
        while stack:
            for v in near[stack.pop()]:
                if v not in comp:
                    comp[v] = i
                    stack.append(v)
    return comp


def jaccard(rows, threshold=0.8, width=5):
    sets = {i: frozenset(tuple(w[k: k + width]) for k in range(max(1, len(w) - width + 1))) if (w := words(t)) else frozenset() for i, t in rows}
    near = {i: [j for j in sets if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-12] for i in sets}
    comp = reach(sets, near)
    return {i: (len(near[i]), comp[i], comp[i] == i) for i in sets}


def cosine(rows, threshold=0.95):
    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    vec = dict(rows)
    near = {i: [j for j in vec if j != i and fine(vec[i]) and fine(vec[j]) and len(vec[i]) == len(vec[j]) and cos(vec[i], vec[j]) >= threshold] for i in vec}
    comp = reach(vec, near)
    return {i: (len(near[i]), comp[i], comp[i] == i) for i in vec}


def ranks(text, top):
    """A text's n-grams with their counts, by strings."""
    low = "".join(c if unicodedata.category(c).startswith(("L", "M")) else " " for c in text.lower())
    grams = Counter()
    if not any(unicodedata.category(c).startswith("L") for c in low):
        return grams
    for w in low.split():
        p = f" {w} "
        grams.update(w)
        grams.update(p[k: k + 2] for k in range(len(p) - 1))
        grams.update(p[k: k + 3] for k in range(len(p) - 2) if p[k + 1] != " ")
    return grams


def _order(grams, top):
    # a shorter n-gram has a smaller code; within a length, code points decide
    return [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:top]]


def languages(rows, top):
    """Profiles of ``(text, lang)`` rows."""
    total = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            total.setdefault(lang, Counter()).update(ranks(text, top))
    return {lang: _order(c, top) for lang, c in total.items() if c}


def language(text, profiles, top):
    """(language, score) by out-of-place distance."""
    mine = _order(ranks(text or "", top), top)
    if not mine or not profiles:
        return "und", 0.0
    far = sorted((sum(abs(p.index(g) - k) if g in p else top for k, g in enumerate(mine)), lang) for lang, p in profiles.items())
    second = far[1][0] if len(far) > 1 else top * len(mine)
    return far[0][1], second / (far[0][0] + second) if far[0][0] + second else 1.0


def passage_features(text, per=100):
    """Features of every passage of a text, byte by byte and word by word."""
    raw = (text or "").encode()
    marks = [i for i in range(33, 127) if not chr(i).isalnum()]

    def kind(b):
        if 48 <= b <= 57:
            return 0
        if 65 <= b <= 90:
            return 1
        if 97 <= b <= 122:
            return 2
        if b in (32, 9, 11, 12):
            return 3
        if b in (10, 13):
            return 4
        return 5 + marks.index(b) if b in marks else 39

    found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    out = []
    for k in range(0, max(1, len(found)), per):
        mine = found[k: k + per]
        row = [0.0] * 48
        if mine:
            end = found[k + per][0] if k + per < len(found) else len(raw)
            block, n = raw[mine[0][0]: end], len(mine)
            for b in block:
                row[kind(b)] += 1
            row[:40] = [math.sqrt(v / len(block)) for v in row[:40]]
            w = [raw[a:b] for a, b in mine]
            mean = sum(map(len, w)) / n
            spread = math.sqrt(max(sum(len(x) ** 2 for x in w) / n - mean ** 2, 0))
            row[40:] = [math.log1p(mean), math.log1p(spread), sum(a == b for a, b in zip(w, w[1:])) / n, len(set(w)) / n,
                        sum(65 <= x[0] <= 90 for x in w) / n, sum(x[-1] < 128 and not 97 <= x[-1] | 32 <= 122 for x in w) / n,
                        sum(len(x) == 1 for x in w) / n, math.log1p(n)]
        out.append(row)
    return out


def attention_score(model, text):
    """Score of one text by the formula of gated attention, in plain loops."""
    w = {k: v.tolist() for k, v in model.weights.items()}

    def times(x, m):
        return [sum(a * row[j] for a, row in zip(x, m)) for j in range(len(m[0]))]

    def sig(x):
        return 1 / (1 + math.exp(-x))

    embedded, logits = [], []
    for x in passage_features(text):
        x = [min(5.0, max(-5.0, (a - m) / s)) for a, m, s in zip(x, model.mean, model.scale)]
        h = [math.tanh(a + b) for a, b in zip(times(x, w["E"]), w["e"])]
        embedded.append(h)
        logits.append(sum(c * math.tanh(t) * sig(g) for c, t, g in zip(w["w"], times(h, w["V"]), times(h, w["U"]))))
    share = [math.exp(a - max(logits)) for a in logits]
    z = [sum(a * h[j] for a, h in zip(share, embedded)) / sum(share) for j in range(len(embedded[0]))]
    return sig(sum(a * b for a, b in zip(z, w["c"])) + w["b"][0])
