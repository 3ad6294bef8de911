"""N-gram Jaccard join: MinHash LSH forest with exact verification.

1. A document is the set of its five-word shingles. Documents with equal sets
   form a class (found by a 128-bit set fingerprint); its smallest id speaks
   for it, so copies are never expanded into pairs.
2. Every class has ``TREES`` labels of ``DEPTH`` minimum hashes: its paths in
   ``TREES`` prefix tries. Two classes match where they share the first ``d``
   minima of a label, that is a node of a trie at depth ``d``. Matching begins
   at the whole label, and the prefix is shortened until the recall measured on
   the verified links reaches the target: a link of similarity s is found with
   probability ``p = 1 - (1 - s**d)**trees``, so the found links stand for
   ``sum(1/p)`` of them (`measured_recall`; one link in a hundred, and one at
   least, is taken to lie at the threshold unseen). At `safe_depth` every pair
   meets with the target probability, so no prefix is shortened further. Low
   thresholds get more trees (`trees_needed`).
3. Nodes that hold several classes tie each to the smallest of them (one link a
   class and node, never all pairs); connected components are candidate groups.
   A dense group (its nodes together hold as many pairs as it has) is verified
   as a whole. In any other group, such as a long chain, only classes that share
   a node meet, each pair once, at its longest shared prefix: work grows with the
   shared prefixes, not with the square of the group.
4. Groups and nodes are verified exactly in tasks: intersections are counted
   over the 64-bit shingle codes. One over ``BLOCK`` classes is dealt into
   blocks, and each pair of blocks is a task of its own. Tasks return a count of
   links and a spanning forest, not the pairs.

Defined results: texts without words link with nothing. A text of one to four
words is one shingle. A null id links with nothing. Rows that repeat an id
count as documents of one class. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm.common import broadcast_if_small, stored
from adsieve.llm.components import components
from adsieve.llm.textcodes import Words, mix, shingles, slices

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 6
TARGET_RECALL = 0.9999
BLOCK = 1024  # classes of a block
BIN = 256  # classes of small groups that share a task
SLICE_BYTES = 1 << 20
_DENSE = 32  # shingles of more classes are counted by matrix product
_SETS = "doc_id long, n int, fp1 long, fp2 long, labels array<binary>"


def found_share(similarity, depth: int, trees: int):
    """Probability that a pair of that similarity shares ``depth`` minima in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def measured_recall(links: float, stand_for: float, threshold: float, depth: int, trees: int) -> float:
    """Share of all links that is found, where ``links`` found ones stand for
    ``stand_for``; a hundredth, and one at least, may lie at the threshold."""
    unseen = 1 + links / 100
    return (links + unseen) / (stand_for + unseen / found_share(threshold, depth, trees))


def safe_depth(threshold: float, trees: int, target: float = TARGET_RECALL) -> int:
    """Longest prefix that finds a pair of any similarity from the threshold up
    with the target probability: matching is never shortened below it."""
    return max((d for d in range(1, DEPTH + 1) if found_share(threshold, d, trees) >= target), default=1)


def trees_needed(threshold: float, trees: int = TREES, target: float = TARGET_RECALL) -> int:
    """``trees``, or more where even prefixes of one minimum miss the target."""
    if not (threshold > 0 and target < 1):
        raise ValueError("threshold must be above 0 and target below 1")
    if threshold >= 1 or found_share(threshold, 1, trees) >= target:
        return trees
    return math.ceil(math.log1p(-target) / math.log(1 - threshold))


def _sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle codes) of every text."""
    for i, j, buf, base in slices(texts, SLICE_BYTES):
        doc, code = shingles(Words(buf, base), width)
        cut = np.searchsorted(doc, np.arange(j - i + 1))
        for k in range(j - i):
            yield i + k, np.unique(code[cut[k]: cut[k + 1]])


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)).astype(np.uint32)
    return x[:n] | np.uint32(1), x[n:]


def signature(codes: np.ndarray, n: int) -> np.ndarray:
    """``n`` minimum hashes of a non-empty set."""
    a, b = _permutations(n)
    h = (codes >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, dtype=np.uint32)
    step = max(1, min(2048, (1 << 22) // n))
    for i in range(0, len(h), step):
        x = h[i: i + step, None] * a
        x += b
        # odd multiples alone order small sets alike; fold the high bits in
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def _set_task(width: int, trees: int, depth: int):
    kind = pa.list_(pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            n, fp1, fp2, labels = [], [], [], []
            for _, codes in _sets(rb.column("text"), width):
                n.append(len(codes))
                fp1.append(int(codes.sum(dtype=np.uint64).astype(np.int64)))
                fp2.append(int(mix(codes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                sig = signature(codes, trees * depth).astype(">u4").reshape(trees, depth) if len(codes) else []
                labels.append([s.tobytes() for s in sig])
            yield pa.RecordBatch.from_arrays(
                [rb.column("doc_id").cast(pa.int64()), pa.array(n, pa.int32()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.array(labels, kind)],
                ["doc_id", "n", "fp1", "fp2", "labels"])
    return run


def _code_task(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            codes = [c.tobytes() for _, c in _sets(rb.column("text"), width)]
            yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in ("doc_id", "meets", "size", "labels")), pa.array(codes, pa.binary())],
                                             ["doc_id", "meets", "size", "labels", "codes"])
    return run


def at_longest(labels: np.ndarray, other: np.ndarray, tree: int) -> np.ndarray:
    """Pairs whose longest shared prefix lies in ``tree`` (of equal ones the
    first). ``labels [classes, trees, depth]``."""
    best = np.zeros((len(labels), len(other)), np.int8)
    own = np.full(best.shape, -1, np.int16)
    for t in range(labels.shape[1]):
        same = np.ones(best.shape, bool)
        length = np.zeros(best.shape, np.int8)
        for d in range(labels.shape[2]):
            same &= labels[:, t, d][:, None] == other[:, t, d][None, :]
            if not same.any():
                break
            length += same
        longer = length > best
        best[longer], own[longer] = length[longer], t
    return own == tree


def overlaps(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of sets ``a`` with sets ``b`` (or with ``a``)."""
    rows = len(a)
    every = a if b is None else a + b
    owner = np.repeat(np.arange(len(every)), [len(x) for x in every])
    _, column = np.unique(np.concatenate(every), return_inverse=True)
    df = np.bincount(column)
    keep = df[column] > 1
    owner, column = owner[keep], column[keep]
    cols = rows if b is None else len(b)
    out = np.zeros((rows, cols), dtype=np.float32)
    wide = df[column] > _DENSE
    # shingles of many sets: matrix products over runs of columns
    o, (_, c) = owner[wide], np.unique(column[wide], return_inverse=True)
    order = np.argsort(c, kind="stable")
    o, c = o[order], c[order]
    step = 1024
    for first in range(0, int(c[-1]) + 1 if len(c) else 0, step):
        x, z = np.searchsorted(c, first), np.searchsorted(c, first + step)
        m = np.zeros((len(every), step), dtype=np.float32)
        m[o[x:z], c[x:z] - first] = 1
        out += m[:rows] @ (m if b is None else m[rows:]).T
    # shingles of few sets: all pairs of each, at most _DENSE times the entries
    o, c = owner[~wide], column[~wide]
    order = np.argsort(c, kind="stable")
    o, c = o[order], c[order]
    for shift in range(1, _DENSE):
        if len(c) <= shift:
            break
        x, y = o[:-shift], o[shift:]
        same = c[:-shift] == c[shift:]
        if not same.any():
            break
        x, y = x[same], y[same]  # x < y: entries of a column stand by set
        if b is not None:
            cross = (x < rows) & (y >= rows)
            np.add.at(out, (x[cross], y[cross] - rows), 1)
        else:
            np.add.at(out, (x, y), 1)
            np.add.at(out, (y, x), 1)
    if b is None:
        np.fill_diagonal(out, 0)
    return out


def _roots(ids: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Smallest id reachable, over a symmetric link matrix."""
    root = np.full(len(ids), -1)
    for s in np.argsort(ids, kind="stable"):
        if root[s] >= 0:
            continue
        front = np.array([s])
        root[s] = s
        while len(front):
            nxt = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
            root[nxt] = s
            front = nxt
    return ids[root]


def _verify_task(threshold: float, trees: int, levels: int):
    schema = pa.schema([("doc_id", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("pairs", pa.int64()), ("stand_for", pa.list_(pa.float64()))])
    depths = np.arange(1, levels + 1)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("doc_id", "ascending")])
        grp = table["grp"].to_numpy()
        ids, size, block, tree = (table[c].to_numpy() for c in ("doc_id", "size", "block", "tree"))
        codes = [np.frombuffer(x, np.uint64) for x in table["codes"].to_pylist()]
        label = table["labels"].to_pylist()
        fresh = np.r_[True, (ids[1:] != ids[:-1]) | (grp[1:] != grp[:-1])]  # an id's repeated rows count in its size
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        out = []

        def labels(rows):
            return np.frombuffer(b"".join(b"".join(label[k]) for k in rows), ">u4").reshape(len(rows), trees, levels)

        def linked(a, b):
            """Links of rows ``a`` with rows ``b`` (None: among themselves), and their similarity."""
            both = overlaps([codes[k] for k in a], None if b is None else [codes[k] for k in b]).astype(np.float64)
            n = np.array([len(codes[k]) for k in a], dtype=np.float64)
            m = n if b is None else np.array([len(codes[k]) for k in b], dtype=np.float64)
            union = n[:, None] + m[None, :] - both
            link = (both > 0) & (both >= threshold * union - 1e-9)
            if b is None:
                np.fill_diagonal(link, False)
            if tree[a[0]] >= 0 and link.any():  # a node: its pairs may share others
                mine = labels(a)
                link &= at_longest(mine, mine if b is None else labels(b), tree[a[0]])
            once = np.triu(link) if b is None else link
            alike = both[once] / union[once]
            return link, len(alike), [float((1 / found_share(alike, d, trees)).sum()) for d in depths]

        begin = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
        for x, z in zip(begin, [*begin[1:], len(grp)]):
            mine = x + np.flatnonzero(fresh[x:z])
            if lo == hi:
                link, pairs, stand_for = linked(mine, None)
                links, root = link @ size[mine], _roots(ids[mine], link)
            else:
                a, b = mine[block[mine] == lo], mine[block[mine] == hi]
                if not len(a) or not len(b):
                    continue
                cross, pairs, stand_for = linked(a, b)
                mine = np.r_[a, b]
                link = np.zeros((len(mine), len(mine)), dtype=bool)
                link[: len(a), len(a):] = cross
                link[len(a):, : len(a)] = cross.T
                links, root = np.r_[cross @ size[b], cross.T @ size[a]], _roots(ids[mine], link)
            some = links > 0
            if some.any():
                rest = int(some.sum()) - 1  # a group's figures stand in its first row
                out.append((ids[mine][some], links[some], root[some], [pairs] + [0] * rest, [stand_for] + [None] * rest))
        if not out:
            return schema.empty_table()
        cols = list(zip(*out))
        figures = [[x for part in c for x in part] for c in cols[3:]]
        return pa.table([*(pa.array(np.concatenate(c).astype(np.int64)) for c in cols[:3]), *map(pa.array, figures)], schema=schema)
    return run


def shared_prefixes(classes: DataFrame, floor: int) -> DataFrame:
    """``rep, tree, path``: the classes' places in the tries, hashed, at the
    depths from ``floor`` to ``DEPTH``, where several share the first. The one
    pass over all classes; deeper levels lie inside."""
    path = F.array(*[F.xxhash64("tree", F.substring("label", 1, 4 * d)) for d in range(floor, DEPTH + 1)])
    keyed = classes.select("rep", F.posexplode("labels").alias("tree", "label")).select("rep", "tree", path.alias("path")) \
        .withColumn("prefix", F.col("path")[0])
    shared = stored(keyed.groupBy("prefix").count().where("count > 1").select("prefix"), "shared")
    return stored(keyed.join(broadcast_if_small(shared, shared.count(), 16), "prefix").drop("prefix"), "prefixes")


def groups_at(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``places (rep, tree, prefix)``: (those that several share, with
    ``n``; ``rep, component, m, blocks, dense`` of every class tied by them)."""
    nodes = stored(places.groupBy("prefix").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1"), "nodes")
    tied = stored(places.join(broadcast_if_small(nodes, nodes.count(), 40), "prefix"), "tied")
    comps = stored(components(tied.where("rep <> head").select(F.col("rep").alias("u"), F.col("head").alias("v")).distinct()), "groups")
    held = nodes.join(comps, F.col("head") == F.col("id")).groupBy("component").agg(F.sum(F.col("n") * (F.col("n") - 1.0) / 2).alias("held"))
    shape = comps.groupBy("component").agg(F.count(F.lit(1)).alias("m")).join(held, "component")
    shape = stored(shape.select("component", "m", F.ceil(F.col("m") / BLOCK).alias("blocks"), (F.col("m") * (F.col("m") - 1.0) / 2 <= F.col("held")).alias("dense")), "shape")
    return tied, stored(comps.withColumnRenamed("id", "rep").join(broadcast_if_small(shape, shape.count(), 40), "component"), "shaped")


def meetings(tied: DataFrame, groups: DataFrame) -> DataFrame:
    """``rep, meets``: where each class of ``groups`` is verified, as ``(kind,
    task, grp, blocks, tree)``. A dense group is met once (tree -1), else every
    shared node."""
    bins = max(1, -(-groups.count() // BIN))
    whole = groups.where("dense").select("rep", F.col("component").alias("grp"), "blocks", F.lit(-1).alias("tree"), F.lit(0).alias("kind"))
    apart = tied.join(groups.where("not dense").select("rep"), "rep") \
        .select("rep", F.col("prefix").alias("grp"), F.ceil(F.col("n") / BLOCK).alias("blocks"), "tree", F.lit(2).alias("kind"))
    small = F.col("blocks") == 1
    met = whole.unionByName(apart).select("rep", F.struct(
        F.when(small, F.col("kind")).otherwise(F.col("kind") + 1).alias("kind"),
        F.when(small, F.pmod(F.xxhash64("grp"), F.lit(bins))).otherwise(F.col("grp")).alias("task"), "grp", "blocks", "tree").alias("at"))
    # a class is in one node a tree at most
    return stored(met.groupBy("rep").agg(F.collect_list("at").alias("meets")), "meetings")


def verified_links(docs: DataFrame, classes: DataFrame, met: DataFrame, threshold: float, width: int, trees: int) -> DataFrame:
    """Links and a spanning forest of the classes that meet."""
    # only classes that are met node by node need their labels there
    at_nodes = F.exists("meets", lambda m: m["tree"] >= 0)
    met = met.join(classes.select("rep", "size", "labels"), "rep").withColumn("labels", F.when(at_nodes, F.col("labels")))
    met = stored(met, "members")
    n, nodes, labels = met.agg(F.count(F.lit(1)), F.sum(F.size("meets")), F.count("labels")).first()
    size = n * 64 + (nodes or 0) * 48 + labels * trees * (4 * DEPTH + 16)
    texts = docs.select("doc_id", "text").join(broadcast_if_small(met, size, 1), F.col("doc_id") == F.col("rep")) \
        .select("doc_id", "text", "meets", "size", "labels")
    kind = texts.schema["meets"].dataType.simpleString()
    codes = texts.mapInArrow(_code_task(width), f"doc_id long, meets {kind}, size long, labels array<binary>, codes binary")
    each = codes.withColumn("at", F.explode("meets")).select("doc_id", "at.*", "size", "codes", F.when(F.col("at.tree") >= 0, F.col("labels")).alias("labels"))
    dealt = each.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    return stored(dealt.groupBy("kind", "task", "lo", "hi").applyInArrow(
        _verify_task(threshold, trees, DEPTH), "doc_id long, links long, root long, pairs long, stand_for array<double>"), "verified")


def forest_links(docs: DataFrame, classes: DataFrame, threshold: float, width: int, trees: int, target: float) -> DataFrame:
    """Verified links of all classes that share a long enough prefix. A shorter
    prefix verifies only groups that it changed: a dense group that stays as it
    was has been compared pair by pair."""
    floor = safe_depth(threshold, trees, target)
    places, verified, before, depth = shared_prefixes(classes, floor), None, None, DEPTH
    while True:
        tied, groups = groups_at(places.select("rep", "tree", F.col("path")[depth - floor].alias("prefix")))
        if verified is None:
            verified = verified_links(docs, classes, meetings(tied, groups), threshold, width, trees)
        else:
            same = groups.join(before.where("dense").select("rep", "component", "m"), ["rep", "component", "m"], "left_semi").select("rep")
            same = stored(same, "settled")
            changed = groups.join(broadcast_if_small(same, same.count(), 16), "rep", "left_anti")
            again = verified_links(docs, classes, meetings(tied, changed), threshold, width, trees)
            verified = stored(verified.join(same, F.col("doc_id") == F.col("rep"), "left_semi").unionByName(again), "verified")
        told = verified.agg(F.sum("pairs"), *(F.sum(F.col("stand_for")[d]) for d in range(DEPTH))).first()
        # the longest prefix that reaches the target by what was seen so far
        reach = [d for d in range(floor, depth + 1) if measured_recall(told[0] or 0, told[d] or 0.0, threshold, d, trees) >= target]
        if depth in reach or depth == floor:
            return verified
        before, depth = groups, max([d for d in reach if d < depth], default=floor)


def jaccard_links(docs: DataFrame, threshold: float = THRESHOLD, width: int = SHINGLE, target: float = TARGET_RECALL) -> DataFrame:
    """``doc_id, n_links, component_id, kept`` of every document: the other
    documents at the threshold or above, and the smallest id reachable."""
    trees = trees_needed(threshold, target=target)
    sets = stored(docs.select("doc_id", "text").mapInArrow(_set_task(width, trees, DEPTH), _SETS), "sets")
    alike = ["n", "fp1", "fp2"]
    known = sets.where("n > 0 and doc_id is not null")
    classes = stored(
        known.groupBy(*alike).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("labels").alias("labels")), "classes")
    verified = forest_links(docs, classes, threshold, width, trees, target)
    joined = components(verified.select(F.col("doc_id").alias("u"), F.col("root").alias("v")))
    links = verified.groupBy(F.col("doc_id").alias("rep")).agg(F.sum("links").alias("links")) \
        .join(joined.select(F.col("id").alias("rep"), F.col("component").alias("root")), "rep", "left")
    told = classes.select(*alike, "rep", "size").join(links, "rep", "left").where("size > 1 or links > 0") \
        .select(*alike, (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    told = stored(told, "told")
    # a class holding a third of all rows meets its one row by broadcast, or by a join that splits skew
    out = known.select("doc_id", *alike).join(broadcast_if_small(told, told.count(), 64), alike, "left").select("doc_id", "n_links", "component_id")
    rest = sets.where("n = 0 or doc_id is null").select("doc_id", F.lit(None).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(rest).select(
        "doc_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
