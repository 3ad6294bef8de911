"""Approximate nearest neighbours by a hierarchical k-means tree.

1. *Index.* Equal vectors are one class with its ``k + 1`` smallest ids (no
   answer can hold more of them). A tree of k-means splits is fitted per vector
   length on a sample of at most ``SAMPLE`` classes and ``SAMPLE_BYTES`` on the
   driver, down to leaves of about ``LEAF`` classes of the table. Then every
   class descends to its leaf, in Spark tasks.
2. *Calibration.* At most about ``PROBES`` query vectors of each length are
   compared with every class. The number of leaf visits is widened until the
   visited leaves hold ``RECALL`` of their true neighbours.
3. *Traversal.* Each query vector visits that many leaves, best bin first: a
   priority queue holds tree nodes by the distance to their centres, the
   nearest is taken, and an inner node puts its children into the queue.
4. *Search.* Queries and members meet by leaf. Leaves and their visitors are
   dealt into blocks of bounded size, so neither a dense leaf nor a popular one
   is one task. A block sifts by matrix products and computes the distances of
   what remains from differences, in double precision. The nearest ``k + 1``
   rows of each query vector are then taken over all its leaves.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without id, take no part. Repeated rows (same id and
vector) are one row; rows that share the id alone are different rows, and a
query is told from its candidates by both. Vectors of different lengths are no
candidates of each other. Negative and positive zero are equal. With fewer
than ``k`` candidates visited, all of them are returned. Other columns are
ignored; empty tables give an empty result. A length of which no query was
probed visits every leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adsieve.llm.common import broadcast_if_small, hash_sample, stored

K = 10
SAMPLE, SAMPLE_BYTES = 1 << 17, 64 << 20
BRANCHES, ROUNDS = 16, 8
LEAF, LEAST_LEAF = 256, 8  # classes of the table, and of the sample
PROBES, RECALL = 256, 0.96
MEMBERS, VISITORS = 1 << 14, 1 << 13  # of a block
_PAIRS = 1 << 16
_FAR = 1e100  # the tree sees no coordinate beyond this, so its distances stay finite


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T), 0)


def _kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """Cluster of each row; the rows come in a random order, the first ones start."""
    centre = np.unique(x[: 4 * k], axis=0)[:k]
    own = np.zeros(len(x), int)
    for _ in range(ROUNDS):
        d = _squares(x, centre)
        new = d.argmin(axis=1)
        count = np.bincount(new, minlength=len(centre))
        centre = np.stack([x[new == c].mean(axis=0) if count[c] else x[d.min(axis=1).argmax()] for c in range(len(centre))])
        if (new == own).all():
            break
        own = new
    return own


@dataclass
class Tree:
    """Nodes with their centres; ``child`` lists each node's children (-1 fills
    up), ``leaf`` numbers the nodes without children (-1 for others)."""

    centre: np.ndarray
    child: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector, by the nearest centre from level to level."""
        out = np.empty(len(x), np.int64)
        for a in range(0, len(x), 1024):
            part = np.clip(x[a: a + 1024], -_FAR, _FAR)
            d = _squares(part, self.centre)
            node, row = np.zeros(len(part), int), np.arange(len(part))
            while (inner := self.leaf[node] < 0).any():
                c = self.child[node[inner]]
                far = np.where(c < 0, np.inf, d[row[inner][:, None], c])
                node[inner] = c[np.arange(len(c)), far.argmin(axis=1)]
            out[a: a + 1024] = self.leaf[node]
        return out

    def visits(self, x: np.ndarray, most: int) -> list[list[int]]:
        """The first ``most`` leaves of each vector, best bin first."""
        out = []
        leaf, child = self.leaf.tolist(), [[int(c) for c in row if c >= 0] for row in self.child]
        for a in range(0, len(x), 1024):
            for d in _squares(np.clip(x[a: a + 1024], -_FAR, _FAR), self.centre).tolist():
                queue, found = [(0.0, 0)], []
                while queue and len(found) < most:
                    _, node = heapq.heappop(queue)
                    if leaf[node] >= 0:
                        found.append(leaf[node])
                    for c in child[node]:
                        heapq.heappush(queue, (d[c], c))
                out.append(found)
        return out


def build(x: np.ndarray, leaf_size: int) -> Tree:
    """Tree over the sample ``x``, split until a node holds ``leaf_size``."""
    x = np.clip(x, -_FAR, _FAR)
    centre, child, leaf, n = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [[]], [-1], 0
    open_ = [(0, np.arange(len(x)))]
    while open_:
        node, rows = open_.pop()
        own = _kmeans(x[rows], BRANCHES) if len(rows) > leaf_size else np.zeros(len(rows), int)
        parts = [rows[own == c] for c in np.unique(own)]
        if len(parts) < 2:
            leaf[node], n = n, n + 1
            continue
        for part in parts:
            child[node].append(len(centre))
            open_.append((len(centre), part))
            centre.append(x[part].mean(axis=0))
            child.append([])
            leaf.append(-1)
    wide = np.full((len(child), BRANCHES), -1, np.int64)
    for row, c in zip(wide, child):
        row[: len(c)] = c
    return Tree(np.array(centre), wide, np.array(leaf))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of ``a`` to the same row of ``b``."""
    diff = a - b
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        out = np.sqrt((diff * diff).sum(axis=1))
        most = np.abs(diff).max(axis=1)
        odd = ((most > 1e140) | (most < 1e-140)) & (most > 0)
        if odd.any():  # squares would over- or underflow
            half = a[odd] / 2 - b[odd] / 2
            most = np.abs(half).max(axis=1)
            most[most == 0] = 1.0
            out[odd] = np.sqrt(((half / most[:, None]) ** 2).sum(axis=1)) * most * 2
    return out


def nearest_rows(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, distance) of the ``k`` nearest rows of ``x`` to each query,
    ties to the smaller ``first``. Products only sift: a row goes on unless
    more than their rounding keeps it from the nearest ``k``."""
    k = min(k, len(x))
    step = max(1, (8 << 20) // (8 * len(x)))
    scale = max(np.abs(q).max(), np.abs(x).max())
    scale = 2.0 ** -np.frexp(scale)[1] if not 1e-140 < scale < 1e140 else 1.0
    sx = x * scale
    norm, eps = (sx * sx).sum(axis=1), 4 * x.shape[1] * np.finfo(float).eps
    for a in range(0, len(q), step):
        sq = q[a: a + step] * scale
        own = (sq * sq).sum(axis=1)
        rough = own[:, None] + norm - 2 * (sq @ sx.T)
        slack = eps * (own[:, None] + norm)
        last = np.partition(rough + slack, k - 1, axis=1)[:, k - 1]
        at, to = np.nonzero(rough - slack <= last[:, None])
        d = np.concatenate([distances(q[a + at[s: s + _PAIRS]], x[to[s: s + _PAIRS]]) for s in range(0, len(at), _PAIRS)])
        order = np.lexsort((first[to], d, at))
        at, to, d = at[order], to[order], d[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        yield a + at[place < k], to[place < k], d[place < k]


def by_length(rb: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) of the list column ``v``."""
    if not rb.num_rows:
        return
    col = rb.column("v")
    at = np.frombuffer(col.buffers()[1], np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    flat, at, size = col.flatten().to_numpy(zero_copy_only=False), at - at[0], np.diff(at)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield int(d), rows, flat[at[rows][:, None] + np.arange(d)]


def _leaf_task(trees: dict[int, Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            leaf = np.zeros(rb.num_rows, np.int64)
            for d, rows, x in by_length(rb):
                if d in trees:
                    leaf[rows] = trees[d].assign(x)
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(leaf)], [*rb.schema.names, "leaf"])
    return run


def _visit_task(trees: dict[int, Tree], visits: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            leaves = np.empty(rb.num_rows, object)
            for d, rows, x in by_length(rb):
                found = trees[d].visits(x, visits.get(d, trees[d].leaves)) if d in trees else [[0]] * len(rows)
                for r, f in zip(rows, found):
                    leaves[r] = f
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(list(leaves), pa.list_(pa.int64()))], [*rb.schema.names, "leaves"])
    return run


def _probe_task(probes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int):
    """Nearest classes of each probe (its own left out), per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {d: (np.full((len(p[0]), k), np.inf), np.full((len(p[0]), k), -1)) for d, p in probes.items()}
        for rb in batches:
            leaf, h1, h2 = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "h1", "h2"))
            for d, rows, x in by_length(rb):
                if d not in probes:
                    continue
                q, q1, q2 = probes[d]
                far = _squares(np.clip(q, -_FAR, _FAR), np.clip(x, -_FAR, _FAR))
                far[(q1[:, None] == h1[rows]) & (q2[:, None] == h2[rows])] = np.inf
                far = np.concatenate([best[d][0], far], axis=1)
                of = np.concatenate([best[d][1], np.broadcast_to(leaf[rows], (len(q), len(rows)))], axis=1)
                pick = np.argpartition(far, k - 1, axis=1)[:, :k]
                best[d] = np.take_along_axis(far, pick, 1), np.take_along_axis(of, pick, 1)
        for d, (far, of) in best.items():
            at = np.nonzero(np.isfinite(far))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at[0]), d)), pa.array(at[0]), pa.array(far[at]), pa.array(of[at])], ["dim", "probe", "far", "leaf"])
    return run


def _search_task(k: int):
    schema = pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim, side = table["dim"][0].as_py(), table["side"].to_numpy()
        v = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["v"].chunks]).reshape(-1, dim)
        ids = [i for i, s in zip(table["ids"].to_pylist(), side) if s == 0]
        x, q, key = v[side == 0], v[side == 1], table["q"].to_numpy(zero_copy_only=False)[side == 1].astype(np.int64)
        if not len(x) or not len(q):
            return schema.empty_table()
        first, count = np.array([i[0] for i in ids]), np.array([len(i) for i in ids])
        flat, at = np.concatenate([np.array(i, dtype=np.int64) for i in ids]), np.cumsum(count) - count
        out = []
        for query, row, d in nearest_rows(q, x, first, k):
            n = count[row]
            each = np.repeat(np.arange(len(row)), n)
            place = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            out.append((key[query[each]], flat[at[row[each]] + place], d[each]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)
    return run


@dataclass
class Index:
    """``members (dim, leaf, ids, h1, h2, v)`` of all classes, and the trees."""

    members: DataFrame
    trees: dict[int, Tree]
    sizes: dict[tuple[int, int], int]
    k: int


def _rows(vectors: DataFrame) -> DataFrame:
    """``vec_id, v, h1, h2`` of the rows that take part."""
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.coalesce(F.col("vec_id").isNotNull() & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))) \
        .withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v"))


def build_index(vectors: DataFrame, k: int = K) -> Index:
    """Index of every row of ``vectors (vec_id, embedding)``, for answers of ``k``."""
    rows = _rows(vectors)
    classes = stored(rows.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"))
                     .withColumn("dim", F.size("v").cast("long")), "classes")
    counts = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    trees = {}
    for dim, n in counts.items():
        bound = max(LEAF, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
        if n > LEAF:
            part = classes.where((F.col("dim") == dim) & hash_sample(F.xxhash64("h1", "h2"), bound, n)).orderBy("h2", "h1").select("v")
            x = np.concatenate([b.column("v").flatten().to_numpy(zero_copy_only=False) for b in part.toArrow().to_batches()] or [np.empty(0)]).reshape(-1, dim)
            if len(x):
                trees[dim] = build(x, max(LEAST_LEAF, LEAF * len(x) // n))
    many = classes.where("size > 1").select("h1", "h2")
    many = broadcast_if_small(many, many.count(), 24)
    # of a class the smallest ids only, cut before the shuffle too
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    copies = rows.select("vec_id", "h1", "h2").join(many, ["h1", "h2"], "left_semi").distinct() \
        .withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1) \
        .groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("copies"))
    copies = stored(copies, "copies")
    placed = classes.drop("size").mapInArrow(_leaf_task(trees), "h1 long, h2 long, v array<double>, least long, dim long, leaf long")
    members = placed.join(broadcast_if_small(copies, copies.count(), 24 + 8 * (k + 1)), ["h1", "h2"], "left") \
        .select("dim", "leaf", F.coalesce("copies", F.array("least")).alias("ids"), "h1", "h2", "v")
    members = stored(members, "members")
    sizes = {(r["dim"], r["leaf"]): r["count"] for r in members.groupBy("dim", "leaf").count().collect()}
    return Index(members, trees, sizes, k)


def calibrate(index: Index, queries: DataFrame, recall: float = RECALL) -> dict[int, tuple[int, float]]:
    """By vector length, the leaf visits at which the visited leaves hold
    ``recall`` of the probes' true neighbours, and that share. ``queries``
    holds distinct vectors (``h1, h2, v``)."""
    probes, visits = {}, {}
    counts = {r["dim"]: r["count"] for r in queries.groupBy(F.size("v").alias("dim")).count().collect()}
    for dim, tree in index.trees.items():
        if dim in counts:
            part = queries.where((F.size("v") == dim) & hash_sample(F.xxhash64("h2", "h1"), PROBES, counts[dim])).collect()
            if part:
                probes[dim] = tuple(np.array([r[c] for r in part]) for c in ("v", "h1", "h2"))
    if not probes:
        return {}
    near = index.members.select("h1", "h2", "v", "leaf").mapInArrow(_probe_task(probes, index.k), "dim long, probe long, far double, leaf long")
    order = Window.partitionBy("dim", "probe").orderBy("far", "leaf")
    near = near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= index.k).select("dim", "probe", "leaf").toPandas()
    for dim, (x, _, _) in probes.items():
        tree, own = index.trees[dim], near[near["dim"] == dim]
        if len(own):
            place = np.empty((len(x), tree.leaves), int)
            for row, leaves in zip(place, tree.visits(x, tree.leaves)):
                row[leaves] = np.arange(1, tree.leaves + 1)
            need = np.sort(place[own["probe"], own["leaf"]])
            wide = 1
            while (share := np.searchsorted(need, wide, side="right") / len(need)) < recall:
                wide += 1  # one more leaf
            visits[dim] = wide, float(share)
    return visits


def search(index: Index, queries: DataFrame, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``k`` rows found for each
    row of ``queries (vec_id, embedding)``, its own row left out."""
    spark, k = queries.sparkSession, index.k
    asked = stored(_rows(queries), "queries")
    distinct = stored(asked.groupBy("h1", "h2").agg(F.first("v").alias("v")).withColumn("q", F.monotonically_increasing_id()), "distinct")
    visits = {dim: n for dim, (n, _) in calibrate(index, distinct, recall).items()}
    went = stored(distinct.select("q", "v").mapInArrow(_visit_task(index.trees, visits), "q long, v array<double>, leaves array<long>")
                  .withColumn("dim", F.size("v").cast("long")), "visits")
    popular = {(r["dim"], r["leaf"]): r["count"] for r in went.select("dim", F.explode("leaves").alias("leaf")).groupBy("dim", "leaf").count().collect()}
    # one row a leaf, as many as the trees have
    deal = [(d, leaf, -(-index.sizes[d, leaf] // MEMBERS), -(-n // VISITORS)) for (d, leaf), n in popular.items() if (d, leaf) in index.sizes]
    deal = F.broadcast(spark.createDataFrame(deal, "dim long, leaf long, subs long, crowds long"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    none = F.lit(None)
    side0 = index.members.join(deal, ["dim", "leaf"]).select(
        "dim", "leaf", F.pmod("h1", "subs").alias("sub"), each("crowds").alias("crowd"), F.lit(0).alias("side"), none.cast("long").alias("q"), "ids", "v")
    side1 = went.select("dim", F.explode("leaves").alias("leaf"), "q", "v").join(deal, ["dim", "leaf"]).select(
        "dim", "leaf", each("subs").alias("sub"), F.pmod(F.xxhash64("q"), "crowds").alias("crowd"), F.lit(1).alias("side"), "q", none.cast("array<long>").alias("ids"), "v")
    met = side0.unionByName(side1).groupBy("dim", "leaf", "sub", "crowd").applyInArrow(_search_task(k + 1), "q long, vec_id long, score double")
    order = Window.partitionBy("q").orderBy("score", "vec_id")
    top = met.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1) \
        .groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("top"))
    top = stored(top.join(distinct.select("q", "h1", "h2"), "q").select("h1", "h2", "top"), "top")
    told = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct().join(broadcast_if_small(top, top.count(), 32 + 24 * (k + 1)), ["h1", "h2"])
    own = lambda x: (x["vec_id"] == F.col("query_id")) & (x["score"] == 0)
    return told.select("query_id", F.posexplode(F.slice(F.filter("top", lambda x: ~own(x)), 1, k)).alias("at", "x")) \
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` found for each row of ``queries``."""
    return search(build_index(vectors, k), queries, recall)
