"""Embedding near-duplicates by dual traversal of cover trees (exact).

1. Vectors that can take part (no null or non-finite component, norm above
   zero) are collapsed when equal; the smallest id speaks for its class, so
   copies are never expanded into pairs.
2. Up to ``CELLS`` centres are taken from a sample of at most ``SAMPLE``
   vectors, every vector joins the cell of its nearest centre, and cells are
   dealt into units of about ``UNIT_BYTES``, those into blocks of at most
   ``BLOCK`` vectors near each other.
3. Each block becomes a cover tree over unit vectors: nested nets with radii
   2, 1, 1/2, ... (a node's centre is its first vector and the centre of its
   own first child; centres of a level are more than its radius apart; every
   node knows its true covering radius). The trees of a unit are written once,
   as one file of the shared folder; its name is new with every attempt of a
   task, and only files named in the stored table count.
4. Pairs of units are dealt to tasks, which read the two files: no vector is
   shuffled for a pair. Pairs of cells, and of blocks, farther apart than their
   covering radii allow are pruned; else both trees are descended at once. A
   pair of nodes is dropped when ``d - r1 - r2`` exceeds the threshold's
   distance, taken whole when ``d + r1 + r2`` stays below it (also by the
   balls around the means of the nodes), and opened otherwise; levels that part
   few nodes are passed over. At the bottom the
   cosine is compared in double precision. A pair of units returns link counts
   and a spanning forest, linear in the units.

On disk are the vectors twice, in their own precision (shuffled to their unit
and in its file; a third time for those with copies), and some 200 bytes a row
for hashes and ids, however many pairs of units there are. Where vectors have
no structure above the threshold's scale (random directions), nothing can be
pruned above the level of near-duplicate groups, and the time of step 4 grows
with the square of their number, as dense matrix products.

Files are reached through pyarrow's file systems, as in ``warc``.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without id, link with nothing. Vectors of different
lengths do not link. Rows that repeat an id count as vectors of one class.
Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from adsieve.llm.common import as_uri, broadcast_if_small, file_system, hash_sample, partitions_for, shared_path, stored
from adsieve.llm.components import components

THRESHOLD = 0.95
SAMPLE, CELLS, BLOCK = 4096, 256, 4096
UNIT_BYTES = 16 << 20  # of unit vectors, one side of a pair
TASK_UNITS, TASK_PAIRS = 4, 8  # units built, pairs of units met by one task
RADII = (1.0, 0.5, 0.25, 0.125)  # below the root's 2
SLACK = 1e-7  # above the rounding of a distance near zero
_MANY = 4096  # node pairs opened by a matrix product rather than gathered
_CHUNK = 1 << 16
_NARROW = (0.01, 0.25)  # radii up to which nodes are sifted together
_SHORT = 32  # components from which a part of them is multiplied first
_BALL = 256  # pairs of vectors of two nodes whose means are compared too
_LONE = 64  # rows left of a node from which lone ones are taken at once
_EDGES = 1 << 20  # held before they are thinned to a forest
_TREE = pa.schema([("ids", pa.binary()), ("sizes", pa.binary()), ("x", pa.binary()), ("starts", pa.list_(pa.binary())), ("radius", pa.list_(pa.binary()))])


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # scaled first, so that no square over- or underflows
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _dist(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))


@dataclass
class Tree:
    """``x``: unit vectors in depth-first order. Level ``k`` is given by the
    first position of each node (also its centre) and its covering radius."""

    x: np.ndarray
    starts: list[np.ndarray]
    radius: list[np.ndarray]
    balls: dict[tuple[int, int], tuple[np.ndarray, float]] = field(default_factory=dict)

    def ball(self, level: int, node: int) -> tuple[np.ndarray, float]:
        """Mean of a node's vectors and the largest distance from it, which is
        well below the covering radius where many are scattered around it."""
        if (level, node) not in self.balls:
            part = self.x[slice(*self.bounds(level)[node: node + 2])]
            mean = part.mean(axis=0)
            self.balls[level, node] = mean, float(np.sqrt(((part - mean) ** 2).sum(axis=1).max()))
        return self.balls[level, node]

    @cached_property
    def single(self) -> np.ndarray:
        return self.x.astype(np.float32)

    @cached_property
    def short(self) -> np.ndarray:
        """A quarter of the components and the length of the rest: the products
        are never below those of the vectors, but for rounding."""
        part = max(1, self.x.shape[1] // 4)
        return np.c_[self.x[:, :part], np.sqrt((self.x[:, part:] ** 2).sum(axis=1))].astype(np.float32)

    def children(self, level: int, to: int) -> np.ndarray:
        """Bounds of each node's descendants among the nodes of level ``to``."""
        return np.r_[np.searchsorted(self.starts[to], self.starts[level]), len(self.starts[to])]

    def bounds(self, level: int) -> np.ndarray:
        return np.r_[self.starts[level], len(self.x)]


def _lone(x: np.ndarray, near: float) -> np.ndarray:
    """Rows that surely have no other row within cosine ``near``, by single
    precision lowered by more than its rounding."""
    f = x.astype(np.float32)
    near = np.float32(near - 2e-7 * x.shape[1] - 1e-6)
    return np.concatenate([(f[s: s + 256] @ f.T >= near).sum(axis=1) == 1 for s in range(0, len(f), 256)])


def build(x: np.ndarray, radii: tuple[float, ...] = RADII) -> tuple[Tree, np.ndarray]:
    """(tree, order of the rows of ``x`` in it)."""
    n = len(x)
    order = np.arange(n)
    starts, radius = [np.array([0])], [np.array([_dist(x @ x[0]).max()])]
    for r in radii:
        near = 1 - r * r / 2  # cosine at the level's radius
        bounds = np.r_[starts[-1], n]
        one = np.diff(bounds) == 1
        begin, cover = [starts[-1][one]], [np.zeros(one.sum())]
        for s, e in zip(bounds[:-1][~one], bounds[1:][~one]):
            left, at, alone = order[s:e].copy(), s, order[:0]
            while len(left):
                cos = x[left] @ x[left[0]] if len(left) > 1 else np.ones(1)
                mine = cos >= near
                mine[0] = True
                k = int(mine.sum())
                begin.append([at])
                cover.append([float(_dist(cos[mine].min())) if k > 1 else 0.0])
                order[at: at + k] = left[mine]
                left, at = left[~mine], at + k
                if at == s + k and len(left) >= _LONE:
                    lone = _lone(x[left], near)
                    alone, left = left[lone], left[~lone]
            order[at:e] = alone
            begin.append(np.arange(at, e))
            cover.append(np.zeros(e - at))
        begin, cover = np.concatenate(begin).astype(np.int64), np.concatenate(cover)
        sort = begin.argsort()
        starts.append(begin[sort])
        radius.append(cover[sort])
    return Tree(x[order], starts, radius), order


def split(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of ``x`` in parts of at most ``most`` near each other: halves by the
    direction between two far ends."""
    done, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        y = x[rows]
        p = y[(y @ y[0]).argmin()]
        along = (y @ (p - y[(y @ p).argmin()])).argsort(kind="stable")
        todo += [np.sort(rows[along[: len(rows) // 2]]), np.sort(rows[along[len(rows) // 2:]])]
    return done


def _open(first_a, first_b, count_a, count_b):
    """All pairs of children of each pair of nodes."""
    size = count_a * count_b
    owner = np.repeat(np.arange(len(size)), size)
    k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return first_a[owner] + k // count_b[owner], first_b[owner] + k % count_b[owner]


def _pairs(a: Tree, b: Tree, fa, fb, ca, cb, pos_a, pos_b, ra, rb, floor):
    """Open pairs of ranges ``[fa, fa+ca) x [fb, fb+cb)``; positions map to
    vectors through ``pos_a``/``pos_b`` and to radii through ``ra``/``rb``.
    Yields (i, j, cosine) where the cosine reaches ``floor`` of the radii's
    sum. Large ranges are sifted by single-precision products, with the floor
    lowered by more than their rounding, narrow nodes apart from wide ones;
    every cosine that is handed on is a double-precision one. The first product
    is of a part of the components and an upper bound (``Tree.short``), while it
    leaves few pairs."""
    big = ca * cb > _MANY
    slack = 2e-7 * a.x.shape[1] + 1e-6
    brief = a.x.shape[1] >= _SHORT
    for k in np.flatnonzero(big):
        columns = np.arange(fb[k], fb[k] + cb[k])
        width = np.searchsorted(_NARROW, rb[columns])
        for part in (columns[width == w] for w in np.unique(width)):
            top, right = rb[part].max(), [t.T for t in (b.short[pos_b[part]], b.single[pos_b[part]])]
            for s in range(fa[k], fa[k] + ca[k], 128):
                e = min(s + 128, fa[k] + ca[k])
                least = (floor(ra[s:e] + top) - slack).astype(np.float32)[:, None]
                if brief:
                    hit = np.flatnonzero(a.short[pos_a[s:e]] @ right[0] >= least)
                    brief = 64 * len(hit) <= (e - s) * len(part)
                if not brief:
                    hit = np.flatnonzero(a.single[pos_a[s:e]] @ right[1] >= least)
                at, to = np.divmod(hit, len(part))
                for x in range(0, len(at), _CHUNK):
                    i, j = at[x: x + _CHUNK] + s, part[to[x: x + _CHUNK]]
                    cos = np.einsum("ij,ij->i", a.x[pos_a[i]], b.x[pos_b[j]])
                    ok = cos >= floor(ra[i] + rb[j])
                    yield i[ok], j[ok], cos[ok]
    fa, fb, ca, cb = (v[~big] for v in (fa, fb, ca, cb))
    cut = np.r_[0, np.flatnonzero(np.diff(np.cumsum(ca * cb) // _CHUNK)) + 1, len(fa)]
    for s, e in zip(cut[:-1], cut[1:]):
        if s == e:
            continue
        i, j = _open(fa[s:e], fb[s:e], ca[s:e], cb[s:e])
        cos = np.einsum("ij,ij->i", a.x[pos_a[i]], b.x[pos_b[j]])
        ok = cos >= floor(ra[i] + rb[j])
        yield i[ok], j[ok], cos[ok]


def _levels(a: Tree, b: Tree) -> list[int]:
    """Levels to descend by: the root's, the last, and between them those with
    at most half of the nodes of the next."""
    count = [len(x) + len(y) for x, y in zip(a.starts, b.starts)]
    levels = [len(count) - 1]
    for k in range(len(count) - 2, 0, -1):
        if 2 * count[k] <= count[levels[0]]:
            levels.insert(0, k)
    return [0, *levels]


def links(a: Tree, b: Tree, wa: np.ndarray, wb: np.ndarray, threshold: float = THRESHOLD):
    """Dual traversal. Returns (weighted links per vector of ``a``, of ``b``,
    edges as two arrays of positions that connect what is linked, those of ``b``
    after all of ``a``). ``b is a`` pairs a block with itself, in one numbering."""
    same = b is a
    off = 0 if same else len(a.x)
    reach = float(_dist(np.float64(threshold)))
    na, nb = np.zeros(len(a.x)), np.zeros(len(b.x))
    edges = np.empty((2, 0), np.int64)

    def keep(u: np.ndarray, v: np.ndarray) -> None:
        nonlocal edges, held
        held.append((u, v))
        if sum(len(x) for x, _ in held) > _EDGES:
            edges, held = _forest(off + len(b.x), np.hstack([edges, *held])), []

    held: list[tuple[np.ndarray, np.ndarray]] = []
    if not same and _dist(a.x[0] @ b.x[0]) - a.radius[0][0] - b.radius[0][0] > reach + SLACK:
        return na, nb, *edges
    sum_a, sum_b = np.r_[0, np.cumsum(wa)], np.r_[0, np.cumsum(wb)]
    floor = lambda r: 1 - np.minimum(r + reach + SLACK, 2.0) ** 2 / 2 - SLACK
    ia, ib = np.array([0]), np.array([0])
    levels = _levels(a, b)
    for level, to in zip(levels[:-1], levels[1:]):
        ka, kb = a.children(level, to), b.children(level, to)
        ra, rb = a.radius[to], b.radius[to]
        end_a, end_b = a.bounds(to), b.bounds(to)
        size_a, size_b = np.diff(end_a), np.diff(end_b)
        next_a, next_b = [], []
        for i, j, cos in _pairs(a, b, ka[ia], kb[ib], np.diff(ka)[ia], np.diff(kb)[ib], a.starts[to], b.starts[to], ra, rb, floor):
            d = _dist(cos)
            near = d - ra[i] - rb[j] <= reach + SLACK
            if same:
                near &= i <= j
            # pairs of single vectors are compared at the bottom, many at a time
            whole = near & (d + ra[i] + rb[j] <= reach - SLACK) & (size_a[i] * size_b[j] > 1)
            for k in np.flatnonzero(near & ~whole & (size_a[i] * size_b[j] >= _BALL)):
                (p, rp), (q, rq) = a.ball(to, i[k]), b.ball(to, j[k])
                whole[k] = np.sqrt(((p - q) ** 2).sum()) + rp + rq <= reach - SLACK
            for x, y in zip(i[whole], j[whole]):
                sa, ea, sb, eb = end_a[x], end_a[x + 1], end_b[y], end_b[y + 1]
                na[sa:ea] += sum_b[eb] - sum_b[sb]
                if same and x == y:  # all of a node's vectors are near each other
                    na[sa:ea] -= wa[sa:ea]
                else:
                    nb[sb:eb] += sum_a[ea] - sum_a[sa]
                keep(np.r_[np.full(eb - sb, sa), np.arange(sa, ea)], np.r_[np.arange(sb, eb), np.full(ea - sa, sb)] + off)
            near &= ~whole
            next_a.append(i[near])
            next_b.append(j[near])
        ia = np.concatenate(next_a) if next_a else np.empty(0, int)
        ib = np.concatenate(next_b) if next_b else np.empty(0, int)
    low_a, low_b = a.bounds(len(a.starts) - 1), b.bounds(len(b.starts) - 1)
    for i, j, _ in _pairs(a, b, low_a[ia], low_b[ib], np.diff(low_a)[ia], np.diff(low_b)[ib], np.arange(len(a.x)), np.arange(len(b.x)),
                          np.zeros(len(a.x)), np.zeros(len(b.x)), lambda r: threshold + r):
        if same:  # a pair of different nodes comes once, a node with itself both ways
            once = i < j
            i, j = i[once], j[once]
        na += np.bincount(i, wb[j], len(na))
        nb += np.bincount(j, wa[i], len(nb))
        keep(i, j + off)
    return na, nb, *_forest(off + len(b.x), np.hstack([edges, *held]))


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest position of ``n`` reachable over edges between positions."""
    lab = np.arange(n)
    while True:
        least = np.minimum(lab[u], lab[v])
        new = lab.copy()
        for at in (u, v, lab[u], lab[v]):
            np.minimum.at(new, at, least)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def _forest(n: int, edges: np.ndarray) -> np.ndarray:
    """Edges that connect the same positions, at most one a position."""
    root = _roots(n, *edges)
    some = np.flatnonzero(root != np.arange(n))
    return np.stack([some, root[some]])


def _placed(rb: pa.RecordBatch, centres: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(length, cell of the nearest centre) of each vector."""
    vectors = rb.column("v")
    dims = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    at, cell = np.cumsum(dims) - dims, np.zeros(len(dims), np.int64)
    for d in np.unique(dims):
        if int(d) in centres:
            rows = np.flatnonzero(dims == d)
            cell[rows] = (unit(flat[at[rows][:, None] + np.arange(d)]) @ centres[int(d)].T).argmax(axis=1)
    return dims, cell


def _count_task(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            (dim, cell), n = np.unique(_placed(rb, centres), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(dim), pa.array(cell), pa.array(n)], ["dim", "cell", "n"])
    return run


def _deal_task(centres: dict[int, np.ndarray], units: dict[tuple[int, int], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            dim, cell = _placed(rb, centres)
            # a cell that rounding leaves out of the count is one unit
            many = np.array([units.get(k, 1) for k in zip(dim.tolist(), cell.tolist())], np.int64)
            part = rb.column("hashed").to_numpy() % many
            yield pa.RecordBatch.from_arrays([rb.column("rep"), rb.column("size"), rb.column("v"), pa.array(dim), pa.array(cell), pa.array(part)],
                                             ["rep", "size", "v", "dim", "cell", "unit"])
    return run


def _tree_task(centres: dict[int, np.ndarray], root: str, most: int):
    """Write the cover trees of a unit's blocks as a file: a row of packed
    arrays each, the vectors as they were given."""
    def run(table: pa.Table) -> pa.Table:
        dim, cell, part = (table[c][0].as_py() for c in ("dim", "cell", "unit"))
        rep, size = table["rep"].to_numpy(), table["size"].to_numpy().astype(np.float64)
        own = table["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        by = rep.argsort(kind="stable")
        x, rows = unit(own[by]), []
        for block in split(x, most):
            tree, order = build(x[block])
            at = by[block[order]]
            # radii are rounded up
            radius = [np.where(r > 0, np.nextafter(r.astype(np.float32), np.float32(np.inf)), 0).astype(np.float32) for r in tree.radius]
            rows.append({"ids": rep[at].tobytes(), "sizes": size[at].tobytes(), "x": own[at].tobytes(),
                         "starts": [s.astype(np.int32).tobytes() for s in tree.starts], "radius": [r.tobytes() for r in radius]})
        far = float(_dist(x @ centres[dim][cell]).max()) if dim in centres else 2.0
        name = f"{root}/{uuid.uuid4().hex}.arrow"
        files, path = file_system(name)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with files.open_output_stream(path) as out, pa.ipc.new_file(out, _TREE) as file:
            file.write_table(pa.Table.from_pylist(rows, schema=_TREE))
        return pa.table({"dim": [dim], "cell": [cell], "unit": [part], "path": [name], "far": [far]})
    return run


def _load(name: str, dim: int) -> list[tuple[Tree, np.ndarray, np.ndarray]]:
    files, path = file_system(name)
    with files.open_input_file(path) as file:
        rows = pa.ipc.open_file(file).read_all().to_pylist()
    out = []
    for row in rows:
        ids = np.frombuffer(row["ids"], np.int64)
        own = np.frombuffer(row["x"], np.float32 if len(row["x"]) == 4 * dim * len(ids) else np.float64).reshape(-1, dim)
        tree = Tree(unit(own), [np.frombuffer(s, np.int32).astype(np.int64) for s in row["starts"]], [np.frombuffer(r, np.float32).astype(np.float64) for r in row["radius"]])
        out.append((tree, ids, np.frombuffer(row["sizes"], np.float64)))
    return out


def _meet(a: list, b: list, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, links, an id linked with it over any number of links) of the linked
    vectors of two units; ``b is a`` pairs a unit with itself."""
    both = a if b is a else a + b
    at = np.cumsum([0] + [len(ids) for _, ids, _ in both])
    n, edges = np.zeros(at[-1]), [np.empty((2, 0), np.int64)]
    for i, (x, _, wx) in enumerate(a):
        for j, (y, _, wy) in enumerate(b):
            if b is a and j < i:
                continue
            k = j if b is a else len(a) + j
            nx, ny, u, v = links(x, y, wx, wy, threshold)
            n[at[i]: at[i + 1]] += nx
            n[at[k]: at[k + 1]] += ny
            place = np.r_[np.arange(at[i], at[i + 1]), np.arange(at[k], at[k + 1])]
            edges.append(place[np.stack([u, v])])
    root = _roots(at[-1], *np.hstack(edges))
    ids, some = np.concatenate([x for _, x, _ in both]), n > 0
    return ids[some], n[some].astype(np.int64), ids[root[some]]


def _pair_task(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (None, [])
        for rb in batches:
            for dim, first, second in zip(*(rb.column(c).to_pylist() for c in ("dim", "a", "b"))):
                if held[0] != first:
                    held = (first, _load(first, dim))
                met = _meet(held[1], held[1] if second == first else _load(second, dim), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in met], ["id", "links", "root"])
    return run


def _centres(sample: list[np.ndarray], counts: dict[int, int]) -> dict[int, np.ndarray]:
    """Farthest-first centres per vector length."""
    out = {}
    for dim, n in counts.items():
        x = [s for s in sample if len(s) == dim]
        if not x:
            continue
        x = unit(np.stack(x))
        pick = [0]
        near = x @ x[0]
        while len(pick) < min(CELLS, len(x), -(-n // BLOCK)):
            pick.append(int(near.argmin()))
            near = np.maximum(near, x @ x[pick[-1]])
        out[dim] = x[pick]
    return out


def _representatives(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rep, size, v`` of every class. Vectors without copies are passed on as
    they are read; only those of repeated classes are shuffled, while these are
    few, else all."""
    repeated = classes.where("size > 1").select("h1", "h2", "rep", "size")
    n = repeated.count()
    lone = [F.col("vec_id").alias("rep"), F.lit(1).cast("long").alias("size"), "v"]
    if not n:
        return rows.select(*lone)
    known = broadcast_if_small(repeated, n, 48)
    if known is repeated:
        return stored(rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("v").alias("v")), "classes").drop("h1", "h2")
    copies = rows.join(known, ["h1", "h2"]).groupBy("h1", "h2").agg(F.first("rep").alias("rep"), F.first("size").alias("size"), F.first("v").alias("v"))
    return rows.join(known, ["h1", "h2"], "left_anti").select(*lone).unionByName(stored(copies, "classes").select("rep", "size", "v"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of
    ``vectors (vec_id, embedding)``."""
    spark = vectors.sparkSession
    given = vectors.schema["embedding"].dataType
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    fine = F.coalesce(F.col("vec_id").isNotNull() & ~bad & some, F.lit(False))
    single = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("embedding") if single else v).alias("v"), fine.alias("fine"),
                          F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"))
    classes = stored(rows.where("fine").select("h1", "h2", "vec_id", F.size("v").cast("long").alias("dim")).groupBy("h1", "h2")
                     .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("dim").alias("dim")), "vectors")
    counts = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    total = sum(counts.values())
    reps = _representatives(rows.where("fine").select("h1", "h2", "vec_id", "v"), classes)
    part = hash_sample(F.xxhash64("rep"), SAMPLE, total)
    sample = [np.array(r["v"]) for r in reps.where(part).orderBy("rep").select("v").collect()]
    centres = _centres(sample, counts)

    held = {d: max(1, UNIT_BYTES // (8 * d * BLOCK)) * BLOCK for d in counts}  # vectors of a unit
    sizes = reps.select("v").mapInArrow(_count_task(centres), "dim long, cell long, n long").groupBy("dim", "cell").agg(F.sum("n").alias("n")).collect()
    parts = {(r["dim"], r["cell"]): -(-r["n"] // held[r["dim"]]) for r in sizes}
    dealt = reps.select("rep", "size", "v", F.xxhash64("rep").alias("hashed")) \
        .mapInArrow(_deal_task(centres, parts), f"rep long, size long, v array<{'float' if single else 'double'}>, dim long, cell long, unit long") \
        .repartition(partitions_for(spark, sum(parts.values()), TASK_UNITS), "dim", "cell", "unit")
    units = stored(dealt.groupBy("dim", "cell", "unit").applyInArrow(
        _tree_task(centres, as_uri(shared_path(spark, "trees")), BLOCK), "dim long, cell long, unit long, path string, far double"), "units")
    cells = {(r["dim"], r["cell"]): (r["n"], r["far"]) for r in units.groupBy("dim", "cell").agg((F.max("unit") + 1).alias("n"), F.max("far").alias("far")).collect()}
    reach = float(_dist(np.float64(threshold)))
    near = []
    for dim, c in cells:
        for other, e in cells:
            if other == dim and c <= e:
                centre = centres.get(dim)
                d = 0.0 if centre is None else float(_dist(centre[c] @ centre[e]))
                if d - cells[dim, c][1] - cells[dim, e][1] <= reach + SLACK:
                    near.append((dim, c, cells[dim, c][0], e, cells[dim, e][0]))
    n_pairs = sum(x[2] * x[4] for x in near)
    pairs = spark.createDataFrame(near, "dim long, ca long, na long, cb long, nb long") \
        .withColumn("ua", F.explode(F.sequence(F.lit(0).cast("long"), F.col("na") - 1))) \
        .withColumn("ub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1))).where("ca < cb or ua <= ub") \
        .select("dim", "ca", "ua", "cb", "ub").repartition(max(1, min(n_pairs, partitions_for(spark, n_pairs, TASK_PAIRS))))
    for side in "ab":
        named = units.select("dim", F.col("cell").alias("c" + side), F.col("unit").alias("u" + side), F.col("path").alias(side))
        pairs = pairs.join(broadcast_if_small(named, sum(n for n, _ in cells.values()), 256), ["dim", "c" + side, "u" + side])
    found = stored(pairs.select("dim", "a", "b").mapInArrow(_pair_task(threshold), "id long, links long, root long"), "found")

    joined = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    told = classes.select("h1", "h2", "rep", "size") \
        .join(found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links")), "rep", "left") \
        .where("size > 1 or links > 0").join(joined.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    told = stored(told, "told")
    out = rows.where("fine").select("vec_id", "h1", "h2").join(broadcast_if_small(told, told.count(), 48), ["h1", "h2"], "left").select("vec_id", "n", "component")
    rest = rows.where(~F.col("fine")).select("vec_id", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("component"))
    component = F.coalesce("component", "vec_id")
    return out.unionByName(rest).select("vec_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                                        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
