"""Packing of tokenized documents by cutting-stock column generation.

1. Tasks tokenize every whole text, append the end id and cut the ids at
   multiples of the capacity. The pieces (without ids) are stored.
2. The histogram of piece lengths, in steps of ``UNIT`` tokens (at most 128
   rows, however large the corpus), goes to the driver. A linear program over patterns (how many
   pieces of each length share a sequence) is solved by column generation: an
   unbounded-knapsack dynamic program prices the next pattern, the simplex
   basis takes it in, until the gap to the bound is below ``GAP``.
3. Pattern counts are rounded down. Pieces get a rank within their length, in
   two levels so that a length holding a third of all rows spreads over many
   tasks, and the rank alone names pattern, sequence and offset. Repeated rows
   are dealt by their place in the stored table, ``RANK_ROWS`` at a time.
4. What rounding leaves over is less than one sequence per pattern, so at most
   ``capacity`` sequences: these pieces are laid end to end and cut at the
   capacity. The last stretch is cut into powers of two. Padding is what the
   steps round up (about 0.7% of the tokens) and what patterns leave free.

Defined results: a null text counts as empty, its only id is the end id. Rows
without id and repeated rows are packed like any other, each for itself. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adsieve.llm.common import broadcast_if_small, partitions_for, stored
from adsieve.llm.tokens import ByteEncoder, encoder

CAPACITY = 1024
END_ID = 0
UNIT = 8  # tokens; the linear program sees lengths rounded up to it
GAP = 5e-4
MAX_COLUMNS = 4000  # of the linear program; stopping early only costs padding
RANK_ROWS = 100_000
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _documents(path: str, batches: Iterator[pa.RecordBatch]):
    enc = encoder(ByteEncoder, path)
    end = int(END_ID).to_bytes(4, "little")
    for rb in batches:
        yield [(d, enc.ids(t or "") + end) for d, t in zip(rb.column("doc_id").to_pylist(), rb.column("text").to_pylist())]


def _cut_task(path: str, capacity: int):
    schema = pa.schema([(n, pa.int64()) for n in COLUMNS[:5]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _documents(path, batches):
            out = []
            for doc, ids in docs:
                n = len(ids) // 4
                for a in range(0, n, capacity):
                    part = ids[4 * a: 4 * (a + capacity)]
                    out.append((doc, a, len(part) // 4, zlib.crc32(part), n))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=schema)
    return run


def _tail_task(path: str, capacity: int):
    schema = pa.schema([("doc", pa.int64()), ("crc", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _documents(path, batches):
            out = []
            for doc, ids in docs:
                n = len(ids) // 4
                tail = ids[4 * (n - n % capacity):]
                out.append((doc, zlib.crc32(tail), n, tail))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), schema.types)], schema=schema)
    return run


def price(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern that fits (value, counts)."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1)
    fit = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fit[c]:
            got = best[c - lengths[: fit[c]]] + value[: fit[c]]
            k = int(got.argmax())
            if got[k] > best[c]:
                best[c], take[c] = got[k], k
    counts = np.zeros(len(lengths))
    c = capacity
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            counts[take[c]] += 1
            c -= int(lengths[take[c]])
    return float(best[capacity]), counts


def patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the linear program's basis and their (fractional) use."""
    m = len(lengths)
    basis = np.diag((capacity // lengths).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    use = inverse @ demand
    for _ in range(MAX_COLUMNS):
        dual = inverse.sum(axis=0)
        value, column = price(lengths, dual, capacity)
        total = use.sum()
        if value <= 1 + 1e-9 or total - total / value <= GAP * total:
            break
        step = inverse @ column
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        use = np.maximum(use - ratio[out] * step, 0)
        use[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        basis[:, out] = column
    return basis.T.astype(int).reshape(-1, m), use


def plan(histogram: dict[int, int], capacity: int = CAPACITY // UNIT) -> tuple[list[tuple], int]:
    """Rounded patterns as slots ``(units, from_rank, to_rank, copies,
    first_sequence, first_slot)``, and the number of sequences they fill;
    ``histogram`` counts pieces by their length in units."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[int(n)] for n in lengths], dtype=float)
    slots, sequence = [], 0
    given = np.zeros(len(lengths), dtype=np.int64)
    if not len(lengths):
        return slots, sequence
    for counts, use in zip(*patterns(lengths, demand, capacity)):
        # never more than there is, whatever the rounding of the solver
        times = min([int(use + 1e-6), *((int(demand[i]) - given[i]) // counts[i] for i in np.flatnonzero(counts))])
        if times <= 0:
            continue
        slot = 0
        for i in np.flatnonzero(counts)[::-1]:
            n, a = int(lengths[i]), int(counts[i])
            slots.append((n, int(given[i]), int(given[i]) + times * a, a, sequence, slot))
            given[i] += times * a
            slot += a
        sequence += times
    return slots, sequence


def lay(rest: list[tuple], sequence: int, capacity: int = CAPACITY) -> list[tuple]:
    """Lay pieces end to end over full sequences; the last stretch is cut into
    powers of two. Yields (piece, start in piece, length, sequence, offset)."""
    total = sum(p["length"] for p in rest)
    sizes = [capacity] * (total // capacity)
    left = total % capacity
    sizes += [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    out, k, room = [], 0, sizes[0] if sizes else 0
    for p in rest:
        at = 0
        while at < p["length"]:
            n = min(room, p["length"] - at)
            out.append((p, at, n, sequence + k, sizes[k] - room))
            at, room = at + n, room - n
            if not room and k + 1 < len(sizes):
                k += 1
                room = sizes[k]
    return out


def _parts(pieces: DataFrame, n: int) -> DataFrame:
    k = partitions_for(pieces.sparkSession, n, RANK_ROWS)
    chunk = F.floor(F.col("row") / RANK_ROWS)  # equal rows of one chunk share a part, others do not
    return pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", chunk), F.lit(k)))


def _ranked(pieces: DataFrame, n: int) -> DataFrame:
    """Rank of each piece among those of its units (from 0), in two levels."""
    keyed = _parts(pieces, n)
    before = Window.partitionBy("units").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("units", "part").count().select("units", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("units", "part").orderBy("doc_id", "start", "ids_crc32")
    return (
        keyed.withColumn("own", F.row_number().over(order) - 1).join(offsets, ["units", "part"])
        .withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "part", "row")
    )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``. ``path`` names the tokenizer's file."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stored(source.mapInArrow(_cut_task(path, capacity), _PIECE).withColumn("row", F.monotonically_increasing_id()), "pieces")
    pieces = pieces.withColumn("units", F.ceil(F.col("length") / UNIT))
    histogram = {r["units"]: r["count"] for r in pieces.groupBy("units").count().collect()}
    slots, n_sequences = plan(histogram, capacity // UNIT)
    ranked = stored(_ranked(pieces, sum(histogram.values())), "ranked")

    side = spark.createDataFrame(slots, "u long, a long, z long, copies long, seq long, slot long")
    inside = F.col("rank") - F.col("a")
    mine = (F.col("units") == F.col("u")) & (F.col("rank") >= F.col("a")) & (F.col("rank") < F.col("z"))
    ahead = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.join(broadcast_if_small(side, len(slots), 64), mine).select(
        *COLUMNS[:5],
        (F.col("seq") + F.floor(inside / F.col("copies"))).alias("sequence_id"),
        (F.col("slot") + inside % F.col("copies")).alias("place"),
    ).select(*COLUMNS[:6], F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"))

    given = {}
    for n, _, z, *_ in slots:
        given[n] = max(z, given.get(n, 0))
    ends = spark.createDataFrame([(n, given.get(n, 0)) for n in histogram], "u long, z long")
    rest = ranked.join(F.broadcast(ends), (F.col("units") == F.col("u")) & (F.col("rank") >= F.col("z"))) \
        .select(*COLUMNS[:5]).orderBy(F.desc("length"), "doc_id", "start").collect()
    moves = [(p["doc_id"], p["ids_crc32"], p["doc_tokens"], p["start"], at, n, seq, off)
             for p, at, n, seq, off in lay(rest, n_sequences, capacity)]
    moved = spark.createDataFrame(moves, "doc_id long, crc long, doc_tokens long, first long, at long, length long, sequence_id long, offset long")
    return _rest(source, moved, len(moves), path, capacity).unionByName(placed) if moves else placed


def _rest(source: DataFrame, moved: DataFrame, n: int, path: str, capacity: int) -> DataFrame:
    """Rows of the pieces that were laid end to end; their ids are made anew."""
    moved = broadcast_if_small(moved, n, 80)
    ids = source.join(broadcast_if_small(moved.select(F.col("doc_id").alias("d")).distinct(), n, 16), F.col("doc_id").eqNullSafe(F.col("d")), "left_semi") \
        .mapInArrow(_tail_task(path, capacity), "doc long, c long, n long, ids binary").dropDuplicates(["doc", "c", "n"])
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("crc") == F.col("c")) & (F.col("doc_tokens") == F.col("n"))
    part = F.substring(F.col("ids"), (F.col("at") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return ids.join(moved, same).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "length",
        F.crc32(part).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
