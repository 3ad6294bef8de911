"""Folding of batch folders into segments, under one manifest per output root.

Every table of an output root keeps one folder ``batch_id=K`` per batch. The
job folds ``FAN`` closed batches into one segment, ``batch_id=lo-hi``, for all
tables alike, and ``FAN`` segments of a level into one of the next, so the
number of live folders grows with the logarithm of the batches (size-tiered).
The newest ``KEEP`` batches stay as they are, for replays.

``_manifest/<version>.json`` lists the live segments and the last folded
batch. It is written under another name and renamed, which commits the fold at
once for all tables: a reader takes the segments of one version and the batches
after it. What a fold replaced is removed by a later fold, so a reader of the
version before still finds its files; folders of a fold that died are not live
and are overwritten by its repetition. A batch at or below ``folded`` is closed:
the job does not write it again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN, KEEP = 8, 4
_DIR = "_manifest"
_VERSIONS_KEPT = 4


@dataclass(frozen=True)
class Segment:
    lo: int
    hi: int
    level: int

    @property
    def name(self) -> str:
        return f"{self.lo}-{self.hi}"


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    folded: int | None = None  # last batch id inside a segment
    segments: tuple[Segment, ...] = ()
    dead: tuple[str, ...] = ()  # folders that this version replaced

    def closed(self, batch_id: int) -> bool:
        return self.folded is not None and int(batch_id) <= self.folded

    def live(self, batch: Column) -> Column:
        """Condition on the ``batch_id`` partition of a table."""
        if self.folded is None:
            return ~batch.contains("-")
        return batch.isin([s.name for s in self.segments]) | (~batch.contains("-") & (batch.try_cast("long") > self.folded))

    def only(self, df: DataFrame) -> DataFrame:
        return df.where(self.live(F.col("batch_id").cast("string"))) if "batch_id" in df.columns else df


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, through Hadoop's file system."""
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under another name, then rename: the file appears whole."""
    fs, target = _fs(spark, path)
    draft = _path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in names(spark, f"{root}/{_DIR}") if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, root: str) -> Manifest:
    """The newest committed version (an empty manifest before the first)."""
    found = _versions(spark, root)
    if not found:
        return Manifest()
    d = json.loads(read_text(spark, f"{root}/{_DIR}/{found[-1]:012d}.json"))
    return Manifest(d["version"], d["folded"], tuple(Segment(**s) for s in d["segments"]), tuple(d["dead"]))


def commit(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Publish ``manifest`` as its version; fails if that version exists."""
    text = json.dumps({"version": manifest.version, "folded": manifest.folded, "segments": [vars(s) for s in manifest.segments], "dead": manifest.dead})
    try:
        write_text(spark, f"{root}/{_DIR}/{manifest.version:012d}.json", text)
    except FileExistsError as e:
        raise RuntimeError(f"manifest version {manifest.version} was committed by another job") from e
    for v in _versions(spark, root)[:-_VERSIONS_KEPT]:
        remove(spark, f"{root}/{_DIR}/{v:012d}.json")


@dataclass(frozen=True)
class Fold:
    """Folders that become one segment."""

    inputs: tuple[str, ...]
    output: Segment


def plan(manifest: Manifest, batches: list[int], fan: int = FAN, keep: int = KEEP) -> Fold | None:
    """The next fold, if one is due: of segments first, else of batches."""
    for level in sorted({s.level for s in manifest.segments}):
        same = [s for s in manifest.segments if s.level == level]
        if len(same) >= fan:
            part = same[:fan]
            return Fold(tuple(s.name for s in part), Segment(part[0].lo, part[-1].hi, level + 1))
    fresh = sorted(b for b in batches if not manifest.closed(b))
    part = fresh[: max(0, len(fresh) - keep)][:fan]
    if len(part) < fan:
        return None
    return Fold(tuple(map(str, part)), Segment(part[0], part[-1], 1))


@dataclass(frozen=True)
class Table:
    """A table of the root: its folder, how deep the batch folders lie, how to
    read it, what merging does to the rows, and how to write a folder."""

    path: str
    depth: int
    read: Callable[[SparkSession, str], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    write: Callable[[DataFrame, str, str], None]


def _folders(spark: SparkSession, table: Table, name: str) -> list:
    fs, at = _fs(spark, table.path + "/*" * table.depth + f"/batch_id={name}")
    return [s.getPath() for s in fs.globStatus(at) or []]


def fold(spark: SparkSession, root: str, tables: list[Table], batches: list[int], fan: int = FAN, keep: int = KEEP) -> Fold | None:
    """Carry out the next due fold for all tables and commit it."""
    manifest = load(spark, root)
    todo = plan(manifest, batches, fan, keep)
    if todo is None:
        return None
    for table in tables:
        if any(_folders(spark, table, name) for name in todo.inputs):
            rows = table.read(spark, table.path).where(F.col("batch_id").cast("string").isin(list(todo.inputs))).drop("batch_id")
            table.write(table.merge(rows), table.path, todo.output.name)
    rest = [s for s in manifest.segments if s.name not in todo.inputs]
    folded = todo.output.hi if manifest.folded is None else max(manifest.folded, todo.output.hi)
    commit(spark, root, Manifest(manifest.version + 1, folded, tuple(sorted([*rest, todo.output], key=lambda s: s.lo)), todo.inputs))
    for table in tables:  # what the version before this one had replaced
        for name in manifest.dead:
            for folder in _folders(spark, table, name):
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return todo


def batches_of(spark: SparkSession, path: str) -> list[int]:
    """Batch ids that have a folder of their own directly under ``path``."""
    ids = [n.removeprefix("batch_id=") for n in names(spark, path) if n.startswith("batch_id=")]
    return sorted(int(i) for i in ids if i.lstrip("-").isdigit())
