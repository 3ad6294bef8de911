"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adsieve.session import apply_required_conf, ensure_checkpoint_dir

# Rows of one Arrow batch; texts are wide, so a batch stays at a few MB.
ARROW_ROWS = 1000
# A side is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 32 << 20

WS = r"[\x20\x09-\x0D]"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the operators rely on; returns the session."""
    apply_required_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks
    can import it wherever the driver was started from."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if any(str(f).endswith(f"{root.name}-tasks.zip") for f in sc.listFiles):
        return
    path = Path(tempfile.mkdtemp()) / f"{root.name}-tasks.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def as_uri(path: str) -> str:
    """Hadoop's spellings of a path as the URI that pyarrow takes."""
    if path.startswith("/"):
        return f"file://{path}"
    return re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", path))


def file_system(uri: str):
    """(pyarrow's file system, path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    so a lost executor recomputes nothing before this point."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast hint only below the size bound; else Spark's own choice of a
    shuffled join (AQE splits skewed partitions)."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def sample_below(bound: int, rows: int) -> int:
    """Threshold that about ``bound`` of ``rows`` 64-bit hashes lie below; exact
    in whole numbers, so it stays right at every number of rows."""
    return (bound << 64) // rows - (1 << 63)


def hash_sample(hashed: Column, bound: int, rows: int) -> Column:
    """Condition that keeps about ``bound`` of ``rows`` rows, and every row
    where there are no more than that."""
    return hashed < F.lit(sample_below(bound, rows)) if rows > bound else F.lit(True)


def partitions_for(spark: SparkSession, items: int, per_task: int) -> int:
    """Partition count that grows with the data, one full wave at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-items // per_task), 1)


def others(df: DataFrame, *names: str) -> list[Column]:
    """The columns of ``df`` but those named like an output column."""
    low = {n.lower() for n in names}
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c.lower() not in low]


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    low = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while f"__{name}" in low:
            name += "_"
        out.append(f"__{name}")
    return out


def crc_mod(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (the fold rule)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.encode(col.cast("string"), "UTF-8")) % n
