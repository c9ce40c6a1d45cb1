"""Session-side helpers shared by the operators: checkpoints, batch limits, bounded bitmaps."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: A bitmap has 2**BITMAP_LOG2 bits (2 MB) at every input size.
BITMAP_LOG2 = 24


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only where the setting is missing (unit tests on one machine) a scratch folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores as no column of ``df`` needs."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, work: Callable, extra: tuple[StructField, ...] = ()) -> DataFrame:
    """``df.mapInArrow`` for work that returns all columns and then ``extra``, whatever the columns are called."""
    fields = [StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)]
    out = df.toDF(*[f.name for f in fields]).mapInArrow(work, StructType([*fields, *extra]))
    return out.toDF(*[f.name for f in df.schema.fields], *[f.name for f in extra])


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are in the shared folder, lost executors cost nothing."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def few(df: DataFrame, rows: int, each: int = 200_000) -> DataFrame:
    """``df`` of about ``rows`` rows in no more partitions than they need: a small table makes no file for each shuffle partition."""
    return df.coalesce(1 + rows // each)


def smallest_hashes(df: DataFrame, key: Column, ties: list[str], rows: int, most: int) -> DataFrame:
    """The ``most`` of the ``rows`` rows of ``df`` with the smallest hash; about that many leave all tasks together.

    A bound on the hash goes before the sort.  It keeps the wanted rows and eight standard deviations more; keys must be mostly distinct.
    """
    share = (most + 8 * most ** 0.5 + 64) / max(1, rows)
    if share < 1:
        df = df.where(key < F.lit(int(share * 2.0 ** 64) - (1 << 63)).cast("long"))
    return df.orderBy(key, *ties).limit(most)


_shipped: set[str] = set()


def prepare(spark: SparkSession, rows: int = 4000, size: str = "2m") -> None:
    """For Python tasks: bound their Arrow batches by rows and bytes, and give them this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for file in package.rglob("*.py"):
            z.write(file, file.relative_to(package.parent))
    sc.addPyFile(target)  # the driver serves it to all executors


def bitmap(df: DataFrame, key: Column, log2: int = BITMAP_LOG2) -> np.ndarray:
    """Bits of ``key mod 2**log2`` as bytes: at most 2**(log2-6) words reach the driver.

    A superset test (false positives only); every caller filters exactly afterwards.
    """
    bit = key.bitwiseAND(F.lit((1 << log2) - 1))
    words = (df.select(bit.alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
             .toPandas())
    out = np.zeros(1 << (log2 - 6), dtype=np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def in_bitmap(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Vectorised membership of uint64 keys in a ``bitmap`` result."""
    bit = keys & np.uint64(len(words) * 64 - 1)
    return ((words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool)
