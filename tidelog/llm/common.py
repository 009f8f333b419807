"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper- to lower-case map of the ASCII letters only.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_FOLD = str.maketrans(ASCII_UPPER, ASCII_LOWER)

#: White space of the word contracts: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    A folder of this process is made only where the session names none and
    runs in one JVM, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidelog-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """df written once to the shared folder and read again.

    Cuts the lineage: what follows reads the table, also after an executor was
    lost.  The table goes when the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tidelog-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _release(spark)
    atexit.register(_remove, spark, path)
    made = spark.read.schema(df.schema).parquet(path)
    made._tidelog_path = path
    return made


def discard(*made: DataFrame) -> None:
    """Deletes tables of ``cut`` that nothing reads any more."""
    for df in made:
        _remove(df.sparkSession, df._tidelog_path)


#: A key with more than this many rows, and more than one in HOT_SHARE of all, is joined by broadcast.
HOT_ROWS, HOT_SHARE = 1000, 10_000


def join_counted(rows: DataFrame, keyed: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """rows joined with keyed, a table of ``cut`` with one row a key and the number of the key's rows in ``count`` (dropped).

    Keys with more than 1 / HOT_SHARE of all rows are fewer than HOT_SHARE
    whatever the data, so their side is broadcast: their rows stay where they
    are and no task gets all rows of one key.  The other keys are shuffled.
    """
    found = keyed.agg(F.sum(count).alias("all"), F.max(count).alias("most")).first()
    limit = max(HOT_ROWS, (found["all"] or 0) // HOT_SHARE)
    if (found["most"] or 0) <= limit:
        return rows.join(keyed.drop(count), keys)
    hot = F.broadcast(keyed.filter(F.col(count) > limit).drop(count))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(keyed.filter(F.col(count) <= limit).drop(count), keys)
    return rows.join(hot, keys).unionByName(rest)


def _release(spark: SparkSession) -> None:
    """Lets Spark's cleaner find the shuffle files of steps that are over, else they stay until the driver's heap fills."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may be gone at exit; the folder is the cluster's scratch space
        pass


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that stand for (doc_id, text), null doc_id included.

    Rows alike in both share the key, and with it every per-row result.
    """
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))))


def in_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that column holds about ``limit`` bytes in each, one row at least.

    Bounds the working memory of the array code by the limit or one long text.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([x or 0 for x in pc.binary_length(batch.column(column)).to_pylist()], np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right"))
            stop = max(stop, at + 1)
            yield batch.slice(at, stop - at)
            at = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def arrow_map(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, slice_on: str | None = None, limit: int = 1 << 20) -> DataFrame:
    """df.mapInArrow with one output batch for each (sliced) input batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, slice_on, limit) if slice_on else batches:
            if batch.num_rows and (out := make(batch)) is not None:
                yield out

    return df.mapInArrow(over, schema)


# -- 64-bit hashing on arrays ------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (the splitmix64 step)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def pair64(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of two hashed arrays."""
    return mix64(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))))
