"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import shared_dir, shared_folder

#: Bytes that part words: space and the five ASCII control characters 09 to 0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes of text that numpy code takes at a time.
LOT = 1 << 22
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds what Spark hands to Python at a time, on both sides, to LOT bytes or one row.

    Spark's own bound is 64 MB, of which the JVM and a worker each hold a few at once.
    """
    size = spark.conf.get(_BATCH).rstrip("b")
    if not size.isdigit() or int(size) > LOT:  # -1 is no bound; another unit is another's choice of more
        spark.conf.set(_BATCH, LOT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the cluster's checkpoint folder (spark.checkpoint.dir).

    The folder must be one that all executors share; a local one is chosen only for a local master.
    """
    small_batches(df.sparkSession)
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df, computed once and kept as Parquet in the shared folder; smaller than a checkpoint of narrow rows."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(columns: list[str], name: str) -> str:
    """name, or name with underscores before it: one that no column has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def give_back() -> None:
    """Returns to the system what a task freed: Python workers live on, and their allocators keep it for the next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def per_batch(make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: pa.Schema):
    """For mapInArrow: make() runs once a task and gives what turns a batch into columns.

    Batches with a text column come in lots of LOT bytes of text (or one longer text), which bounds
    what numpy holds at a time. What a task freed goes back to the system when it ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each, batch = make(), None
        for batch in batches:
            for a, b in lots(batch["text"]) if "text" in batch.schema.names else [(0, len(batch))]:
                yield pa.RecordBatch.from_pydict(each(batch.slice(a, b - a)), schema=schema)
        del each, batch
        give_back()

    return run


def lots(texts: pa.Array) -> list[tuple[int, int]]:
    """Row ranges of LOT bytes of text at most, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    out, at = [], 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LOT, "right")))
        out.append((at, to))
        at = to
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): row i is bytes[offsets[i]:offsets[i + 1]]; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def count_between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def word_counts(column: pa.Array) -> np.ndarray:
    """Words [^\\x20\\x09-\\x0D]+ in each row; null has none."""
    data, offsets = text_bytes(column)
    blank = BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = ~blank[firsts]
    return count_between(begins, offsets)


def crc_of_id(column: str) -> Column:
    """crc32 of the id's decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
