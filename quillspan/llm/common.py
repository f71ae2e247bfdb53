"""Helpers that the corpus operators share: scratch tables in the shared folder, words, and row batches."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes that separate words: space and U+0009 to U+000D. Fixed by the words' definition.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Rows up to which a table that was counted is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a temporary one, and only if all executors are in this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        keep = tempfile.TemporaryDirectory(prefix="quillspan-")
        atexit.register(keep.cleanup)
        root = f"file://{keep.name}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table or archive, where every executor can read it, in one folder for each application."""
    return f"{shared_root(spark)}/quillspan-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a Parquet table in the shared folder.

    Cuts the lineage: what comes after survives lost executors without running df again,
    and df runs once however often its rows are used.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["written_to"] = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables of `written` that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.__dict__["written_to"])
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has at most BROADCAST_ROWS rows."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hands rows to Python by the thousand, so that neither side holds more texts at once. Lasts for the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A mapInArrow function after which the worker, which Spark keeps for later tasks, gives freed memory back to the system."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        pa.set_memory_pool(pa.system_memory_pool())  # the one that can be trimmed
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def matching(keep: Callable[[list], np.ndarray], rows: int = 256):
    """A function of a column of texts, from one of lists of texts to booleans. Few texts are decoded at once."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("boolean")
    def match(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            for column in texts:
                parts = [np.asarray(keep(column.slice(at, rows).to_pylist()), bool) for at in range(0, len(column), rows)]
                yield pa.array(np.concatenate([np.empty(0, bool), *parts]))
        finally:
            give_back()

    return match


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: nothing to trim


def words(text: str | None, fold: bool = False) -> list[str]:
    """The words of a text: runs of anything but space and U+0009 to U+000D. None: no words."""
    if not text:
        return []
    for c in "\t\n\x0b\x0c\r":
        if c in text:
            text = text.replace(c, " ")
    if fold:
        # bytes.lower() changes A-Z alone, and is much faster than a translation table
        text = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return [w for w in text.split(" ") if w]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that decoded texts of few rows are held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def frombuffers(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Binary values of `width` bytes each, none null, as a matrix with a row for each, without a copy."""
    n = len(column)
    if not n:
        return np.empty((0, width // np.dtype(dtype).itemsize), dtype)
    _, offsets, data = column.buffers()
    start = int(np.frombuffer(offsets, np.int32)[column.offset])
    return np.frombuffer(data, np.uint8)[start : start + n * width].view(dtype).reshape(n, -1)


def binaries(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    raw = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * np.int32(raw.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def summed(vectors: DataFrame, length: int, chunk: int = 4096, dtype=np.float64) -> np.ndarray | None:
    """The sum, in doubles, of the vectors of dtype in the column v (binary), each of `length`; None if there are none.

    The vectors are cut to pieces, and each piece is summed as it streams through the task that has its number:
    no task holds more than its pieces of one vector, however many vectors there are.
    """
    from pyspark.sql import functions as F

    pieces, size = ceil_div(length, chunk), chunk * np.dtype(dtype).itemsize

    @released
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                total[k] = total.get(k, 0.0) + np.frombuffer(v, dtype).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["k", "v"])

    cut = vectors.select("v", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("k"))
    cut = cut.select("k", F.substring("v", F.col("k") * size + 1, F.lit(size)).alias("v"))
    found = {r.k: np.frombuffer(r.v, np.float64) for r in cut.repartition(pieces, "k").mapInArrow(add, "k int, v binary").collect()}
    return np.concatenate([found[k] for k in range(pieces)]) if found else None
