"""Where operators put tables and files that executors share, and how batches cross to Python.

Every intermediate table is written below the folder that the session names in
``spark.checkpoint.dir``; a lost executor then costs a re-run of its tasks and
never a lost intermediate.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import posixpath
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once, and of an Arrow batch. Small, as a worker stands beside a full heap.
SLICE_BYTES, BATCH_BYTES = 2 << 20, 4 << 20

_made: list[tuple[SparkSession, str]] = []


def base_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and Spark runs in one JVM."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="folioscope-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one; it goes when the driver's Python ends."""
    folder = f"{base_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, folder))
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _remove_all() -> None:
    for spark, folder in _made:
        try:
            remove(spark, folder)
        except Exception:  # noqa: BLE001  the session may be gone; the folder is then left to its owner
            return


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` below ``folder`` and read it back: cuts the lineage and runs the plan once."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))


def publish(folder: str, name: str, write) -> object:  # noqa: ANN001
    """Write a file under a name of its own and then move it, so that only whole files are seen, from whichever attempt."""
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)
    own = posixpath.join(path, f"_{name}.{uuid.uuid4().hex}")
    with fs.open_output_stream(own) as sink:
        result = write(sink)
    fs.move(own, posixpath.join(path, name))
    return result


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound what one Arrow batch to a Python worker can hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def slices(batch: pa.RecordBatch, column: str | int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of ``column``, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    yield batch.slice(start)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives its memory back at the end of a task; Spark keeps the worker's process for later ones."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
            ctypes.CDLL(None).malloc_trim(0)

    return through


def project(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns never clash with an operator's own."""
    return df.select(*[df[n] for n in names])


#: Bits (as a power of two) of a reducing filter: 4 MB at most when broadcast, whatever the number of keys; more keys only let more rows through.
FILTER_BITS = 25


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS)) + 1


def marked(df: DataFrame, key: Column, keys: DataFrame, of: str, name: str = "__may") -> DataFrame:
    """Add ``name``: false only for rows whose key is surely not in column ``of`` of ``keys``.

    The keys become a bitmap of fixed size, which is broadcast; a join with
    the keys themselves can then leave the unmarked rows where they are.
    """
    slot = _slot(F.col(of))
    bitmap = keys.select(F.bitmap_bucket_number(slot).alias("__bucket"), F.bitmap_bit_position(slot).alias("__bit")).groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bitmap"))
    own = df.withColumn("__slot", _slot(key)).withColumn("__own", F.bitmap_bucket_number("__slot")).withColumn("__at", F.bitmap_bit_position("__slot"))
    joined = own.join(F.broadcast(bitmap), F.col("__own") == F.col("__bucket"), "left")
    byte = F.conv(F.hex(F.substr("__bitmap", (F.floor(F.col("__at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.when(F.col("__bitmap").isNull(), False).otherwise(byte.bitwiseAND(F.expr("shiftleft(1, CAST(__at % 8 AS INT))")) != 0)
    return joined.withColumn(name, bit).drop("__slot", "__own", "__at", "__bucket", "__bitmap")
