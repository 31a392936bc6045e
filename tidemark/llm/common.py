"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.session import stage, unstage

#: Bytes of text a batch handed to Python holds at most (a single longer text makes its own batch).
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this library's code to the executors, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="tidemark-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "tidemark"), "zip", root, "tidemark"))
    sc._tidemark_shipped = True


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` over slices of at most ``BATCH_BYTES`` of data.

    ``fn`` takes a record batch and yields dicts of columns; the schema gives
    their Arrow types, so empty lists and all-null columns keep their type.
    """
    ship(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what an earlier task in this worker has left
        for batch in batches:
            for part in slices(batch):
                for cols in fn(part):
                    arrays = [c if isinstance(c := cols[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                              for f in target]
                    arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
                    arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, target)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``BATCH_BYTES`` each."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * BATCH_BYTES / max(batch.nbytes, 1)))
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


_CACHE: list = []


def only_cache(name: object, forget: Callable[[], None]) -> None:
    """Says which cache a task uses now; the one that another operator left in this worker is forgotten."""
    if _CACHE and _CACHE[0] != name:
        _CACHE[1]()
        give_back()
    _CACHE[:] = [name, forget]


def give_back() -> None:
    """Hand freed memory of this worker back to the system, which the allocators would keep for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted`` with as many underscores as set it apart from the names taken, in any case."""
    names = {c.lower() for c in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def as_bytes(name: str) -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name).cast("string").cast("binary"), F.lit(b""))


__all__ = ["BATCH_BYTES", "as_bytes", "free_name", "give_back", "map_arrow", "only_cache", "ship", "slices", "stage", "table", "unstage"]
