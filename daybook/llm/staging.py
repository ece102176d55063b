"""Written intermediate tables in the shared folder, and their removal."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from daybook.session import new_path


class Stages:
    """Frames written once as Parquet to the shared folder and read back.

    A written table cuts lineage, is readable by every executor after any of them is lost, and gives the
    planner real sizes.  ``drop`` removes tables that nothing lazy reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = new_path(spark, name)
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:04d}"
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._stage_path = path
        return stored

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._stage_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def tidy(each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for ``mapInArrow`` after whose last batch the worker hands its free memory back to the machine.

    Spark uses a worker again for other tasks: what one stage needed for a while would count against the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from each(batches)
        _release()

    return run


def _release() -> None:
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library, which has no such call
        pass
