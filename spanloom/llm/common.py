"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import inspect
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: The separators of ``[^\x20\x09-\x0D]+`` words, for the SQL side.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ascii_lower(text: Column | str) -> Column:
    return F.translate(text, UPPER, LOWER)


def plain_word_count(text: Column | str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Bytes of a text column: one narrow scan, a single number to the driver."""
    return df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def bucket_count(total_bytes: int, bucket_bytes: int, least: int = 8) -> int:
    """Buckets of a bounded size: their number, not their size, grows with the data."""
    return max(least, math.ceil(total_bytes / bucket_bytes))


def crc32_of_id(column: Column | str) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"), F.lit("")).cast("binary"))


def whole_number_id(df: DataFrame, column: str) -> Column:
    """The id column as a long; ids of other types have no order or number that the operators could use."""
    if not isinstance(df.schema[column].dataType, IntegralType):
        raise TypeError(f"{column} must be a whole number, not {df.schema[column].dataType.simpleString()}")
    return F.col(column).cast("long")


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def frugal(task):
    """task, a function of batches or of one or two tables, after which its Python worker gives freed memory back
    to the system: Spark keeps workers for later tasks, and those of earlier stages wait beside the ones at work."""

    def of_batches(batches):
        yield from task(batches)
        _give_back()

    def of_table(table):
        out = task(table)
        _give_back()
        return out

    def of_tables(left, right):
        out = task(left, right)
        _give_back()
        return out

    if inspect.isgeneratorfunction(task):
        return of_batches
    return of_table if len(inspect.signature(task).parameters) == 1 else of_tables


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a new one only where none is named and all tasks run here (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """df, read back from the shared checkpoint folder, so that lost executors cost nothing."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def forget_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more, as of checkpointed ones."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark reads."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
