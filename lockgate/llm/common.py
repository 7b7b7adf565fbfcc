"""What the text operators share: work tables, word patterns, held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lockgate.sources.storage import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Work:
    """Tables of one run, below the shared folder that ``spark.checkpoint.dir`` names.

    Writing a table and reading it again cuts the lineage in a way that survives lost
    executors. Only a local session without the setting gets a folder of its own.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = scratch_path(spark, name)

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        """Write ``frame`` as Parquet and return a frame that reads it."""
        frame.write.parquet(f"{self.root}/{name}")
        # what led to the table is done with: let the cleaner drop its shuffle files
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(frame.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        """Delete a table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of ``text``: runs of anything but ASCII white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor
