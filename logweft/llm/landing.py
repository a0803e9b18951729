"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft.session import new_shared_path

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: For rows of 100 KB and more.  Parquet looks at sizes after 100 rows only, and Spark's reader holds 4,096 rows of a
#: row group at once: here pages and row groups end by their size, whatever the number of rows.
LONG_ROWS = {"parquet.block.size": 4 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}


def landed(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` below ``spark.checkpoint.dir`` and go on from there."""
    return _written(frame, new_shared_path(frame.sparkSession, name))


class Scratch:
    """Landed tables of one computation, each removed once nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, new_shared_path(spark, name)

    def land(self, frame: DataFrame, name: str, arrow_bytes: int | None = None, **options) -> DataFrame:
        """``options`` are of the writer; batches that go to Python meanwhile are of ``arrow_bytes`` at most, or one row."""
        return _written(frame, f"{self.folder}/{name}", arrow_bytes, options)

    def drop(self, name: str = "") -> None:
        """Remove one table, or all of them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _written(frame: DataFrame, path: str, arrow_bytes: int | None = None, options: dict | None = None) -> DataFrame:
    """``frame`` as written to ``path``.

    What was shuffled to write it is not needed again and is removed at once; the settings for that and for the size of
    batches are put back.
    """
    spark = frame.sparkSession
    settings = {_CLEAN: "true"} | ({_ARROW_BYTES: str(arrow_bytes)} if arrow_bytes else {})
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        frame.write.options(**(options or {})).parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(frame.schema).parquet(path)


def small(frame: DataFrame, rows: int) -> DataFrame:
    """A landed frame, marked for broadcast if it has no more than ``rows`` rows."""
    return F.broadcast(frame) if frame.count() <= rows else frame
