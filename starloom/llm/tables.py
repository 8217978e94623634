"""Reading and writing around the operators: tables, scratch copies, size checks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Ids that may be broadcast to find rows by id: 8 bytes each, 16 MB.
BROADCAST_IDS = 2_000_000


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; other columns, whatever their names, stay unread."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*[f"`{c}`" for c in columns])


def id_text(texts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    return texts.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))


def keyed(docs: DataFrame, id_column: str, text_column: str, *more) -> DataFrame:
    """``id``, ``text`` and a ``doc_id`` that is the id, or a hash of the text where that is null."""
    key = F.col(id_column).cast("long")
    text = F.col(text_column)
    return docs.select(key.alias("id"), F.coalesce(key, F.xxhash64(F.lit("no id"), text)).alias("doc_id"), text.alias("text"), *more)


def crc_part(column, parts: int):
    """``crc32`` of an id as text, modulo ``parts``; a null id is in part 0."""
    return F.coalesce(F.crc32(column.cast("string")) % parts, F.lit(0))


def matching(df: DataFrame, ids: DataFrame, count: int, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``doc_id`` is in ``ids`` (``count`` distinct rows), or not in it.

    Up to ``BROADCAST_IDS`` ids are sent to the rows, so that other rows are
    dropped before any shuffle; beyond that both sides are shuffled.
    """
    keys = ids.select("doc_id")
    return df.join(F.broadcast(keys) if count <= BROADCAST_IDS else keys, "doc_id", how)


def rebatched(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def longs(values) -> pa.Array:
    return pa.array(np.asarray(values, np.int64))


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcasts a small object together with the code of its class."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(held: Broadcast):
    return cloudpickle.loads(held.value)


class Scratch:
    """Tables of one run in the folder that all executors share.

    A table cuts the lineage: lost executors read it again instead of
    computing it again. Shuffle files of a step go when its table is written,
    and tables go when no later step reads them.
    """

    def __init__(self, spark: SparkSession, label: str, arrow_rows: int | None = None):
        """``arrow_rows`` bounds the rows of a batch that goes to Python; rows with whole texts need fewer than Spark's 10,000."""
        self.spark, self.folder, self.paths, self.count = spark, scratch_path(spark, label), {}, 0
        self.settings = {CLEANUP: "true"} | ({ARROW_ROWS: str(arrow_rows)} if arrow_rows else {})

    @contextmanager
    def configured(self):
        """The settings of this object's jobs, for as long as they run."""
        before = {key: self.spark.conf.get(key, None) for key in self.settings}
        try:
            for key, value in self.settings.items():
                self.spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{name}-{self.count}"
        with self.configured():
            df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = (path, table)
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that this object stored."""
        for table in tables:
            path, _ = self.paths.pop(id(table))
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    return Scratch(df.sparkSession, label).store(df, "table")
