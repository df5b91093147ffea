"""Shared pieces of the corpus operators: inputs, work tables and Arrow batches.

Conventions of all operators:

* the id and text columns are named by the caller; other columns are never looked at, so extra
  columns may have any name, and an operator's result holds the id column and its own columns only;
* a null text counts as empty; a null id is carried through as null;
* intermediate tables are Parquet below ``spark.checkpoint.dir``, which every executor can reach.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.session import shared_dir

WHITE = " \t\n\x0b\x0c\r"
#: Bytes of text that one step of an Arrow task handles at a time.
SLICE_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies (clusters without a shared folder for it: --py-files)."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([here, known]) if known else here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def text_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with the text as UTF-8 bytes, as Arrow tasks take it."""
    return texts(df, id_col, text_col).withColumn("text", F.col("text").cast("binary"))


def id_remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; 0 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % modulus, F.lit(0))


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file.rsplit("/", 1)[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes in ``column``, at least one row each."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], object]], schema: str, column: str = "text") -> DataFrame:
    """mapInArrow by bounded slices: ``make()`` runs once a task and returns the function of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in cut(batch, column):
                out = step(part)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def raw_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary array without nulls, as views."""
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
