"""Readers for the flat learner table. Everything lands as text; typing happens later."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph.operators.parse import once
from cohortgraph.schemas import raw_schema
from cohortgraph.session import work_table

CORRUPT = "_corrupt_record"
DEFAULT_NULL_TOKENS = ("-99", "-99.0", "")


def read_learners_csv(
    spark: SparkSession, path: str, null_tokens: tuple[str, ...] = (), keep_corrupt: bool = False, multi_line: bool = False, whole_files: bool = False
) -> DataFrame:
    """RFC-4180 CSV, all columns text. Files are split over tasks, also with ``multi_line``.

    Doubled quotes are read, NUL and undecodable characters and a byte-order mark removed, short rows filled
    with NULL and long rows cut. ``null_tokens`` become NULL. ``multi_line``: fields may hold quoted line
    breaks; records are put together by ``csv_records``. ``whole_files``: they do, records end with a line feed, and each
    file is one task's work, as compressed ones are anyway; Spark's own reader of such files takes them in one scan.
    """
    options = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE"}
    names = [n.lstrip("\ufeff") for n in spark.read.options(**options).csv(path).columns]
    schema = raw_schema(tuple(names)).add(T.StructField(CORRUPT, T.StringType()))
    if whole_files:
        options |= {"multiLine": "true", "lineSep": "\n", "enforceSchema": "true", "columnNameOfCorruptRecord": CORRUPT}
        cells, df = [F.col(f"`{n}`") for n in names], spark.read.schema(schema).options(**options).csv(path)
        text = F.concat_ws("", *cells)  # looked through once a record, in a step of its own
        df = once(df.select("*", text.alias("_text")), _dirty=F.col("_text").contains("\u0000") | F.col("_text").contains("\ufffd")).drop("_text")
    elif multi_line:
        options |= {"columnNameOfCorruptRecord": CORRUPT, "multiLine": "true", "header": "false"}
        records = csv_records(spark, path).filter("record > 1")  # the first of each file is its header
        dirty = F.col("text").contains("\u0000") | F.col("text").contains("\ufffd") | ~F.is_valid_utf8("text")
        text = F.when(dirty, F.translate("text", "\u0000\ufffd", "")).otherwise(F.col("text"))  # once a record, and only where needed
        df = records.select(F.from_csv(text, F.lit(", ".join(f"`{f.name}` STRING" for f in schema)), options).alias("r")).select("r.*")
    else:
        df = spark.read.schema(schema).options(**options, enforceSchema="true", columnNameOfCorruptRecord=CORRUPT).csv(path)
    clean = []
    for name in names:
        c = F.col(f"`{name}`")
        if whole_files:
            c = F.when(F.col("_dirty"), F.translate(c, "\u0000\ufffd", "")).otherwise(c)
        elif not multi_line:
            c = F.translate(c, "\u0000\ufffd", "")
        if null_tokens:
            c = F.when(~c.isin(*null_tokens), c)
        clean.append(c.alias(name))
    if keep_corrupt:
        clean.append(F.col(CORRUPT))
    return df.select(*clean)


def _scans():
    """The functions of the scan tasks; made here, so that they travel to workers by value."""

    def segments(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array, np.ndarray]]:
        """Runs of lines of one byte range: (file, block), the lines, and which have an odd number of quotes."""
        file, block = batch.column("file"), np.asarray(batch.column("block"))
        odd = np.asarray(pc.count_substring(batch.column("text"), b'"')).astype(np.int64) % 2
        codes = np.asarray((file.dictionary_encode() if not isinstance(file, pa.DictionaryArray) else file).indices)
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(block) != 0)) + 1
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(block)], strict=True):
            if s < e:
                yield (file[s].as_py(), int(block[s])), batch.column("text").slice(s, e - s), odd[s:e]

    def range_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each part of a byte range does: if it flips the quote parity, records that begin in it if it begins outside (even) or inside (odd) of quotes."""
        at, step, parity, begun = None, 0, 0, np.zeros(2, np.int64)
        for batch in batches:
            rows = []
            for here, _, own in segments(batch):
                if here != at:
                    at, step, parity, begun = here, 0, 0, np.zeros(2, np.int64)
                before = (parity + np.cumsum(own) - own) % 2
                begun = begun + [(before == 0).sum(), (before == 1).sum()]
                step, parity = step + 1, int(before[-1] + own[-1]) % 2
                rows.append((*at, step, parity == 1, *map(int, begun)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["file", "block", "step", "flips", "even", "odd"])

    def assembler(starts: dict[tuple[str, int], tuple[bool, int]], whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Records of byte ranges whose state at their begin is known: those that lie in one range (``whole``), or the pieces of the others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, parity, record, piece, held = None, 0, 0, False, []

            def table(rows: list[tuple]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                                  names=["file", "block", "record", "text"])

            for batch in batches:
                rows = []
                for here, lines, own in segments(batch):
                    if here != at:
                        if held and not whole:
                            rows.append((*at, record, b"\n".join(held)))
                        at, held = here, []
                        piece, record = starts[here]
                        parity = int(piece)
                    after = (parity + np.cumsum(own)) % 2
                    parity, text = int(after[-1]), lines.to_pylist()
                    begin = 0
                    for end in (np.flatnonzero(after == 0) + 1).tolist():  # a record ends where no quote is open
                        if not (held or piece):
                            record += 1
                        if piece != whole:
                            rows.append((*at, record, b"\n".join([*held, *text[begin:end]])))
                        begin, piece, held = end, False, []
                    if begin < len(text):
                        if not (held or piece):
                            record += 1
                        held += text[begin:]
                if rows:
                    yield table(rows)
            if held and not whole:
                yield table([(*at, record, b"\n".join(held))])

        return run

    return range_ends, assembler


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text): the records of CSV files, quoted line breaks included; ``record`` counts from 1 in each file.

    Every byte range of a file is a task. It cannot know if it begins inside of quotes, so a first scan works out
    both cases; one row a range (quote parity, records begun in either case) gives the true one by a running sum over
    the ranges before. This list, one entry a range like the list of files of a scan, goes to the tasks that put
    records together; only pieces of records that pass from range to range are shuffled. A quote that is never
    closed makes one record of the rest of its file. Line breaks inside of fields stay as they are, blank records
    are left out.
    """
    range_ends, assembler = _scans()
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("text"))
    ends = lines.mapInArrow(range_ends, "file string, block long, step long, flips boolean, even long, odd long")
    ranges = work_table(ends.groupBy("file", "block").agg(F.max_by(F.struct("flips", "even", "odd"), "step").alias("end")).select("file", "block", "end.*"), "csv-ranges")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    quoted = ranges.select("file", "block", "even", "odd", (F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1).alias("quoted"))
    begun = F.when(F.col("quoted"), F.col("odd")).otherwise(F.col("even"))
    found = quoted.select("file", "block", "quoted", F.coalesce(F.sum(begun).over(before), F.lit(0)).alias("earlier")).collect()
    starts = {(r.file, r.block): (r.quoted, r.earlier) for r in found}

    def records(whole: bool) -> DataFrame:
        return lines.mapInArrow(assembler(starts, whole), "file string, block long, record long, text binary")

    pieces = records(False).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", F.col("text").cast("string").alias("t")))).alias("parts"))
    joined = pieces.select("file", "record", F.array_join(F.transform("parts", lambda p: p["t"]), "\n").alias("text"))
    out = records(True).select("file", "record", F.col("text").cast("string").alias("text")).unionByName(joined)
    bare = F.when(F.col("text").endswith("\r"), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text"))
    return out.select("file", "record", bare.alias("text")).filter(F.trim("text") != "")


def read_learners_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def jdbc_options(
    url: str, table: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None,
    partitions: int = 1, fetch_size: int = 10_000, **extra: str,
) -> dict[str, str]:
    """Options of a partitioned, streaming table scan; failed reads are repeated as Spark tasks."""
    if not url or not table:
        raise ValueError("url and table are required")
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        if bounds is None or partitions < 1:
            raise ValueError("a partition column needs bounds and a positive number of partitions")
        out |= {
            "partitionColumn": partition_column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return out


def read_learners_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


_SOURCES: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "csv": (("path",), read_learners_csv),
    "parquet": (("path",), read_learners_parquet),
    "mysql": (("url", "table"), read_learners_jdbc),
}


def read_learners(spark: SparkSession, source: str, options: dict) -> DataFrame:
    """Reader chosen by name: csv, parquet or mysql."""
    if source not in _SOURCES:
        raise ValueError(f"unknown source {source!r}, expected one of {sorted(_SOURCES)}")
    needed, reader = _SOURCES[source]
    missing = [o for o in needed if not options.get(o)]
    if missing:
        raise ValueError(f"source {source!r} needs {', '.join(missing)}")
    return reader(spark, **options)


def with_row_ord(df: DataFrame) -> DataFrame:
    """Add the physical row order of a Parquet scan as (file, row index)."""
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("row_ord"))


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, n): how many rows each Parquet file of a table holds, counted without reading a column."""
    file = F.col("_metadata.file_path").alias("file")
    return spark.read.parquet(path).groupBy(file).agg(F.count(F.lit(1)).alias("n"))


def row_range(spark: SparkSession, path: str, start_row: int = 0, max_rows: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """Rows ``start_row`` to ``start_row + max_rows`` of Parquet files in file order; only files that hold some of them are read.

    The ordinal is the row index inside the file plus the rows of earlier files, so nothing is sorted. The rows of
    each file come from ``index`` (a stored ``file_index`` of an unchanged table), else they are counted once,
    without any column. Offsets are summed up by blocks of files, so no task gets the whole list; the list of
    the files that overlap is the plan of the scan and passes the driver.
    """
    whole = spark.read.parquet(path)
    counts = work_table(file_index(spark, path) if index is None else index, "file-index")
    in_order = counts.repartitionByRange("file").sortWithinPartitions("file").withColumn("block", F.spark_partition_id())
    in_order = work_table(in_order, "file-order")  # the blocks are read twice and must not be dealt anew
    by_block = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = in_order.groupBy("block").agg(F.sum("n").alias("m")).select("block", F.coalesce(F.sum("m").over(by_block), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_order.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(blocks, "block").select("file", "n", (F.col("base") + F.col("inside")).alias("_offset"))
    wanted = F.col("_offset") + F.col("n") > start_row
    if max_rows is not None:
        wanted = wanted & (F.col("_offset") < start_row + max_rows)
    found = [(r.file, r._offset) for r in offsets.filter(wanted).filter("n > 0").collect()]
    if not found:
        return whole.withColumn("row_ordinal", F.lit(0).cast("long")).limit(0)
    files = spark.read.schema(whole.schema).parquet(*[unquote(f) for f, _ in found])
    columns = files.columns
    files = files.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    ordinal = F.col("_offset") + F.col("_row")
    rows = files.join(spark.createDataFrame(found, "_file string, _offset long"), "_file").filter(ordinal >= start_row)
    if max_rows is not None:
        rows = rows.filter(ordinal < start_row + max_rows)
    return rows.select(*columns, ordinal.alias("row_ordinal"))


def source_summary(df: DataFrame) -> DataFrame:
    """Row and column counts; a Parquet row count comes from file footers."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def country_mapping(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(mappings, aliases) as (name, code, ord) from a JSON file of two objects."""
    both = T.MapType(T.StringType(), T.StringType())
    schema = T.StructType([T.StructField("mappings", both), T.StructField("aliases", both)])
    doc = spark.read.schema(schema).option("multiLine", "true").json(path)

    def table(name: str) -> DataFrame:
        entries = doc.select(F.posexplode(F.map_entries(name)).alias("ord", "e"))
        return entries.select(F.col("e.key").alias("name"), F.col("e.value").alias("code"), F.col("ord").cast("bigint").alias("ord"))

    return table("mappings"), table("aliases")
