"""Writers: Parquet export with statistics, node tables, whole graphs."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortgraph.operators.model import Graph
from cohortgraph.operators.parse import once

NODE_COLUMNS = {
    "Learner": (
        "hashed_email", "sand_id", "full_name", "profile_photo_url", "bio", "gender", "education_level", "education_field",
        "country_of_residence_code", "country_of_origin_code", "city_of_residence_id", "current_learning_state",
        "current_professional_status", "is_placed", "is_featured", "is_rural", "description_of_living_location",
        "has_disability", "type_of_disability", "is_from_low_income_household", "snapshot_id", "created_at", "updated_at",
    ),
    "Country": ("code", "name", "latitude", "longitude"),
    "City": ("id", "name", "country_code", "latitude", "longitude"),
    "Skill": ("id", "name", "category"),
    "Program": ("id", "name", "cohort_code", "provider"),
    "Company": ("id", "name", "industry", "country_code"),
    "LearningState": ("state", "start_date", "end_date", "is_current", "reason"),
    "ProfessionalStatus": ("status", "start_date", "end_date", "is_current", "details"),
}


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def to_node_table(df: DataFrame, kind: str) -> DataFrame:
    """Columns of a node kind under their stored names; absent ones are left out."""
    return df.select(*[F.col(c).alias(camel(c)) for c in NODE_COLUMNS[kind] if c in df.columns])


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def export_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write zstd Parquet; the row count is observed during the write, no second pass."""
    spark = df.sparkSession
    seen = Observation()
    start = time.time()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", "zstd").parquet(path)
    seconds = time.time() - start
    rows = seen.get["rows"]
    p, fs = _path(spark, path)
    size = fs.getContentSummary(p).getLength()
    return spark.createDataFrame(
        [(rows, len(df.columns), seconds, rows / seconds if seconds else 0.0, size)],
        "rows bigint, columns int, seconds double, rows_per_second double, bytes bigint",
    )


def export_csv(df: DataFrame, path: str, bom: bool = False, records: int | None = None) -> None:
    """RFC-4180 files with a header each, every value quoted, line breaks kept; trailing NULLs make a row short, others are empty.

    ``bom`` puts a byte-order mark before each header. ``records``: gzip files of at most so many records, as a reader
    takes each from its start.
    """
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    cells = [F.coalesce(quoted(F.col(f"`{c}`").cast("string")), F.lit("")) for c in df.columns]
    parts, rows = range(0, len(cells), 10), df  # a step each: one for all cells is a method too long for the JVM to compile
    for i in parts:
        rows = once(rows, **{f"_cells{i}": F.concat_ws(",", *cells[i : i + 10])})
    rows = rows.select(F.rtrim(F.concat_ws(",", *[F.col(f"_cells{i}") for i in parts]), F.lit(",")).alias("value"))
    header = ("\ufeff" if bom else "") + ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)

    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # in its task
    first = number == 0 if records is None else number % records == 0  # of a file
    body = rows.select(F.when(first, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value")).alias("value"))
    alone = df.sparkSession.range(0, 1, 1, 1).select(F.lit(header).alias("value"))  # a file for tables without rows
    options = {} if records is None else {"compression": "gzip", "maxRecordsPerFile": records}
    body.unionByName(alone).write.options(**options).mode("overwrite").text(path)


def clear(spark: SparkSession, path: str, confirm: bool = False) -> bool:
    """Delete a stored table or graph; refuses without ``confirm``."""
    if not confirm:
        raise ValueError("pass confirm=True to delete everything below the path")
    p, fs = _path(spark, path)
    return fs.delete(p, True)


MANIFESTS = "_manifests"


def graph_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions of a stored graph, rising; their count is bounded by ``keep``."""
    p, fs = _path(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    return sorted(int(name) for name in (s.getPath().getName() for s in fs.listStatus(p)) if name.isdigit())


def graph_manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """Folder, tables and row counts of a committed version (None: the last one); empty if there is none."""
    versions = graph_versions(spark, path)
    if not versions or version is not None and version not in versions:
        return {}
    number = versions[-1] if version is None else version
    text = spark.read.option("wholetext", "true").text(f"{path}/{MANIFESTS}/{number}").first()[0]
    return {"version": number, **json.loads(text)}


def write_graph(graph: Graph, path: str, mode: str = "overwrite", keep: int = 2) -> dict:
    """Node tables first, then edge tables, each as Parquet in a new folder below ``path``; then the manifest that names them.

    Readers follow the last manifest, so a load that stops at any point shows nothing: they go on with the version
    before. The manifest appears by one rename, which fails if another load has committed meanwhile. The last ``keep``
    versions stay for readers that are under way; older ones are deleted after the commit.
    Returns the manifest, with the rows of each table as they were written.
    """
    members = graph.members()
    spark = members["learner"].sparkSession
    versions = graph_versions(spark, path)
    if versions and mode in ("error", "errorifexists"):
        raise ValueError(f"{path} holds a graph already")
    edges = [n for n in members if n.startswith("has_") or n in ("enrolled_in", "works_for")]
    folder, rows = f"load-{uuid.uuid4().hex}", {}
    for name in [n for n in members if n not in edges] + edges:
        seen = Observation()
        members[name].observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(f"{path}/{folder}/{name}")
        rows[name] = seen.get["rows"]
    number = (versions[-1] if versions else 0) + 1
    _publish(spark, path, number, {"folder": folder, "rows": rows})
    _drop_old(spark, path, keep)
    return {"version": number, "folder": folder, "rows": rows}


def _publish(spark: SparkSession, path: str, number: int, content: dict) -> None:
    made, fs = _path(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    out = fs.create(made, False)
    out.write(json.dumps(content).encode())
    out.close()
    final, _ = _path(spark, f"{path}/{MANIFESTS}/{number}")
    if fs.exists(final) or not fs.rename(made, final):
        fs.delete(made, False)
        raise RuntimeError(f"version {number} of {path} was committed by another load")


def _drop_old(spark: SparkSession, path: str, keep: int) -> None:
    """Delete manifests before the last ``keep``, then the folders of theirs; a load under way writes to a folder that no manifest names yet and keeps it."""
    for number in graph_versions(spark, path)[:-max(1, keep)]:
        folder = graph_manifest(spark, path, number)["folder"]
        for name in (f"{MANIFESTS}/{number}", folder):
            p, fs = _path(spark, f"{path}/{name}")
            fs.delete(p, True)


def read_graph(spark: SparkSession, path: str, version: int | None = None) -> Graph:
    """A committed version of a stored graph, the last one unless said otherwise."""
    manifest = graph_manifest(spark, path, version)
    if not manifest:
        raise ValueError(f"no committed graph at {path}" + (f" with version {version}" if version is not None else ""))
    return Graph(**{name: spark.read.parquet(f"{path}/{manifest['folder']}/{name}") for name in manifest["rows"]})


def save_bucketed(graph: Graph, prefix: str, buckets: int) -> None:
    """Learner and edge tables as catalog tables bucketed and sorted by learner.

    Joins between them on the learner then need no shuffle.
    """
    keyed = {"learner": "hashed_email", "has_skill": "learner", "enrolled_in": "learner", "works_for": "learner"}
    for name, df in graph.members().items():
        writer = df.write.mode("overwrite").format("parquet")
        if name in keyed:
            writer = writer.bucketBy(buckets, keyed[name]).sortBy(keyed[name])
        writer.saveAsTable(f"{prefix}{name}")


def load_bucketed(spark: SparkSession, prefix: str) -> Graph:
    names = [n for n in Graph.__dataclass_fields__ if spark.catalog.tableExists(f"{prefix}{n}")]
    return Graph(**{n: spark.table(f"{prefix}{n}") for n in names})
