"""Incremental ingestion: a file stream whose micro-batches become an idempotent change log.

Each batch keeps the last row per key and replaces only its own ``batch_id`` folder, so a
batch repeated after a failure writes the same result again. ``compact`` folds finished batches
into a base table, dealt out by key into buckets, of which it rewrites only those that the batches
touch. A numbered snapshot says up to which batch the base goes and where each bucket lies; readers
follow the last snapshot, so compaction may run beside an ingest and beside readers, or stop at any point.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph.operators.keyed import last_by
from cohortgraph.sources.writers import _path, _publish, graph_manifest


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest(
    stream: DataFrame, target: str, keys: list[str], order: list[str], prepare: Callable[[DataFrame], DataFrame] | None = None
) -> dict:
    """Run all available input into ``target``; resumes from its checkpoint."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        cols = [c for c in rows.columns if c not in keys]
        last = last_by(rows, keys, F.struct(*order), cols)
        last.write.mode("overwrite").parquet(f"{target}/log/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return progress(query.recentProgress)


def progress(reports: list) -> dict:
    """Batches, input rows and rate of a finished run."""
    done = [r for r in reports if r["numInputRows"] > 0]
    rows = sum(r["numInputRows"] for r in done)
    seconds = sum(r["batchDuration"] for r in done) / 1000
    return {"batches": len(done), "rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds else 0.0}


BUCKETS = 64


def _snapshot(spark: SparkSession, target: str) -> dict:
    """The last snapshot: its number, the last batch folded in, and the folder of each bucket."""
    return graph_manifest(spark, target) or {"version": 0, "through": -1, "base": {}}


def _finished(spark: SparkSession, target: str) -> list[int]:
    """Batches of the log that are written in full, rising."""
    root, fs = _path(spark, f"{target}/log")
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    ids = [int(n.split("=")[1]) for n in names if n.startswith("batch_id=")]
    return sorted(i for i in ids if fs.exists(_path(spark, f"{target}/log/batch_id={i}/_SUCCESS")[0]))


def _batches(spark: SparkSession, target: str, ids: list[int]) -> DataFrame | None:
    if not ids:
        return None
    return spark.read.option("basePath", f"{target}/log").parquet(*[f"{target}/log/batch_id={i}" for i in ids])


def _base(spark: SparkSession, target: str, base: dict[str, str], buckets: set[str] | None = None) -> DataFrame | None:
    """Rows of the base, with the batch they came from as ``batch_id``."""
    paths = [f"{target}/base/{folder}/bucket={b}" for b, folder in base.items() if buckets is None or b in buckets]
    return spark.read.parquet(*paths) if paths else None


def log(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the finished batches that no compaction has folded in yet."""
    through, done = _snapshot(spark, target)["through"], _finished(spark, target)
    fresh = _batches(spark, target, [i for i in done if i > through])
    if fresh is not None:
        return fresh
    rest = _base(spark, target, _snapshot(spark, target)["base"])
    if rest is None:
        raise ValueError(f"nothing was taken in at {target}")
    return rest.limit(0)


def current(spark: SparkSession, target: str, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key by ``order``; of equals that of the later batch, so batching does not matter.

    The base has one row per key already: only its rows with a key in the newer batches meet them, the
    others are passed on as they are, without a shuffle where the newer keys are few.
    """
    snap = _snapshot(spark, target)
    fresh = _batches(spark, target, [i for i in _finished(spark, target) if i > snap["through"]])
    base = _base(spark, target, snap["base"])
    if fresh is None:
        return log(spark, target).drop("batch_id") if base is None else base.drop("batch_id")
    cols = [c for c in fresh.columns if c not in (*keys, "batch_id")]
    latest = F.struct(*order, "batch_id")
    if base is None:
        return last_by(fresh, keys, latest, cols)
    changed = fresh.select(*keys).distinct()
    same = [base[k].eqNullSafe(changed[k]) for k in keys]
    met = fresh.unionByName(base.join(changed, same, "left_semi"))
    return base.join(changed, same, "left_anti").select(*keys, *cols).unionByName(last_by(met, keys, latest, cols))


def compact(spark: SparkSession, target: str, keys: list[str], order: list[str], buckets: int = BUCKETS) -> int:
    """Fold the finished batches into the base and publish the snapshot; returns its number (that of the last one if there is nothing to fold).

    Batches are folded in the order of their ids, up to the first that is not finished, so an ingest may go on
    meanwhile. Buckets without new rows keep their folder. What the snapshot before needed stays for its readers
    until the next compaction. A stop before the snapshot is published leaves unused files, one after it
    leaves files that a later compaction deletes. The number of buckets is fixed by the first compaction.
    """
    snap = _snapshot(spark, target)
    ids, through = set(_finished(spark, target)), snap["through"]
    fold = []
    while through + 1 in ids:
        through += 1
        fold.append(through)
    if not fold:
        return snap["version"]
    buckets = snap.get("buckets", buckets)
    fresh = _batches(spark, target, fold)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    touched = {str(r.b) for r in fresh.select(bucket.alias("b")).distinct().collect()}  # at most ``buckets`` numbers
    old = _base(spark, target, snap["base"], touched)
    both = fresh if old is None else fresh.unionByName(old)
    cols = [c for c in fresh.columns if c not in (*keys, "batch_id")]
    folder = f"load-{uuid.uuid4().hex}"
    last = last_by(both, keys, F.struct(*order, "batch_id"), [*cols, "batch_id"])
    last.withColumn("bucket", bucket).hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{target}/base/{folder}")
    base = {**snap["base"], **{b: folder for b in touched}}
    number = snap["version"] + 1
    _publish(spark, target, number, {"through": through, "buckets": buckets, "base": base})
    used = {*base.values(), *snap["base"].values()}
    root, fs = _path(spark, f"{target}/base")
    for name in [s.getPath().getName() for s in fs.listStatus(root)]:
        if name not in used:
            fs.delete(_path(spark, f"{target}/base/{name}")[0], True)
    for i in (i for i in ids if i <= snap["through"]):
        fs.delete(_path(spark, f"{target}/log/batch_id={i}")[0], True)
    return number


def status(spark: SparkSession, target: str) -> DataFrame:
    """Rows written per batch that is not folded in."""
    return log(spark, target).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))


def run_metrics(total: int, counts: dict[str, int], seconds: float, spark: SparkSession) -> DataFrame:
    """Report of a run: processed, succeeded and failed rows, percentages and rate."""
    ok = counts.get("valid", 0)
    rows = [
        ("processed", float(total)), ("succeeded", float(ok)), ("failed", float(total - ok)),
        ("success_pct", 100.0 * ok / total if total else 0.0), ("rows_per_second", total / seconds if seconds else 0.0),
    ]
    return spark.createDataFrame(rows, "metric string, value double")
