"""Sharding by extendible hashing.

A row's key is the first 60 bits of the MD5 of its id, followed by 60 bits of a row tag that only
matter for rows with equal ids. The directory is indexed by key prefixes: a shard is the shortest
prefix whose rows fit the byte limit, so only a bucket that is too large is split on one more bit.
Bucket sizes for ``step`` levels at a time come from one aggregate by prefix (partial sums in the map
tasks, so a hot prefix costs one row a task); only rows of buckets that are still too large
go on to the next levels. The directory stays a DataFrame.

Defined cases: null text has 0 bytes; a null id is a key of its own; a row larger than the limit is
alone in its shard; repeated rows are told apart by their tag, so they spread as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgraph.llm import common

LIMIT_BYTES = 1 << 20
STEP = 16
_BITS = 60


def _key(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")


def _shift(column: str, bits: Column) -> Column:
    return F.call_function("shiftright", F.col(column), bits.cast("int"))


def _leaf(depth: int) -> Column:
    """The first ``depth`` bits of a row's key (h1, h2)."""
    return F.struct(_shift("h1", F.lit(_BITS - min(depth, _BITS))).alias("p1"), _shift("h2", F.lit(_BITS - max(depth - _BITS, 0))).alias("p2"))


def _above(last: int) -> Column:
    """The prefix of length ``depth`` of a leaf at depth ``last``."""
    depth = F.col("depth")
    return F.struct(_shift("leaf.p1", F.lit(min(last, _BITS)) - F.least(depth, F.lit(_BITS))).alias("p1"),
                    _shift("leaf.p2", F.lit(max(last - _BITS, 0)) - F.greatest(depth - _BITS, F.lit(0))).alias("p2"))


def _placed(df: DataFrame, id_col: str, text_col: str, limit: int, step: int, carried: list[str]) -> DataFrame:
    """For each row: doc_id, the carried columns, shard (its prefix as bits), depth, shard_bytes, shard_docs."""
    keyed = common.texts(df, id_col, text_col).select(
        "doc_id", *carried, F.octet_length("text").cast("long").alias("size"), _key(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("h1"),
        F.monotonically_increasing_id().alias("tag"))
    rows = common.stored(keyed, "shard-keys").withColumn("h2", _key(F.col("tag").cast("string")))
    done, open_rows, at = None, rows, 0
    while True:
        last = min(at + step, 2 * _BITS)
        leaves = open_rows.groupBy(_leaf(last).alias("leaf")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        nodes = leaves.withColumn("depth", F.explode(F.sequence(F.lit(at), F.lit(last)))).withColumn("node", _above(last))
        sums = nodes.groupBy("depth", "node").agg(F.sum("size").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        fit = sums.filter((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
        level = nodes.select("leaf", "depth", "node").join(fit, ["depth", "node"]).groupBy("leaf").agg(
            F.min(F.struct("depth", "node", "shard_bytes", "shard_docs")).alias("shard"))
        directory = common.stored(level.select("leaf", "shard.*"), "shard-directory")
        keyed = open_rows.withColumn("leaf", _leaf(last))
        placed = keyed.join(directory, "leaf")
        done = placed if done is None else done.unionByName(placed)
        # what is left: leaves of this level without a fitting prefix
        rest = keyed.join(directory.select("leaf"), "leaf", "left_anti").drop("leaf")
        if last >= 2 * _BITS or rest.isEmpty():
            break
        open_rows, at = rest, last
    bits = F.concat(F.lpad(F.bin("node.p1"), F.least("depth", F.lit(_BITS)), "0"),
                    F.when(F.col("depth") > _BITS, F.lpad(F.bin("node.p2"), F.greatest(F.col("depth") - _BITS, F.lit(0)), "0")).otherwise(""))
    return done.select("doc_id", *carried, F.when(F.col("depth") == 0, "").otherwise(bits).alias("shard"), F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_docs")


def assign(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES, step: int = STEP) -> DataFrame:
    """For each row: doc_id, shard (its prefix as bits), depth, shard_bytes, shard_docs."""
    return _placed(df, id_col, text_col, limit, step, [])


def write(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> None:
    """Write (doc_id, text), one folder for each shard; the texts are stored with the keys, so each row is written once."""
    out = _placed(df, id_col, text_col, limit, STEP, ["text"]).select("doc_id", "text", "shard")
    out.withColumn("shard", F.concat(F.lit("s"), "shard")).repartition("shard").write.partitionBy("shard").parquet(path)


def op5(spark, sf_dir: str) -> DataFrame:
    return assign(common.table(spark, sf_dir, "documents"))


SQL = f"""
WITH k AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS size,
                  ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents),
n AS (SELECT d, h >> (60 - d) AS p, sum(size) AS bytes, count(*) AS docs FROM k, range(0, 33) AS r(d) GROUP BY 1, 2),
f AS (SELECT * FROM n WHERE bytes <= {LIMIT_BYTES} OR docs = 1),
b AS (SELECT doc_id, min(d) AS d FROM k JOIN f ON f.p = (k.h >> (60 - f.d)) GROUP BY doc_id)
SELECT k.doc_id, CASE WHEN b.d = 0 THEN '' ELSE lpad(bin(f.p), b.d::INT, '0') END AS shard, b.d::INT AS depth,
       f.bytes::BIGINT AS shard_bytes, f.docs::BIGINT AS shard_docs
FROM k JOIN b USING (doc_id) JOIN f ON f.d = b.d AND f.p = (k.h >> (60 - b.d))
"""
