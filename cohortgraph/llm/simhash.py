"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints are made in Arrow tasks; equal ones are folded before anything else. A table keeps the
fingerprint bits of one mask. The masks are structured: bit i has a non-zero vector m(i) of r+1 bits,
and the mask of a non-zero v has bit i where <m(i), v> is odd. Any r positions leave a non-zero v
orthogonal to all their vectors, so every pair within radius r agrees under some mask.

Buckets are sorted runs of a partition. Within a bucket a breadth-first search from one fingerprint
to those not yet reached emits a spanning forest of the links, never all pairs. A bucket of more than
``bucket_limit`` fingerprints is not held: its members go through a second covering of the bits that
the first mask leaves free, where a bucket has at most 2^17 different fingerprints. Components come
from alternating star contraction of the links, stored after each round.

Defined cases: null and wordless texts have fingerprint 0 and link like any other; fewer than four
words make one shingle; ids may repeat; a null id never names a component unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm import common

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET_LIMIT = 4096
_UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """A hash of each run of ``shingle`` words; fewer words make one shingle, no words none."""
    words = text.translate(_UPPER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    pieces = [joined[a:b] for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)]
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, n)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the shingle hashes; 0 without words."""
    hashes = shingle_hashes(text, shingle)
    n = len(hashes)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        votes += np.unpackbits(hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint as signed long."""
    source = common.text_bytes(docs, id_col, text_col)

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t, shingle) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

        return step

    return common.map_arrow(source, make, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp long")


def covering_masks(radius: int, bits: list[int]) -> list[int]:
    """2^(radius+1) - 1 masks over the given bit positions."""
    n = 1 << (radius + 1)
    vectors = {bit: 1 + i % (n - 1) for i, bit in enumerate(bits)}
    return [sum(1 << b for b, m in vectors.items() if (m & v).bit_count() & 1) for v in range(1, n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(radius: int, limit: int):
    """From rows sorted by (t, key): spanning links of each bucket; rows of buckets beyond the limit as they are."""

    def forest(fps: np.ndarray) -> Iterator[tuple[int, int]]:
        left = fps[1:]
        queue = [fps[0]]
        while queue:
            pivot = queue.pop()
            near = np.bitwise_count((left ^ pivot).view(np.uint64)) <= radius
            if near.any():
                found = left[near]
                yield from zip(repeat(int(pivot)), found.tolist())
                queue.extend(found)
                left = left[~near]
            if not queue and len(left) > 1:
                queue, left = [left[0]], left[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        at, size, big = None, 0, False

        def table(rows: list[tuple]) -> pa.RecordBatch:
            a, b, t = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(t, pa.int32())], names=["a", "b", "t"])

        def close() -> list[tuple]:
            if big or size < 2:
                return []
            return [(x, y, None) for x, y in forest(np.concatenate(held))]

        for batch in batches:
            t, key, fp = (np.asarray(batch.column(c)) for c in ("t", "key", "fp"))
            if not len(t):
                continue
            edges = np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0)) + 1
            out: list[tuple] = []
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(t)], strict=True):
                if (t[s], key[s]) != at:
                    out += close()
                    at, size, big, held = (t[s], key[s]), 0, False, []
                size += e - s
                if limit and size > limit:
                    rows = [*held, fp[s:e]] if not big else [fp[s:e]]
                    out += [(int(x), None, int(t[s])) for r in rows for x in r]
                    big, held = True, []
                else:
                    held.append(fp[s:e])
                if len(out) > 1 << 16:
                    yield table(out)
                    out = []
            if out:
                yield table(out)
        out = close()
        if out:
            yield table(out)

    return run


def links(fps: DataFrame, *, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b): links between different fingerprints of column ``fp`` (distinct rows) that keep all of their components together."""
    spark = fps.sparkSession
    masks = covering_masks(radius, list(range(64)))
    tables = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]))
    dealt = lambda df: df.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow
    found = common.stored(dealt(fps.select("fp", tables.alias("x")).select("x.t", "x.key", "fp"))(_links(radius, bucket_limit), "a long, b long, t int"), "simhash-links")
    out = found.filter("t IS NULL").select("a", "b")
    again = found.filter("t IS NOT NULL").select(F.col("a").alias("fp"), F.col("t").alias("first"))
    # a second covering, of the bits that the first mask leaves free: a fixed table of masks
    rows = [(i, i * len(masks) + j, _signed(m | extra)) for i, m in enumerate(masks)
            for j, extra in enumerate(covering_masks(radius, [b for b in range(64) if not m >> b & 1]))]
    finer = spark.createDataFrame(rows, "first int, t int, mask long")
    keyed = again.join(F.broadcast(finer), "first").select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    return out.unionByName(dealt(keyed)(_links(radius, 0), "a long, b long, t int").select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable, for every fingerprint that has a link.

    Minima are stored before they meet the links they come from, so that the join deals out both sides itself and
    can split a centre that many nodes are linked to.
    """
    pairs = common.stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "simhash-pairs")
    state = None
    while True:
        # large star: larger neighbours of a node are linked to its smallest neighbour
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = common.stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "simhash-least")
        large = common.stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "simhash-large")
        # small star: a node and its smaller neighbours are linked to the smallest of them
        low = common.stored(large.groupBy("u").agg(F.min("v").alias("m")), "simhash-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        last, pairs = pairs, common.stored(small.filter("u <> v").distinct(), "simhash-pairs")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        for done in (last, least, large, low):
            common.drop_stored(done)
        if now == state:
            return pairs.groupBy(F.col("u").alias("fp")).agg(F.min("v").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
                    bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """For each row: doc_id, fp, component_id (smallest id of its component), n_links (links of its fingerprint in the forest)."""
    own = common.stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "simhash-fingerprints")
    distinct = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), radius=radius, bucket_limit=bucket_limit))
    placed = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = common.stored(placed, "simhash-roots")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(placed.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, that name their component; rows that repeat an id stay together."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, radius=radius)
    dropped = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_dropped_id")).distinct()
    return docs.join(dropped, docs[id_col] == dropped["_dropped_id"], "left_anti")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
