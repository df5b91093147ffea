"""Near copies by word shingles: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Texts with the same set are folded first. Candidates share a band of ROWS minhashes; a pair at exactly
0.8 misses all BANDS bands with probability (1 - 0.8^4)^40 < 1e-9, a closer pair less. Bands that hold
the same sets are one bucket. Only sets in a bucket with another one are made again and sent to it,
where a breadth-first search by exact similarity emits a spanning forest of the links, never all pairs.
A bucket of more than ``bucket_limit`` sets is dealt out in tiles of two parts each, so every pair still
meets and no task holds more than two parts. Components come from the star contraction of ``simhash``.

With a ``radius`` the SimHash fingerprints of op9 give candidates too: the sets of a component of fingerprints
(covering masks, all pairs within the radius) are a bucket like those of the bands, and checked exactly like them.

Defined cases: fewer than five words make one shingle; null and wordless texts have the empty set and
are one group; of a group the row with the smallest id stays (a null id comes last, then the text hash
decides), rows equal in id and text stay together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgraph.llm import common, line_dedup, simhash

SHINGLE = 5
#: In thousandths.
SIMILARITY = 800
BANDS, ROWS = 40, 4
BUCKET_LIMIT = 1024
_RNG = np.random.default_rng(42)
_XOR, _TIMES = _RNG.integers(0, 1 << 32, (2, BANDS * ROWS, 1), np.uint32) | np.array([[[0]], [[1]]], np.uint32)


def grams(text: bytes, shingle: int) -> np.ndarray:
    return np.unique(simhash.shingle_hashes(text, shingle))


def digest(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.astype("<u8").tobytes())


def bands(grams: np.ndarray) -> list[int]:
    """A key for each band; none for the empty set."""
    if not len(grams):
        return []
    low, least = (grams >> np.uint64(32)).astype(np.uint32), np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 1024):
        np.minimum(least, ((low[i : i + 1024] ^ _XOR) * _TIMES).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(least.reshape(BANDS, ROWS))]


def _sketches(docs: DataFrame, shingle: int, prints: bool) -> DataFrame:
    """(doc_id, h1, s, bands, fp): hash of the text, digest of the set, keys of its bands, fingerprint if ``prints``."""
    source = docs.withColumn("text", F.col("text").cast("binary"))

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            sets = [grams(t, shingle) for t in part.column("text").to_pylist()]
            fps = np.array([simhash.fingerprint(t) for t in part.column("text").to_pylist()] if prints else [0] * len(sets), np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h1"), pa.array(map(digest, sets), pa.binary()), pa.array(map(bands, sets), pa.list_(pa.int64())), pa.array(fps)],
                                              names=["doc_id", "h1", "s", "bands", "fp"])

        return step

    return common.map_arrow(source, make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, h1 long, s binary, bands array<long>, fp long")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(s, grams): the sets themselves, as sorted 64-bit hashes."""

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            sets = [grams(t, shingle) for t in part.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(map(digest, sets), pa.binary()), pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())], names=["s", "grams"])

        return step

    return common.map_arrow(docs.select(F.col("text").cast("binary").alias("text")), make, "s binary, grams binary")


def forest(names: list[bytes], sets: list[np.ndarray], similarity: int) -> Iterator[tuple[bytes, bytes]]:
    """Links of a spanning forest of the similar pairs; the sets are not empty."""
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    known, at = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(known), np.int32)
    left, queue = np.arange(1, len(sets)), [0]
    while len(left):
        pivot = queue.pop() if queue else None
        if pivot is None:
            pivot, left = left[0], left[1:]
            if not len(left):
                return
        own = at[starts[pivot] : starts[pivot] + sizes[pivot]]
        mark[own] = 1
        shared = np.add.reduceat(mark[at], starts)[left]
        mark[own] = 0
        near = 1000 * shared >= similarity * (sizes[left] + sizes[pivot] - shared)
        yield from ((names[pivot], names[x]) for x in left[near])
        queue.extend(left[near].tolist())
        left = left[~near]


def _links(similarity: int):
    """From rows (k, lo, hi, s, grams) sorted by tile: spanning links of each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("k", "lo", "hi", "s", "grams")), strict=True))
        for _, tile in groupby(rows, lambda row: row[:3]):
            names, sets = zip(*((s, np.frombuffer(g, "<u8")) for _, _, _, s, g in tile), strict=True)
            found = list(forest(names, sets, similarity)) if len(sets) > 1 else []
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def _order(id_col: str = "doc_id") -> Column:
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("h1").alias("h1"))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return common.texts(docs, id_col, text_col).withColumn("h1", F.xxhash64("text"))


def _fingerprint_keys(own: DataFrame, radius: int) -> DataFrame:
    """(s, k): a key for each group of fingerprints that links within the radius hold together, beside the sets of its texts."""
    pairs = common.stored(own.filter(F.size("bands") > 0).select("s", "fp").distinct(), "near-fingerprints")
    roots = common.stored(simhash.components(simhash.links(pairs.select("fp").distinct(), radius=radius)), "near-fingerprint-roots")
    return pairs.join(roots, "fp", "left").select("s", F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("k")).distinct()


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY,
           bucket_limit: int = BUCKET_LIMIT, radius: int | None = None) -> DataFrame:
    """For each row: doc_id, h1 (hash of its text), first (order of the row of its group that stays).

    ``radius``: texts whose fingerprints links of at most so many bits hold together are candidates as well; None: bands only.
    """
    source = _source(docs, id_col, text_col)
    own = common.stored(_sketches(source, shingle, radius is not None), "near-sketches")
    distinct = common.stored(own.groupBy("s").agg(F.min(_order()).alias("first"), F.min("bands").alias("bands")), "near-distinct")
    keyed = distinct.select("s", F.explode("bands").alias("k"))
    if radius is not None:
        keyed = keyed.unionByName(common.stored(_fingerprint_keys(own, radius), "near-fingerprint-keys"))
    ones = [F.bit_xor(F.xxhash64(F.lit(i), "s")).alias(f"x{i}") for i in range(2)]
    buckets = keyed.groupBy("k").agg(F.count("*").alias("n"), *ones).filter("n > 1").groupBy("n", "x0", "x1").agg(F.min("k").alias("k"))
    # stored, as are the tables below, so that the joins behind them can split a bucket or set that many rows share
    members = common.stored(keyed.join(common.stored(buckets.select("k", "n"), "near-buckets"), "k"), "near-members")
    parts = F.ceil(F.col("n") / bucket_limit).cast("int")
    tiles = members.withColumn("part", F.pmod(F.xxhash64("s"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    tiles = tiles.select("k", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "s")

    # the candidates' sets, made again from the text of one row each
    wanted = distinct.join(members.select("s").distinct(), "s", "left_semi").select("first", F.col("first.h1").alias("h1"))
    wanted = common.stored(wanted, "near-wanted")
    texts = line_dedup._prefiltered(source, wanted).join(wanted, "h1").filter(_order() == F.col("first"))
    sets = common.stored(_sets(texts, shingle).dropDuplicates(["s"]), "near-sets")
    found = tiles.join(sets, "s").repartition("k", "lo", "hi").sortWithinPartitions("k", "lo", "hi").select("k", "lo", "hi", "s", "grams").mapInArrow(_links(similarity), "a binary, b binary")

    roots = simhash.components(found)
    placed = common.stored(distinct.select("s", "first").join(roots.withColumnRenamed("fp", "s"), "s", "left").withColumn("root", F.coalesce("root", "s")), "near-roots")
    named = placed.groupBy("root").agg(F.min("first").alias("first"))
    fate = common.stored(placed.select("s", "root").join(named, "root").select("s", "first"), "near-fate")
    return own.select("doc_id", "h1", "s").join(fate, "s").select("doc_id", "h1", "first")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY,
               bucket_limit: int = BUCKET_LIMIT, radius: int | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that stay."""
    found = groups(docs, id_col=id_col, text_col=text_col, shingle=shingle, similarity=similarity, bucket_limit=bucket_limit, radius=radius)
    gone = found.filter(_order() != F.col("first")).select(F.col("doc_id").alias("_gone_id"), F.col("h1").alias("_gone_h1")).distinct()
    gone = common.stored(gone, "near-gone")
    same = docs[id_col].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == gone["_gone_h1"])
    return docs.join(gone, same, "left_anti")
