"""Benchmark decontamination with a hash set of normalised test n-grams.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z. A window is ``n``
consecutive words of an item; an item of fewer words, but not none, is one window. The windows are
broadcast, documents are scanned once in a map-only job, each candidate is verified word by word.

A benchmark of more than ``broadcast_bytes`` of text is not broadcast. Its windows become a table; the scan
passes on only those windows of a text that a Bloom filter of bounded size lets through, and a join with the table,
on the hash and the whole window, decides. Equal texts are joined once.

Defined cases: null or wordless texts have no words and no hits; null or wordless items have no
window; an item without id marks words but is not listed; repeated rows give repeated results; an
empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgraph.llm import common

NGRAM = 13
#: A document is contaminated when hits are at least this share of its words.
SHARE = 20
#: Benchmarks of at most this much text are broadcast; a worker holds about forty times as much.
BROADCAST_BYTES = 4 << 20
#: Words of 64 bits in the Bloom filter of a larger benchmark, at most.
FILTER_WORDS = 1 << 21

#: Bytes that belong to words map to lower case, all others to a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Windows:
    """Word ids, and for each window length the windows with their items."""

    def __init__(self, items: list[tuple[object, bytes]], n: int):
        self.ids: dict[bytes, int] = {}
        self.by_length: dict[int, dict[tuple[int, ...], list[object]]] = {}
        for item, text in items:
            seq = tuple(self.ids.setdefault(w, len(self.ids)) for w in words(text))
            size = min(n, len(seq))
            for i in range(len(seq) - size + 1 if size else 0):
                self.by_length.setdefault(size, {}).setdefault(seq[i : i + size], []).append(item)

    def mark(self, doc_words: list[bytes], hit: np.ndarray, items: set) -> None:
        ids = np.fromiter(map(self.ids.get, doc_words, repeat(-1)), np.int32, len(doc_words))
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        for size, windows in self.by_length.items():
            if size > len(ids):
                continue
            for p in np.flatnonzero(known[size:] - known[:-size] == size):
                found = windows.get(tuple(ids[p : p + size].tolist()))
                if found:
                    hit[p : p + size] = True
                    items.update(found)


def _small(benchmark: DataFrame, id_col: str, text_col: str, n: int, broadcast_bytes: int) -> Broadcast | None:
    """The windows of a benchmark that may be broadcast."""
    source = common.text_bytes(benchmark, id_col, text_col)
    # a row counts for some bytes even without text
    if (source.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) > broadcast_bytes:
        return None
    return benchmark.sparkSession.sparkContext.broadcast(Windows([(r.doc_id, bytes(r.text)) for r in source.collect()], n))


def _marks(windows: Windows, texts: list[bytes]) -> list[tuple[list[bytes], np.ndarray, set]]:
    rows = [(w := words(t), np.zeros(len(w), bool), set()) for t in texts]
    for row in rows:
        windows.mark(*row)
    return rows


def window_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words."""
    n = max(0, len(word_hashes) - size + 1)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[j : j + n]
    return out ^ (out >> np.uint64(29))


def _hashes(seq: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, seq), np.uint64, len(seq))


def window_table(benchmark: DataFrame, *, item_col: str = "item_id", text_col: str = "text", n: int = NGRAM) -> DataFrame:
    """(item as string, size, h, gram): the different windows of each item, stored."""
    source = common.text_bytes(benchmark, item_col, text_col).withColumn("doc_id", F.col("doc_id").cast("string"))

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for item, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                seq = words(text)
                size = min(n, len(seq))
                found = window_hashes(_hashes(seq), size).view(np.int64).tolist() if size else []
                rows += [(item, size, h, b" ".join(seq[i : i + size])) for i, h in enumerate(found)]
            item, size, h, gram = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(size, pa.int32()), pa.array(h, pa.int64()), pa.array(gram, pa.binary())],
                                              names=["item", "size", "h", "gram"])

        return step

    return common.stored(common.map_arrow(source, make, "item string, size int, h long, gram binary").distinct(), "benchmark-windows")


def _filter(windows: DataFrame, limit: int) -> np.ndarray:
    """A Bloom filter of the window hashes: four bits in one of at most ``limit`` words, a power of two."""
    n_words = min(limit, 1 << max(0, windows.count() // 4).bit_length())
    bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(h, {k}) & 63 AS int))" for k in (40, 46, 52, 58))
    found = windows.groupBy(F.expr(f"cast(h & {n_words - 1} AS int)").alias("word")).agg(F.bit_or(F.expr(bits)).alias("bits")).toArrow()
    out = np.zeros(n_words, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _passes(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = np.zeros(len(h), np.uint64)
    for k in (40, 46, 52, 58):
        bits |= np.uint64(1) << (h >> np.uint64(k) & np.uint64(63))
    return bloom[h & np.uint64(len(bloom) - 1)] & bits == bits


def _sha(text_col: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"), 256))


def joined_hits(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                n: int = NGRAM, filter_words: int = FILTER_WORDS) -> DataFrame:
    """(sha, n_words, p, size, item): windows at word p of the text with this SHA-256, through a join; stored."""
    table = window_table(benchmark, item_col=item_col, text_col=item_text_col, n=n)
    sizes = [r.size for r in table.select("size").distinct().collect()]  # at most n
    bloom = benchmark.sparkSession.sparkContext.broadcast(_filter(table, filter_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            columns, rows[:] = list(zip(*rows, strict=True)), []
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["sha", "n_words", "p", "size", "h", "gram"])

        rows: list[tuple] = []
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                seq, sha = words(text), hashlib.sha256(text).digest()
                hashes = _hashes(seq)
                for size in sizes:
                    h = window_hashes(hashes, size)
                    for p in np.flatnonzero(_passes(bloom.value, h)).tolist():
                        rows.append((sha, len(seq), p, size, int(h[p : p + 1].view(np.int64)[0]), b" ".join(seq[p : p + size])))
                        if len(rows) >= 1 << 16:
                            yield flush()
        if rows:
            yield flush()

    source = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    candidates = source.mapInArrow(run, "sha binary, n_words long, p long, size int, h long, gram binary").distinct()
    return common.stored(candidates.join(table, ["h", "size", "gram"]).select("sha", "n_words", "p", "size", "item"), "benchmark-hits")


def _joined(hits: DataFrame) -> DataFrame:
    """(sha, n_words, n_hit, items) of the texts with hits, stored."""
    place = F.explode(F.sequence("p", F.col("p") + F.col("size") - 1)).alias("q")
    hit = hits.select("sha", "n_words", "p", "size").distinct().select("sha", "n_words", place).distinct().groupBy("sha", "n_words").agg(F.count("*").alias("n_hit"))
    items = hits.filter("item IS NOT NULL").select("sha", "item").distinct().groupBy("sha").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return common.stored(hit.join(items, "sha", "left"), "benchmark-texts")


def contaminated(hit: np.ndarray, share: int = SHARE) -> bool:
    found = int(hit.sum())
    return found > 0 and share * found >= len(hit)


def scan(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", n: int = NGRAM, share: int = SHARE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """For each document: doc_id, n_words, n_hit, items (sorted as strings), contaminated."""
    windows = _small(benchmark, item_col, item_text_col, n, broadcast_bytes)
    source = common.text_bytes(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    if windows is None:
        found = _joined(joined_hits(docs, benchmark, text_col=text_col, item_col=item_col, item_text_col=item_text_col, n=n))

        def count():
            def step(part: pa.RecordBatch) -> pa.RecordBatch:
                found = part.column("text").to_pylist()
                return pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([hashlib.sha256(t).digest() for t in found], pa.binary()), pa.array([len(words(t)) for t in found], pa.int64())],
                    names=["doc_id", "sha", "n_words"])

            return step

        own = common.map_arrow(source, count, f"doc_id {kind}, sha binary, n_words long")
        hit = F.coalesce("n_hit", F.lit(0))
        return own.join(found.drop("n_words"), "sha", "left").select(
            "doc_id", "n_words", hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"))

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = _marks(windows.value, part.column("text").to_pylist())
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(w) for w, _, _ in rows], pa.int64()),
                 pa.array([int(h.sum()) for _, h, _ in rows], pa.int64()),
                 pa.array([sorted(str(x) for x in i if x is not None) for _, _, i in rows], pa.list_(pa.string())),
                 pa.array([contaminated(h, share) for _, h, _ in rows], pa.bool_())],
                names=["doc_id", "n_words", "n_hit", "items", "contaminated"])

        return step

    return common.map_arrow(source, make, f"doc_id {kind}, n_words long, n_hit long, items array<string>, contaminated boolean")


def remove_documents(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                     item_text_col: str = "text", n: int = NGRAM, share: int = SHARE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    windows = _small(benchmark, item_col, item_text_col, n, broadcast_bytes)
    if windows is None:
        found = _joined(joined_hits(docs, benchmark, text_col=text_col, item_col=item_col, item_text_col=item_text_col, n=n))
        gone = found.filter(share * F.col("n_hit") >= F.col("n_words")).select(F.col("sha").alias("_hit_sha"))
        return docs.join(gone, _sha(text_col) == F.col("_hit_sha"), "left_anti")

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = _marks(windows.value, [(t or "").encode() for t in part.column(text_col).to_pylist()])
            return part.filter(pa.array([not contaminated(h, share) for _, h, _ in rows], pa.bool_()))

        return step

    return common.map_arrow(docs, make, docs.schema, text_col)


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", n: int = NGRAM, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text, n_spans): each run of hit words, from its first to its last byte, is cut out."""
    windows = _small(benchmark, item_col, item_text_col, n, broadcast_bytes)
    source = common.text_bytes(docs, id_col, text_col)
    if windows is None:
        hits = joined_hits(docs, benchmark, text_col=text_col, item_col=item_col, item_text_col=item_text_col, n=n)
        places = common.stored(hits.select("sha", F.struct("p", "size").alias("place")).distinct().groupBy("sha").agg(F.collect_list("place").alias("places")), "benchmark-places")
        source = source.withColumn("sha", F.unhex(F.sha2("text", 256))).join(places, "sha", "left").select("doc_id", "text", "places")

    def placed(n_words: int, places: list[dict] | None) -> np.ndarray:
        hit = np.zeros(n_words, bool)
        for x in places or ():
            hit[x["p"] : x["p"] + x["size"]] = True
        return hit

    def without(text: bytes, hit: np.ndarray) -> tuple[str, int]:
        plain = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
        edge = np.diff(np.concatenate([[0], plain.view(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        runs = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
        out, at = [], 0
        spans = list(zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1), strict=True))
        for first, last in spans:
            out.append(text[at : starts[first]])
            at = ends[last - 1]
        return b"".join([*out, text[at:]]).decode("utf-8", "replace"), len(spans)

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            found = part.column("text").to_pylist()
            if windows is None:
                hits = [placed(len(words(t)), p) for t, p in zip(found, part.column("places").to_pylist(), strict=True)]
            else:
                hits = [h for _, h, _ in _marks(windows.value, found)]
            done = [without(t, h) for t, h in zip(found, hits, strict=True)]
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([t for t, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())],
                names=["doc_id", "text", "n_spans"])

        return step

    kind = source.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(source, make, f"doc_id {kind}, text string, n_spans long")


def digest(found: DataFrame) -> DataFrame:
    """The result of ``scan`` with the item list as count and digest."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op3(spark, sf_dir: str) -> DataFrame:
    return digest(scan(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM iw, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
grams AS (
  SELECT r, p, s.size, array_to_string(w[p:p + s.size - 1], ' ') AS g
  FROM dw, (SELECT DISTINCT size FROM win) s, unnest(range(1, len(w) - s.size + 2)) AS u(p) WHERE len(w) >= s.size),
hits AS (SELECT r, p, size, item_id FROM grams JOIN win USING (size, g)),
pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + size)) AS u(q) GROUP BY r),
its AS (SELECT r, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT item_id::varchar, ',' ORDER BY item_id::varchar) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
