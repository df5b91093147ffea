"""Exact substring dedup: bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere.

Suffixes are not dealt out one by one. Each window of LENGTH bytes chooses an anchor by its content (the
GRAM bytes with the least hash), so equal windows choose the same anchor at the same offset. The windows
of one anchor form a segment: the bytes from the first start to the end of the last window. Segments are
keyed by their anchor's hash; only keys that occur more than once can hold a repeat.

Equal segments are folded before anything is gathered. The different segments of a key are joined into
one string and their suffixes are sorted in two stages: suffixes smaller than their successor
are sorted directly, the others are induced by one scan over the byte buckets from left to right. Neighbours
in that order with a common prefix of LENGTH bytes are repeats. A key with more than ``BLOCK`` different
segments is dealt out over several blocks; windows that a block has only once are then compared across its
blocks by 128-bit digests, packed by ranges of digests so that no task gets more than a few blocks' worth.

Documents are identified by their content, so repeated rows need no ids. Defined cases: null text is
empty; texts shorter than LENGTH keep all bytes; matches never cross documents; equal rows are each
other's repeats; a removed span may cut a UTF-8 character, so kept texts are bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.llm import common

LENGTH = 400
GRAM = 96
#: Different segments of a key that one sort takes, and the bytes of several keys that share a sort.
BLOCK = 512
SORT_BYTES = 256 << 10
_PIECE = 1 << 19
_POSITION = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_END = 0xFF  # never part of UTF-8


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Anchors:
    """Finds the segments of many texts at once."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.width = length, gram, length - gram + 1
        self.powers = _powers(_BASE, _PIECE + 2 * length)
        self.inverse = _powers(pow(_BASE, -1, 1 << 64), _PIECE + 2 * length)

    def segments(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first start, number of starts, key) of each segment; starts says where windows may begin."""
        n = len(data) - self.gram + 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data.astype(np.uint64) * self.powers[: len(data)], dtype=np.uint64)])
        grams = _mixed((sums[self.gram :] - sums[:-self.gram]) * self.inverse[:n])
        value = (grams & ~_POSITION) | np.arange(n, dtype=np.uint64)
        w = self.width
        padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = value
        rows = padded.reshape(-1, w)
        left = np.minimum.accumulate(rows, axis=1).ravel()
        right = np.ascontiguousarray(np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1]).ravel()
        least = np.minimum(right[starts], left[starts + w - 1]) & _POSITION
        new = np.flatnonzero(np.concatenate([[True], (np.diff(least) != 0) | (np.diff(starts) != 1)]))
        count = np.diff(np.concatenate([new, [len(starts)]]))
        return starts[new], count, _mixed(grams[least[new].astype(np.int64)] ^ np.uint64(_BASE)).view(np.int64)


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (text, from, to) with about _PIECE bytes; a long text comes in parts that overlap by length-1."""
    held, size = [], 0
    for k, text in enumerate(texts):
        at = 0
        while len(text) - at >= length:
            end = min(len(text), at + _PIECE)
            if held and size + end - at > _PIECE:
                yield held
                held, size = [], 0
            held.append((k, at, end))
            size += end - at
            at = end - length + 1
    if held:
        yield held


def _segment_rows(length: int, gram: int):
    def make():
        anchors = Anchors(length, gram)

        def step(part: pa.RecordBatch) -> pa.RecordBatch | None:
            texts = part.column("text").to_pylist()
            u1, u2 = np.asarray(part.column("u1")), np.asarray(part.column("u2"))
            columns: list[list[np.ndarray]] = [[] for _ in range(7)]
            for piece in _pieces(texts, length):
                data = b"".join([texts[k][a:b] for k, a, b in piece])
                sizes = np.array([b - a for _, a, b in piece])
                offsets = np.cumsum(sizes) - sizes
                counts = sizes - length + 1
                owner = np.repeat(np.arange(len(piece)), counts)
                starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[owner]
                first, count, key = anchors.segments(np.frombuffer(data, np.uint8), starts)
                digests = [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)]
                s = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                own = np.searchsorted(offsets, first, side="right") - 1
                doc = np.array([k for k, _, _ in piece])[own]
                start = first - offsets[own] + np.array([a for _, a, _ in piece])[own]
                for c, x in zip(columns, (key, s[:, 0], s[:, 1], u1[doc], u2[doc], start.astype(np.int64), count.astype(np.int32)), strict=True):
                    c.append(x)
            if not columns[0]:
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["key", "s1", "s2", "u1", "u2", "start", "n"])

        return step

    return make


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes (and a little more), by two-stage sorting."""
    n = len(data)
    step = np.diff(data.astype(np.int16), append=np.int16(-1))  # the end counts as smaller than any byte
    turns = np.flatnonzero(step)
    small = step[turns[np.searchsorted(turns, np.arange(n))]] > 0  # smaller than the successor
    text = data.tobytes()
    direct = np.flatnonzero(small)
    keys = [text[i : i + depth] for i in direct.tolist()]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    del keys
    size = np.bincount(data, minlength=256)
    end = np.cumsum(size)
    head = end - size
    order = np.empty(n, np.int64)
    by_byte = np.bincount(data[direct], minlength=256)
    at = 0
    for c in np.flatnonzero(by_byte):
        order[end[c] - by_byte[c] : end[c]] = direct[at : at + by_byte[c]]
        at += by_byte[c]
    fill = head.copy()

    def put(found: np.ndarray) -> None:
        """Append suffixes to the fronts of their buckets, keeping their order."""
        kinds = data[found]
        found = found[np.argsort(kinds, kind="stable")]
        counts = np.bincount(kinds, minlength=256)
        at = 0
        for c in np.flatnonzero(counts):
            order[fill[c] : fill[c] + counts[c]] = found[at : at + counts[c]]
            fill[c] += counts[c]
            at += counts[c]

    def before(found: np.ndarray) -> np.ndarray:
        found = found[found > 0] - 1
        return found[~small[found]]

    if n and not small[n - 1]:
        put(np.array([n - 1]))
    for c in np.flatnonzero(size):
        done = head[c]
        while done < fill[c]:  # runs of one byte reach into their own bucket
            now = order[done : fill[c]].copy()
            done = fill[c]
            put(before(now))
        put(before(order[end[c] - by_byte[c] : end[c]]))
    return order


def repeated_windows(segments: list[bytes], length: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """For different segments: which window starts are repeated; and of all windows (segment, start, class)."""
    data = np.frombuffer(b"".join([s + bytes([_END]) for s in segments]) + bytes([_END]) * length, np.uint8)
    sizes = np.array([len(s) for s in segments])
    offsets = np.cumsum(sizes + 1) - sizes - 1
    window = np.zeros(len(data), bool)
    for o, s in zip(offsets.tolist(), sizes.tolist(), strict=True):
        window[o : o + s - length + 1] = True
    order = suffix_order(data, length)
    order = order[window[order]]
    views = np.lib.stride_tricks.sliding_window_view(data, length)
    same = np.zeros(len(order), bool)  # has the common prefix with the one before
    for i in range(1, len(order), 4096):
        j = min(len(order), i + 4096)
        same[i:j] = common_prefix(views, order[i - 1 : j - 1], order[i:j]) >= length
    again = same.copy()
    again[:-1] |= same[1:]
    flags = np.zeros(len(data), bool)
    flags[order] = again
    owner = np.searchsorted(offsets, order, side="right") - 1
    return [flags[o : o + s - length + 1] for o, s in zip(offsets.tolist(), sizes.tolist(), strict=True)], owner, order - offsets[owner], np.cumsum(~same)


def common_prefix(views: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = views[a] != views[b]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), views.shape[1])


_FOUND = "key long, s1 long, s2 long, runs array<struct<a:int,b:int>>, part int, packed binary"
_FOUND_ARROW = pa.schema([("key", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("runs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                          ("part", pa.int32()), ("packed", pa.binary())])
#: A different window of a block: digest, and its place if it occurs there once.
_WINDOW = np.dtype([("w1", "<i8"), ("w2", "<i8"), ("s1", "<i8"), ("s2", "<i8"), ("at", "<i4"), ("alone", "?")])
#: Blocks whose windows one range of digests takes on average.
_TOGETHER = 8


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _FOUND_ARROW, strict=True)], schema=_FOUND_ARROW)


def _runs(flags: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return [{"a": int(a), "b": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def _sorted_groups(length: int):
    """From segments sorted by (key, block, s1, s2): repeated starts of segments that occur once. Of keys with
    several blocks also the different windows, packed by ranges of their digests."""

    def solve(rows: list[tuple]) -> Iterator[tuple]:
        flags, owner, start, kind = repeated_windows([r[6] for r in rows], length)
        for r, f in zip(rows, flags, strict=True):
            if r[4] == 1 and f.any():
                yield (r[0], r[2], r[3], _runs(f), None, None)
        if rows[0][5] > 1:  # such rows have a sort of their own
            first = np.flatnonzero(np.diff(kind, prepend=0))
            out = np.zeros(len(first), _WINDOW)
            places = list(zip(owner[first].tolist(), start[first].tolist(), strict=True))
            digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(rows[o][6][at : at + length]) for o, at in places]), "<i8").reshape(-1, 2)
            out["w1"], out["w2"], out["at"] = digests[:, 0], digests[:, 1], start[first]
            out["s1"], out["s2"] = (np.array([r[k] for r in rows])[owner[first]] for k in (2, 3))
            out["alone"] = [rows[o][4] == 1 and not flags[o][at] for o, at in places]
            part = out["w1"].view(np.uint64) % np.uint64(max(1, rows[0][5] // _TOGETHER))
            for p in np.unique(part):
                yield (rows[0][0], None, None, None, int(p), out[part == p].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []  # the segments of a key, or of one of its blocks
        held: list[tuple] = []  # whole groups that will share a sort
        out: list[tuple] = []

        def finish() -> None:
            nonlocal group
            if group and group[0][5] > 1:
                out.extend(solve(group))
            else:
                held.extend(group)
            if held and sum(len(r[6]) for r in held) >= SORT_BYTES:
                out.extend(solve(held))
                held.clear()
            group = []

        for batch in batches:
            for part in common.cut(batch, "bytes"):
                for r in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if group and r[:4] == group[-1][:4]:
                        continue  # a repeated document brought the same segment
                    if group and r[:2] != group[-1][:2]:
                        finish()
                    group.append(r)
                if len(out) > 1 << 12:
                    yield _found(out)
                    out.clear()
        finish()
        out.extend(solve(held) if held else ())
        if out:
            yield _found(out)

    return run


def _across_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From packed windows sorted by (key, part): starts that occur once in their block and again in another."""
    at, held = None, []

    def close() -> list[tuple]:
        rows = np.frombuffer(b"".join(held), _WINDOW)
        rows = rows[np.lexsort((rows["w2"], rows["w1"]))]
        same = (rows["w1"][1:] == rows["w1"][:-1]) & (rows["w2"][1:] == rows["w2"][:-1])
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        rows = rows[again & rows["alone"]]
        rows = rows[np.lexsort((rows["at"], rows["s2"], rows["s1"]))]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(rows["s1"]) != 0) | (np.diff(rows["s2"]) != 0)])) if len(rows) else []
        return [(at[0], int(r["s1"][0]), int(r["s2"][0]), [{"a": int(x), "b": int(x) + 1} for x in r["at"]], None, None) for r in np.split(rows, new)[1:]]

    for batch in batches:
        for key, part, packed in zip(*(batch.column(c).to_pylist() for c in ("key", "part", "packed")), strict=True):
            if (key, part) != at:
                if held and (out := close()):
                    yield _found(out)
                at, held = (key, part), []
            held.append(packed)
    if held and (out := close()):
        yield _found(out)


def _bytes_of_segments(length: int):
    """From documents with their wanted segments: one row for each segment. Equal documents come one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for part in common.cut(batch, "text"):
                rows = []
                for u1, u2, text, wanted in zip(*(part.column(c).to_pylist() for c in ("u1", "u2", "text", "wanted")), strict=True):
                    if (u1, u2) != last:
                        last = (u1, u2)
                        rows += [(w["key"], w["block"], w["s1"], w["s2"], w["n_occ"], w["blocks"], text[w["start"] : w["start"] + w["n"] + length - 1]) for w in wanted]
                for i in range(0, len(rows), 4096):
                    columns = zip(*rows[i : i + 4096], strict=True)
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                                     names=["key", "block", "s1", "s2", "n_occ", "blocks", "bytes"])

    return run


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text as bytes, u1, u2): u1 and u2 stand for the content."""
    return common.texts(docs, id_col, text_col).select(
        "doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("u1"), F.xxhash64(F.lit("text"), F.col("text")).alias("u2"))


def spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """(u1, u2, spans): byte ranges [a, b) to remove for each content that has any; ranges may overlap."""
    source = _identified(docs, id_col, text_col).filter(F.octet_length("text") >= length)
    rows = common.stored(common.map_arrow(source.select("text", "u1", "u2"), _segment_rows(length, gram),
                                          "key long, s1 long, s2 long, u1 long, u2 long, start long, n int"), "substring-rows")
    # keys and kinds are stored before they are joined with their own source, so that the joins can split a frequent key
    keys = common.stored(rows.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key"), "substring-keys")
    met = common.stored(rows.join(keys, "key"), "substring-segments")
    common.drop_stored(rows)

    place = F.struct("u1", "u2", "start", "n")
    folded = common.stored(met.groupBy("key", "s1", "s2").agg(F.count("*").alias("n_occ"), F.min(place).alias("at")), "substring-folded")
    kinds = common.stored(folded.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "substring-kinds")
    blocks = F.ceil(F.col("kinds") / block).cast("int")
    wanted = folded.join(kinds, "key").select("key", F.pmod("s1", blocks).cast("int").alias("block"), "s1", "s2", "n_occ", blocks.alias("blocks"), "at.*")
    by_doc = wanted.groupBy("u1", "u2").agg(F.collect_list(F.struct("key", "block", "s1", "s2", "n_occ", "blocks", "start", "n")).alias("wanted"))
    by_doc = common.stored(by_doc, "substring-wanted")  # so that the join can split a text that many rows share
    texts = source.select("u1", "u2", "text").join(by_doc, ["u1", "u2"]).select("u1", "u2", "text", "wanted")
    cut = texts.mapInArrow(_bytes_of_segments(length), "key long, block int, s1 long, s2 long, n_occ long, blocks int, bytes binary")
    ordered = cut.repartition("key", "block").sortWithinPartitions("key", "block", "s1", "s2")
    found = common.stored(ordered.mapInArrow(_sorted_groups(length), _FOUND), "substring-found")

    inside = found.filter("packed IS NULL").select("key", "s1", "s2", "runs")
    packed = found.filter("packed IS NOT NULL").repartition("key", "part").sortWithinPartitions("key", "part")
    across = packed.mapInArrow(_across_blocks, _FOUND).select("key", "s1", "s2", "runs")
    whole = folded.filter("n_occ > 1").select("key", "s1", "s2", F.array(F.struct(F.lit(0).alias("a"), F.col("at.n").alias("b"))).alias("runs"))
    verdict = whole.unionByName(inside).unionByName(across).groupBy("key", "s1", "s2").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    verdict = common.stored(verdict, "substring-verdict")
    marks = met.join(verdict, ["key", "s1", "s2"]).select("u1", "u2", "start", F.explode("runs").alias("r"))
    marks = marks.select("u1", "u2", F.struct((F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b") + (length - 1)).alias("b")).alias("s"))
    return marks.groupBy("u1", "u2").agg(F.collect_set("s").alias("spans"))


def _merged(found: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in found or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, kept: bool = True) -> DataFrame:
    """For each row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes."""
    found = common.stored(spans(docs, id_col=id_col, text_col=text_col, length=length, gram=gram, block=block), "substring-spans")
    joined = _identified(docs, id_col, text_col).join(found, ["u1", "u2"], "left").select("doc_id", "text", "spans")

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text, ranges in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                ranges = _merged(ranges)
                edges = [0, *(x for r in ranges for x in r), len(text)]
                rest = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]) if ranges else text
                out.append((len(text), len(text) - len(rest), len(ranges), hashlib.sha256(rest).hexdigest(), rest))
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[: 4 + kept]
            return pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=False))],
                                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + kept])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return common.map_arrow(joined, make, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept)


def op4(spark, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"), kept=False)
