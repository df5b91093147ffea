"""Exact dedup with Patricia tries that own their texts.

Texts are compared without white space. Each map task first folds equal texts of a slice into one
row, so a text that a third of all rows share reaches its owner as a few rows per task. The folded
rows are dealt out by length and content hash, so equal texts have one owner. An owner goes through its
length classes (powers of two) and inserts the full byte strings of a class into one compressed radix trie,
whose strings share prefixes and branch where they differ. A terminal node stores the best row of its string.
When a trie holds more than ``subtree_bytes``, its largest subtrees are spilled one by one until half of the
limit is free: their terminals leave the task as rows. A last aggregate by SHA-256 joins what a string left
before and after a spill.

Defined cases: null counts as empty; of equal texts the row with the most code points, then the
smallest id stays (a null id comes last); rows equal in id, length and text are one document and all
marked kept; repeated rows count in ``group_size``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.llm import common

SUBTREE_BYTES = 32 << 20
#: What a node takes besides its label, in bytes.
_NODE = 300
_WHITE = common.WHITE.encode()


def better(a: tuple, b: tuple) -> tuple:
    """Of two (n_chars, id) the one that stays."""
    if a[0] != b[0]:
        return a if a[0] > b[0] else b
    if a[1] is None or b[1] is None:
        return b if a[1] is None else a
    return a if a[1] <= b[1] else b


class Node:
    __slots__ = ("children", "count", "keeper", "label")

    def __init__(self, label: bytes):
        self.label, self.children, self.keeper, self.count = label, {}, None, 0


class Trie:
    """A compressed radix trie over byte strings; terminals hold the row that stays and a count."""

    def __init__(self):
        self.root, self.bytes = Node(b""), 0

    def add(self, key: bytes, keeper: tuple, count: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.bytes += len(child.label) + _NODE
                node, at = child, len(key)
                break
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, key[at : at + len(label)])
            upper = node.children[key[at]] = Node(label[:same])
            self.bytes += _NODE
            child.label = label[same:]
            upper.children[child.label[0]] = child
            node, at = upper, at + same
        node.keeper = keeper if node.keeper is None else better(node.keeper, keeper)
        node.count += count

    def spill(self) -> Iterator[tuple[bytes, tuple, int]]:
        """All terminals as (string, keeper, count); the trie is empty afterwards."""
        root, self.root, self.bytes = self.root, Node(b""), 0
        yield from terminals(root, b"")

    def spill_subtrees(self, limit: int) -> Iterator[tuple[bytes, tuple, int]]:
        """Terminals of the largest subtrees, one subtree after another, until at most ``limit`` bytes are held."""
        while self.bytes > limit:
            path, node = b"", self.root
            while len(node.children) == 1:  # below a prefix that all share
                (node,) = node.children.values()
                path += node.label
            if not node.children:
                yield from self.spill()
                return
            sizes = {first: held(child) for first, child in node.children.items()}
            for first in sorted(sizes, key=sizes.get, reverse=True):
                yield from terminals(node.children.pop(first), path)
                self.bytes -= sizes[first]
                if self.bytes <= limit:
                    return


def terminals(top: Node, prefix: bytes) -> Iterator[tuple[bytes, tuple, int]]:
    """(string, keeper, count) of every terminal at or below a node."""
    stack = [(top, prefix)]
    while stack:
        node, before = stack.pop()
        key = before + node.label
        if node.count:
            yield key, node.keeper, node.count
        stack.extend((c, key) for c in node.children.values())


def held(top: Node) -> int:
    """Bytes of a node and all below it."""
    total, stack = 0, [top]
    while stack:
        node = stack.pop()
        total += len(node.label) + _NODE
        stack.extend(node.children.values())
    return total


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _owned(subtree_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, at, out = Trie(), None, []

        def leaving(spilled) -> Iterator[tuple]:
            return ((hashlib.sha256(k).digest(), *keeper, n) for k, keeper, n in spilled)

        def flush() -> pa.RecordBatch:
            rows, out[:] = list(out), []
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], ids), pa.array([r[3] for r in rows], pa.int64())],
                names=["sha", "best_chars", "best_id", "n"])

        ids = pa.int64()
        for batch in batches:
            ids = batch.schema.field("best_id").type
            for part in common.cut(batch, "norm"):
                for size, _, norm, chars, best, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    gone = ()
                    if size.bit_length() != at:
                        gone, at = trie.spill(), size.bit_length()
                    elif trie.bytes > subtree_bytes:
                        gone = trie.spill_subtrees(subtree_bytes // 2)
                    for row in leaving(gone):
                        out.append(row)
                        if len(out) >= 4096:
                            yield flush()
                    trie.add(norm, (chars, best), n)
        for row in leaving(trie.spill()):
            out.append(row)
            if len(out) >= 4096:
                yield flush()
        if out:
            yield flush()

    return run


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", subtree_bytes: int = SUBTREE_BYTES) -> DataFrame:
    """One row for each distinct text: sha (binary), best_chars, best_id, group_size."""
    source = common.texts(docs, id_col, text_col).select("doc_id", F.char_length("text").cast("long").alias("chars"), F.col("text").cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            found: dict[bytes, tuple[tuple, int]] = {}
            for doc, chars, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                norm, keeper = text.translate(None, _WHITE), (chars, doc)
                old = found.get(norm)
                found[norm] = (keeper, 1) if old is None else (better(old[0], keeper), old[1] + 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(k) for k in found], pa.int32()), pa.array([xxhash.xxh64_intdigest(k) - (1 << 63) for k in found], pa.int64()),
                 pa.array(found.keys(), pa.binary()), pa.array([v[0][0] for v in found.values()], pa.int64()),
                 pa.array([v[0][1] for v in found.values()], part.schema.field("doc_id").type), pa.array([v[1] for v in found.values()], pa.int64())],
                names=["n_bytes", "h", "norm", "best_chars", "best_id", "n"])

        return step

    folded = common.map_arrow(source, make, f"n_bytes int, h long, norm binary, best_chars long, best_id {kind}, n long")
    owned = folded.repartition("n_bytes", "h").sortWithinPartitions("n_bytes", "h").mapInArrow(
        _owned(subtree_bytes), f"sha binary, best_chars long, best_id {kind}, n long")
    best = F.min(F.struct((-F.col("best_chars")).alias("less"), F.col("best_id").isNull().alias("none"), "best_id")).alias("best")
    return owned.groupBy("sha").agg(best, F.sum("n").alias("group_size")).select(
        "sha", (-F.col("best.less")).alias("best_chars"), F.col("best.best_id").alias("best_id"), "group_size")


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", subtree_bytes: int = SUBTREE_BYTES) -> DataFrame:
    """For each row: doc_id, keep_id, group_size, kept, text_sha256."""
    own = common.texts(docs, id_col, text_col).select(
        "doc_id", F.char_length("text").cast("long").alias("chars"),
        F.unhex(F.sha2(F.translate("text", common.WHITE, "").cast("binary"), 256)).alias("sha"))
    # stored, so that the join deals out both sides itself and can split a text that many rows share
    found = common.stored(groups(docs, id_col=id_col, text_col=text_col, subtree_bytes=subtree_bytes), "exact-groups")
    return own.join(found, "sha").select(
        "doc_id", F.col("best_id").alias("keep_id"), "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("chars") == F.col("best_chars"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def op2(spark, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha FROM documents),
g AS (SELECT sha, count(*) AS group_size, max(chars) AS best FROM d GROUP BY sha),
k AS (SELECT sha, min(doc_id) AS keep_id FROM d JOIN g USING (sha) WHERE chars = best GROUP BY sha)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AND chars = best AS kept, sha AS text_sha256
FROM d JOIN g USING (sha) JOIN k USING (sha)
"""
