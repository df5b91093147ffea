"""Language identification with bit-sliced Bloom filters of n-grams.

Texts are lower-cased, everything but letters becomes one blank, and n-grams of ``GRAM`` UTF-8 bytes are
taken within words and their blanks. An n-gram belongs to a language if at least a ``SHARE`` of the
language's learned documents (and two of them) contain it. One row of the filter is the bit mask of the
languages that have it set, so ``PROBES`` rows and-ed together answer for all languages at once which
contain an n-gram. A document's popcounts by language, less the false positives that the filter's fill
makes likely, decide.

Counting is a map-side fold of (language, n-gram, documents) by task and a sum in Spark; as the threshold
is a share of documents, the number of n-grams kept follows the length of documents, not their number.
Where many languages would make it more than ``MOST`` in all, the share is doubled until they fit. The
filter is broadcast, 16 rows for each n-gram of the largest language, at most.

Defined cases: null text and text without a letter is ``und`` with score 0, and is not learned from; a
null id is learned from; null languages are not; repeated rows count as often as they occur; a text with
letters but no known n-gram gets the language with most learned documents and score 0; of equal counts
that language goes first, then the name decides; if nothing can be learned all documents are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm import common

GRAM = 4
SHARE = 0.01
#: (language, n-gram) entries of all filters at most.
MOST = 4_000_000
PROBES = 4
UNKNOWN = "und"
#: (language, n-gram) counts that a task folds before it passes them on.
_HELD = 2_000_000
_BLANK = 32


def letters(text: Column) -> Column:
    """The lower-cased words of a text between single blanks, as bytes."""
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(F.lower(text), r"\P{L}+", " "), F.lit(" ")), F.lit(" ")).cast("binary")


def held_out(id_col: Column) -> Column:
    return common.id_remainder(id_col, 4) == 2


def grams(column: pa.Array, size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(row, n-gram as integer) of all texts of a batch."""
    data, offsets = common.raw_bytes(column)
    n = len(data) - size + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.zeros(n, np.uint64)
    inside = np.ones(n, bool)
    for i in range(size):
        part = data[i : i + n]
        value = (value << np.uint64(8)) | part
        if 0 < i < size - 1:
            inside &= part != _BLANK  # a blank may only be at the ends
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    inside &= row[:n] == row[size - 1 :]
    at = np.flatnonzero(inside)
    return row[at], value[at]


def counts(docs: DataFrame, size: int = GRAM) -> DataFrame:
    """(lang, gram, n) from (lang, text): in how many documents of a language an n-gram occurs; gram -1 counts the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        seen: dict[int, int] = {}

        def fold() -> None:
            lang, gram, n = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((gram, lang))
            lang, gram, n = lang[order], gram[order], n[order]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(lang) != 0) | (gram[1:] != gram[:-1])]))
            held[:] = [(lang[new], gram[new], np.add.reduceat(n, new))]

        def rows() -> Iterator[pa.RecordBatch]:
            listed = pa.array(list(names))
            for lang, gram, n in held:
                for i in range(0, len(lang), 1 << 16):
                    part = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays([listed.take(pa.array(lang[part])), pa.array(gram[part].astype(np.int64)), pa.array(n[part])], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for part in common.cut(batch, "text"):
                code = np.array([names.setdefault(x, len(names)) for x in part.column("lang").to_pylist()])
                for c, m in zip(*np.unique(code, return_counts=True), strict=True):
                    seen[int(c)] = seen.get(int(c), 0) + int(m)
                row, gram = grams(part.column("text"), size)
                if not len(row):
                    continue
                order = np.lexsort((gram, row))
                row, gram = row[order], gram[order]
                first = np.concatenate([[True], (np.diff(row) != 0) | (gram[1:] != gram[:-1])])
                held.append((code[row[first]], gram[first], np.ones(int(first.sum()), np.int64)))
                if sum(len(h[0]) for h in held) > 2 * _HELD:
                    fold()
                    if len(held[0][0]) > _HELD:
                        yield from rows()
        if held:
            fold()
            yield from rows()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(names)), pa.array([-1] * len(names), pa.int64()), pa.array([seen[c] for c in range(len(names))], pa.int64())],
                                             names=["lang", "gram", "n"])

    return docs.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Filters:
    """Bit-sliced Bloom filters: ``rows[i]`` has the languages (64 to a word) whose filter has bit i set."""

    rows: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Filters:
        size = 1 << max(6, (16 * max(map(len, sets), default=1) - 1).bit_length())
        size = min(size, 16 * 1 << (MOST - 1).bit_length())
        rows = np.zeros((size, -(-len(sets) // 64)), np.uint64)
        for k, members in enumerate(sets):
            for at in cls._places(members, size):
                rows[at, k // 64] |= np.uint64(1) << np.uint64(k % 64)
        fill = np.array([np.count_nonzero(rows[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)) / size for k in range(len(sets))])
        return cls(rows, fill**PROBES)

    @staticmethod
    def _places(members: np.ndarray, size: int) -> Iterator[np.ndarray]:
        h = _mixed(members.astype(np.uint64))
        step = (h >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            yield ((h + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64)

    def containing(self, members: np.ndarray) -> np.ndarray:
        """For each n-gram the bit mask of the languages that contain it, a row of words each."""
        out = None
        for at in self._places(members, len(self.rows)):
            out = self.rows[at] if out is None else out & self.rows[at]
        return out


@dataclass
class Model:
    """Languages by falling number of learned documents, and their filters."""

    langs: list[str]
    filters: Filters
    size: int = GRAM

    def hits(self, column: pa.Array) -> np.ndarray:
        """Corrected popcounts: (documents, languages)."""
        row, gram = grams(column, self.size)
        masks = self.filters.containing(gram)
        total = np.bincount(row, minlength=len(column))
        out = np.empty((len(column), len(self.langs)))
        for k in range(len(self.langs)):
            bits = (masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).astype(np.float64)
            false = self.filters.false_rate[k]
            out[:, k] = np.maximum(0.0, (np.bincount(row, bits, len(column)) - total * false) / max(1e-9, 1 - false))
        return out

    def predict(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(doc_id, lang_pred, score): score is the best count's share of the two best."""
        source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), letters(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text"))
        if not self.langs:
            return source.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        model = docs.sparkSession.sparkContext.broadcast(self)

        def make():
            m = model.value
            names = pa.array([*m.langs, UNKNOWN])

            def step(part: pa.RecordBatch) -> pa.RecordBatch:
                hits = m.hits(part.column("text"))
                best = hits.argmax(axis=1)  # the first of equal counts
                top = hits.max(axis=1)
                second = np.partition(hits, -2, axis=1)[:, -2] if hits.shape[1] > 1 else np.zeros(len(hits))
                wordless = np.diff(common.raw_bytes(part.column("text"))[1]) <= 2
                score = np.where(wordless | (top <= 0), 0.0, top / np.maximum(top + second, 1e-300))
                return pa.RecordBatch.from_arrays([part.column("doc_id"), names.take(pa.array(np.where(wordless, len(m.langs), best))), pa.array(score)],
                                                  names=["doc_id", "lang_pred", "score"])

            return step

        return common.map_arrow(source, make, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = GRAM, share: float = SHARE) -> Model:
    """Learn from all documents with a text and a language that are not held out."""
    known = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & F.col("_text").isNotNull() & ~held_out(F.col("_id"))).select("lang", letters(F.col("_text")).alias("text"))
    found = common.stored(counts(known.filter(F.octet_length("text") > 2), size), "language-grams")
    docs_of = {r.lang: r.n for r in found.filter("gram = -1").collect()}
    langs = sorted(docs_of, key=lambda x: (-docs_of[x], x))
    total = found.filter("gram = -1").select(F.col("lang").alias("_lang"), F.col("n").alias("docs"))
    often = found.filter("gram <> -1 AND n > 1").join(total, F.col("lang") == F.col("_lang"))
    while (kept := often.filter(F.col("n") >= share * F.col("docs"))).count() > MOST:
        share *= 2
    sets: dict[str, list[int]] = {x: [] for x in langs}
    for batch in kept.select("lang", "gram").toArrow().to_batches():  # MOST rows at most
        for x, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets[x].append(g)
    return Model(langs, Filters.of([np.array(sets[x], np.uint64) for x in langs]), size)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = fit(docs).predict(docs)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
