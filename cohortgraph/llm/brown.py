"""LM scoring with Brown class-based n-grams.

p(w | v) = p(class(w) | class(v)) * p(w | class(w)), with classes from exchange clustering.

1. Seeds. The ``SEEDS`` most frequent words are clustered by the exchange algorithm on their class
   bigrams over all training text: a word moves to the class that raises the likelihood most until no
   word moves. The counts are a table of SEEDS^2 cells at most. All other words stand in it as one pseudo word.
2. Every other word of the corpus then goes to the class under which its left and right neighbours are
   likeliest, the same criterion for one word at a time. These words are distributed by hash.
3. Documents are coded in chunks of bounded size with a dictionary of the chunk's own words. Only
   dictionaries travel to the words and back (a word has at most one row a chunk), never tokens.
4. Class transitions are counted over all training documents and smoothed with class frequencies.
   Emissions are discounted by d = n1 / (n1 + 2 n2); what that frees in a class is its share for
   unknown words. An unknown word leaves the history at the class before it. For each history the
   probabilities of all known words, the end and the unknown word sum to one.

Words are known by 64-bit hashes. Defined cases: null text is empty and has only its end token; rows
may repeat; without training rows every word is unknown and only base scores tell texts apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cohortgraph.llm import common

CLASSES = 32
SEEDS = 2048
SWEEPS = 20
CHUNK_BYTES = 16 << 20
_UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_END = b"\n"  # no word holds white space
_UNKNOWN = 255


def words(text: bytes) -> list[bytes]:
    return text.translate(_UPPER).split()


def _hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


class _Intern(dict):
    """Numbers keys in the order they come."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[tuple]]:
    """Rows of a task in lists of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for part in common.cut(batch, "text"):
            rows = list(zip(*(c.to_pylist() for c in part.columns), strict=True))
            held += rows
            size += sum(len(r[-1]) for r in rows)
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def seeds(source: DataFrame, n: int) -> list[bytes]:
    """The most frequent training words, by exact counts (a word is one row a chunk); ties by byte order."""

    def run(batches):
        for rows in _chunks(batches, CHUNK_BYTES):
            intern = _Intern()
            counts = np.zeros(0, np.int64)
            for _, held, text in rows:
                if not held:
                    found = np.bincount(np.fromiter(map(intern.__getitem__, words(text)), np.int64), minlength=len(intern))
                    found[: len(counts)] += counts
                    counts = found
            yield pa.RecordBatch.from_arrays([pa.array(list(intern), pa.binary()), pa.array(counts)], names=["w", "n"])

    found = source.mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return [bytes(r.w) for r in found.orderBy(F.desc("n"), "w").limit(n).collect()]


def _dense(df: DataFrame, run, size: int) -> np.ndarray:
    """Sum of the (cell, n) rows that tasks send, as an array of ``size`` cells."""
    out = np.zeros(size, np.int64)
    table = df.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[np.asarray(table.column("cell"))] = np.asarray(table.column("n"))
    return out


def _cells(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])


def seed_bigrams(source: DataFrame, chosen: list[bytes]) -> np.ndarray:
    """Bigram counts of seeds, other words (row and column n) and the end (n + 1) over all training documents."""
    n, side = len(chosen), len(chosen) + 2
    ids = source.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(chosen)})

    def run(batches):
        get, total = ids.value.get, np.zeros(side * side, np.int64)
        for batch in batches:
            for part in common.cut(batch, "text"):
                for _, held, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if not held:
                        found = words(text)
                        seq = np.full(len(found) + 2, n + 1, np.int64)
                        seq[1:-1] = np.fromiter(map(get, found, repeat(n)), np.int64, len(found))
                        np.add.at(total, seq[:-1] * side + seq[1:], 1)
        yield _cells(total)

    return _dense(source, run, side * side).reshape(side, side)


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each word; the last two rows of ``bigrams`` (other words, end) keep classes of their own.

    The criterion is the class bigram likelihood, sum N(g,h) log N(g,h) - sum N(g,.) log N(g,.) - sum N(.,h) log N(.,h).
    The most frequent words begin in classes of their own; the others join the best class in the first sweep.
    """
    n = len(bigrams) - 2
    own = np.concatenate([np.minimum(np.arange(n), classes), [classes, classes + 1]])
    member = np.zeros((n + 2, classes + 2))
    member[np.arange(n + 2), own] = 1
    to, fro = bigrams @ member, bigrams.T @ member  # of each word: counts to and from each class
    table = member.T @ to
    out, into = bigrams.sum(1).astype(float), bigrams.sum(0).astype(float)
    size_out, size_in = member.T @ out, member.T @ into
    phi = lambda x: x * np.log(np.maximum(x, 1))
    every = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            a, self_count = own[w], float(bigrams[w, w])
            right, left = to[w].copy(), fro[w].copy()
            right[a] -= self_count
            left[a] -= self_count
            table[a] -= right
            table[:, a] -= left
            table[a, a] -= self_count
            rows, cols = table[:classes], table[:, :classes].T
            gain = (phi(rows + right) - phi(rows)).sum(1) + (phi(cols + left) - phi(cols)).sum(1)
            diagonal, r, l = table[every, every], right[:classes], left[:classes]  # the cell that both sums touch
            gain += phi(diagonal + r + l + self_count) - phi(diagonal) - (phi(diagonal + r) - phi(diagonal)) - (phi(diagonal + l) - phi(diagonal))
            size_out[a] -= out[w]
            size_in[a] -= into[w]
            gain -= (phi(size_out + out[w]) - phi(size_out) + phi(size_in + into[w]) - phi(size_in))[:classes]
            b = int(np.argmax(gain)) if a == classes or gain.max() > gain[a] + 1e-9 else a
            table[b] += right
            table[:, b] += left
            table[b, b] += self_count
            size_out[b] += out[w]
            size_in[b] += into[w]
            if b != a:
                moved += 1
                own[w] = b
                to[:, a] -= bigrams[:, w]
                to[:, b] += bigrams[:, w]
                fro[:, a] -= bigrams[w]
                fro[:, b] += bigrams[w]
        if not moved:
            break
    return own[:n]


def neighbour_logs(bigrams: np.ndarray, own: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(log p of each class after / before a neighbour's class as rows of 2 * (classes + 2) by classes, class sizes)."""
    side = classes + 2
    member = np.zeros((len(bigrams), side))
    member[np.arange(len(bigrams)), np.concatenate([own, [classes, classes + 1]])] = 1
    table = member.T @ bigrams @ member + 0.5
    after = np.log(table / table.sum(1, keepdims=True))  # [left neighbour, class]
    return np.concatenate([after[:, :classes], after[:classes].T]), (member.T @ bigrams.sum(1))[:classes]


_CODED = "chunk long, doc_id {kind}, held_out boolean, tokens binary, idx int, w long, n long, slots binary"
_SLOT = np.dtype([("s", "u1"), ("c", "<u2")])


def coded(source: DataFrame, chosen: list[bytes], own: np.ndarray, classes: int) -> DataFrame:
    """Two kinds of rows: documents (chunk, doc_id, held_out, tokens as numbers of the chunk's dictionary), and
    dictionary rows (chunk, idx, w, n in training documents of the chunk, slots: neighbours' classes of words that are no seeds)."""
    kind, id_type = source.schema["doc_id"].dataType.simpleString(), to_arrow_type(source.schema["doc_id"].dataType)
    given = source.sparkSession.sparkContext.broadcast({w: int(c) for w, c in zip(chosen, own, strict=True)} | {_END: classes + 1})
    side = classes + 2

    def run(batches):
        first = TaskContext.get().partitionId() << 20
        for chunk, rows in enumerate(_chunks(batches, CHUNK_BYTES), first):
            intern = _Intern()
            intern[_END]  # number 0
            seqs = []
            for _, _, text in rows:
                found = words(text)
                seq = np.zeros(len(found) + 1, np.int32)
                seq[:-1] = np.fromiter(map(intern.__getitem__, found), np.int32, len(found))
                seqs.append(seq)
            size = len(intern)
            learn = [s for s, r in zip(seqs, rows, strict=True) if not r[1]]
            train = np.concatenate([[0], *learn]).astype(np.int64)  # every document begins after an end
            counts = np.bincount(train[1:], minlength=size)
            group = np.fromiter(map(given.value.get, intern, repeat(classes)), np.int64, size)  # the other words' pseudo class: classes
            rare = group == classes
            at = np.flatnonzero(rare[train[1:-1]]) + 1 if len(train) > 2 else np.zeros(0, np.int64)
            keys = np.concatenate([train[at] * (2 * side) + group[train[at - 1]], train[at] * (2 * side) + side + group[train[at + 1]]])
            keys, n = np.unique(keys, return_counts=True)
            over = n >> 16  # counts beyond 16 bits take more entries
            keys, n = np.repeat(keys, over + 1), np.concatenate([np.append(np.full(o, 65535, np.int64), c - 65535 * o) for c, o in zip(n, over, strict=True)]) if over.any() else n
            packed = np.zeros(len(keys), _SLOT)
            packed["s"], packed["c"] = keys % (2 * side), n
            ends = np.searchsorted(keys // (2 * side), np.arange(size), side="right").astype(np.int64) * _SLOT.itemsize
            slots = pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())])
            none = lambda k, t: pa.nulls(k, t)
            ids = pa.array([r[0] for r in rows], id_type)
            names = ["chunk", "doc_id", "held_out", "tokens", "idx", "w", "n", "slots"]
            for i in range(0, len(rows), 1000):
                part = slice(i, i + 1000)
                k = len(seqs[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, chunk)), ids[part], pa.array([r[1] for r in rows[part]], pa.bool_()), pa.array([s.tobytes() for s in seqs[part]], pa.binary()),
                     none(k, pa.int32()), none(k, pa.int64()), none(k, pa.int64()), none(k, pa.binary())], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, chunk)), none(size, ids.type), none(size, pa.bool_()), none(size, pa.binary()),
                 pa.array(np.arange(size, dtype=np.int32)), pa.array([_hash(w) for w in intern], pa.int64()), pa.array(counts), slots], names=names)

    return source.mapInArrow(run, _CODED.format(kind=kind))


def classified(entries: DataFrame, chosen: list[bytes], own: np.ndarray, logs: np.ndarray, sizes: np.ndarray) -> DataFrame:
    """For each dictionary row (chunk, idx): n over all training documents, class, and ``lead`` for one row of each word.

    Rows come sorted by word; what is held of a word is one row a chunk."""
    classes = logs.shape[1]
    fixed = entries.sparkSession.sparkContext.broadcast({_hash(w): int(c) for w, c in zip(chosen, own, strict=True)} | {_hash(_END): classes})
    schema = ["chunk", "idx", "n", "c", "lead"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def solve(chunk, idx, w, n, slot_rows, slots):
            new = np.concatenate([[True], w[1:] != w[:-1]])
            word = np.cumsum(new) - 1
            total = np.zeros(word[-1] + 1, np.int64)
            np.add.at(total, word, n)
            scores = np.zeros((len(total), logs.shape[0]), np.float32)
            np.add.at(scores, (word[slot_rows], slots["s"]), slots["c"])
            gain = scores @ logs - total[:, None] * np.log(sizes[None, :] + total[:, None] + 1)
            best = gain.argmax(1)
            known = fixed.value
            names = w[new]
            for i in np.flatnonzero(np.isin(names, np.fromiter(known, np.int64, len(known)))).tolist():
                best[i] = known[int(names[i])]
            return pa.RecordBatch.from_arrays(
                [pa.array(chunk), pa.array(idx), pa.array(total[word]), pa.array(best[word].astype(np.int16)), pa.array(new)], names=schema)

        def arrays(batch):
            data, offsets = common.raw_bytes(batch.column("slots"))
            return (*(np.asarray(batch.column(c)) for c in ("chunk", "idx", "w", "n")), np.repeat(np.arange(batch.num_rows), np.diff(offsets) // _SLOT.itemsize),
                    np.frombuffer(data.tobytes(), _SLOT))

        def joined(a, b):
            if a is None:
                return b
            return (*(np.concatenate([x, y]) for x, y in zip(a[:4], b[:4], strict=True)), np.concatenate([a[4], b[4] + len(a[0])]), np.concatenate([a[5], b[5]]))

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = joined(held, arrays(batch))
            cut = int(np.searchsorted(rows[2], rows[2][-1]))  # the last word may go on
            if cut:
                k = int(np.searchsorted(rows[4], cut))
                yield solve(*(x[:cut] for x in rows[:4]), rows[4][:k], rows[5][:k])
                held = (*(x[cut:] for x in rows[:4]), rows[4][k:] - cut, rows[5][k:])
            else:
                held = rows
        if held is not None:
            yield solve(*held)

    dealt = entries.select("chunk", "idx", "w", "n", "slots").repartition("w").sortWithinPartitions("w")
    return dealt.mapInArrow(run, "chunk long, idx int, n long, c short, lead boolean")


class Stats:
    """Corpus numbers of a fitted model: N, V, class sizes, words of each class, discount."""

    def __init__(self, rows: DataFrame, classes: int):
        found = rows.filter("lead AND n > 0").groupBy("c").agg(
            F.sum("n").alias("n"), F.count("*").alias("v"), F.sum((F.col("n") == 1).cast("long")).alias("once"), F.sum((F.col("n") == 2).cast("long")).alias("twice")).collect()
        self.size, self.kinds = np.zeros(classes + 1), np.zeros(classes + 1)
        for r in found:
            self.size[r.c], self.kinds[r.c] = r.n, r.v
        once, twice = sum(r.once for r in found if r.c < classes), sum(r.twice for r in found if r.c < classes)
        self.tokens, self.vocabulary = int(self.size.sum()), int(self.kinds.sum())
        self.discount = once / (once + 2 * twice) if once and twice else 0.5


def sequences(codes: DataFrame, entries: DataFrame, stats: Stats, classes: int) -> DataFrame:
    """For each document: doc_id, held_out, n_tokens, n_known, base_score, emission (sum of log10), classes of its tokens."""
    kind = codes.schema["doc_id"].dataType.simpleString()
    size, discount, tokens, vocabulary = stats.size, stats.discount, stats.tokens, stats.vocabulary

    def one(docs, dictionary):
        n = np.zeros(len(dictionary), np.int64)
        c = np.zeros(len(dictionary), np.int64)
        idx = dictionary["idx"].to_numpy()
        n[idx], c[idx] = dictionary["n"].to_numpy(), dictionary["c"].to_numpy()
        base = np.log10((n + 1) / (tokens + vocabulary + 1))
        cut = np.where(c == classes, 0.0, discount)
        emit = np.where(n > 0, np.log10(np.maximum(n - cut, 1e-9) / np.maximum(size[c], 1)), 0.0)
        c = np.where(n > 0, c, _UNKNOWN).astype(np.uint8)
        seqs = [np.frombuffer(t, np.int32) for t in docs["tokens"]]
        out = docs[["doc_id", "held_out"]].copy()
        out["n_tokens"] = [len(s) for s in seqs]
        out["n_known"] = [int((n[s] > 0).sum()) for s in seqs]
        out["base_score"] = [float(base[s].sum()) for s in seqs]
        out["emission"] = [float(emit[s].sum()) for s in seqs]
        out["classes"] = [c[s].tobytes() for s in seqs]
        return out

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, emission double, classes binary"
    return codes.groupBy("chunk").cogroup(entries.groupBy("chunk")).applyInPandas(one, schema)


def _histories(seq: np.ndarray, classes: int) -> np.ndarray:
    """The class before each token; an unknown word passes on the class before it; a text begins after an end."""
    known = np.concatenate([[True], seq[:-1] != _UNKNOWN])
    last = np.maximum.accumulate(np.where(known, np.arange(len(seq)), 0))
    return np.concatenate([[classes], seq[:-1]])[last]


def transitions(rows: DataFrame, classes: int) -> np.ndarray:
    """Counts of class after class over training documents."""
    side = classes + 1

    def run(batches):
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            for c in batch.column("classes").to_pylist():
                seq = np.frombuffer(c, np.uint8).astype(np.int64)
                total += np.bincount(_histories(seq, classes) * side + seq, minlength=side * side)
        yield _cells(total)

    return _dense(rows.filter("NOT held_out").select("classes"), run, side * side).reshape(side, side)


def probabilities(counts: np.ndarray, stats: Stats) -> tuple[np.ndarray, np.ndarray]:
    """(p of a class after a class, p of the unknown word after a class)."""
    classes = len(counts) - 1
    share = (stats.size + 1) / (stats.size.sum() + classes + 1)
    after = (counts + share[None, :]) / (counts.sum(1, keepdims=True) + 1)
    freed = np.where(stats.size > 0, stats.discount * stats.kinds / np.maximum(stats.size, 1), 1.0)
    freed[classes] = 0.0 if stats.size[classes] else 1.0
    return after, after @ freed


def score(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, seed_words: int = SEEDS) -> DataFrame:
    """For each row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. ``held_out`` may use the column doc_id."""
    texts = common.text_bytes(docs, id_col, text_col)
    source = texts.select("doc_id", held_out.alias("held_out"), "text")
    chosen = seeds(source, seed_words)
    bigrams = seed_bigrams(source, chosen)
    own = exchange(bigrams, classes)
    logs, sizes = neighbour_logs(bigrams, own, classes)
    both = common.stored(coded(source, chosen, own, classes), "brown-coded")
    entries = common.stored(classified(both.filter("tokens IS NULL"), chosen, own, logs, sizes), "brown-words")
    stats = Stats(entries, classes)
    rows = common.stored(sequences(both.filter("tokens IS NOT NULL").select("chunk", "doc_id", "held_out", "tokens"),
                                   entries.select("chunk", "idx", "n", "c"), stats, classes), "brown-classes")
    common.drop_stored(both)
    common.drop_stored(entries)
    after, unknown = probabilities(transitions(rows, classes), stats)
    after_log, unknown_log = np.log10(after), np.log10(np.maximum(unknown, 1e-300))

    def run(batches):
        for batch in batches:
            sums = []
            for c in batch.column("classes").to_pylist():
                seq = np.frombuffer(c, np.uint8).astype(np.int64)
                before, known = _histories(seq, classes), seq != _UNKNOWN
                sums.append(float(after_log[before[known], seq[known]].sum() + unknown_log[before[~known]].sum()))
            total = np.asarray(batch.column("emission")) + np.array(sums)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("doc_id", "held_out", "n_tokens", "n_known", "base_score")), pa.array(total)],
                                             names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    kind = source.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(stats.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op1(spark, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"), common.id_remainder(F.col("doc_id"), 7) == 2)
