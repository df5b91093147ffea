"""Decontamination, BPE, WARC, sharding and the language model against brute force and round trips."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortgraph.llm import bpe, brown, common, decontamination, sharding, warc

tokenizers = pytest.importorskip("tokenizers")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_scan(docs, items, n=13):
    out = []
    for i, t in docs:
        words = WORD.findall(lower(t))
        hit, found = set(), set()
        for item, text in items:
            seq = WORD.findall(lower(text))
            size = min(n, len(seq))
            for k in range(len(seq) - size + 1 if size else 0):
                for p in range(len(words) - size + 1):
                    if words[p : p + size] == seq[k : k + size]:
                        hit.update(range(p, p + size))
                        found.add(item)
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


ITEMS = [(1, "The quick, brown fox! jumps over the lazy dog and then runs away from all of them"), (2, "Zebra"), (3, None), (4, "..."),
         (None, "alpha beta gamma"), (10, "zebra ÄÖ"), (1, "ZEBRA"), (2, "zebra")]
TEXTS = [(1, "before the QUICK brown-fox jumps over the lazy dog and then runs away from all of them after " + "w " * 30), (2, "zebra " * 3 + "x " * 200),
         (3, None), (4, ""), (5, "Alpha; beta gamma"), (5, "Alpha; beta gamma"), (None, "zebra ÄÖ zebra äö"), (6, "clean text " * 50)]


@pytest.mark.parametrize("broadcast_bytes", [1, 1 << 20])
def test_decontamination(docs_of, broadcast_bytes):
    docs, items = docs_of(TEXTS), docs_of(ITEMS, "item_id")
    got = decontamination.digest(decontamination.scan(docs, items, broadcast_bytes=broadcast_bytes)).collect()
    assert sorted(map(tuple, got), key=str) == brute_scan(TEXTS, ITEMS)


@pytest.mark.parametrize(("broadcast_bytes", "filter_words"), [(1 << 20, 1), (1, 1), (1, 1 << 10)])
def test_decontamination_removes(docs_of, monkeypatch, broadcast_bytes, filter_words):
    whole = decontamination.joined_hits
    monkeypatch.setattr(decontamination, "joined_hits", lambda *a, **k: whole(*a, **k, filter_words=filter_words))
    docs, items = docs_of(TEXTS), docs_of(ITEMS, "item_id")
    kept = decontamination.remove_documents(docs, items, broadcast_bytes=broadcast_bytes)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6]
    spans = {r.doc_id: r for r in decontamination.remove_spans(docs, items, broadcast_bytes=broadcast_bytes).collect()}
    assert spans[1].text.startswith("before  after") and spans[1].n_spans == 1
    assert spans[5].text == "" and spans[6].text == TEXTS[-1][1] and spans[3].text == ""
    assert decontamination.scan(docs, docs_of([], "item_id"), broadcast_bytes=broadcast_bytes).filter("contaminated").count() == 0
    assert decontamination.scan(docs, docs_of([(1, None)], "item_id"), broadcast_bytes=broadcast_bytes).filter("n_hit > 0").count() == 0
    assert decontamination.scan(docs_of([]), items, broadcast_bytes=broadcast_bytes).count() == 0


def library():
    import public_tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path(bpe.NAME))
    t.no_padding()
    t.no_truncation()
    return t


def test_bpe_equals_the_library(docs_of, rows):
    rng = random.Random(6)
    alphabet = "abcdehinorst' <|endoftext|>\x1c\x85 ΣΑσςİÉ123٣½日한🙂!?.,\n\t-=don't we'll"
    more = [(1000 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80)))) for i in range(1500)]
    more += [(9000 + i, c * n) for i, (c, n) in enumerate([("a", 300), ("=", 77), ("ab", 120), ("ha", 50), ("<|endoftext|>", 3)])]
    texts = [*rows, *more]
    t = library()
    want = []
    for i, x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest(), ids))
    coded = bpe.encode(docs_of(texts))
    assert sorted(map(tuple, coded.collect()), key=str) == sorted(want, key=str)
    decoded = bpe.decode(coded.filter("doc_id >= 1000")).collect()
    assert {r.doc_id: r.text for r in decoded} == {w[0]: t.decode(w[4], skip_special_tokens=False) for w in want if (w[0] or 0) >= 1000}
    assert bpe.encode(docs_of([])).count() == 0


def test_bpe_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder, t = bpe.Encoder(bpe.tokenizer_text()), library()
    for text in ("one two three four five six", "six five four three two one", "one one seven"):
        assert encoder.encode(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(encoder.words) <= 3


PAGES = [(1, "a" * 100), (2, "a" * 100), (3, "é" * 5000), (4, None), (5, ""), (6, "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 300), (7, "é" * 5000), (None, "a" * 100),
         (None, "alone"), (8, "x\r\n0\r\n\r\ny"), (9, "z" * 4096), (7, "é" * 5000)]


@pytest.mark.parametrize(("segment_bytes", "least"), [(200, 0), (1 << 20, 0), (1000, 101)])
def test_warc_round_trip(spark, docs_of, segment_bytes, least):
    pages = docs_of(PAGES, "page_id", "html").withColumn("url", F.when(F.col("page_id") > 4, F.lit("http://x/\r\ny")))
    path = common.folder(spark, "warc-test")
    got = warc.round_trip(pages, path, least_bytes=least, segment_bytes=segment_bytes, archive_bytes=2 * segment_bytes)
    sizes = [(len(list(warc.parse(x))), len(r.content)) for r in spark.read.format("binaryFile").load(f"{path}/*.gz").collect() for x in [io.BytesIO(gzip.decompress(r.content))]]
    assert len(sizes) > 2 and all(k <= 2 for k, _ in sizes)
    keeper = {}
    for i, h in PAGES:
        keeper[h or ""] = i if keeper.get(h or "") is None else max(keeper[h or ""], i or -1)
    want = []
    for i, h in PAGES:
        b = (h or "").encode()
        again = i != keeper[h or ""] and len(b) >= least
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", keeper[h or ""] if again else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    back = warc.read(spark, path)
    assert back.filter("complete").count() == len(PAGES)
    payloads = {bytes(r.payload) for r in back.filter("kind = 'response'").collect()}
    assert payloads == {(h or "").encode() for _, h in PAGES}


def test_warc_incomplete_segments(spark, docs_of):
    path = common.folder(spark, "warc-test")
    warc.write(docs_of([(1, "q" * 3000), (2, "r" * 10)], "page_id", "html").withColumn("url", F.lit(None).cast("string")), path, segment_bytes=500)
    parts = warc.records(spark, path).filter("segment IS NOT NULL")
    whole = warc.reassembled(parts).collect()
    assert warc.block_payload(bytes(whole[0].block)) == b"q" * 3000
    assert warc.reassembled(parts.filter("segment <> 3")).collect()[0].block is None
    assert warc.reassembled(parts.filter("segment < 7")).collect()[0].block is None
    assert warc.unchunked(b"5\r\nabc") is None


def test_warc_empty_table(spark, docs_of):
    pages = docs_of([], "page_id", "html").withColumn("url", F.lit(None).cast("string"))
    path = common.folder(spark, "warc-test")
    assert warc.round_trip(pages, path).count() == 0
    assert warc.read(spark, path).count() == 0


@pytest.mark.parametrize(("limit", "step"), [(400, 2), (5000, 16), (1 << 30, 3)])
def test_sharding(docs_of, rows, limit, step):
    got = sharding.assign(docs_of(rows), limit=limit, step=step).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    names = sorted(shards)
    for a, b in zip(names, names[1:]):
        assert not b.startswith(a)  # a prefix code: every key has one shard
    sizes = {}
    for name, members in shards.items():
        assert {(len(name), len(members))} == {(m.depth, m.shard_docs) for m in members}
        sizes[name] = members[0].shard_bytes
        assert sizes[name] <= limit or len(members) == 1
    assert sum(sizes.values()) == sum(len((t or "").encode()) for _, t in rows)
    for name in names:  # only oversized buckets are split
        if name:
            inside = [n for n in names if n.startswith(name[:-1])]
            assert sum(sizes[n] for n in inside) > limit and sum(len(shards[n]) for n in inside) > 1


def test_sharding_write(spark, docs_of, tmp_path):
    """Null and repeated ids: each row once, in the shard it was given."""
    rows = [(None, "none " * 20), (None, None), *[(7, f"text {i} " * 9) for i in range(30)], *[(7, "same")] * 3, *[(i, f"t{i}" * 40) for i in range(40)]]
    path = str(tmp_path / "shards")
    sharding.write(docs_of(rows), path, limit=400)
    got = spark.read.option("basePath", path).schema("doc_id long, text string, shard string").parquet(path).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(len(r.text))
    assert len(shards) > 10
    assert all(sum(n) <= 400 or len(n) == 1 for n in shards.values())


def test_sharding_empty_table(docs_of):
    assert sharding.assign(docs_of([])).count() == 0


def lm_rows():
    rng = random.Random(12)
    kinds = [[f"{p}{i}" for i in range(40)] for p in ("aa", "bb", "cc")]
    rows = []
    for i in range(300):
        kind = rng.choice(kinds)
        rows.append((i, " ".join(rng.choice(kind) if rng.random() < 0.95 else f"rare{rng.randrange(4000)}" for _ in range(rng.randint(0, 60)))))
    return [*rows, (900, None), (901, ""), (902, "AA1\x0bunseen words HERE"), (5, "aa1 aa2"), (None, "bb1 bb2 new")]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_language_model(docs_of, monkeypatch):
    monkeypatch.setattr(brown, "CHUNK_BYTES", 3000)
    rows = lm_rows()
    tokens = lambda t: [w for w in re.split("[\x20\x09-\x0d]+", lower(t)) if w] + [None]
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    got = brown.score(docs_of(rows), common.id_remainder(F.col("doc_id"), 7) == 2, classes=6, seed_words=50).collect()
    want = sorted(((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens(t)), 6))
                   for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == want
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.85 * sum(r.base_score for r in out)  # both are negative


def test_language_model_sums_to_one(docs_of):
    """Texts of at most one word have at most all of the probability, repeating a word repeats its step, and the parts of a history sum to one."""
    train = [(i, t) for i, t in lm_rows()[:60] if not held(i)]
    vocabulary = sorted({w for _, t in train for w in t.split()}) + ["never-seen"]
    probes = [(10_000, "")] + [(10_001 + i, w) for i, w in enumerate(vocabulary)] + [(20_001 + i, f"{w} {w}") for i, w in enumerate(vocabulary)]
    probes += [(30_001 + i, f"{w} {w} {w}") for i, w in enumerate(vocabulary)]
    got = {r.doc_id: r.score for r in brown.score(docs_of([*train, *probes]), F.col("doc_id") >= 10_000, classes=4, seed_words=20).collect()}
    total = 10 ** got[10_000]
    for i in range(len(vocabulary)):
        one, two, three = (got[k + i] for k in (10_001, 20_001, 30_001))
        step = two - one  # log p(w | w)
        assert abs((three - two) - step) < 1e-9
        total += 10**one
    assert total <= 1.0 + 1e-9
    stats = brown.Stats.__new__(brown.Stats)
    stats.size, stats.kinds, stats.discount = np.array([30.0, 10.0, 5.0]), np.array([6.0, 4.0, 1.0]), 0.4
    after, unknown = brown.probabilities(np.array([[9, 3, 1], [4, 2, 2], [8, 1, 0]]), stats)
    known = 1 - stats.discount * stats.kinds / stats.size
    known[2] = 1.0
    assert np.allclose((after * known).sum(1) + unknown, 1)


def test_language_model_against_a_plain_version(docs_of, monkeypatch):
    """With every word a seed the classes are those of the exchange, and the score is what plain loops give."""
    monkeypatch.setattr(brown, "CHUNK_BYTES", 2000)
    rows, classes = lm_rows()[:120], 5
    split = lambda t: [w.encode() for w in lower(t).split()]
    train = [split(t) for i, t in rows if not held(i)]
    counts = Counter(w for ws in train for w in ws)
    order = sorted(counts, key=lambda w: (-counts[w], w))
    at = {w: i for i, w in enumerate(order)}
    bigrams = np.zeros((len(at) + 2, len(at) + 2), np.int64)
    for ws in train:
        seq = [len(at) + 1, *(at[w] for w in ws), len(at) + 1]
        for a, b in zip(seq, seq[1:], strict=False):
            bigrams[a, b] += 1
    group = dict(zip(order, brown.exchange(bigrams, classes).tolist(), strict=True))
    follow, size, kinds = Counter(), Counter({classes: len(train)}), Counter()
    for ws in train:
        before = classes
        for c in [*(group[w] for w in ws), classes]:
            follow[before, c] += 1
            before = c
    for w, n in counts.items():
        size[group[w]] += n
        kinds[group[w]] += 1
    once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
    cut, every = once / (once + 2 * twice), range(classes + 1)
    after = {}
    for h in every:
        row = sum(follow[h, c] for c in every)
        for c in every:
            after[h, c] = (follow[h, c] + (size[c] + 1) / (sum(size.values()) + classes + 1)) / (row + 1)
    want = {}
    for i, t in rows:
        before, p = classes, 0.0
        for w in split(t):
            if w in counts:
                c = group[w]
                p += math.log10(after[before, c] * (counts[w] - cut) / size[c])
                before = c
            else:
                p += math.log10(sum(after[before, c] * (cut * kinds[c] / size[c] if size[c] else 1.0) for c in range(classes)))
        want[i] = p + math.log10(after[before, classes])
    got = brown.score(docs_of(rows), common.id_remainder(F.col("doc_id"), 7) == 2, classes=classes, seed_words=10_000).collect()
    assert len(got) == len(rows) and any(r.held_out and r.n_known < r.n_tokens for r in got)
    assert all(abs(r.score - want[r.doc_id]) < 1e-6 for r in got)


def test_seeds_are_the_most_frequent_words(docs_of, monkeypatch):
    """Also where a word is never among the first of its chunk: each chunk has many words of its own that are more frequent there."""
    monkeypatch.setattr(brown, "CHUNK_BYTES", 500)
    rows = [(i, " ".join(f"own{i}x{j} own{i}x{j}" for j in range(150)) + " spread") for i in range(12)]
    source = docs_of(rows).select("doc_id", F.lit(False).alias("held_out"), F.col("text").cast("binary").alias("text"))
    assert brown.seeds(source, 1) == [b"spread"]


def likelihood(bigrams, own, classes):
    member = np.eye(classes + 2)[np.concatenate([own, [classes, classes + 1]])]
    table = member.T @ bigrams @ member
    return sum((x * np.log(np.maximum(x, 1))).sum() * f for x, f in ((table, 1), (table.sum(1), -1), (table.sum(0), -1)))


def test_exchange_finds_the_blocks_and_no_better_move():
    rng = np.random.default_rng(1)
    n = 40
    rates = np.full((n + 2, n + 2), 0.2)
    rates[:20, 20:40] = rates[20:40, :20] = 9
    own = brown.exchange(rng.poisson(rates), 2)
    assert len(set(own[:20])) == len(set(own[20:])) == 1 and own[0] != own[20]
    bigrams = rng.poisson(2, (n + 2, n + 2))
    own = brown.exchange(bigrams, 4, sweeps=100)
    best = likelihood(bigrams, own, 4)
    for w in range(n):
        for k in range(4):
            other = own.copy()
            other[w] = k
            assert likelihood(bigrams, other, 4) <= best + 1e-6


def test_language_model_empty_table(docs_of):
    assert brown.score(docs_of([]), F.lit(False)).count() == 0
    got = brown.score(docs_of([(1, "a b")]), F.lit(True)).collect()
    assert got[0].train_tokens == 0 and got[0].n_known == 0
