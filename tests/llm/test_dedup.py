"""Exact dedup, substring dedup, line dedup and SimHash against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cohortgraph.llm import common, exact_dedup, line_dedup, simhash, substrings

WHITE = str.maketrans("", "", common.WHITE)


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


@pytest.mark.parametrize("subtree_bytes", [1, 3000, 1 << 20])
def test_exact_dedup(docs_of, rows, subtree_bytes):
    got = sorted(map(tuple, exact_dedup.dedup(docs_of(rows), subtree_bytes=subtree_bytes).collect()), key=str)
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(WHITE)].append((-len(t or ""), i is None, i))
    want = []
    for i, t in rows:
        best = min(groups[(t or "").translate(WHITE)])
        want.append((i, best[2], len(groups[(t or "").translate(WHITE)]), (-len(t or ""), i) == (best[0], best[2]), sha((t or "").translate(WHITE))))
    assert got == sorted(want, key=str)


def test_exact_dedup_empty_table(docs_of):
    assert exact_dedup.dedup(docs_of([])).count() == 0


def test_trie_keeps_strings_apart():
    rng, trie, want = random.Random(1), exact_dedup.Trie(), Counter()
    for _ in range(2000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9)))
        want[key] += 1
        trie.add(key, (1, 1), 1)
    assert {k: n for k, _, n in trie.spill()} == want
    assert not list(trie.spill())


def test_trie_branches_and_spills_by_subtree():
    trie = exact_dedup.Trie()
    keys = [b"shared-" + c * 3 + bytes([48 + k]) * (20 if c == b"a" else 2) for c in (b"a", b"b", b"c") for k in range(8)] + [b"shared-", b"shared-aaa"]
    for i, key in enumerate(keys):
        trie.add(key, (1, i), 1)
    (stem,) = trie.root.children.values()
    assert stem.label == b"shared-" and stem.count == 1 and sorted(stem.children) == [97, 98, 99]
    assert len(stem.children[97].children) == 8 and trie.bytes == exact_dedup.held(trie.root) - exact_dedup._NODE
    gone = list(trie.spill_subtrees(trie.bytes - 1))
    assert {k for k, _, _ in gone} == {k for k in keys if k.startswith(b"shared-a")}
    assert trie.bytes == exact_dedup.held(trie.root) - exact_dedup._NODE
    gone += trie.spill_subtrees(trie.bytes // 2)
    gone += trie.spill()
    assert sorted((k, keeper[1]) for k, keeper, _ in gone) == sorted((k, i) for i, k in enumerate(keys))
    assert trie.bytes == 0 and not list(trie.spill_subtrees(0))


@pytest.mark.parametrize(("length", "gram", "block"), [(40, 10, 512), (40, 10, 2), (25, 25, 3)])
def test_substrings(docs_of, rows, length, gram, block):
    got = sorted(map(tuple, substrings.dedup(docs_of(rows), length=length, gram=gram, block=block).collect()), key=str)
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    want = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        rest = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        want.append((i, len(t), int(gone.sum()), spans, sha(rest), bytearray(rest)))
    assert got == sorted(want, key=str)


def test_substrings_within_one_long_text(docs_of, monkeypatch):
    monkeypatch.setattr(substrings, "_PIECE", 1 << 19)
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(5000))
    text = text[:3000] + text[100:900] + text[3000:] + "z" * 700
    got = substrings.dedup(docs_of([(1, text), (2, None)])).orderBy("doc_id").collect()
    assert (got[0].n_removed, got[0].n_spans, got[1].n_bytes) == (800 * 2 + 700, 3, 0)


@pytest.mark.parametrize("letters", ["ab", "a", "abcdefghij"])
def test_two_stage_order(letters):
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 200))).encode()
        order = substrings.suffix_order(np.frombuffer(text, np.uint8), 200)
        assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))


def test_substrings_passages_by_bytes(docs_of):
    """At the contract's length: passages of over 50 words that documents share go from 400 bytes on; n_bytes is the input's size either way."""
    rng = random.Random(6)

    def prose(size):
        text = ""
        while len(text) < size:
            text += "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) + " "
        return text[: size - 1] + "."

    passages = {size: prose(size) for size in (399, 400, 401, 900)}
    assert all(len(p.split()) > 50 for p in passages.values())
    rows, want = [], {}
    for k, (size, passage) in enumerate(passages.items()):
        for i, edge in ((2 * k, "<>"), (2 * k + 1, "[]")):  # the edges differ, so no match reaches past the passage
            own = prose(700)
            rows.append((i, own + edge[0] + passage + edge[1] + prose(300)))
            want[i] = (1002 + size, size if size >= 400 else 0, int(size >= 400))
    rows += [(100 + i, prose(1500)) for i in range(4)]
    want |= {100 + i: (1500, 0, 0) for i in range(4)}
    got = substrings.dedup(docs_of(rows), kept=False).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got} == want


def test_substrings_empty_table(docs_of):
    assert substrings.dedup(docs_of([])).count() == 0


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = (a, b) if len(a) < len(b) else (b, a)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def line_rows():
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefg hé") for _ in range(rng.randint(28, 140))) for _ in range(30)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 4)):
            line, kind = rng.choice(base), rng.randrange(6)
            k = rng.randrange(len(line))
            line = {0: line[:k] + "Z" + line[k + 1 :], 1: line[:k] + line[k + 1 :], 2: line[:k] + "Y" + line[k:], 3: f"  {line}\t"}.get(kind, line)
            lines.append(line)
        rows.append((i, "\n".join([*lines, "short", "short"])))
    return [*rows, (500, None), (501, ""), (None, base[0]), (7, rows[7][1]), (8, "other\n" + base[3])]


def brute_lines(rows):
    """(id, text without the lines that came before), and the lines that go because an earlier one is an edit away."""
    bare = lambda s: s.strip(" \t\r")
    order = lambda i, k: (i is None, i or 0, k)
    first = {}
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            s = bare(line)
            if s:
                first[s] = min(first.get(s, order(i, k)), order(i, k))
    long = {s for s in first if len(s) >= line_dedup.MIN_CHARS}
    near = {s for s in long if any(first[o] < first[s] and within_one(o, s) for o in long if o != s)}
    want = []
    for i, t in rows:
        keep = [x for k, x in enumerate((t or "").split("\n")) if not bare(x) or (bare(x) not in near and first[bare(x)] == order(i, k))]
        want.append((i, None if t is None else "\n".join(keep)))
    return want, near


def test_line_dedup(docs_of):
    rows = line_rows()
    want, near = brute_lines(rows)
    assert len(near) > 20
    got = line_dedup.dedup(docs_of(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_line_dedup_edit_at_every_place(docs_of):
    """Edits at each position of lines around the block borders, each against its own original."""
    rng = random.Random(3)
    rows, want = [], {}
    for n in (30, 31, 32, 33, 63, 64, 65, 96, 97):
        for at in range(n):
            for kind in range(3):
                line = "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
                edited = (line[:at] + "!" + line[at + 1 :], line[:at] + line[at + 1 :], line[:at] + "!" + line[at:])[kind]
                if len(edited) >= line_dedup.MIN_CHARS:
                    rows += [(len(rows), line), (len(rows) + 1, edited)]
    got = line_dedup.dedup(docs_of(rows)).filter("doc_id % 2 = 1 AND text <> ''").count()
    assert got == 0


def test_line_dedup_short_repeats(spark, docs_of):
    """The pipeline's stage: repeats of short lines go, their near lines and blank ones stay."""
    long = "a line of more than thirty characters"
    rows = [(2, "All rights reserved.\n\n x\t\n" + long), (1, "top\nAll rights reserved.\ntop \n \nx"), (3, "All rights reserved!\n\n" + long + "s"), (None, "top\nAll rights reserved!\nlast"), (4, None)]
    want = {2: "\n" + long, 1: "top\nAll rights reserved.\n \nx", 3: "All rights reserved!\n", None: "last", 4: None}
    out = corpus_pipeline.lines_once(spark, docs_of(rows), "")
    assert {r.doc_id: r.text for r in out.collect()} == want


def test_line_dedup_keeps_columns_and_empty_table(docs_of):
    docs = docs_of([])
    out = line_dedup.dedup(docs)
    assert out.columns == docs.columns
    assert out.count() == 0


def brute_fingerprint(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).translate({ord(c): " " for c in common.WHITE}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("limit", [1, simhash.BUCKET_LIMIT])
def test_simhash(docs_of, rows, limit):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    kinds = sorted({f for _, f in fps})
    root = {f: f for f in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in kinds:
        for b in kinds:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for i, f in fps:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    got = simhash.near_duplicates(docs_of(rows), bucket_limit=limit).select("doc_id", F.hex("fp"), "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, f"{f:X}", least.get(find(f))) for i, f in fps], key=str)


def test_covering_masks_meet_every_pair():
    rng = random.Random(8)
    masks = simhash.covering_masks(4, list(range(64)))
    for _ in range(3000):
        spots = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not m & spots for m in masks)


def test_simhash_chain_is_one_component(spark):
    """A chain of links, each within the radius, whose ends are far apart."""
    chain = [0]
    for i in range(12):
        chain.append(chain[-1] ^ (0b1111 << 4 * i))
    fps = spark.createDataFrame([(x,) for x in chain] + [(0x0F0F << 48 | 5,)], "fp long")
    for limit in (1, 100):
        roots = simhash.components(simhash.links(fps, bucket_limit=limit)).collect()
        assert {r.root for r in roots} == {0}
        assert len(roots) == 12


def test_simhash_keep_first(docs_of, rows):
    docs = docs_of(rows)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 0 in ids and 100 not in ids and ids.count(3) == 4
    assert simhash.keep_first(docs_of([])).count() == 0
