"""Near copies of the pipeline's stage against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from cohortgraph.llm import near_copies, simhash


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(a, b):
    return a == b or 10 * len(a & b) >= 8 * len(a | b)


def near_rows():
    rng = random.Random(21)
    words = [f"w{i}" for i in range(900)]
    rows = [(None, None), (3, ""), (4, " \n"), (5, "one two"), (6, "ONE  two"), (7, "one three")]
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([20, 60, 300, 1600]))]
        for copy in range(10):  # from close copies to ones below the bound
            new = list(text)
            for _ in range(int(len(text) * copy * 0.005)):
                new[rng.randrange(len(new))] = rng.choice(words)
            rows.append((rng.randrange(10, 10**6), " ".join(new)))
        rows.append((rows[-5][0] + 1, rows[-5][1]))
    rows += [(None, rows[20][1]), (rows[30][0], rows[60][1]), rows[40], rows[40]]
    chain = [rng.choice(words) for _ in range(100)]
    for i in range(8):  # neighbours are near copies, the ends are not
        rows.append((2 * 10**6 + i, " ".join(chain[i * 5 : i * 5 + 60])))
    return rows


def brute_near(rows):
    """The rows that stay, and the number of links between different texts."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = 0
    for a in range(len(rows)):
        for b in range(a):
            if similar(sets[a], sets[b]):
                linked += sets[a] != sets[b]
                root[find(a)] = find(b)
    best = {}
    for k, (i, _) in enumerate(rows):
        best.setdefault(find(k), []).append((i is None, i or 0))
    return [(i, t) for k, (i, t) in enumerate(rows) if (i is None, i or 0) == min(best[find(k)])], linked


@pytest.mark.parametrize("limit", [2, near_copies.BUCKET_LIMIT])
def test_near_copies(docs_of, limit):
    rows = near_rows()
    want, linked = brute_near(rows)
    assert linked > 100
    got = near_copies.keep_first(docs_of(rows), bucket_limit=limit)
    assert got.columns == docs_of(rows).columns
    assert sorted(map(tuple, got.select("doc_id", "text").collect()), key=str) == sorted(want, key=str)


def test_stage_drops_copies_far_apart_in_simhash(spark, docs_of):
    """Pairs at a similarity of 0.8 to 0.85, most of which differ in more than four bits of a fingerprint."""
    rng = random.Random(4)
    rows = []
    for i in range(0, 60, 2):
        words = [f"v{rng.randrange(5000)}" for _ in range(400)]
        new = list(words)
        for k in range(8):
            new[25 + 50 * k] = "changed"
        rows += [(i, " ".join(words)), (i + 1, " ".join(new))]
    assert all(similar(shingles(a), shingles(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True))
    kept = corpus_pipeline.near_duplicates_out(spark, docs_of(rows), "")
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(0, 60, 2))


def test_near_copies_empty_table(docs_of):
    assert near_copies.keep_first(docs_of([])).count() == 0


def test_forest_links_what_a_pivot_misses():
    sets = [np.arange(i * 10, i * 10 + 100, dtype=np.uint64) for i in range(6)]
    order = [0, 3, 5, 1, 4, 2]
    found = list(near_copies.forest([bytes([i]) for i in order], [sets[i] for i in order], 800))
    assert sorted(tuple(sorted((a[0], b[0]))) for a, b in found) == [(i, i + 1) for i in range(5)]


def test_pipeline_stage_runs_fingerprints(spark, docs_of, monkeypatch):
    """Components of op9's fingerprints are buckets of the stage; the exact check parts those whose shingles differ."""
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice("bdfgklmnprst") + "aeiou"[rng.randrange(5)] for _ in range(3)) for _ in range(n))
    refrain = prose(13)  # an odd number, so that the rest decides no bit
    words = prose(2000).split()
    texts = [" ".join([refrain] * 60 + [prose(14)]) for _ in range(2)] + [" ".join(words), " ".join([*words[:-1], "other"]), prose(60), None, ""]
    prints = [simhash.fingerprint((t or "").encode()) for t in texts]
    assert [(prints[i] ^ prints[i + 1]).bit_count() <= simhash.RADIUS for i in range(5)] == [True, False, True, False, False]
    seen, run = [], near_copies._fingerprint_keys

    def keys(own, radius):
        out = run(own, radius)
        named = out.join(own.select("doc_id", "s").distinct(), "s").collect()
        seen.append((radius, {r.doc_id: r.k for r in named}))
        return out

    monkeypatch.setattr(near_copies, "_fingerprint_keys", keys)
    kept = corpus_pipeline.near_duplicates_out(spark, docs_of(list(enumerate(texts))), "").collect()
    (radius, k), = seen
    assert radius == simhash.RADIUS and set(k) == set(range(5))
    assert k[0] == k[1] and k[2] == k[3] and len({k[0], k[2], k[4]}) == 3
    assert sorted(r.doc_id for r in kept) == [0, 1, 2, 4, 5]
