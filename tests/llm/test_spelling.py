"""Spelling variants against a brute-force version, with every level of chunks forced."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from cohortgraph.llm import spelling

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def count(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(words):
    links = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if near(a, b):
            links[a].append(b)
            links[b].append(a)
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(links[w]), words[form[w]] if form[w] else None))
    return out


def result(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def word_table(seed, letters="abé", sizes=(5, 6, 7, 8, 11)):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(sizes))): rng.choice([3, 4, 6, 9, 20, 60]) for _ in range(250)}
    return words | {"x" * 90: 5, "x" * 91: 10, "x" * 49 + "y" + "x" * 40: 3}


@pytest.mark.parametrize("limit", [2, 100_000])
def test_group_equals_brute_force(spark, limit):
    words = word_table(limit)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert result(spelling.group(df, limit=limit)) == brute(words)


def test_one_key_holds_most_words(spark):
    words = {f"{'prefix' * 3}{a}{b}": 3 + (ord(a) * ord(b)) % 40 for a in "abcdefghijklmn" for b in "abcdefghijklmn"}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert result(spelling.group(df, limit=16)) == brute(words)


def test_chains_of_forms(spark):
    words = {"abcdefgh": 4, "abcdefg": 8, "abcdef": 16, "abcde": 32, "abcdz": 64, "abcyz": 128, "abxyz": 256}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = result(spelling.group(df))
    assert got == brute(words) and ("abcdefgh", "abcdefg", "abxyz", 4, 1, 8) in got


def test_runs_of_documents(spark, docs_of):
    rng = random.Random(6)
    stems = ["".join(rng.choice("abcdé") for _ in range(rng.randint(4, 8))) for _ in range(40)]
    rows = [(k, " ".join(rng.choice([str.upper, str.lower, str.title])(rng.choice(stems)) + rng.choice(["", ",", "1", "ß", "\n"]) for _ in range(150))) for k in range(60)]
    rows += [(7, rows[7][1])] * 2 + [(None, rows[8][1]), (90, None), (91, ""), (92, "12 345"), (93, "Long" * 3000)]
    got = result(spelling.group(spelling.vocabulary(spelling.runs(docs_of(rows)))))
    assert got == brute(count(rows)) and len(got) > 30


def test_empty_tables(spark, docs_of):
    assert spelling.group(spelling.vocabulary(spelling.runs(docs_of([(1, None)])))).count() == 0
    assert spelling.group(spelling.vocabulary(spelling.runs(docs_of([(1, None)]).limit(0)))).count() == 0
