"""Language identification: filters against plain sets, held-out accuracy, defined cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortgraph.llm import language_id

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred string, _lang string, gram string, n string"
ALPHABETS = {"aa": "abcdeo", "bb": "bcdfgu", "cc": "éàdefo", "dd": "жабвгд"}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 7))) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, x, *("clash",) * 5) for i, t, x in rows], SCHEMA).repartition(3)


def corpus(n=240):
    rng = random.Random(9)
    return [(k, text(rng, x := rng.choice(sorted(ALPHABETS))), x) for k in range(n)]


def plain_grams(t, size=4):
    out = []
    for word in "".join(c if c.isalpha() else " " for c in t.lower()).split():
        data = f" {word} ".encode()
        out += [data[i : i + size] for i in range(len(data) - size + 1)]
    return out


def test_grams_are_those_of_the_words():
    texts = ["Ab, cde! É1ça", "", "x", "жя  Абв\n"]
    letters = [(" " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " ").encode() for t in texts]
    row, gram = language_id.grams(pa.array(letters, pa.binary()))
    got = [[int(g).to_bytes(4) for g in gram[row == k]] for k in range(len(texts))]
    assert got == [plain_grams(t) for t in texts]


def test_filters_return_all_languages_that_contain_a_gram():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 32, 500, np.uint64)) for _ in range(130)]
    f = language_id.Filters.of(sets)
    for k in (0, 63, 64, 129):
        masks = f.containing(sets[k])
        assert masks.shape[1] == 3 and (masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).all()
    other = rng.integers(0, 1 << 32, 20_000, np.uint64)
    rate = np.mean(f.containing(other)[:, 0] & np.uint64(1))
    assert abs(rate - f.false_rate[0]) < 0.01


def test_learned_grams_equal_plain_counts(spark):
    rows = corpus()
    model = language_id.fit(table(spark, rows), share=0.2)
    known = [(t, x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = {x: sum(y == x for _, y in known) for x in ALPHABETS}
    assert model.langs == sorted(docs, key=lambda x: (-docs[x], x))
    for k, x in enumerate(model.langs):
        n = {}
        for t, y in known:
            for g in set(plain_grams(t)) if y == x else ():
                n[g] = n.get(g, 0) + 1
        mine = {g for g, c in n.items() if c >= 2 and c >= 0.2 * docs[x]}
        masks = model.filters.containing(np.array([int.from_bytes(g) for g in n], np.uint64))
        found = {g for g, m in zip(n, masks[:, 0] >> np.uint64(k) & np.uint64(1)) if m}
        assert mine <= found and len(found - mine) <= 0.02 * len(n) + 2


def test_held_out_accuracy_and_no_leak(spark):
    rows = corpus()
    got = {r.doc_id: r for r in language_id.fit(table(spark, rows)).predict(table(spark, rows)).collect()}
    assert np.mean([got[i].lang_pred == x for i, _, x in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else x) for i, t, x in rows]  # held-out labels are never read
    again = {r.doc_id: r for r in language_id.fit(table(spark, wrong)).predict(table(spark, wrong)).collect()}
    assert again == got


def test_defined_cases(spark):
    rows = corpus(80)
    odd = [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !?\n", None), (1003, "x", None), (1004, "漢字漢字", None), (None, rows[0][1], rows[0][2]), (1005, rows[1][1] * 500, None)]
    odd += [rows[2]] * 3
    model = language_id.fit(table(spark, rows + odd))
    out = model.predict(table(spark, rows + odd)).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert len(out) == 90
    assert got[1000] == got[1001] == got[1002] == ("und", 0.0)
    assert got[1003] == got[1004] == (model.langs[0], 0.0)
    assert got[None][0] == rows[0][2] and got[1005][0] == rows[1][2]


@pytest.mark.parametrize("rows", [[], [(1, "some text", None)], [(1, None, "aa")]])
def test_nothing_to_learn(spark, rows):
    df = table(spark, rows) if rows else spark.createDataFrame([], SCHEMA)
    out = language_id.fit(df).predict(df)
    assert [(r.lang_pred, r.score) for r in out.collect()] == [("und", 0.0)] * len(rows)


def test_share_rises_until_the_filters_fit(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST", 300)
    model = language_id.fit(table(spark, corpus()))
    assert model.filters.rows.shape[0] <= 16 * 512


def test_registered_query(spark):
    out = language_id.op13(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    right = out.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right[0] > 0.95 and right[1] == docs.count()
