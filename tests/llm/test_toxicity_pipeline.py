"""Toxicity on held-out labels, and the stages of the pipeline one after another."""

import random
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortgraph.llm import common, toxicity
from test_dedup import brute_lines
from test_near_copies import brute_near
from test_text import brute_scan, library

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    got = toxicity.op6(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(r.predicted == r.toxic for r in got) >= 0.95 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert docs.count() == toxicity.op6(spark, SF).count()


def test_held_out_labels_are_not_learned_from(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("this that other thing goes here".split()) for _ in range(30)) + (" you idiot moron" if i % 4 == 0 else "")) for i in range(400)]
    docs = docs_of(rows)
    right = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    held = zlib.crc32
    wrong = spark.createDataFrame([(i, int((i % 4 == 0) != (held(str(i).encode()) % 5 == 0))) for i, _ in rows], "doc_id long, toxic int")
    scores = [sorted(map(tuple, toxicity.fit(docs, x).score(docs.select("doc_id", "text")).select("doc_id", "score").collect())) for x in (right, wrong)]
    assert scores[0] == scores[1]
    assert all((s >= 0.5) == (i % 4 == 0) for i, s in scores[0])


def test_odd_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (None, "You stupid idiot!"), (2, ""), (4, "x" * 300_000)])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (9, None, 0)], "doc_id long, toxic int, text int")
    model = toxicity.fit(docs, labels)
    assert model.trees is None
    got = model.score(docs, name="p").collect()
    assert len(got) == 5 and {r.p for r in got} == {1.0}
    assert toxicity.fit(docs_of([]), labels).score(docs_of([])).count() == 0
    assert len(toxicity.features(b"", {}, {})) == len(toxicity.features("Ähm YOU st*pid idiot!".encode(), {}, {b"stup": 1.0})) == len(toxicity.FEATURES)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    for name in ("documents", "labels", "benchmark"):
        pq.write_table(pq.read_table(f"{SF}/{name}.parquet").slice(0, 400), f"{folder}/{name}.parquet")
    return folder


def test_pipeline(spark, small):
    docs = first = common.table(spark, small, "documents")
    ids = [{r.doc_id for r in docs.select("doc_id").collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, small), "pipeline-test")
        if name != "bpe":
            assert docs.schema.simpleString() == first.schema.simpleString()
            assert docs.filter(F.col("n_chars") != F.char_length("text")).count() == 0
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert ids[2] == ids[1] and ids[5] == ids[4]  # line dedup and encoding keep every document
    assert len(ids[0]) > len(ids[1]) > len(ids[3]) > len(ids[4]) > 0
    toxic = {r.doc_id for r in common.table(spark, small, "labels").filter("toxic = 1").collect()}
    assert len(toxic & ids[1]) <= 0.1 * len(toxic)
    assert corpus_pipeline.run(spark, small).count() == len(ids[5])


def planted():
    """Documents by kind: clean, toxic, copies, near copies, repeated lines short and long, benchmark passages; and the items."""
    rng = random.Random(31)
    vocabulary = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, toxic = [], set()
    for i in range(400):
        if i % 4:
            rows.append((i, "\n".join(prose(rng.randint(20, 40)) for _ in range(rng.randint(1, 3)))))
        else:
            rows.append((i, prose(15) + " you idiot moron " + prose(15) + " you stupid idiot"))
            toxic.add(i)
    clean = [t for i, t in rows if i % 4]
    rows += [(1000 + k, clean[k]) for k in range(10)]
    for k in range(10, 40):  # near copies at similarities on both sides of 0.8
        words = prose(120).split()
        rows.append((1000 + 10 * k, " ".join(words)))
        for copy in range(1, 5):
            new = list(words)
            for at in range(copy * 20, copy * 20 + copy * (k % 4)):
                new[at] = "another" + prose(1)
            rows.append((1000 + 10 * k + copy, " ".join(new)))
    rows += [(3000 + k, prose(30) + "\nAll rights reserved.\n\n" + clean[100] + "x" * (k % 2)) for k in range(12)]
    items = [(f"item-{k}", prose(20)) for k in range(8)] + [("short", "zyx wvu"), ("none", None)]
    rows += [(4000 + k, prose(25) + " " + items[k % 8][1].upper() + " " + prose(25 if k < 12 else 2000)) for k in range(16)]
    rows += [(5000, None), (5001, ""), (5002, " \n\n"), (5003, "Zyx, wvu!"), (5004, prose(6000))]
    return rows, toxic, items


def test_stages_equal_brute_force(spark, tmp_path):
    rows, toxic, items = planted()
    ids, texts = zip(*rows, strict=True)
    pq.write_table(pa.table({"doc_id": ids, "text": texts, "lang": ["en"] * len(ids), "source": ["s"] * len(ids), "n_chars": [len(t or "") for t in texts]}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": ids, "quality": [1] * len(ids), "toxic": [int(i in toxic) for i in ids]}), tmp_path / "labels.parquet")
    pq.write_table(pa.table({"item_id": [i for i, _ in items], "text": [t for _, t in items]}), tmp_path / "benchmark.parquet")

    want = [(i, t) for i, t in rows if i not in toxic]
    stages = [want, brute_lines(want)[0]]
    kept, linked = brute_near(stages[-1])
    assert 20 < linked and len(kept) < len(stages[-1]) - 20
    stages.append(kept)
    bad = {i for i, _, _, _, _, out in brute_scan(kept, items) if out}
    assert {4000, 4011, 5003} <= bad and not bad & {4012, 4015}
    stages.append([(i, t) for i, t in kept if i not in bad])

    docs = common.table(spark, str(tmp_path), "documents")
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:4], stages, strict=True):
        docs = common.stored(stage(spark, docs, str(tmp_path)), "pipeline-test")
        assert sorted(map(tuple, docs.select("doc_id", "text").collect())) == sorted(expected, key=lambda r: r[0]), name
    encoder = library()
    ids_of = {i: encoder.encode(t or "", add_special_tokens=False).ids for i, t in stages[-1]}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: list(r.ids) for r in got} == ids_of and len(got) == len(ids_of)


def test_pipeline_of_empty_tables(spark, tmp_path):
    kinds = {"documents": "doc_id long, text string, lang string, source string, n_chars int", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id string, text string"}
    for name, schema in kinds.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
