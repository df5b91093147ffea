"""Sources, sinks, stored graphs and the incremental change log."""

import csv
import gzip
import json
import random
from dataclasses import replace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortgraph.bindings import star
from cohortgraph.functions import cleaning as C
from cohortgraph.operators import entities, load
from cohortgraph.operators.model import Graph
from cohortgraph.plans import graph as G
from cohortgraph.plans import registry_tables
from cohortgraph.session import bucketed_table, work_table
from cohortgraph.sources import readers, writers
from cohortgraph.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_csv_edge_cases(spark, tmp_path):
    text = "﻿hashed_email,bio,score\n" "h1,\"line one\nsaid \"\"hi\"\"\",5,extra\n" "h2,nul\u0000byte,-99\n" "h3,short\n"
    (tmp_path / "a.csv").write_bytes(text.encode() + b"h4,bad\xff byte,\n")
    df = readers.read_learners_csv(spark, str(tmp_path), null_tokens=readers.DEFAULT_NULL_TOKENS, multi_line=True)
    assert df.columns == ["hashed_email", "bio", "score"]
    assert {tuple(r) for r in df.collect()} == {
        ("h1", 'line one\nsaid "hi"', "5"), ("h2", "nulbyte", None), ("h3", "short", None), ("h4", "bad byte", None)
    }


def test_csv_records_split_at_any_byte(spark, tmp_path):
    """Two files cut into small byte ranges, fields with quoted breaks over several of them: as the csv module reads them."""
    rng = random.Random(4)
    pieces = ["a", "é", ",", '"', "\n", "\r\n", " ", "long text " * 5]
    want, fields = [], ["id", "text", "more"]
    for f in range(2):
        rows = [[f"{f}-{i}", "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 3, 60]))), "x\n" * rng.choice([0, 0, 0, 40])] for i in range(120)]
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf-8-sig") as out:
            csv.writer(out, lineterminator=("\n", "\r\n")[f]).writerows([fields, *rows])
            out.write('\n"last","never ends\n')
        want += [tuple(c or None for c in r) for r in rows]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("500", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            records = readers.csv_records(spark, str(tmp_path))
            assert records.select("file", "record").distinct().count() == records.count() == 2 * 122
            df = readers.read_learners_csv(spark, str(tmp_path), multi_line=True, null_tokens=("",))
            assert df.columns == fields
            got = [tuple(r) for r in df.filter("id <> 'last'").collect()]
            assert sorted(got, key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_export_round_trip(spark, tmp_path):
    rows = [("a", 'x "y"\n,z', None), ("b", "", "1"), ("c", None, None), ("d", "\r\n", "2")]
    df = spark.createDataFrame(rows, "id string, t string, n string").repartition(2)
    writers.export_csv(df, str(tmp_path / "out"), bom=True)
    back = readers.read_learners_csv(spark, str(tmp_path / "out"), multi_line=True)
    assert sorted((r.id, r.t or "", r.n or "") for r in back.collect()) == [(a, b or "", c or "") for a, b, c in rows]
    writers.export_csv(df.limit(0), str(tmp_path / "none"))
    assert readers.read_learners_csv(spark, str(tmp_path / "none"), multi_line=True).count() == 0


def test_csv_moves_only_pieces_between_ranges(spark, tmp_path):
    """Records with quoted breaks that lie in one byte range are put together there; the export needs no Python."""
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("one\ntwo "), "id").alias("t"))
    writers.export_csv(df, str(tmp_path / "out"))
    records = readers.csv_records(spark, str(tmp_path / "out"))
    shuffled = [m for m in records._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in m]
    assert len(shuffled) <= 2  # partial lists and their groups, of pieces only
    assert records.filter("record > 1").count() == 2000
    _, assembler = readers._scans()
    text = pa.array([b'"h"', b'"1","one', b'two"', b'"2","x', b'y"', b'"3","open'])
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * 6), pa.array([0] * 6), text], names=["file", "block", "text"])
    got = {w: [r for b in assembler({("f", 0): (False, 0)}, w)([batch.slice(0, 4), batch.slice(4, 2)]) for r in zip(*(c.to_pylist() for c in b.columns[2:]))] for w in (True, False)}
    assert got == {True: [(1, b'"h"'), (2, b'"1","one\ntwo"'), (3, b'"2","x\ny"')], False: [(4, b'"3","open')]}


def test_factory(spark):
    with pytest.raises(ValueError, match="unknown source"):
        readers.read_learners(spark, "oracle", {})
    with pytest.raises(ValueError, match="needs path"):
        readers.read_learners(spark, "csv", {})
    options = readers.jdbc_options("jdbc:mysql://h/db", "learners", "id", (0, 100), 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id" and options["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", "id")


def test_country_mapping_file(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"comment": "x", "mappings": {"Egypt": "EG", "Ghana": "gh"}, "aliases": {"EGYPT": "XX", "Misr": "EG"}}, indent=1))
    dim = entities.country_dim(*readers.country_mapping(spark, str(path)))
    assert {tuple(r) for r in dim.collect()} == {("egypt", "XX"), ("ghana", "GH"), ("misr", "EG")}


def test_row_range_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(5).write.parquet(path)
    whole = [r.id for r in readers.row_range(spark, path).orderBy("row_ordinal").collect()]
    assert sorted(whole) == list(range(100))
    part = readers.row_range(spark, path, 30, 25).orderBy("row_ordinal").collect()
    assert [r.id for r in part] == whole[30:55] and part[0].row_ordinal == 30
    whole_table = set(spark.read.parquet(path).inputFiles())
    assert len(part) == 25 and len(set(readers.row_range(spark, path, 30, 25).inputFiles())) < len(whole_table) == 5
    index = spark.createDataFrame(readers.file_index(spark, path).collect())
    again = readers.row_range(spark, path, 30, 25, index=index).orderBy("row_ordinal").collect()
    assert again == part
    assert readers.row_range(spark, path, 100).count() == 0 and readers.row_range(spark, path, 95, 50).count() == 5
    assert readers.with_row_ord(spark.read.parquet(path)).select("row_ord").distinct().count() == 100


def test_load_and_read_back(spark, tmp_path):
    path = str(tmp_path / "graph")
    raw = star.raw_rows(spark, SF)
    dim = entities.country_dim(star.country_mapping(spark, SF))
    load.load_graph(raw, dim, path, star.AS_OF)
    g = writers.read_graph(spark, path)
    for name, keys in (("learner", ["hashed_email"]), ("enrolled_in", ["learner", "program_id"]), ("works_for", ["learner", "company_id"]),
                       ("has_skill", ["learner", "skill_id"]), ("has_learning_state", ["learner", "state", "valid_from"]), ("skill", ["id"])):
        df = g.members()[name]
        assert df.count() == df.select(*keys).distinct().count() > 0
    assert g.enrolled_in.join(g.program, F.col("program_id") == F.col("id"), "left_anti").count() == 0
    assert g.works_for.join(g.company, F.col("company_id") == F.col("id"), "left_anti").count() == 0
    assert g.has_learning_state.filter("is_current").count() == raw.select("hashed_email").distinct().count()
    assert G.g06_completion(g, min_n=0).count() == 5
    with pytest.raises(ValueError):
        writers.clear(spark, path)
    assert writers.clear(spark, path, confirm=True) and not (tmp_path / "graph").exists()


def test_load_shuffles_the_entries_once(spark):
    raw = star.raw_rows(spark, SF)
    key = F.col("row_ord")
    raw = raw.withColumns({  # learners without any entry, rows without text
        "learning_details": F.when(F.col("sand_id") != "n/a", "[]").otherwise(F.col("learning_details")),
        "employment_details": F.when(F.col("gender") == "Other", "").when(key % 13 != 0, F.col("employment_details"))})
    dim = entities.country_dim(star.country_mapping(spark, SF))
    stored = [bucketed_table(df, "entries", "learner") for df in (load.enrolment_entries(raw, C.YEARS), load.job_entries(raw, C.YEARS, False))]
    plain = load.build_graph(raw, dim, star.AS_OF).members()
    for name, df in load.build_graph(raw, dim, star.AS_OF, entries=tuple(stored), store=True).members().items():
        if name in ("enrolled_in", "works_for", "has_learning_state", "has_professional_status"):
            assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.exceptAll(plain[name]).count() == plain[name].exceptAll(df).count() == 0


def test_stopped_load_shows_the_version_before(spark, tmp_path):
    path = str(tmp_path / "graph")
    g = star.graph(spark, SF)
    small = Graph(**{n: spark.createDataFrame(df.limit(5).collect(), df.schema) for n, df in g.members().items()})
    with pytest.raises(ValueError, match="no committed graph"):
        writers.read_graph(spark, path)
    assert writers.write_graph(small, path)["version"] == 1
    broken = replace(small, works_for=small.works_for.withColumn("learner", F.raise_error(F.lit("stopped here")).cast("string")), skill=small.skill.limit(1))
    with pytest.raises(Exception, match="stopped here"):
        writers.write_graph(broken, path)
    seen = writers.read_graph(spark, path)
    assert writers.graph_versions(spark, path) == [1] and seen.skill.count() == 5 and seen.works_for.count() == 5
    less = replace(small, skill=small.skill.limit(2))
    under_way = writers.read_graph(spark, path)
    assert writers.write_graph(less, path)["rows"]["skill"] == 2
    assert under_way.skill.count() == 5 and writers.read_graph(spark, path, 1).skill.count() == 5  # the version before is kept
    assert writers.read_graph(spark, path).skill.count() == 2
    writers.write_graph(small, path)
    assert writers.graph_versions(spark, path) == [2, 3]
    with pytest.raises(RuntimeError, match="another load"):
        writers._publish(spark, path, 3, {})
    with pytest.raises(ValueError, match="holds a graph"):
        writers.write_graph(small, path, mode="error")


def test_node_table_names(spark):
    df = spark.createDataFrame([("h", "EG")], "hashed_email string, country_of_residence_code string")
    assert writers.to_node_table(df, "Learner").columns == ["hashedEmail", "countryOfResidenceCode"]


def test_export_statistics(spark, tmp_path):
    stats = writers.export_parquet(spark.range(1000).withColumn("x", F.lit(1)), str(tmp_path / "e")).first()
    assert (stats.rows, stats.columns) == (1000, 2) and stats.bytes > 0


def test_bucketed_join_has_no_shuffle(spark):
    g = star.graph(spark, SF)
    writers.save_bucketed(g, "bk_", 4)
    b = writers.load_bucketed(spark, "bk_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = b.enrolled_in.join(b.works_for.select("learner", "company_id"), "learner")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    assert b.enrolled_in.count() == g.enrolled_in.count()


SCHEMA = "k string, v int, o int"


def _drop(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def _ingest(spark, folder, target):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = incremental.stream_files(spark, f"{folder}/*", schema)
    return incremental.ingest(stream, target, ["k"], ["o"])


def _state(spark, target):
    return sorted(tuple(r) for r in incremental.current(spark, target, ["k"], ["o"]).select("k", "v").collect())


def test_two_batches_equal_one_and_replay_changes_nothing(spark, tmp_path):
    first, second = [("a", 1, 1), ("b", 1, 1), ("a", 2, 2)], [("a", 9, 1), ("c", 3, 1)]
    inbox, target = str(tmp_path / "in"), str(tmp_path / "out")
    _drop(spark, inbox, "f1", first)
    report = _ingest(spark, inbox, target)
    assert report["rows"] == 3 and _state(spark, target) == [("a", 2), ("b", 1)]
    _drop(spark, inbox, "f2", second)
    _ingest(spark, inbox, target)
    after = _state(spark, target)
    assert after == [("a", 2), ("b", 1), ("c", 3)]  # the late row is older
    assert _ingest(spark, inbox, target)["rows"] == 0 and _state(spark, target) == after
    assert {r.batch_id: r.rows for r in incremental.status(spark, target).collect()} == {0: 2, 1: 2}
    incremental.compact(spark, target, ["k"], ["o"])
    spark.catalog.clearCache()
    assert _state(spark, target) == after
    _drop(spark, inbox, "f3", [("b", 7, 1)])
    _ingest(spark, inbox, target)
    incremental.compact(spark, target, ["k"], ["o"])
    assert _state(spark, target) == [("a", 2), ("b", 7), ("c", 3)]


def test_compaction_beside_readers_and_an_ingest(spark, tmp_path, monkeypatch):
    inbox, target = str(tmp_path / "in"), str(tmp_path / "out")
    rng, rows = random.Random(3), []

    def deliver(name):
        new = [(rng.choice("abcdefghij") + str(rng.randrange(9)), rng.randrange(100), rng.randrange(12)) for _ in range(40)]
        rows.extend((*r, len(rows) + i) for i, r in enumerate(new))
        _drop(spark, inbox, name, new)
        _ingest(spark, inbox, target)

    def want():  # a batch keeps the last row by order; which of equals does not matter to the key's order value
        last = {}
        for k, _, o, _ in rows:
            last[k] = max(last.get(k, o), o)
        return last

    def seen(df):
        out = [(r.k, r.o) for r in df.collect()]
        assert len(out) == len(set(out))
        return dict(out)

    def now():
        return incremental.current(spark, target, ["k"], ["o"])

    deliver("f0")
    deliver("f1")
    assert incremental.compact(spark, target, ["k"], ["o"], buckets=8) == 1 and seen(now()) == want()
    reader, before = now(), want()  # planned on the first snapshot
    deliver("f2")
    (tmp_path / "out" / "log" / "batch_id=3" / "_temporary").mkdir(parents=True)  # a batch that is being written
    assert seen(now()) == want()
    assert incremental.compact(spark, target, ["k"], ["o"]) == 2 and seen(now()) == want()
    assert seen(reader) == before
    assert incremental.compact(spark, target, ["k"], ["o"]) == 2  # nothing to fold
    deliver("f3")
    monkeypatch.setattr(incremental, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        incremental.compact(spark, target, ["k"], ["o"])
    assert seen(now()) == want()
    monkeypatch.undo()
    _drop(spark, inbox, "f4", [("a0", 1, 50)])
    _ingest(spark, inbox, target)
    rows.append(("a0", 1, 50, 0))
    before = incremental.graph_manifest(spark, target)["base"]
    assert incremental.compact(spark, target, ["k"], ["o"]) == 3 and seen(now()) == want()
    deliver("f5")
    _drop(spark, inbox, "f6", [("a0", 2, 60)])
    _ingest(spark, inbox, target)
    rows.append(("a0", 2, 60, 0))
    assert seen(now()) == want() and len(before) <= 8


def test_strict_country_mode_raises_for_an_unmapped_name(spark):
    rows = spark.createDataFrame([("Egypt",), ("Nowhere",)], "country_of_residence string")
    dim = entities.country_dim(spark.createDataFrame([("Egypt", "EG")], "name string, code string"))
    strict = entities.with_country_code(rows, dim, mode="strict")
    assert [r.country_code for r in strict.filter("country_of_residence = 'Egypt'").collect()] == ["EG"]
    with pytest.raises(Exception, match="country not in mapping: Nowhere"):
        strict.collect()
    auto = entities.with_country_code(rows, dim, mode="auto").collect()
    assert {r.country_code for r in auto} == {"EG", "auto:NOWHERE"}


def test_compressed_csv_with_line_breaks_is_read_back(spark, tmp_path):
    """Bounded gzip files, each with its header; the factory's query writes such files."""
    rows = [(str(i), f'line {i}\nsays "{i}", end') for i in range(25)]
    spark.createDataFrame(rows, "a string, b string").coalesce(1).write.option("header", "true").option("escape", '"').option(
        "compression", "gzip").option("maxRecordsPerFile", 10).csv(str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("*.csv.gz"))) == 3
    back = readers.read_learners(spark, "csv", {"path": str(tmp_path / "csv"), "multi_line": True})
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_factory_writes_compressed_csv(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry_tables, "_folder", lambda spark: str(tmp_path / "f"))
    registry_tables._factory(spark, "/root/testdata/sf0.001").collect()
    files = [p.name for p in (tmp_path / "f" / "csv").iterdir() if p.name.startswith("part-")]
    assert files and all(n.endswith(".csv.gz") for n in files)


def test_learners_are_counted_by_keys(spark):
    raw = star.raw_rows(spark, SF)
    dim = entities.country_dim(star.country_mapping(spark, SF))
    keys = entities.learner_keys(raw)
    assert keys.count() == entities.learners(raw, dim).count() > 0
    assert "from_json" not in keys._jdf.queryExecution().optimizedPlan().toString()


def test_csv_query_shuffles_digests_and_counts_cells_that_differ(spark, tmp_path, monkeypatch):
    """The files are compressed and bounded, rows meet without their wide cells, and what a writer spoils is counted cell by cell."""
    export, tables, counter = writers.export_csv, [], iter(range(9))
    query = lambda: registry_tables.QUERIES["src_csv"](spark, SF)
    monkeypatch.setattr(registry_tables, "_folder", lambda s: str(tmp_path / str(next(counter))))
    monkeypatch.setattr(registry_tables, "CSV_RECORDS", 100)
    monkeypatch.setattr(registry_tables, "work_table", lambda df, name: tables.append(df) or work_table(df, name))
    want = sorted(query().collect())
    files = [p for p in (tmp_path / "0").iterdir() if p.name.startswith("part-")]
    assert len(files) >= 15 and all(p.name.endswith(".gz") for p in files)
    assert len(want) == 1500 and {r.differing_cells for r in want} == {0}
    plan = tables[0]._jdf.queryExecution().optimizedPlan()
    joins = [x for x in plan.toString().splitlines() if x.lstrip(" :+-").startswith("Join")]
    assert joins and "education_details" not in [f for f in tables[0].columns]
    spoilt = F.col("row_ord").cast("long") % 500 == 7
    monkeypatch.setattr(writers, "export_csv", lambda df, *a, **k: export(df.withColumns({
        "bio": F.when(spoilt, F.lit("")).otherwise(F.col("bio")), "type_of_disability": F.when(spoilt, F.lit("x"))}), *a, **k))
    got = sorted(query().collect())
    assert [r.differing_cells for r in got] == [2 if int(r.row_ord) % 500 == 7 else 0 for r in got]
    assert [(*r[:4], *r[5:]) for r in got] == [(*r[:4], *r[5:]) for r in want]


def test_whole_csv_files_are_read_in_one_scan(spark, tmp_path):
    """Quoted breaks, NUL and undecodable bytes, short, long and empty rows in compressed files: as the reader of plain files gives them."""
    text = '\ufeffid,bio,score\nh1,"line one\r\nsaid ""hi""\n",5,extra\nh2,nul\u0000byte,-99\nh3,short\n\n'.encode() + b'h4,bad\xff byte,\nh5,"",""\n'
    (tmp_path / "plain").mkdir()
    (tmp_path / "packed").mkdir()
    for name in "ab":
        (tmp_path / "plain" / f"{name}.csv").write_bytes(text)
        (tmp_path / "packed" / f"{name}.csv.gz").write_bytes(gzip.compress(text))
    plain = readers.read_learners_csv(spark, str(tmp_path / "plain"), null_tokens=readers.DEFAULT_NULL_TOKENS, multi_line=True)
    packed = readers.read_learners_csv(spark, str(tmp_path / "packed"), null_tokens=readers.DEFAULT_NULL_TOKENS, whole_files=True)
    assert "MapInArrow" not in packed._jdf.queryExecution().executedPlan().toString()
    assert packed.columns == plain.columns and sorted(map(tuple, packed.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert packed.count() == 10


def test_whole_raw_rows_are_the_raw_rows(spark):
    rows, whole = star.raw_rows(spark, SF), star.raw_rows(spark, SF, False, True)
    assert whole.schema == rows.schema and whole.exceptAll(rows).isEmpty() and whole.count() == rows.count()
