"""Keyed tables, entities, edges and quality rules on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortgraph.bindings import star
from cohortgraph.functions import cleaning as C
from cohortgraph.operators import edges, entities, keyed, parse, quality, states


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x", 1), ("a", 2, None, 1), ("b", 3, "z", 2), ("a", 4, "q", 2), ("a", 5, "r", 2)], "k string, o int, v string, b int")
    assert rows(keyed.dedup_first(df.select("k", "o", "v"), "k", "o"), "k") == [("a", 1, "x"), ("b", 3, "z")]
    assert rows(keyed.last_by(df.filter("o < 3"), ["k"], "o", ["v"]), "k") == [("a", None)]
    assert rows(keyed.dedup_batched(df, "k", "o", "b").select("k", "v"), "k") == [("a", "q"), ("b", "z")]


def test_upsert_overwrites_with_null(spark):
    target = spark.createDataFrame([("a", "old", 1), ("b", "keep", 2)], "k string, v string, n int")
    updates = spark.createDataFrame([("a", "mid", 5, 1), ("a", None, 6, 2), ("c", "new", 7, 1)], "k string, v string, n int, o int")
    assert rows(keyed.upsert(target, updates, ["k"], "o"), "k") == [("a", None, 6), ("b", "keep", 2), ("c", "new", 7)]
    again = keyed.upsert(keyed.upsert(target, updates, ["k"], "o"), updates, ["k"], "o")
    assert rows(again, "k") == rows(keyed.upsert(target, updates, ["k"], "o"), "k")


def test_edge_upsert_needs_both_ends(spark):
    target = spark.createDataFrame([("l1", "c1", "x")], "src string, dst string, v string")
    updates = spark.createDataFrame([("l1", "c1", "y", 1), ("l9", "c1", "z", 1), ("l1", "c9", "z", 1), ("l2", "c1", "w", 1)], "src string, dst string, v string, o int")
    people, firms = spark.createDataFrame([("l1",), ("l2",)], "id string"), spark.createDataFrame([("c1",)], "id string")
    out = keyed.upsert_edges(target, updates, (("src", people, "id"), ("dst", firms, "id")), "o")
    assert rows(out, "src") == [("l1", "c1", "y"), ("l2", "c1", "w")]


@pytest.mark.parametrize(
    "g, a, d, expected",
    [(True, True, True, "Graduate"), (False, True, True, "Dropped Out"), (False, True, False, "Active"), (None, None, None, "Inactive")],
)
def test_learning_state_priority(spark, g, a, d, expected):
    df = spark.createDataFrame([(g, a, d)], "g boolean, a boolean, d boolean")
    assert df.select(states.learning_state(F.col("g"), F.col("a"), F.col("d"))).first()[0] == expected


@pytest.mark.parametrize(
    "jobs, placed, venture, wage, expected",
    [
        (2, False, False, False, "Multiple"), (1, True, False, False, "Entrepreneur"), (1, False, True, False, "Wage Employed"),
        (0, False, True, True, "Entrepreneur"), (None, False, False, True, "Wage Employed"), (0, True, False, False, "Unemployed"),
    ],
)
def test_professional_status(spark, jobs, placed, venture, wage, expected):
    df = spark.createDataFrame([(jobs, placed, venture, wage)], "j int, p boolean, v boolean, w boolean")
    assert df.select(states.professional_status(*map(F.col, "jpvw"))).first()[0] == expected


def test_enrolment_flags_and_negative_duration(spark):
    df = spark.createDataFrame([("Graduated", dt.date(2024, 9, 1), dt.date(2024, 7, 1))], "enrollment_status string, start_date date, end_date date")
    row = edges.with_enrollment_flags(df).first()
    assert (row.is_completed, row.is_dropped, row.duration) == (True, False, -62)


def test_job_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 10)), (dt.date(2024, 1, 1), dt.date(2024, 4, 1)), (dt.date(2024, 1, 1), None)], "start_date date, end_date date")
    assert [(r.is_current, r.duration) for r in edges.with_employment_derived(df).orderBy(F.col("end_date").asc_nulls_last()).collect()] == [
        (False, 1), (False, 3), (True, None)
    ]


def test_state_nodes_skip_unknown_start(spark):
    df = spark.createDataFrame(
        [("b", "Active", dt.date(2000, 1, 1), 1, 0, "second"), ("a", "Active", dt.date(2000, 1, 1), 1, 0, "first"), ("a", "Active", None, 0, 0, "none")],
        "learner string, state string, start_date date, entry_ord int, step int, reason string",
    ).withColumns({"end_date": F.lit(None).cast("date"), "is_current": F.lit(True)})
    assert [(r.state, r.reason) for r in entities.state_nodes(df, "state", "reason").collect()] == [("Active", "first")]


def test_quality_rules(spark):
    df = spark.createDataFrame(
        [("C1", 120.0, dt.date(2024, 1, 1), dt.date(2023, 1, 1)), ("", 50.0, None, None), ("C2", None, dt.date(2024, 1, 1), dt.date(2024, 2, 1))],
        "program_id string, completion_rate double, start_date date, end_date date",
    )
    zero = F.lit(None).cast("double")
    df = df.withColumns({c: zero for c in ("assignment_completion_rate", "milestone_completion_rate", "test_completion_rate", "lms_overall_score")})
    out = quality.check_enrollments(df.withColumn("graduation_date", F.lit(None).cast("date")))
    assert sorted(e for r in out.collect() for e in r.errors) == [
        "cohort_code is required", "completion_rate must be between 0 and 100, got 120.0", "end_date (2023-01-01) before start_date (2024-01-01)"
    ]
    good, bad = quality.split_valid(out)
    assert (good.count(), bad.count()) == (1, 2)
    m = quality.quality_gate(quality.quality_metrics(out)).first()
    assert (m.total_records, m.valid_records, m.invalid_records, m.error_rate, m.success_rate, m.passed) == (3, 1, 2, 0.6667, 0.3333, False)


def test_quality_of_nothing_and_limit(spark):
    empty = spark.createDataFrame([], "errors array<string>")
    m = quality.quality_gate(quality.quality_metrics(empty)).first()
    assert (m.total_records, m.error_rate, m.passed) == (0, 0.0, True)
    some = spark.createDataFrame([(["x"],)] + [([],)] * 19, "errors array<string>")
    assert quality.quality_gate(quality.quality_metrics(some), 0.05).first().passed
    assert not quality.quality_gate(quality.quality_metrics(some), 0.049).first().passed


def test_learner_checks_and_fields(spark):
    df = spark.createDataFrame([("h", None, "EGY", "EG"), ("h", "n", "EG", None)], "hashed_email string, full_name string, country_of_residence_code string, country_of_origin_code string")
    out = quality.check_learners(df)
    assert {(r.field, r.n) for r in quality.errors_by_field(out).collect()} == {("Missing required field", 1), ("Invalid country_of_residence_code", 1)}


def test_employment_consistency(spark):
    people = spark.createDataFrame([("a", "Unemployed"), ("b", "Freelancer"), ("c", "Multiple"), ("d", "Wage Employed")], "learner string, status string")
    jobs = spark.createDataFrame(
        [("a", "1", "2020-01-01"), ("b", "0", "2020-01-01"), ("d", "1", "2020-01-01"), ("d", "1", "2020-01-01")], "learner string, is_current string, start_date string"
    )
    assert rows(quality.employment_consistency(people, jobs).select("learner", "rule", "start_date"), "learner") == [
        ("a", "unemployed_with_current_jobs", None), ("b", "employed_with_past_jobs_only", None),
        ("c", "employed_without_jobs", None), ("d", "info_current_jobs_same_start", "2020-01-01"),
    ]


def test_split_is_written_in_one_pass(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else "x", "" if i % 7 == 0 else "y") for i in range(100)]
    df = quality.with_errors(spark.createDataFrame(rows, "id int, hashed_email string, full_name string"), *quality.required())
    path = str(tmp_path / "split")
    report = quality.write_split(df, path).first()
    bad = {i for i, a, b in rows if a is None or b == ""}
    assert (report.total, report.good, report.bad) == (100, 100 - len(bad), len(bad))
    good, quarantine = quality.read_split(spark, path, df.schema)
    assert {r.id for r in good.collect()} == {r[0] for r in rows} - bad and good.columns == ["id", "hashed_email", "full_name"]
    assert {r.id: len(r.errors) for r in quarantine.collect()} == {i: (a is None) + (b == "") for i, a, b in rows if i in bad}
    assert "PartitionFilters: [isnotnull(kind" in good._jdf.queryExecution().toString()
    empty = quality.write_split(df.limit(0), path).first()
    assert (empty.total, empty.good, empty.bad) == (0, 0, 0)
    assert all(t.count() == 0 for t in quality.read_split(spark, path, df.schema))


def test_load_cleans_equal_cells_and_last_rows_once(spark):
    """Tables made from first cells, last rows and ids of names equal those made of every row; wide columns in steps equal those made at once."""
    sf, k = "/root/testdata/sf0.001", F.col("row_ord")
    raw = star.raw_rows(spark, sf).withColumns({
        "skills_list": F.when(k % 7 == 0, " Python ,PYTHON, null,N/A,c++, --- ,,project   management").when(k % 7 == 1, F.lit(None)).otherwise(F.col("skills_list")),
        "hashed_email": F.when(k % 13 == 0, F.lit(None)).when(k % 13 == 1, F.concat(F.lit(" "), "hashed_email")).otherwise(F.col("hashed_email")),
        "city_of_residence": F.when(k % 9 == 0, F.lit(" new town ")).otherwise(F.col("city_of_residence")),
        "city_of_residence_latitude": (k % 17).cast("string"),
    })
    dim = entities.country_dim(star.country_mapping(spark, sf))

    def same(a, b):
        assert a.columns == b.columns and sorted(a.collect(), key=str) == sorted(b.collect(), key=str) != []

    every = parse.learner_skills(raw)
    same(parse.stored_skill_edges(raw), edges.has_skill(every))
    same(entities.skills(parse.learner_skills(parse.skill_cells(raw))), entities.skills(every))
    entries = parse.enrollments_raw(raw)
    same(edges.typed_enrollments(entries, whole=True), edges.typed_enrollments(entries))
    typed = edges.typed_enrollments(entries)
    same(edges.enrolled_in(typed, whole=True), edges.enrolled_in(typed))
    rows = entities.learner_rows(raw, dim).filter("hashed_email is not null")
    got = entities.learners(raw, dim)
    same(got, keyed.last_by(rows, ["hashed_email"], "row_ord", list(entities.LEARNER_COLUMNS)).select(*got.columns))
    cities = entities.cities(raw, dim)
    first = {}
    for r in sorted(entities.with_country_code(raw, dim, "country_of_residence", "cc").select("row_ord", C.city_id(F.col("city_of_residence"), F.col("cc")).alias("id"), "city_of_residence_latitude").collect()):
        first.setdefault(r.id, r)
    assert {r.id: r.latitude for r in cities.collect()} == {i: float(r.city_of_residence_latitude) for i, r in first.items() if i}
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert next(i for i, x in enumerate(plan) if "Join" in x) < next(i for i, x in enumerate(plan) if "max_by" in x)  # cleaned after the last rows are found
