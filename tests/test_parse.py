import json

from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.functions.jsoncols import parse_json_array
from cohortgraph.operators import entities, parse

JOB = {
    "index": "1", "organisation_name": "Acme", "start_date": "2023-01-01", "end_date": "2023-12-31", "country": "EG",
    "job_title": "Analyst", "is_current": "0", "duration_in_years": "1",
}


def raw(spark, **columns):
    n = len(next(iter(columns.values())))
    names = list(columns)
    rows = [(f"h{i}", i, *[columns[c][i] for c in names]) for i in range(n)]
    return spark.createDataFrame(rows, "hashed_email string, row_ord bigint, " + ", ".join(f"{c} string" for c in names))


def test_parse_json_array(spark):
    good = json.dumps([JOB])
    cells = [good, json.dumps(good), "[]", '"[]"', "", None, "not json", '{"index": "1"}', " [ ] ", "n/a"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    out = df.select("i", F.size(parse_json_array(F.col("c"), S.EMPLOYMENT_ARRAY)).alias("n")).orderBy("i").collect()
    assert [r.n if r.n and r.n > 0 else None for r in out] == [1, 1, None, None, None, None, None, None, None, None]


def test_jobs_accept_both_spellings_and_drop_incomplete(spark):
    other = {**JOB, "organization_name": "Bolt"}
    other.pop("organisation_name")
    broken = {k: v for k, v in JOB.items() if k != "job_title"}
    nameless = {k: v for k, v in JOB.items() if k != "organisation_name"}
    df = parse.jobs_raw(raw(spark, employment_details=[json.dumps([JOB, other, broken, nameless])]))
    assert [(r.pos, r.organization_name) for r in df.orderBy("pos").collect()] == [(0, "Acme"), (1, "Bolt")]


def test_placements(spark):
    cells = [
        '[{"job_start_date": "2024-01-01", "organisation_name": "A", "salary_range": "$0-$500"}]',
        '[{"job_start_date": "2024-01-01", "business_name": "B", "jobs_created_to_date": 3}]',
        '[{"organisation_name": "no date"}]', "[]",
    ]
    df = raw(spark, placement_details=cells)
    assert [(r.learner, r.kind, r.jobs_created) for r in parse.placements(df).orderBy("row_ord").collect()] == [
        ("h0", "wage", None), ("h1", "venture", 3)
    ]
    assert {r.kind for r in parse.placements(df, parity=True).collect()} == {"wage"}
    flags = [r.placement_is_venture for r in parse.placement_flags(df).orderBy("row_ord").collect()]
    assert flags == [False, True, False, False]


def test_skills_first_spelling_and_limit(spark):
    many = ",".join(f"Skill {i}" for i in range(60))
    df = parse.learner_skills(raw(spark, skills_list=["Python, python , N/A,none, ,C++,C#,null", many, None]))
    rows = df.orderBy("row_ord", "pos").collect()
    assert [(r.skill_id, r.name) for r in rows if r.learner == "h0"] == [("python", "Python"), ("c", "C++")]
    assert sum(r.learner == "h1" for r in rows) == 60


def test_country_modes(spark):
    dim = entities.country_dim(
        spark.createDataFrame([("Egypt", "EG", 0), ("EGYPT", "XX", 1), ("Ghana", "GH", 2)], "name string, code string, ord bigint"),
        spark.createDataFrame([("ghana", "gx", 0)], "name string, code string, ord bigint"),
    )
    df = raw(spark, country_of_residence=["egypt", " Ghana", "Atlantis", "n/a"])

    def codes(mode, **options):
        return [r.country_code for r in entities.with_country_code(df, dim, mode=mode, **options).orderBy("row_ord").collect()]

    assert codes("null") == ["EG", "GX", None, None]
    assert codes("auto") == ["EG", "GX", "auto:ATLANTIS", None]
    assert codes("auto", parity=True) == ["EG", "GX", "AT", None]
    assert [(r.country, r.n) for r in entities.unmapped_countries(df, dim).collect()] == [("Atlantis", 1)]
    try:
        codes("strict")
        raise AssertionError("strict mode must fail")
    except Exception as exc:  # the job fails on the unmapped name
        assert "Atlantis" in str(exc)


def test_no_skill_is_cut(one):
    cell = ",".join(f"Skill {i}" for i in range(80))
    assert len(one([cell], parse.skill_array)[0]) == 80
    assert len(one([cell], lambda c: parse.skill_array(c, limit=50))[0]) == 50
