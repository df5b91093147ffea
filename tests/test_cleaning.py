import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from cohortgraph.functions import cleaning as C


def test_norm_str(one):
    assert one(["  Test  ", "N/A", "none", "NULL", "", None, "\t a ", "nonesuch"], C.norm_str) == [
        "Test", None, None, None, None, None, "a", "nonesuch"
    ]


def test_skill_id(one):
    values = ["C++", "C#", "Python 3.x", "Data Analysis", " - a--b ", "Émile skill", "a_ b"]
    assert one(values, C.skill_id) == ["c", "c", "python_3x", "data_analysis", "a_b", "émile_skill", "a_b"]


def test_city_id(one):
    assert one(["Cairo", " alexandria", "n/a"], lambda c: C.city_id(c, F.lit("eg"))) == ["EG-CAIRO", "EG-ALEXANDRIA", None]
    cities = ["Alexandria", "Aleppo Town"]
    assert one(cities, lambda c: C.city_id(c, F.lit("eg"), parity=True)) == ["EG-ALE"] * 2
    assert len(set(one(cities, lambda c: C.city_id(c, F.lit("eg"))))) == 2


def test_parse_date(one):
    values = [
        "2024-01-15", "2024-1-5", "1970-01-01", "9999-12-31", "2024-02-30", "invalid-date", "2024", "2024-01",
        "2024-01-15T10:00:00", "2024-01-15 10:00:00+05:00", "2031-01-01", "1969-12-31", "", None, "20240115",
        "2024-01-15Tx", " 2024-01-15", "12024-01-1", "2030-12-31",
    ]
    day = dt.date(2024, 1, 15)
    assert one(values, C.parse_date) == [
        day, dt.date(2024, 1, 5), None, None, None, None, None, None, day, day, None, None, None, None, day, None, None, None,
        dt.date(2030, 12, 31),
    ]
    assert one(["2031-01-01"], lambda c: C.parse_date(c, None)) == [dt.date(2031, 1, 1)]


def test_numbers(one):
    values = ["93.64", "-99", "-99.0", " 7 ", "n/a", "x", "", None, "12.9"]
    assert one(values, C.parse_num) == [93.64, None, None, 7.0, None, None, None, None, 12.9]
    assert one(values, C.parse_int) == [93, None, None, 7, None, None, None, None, 12]
    assert one(["-99", "nan"], lambda c: C.parse_int(c, keep_missing=True)) == [-99, None]


def test_flags(one):
    assert one(["1", "Yes", "no", "0", "maybe", None], C.parse_bool) == [True, True, False, False, None, None]
    assert one(["rural", "URBAN", "1", "n/a"], C.parse_rural) == [True, False, True, None]
    assert one(["0", "1", None, "-99"], C.is_set) == [False, True, False, False]


def test_enumerations(one):
    assert one([" Male", "FEMALE", "Other", "Prefer not to say", "x", None], C.norm_gender) == [
        "male", "female", "other/prefer not to say", "other/prefer not to say", None, None
    ]
    assert one(["phd", "BACHELOR'S DEGREE", "n/a", "Kindergarten"], C.norm_education) == ["PhD", "Bachelor'S Degree", None, None]


def test_hash_id(one):
    assert one(["Acme", " Acme"], C.hash_id) == [hashlib.sha256(v.encode()).hexdigest()[:16] for v in ("Acme", " Acme")]


def test_skill_category(one):
    values = ["Python", "Maintenance", "Sales", "Teamwork", "Pottery", "Data Management"]
    assert one(values, C.skill_category) == ["Technical", "Technical", "Business", "Soft Skill", "Other", "Technical"]


@pytest.mark.parametrize(
    "title, org, venture, expected",
    [
        ("Co-Founder", "X", False, "Entrepreneur"), ("Analyst", "Oceonics", False, "Entrepreneur"),
        ("Consultant", "X", False, "Freelancer"), ("Analyst", "X", False, "Wage Employed"), ("Analyst", "X", True, "Entrepreneur"),
        (None, "self-employed", None, "Freelancer"),
    ],
)
def test_employment_class(spark, title, org, venture, expected):
    df = spark.createDataFrame([(title, org, venture)], "t string, o string, v boolean")
    assert df.select(C.employment_class(F.col("t"), F.col("o"), F.col("v"))).first()[0] == expected


def test_is_current_by_date(one):
    values = [None, "", "null", "9999-12-31", "2025-10-06", "2025-10-05", "junk", "1970-01-01"]
    assert one(values, C.is_current_by_date) == [True, True, True, True, True, False, True, False]


def test_valid_company(one):
    assert one(["Acme", "", "N/A", "na", None], C.valid_company) == [True, False, False, False, False]


def test_casts_of_the_flat_table(one):
    numbers = ["3", "3.0", "2.7", "-2.5", "1e2", "3d", "x", "-99", "", None, "99999999999"]
    assert one(numbers, C.safe_int) == [3, 3, 3, -3, 100, None, None, None, None, None, None]
    days = ["2020-01-05", "2020-01-05 00:00:00", "2020-01-05T10:00:00", "2020/01/05", "2020-1-5", "2020", "1970-01-01", "2020-13-01", "2020-01-05 junk", None]
    assert [str(d) if d else None for d in one(days, C.safe_date)] == ["2020-01-05"] * 5 + [None] * 5
