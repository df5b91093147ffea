"""Questions over the flat landing table, one row per enrolment record.

Each is filter, one grouped aggregate, having, order, limit. Thresholds, terms and
countries are parameters; every order has a full tie-break.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgraph.functions import cleaning as C
from cohortgraph.functions.rates import asc, desc, mean, rates_by, share_of_total, top_k, top_n_per_group
from cohortgraph.operators.parse import silver



def reads(learning: str = "", employment: str = "", placement: str = ""):
    """Name the JSON fields a question needs; only these are parsed, once per row."""

    def decorate(question):
        @wraps(question)
        def run(raw: DataFrame, *args, **options) -> DataFrame:
            flat = silver(raw, tuple(learning.split()), tuple(employment.split()), tuple(placement.split()))
            return question(flat, *args, **options)

        return run

    return decorate


def _program() -> Column:
    return F.col("le.program_name")


def _status() -> Column:
    return F.lower(F.col("le.enrollment_status"))


def _graduated() -> Column:
    return _status() == "graduated"


def _dropped() -> Column:
    return _status().contains("dropped")


def _employed() -> Column:
    return (F.col("is_wage_employed") == 1) | (F.col("is_running_a_venture") == 1) | (F.col("is_a_freelancer") == 1)


def _is(flag: str) -> Column:
    return F.col(flag) == 1


def q00_describe(raw: DataFrame) -> DataFrame:
    """Columns with their types, from the schema alone."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(raw.schema.fields)]
    return raw.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")


@reads()
def q01_country_share(df: DataFrame, limit: int = 20) -> DataFrame:
    known = df.filter(F.col("country").isNotNull())
    out = share_of_total(known, ["country"], "total_learners", "percentage")
    return top_k(out, desc("total_learners") + asc("country"), limit)


@reads(learning="program_name")
def programs_matching(df: DataFrame, country: str, term: str) -> DataFrame:
    """Distinct first programs that contain a term, in a country."""
    hit = df.filter(C.contains_term(F.col("country"), country) & C.contains_term(_program(), term))
    out = hit.groupBy(_program().alias("program_name")).agg(F.count(F.lit(1)).alias("learners"))
    return out.orderBy(*desc("learners"), *asc("program_name"))


def _outcomes(df: DataFrame, country: str, terms: dict[str, str]) -> DataFrame:
    here = df.filter(C.contains_term(F.col("country"), country))
    hits = F.array_compact(F.array(*[F.when(C.contains_term(_program(), t), F.lit(label)) for label, t in terms.items()]))
    tagged = here.select("le", F.explode(hits).alias("match_type"))
    return rates_by(
        tagged,
        ["match_type"],
        {"graduates": _graduated(), "active": _status() == "enrolled", "dropped_out": _dropped()},
        {"graduation_rate_pct": ("graduates", "total_learners")},
        total="total_learners",
    )


def match_terms(specific: str, broad: str) -> dict[str, str]:
    return {f"{specific} (SPECIFIC)": specific, f"{broad} (BROAD)": broad}


@reads(learning="program_name enrollment_status")
def q02_program_in_country(df: DataFrame, country: str, specific: str = "data analytics", broad: str = "data") -> DataFrame:
    """Outcomes for a specific and a broad program term; one scan tags a row with every term it meets."""
    return _outcomes(df, country, match_terms(specific, broad)).orderBy("match_type")


@reads(learning="program_name")
def q02b_by_city(df: DataFrame, country: str, term: str, min_n: int = 3, limit: int = 15) -> DataFrame:
    hit = df.filter(
        C.contains_term(F.col("country"), country) & C.contains_term(_program(), term) & F.col("city").isNotNull()
    )
    out = rates_by(
        hit, ["city"], {"graduates": _is("is_graduate_learner")},
        {"graduation_rate_pct": ("graduates", "learner_count")}, total="learner_count", min_n=min_n,
    )
    return top_k(out, desc("learner_count") + asc("city"), limit)


@reads(learning="program_name enrollment_status")
def q03b_two_country_compare(
    df: DataFrame, first: str, second: str, specific: str = "data analytics", broad: str = "data"
) -> DataFrame:
    """Two countries by match type."""
    name = F.col("country")
    label = F.when(C.contains_term(name, first), F.lit(first)).when(C.contains_term(name, second), F.lit(second))
    terms = match_terms(specific, broad)
    hits = F.array_compact(F.array(*[F.when(C.contains_term(_program(), t), F.lit(k)) for k, t in terms.items()]))
    tagged = df.withColumn("country", label).filter(F.col("country").isNotNull())
    tagged = tagged.select("country", "le", F.explode(hits).alias("match_type"))
    out = rates_by(
        tagged, ["country", "match_type"], {"graduates": _graduated(), "dropped_out": _dropped()},
        {"graduation_rate_pct": ("graduates", "total_learners")}, total="total_learners",
    )
    return out.orderBy("country", "match_type")


@reads()
def q04_active_by_country(df: DataFrame, limit: int = 20) -> DataFrame:
    hit = df.filter(_is("is_active_learner") & F.col("country").isNotNull())
    out = rates_by(
        hit, ["country"], {"female_count": F.col("gender") == "female"},
        {"female_pct": ("female_count", "active_learners")}, total="active_learners",
    )
    return top_k(out, desc("active_learners") + asc("country"), limit)


def _state_counts() -> dict[str, Column]:
    return {
        "graduates": _is("is_graduate_learner"), "dropouts": _is("is_a_dropped_out"), "active": _is("is_active_learner"),
    }


@reads()
def q05_grad_rate_country(df: DataFrame, min_n: int = 1000) -> DataFrame:
    out = rates_by(
        df.filter(F.col("country").isNotNull()), ["country"], _state_counts(),
        {
            "graduation_rate_pct": ("graduates", "total_enrollments"),
            "dropout_rate_pct": ("dropouts", "total_enrollments"),
        },
        total="total_enrollments", min_n=min_n,
    )
    return out.orderBy(*desc("graduation_rate_pct"), *asc("country"))


@reads()
def q06_top_cities(df: DataFrame, min_n: int = 500, limit: int = 30) -> DataFrame:
    out = rates_by(
        df.filter(F.col("city").isNotNull()), ["country", "city"], {"graduates": _is("is_graduate_learner")},
        {"graduation_rate_pct": ("graduates", "total_learners")}, total="total_learners", min_n=min_n,
    )
    return top_k(out, desc("total_learners") + asc("country", "city"), limit)


@reads(learning="program_name")
def q07_program_enrolments(df: DataFrame) -> DataFrame:
    """Share of all rows, also of rows without a program: the NULL group counts in the whole."""
    out = share_of_total(df.select(_program().alias("program_name")), ["program_name"], "total_enrollments", "pct_of_total")
    return out.filter(F.col("program_name").isNotNull()).orderBy(*desc("total_enrollments"), *asc("program_name"))


@reads(learning="program_name enrollment_status")
def q08_program_grad_rate(df: DataFrame, min_n: int = 100) -> DataFrame:
    out = rates_by(
        df.select("le", _program().alias("program_name")), ["program_name"],
        {"graduates": _graduated(), "dropouts": _dropped()},
        {"graduation_rate_pct": ("graduates", "total_enrolled")}, total="total_enrolled", min_n=min_n,
    )
    return out.orderBy(*desc("graduation_rate_pct"), *asc("program_name"))


@reads(learning="program_name cohort_code enrollment_status lms_overall_score")
def q09_cohort_performance(df: DataFrame, min_n: int = 100, limit: int = 30) -> DataFrame:
    out = rates_by(
        df.select("le", F.col("le.cohort_code").alias("cohort_code"), _program().alias("program_name")),
        ["cohort_code", "program_name"], {"_graduates": _graduated()},
        {"graduation_rate_pct": ("_graduates", "enrollments")}, total="enrollments", min_n=min_n,
        extra=[mean(C.safe_double(F.col("le.lms_overall_score"))).alias("avg_lms_score")],
    ).drop("_graduates")
    return top_k(out, desc("enrollments") + asc("cohort_code", "program_name"), limit)


@reads(learning="program_name program_start_date program_end_date")
def q10_program_duration(df: DataFrame, min_n: int = 100) -> DataFrame:
    days = F.datediff(C.safe_date(F.col("le.program_end_date")), C.safe_date(F.col("le.program_start_date")))
    out = rates_by(
        df.select(_program().alias("program_name"), days.alias("days")), ["program_name"], {},
        total="enrollments", min_n=min_n,
        extra=[
            mean(F.col("days"), 1).alias("avg_duration_days"),
            mean(F.col("days") / F.lit(30.0), 1).alias("avg_duration_months"),
        ],
    )
    return out.orderBy(*desc("avg_duration_days"), *asc("program_name"))


@reads(learning="program_name assignment_completion_rate test_completion_rate milestone_completion_rate")
def q11_completion_rates(df: DataFrame, min_n: int = 100) -> DataFrame:
    metrics = ("assignment", "test", "milestone")
    out = rates_by(
        df.select("le", _program().alias("program_name")), ["program_name"], {}, total="enrollments", min_n=min_n,
        extra=[
            mean(C.safe_double(F.col(f"le.{m}_completion_rate"))).alias(f"avg_{m}_completion_pct") for m in metrics
        ],
    )
    return out.orderBy(*desc("avg_assignment_completion_pct"), *asc("program_name"))


@reads(learning="program_name lms_overall_score")
def q12_top_performers(df: DataFrame, n: int = 5, limit: int | None = 50) -> DataFrame:
    score = C.safe_double(F.col("le.lms_overall_score"))
    rows = df.select(
        "hashed_email", "row_ord", F.col("country_of_residence"), "gender",
        _program().alias("program_name"), score.alias("lms_score"),
    ).filter(F.col("lms_score") > 0)
    best = top_n_per_group(rows, ["program_name"], desc("lms_score") + asc("hashed_email", "row_ord"), n, "rank_in_program")
    out = best.select("program_name", "country_of_residence", "gender", "lms_score", "rank_in_program")
    return top_k(out, asc("program_name", "rank_in_program"), limit)


def state_label() -> Column:
    return (
        F.when(_is("is_graduate_learner"), "Graduate").when(_is("is_active_learner"), "Active/Enrolled")
        .when(_is("is_a_dropped_out"), "Dropped Out").otherwise("Unknown")
    )


@reads()
def q13_state_distribution(df: DataFrame) -> DataFrame:
    out = share_of_total(df.select(state_label().alias("learning_state")), ["learning_state"], "learner_count")
    return out.orderBy(*desc("learner_count"), *asc("learning_state"))


@reads()
def q14_state_by_country(df: DataFrame, min_n: int = 1000) -> DataFrame:
    out = rates_by(
        df.filter(F.col("country").isNotNull()), ["country"],
        {"graduates": _is("is_graduate_learner"), "active": _is("is_active_learner"), "dropped_out": _is("is_a_dropped_out")},
        {"graduation_rate_pct": ("graduates", "total"), "dropout_rate_pct": ("dropped_out", "total")}, min_n=min_n,
    )
    return out.orderBy(*desc("graduation_rate_pct"), *asc("country"))


@reads()
def q15_by_gender(df: DataFrame) -> DataFrame:
    out = rates_by(
        df.withColumn("gender", F.coalesce("gender", F.lit("Unknown"))), ["gender"],
        {"graduates": _is("is_graduate_learner"), "dropped_out": _is("is_a_dropped_out")},
        {"graduation_rate_pct": ("graduates", "total"), "dropout_rate_pct": ("dropped_out", "total")},
    )
    return out.orderBy(*desc("total"), *asc("gender"))


@reads()
def q16_by_education(df: DataFrame, min_n: int = 100) -> DataFrame:
    out = rates_by(
        df.filter(F.col("education_level").isNotNull()), ["education_level"],
        {"graduates": _is("is_graduate_learner"), "_dropped": _is("is_a_dropped_out")},
        {"graduation_rate_pct": ("graduates", "total"), "dropout_rate_pct": ("_dropped", "total")}, min_n=min_n,
    ).drop("_dropped")
    return out.orderBy(*desc("graduation_rate_pct"), *asc("education_level"))


@reads(learning="program_start_date enrollment_status")
def q17_monthly_trend(df: DataFrame, since: str = "2020-01-01", until: str | None = None) -> DataFrame:
    """Enrolments per start month; ``until`` bounds the range (inclusive)."""
    day = C.safe_date(F.col("le.program_start_date"))
    rows = df.select("le", day.alias("day")).filter(F.col("day") >= F.lit(since).cast("date"))
    if until:
        rows = rows.filter(F.col("day") <= F.lit(until).cast("date"))
    out = rates_by(
        rows.withColumn("start_month", F.trunc("day", "month")), ["start_month"],
        {"graduated": _graduated(), "dropped_out": _dropped()}, total="new_enrollments",
    )
    return out.orderBy("start_month")


@reads()
def q18_employment_by_country(df: DataFrame, min_n: int = 100) -> DataFrame:
    rows = df.filter(F.col("country").isNotNull() & _is("is_graduate_learner"))
    out = rates_by(
        rows, ["country"], {"employed_graduates": _employed()},
        {"employment_rate_pct": ("employed_graduates", "total_graduates")}, total="total_graduates", min_n=min_n,
    )
    return out.orderBy(*desc("employment_rate_pct"), *asc("country"))


@reads()
def q19_employment_types(df: DataFrame) -> DataFrame:
    w, v, f = F.col("is_wage_employed"), F.col("is_running_a_venture"), F.col("is_a_freelancer")
    kind = (
        F.when((w == 1) & (v == 0) & (f == 0), "Wage Employed Only")
        .when((v == 1) & (w == 0) & (f == 0), "Entrepreneur Only")
        .when((f == 1) & (w == 0) & (v == 0), "Freelancer Only")
        .when((w == 1) & (v == 1), "Wage + Entrepreneur")
        .when((w == 1) & (f == 1), "Wage + Freelancer")
        .when((w == 0) & (v == 0) & (f == 0), "Not Employed/Unknown")
        .otherwise("Multiple/Other")
    )
    out = share_of_total(df.select(kind.alias("employment_type")), ["employment_type"], "learner_count")
    return out.orderBy(*desc("learner_count"), *asc("employment_type"))


@reads(placement="salary_range")
def q20_salary_distribution(df: DataFrame) -> DataFrame:
    rows = df.select(F.col("pl.salary_range").alias("salary_range"))
    rows = rows.filter(F.col("salary_range").isNotNull() & ~F.col("salary_range").isin("n/a", ""))
    out = share_of_total(rows, ["salary_range"], "learner_count")
    return out.orderBy(*desc("learner_count"), *asc("salary_range"))


@reads(employment="job_title")
def q21_job_titles(df: DataFrame, min_n: int = 10, limit: int = 30) -> DataFrame:
    rows = df.select("hashed_email", F.col("em.job_title").alias("job_title"))
    rows = rows.filter(F.col("job_title").isNotNull() & ~F.col("job_title").isin("n/a", ""))
    out = rates_by(
        rows, ["job_title"], {}, total="occurrence_count", min_n=min_n,
        extra=[F.countDistinct("hashed_email").alias("unique_learners")],
    )
    return top_k(out, desc("occurrence_count") + asc("job_title"), limit)


@reads(placement="jobs_created_to_date female_opp_todate")
def q22_ventures(df: DataFrame, min_n: int = 10, limit: int = 20) -> DataFrame:
    def total(name: str) -> Column:
        return F.sum(F.coalesce(C.safe_int(F.col(f"pl.{name}")), F.lit(0)).cast("bigint"))

    rows = df.filter(_is("is_running_a_venture") & F.col("country").isNotNull())
    out = rows.groupBy("country").agg(
        F.countDistinct("hashed_email").alias("entrepreneurs"),
        total("jobs_created_to_date").alias("total_jobs_created"),
        total("female_opp_todate").alias("female_opportunities"),
    )
    return top_k(out.filter(F.col("entrepreneurs") >= min_n), desc("entrepreneurs") + asc("country"), limit)


@reads(learning="program_name enrollment_status")
def q23_employment_by_program(df: DataFrame, min_n: int = 50) -> DataFrame:
    rows = df.filter(_is("is_graduate_learner") & _graduated()).withColumn("program_name", _program())
    out = rates_by(
        rows, ["program_name"],
        {
            "employed_count": _employed(), "wage_employed": _is("is_wage_employed"),
            "entrepreneurs": _is("is_running_a_venture"), "freelancers": _is("is_a_freelancer"),
        },
        {"employment_rate_pct": ("employed_count", "total_graduates")}, total="total_graduates", min_n=min_n,
    )
    return out.orderBy(*desc("employment_rate_pct"), *asc("program_name"))


def _female_employed(df: DataFrame, country: str) -> DataFrame:
    return df.filter(
        (F.col("gender") == "female") & _is("is_graduate_learner") & C.contains_term(F.col("country"), country) & _employed()
    )


@reads(learning="program_name")
def q24_female_employed(df: DataFrame, country: str, min_n: int = 3, limit: int = 20) -> DataFrame:
    out = rates_by(
        _female_employed(df, country).withColumn("program_name", _program()), ["city", "program_name"],
        {"_w": _is("is_wage_employed"), "_v": _is("is_running_a_venture"), "_f": _is("is_a_freelancer")},
        total="employed_female_graduates", min_n=min_n,
    )
    w, v, f = F.col("_w"), F.col("_v"), F.col("_f")
    kind = (
        F.when((w > 0) & (v == 0), "Wage Employed").when((v > 0) & (w == 0), "Entrepreneur")
        .when(f > 0, "Freelancer").otherwise("Mixed")
    )
    out = out.withColumn("primary_employment_type", kind).drop("_w", "_v", "_f")
    return top_k(out, desc("employed_female_graduates") + asc("city", "program_name"), limit)


@reads()
def q24_total(df: DataFrame, country: str) -> DataFrame:
    return _female_employed(df, country).agg(F.count(F.lit(1)).alias("total_employed_female_graduates"))


@reads(learning="program_name")
def q25_venture_grads(df: DataFrame, country: str, term: str, limit: int = 20) -> DataFrame:
    """City and program of graduates with a venture whose learning details contain a term."""
    rows = df.filter(
        C.contains_term(F.col("country"), country) & _is("is_graduate_learner") & _is("is_running_a_venture")
        & C.contains_term(F.col("learning_details"), term)
    )
    out = rows.groupBy("city", _program().alias("program_name")).agg(F.count(F.lit(1)).alias("entrepreneurs"))
    return top_k(out, desc("entrepreneurs") + asc("city", "program_name"), limit)


@reads(learning="program_name")
def q25_with_fallback(df: DataFrame, country: str, term: str, limit: int = 20) -> DataFrame:
    """As ``q25_venture_grads``; where the term finds none, every graduate venture of the country by program.

    One plan: groups carry both counts, the number of matches over all groups is a scalar subquery.
    """
    rows = df.filter(
        C.contains_term(F.col("country"), country) & _is("is_graduate_learner") & _is("is_running_a_venture")
    )
    hit = F.coalesce(C.contains_term(F.col("learning_details"), term), F.lit(False))
    groups = rows.groupBy("city", _program().alias("program_name")).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("hits"))
    matches = groups.agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("hits")).scalar()
    found = groups.filter("hits > 0").select("city", "program_name", F.col("hits").alias("entrepreneurs"))
    rest = groups.groupBy("program_name").agg(F.sum("n").alias("entrepreneurs")).filter(matches == 0)
    rest = rest.select(F.lit(None).cast("string").alias("city"), "program_name", "entrepreneurs")
    order = desc("entrepreneurs") + asc("city", "program_name")
    return top_k(found, order, limit).unionByName(rest).orderBy(*order)


@reads()
def q26_skill_employment(df: DataFrame, min_n: int = 100, limit: int = 25) -> DataFrame:
    rows = df.filter(_is("is_graduate_learner") & F.col("skills_list").isNotNull() & (F.col("skills_list") != ""))
    exploded = rows.select(
        F.explode(F.split("skills_list", ",")).alias("s"), _employed().alias("employed")
    ).select(F.trim("s").alias("skill_name"), "employed")
    out = rates_by(
        exploded, ["skill_name"], {"employed_count": F.col("employed"), "not_employed_count": ~F.col("employed")},
        {"employed_pct": ("employed_count", "total_count")}, total="total_count", min_n=min_n,
    )
    return top_k(out, desc("employed_pct") + asc("skill_name"), limit)


@reads(learning="program_name enrollment_status")
def q27_field_program(df: DataFrame, min_n: int = 100, limit: int = 30) -> DataFrame:
    rows = df.filter(F.col("education_field").isNotNull()).select(
        "le", F.col("education_field").alias("prior_education_field"), _program().alias("program_name")
    )
    out = rates_by(
        rows, ["prior_education_field", "program_name"], {"graduates": _graduated()},
        {"graduation_rate_pct": ("graduates", "enrollments")}, total="enrollments", min_n=min_n,
    )
    return top_k(out, desc("graduation_rate_pct") + asc("prior_education_field", "program_name"), limit)


@reads(learning="program_name lms_overall_score")
def q28_high_performers(df: DataFrame, score: float = 90, min_n: int = 10, limit: int = 30) -> DataFrame:
    value = C.safe_double(F.col("le.lms_overall_score"))
    rows = df.withColumn("_score", value).filter(F.col("_score") >= score).withColumn("program_name", _program())
    out = rates_by(
        rows, ["gender", "country_of_residence", "education_level", "program_name"],
        {"employed_count": _is("is_wage_employed") | _is("is_running_a_venture")},
        total="high_performers", min_n=min_n, extra=[mean(F.col("_score")).alias("avg_score")],
    ).withColumnRenamed("country_of_residence", "country")
    order = desc("high_performers") + asc("gender", "country", "education_level", "program_name")
    return top_k(out, order, limit)


@reads(learning="program_name enrollment_status")
def q29_dropout_risk(df: DataFrame, min_n: int = 100, limit: int = 30) -> DataFrame:
    rows = df.filter(F.col("education_level").isNotNull()).withColumn("program_name", _program())
    out = rates_by(
        rows, ["gender", "education_level", "program_name"], {"dropped_out": _dropped()},
        {"dropout_rate_pct": ("dropped_out", "total_enrolled")}, total="total_enrolled", min_n=min_n,
    )
    return top_k(out, desc("dropout_rate_pct") + asc("gender", "education_level", "program_name"), limit)


@reads(learning="program_name enrollment_status no_of_submissions")
def q30_funnel(df: DataFrame, min_n: int = 100) -> DataFrame:
    started = F.coalesce(C.safe_int(F.col("le.no_of_submissions")) > 0, F.lit(False))
    out = rates_by(
        df.withColumn("program_name", _program()), ["program_name"],
        {"started_assignments": started, "graduated": _graduated(), "employed": _employed()},
        {
            "started_pct": ("started_assignments", "total_enrolled"),
            "graduation_pct": ("graduated", "total_enrolled"),
            "employment_rate_of_graduates_pct": ("employed", "graduated"),
        },
        total="total_enrolled", min_n=min_n,
    )
    return out.orderBy(*desc("total_enrolled"), *asc("program_name"))
