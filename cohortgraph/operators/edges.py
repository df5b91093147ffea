"""Edge tables from parsed rows; one edge per pair of end points, last write wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.functions import cleaning as C
from cohortgraph.operators.keyed import last_by
from cohortgraph.operators.parse import in_steps

_DATES = {"start_date": "program_start_date", "end_date": "program_end_date", "graduation_date": "program_graduation_date"}
_FLOATS = {
    "lms_overall_score": "lms_overall_score",
    "completion_rate": "completion_rate",
    "assignment_completion_rate": "assignment_completion_rate",
    "milestone_completion_rate": "milestone_completion_rate",
    "test_completion_rate": "test_completion_rate",
}
_INTS = {
    "number_of_assignments": "no_of_assignments",
    "number_of_submissions": "no_of_submissions",
    "number_of_assignments_passed": "no_of_assignment_passed",
    "number_of_milestones": "no_of_milestone",
    "number_of_milestones_submitted": "no_of_milestone_submitted",
    "number_of_milestones_passed": "no_of_milestone_passed",
    "number_of_tests": "no_of_test",
    "number_of_tests_submitted": "no_of_test_submitted",
    "number_of_tests_passed": "no_of_test_passed",
}


def has_skill(learner_skills: DataFrame) -> DataFrame:
    return learner_skills.filter(F.col("learner").isNotNull()).select("learner", "skill_id").distinct()


def typed_enrollments(
    enrollments: DataFrame, keep_missing_ints: bool = False, years: tuple[int, int] | None = C.YEARS, whole: bool = False
) -> DataFrame:
    """Enrolment entries with typed metrics, one row per entry; dates outside ``years`` are NULL.

    ``whole``: all columns are asked for, so they are made in steps, each a method short enough for the JVM to compile.
    """
    df = enrollments.filter(F.col("learner").isNotNull())
    columns = {
        "learner": F.col("learner"),
        "program_id": F.col("cohort_code"),
        "row_ord": F.col("row_ord"),
        "pos": F.col("pos"),
        "index": C.parse_int(F.col("index")),
        "program_name": F.col("program_name"),
        "enrollment_status": F.col("enrollment_status"),
        **{dst: C.parse_date(F.col(src), years) for dst, src in _DATES.items()},
        **{dst: C.parse_num(F.col(src)) for dst, src in _FLOATS.items()},
        **{dst: C.parse_int(F.col(src), keep_missing_ints) for dst, src in _INTS.items()},
    }
    return in_steps(df, columns) if whole else df.select(*[c.alias(n) for n, c in columns.items()])


def with_enrollment_flags(df: DataFrame) -> DataFrame:
    """Completed and dropped flags and the length in days, which may be negative."""
    return df.withColumns(
        {
            "is_completed": F.col("enrollment_status").isin(*S.COMPLETED_STATUSES),
            "is_dropped": F.col("enrollment_status") == S.DROPPED_STATUS,
            "duration": F.datediff("end_date", "start_date"),
        }
    )


def enrolled_in(typed: DataFrame, whole: bool = False) -> DataFrame:
    """(learner, program_id) edges of typed enrolments with metrics and derived flags."""
    cols = [c for c in typed.columns if c not in ("row_ord", "pos", "program_name")]
    return with_enrollment_flags(last_by(typed, ["learner", "program_id"], F.struct("row_ord", "pos"), cols, whole))


def typed_jobs(jobs: DataFrame, years: tuple[int, int] | None = C.YEARS) -> DataFrame:
    """Job entries with dates, one row per entry; dates outside ``years`` are NULL.

    ``is_current`` is the flag of the stored edge, ``flagged`` accepts every true token. The kind of the
    row's placement (``placement_is_venture``) stays if the entries have it.
    """
    flag = F.lower(C.strip(F.coalesce("is_current", F.lit("0"))))
    return jobs.filter(F.col("learner").isNotNull()).select(
        "learner",
        C.hash_id(F.col("organization_name")).alias("company_id"),
        "organization_name",
        "row_ord",
        "pos",
        F.col("job_title").alias("position"),
        C.parse_date(F.col("start_date"), years).alias("start_date"),
        C.parse_date(F.col("end_date"), years).alias("end_date"),
        F.coalesce(F.col("is_current") == "1", F.lit(False)).alias("is_current"),
        flag.isin("1", "true", "yes").alias("flagged"),
        *[c for c in jobs.columns if c == "placement_is_venture"],
    )


def works_for(typed: DataFrame, whole: bool = False) -> DataFrame:
    """(learner, company_id) edges of typed jobs; several jobs at one company become one edge."""
    order = F.struct("row_ord", "pos")
    out = last_by(typed, ["learner", "company_id"], order, ["position", "start_date", "end_date", "is_current"], whole)
    return out.withColumn("source", F.lit("employment_details"))


def with_employment_derived(df: DataFrame) -> DataFrame:
    """Current means no end date; length in months of 30 days, at least one."""
    months = F.greatest(F.lit(1), F.floor(F.datediff("end_date", "start_date") / 30).cast("int"))
    return df.withColumns(
        {
            "is_current": F.col("end_date").isNull(),
            "duration": F.when(F.col("start_date").isNotNull() & F.col("end_date").isNotNull(), months),
        }
    )


def runs_venture(placements: DataFrame) -> DataFrame:
    """Founder edges to the hashed business name."""
    df = placements.filter((F.col("kind") == "venture") & F.col("learner").isNotNull())
    df = df.select(
        "learner",
        C.hash_id(F.col("business_name")).alias("company_id"),
        "row_ord",
        C.parse_date(F.col("job_start_date")).alias("start_date"),
        "jobs_created",
        "capital_secured",
        "female_opportunities",
    )
    out = last_by(df, ["learner", "company_id"], "row_ord", [
        "start_date", "jobs_created", "capital_secured", "female_opportunities",
    ])
    return out.withColumn("role", F.lit("Founder")).withColumn("is_current", F.lit(True))


def _state_edges(history: DataFrame, value: str) -> DataFrame:
    df = history.filter(F.col("start_date").isNotNull() & F.col("learner").isNotNull())
    order = F.struct("entry_ord", "step")
    out = last_by(df, ["learner", value, "start_date"], order, ["end_date", "is_current"])
    return out.select(
        "learner", value, F.col("start_date").alias("valid_from"), F.col("end_date").alias("valid_to"), "is_current"
    )


def has_learning_state(history: DataFrame) -> DataFrame:
    """One edge per (learner, state, start) for every history row with a start date."""
    return _state_edges(history, "state")


def has_professional_status(history: DataFrame) -> DataFrame:
    return _state_edges(history, "status")
