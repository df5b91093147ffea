"""Fixed values and schemas of the learner model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (must equal the model's published rules) -----------------------------------

NULL_TOKENS = ("n/a", "none", "null", "")
MISSING_NUMBERS = ("-99", "-99.0")
INVALID_DATES = ("1970-01-01", "9999-12-31")
TRUE_TOKENS = ("1", "true", "yes", "y")
FALSE_TOKENS = ("0", "false", "no", "n")
NO_COMPANY_TOKENS = ("", "n/a", "na")
OTHER_GENDER_TOKENS = ("other/prefer not to say", "prefer not to say", "other")
OTHER_GENDER = "other/prefer not to say"

EDUCATION_LEVELS = (
    "Completed secondary school or equivalent and earned a secondary or final national examination certificate.",
    "Currently Enrolled At University/College",
    "High School",
    "Associate Degree",
    "University Diploma or equivalent",
    "Bachelor's degree or equivalent",
    "Bachelor'S Degree",
    "Master's degree",
    "PhD",
    "Professional Certificate",
)
LEARNING_STATES = ("Active", "Graduate", "Dropped Out", "Inactive")
PROFESSIONAL_STATUSES = ("Unemployed", "Wage Employed", "Freelancer", "Entrepreneur", "Multiple")

TECHNICAL_TERMS = (
    "python", "java", "javascript", "sql", "data", "machine learning", "ai", "programming", "coding",
    "software", "development", "web", "cloud", "database",
)
BUSINESS_TERMS = (
    "management", "leadership", "strategy", "finance", "accounting", "marketing", "sales", "business",
)
SOFT_TERMS = (
    "communication", "teamwork", "problem solving", "critical thinking", "presentation", "collaboration",
)
VENTURE_TERMS = ("founder", "co-founder", "entrepreneur", "ceo", "owner", "venture", "startup")
FREELANCE_TERMS = ("freelance", "freelancer", "consultant", "contractor", "self-employed")

COMPLETED_STATUSES = ("Graduated", "Completed")
DROPPED_STATUS = "Dropped Out"
PROVIDER = "ALX"

# ---- raw table ------------------------------------------------------------------------------

RAW_COLUMNS = (
    "hashed_email", "sand_id", "full_name", "profile_photo_url", "bio", "gender",
    "country_of_residence", "country_of_origin", "city_of_residence",
    "country_of_residence_latitude", "country_of_residence_longitude",
    "city_of_residence_latitude", "city_of_residence_longitude",
    "education_level_of_study", "education_field_of_study", "skills_list",
    "is_graduate_learner", "is_active_learner", "is_a_dropped_out",
    "is_running_a_venture", "is_a_freelancer", "is_wage_employed", "is_placed", "is_featured",
    "is_rural", "description_of_living_location", "has_disability", "type_of_disability",
    "is_from_low_income_household", "learning_details", "placement_details", "employment_details",
    "education_details", "snapshot_id",
)


def raw_schema(columns: tuple[str, ...] = RAW_COLUMNS) -> T.StructType:
    """Landing schema: everything arrives as text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def entry_array(fields: tuple[str, ...]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in fields]))


LEARNING_FIELDS = (
    "index", "program_name", "cohort_code", "program_start_date", "program_end_date",
    "enrollment_status", "program_graduation_date", "lms_overall_score", "no_of_assignments",
    "no_of_submissions", "no_of_assignment_passed", "assignment_completion_rate", "no_of_milestone",
    "no_of_milestone_submitted", "no_of_milestone_passed", "milestone_completion_rate", "no_of_test",
    "no_of_test_submitted", "no_of_test_passed", "test_completion_rate", "completion_rate",
)
EMPLOYMENT_FIELDS = (
    "index", "organization_name", "start_date", "end_date", "country", "job_title", "is_current",
    "duration_in_years",
)
EMPLOYMENT_WIRE_FIELDS = EMPLOYMENT_FIELDS + ("organisation_name",)
EDUCATION_FIELDS = (
    "index", "institution_name", "start_date", "end_date", "level_of_study", "field_of_study", "graduated",
)
PLACEMENT_FIELDS = (
    "job_start_date", "organisation_name", "employment_type", "salary_range", "job_title",
    "business_name", "jobs_created_to_date", "capital_secured_todate", "female_opp_todate",
)

LEARNING_ARRAY = entry_array(LEARNING_FIELDS)
EMPLOYMENT_ARRAY = entry_array(EMPLOYMENT_WIRE_FIELDS)
EDUCATION_ARRAY = entry_array(EDUCATION_FIELDS)
PLACEMENT_ARRAY = entry_array(PLACEMENT_FIELDS)
