"""Validation rules as an ``errors`` array column, and data-quality metrics over it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph.functions import cleaning as C
from cohortgraph.functions.rates import asc, desc, round_to, top_k

RATES = ("completion_rate", "assignment_completion_rate", "milestone_completion_rate", "test_completion_rate")


def with_errors(df: DataFrame, *checks: Column) -> DataFrame:
    """Append the non-null messages of ``checks`` as the ``errors`` array."""
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def required(cols: tuple[str, ...] = ("hashed_email", "full_name")) -> list[Column]:
    """Missing or empty required fields."""
    return [
        F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"Missing required field: {c}")) for c in cols
    ]


def code_length(col: str, label: str) -> Column:
    return F.when(F.length(col) != 2, _text(f"{label}: ", F.col(col)))


def date_order(start: str, end: str, label: str = "end_date", context: str = "") -> Column:
    message = _text(f"{context}{label} (", F.col(end), f") before {start} (", F.col(start), ")")
    return F.when(F.col(end) < F.col(start), message)


def in_range(col: str, low: float = 0, high: float = 100) -> Column:
    return F.when(
        ~F.col(col).between(low, high), _text(f"{col} must be between {low} and {high}, got ", F.col(col))
    )


def check_types(df: DataFrame, cols: tuple[str, ...] = ("sand_id", "hashed_email")) -> list[str]:
    """Columns that should be text and are not. Types belong to the schema, so no row is read."""
    return [
        f"{c} must be string, got {df.schema[c].dataType.simpleString()}"
        for c in cols if c in df.columns and not isinstance(df.schema[c].dataType, T.StringType)
    ]


def type_errors(df: DataFrame, cols: tuple[str, ...] = ("sand_id", "hashed_email")) -> DataFrame:
    """Wrongly typed text columns with the number of rows that hold a value in them."""
    wrong = {c: e for c in cols for e in check_types(df, (c,))}
    counts = df.agg(F.count(F.lit(1)), *[F.count(c).alias(c) for c in wrong])
    rows = F.array(*[F.struct(F.lit(e).alias("error"), F.col(c).alias("n")) for c, e in wrong.items()]) if wrong else (
        F.array().cast("array<struct<error:string,n:bigint>>"))
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def check_learners(df: DataFrame, fields: tuple[str, ...] = ("hashed_email", "full_name")) -> DataFrame:
    checks = required(fields) + [
        code_length("country_of_residence_code", "Invalid country_of_residence_code"),
        code_length("country_of_origin_code", "Invalid country_of_origin_code"),
    ]
    return with_errors(df, *checks)


def check_enrollments(df: DataFrame, low: float = 0, high: float = 100) -> DataFrame:
    """Cohort present, dates in order, rates and score within bounds."""
    checks = [
        F.when(F.col("program_id").isNull() | (F.col("program_id") == ""), F.lit("cohort_code is required")),
        date_order("start_date", "end_date"),
        date_order("start_date", "graduation_date", "graduation_date"),
        *[in_range(c, low, high) for c in (*RATES, "lms_overall_score")],
    ]
    return with_errors(df, *checks)


def check_employment(df: DataFrame) -> DataFrame:
    return with_errors(
        df,
        date_order("start_date", "end_date"),
        F.when(F.col("end_date").isNotNull() & F.col("is_current"), F.lit("is_current=True but end_date is set")),
    )


def check_range(df: DataFrame, start: str, end: str, label: str = "relationship") -> DataFrame:
    return with_errors(df, date_order(start, end, "end_date", f"{label}: "))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their errors."""
    ok = F.size("errors") == 0
    return df.filter(ok).drop("errors"), df.filter(~ok)


def write_split(df: DataFrame, path: str) -> DataFrame:
    """Write good and bad rows in one job and report it: total, good and bad rows, one row.

    The table is read and checked once: the rows are written below ``path``, parted by ``kind`` (good, or quarantine with the
    errors), while the counts are observed.
    """
    spark, seen = df.sparkSession, Observation()
    ok = F.coalesce(F.size("errors") == 0, F.lit(True))
    kind = F.when(ok, F.lit("good")).otherwise(F.lit("quarantine"))
    counted = df.withColumn("kind", kind).observe(
        seen, F.count(F.lit(1)).alias("total"), F.count_if(F.col("kind") == "good").alias("good"), F.count_if(F.col("kind") != "good").alias("bad"))
    counted.write.mode("overwrite").partitionBy("kind").option("compression", "zstd").parquet(path)
    return spark.createDataFrame([(seen.get["total"], seen.get["good"], seen.get["bad"])], "total bigint, good bigint, bad bigint")


def read_split(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their errors, as written by ``write_split`` from a table of ``schema``; each reads its own folder only."""
    both = spark.read.schema(T.StructType([*schema.fields, T.StructField("kind", T.StringType())])).parquet(path)
    return both.filter("kind = 'good'").drop("errors", "kind"), both.filter("kind = 'quarantine'").drop("kind")


def quality_metrics(df: DataFrame) -> DataFrame:
    """Totals and rates, one row."""
    bad = F.size("errors") > 0
    out = df.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(bad).alias("invalid_records"))
    total = F.col("total_records")

    def rate(c: Column) -> Column:
        return F.coalesce(round_to(c.cast("double") / F.when(total > 0, total), 4), F.lit(0.0))

    return out.select(
        total, (total - F.col("invalid_records")).alias("valid_records"), "invalid_records",
        rate(F.col("invalid_records")).alias("error_rate"), rate(total - F.col("invalid_records")).alias("success_rate"),
    )


def errors_by_type(df: DataFrame) -> DataFrame:
    return df.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def errors_by_field(df: DataFrame) -> DataFrame:
    """Errors of the form ``field: message`` per field."""
    e = df.select(F.explode("errors").alias("error")).filter(F.col("error").contains(":"))
    field = F.trim(F.split("error", ":")[0])
    return e.groupBy(field.alias("field")).agg(F.count(F.lit(1)).alias("n"))


def quality_gate(metrics: DataFrame, max_error_rate: float = 0.05) -> DataFrame:
    """Passes unless the error rate is above the limit."""
    rate = F.col("invalid_records") / F.when(F.col("total_records") > 0, F.col("total_records"))
    return metrics.withColumns(
        {"max_error_rate": F.lit(max_error_rate), "passed": F.coalesce(rate <= max_error_rate, F.lit(True))}
    )


def top_errors(df: DataFrame, n: int = 10) -> DataFrame:
    return top_k(errors_by_type(df), desc("n") + asc("error"), n)


def top_fields(df: DataFrame, n: int = 10) -> DataFrame:
    return top_k(errors_by_field(df), desc("n") + asc("field"), n)


def quality_report(df: DataFrame, max_error_rate: float = 0.05, n: int = 10) -> DataFrame:
    """Summary, gate, top errors and top fields as (section, name, value) rows."""
    summary = quality_gate(quality_metrics(df), max_error_rate)
    names = ("total_records", "valid_records", "invalid_records", "error_rate", "success_rate", "max_error_rate", "passed")
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in names[:-1]],
                    F.struct(F.lit("passed").alias("name"), F.col("passed").cast("int").cast("double").alias("value")))
    parts = [
        summary.select(F.lit("summary").alias("section"), F.explode(pairs).alias("p")).select("section", "p.name", "p.value"),
        top_errors(df, n).select(F.lit("top_errors").alias("section"), F.col("error").alias("name"), F.col("n").cast("double").alias("value")),
        top_fields(df, n).select(F.lit("problematic_fields").alias("section"), F.col("field").alias("name"), F.col("n").cast("double").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def mapping_coverage(df: DataFrame, dim: DataFrame, name: str = "country_of_residence", warn_below: float = 95.0) -> DataFrame:
    """Share of rows with a country name that the mapping knows. Names are counted before the join."""
    names = df.select(C.norm_str(F.col(name)).alias("country")).filter(F.col("country").isNotNull())
    counts = names.groupBy(F.lower("country").alias("country_key")).agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(dim.select("country_key", "code"), "country_key", "left")
    out = joined.agg(F.sum("n").alias("named"), F.sum(F.when(F.col("code").isNotNull(), F.col("n")).otherwise(0)).alias("mapped"))
    share = round_to(F.lit(100.0) * F.col("mapped") / F.col("named").cast("double"), 2)
    return out.withColumn("coverage_pct", share).withColumn("warn", F.col("coverage_pct") < warn_below)


def employment_consistency(learners: DataFrame, jobs: DataFrame) -> DataFrame:
    """Contradictions between professional status and jobs: learner, rule, current_jobs, jobs, start_date.

    ``learners`` has learner and status. Jobs are reduced to counts and start bounds per
    learner, never collected; ``contradicting_jobs`` lists the jobs behind the first rule.
    """
    flag = F.col("is_current") == "1"
    per = jobs.groupBy("learner").agg(
        F.count(F.lit(1)).alias("jobs"), F.count_if(flag).alias("current_jobs"),
        F.min(F.when(flag, F.col("start_date"))).alias("first_start"), F.max(F.when(flag, F.col("start_date"))).alias("last_start"),
    )
    df = learners.join(per, "learner", "left").fillna(0, ["jobs", "current_jobs"])
    employed = F.col("status").isin("Wage Employed", "Freelancer", "Multiple", "Entrepreneur")
    n, total = F.col("current_jobs"), F.col("jobs")
    rules = F.array_compact(F.array(
        F.when((F.col("status") == "Unemployed") & (n > 0), F.lit("unemployed_with_current_jobs")),
        F.when(employed & (n == 0) & (total > 0), F.lit("employed_with_past_jobs_only")),
        F.when(employed & (total == 0), F.lit("employed_without_jobs")),
        F.when((n > 1) & (F.col("first_start") == F.col("last_start")), F.lit("info_current_jobs_same_start")),
    ))
    same = F.col("rule") == "info_current_jobs_same_start"
    return df.select("learner", "status", "current_jobs", "jobs", "first_start", F.explode(rules).alias("rule")).select(
        "learner", "rule", "current_jobs", "jobs", F.when(same, F.col("first_start")).alias("start_date")
    )


def contradicting_jobs(learners: DataFrame, jobs: DataFrame) -> DataFrame:
    """Current jobs of learners whose status is Unemployed, one row each."""
    idle = learners.filter(F.col("status") == "Unemployed").select("learner")
    return jobs.filter(F.col("is_current") == "1").join(idle, "learner", "left_semi").select(
        "learner", "organization_name", "job_title", "start_date"
    )
