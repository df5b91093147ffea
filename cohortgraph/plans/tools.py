"""Parameterised analytics tools. ``limit`` None gives every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph.functions.rates import asc, desc, pct, round_to, top_k
from cohortgraph.operators.model import Graph
from cohortgraph.plans import graph as G
from cohortgraph.plans.journeys import _nested


def t1_top_countries(g: Graph, limit: int | None = 10) -> DataFrame:
    return G.g01_top_countries(g, limit).select("country", F.col("code").alias("country_code"), "learner_count")


def t2_program_completion(g: Graph, program: str | None = None, limit: int | None = 20) -> DataFrame:
    df = G.enrolments(g)
    if program is not None:
        return G.completion_by(df.filter(F.col("program") == program), ["program"])
    return top_k(G.completion_by(df, ["program"]), desc("completion_rate") + asc("program"), limit)


def t3_employment_rate(g: Graph, program: str | None = None, limit: int | None = 20, min_n: int = 100) -> DataFrame:
    """Learners at a valid company over learners; the size threshold applies only without a program."""
    df = G.enrolments(g).select("learner", "program")
    if program is not None:
        df = df.filter(F.col("program") == program)
    df = G.with_employed_flag(df.distinct(), G.employees(g, only_valid=True))
    out = df.groupBy("program").agg(
        F.count("*").alias("total_learners"), F.count_if("employed").alias("employed_learners")
    ).filter(F.col("employed_learners") > 0)
    out = out.withColumn("employment_rate", pct(F.col("employed_learners"), F.col("total_learners")))
    if program is not None:
        return out
    out = out.filter(F.col("total_learners") > min_n)
    return top_k(out, desc("employment_rate") + asc("program"), limit)


def t4_top_skills(g: Graph, category: str | None = None, limit: int | None = 20) -> DataFrame:
    return G.g09_top_skills(g, limit, category)


def t5_learner_journey(g: Graph, learner: DataFrame | str) -> DataFrame:
    """One learner with place names, skills, programs and jobs at named companies."""
    who = F.col("learner") == G.learner_key(learner)
    skills = G.learner_skills(g).filter(who).groupBy("learner").agg(
        F.array_sort(F.collect_set("skill")).alias("skills")
    )
    programs = _nested(
        G.enrolments(g).filter(who), "programs",
        "program", "enrollment_status", "completion_rate", "lms_overall_score",
    )
    work = _nested(
        G.jobs(g, only_valid=True).filter(who), "employment",
        "company", "position", "is_current", "start_date",
    )
    people = g.learner.withColumnRenamed("hashed_email", "learner").filter(who)
    country = g.country.select(F.col("code").alias("country_of_residence_code"), F.col("name").alias("country_of_residence"))
    city = g.city.select(F.col("id").alias("city_of_residence_id"), F.col("name").alias("city_of_residence"))
    df = people.join(country, "country_of_residence_code", "left").join(city, "city_of_residence_id", "left")
    df = df.select(
        "learner", "full_name", "gender", "education_level", "country_of_residence", "city_of_residence",
        F.col("current_learning_state").alias("learning_state"), F.col("current_professional_status").alias("professional_status"),
    )
    return df.join(skills, "learner", "left").join(programs, "learner", "left").join(work, "learner", "left")


def t6_skills_employed(g: Graph, country: str | None = None, limit: int | None = 20) -> DataFrame:
    people = G.employees(g, only_valid=True)
    if country is not None:
        here = G.learner_attrs(g, "country_of_residence_code").filter(F.col("country_of_residence_code") == country)
        people = people.join(here.select("learner"), "learner", "left_semi")
    counts = g.has_skill.join(people, "learner", "left_semi").groupBy("skill_id").agg(F.count("*").alias("employed_learners_with_skill"))
    out = counts.join(G.skill_names(g), "skill_id").select("skill", "employed_learners_with_skill")
    return top_k(out, desc("employed_learners_with_skill") + asc("skill"), limit)


def t7_geo_distribution(g: Graph, metric: str = "learners", limit: int | None = 20) -> DataFrame:
    """Countries by learners, distinct programs or distinct named companies.

    An unknown metric counts learners under the name ``count``.
    """
    people = G.learner_attrs(g, F.col("country_of_residence_code").alias("country_code")).filter(F.col("country_code").isNotNull())
    if metric == "programs":
        name = "program_count"
        df = g.enrolled_in.select("learner", "program_id").join(people, "learner")
        counts = df.groupBy("country_code").agg(F.countDistinct("program_id").alias(name))
    elif metric == "companies":
        name = "company_count"
        df = G.jobs(g, only_valid=True).select("learner", "company_id").join(people, "learner")
        counts = df.groupBy("country_code").agg(F.countDistinct("company_id").alias(name))
    else:
        name = "learner_count" if metric == "learners" else "count"
        counts = people.groupBy("country_code").agg(F.count("*").alias(name))
    out = G.with_country_name(counts, g).select("country", "country_code", name)
    return top_k(out, desc(name) + asc("country_code"), limit)


def t8_time_to_employment(g: Graph, program: str | None = None, min_n: int = 10, limit: int | None = 20, component: bool = False) -> DataFrame:
    """Days from graduation to jobs at named companies.

    ``component`` keeps only the day part after whole months, as a calendar duration reports it.
    """
    gaps = G.job_gaps(g, only_valid=True)
    if component:
        gaps = gaps.withColumn("days", G.component_days(F.col("graduation_date"), F.col("job_start")))
    gaps = gaps.join(G.program_names(g), "program_id")
    stats = [
        F.count("*").alias("sample_size"), round_to(F.avg("days"), 0).alias("avg_days"),
        round_to(F.percentile("days", F.lit(0.5)), 0).alias("median_days"),
    ]
    if program is not None:
        only = gaps.filter(F.col("program") == program).agg(
            *stats, F.min("days").alias("min_days"), F.max("days").alias("max_days")
        )
        return only.select(F.lit(program).alias("program"), "*")
    out = gaps.groupBy("program").agg(*stats).filter(F.col("sample_size") > min_n)
    return top_k(out, asc("avg_days", "program"), limit)
