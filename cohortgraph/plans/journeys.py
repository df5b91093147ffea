"""Single-learner journeys and the questions asked of both the flat table and the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.functions.cleaning import parse_int
from cohortgraph.functions.rates import asc, desc, mean, round_to, share_of_total, top_k
from cohortgraph.operators.model import Graph
from cohortgraph.plans import graph as G


def j01_graduates(g: Graph) -> DataFrame:
    return g.learner.filter(F.col("current_learning_state") == "Graduate").agg(F.count("*").alias("graduate_count"))


def j01_graduates_flat(raw: DataFrame) -> DataFrame:
    return raw.filter(parse_int(F.col("is_graduate_learner")) == 1).agg(F.count("*").alias("graduate_count"))


def j02_top_countries(g: Graph, limit: int = 10) -> DataFrame:
    """By code, without the country table, so codes unknown to it stay."""
    out = g.learner.filter(F.col("country_of_residence_code").isNotNull()).groupBy(
        F.col("country_of_residence_code").alias("country")
    ).agg(F.count("*").alias("learner_count"))
    return top_k(out, desc("learner_count") + asc("country"), limit)


def j02_top_countries_flat(raw: DataFrame, limit: int = 10) -> DataFrame:
    """By name as it is written."""
    out = raw.filter(F.col("country_of_residence").isNotNull()).groupBy(
        F.col("country_of_residence").alias("country")
    ).agg(F.count("*").alias("learner_count"))
    return top_k(out, desc("learner_count") + asc("country"), limit)


def j03_skill_program_employed(g: Graph, skill: str = "python", limit: int | None = 20) -> DataFrame:
    return G.g35_multi_hop(g, skill, None, limit)


def _employed_flag() -> Column:
    flags = [parse_int(F.col(c)) == 1 for c in ("is_wage_employed", "is_a_freelancer", "is_running_a_venture")]
    return F.coalesce(flags[0] | flags[1] | flags[2], F.lit(False))


def j03_flat(raw: DataFrame, skill: str = "Python", limit: int = 20) -> DataFrame:
    df = raw.filter(
        F.col("skills_list").contains(skill) & F.col("learning_details").isNotNull() & (F.col("learning_details") != "[]")
        & _employed_flag()
    )
    return top_k(df.select("row_ord", "sand_id", "full_name", "skills_list"), asc("row_ord"), limit)


def j04_effective_programs(g: Graph, min_rate: float = 70, min_n: int = 3) -> DataFrame:
    """Programs by enrolments at or above a completion rate."""
    df = g.enrolled_in.filter(F.col("completion_rate") >= min_rate).groupBy("program_id").agg(
        F.count("*").alias("enrollments"), mean(F.col("completion_rate"), 1).alias("avg_completion_rate"),
        mean(F.col("lms_overall_score"), 1).alias("avg_lms_score"),
    ).filter(F.col("enrollments") >= min_n)
    out = df.join(G.program_names(g), "program_id")
    return out.select("program", "program_id", "enrollments", "avg_completion_rate", "avg_lms_score").orderBy(
        *desc("enrollments"), *asc("program_id")
    )


def j04_flat(raw: DataFrame) -> DataFrame:
    df = raw.filter(F.col("learning_details").isNotNull() & ~F.col("learning_details").isin("[]", ""))
    return df.agg(F.count("*").alias("enrollment_count"))


def j05_skill_combos(g: Graph, min_size: int = 3, limit: int = 10) -> DataFrame:
    """Identical skill sets among employed graduates."""
    people = G.learner_attrs(g, "current_learning_state", "current_professional_status").filter(
        (F.col("current_learning_state") == "Graduate")
        & F.col("current_professional_status").isin("Wage Employed", "Freelancer", "Multiple")
    )
    people = people.join(G.employees(g), "learner", "left_semi")
    sets = G.learner_skills(g).join(people.select("learner"), "learner", "left_semi").groupBy("learner").agg(
        F.array_sort(F.collect_set("skill")).alias("skills")
    )
    out = sets.filter(F.size("skills") >= min_size).groupBy("skills").agg(F.count("*").alias("learner_count"))
    out = out.select(F.slice("skills", 1, 5).alias("top_skills"), F.size("skills").alias("total_skills"), "learner_count", "skills")
    return top_k(out, desc("learner_count") + asc("skills"), limit).drop("skills")


def j05_flat(raw: DataFrame, min_commas: int = 2, limit: int = 10) -> DataFrame:
    """Equal skill texts with at least so many commas."""
    commas = F.length("skills_list") - F.length(F.replace(F.col("skills_list"), F.lit(","), F.lit("")))
    df = raw.filter((parse_int(F.col("is_graduate_learner")) == 1) & _employed_flag() & (commas >= min_commas))
    out = df.groupBy("skills_list").agg(F.count("*").alias("learner_count"))
    return top_k(out, desc("learner_count") + asc("skills_list"), limit)


def most_skilled(g: Graph, min_skills: int = 3) -> DataFrame:
    """The learner with most skills, one row."""
    df = G.skill_counts(g).filter(F.col("skills") >= min_skills)
    return top_k(df, desc("skills") + asc("learner"), 1)


def overlap_with(g: Graph, target: DataFrame | str, min_shared: int = 3) -> DataFrame:
    """Learners sharing at least so many skills with the target learner: learner, shared_skills."""
    key = G.learner_key(target)
    wanted = g.has_skill.filter(F.col("learner") == key).select("skill_id")
    shared = g.has_skill.filter(F.col("learner") != key).join(wanted, "skill_id", "left_semi").groupBy("learner").agg(F.count("*").alias("shared_skills"))
    return shared.filter(F.col("shared_skills") >= min_shared)


def j08_similar_learners(g: Graph, min_shared: int = 3, limit: int = 10) -> DataFrame:
    """Learners most similar to the most skilled one, with five shared skills.

    Names are collected for the final ten rows only.
    """
    target = most_skilled(g, min_shared)
    best = top_k(overlap_with(g, target, min_shared), desc("shared_skills") + asc("learner"), limit)
    wanted = G.learner_skills(g).filter(F.col("learner") == G.learner_key(target)).select("skill_id", "skill")
    names = g.has_skill.join(best.select("learner"), "learner", "left_semi").join(wanted, "skill_id").groupBy("learner").agg(
        F.slice(F.array_sort(F.collect_set("skill")), 1, 5).alias("sample_skills")
    )
    df = best.join(names, "learner").join(G.learner_attrs(g, "full_name"), "learner")
    return df.select("learner", "full_name", "shared_skills", "sample_skills").orderBy(*desc("shared_skills"), *asc("learner"))


def j09_recommend_programs(
    g: Graph, min_shared: int = 3, statuses: tuple[str, ...] = S.COMPLETED_STATUSES, min_rate: float = 70, limit: int = 5
) -> DataFrame:
    """Programs that similar learners finished, by how many did and their score."""
    similar = overlap_with(g, most_skilled(g, min_shared), min_shared)
    done = g.enrolled_in.filter(F.col("enrollment_status").isin(*statuses) & (F.col("completion_rate") >= min_rate))
    df = done.join(similar.select("learner"), "learner", "left_semi").groupBy("program_id").agg(
        F.countDistinct("learner").alias("similar_learners_count"), mean(F.col("lms_overall_score"), 1).alias("avg_score")
    )
    out = df.join(G.program_names(g), "program_id").select(
        F.col("program").alias("recommended_program"), "program_id", "similar_learners_count", "avg_score"
    )
    return top_k(out, desc("similar_learners_count", "avg_score") + asc("program_id"), limit)


def j10_country_time_to_job(
    g: Graph, statuses: tuple[str, ...] = S.COMPLETED_STATUSES, within: int = 730, limit: int = 10
) -> DataFrame:
    gaps = G.job_gaps(g, strict=True).filter(F.col("enrollment_status").isin(*statuses) & (F.col("days") <= within))
    people = G.learner_attrs(g, F.col("country_of_residence_code").alias("country")).filter(F.col("country").isNotNull())
    avg = F.avg("days")
    out = gaps.join(people, "learner").groupBy("country").agg(
        F.count("*").alias("sample_size"), round_to(avg, 0).alias("avg_days_to_employment"),
        round_to(avg / F.lit(30.0), 1).alias("avg_months_to_employment"),
    )
    return top_k(out, desc("sample_size") + asc("country"), limit)


def j11_rich_profiles(g: Graph, limit: int = 10) -> DataFrame:
    """Learners by number of distinct skills, programs and companies; each side is counted before joining."""
    programs = g.enrolled_in.groupBy("learner").agg(F.count("*").alias("program_count"))
    companies = g.works_for.groupBy("learner").agg(F.count("*").alias("company_count"))
    df = G.skill_counts(g).withColumnRenamed("skills", "skill_count").join(programs, "learner").join(companies, "learner", "left")
    df = df.withColumn("company_count", F.coalesce("company_count", F.lit(0)))
    df = df.join(G.learner_attrs(g, "full_name", "current_learning_state", "current_professional_status"), "learner")
    df = df.withColumn("score", F.col("skill_count") + F.col("program_count") + F.col("company_count"))
    return top_k(df, desc("score") + asc("learner"), limit).drop("score")


def _nested(df: DataFrame, name: str, *cols: str) -> DataFrame:
    return df.groupBy("learner").agg(F.array_sort(F.collect_set(F.struct(*cols))).alias(name))


def j12_profile(g: Graph, learner: DataFrame | str) -> DataFrame:
    """Nested skills, programs and employment of one learner.

    Edges are cut to the learner before anything is collected and are unique on their end
    points, so the arrays are bounded by the number of skills, programs and companies.
    """
    who = F.col("learner") == G.learner_key(learner)
    skills = G.skill_names(g, category=True)
    s = _nested(g.has_skill.filter(who).join(skills, "skill_id"), "skills", "skill", "category")
    p = _nested(
        g.enrolled_in.filter(who).join(G.program_names(g), "program_id"), "programs",
        "program", "program_id", "enrollment_status", "start_date", "completion_rate", "lms_overall_score",
    )
    e = _nested(
        g.works_for.filter(who).join(G.company_names(g), "company_id"), "employment",
        "company", "position", "start_date", "is_current",
    )
    people = g.learner.withColumnRenamed("hashed_email", "learner").filter(who).select(
        "learner", "full_name", "gender", "country_of_residence_code", "education_level", "current_learning_state",
        "current_professional_status",
    )
    return people.join(s, "learner", "left").join(p, "learner", "left").join(e, "learner", "left")


def j13_timeline(g: Graph, learner: DataFrame | str, limit: int = 10) -> DataFrame:
    """Milestones of a learner: programs, first five current jobs, earliest past job."""
    who = F.col("learner") == G.learner_key(learner)
    programs = g.enrolled_in.filter(who).filter(F.col("start_date").isNotNull()).join(
        G.program_names(g), "program_id"
    ).select("learner", F.col("start_date").alias("date"), F.lit("Program").alias("type"), F.col("program_id").alias("label"),
             F.col("enrollment_status").alias("detail"), F.lit(1).alias("priority"))
    work = G.jobs(g).filter(who).filter(F.col("start_date").isNotNull())
    w = Window.partitionBy("learner", "is_current").orderBy(*asc("start_date", "company_id"))
    ranked = work.withColumn("r", F.row_number().over(w)).filter(
        (F.col("is_current") & (F.col("r") <= 5)) | (~F.col("is_current") & (F.col("r") == 1))
    )
    jobs = ranked.select(
        "learner", F.col("start_date").alias("date"), F.lit("Employment").alias("type"), F.col("position").alias("label"),
        F.col("company").alias("detail"), F.when(F.col("is_current"), 2).otherwise(3).alias("priority"),
    )
    return top_k(programs.unionByName(jobs), asc("learner", "date", "priority", "label", "detail"), limit)


def j14_state_pct(g: Graph) -> DataFrame:
    known = g.learner.filter(F.col("current_learning_state").isNotNull())
    out = share_of_total(known.select(F.col("current_learning_state").alias("state")), ["state"], "learner_count")
    return out.orderBy(*desc("learner_count"), *asc("state"))
