"""Graph-pattern questions as joins and aggregates over node and edge tables.

Edges are unique on their end points. Aggregation comes before dimension joins, and
many-to-many patterns are counted from per-learner totals instead of being expanded.
Dimension sides carry no hint: Spark broadcasts them when their measured size allows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.functions.cleaning import valid_company
from cohortgraph.functions.rates import asc, desc, mean, pct, round_to, share_of_total, top_k
from cohortgraph.operators.model import Graph
from cohortgraph.operators.temporal import full_months
from cohortgraph.session import work_folder, work_table

EMPLOYED = ("Wage Employed", "Entrepreneur", "Multiple")
N = F.count


# ---- building blocks -------------------------------------------------------------------------


def program_names(g: Graph) -> DataFrame:
    return g.program.select(F.col("id").alias("program_id"), F.col("name").alias("program"))


def skill_names(g: Graph, category: bool = False) -> DataFrame:
    cols = [F.col("id").alias("skill_id"), F.col("name").alias("skill")]
    return g.skill.select(*cols, *(["category"] if category else []))


def company_names(g: Graph, only_valid: bool = False) -> DataFrame:
    df = g.company.select(
        F.col("id").alias("company_id"), F.col("name").alias("company"), "industry", F.col("country_code").alias("work_country")
    )
    return df.filter(valid_company(F.col("company"))) if only_valid else df


def enrolments(g: Graph) -> DataFrame:
    return g.enrolled_in.join(program_names(g), "program_id")


def jobs(g: Graph, only_valid: bool = False) -> DataFrame:
    return g.works_for.join(company_names(g, only_valid), "company_id")


def learner_skills(g: Graph) -> DataFrame:
    return g.has_skill.join(skill_names(g), "skill_id")


def graduates(g: Graph) -> DataFrame:
    """Distinct learners with a completed enrolment."""
    return g.enrolled_in.filter(F.col("is_completed")).select("learner").distinct()


def employees(g: Graph, only_valid: bool = False) -> DataFrame:
    """Distinct learners with a job edge."""
    edges = g.works_for
    if only_valid:
        edges = edges.join(company_names(g, True).select("company_id"), "company_id", "left_semi")
    return edges.select("learner").distinct()


def learner_attrs(g: Graph, *cols: str) -> DataFrame:
    return g.learner.select(F.col("hashed_email").alias("learner"), *cols)


def with_employed_flag(df: DataFrame, employed: DataFrame) -> DataFrame:
    return df.join(employed.withColumn("employed", F.lit(True)), "learner", "left").withColumn(
        "employed", F.coalesce("employed", F.lit(False))
    )


def distinct_where(cond: Column, value: str = "learner") -> Column:
    return F.countDistinct(F.when(cond, F.col(value)))


def with_country_name(df: DataFrame, g: Graph, code: str = "country_code") -> DataFrame:
    names = g.country.select(F.col("code").alias(code), F.col("name").alias("country"))
    return df.join(names, code)


# ---- geography and demography ----------------------------------------------------------------


def g01_top_countries(g: Graph, limit: int = 10) -> DataFrame:
    codes = g.learner.filter(F.col("country_of_residence_code").isNotNull())
    counts = codes.groupBy(F.col("country_of_residence_code").alias("code")).agg(N("*").alias("learner_count"))
    return top_k(with_country_name(counts, g, "code"), desc("learner_count") + asc("code"), limit)


def g02_program_country_grads(g: Graph, country: str, term: str) -> DataFrame:
    here = g.learner.filter(F.col("country_of_residence_code") == country).select(F.col("hashed_email").alias("learner"))
    programs = g.program.filter(F.col("name").contains(term)).select(F.col("id").alias("program_id"))
    done = g.enrolled_in.filter(F.col("is_completed")).join(programs, "program_id", "left_semi")
    return done.join(here, "learner", "left_semi").agg(F.countDistinct("learner").alias("graduates"))


def g03_gender_country(g: Graph, codes: list[str]) -> DataFrame:
    """Countries by gender, one column per gender, zero where none."""
    df = g.learner.filter(F.col("country_of_residence_code").isin(codes) & F.col("gender").isNotNull())
    labels = {"male": "male", "female": "female", S.OTHER_GENDER: "other"}
    df = df.select(F.col("country_of_residence_code").alias("code"), "gender")
    wide = df.groupBy("code").agg(*[F.count_if(F.col("gender") == k).alias(v) for k, v in labels.items()])
    return with_country_name(wide, g, "code").select("country", *labels.values()).orderBy("country")


def g03_gender_country_long(g: Graph, codes: list[str]) -> DataFrame:
    df = g.learner.filter(F.col("country_of_residence_code").isin(codes) & F.col("gender").isNotNull())
    counts = df.groupBy(F.col("country_of_residence_code").alias("code"), "gender").agg(N("*").alias("n"))
    return with_country_name(counts, g, "code").select("country", "gender", "n").orderBy(*asc("country"), *desc("n"), *asc("gender"))


def g04_top_cities(g: Graph, limit: int = 10) -> DataFrame:
    known = g.learner.filter(F.col("city_of_residence_id").isNotNull())
    counts = known.groupBy(F.col("city_of_residence_id").alias("id")).agg(N("*").alias("learner_count"))
    city = g.city.select("id", F.col("name").alias("city"), F.col("country_code").alias("country"))
    return top_k(counts.join(city, "id"), desc("learner_count") + asc("id"), limit).select("city", "country", "learner_count")


def g41_rural(g: Graph, country: str) -> DataFrame:
    df = g.learner.filter((F.col("country_of_residence_code") == country) & F.col("is_rural"))
    return df.agg(N("*").alias("learners"))


def g42_single(g: Graph, **equal: str) -> DataFrame:
    """Count of learners by exact property values."""
    cond = reduce(lambda a, b: a & b, [F.col(k) == v for k, v in equal.items()])
    return g.learner.filter(cond).agg(N("*").alias("learners"))


def g44_region_rollup(g: Graph) -> DataFrame:
    """Learners per region and country with subtotals; needs a ``region`` column on the country table."""
    counts = g.learner.groupBy(F.col("country_of_residence_code").alias("code")).agg(N("*").alias("n"))
    df = counts.join(g.country.select("code", "region", F.col("name").alias("country")), "code")
    out = df.rollup("region", "country").agg(F.sum("n").alias("learners"), F.grouping_id().alias("level"))
    return out.select("region", "country", F.col("level").cast("int").alias("level"), "learners")


# ---- programs --------------------------------------------------------------------------------


def g05_enrolments(g: Graph, limit: int = 15) -> DataFrame:
    counts = g.enrolled_in.groupBy("program_id").agg(N("*").alias("enrollments"))
    out = counts.join(program_names(g), "program_id").select("program", F.col("program_id").alias("cohort"), "enrollments")
    return top_k(out, desc("enrollments") + asc("cohort"), limit)


def completion_by(df: DataFrame, keys: list[str], total: str = "total_enrolled") -> DataFrame:
    out = df.groupBy(*keys).agg(
        N("*").alias(total), F.count_if("is_completed").alias("completed"), F.count_if("is_dropped").alias("dropped_out")
    )
    return out.withColumns(
        {
            "completion_rate": pct(F.col("completed"), F.col(total)),
            "dropout_rate": pct(F.col("dropped_out"), F.col(total)),
        }
    )


def g06_completion(g: Graph, min_n: int = 1000, limit: int = 10) -> DataFrame:
    out = completion_by(enrolments(g), ["program"]).filter(F.col("total_enrolled") > min_n)
    return top_k(out, desc("completion_rate") + asc("program"), limit)


def g06_completion_by_cohort(g: Graph) -> DataFrame:
    out = completion_by(g.enrolled_in, ["program_id"], "total").join(program_names(g), "program_id")
    out = out.select(
        "program", F.col("program_id").alias("cohort"), "total",
        F.col("completion_rate").alias("completion_percentage"), F.col("dropout_rate").alias("dropout_percentage"),
    )
    return out.orderBy(*desc("total"), *asc("cohort"))


def g07_lms(g: Graph, min_n: int = 500, limit: int = 10, null_as_zero: bool = False) -> DataFrame:
    score, rate = F.col("lms_overall_score"), F.col("completion_rate")
    df = enrolments(g)
    if null_as_zero:
        score, rate = F.coalesce(score, F.lit(0.0)), F.coalesce(rate, F.lit(0.0))
    else:
        df = df.filter(score.isNotNull())
    out = df.groupBy("program").agg(
        N("*").alias("learner_count"), mean(score).alias("avg_lms_score"), mean(rate).alias("avg_completion_rate")
    ).filter(F.col("learner_count") > min_n)
    return top_k(out, desc("avg_lms_score") + asc("program"), limit)


def g08_status_dist(g: Graph) -> DataFrame:
    low = F.lower("enrollment_status")
    status = F.col("enrollment_status")
    for name in ("Dropped Out", "Enrolled", "Graduated", "Active"):
        status = F.when(low == name.lower(), F.lit(name)).otherwise(status)
    out = g.enrolled_in.groupBy(status.alias("status")).agg(N("*").alias("n"))
    return out.orderBy(*desc("n"), *asc("status"))


def g31_duration(g: Graph, min_n: int = 100, limit: int = 10) -> DataFrame:
    df = enrolments(g).filter(F.col("duration").isNotNull())
    out = df.groupBy("program").agg(
        N("*").alias("enrollment_count"), mean(F.col("duration"), 0).alias("avg_duration_days"),
        round_to(F.avg("duration") / F.lit(30.0), 1).alias("avg_duration_months"),
        F.min("duration").alias("min_days"), F.max("duration").alias("max_days"),
    ).filter(F.col("enrollment_count") > min_n)
    return top_k(out, desc("avg_duration_days") + asc("program"), limit)


def g37_avg_completion(g: Graph, limit: int = 5) -> DataFrame:
    out = enrolments(g).groupBy("program").agg(
        mean(F.col("completion_rate")).alias("completion_rate"), N("*").alias("enrollments")
    ).filter(F.col("completion_rate").isNotNull())
    return top_k(out, desc("completion_rate") + asc("program"), limit)


def g45_program_country_learners(g: Graph, term: str, country: str) -> DataFrame:
    here = g.learner.filter(F.col("country_of_residence_code") == country).select(F.col("hashed_email").alias("learner"))
    programs = program_names(g).filter(F.lower("program").contains(term.lower()))
    df = g.enrolled_in.join(programs, "program_id").join(here, "learner", "left_semi")
    out = df.groupBy("program").agg(F.countDistinct("learner").alias("learners"))
    return out.orderBy(*desc("learners"), *asc("program"))


# ---- skills ----------------------------------------------------------------------------------


def g09_top_skills(g: Graph, limit: int = 20, category: str | None = None) -> DataFrame:
    dim = skill_names(g, category=True)
    edges = g.has_skill
    if category is not None:
        dim = dim.filter(F.col("category") == category)
        edges = edges.join(dim.select("skill_id"), "skill_id", "left_semi")
    counts = edges.groupBy("skill_id").agg(N("*").alias("learner_count"))
    out = counts.join(dim, "skill_id").select("skill", "category", "learner_count")
    return top_k(out, desc("learner_count") + asc("skill"), limit)


def g10_skills_by_program(g: Graph, term: str, limit: int = 15) -> DataFrame:
    programs = program_names(g).filter(F.col("program").contains(term)).select("program_id")
    members = g.enrolled_in.join(programs, "program_id", "left_semi").select("learner").distinct()
    counts = g.has_skill.join(members, "learner", "left_semi").groupBy("skill_id").agg(N("*").alias("learner_count"))
    out = counts.join(skill_names(g), "skill_id").select("skill", "learner_count")
    return top_k(out, desc("learner_count") + asc("skill"), limit)


def g11_skill_pair_filter(g: Graph, names: list[str], terms: list[str]) -> DataFrame:
    """Learners with one of the named skills and a skill containing one of the terms: one pass over the edges."""
    a = F.col("skill").isin(names)
    b = reduce(lambda x, y: x | y, [F.col("skill").contains(t) for t in terms])
    df = learner_skills(g).filter(a | b).groupBy("learner").agg(F.bool_or(a).alias("a"), F.bool_or(b).alias("b"))
    return df.filter(F.col("a") & F.col("b")).agg(N("*").alias("learners"))


def skill_counts(g: Graph) -> DataFrame:
    return g.has_skill.groupBy("learner").agg(N("*").alias("skills"))


def g12_avg_skills(g: Graph, min_n: int = 1000, limit: int = 10) -> DataFrame:
    """Average skills per learner and program, learners without skills included."""
    pairs = enrolments(g).groupBy("learner", "program").agg(N("*").alias("cohorts"))
    df = pairs.join(skill_counts(g), "learner", "left")
    out = df.groupBy("program").agg(
        N("*").alias("learner_count"), mean(F.col("cohorts") * F.coalesce("skills", F.lit(0))).alias("avg_skills_per_learner")
    ).filter(F.col("learner_count") > min_n)
    return top_k(out, desc("avg_skills_per_learner") + asc("program"), limit)


def skill_employment(g: Graph) -> DataFrame:
    """Per skill name: holders and holders with a job."""
    flagged = with_employed_flag(g.has_skill, employees(g)).join(skill_names(g), "skill_id")
    out = flagged.groupBy("skill").agg(
        F.countDistinct("learner").alias("total_with_skill"), distinct_where(F.col("employed")).alias("employed_with_skill")
    ).filter(F.col("employed_with_skill") > 0)
    return out.withColumn("employment_rate", pct(F.col("employed_with_skill"), F.col("total_with_skill")))


def g20_skill_rate(g: Graph, min_n: int = 1000, limit: int = 15) -> DataFrame:
    out = skill_employment(g).filter(F.col("total_with_skill") > min_n)
    return top_k(out, desc("employment_rate") + asc("skill"), limit)


def g22_rare_skills(g: Graph, low: int = 50, high: int = 500, rate: float = 80.0, limit: int = 15) -> DataFrame:
    out = skill_employment(g).filter(
        F.col("total_with_skill").between(low, high) & (F.col("employment_rate") >= rate)
    )
    return top_k(out, desc("employment_rate", "total_with_skill") + asc("skill"), limit)


def g24_skills_gap(g: Graph, min_n: int = 100, limit: int = 20) -> DataFrame:
    """Employed and unemployed graduates per skill; both must occur."""
    status = F.col("current_professional_status")
    people = learner_attrs(g, "current_professional_status").filter(status.isin(*EMPLOYED, "Unemployed"))
    people = people.join(graduates(g), "learner", "left_semi")
    df = g.has_skill.join(people, "learner").join(skill_names(g), "skill_id")
    out = df.groupBy("skill").agg(
        distinct_where(status != "Unemployed").alias("employed_with_skill"),
        distinct_where(status == "Unemployed").alias("unemployed_with_skill"),
    ).filter((F.col("employed_with_skill") > 0) & (F.col("unemployed_with_skill") > 0))
    out = out.withColumn("total_grads_with_skill", F.col("employed_with_skill") + F.col("unemployed_with_skill"))
    out = out.filter(F.col("total_grads_with_skill") > min_n)
    out = out.withColumn("employment_rate", pct(F.col("employed_with_skill"), F.col("total_grads_with_skill")))
    return top_k(out, desc("employment_rate") + asc("skill"), limit)


#: Skills that share a learner's bit mask, and skills of one learner that are paired in one place.
HEAVY, TILE = 63, 64


def skill_pairs(learner_skill: DataFrame, skill: str, top: int | None = None, heavy: int = HEAVY, tile: int = TILE) -> DataFrame:
    """Co-occurrence counts of skill pairs: a heavy-light split of the product of the sparse learner-skill matrix.

    The ``heavy`` most frequent skills of a learner are one bit mask; equal masks are merged and weighted, and
    only different masks are expanded, to a bounded number of pairs. Pairs with another skill are made per
    learner; a learner with many skills is dealt out in tiles of ``tile`` skills, each pair of tiles a group of
    its own, and equal groups are merged and weighted before they are expanded. So no task expands more than
    two tiles at a time, however many skills a learner has. With ``top``, other skills than the heavy ones that
    are less frequent than the ``top``-th pair of heavy ones are left out, as their pairs cannot be more frequent.
    """
    held = work_table(learner_skill.select("learner", F.col(skill).alias("skill")).distinct(), "skill-pairs")
    counts = held.groupBy("skill").agg(N("*").alias("n"))
    ranked = [r.skill for r in top_k(counts, desc("n") + asc("skill"), heavy + 1).collect()]
    common = sorted(ranked[:heavy])
    if not common:
        return held.select(F.col("skill").alias("skill1"), F.col("skill").alias("skill2"), F.lit(0).cast("long").alias("co_occurrence")).limit(0)
    names = F.array(*[F.lit(x) for x in common])
    bit = F.array_position(names, F.col("skill"))  # 0 for the others, else from 1 in the order of the names
    marks = held.withColumn("bit", bit)
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") - 1).cast("int")))
    masks = marks.filter("bit > 0").groupBy("learner").agg(mask.alias("mask")).groupBy("mask").agg(N("*").alias("w")).filter(F.bit_count("mask") > 1)
    bits = F.filter(F.sequence(F.lit(1), F.lit(len(common))), lambda i: F.call_function("shiftright", F.col("mask"), (i - 1).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)
    first = masks.select("w", bits.alias("bits")).select("w", "bits", F.posexplode("bits").alias("at", "b1"))
    second = first.select("w", "b1", F.explode(F.slice("bits", F.col("at") + 2, F.size("bits"))).alias("b2"))
    both_heavy = second.groupBy("b1", "b2").agg(F.sum("w").alias("co_occurrence"))
    both_heavy = both_heavy.select(F.element_at(names, F.col("b1")).alias("skill1"), F.element_at(names, F.col("b2")).alias("skill2"), "co_occurrence")
    if len(ranked) <= heavy:
        return both_heavy
    both_heavy = work_table(both_heavy, "skill-pairs")

    others = counts.filter(~F.col("skill").isin(*common))
    if top is not None:
        least = both_heavy.agg(F.get(F.sort_array(F.collect_list("co_occurrence"), asc=False), F.lit(top - 1))).first()[0]  # heavy * heavy / 2 rows
        others = others.filter(F.col("n") >= (least or 0))
    others = work_table(others.select(F.col("skill").alias("_other")), "skill-light")
    light = marks.join(others, F.col("skill") == F.col("_other"), "left").filter("bit > 0 OR _other IS NOT NULL").select("learner", "skill", F.col("_other").isNotNull().alias("light"))
    sizes = work_table(light.groupBy("learner").agg(N("*").alias("n"), F.count_if("light").alias("light_n")).filter("light_n > 0 AND n > 1").select(
        F.col("learner").alias("_learner"), F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "skill-sizes")
    dealt = light.join(sizes, F.col("learner") == F.col("_learner")).withColumn("t", F.pmod(F.xxhash64("skill"), F.col("tiles")).cast("int"))
    dealt = dealt.select("learner", "skill", "light", "t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o")).select(
        "learner", F.least("t", "o").alias("a"), F.greatest("t", "o").alias("b"), F.struct("skill", "light", (F.col("t") > F.col("o")).alias("second")).alias("s"))
    groups = dealt.groupBy("learner", "a", "b").agg(F.sort_array(F.collect_list("s")).alias("set")).groupBy("set", (F.col("a") == F.col("b")).alias("own")).agg(N("*").alias("w"))
    one = groups.select("w", "own", "set", F.posexplode("set").alias("at", "x"))
    two = one.select("w", "own", "x", F.explode(F.slice("set", F.col("at") + 2, F.size("set"))).alias("y"))
    two = two.filter((F.col("x.light") | F.col("y.light")) & (F.col("own") | (F.col("x.second") != F.col("y.second"))))
    with_light = two.groupBy(F.col("x.skill").alias("skill1"), F.col("y.skill").alias("skill2")).agg(F.sum("w").alias("co_occurrence"))
    return both_heavy.unionByName(with_light)


def g28_skill_cooccurrence(g: Graph, min_n: int = 100, limit: int = 20) -> DataFrame:
    """Pairs among employed learners."""
    held = g.has_skill.join(employees(g), "learner", "left_semi").select("learner", "skill_id").distinct()
    frequent = held.groupBy("skill_id").agg(N("*").alias("n")).filter(F.col("n") > min_n)  # a pair is no more frequent than its skills
    held = held.join(frequent, "skill_id", "left_semi")
    pairs = skill_pairs(held, "skill_id").filter(F.col("co_occurrence") > min_n)
    names = g.skill.select("id", "name")
    out = (
        pairs.join(names.select(F.col("id").alias("skill1"), F.col("name").alias("name1")), "skill1")
        .join(names.select(F.col("id").alias("skill2"), F.col("name").alias("name2")), "skill2")
        .select(F.col("name1").alias("skill1"), F.col("name2").alias("skill2"), "co_occurrence")
    )
    return top_k(out, desc("co_occurrence") + asc("skill1", "skill2"), limit)


def g28_cooccurrence_all(g: Graph, limit: int = 15) -> DataFrame:
    """Pairs by name among all learners."""
    out = skill_pairs(learner_skills(g), "skill", top=limit)
    return top_k(out, desc("co_occurrence") + asc("skill1", "skill2"), limit)


def g36_program_skills_sample(g: Graph, n: int = 5, limit: int | None = 5) -> DataFrame:
    """First ``n`` skill names per learner, for every learner and program."""
    top = first_skills(g, n)
    df = enrolments(g).select("learner", "program_id", "program").join(top, "learner")
    df = df.join(learner_attrs(g, "full_name"), "learner")
    out = df.select("learner", "full_name", "program", "program_id", "skills")
    return top_k(out, asc("learner", "program_id"), limit)


def first_skills(g: Graph, n: int) -> DataFrame:
    """First ``n`` skill names per learner in alphabetical order; Spark keeps ``n`` rows per learner before the shuffle."""
    w = Window.partitionBy("learner").orderBy("skill")
    kept = learner_skills(g).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= n)
    return kept.groupBy("learner").agg(F.array_sort(F.collect_list("skill")).alias("skills"))


def g38_company_regex_skills(g: Graph, pattern: str = "(tech|software|digital)", industry: str | None = None, limit: int = 10) -> DataFrame:
    """Skills of people at companies whose name matches; one count per (job, skill)."""
    hit = F.col("company").rlike("(?i)" + pattern)
    if industry is not None:
        hit = hit | (F.col("industry") == industry)
    at = g.works_for.join(company_names(g).filter(hit), "company_id").groupBy("learner").agg(N("*").alias("w"))
    df = g.has_skill.join(at, "learner").groupBy("skill_id").agg(F.sum("w").alias("learner_count"))
    out = df.join(skill_names(g), "skill_id").select("skill", "learner_count")
    return top_k(out, desc("learner_count") + asc("skill"), limit)


# ---- current states --------------------------------------------------------------------------


def state_dist(g: Graph, column: str, name: str) -> DataFrame:
    df = g.learner.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias(name)).agg(N("*").alias("learner_count"))
    return df.orderBy(*desc("learner_count"), *asc(name))


def g13_learning_dist(g: Graph) -> DataFrame:
    return state_dist(g, "current_learning_state", "state")


def g14_prof_dist(g: Graph) -> DataFrame:
    return state_dist(g, "current_professional_status", "status")


def g15_state_country(g: Graph, codes: list[str]) -> DataFrame:
    """Countries by learning state, one column per state."""
    df = g.learner.filter(F.col("country_of_residence_code").isin(codes) & F.col("current_learning_state").isNotNull())
    df = df.select(F.col("country_of_residence_code").alias("code"), "current_learning_state")
    wide = df.groupBy("code").pivot("current_learning_state", list(S.LEARNING_STATES)).agg(N(F.lit(1)))
    cols = [F.coalesce(F.col(s), F.lit(0)).alias(s.lower().replace(" ", "_")) for s in S.LEARNING_STATES]
    return with_country_name(wide, g, "code").select("country", *cols).orderBy("country")


def g16_status_pct(g: Graph) -> DataFrame:
    known = g.learner.filter(F.col("current_professional_status").isNotNull())
    out = share_of_total(known.select(F.col("current_professional_status").alias("status")), ["status"], "learner_count")
    return out.orderBy(*desc("learner_count"), *asc("status"))


# ---- employment ------------------------------------------------------------------------------


def g17_employers(g: Graph, limit: int = 20, only_valid: bool = False, country: str | None = None) -> DataFrame:
    """Companies by employees, raw or without placeholder names, optionally for residents of a country."""
    edges = g.works_for
    if country is not None:
        here = learner_attrs(g, "country_of_residence_code").filter(F.col("country_of_residence_code") == country)
        edges = edges.join(here.select("learner"), "learner", "left_semi")
    counts = edges.groupBy("company_id").agg(N("*").alias("employee_count"))
    out = counts.join(company_names(g, only_valid), "company_id").select("company", "industry", "employee_count")
    return top_k(out, desc("employee_count") + asc("company"), limit)


def g17_employers_distinct(g: Graph, limit: int = 10) -> DataFrame:
    out = jobs(g).groupBy("company").agg(F.countDistinct("learner").alias("learner_count"))
    return top_k(out, desc("learner_count") + asc("company"), limit)


def g18_emp_by_program(g: Graph, min_n: int = 1000, limit: int = 10) -> DataFrame:
    """Distinct employed learners over enrolments."""
    df = with_employed_flag(enrolments(g).select("learner", "program"), employees(g))
    out = df.groupBy("program").agg(
        N("*").alias("total_learners"), distinct_where(F.col("employed")).alias("employed_learners")
    ).filter((F.col("total_learners") > min_n) & (F.col("employed_learners") > 0))
    out = out.withColumn("employment_rate", pct(F.col("employed_learners"), F.col("total_learners")))
    return top_k(out, desc("employment_rate") + asc("program"), limit)


def g19_grad_outcomes(g: Graph, codes: list[str]) -> DataFrame:
    """Graduates per country beside enrolled learners with a job and an employed status (not only graduates)."""
    per_learner = g.enrolled_in.groupBy("learner").agg(F.bool_or("is_completed").alias("graduate"))
    people = learner_attrs(g, "country_of_residence_code", "current_professional_status").filter(
        F.col("country_of_residence_code").isin(codes)
    ).join(per_learner, "learner")
    people = with_employed_flag(people, employees(g))
    out = people.groupBy(F.col("country_of_residence_code").alias("code")).agg(
        F.count_if("graduate").alias("total_grads"),
        F.count_if(F.col("employed") & F.col("current_professional_status").isin(*EMPLOYED)).alias("employed_grads"),
    ).filter((F.col("total_grads") > 0) & (F.col("employed_grads") > 0))
    out = out.withColumn("employment_rate", pct(F.col("employed_grads"), F.col("total_grads")))
    out = with_country_name(out, g, "code").select("country", "total_grads", "employed_grads", "employment_rate")
    return out.orderBy(*desc("employment_rate"), *asc("country"))


def g21_high_impact(g: Graph) -> DataFrame:
    people = learner_attrs(g, "current_professional_status").filter(
        F.col("current_professional_status").isin("Entrepreneur", "Multiple")
    )
    df = people.join(graduates(g), "learner", "left_semi").join(employees(g), "learner", "left_semi")
    return df.agg(N("*").alias("high_impact_learners"))


def g23_program_industry(g: Graph, min_n: int = 500, min_share: float = 5.0) -> DataFrame:
    work = g.works_for.join(company_names(g).filter(F.col("industry").isNotNull()), "company_id").select("learner", "industry").distinct()
    df = enrolments(g).select("learner", "program").distinct().join(work, "learner")
    counts = df.groupBy("program", "industry").agg(N("*").alias("learner_count"))
    whole = F.sum("learner_count").over(Window.partitionBy("program"))
    out = counts.withColumn("program_total", whole).filter(F.col("program_total") > min_n)
    out = out.withColumn("industry_share", pct(F.col("learner_count"), F.col("program_total")))
    out = out.filter(F.col("industry_share") >= min_share).drop("program_total")
    return out.orderBy(*asc("program"), *desc("industry_share"), *asc("industry"))


def g25_success_factors(g: Graph) -> DataFrame:
    """Employed graduates beside dropouts.

    The pattern repeats an enrolment once per job and skill; here the repetition is a weight.
    """
    work = g.works_for.groupBy("learner").agg(N("*").alias("jobs"))
    cols = ["learner", "lms_overall_score", "completion_rate"]

    def summary(df: DataFrame, category: str) -> DataFrame:
        skills = F.coalesce("skills", F.lit(0))
        w = F.col("w") * F.greatest(skills, F.lit(1))

        def weighted(c: Column) -> Column:
            return round_to(F.sum(c * w) / F.sum(F.when(c.isNotNull(), w)).cast("double"), 2)

        return df.join(skill_counts(g), "learner", "left").agg(
            F.lit(category).alias("category"),
            F.countDistinct("learner").alias("learner_count"),
            weighted(F.col("lms_overall_score")).alias("avg_lms_score"),
            weighted(F.col("completion_rate")).alias("avg_completion_rate"),
            weighted(skills.cast("double")).alias("avg_skill_count"),
        )

    grads = g.enrolled_in.filter("is_completed").select(*cols).join(work, "learner").withColumnRenamed("jobs", "w")
    drops = g.enrolled_in.filter("is_dropped").select(*cols).withColumn("w", F.lit(1))
    out = summary(grads, "Employed Graduate").unionByName(summary(drops, "Dropout"))
    return out.orderBy(F.col("category").desc())


def g26_peer_pairs(g: Graph, min_pairs: int = 10, limit: int = 20) -> DataFrame:
    """Pairs of learners of one cohort at one company: n(n-1)/2 of the group size, no pair is made."""
    both = g.enrolled_in.select("learner", "program_id").join(g.works_for.select("learner", "company_id"), "learner")
    sizes = both.groupBy("program_id", "company_id").agg(N("*").alias("n"))
    pairs = sizes.withColumn("peer_pairs", F.expr("n * (n - 1) div 2")).filter(F.col("peer_pairs") >= max(min_pairs, 1))
    named = pairs.join(program_names(g), "program_id").join(company_names(g), "company_id")
    out = named.select("program", F.col("program_id").alias("cohort"), "company", "peer_pairs")
    return top_k(out, desc("peer_pairs") + asc("cohort", "company"), limit)


def g27_program_to_company(g: Graph, min_n: int = 50, limit: int = 25) -> DataFrame:
    """Distinct hires per program and company."""
    member = enrolments(g).select("learner", "program").distinct()
    out = member.join(jobs(g).select("learner", "company").distinct(), "learner").groupBy("program", "company").agg(
        N("*").alias("hire_count")
    )
    return top_k(out.filter(F.col("hire_count") >= min_n), desc("hire_count") + asc("program", "company"), limit)


def g29_mobility(g: Graph, limit: int = 15) -> DataFrame:
    """Flows from origin to work country with the residence deciding the kind."""
    people = learner_attrs(g, "country_of_origin_code", "country_of_residence_code").filter(
        F.col("country_of_origin_code").isNotNull() & F.col("country_of_residence_code").isNotNull()
    )
    work = g.works_for.join(company_names(g).filter(F.col("work_country").isNotNull()), "company_id")
    work = work.groupBy("learner", "work_country").agg(N("*").alias("n"))
    origin, residence, target = (F.col(c) for c in ("country_of_origin_code", "country_of_residence_code", "work_country"))
    flows = people.join(work, "learner").filter(origin != target).groupBy(
        origin.alias("origin"), residence.alias("residence"), target.alias("work")
    ).agg(F.sum("n").alias("learner_count"))
    names = g.country.select("code", "name")
    kind = (
        F.when(F.col("origin") == F.col("residence"), "Relocated for work")
        .when(F.col("residence") == F.col("work"), "Already relocated, now working")
        .otherwise("Complex mobility")
    )
    out = (
        flows.join(names.select(F.col("code").alias("origin"), F.col("name").alias("origin_country")), "origin")
        .join(names.select(F.col("code").alias("work"), F.col("name").alias("work_country")), "work")
        .withColumn("mobility_type", kind)
    )
    order = desc("learner_count") + asc("origin", "work", "residence")
    return top_k(out, order, limit).select("origin_country", "work_country", "residence", "learner_count", "mobility_type")


def g30_journey_paths(g: Graph, n: int = 5, limit: int = 20) -> DataFrame:
    """Program, first skills and industry of employed graduates."""
    people = learner_attrs(g, "current_learning_state", "current_professional_status").filter(
        (F.col("current_learning_state") == "Graduate")
        & F.col("current_professional_status").isin("Wage Employed", "Entrepreneur")
    ).select("learner")
    skills = first_skills(g, n).join(people, "learner", "left_semi")
    member = enrolments(g).select("learner", "program").distinct()
    work = jobs(g).select("learner", "company", "industry").distinct()
    df = skills.join(member, "learner").join(work, "learner")
    out = df.groupBy("program", F.col("skills").alias("top_skills"), "industry").agg(N("*").alias("learner_count"))
    return top_k(out, desc("learner_count") + asc("program", "top_skills", "industry"), limit)


def job_gaps(g: Graph, only_valid: bool = False, strict: bool = False) -> DataFrame:
    """Days from graduation to each later job start, with learner and program.

    Total days; see ``component`` for the day part after whole months.
    """
    done = g.enrolled_in.filter(F.col("graduation_date").isNotNull()).select(
        "learner", "program_id", "enrollment_status", "graduation_date"
    )
    edges = g.works_for
    if only_valid:
        edges = edges.join(company_names(g, True).select("company_id"), "company_id", "left_semi")
    starts = edges.filter(F.col("start_date").isNotNull()).select("learner", F.col("start_date").alias("job_start"))
    later = F.col("job_start") > F.col("graduation_date") if strict else F.col("job_start") >= F.col("graduation_date")
    df = done.join(starts, "learner").filter(later)
    return df.withColumn("days", F.datediff("job_start", "graduation_date"))


def component_days(start: Column, end: Column) -> Column:
    """Day component left after whole months, as a calendar duration reports it."""
    return F.datediff(end, F.add_months(start, full_months(start, end)))


def gap_stats(df: DataFrame, keys: list[str], total: str = "total_transitions") -> DataFrame:
    """Exact statistics of whole-day gaps; the percentile state is bounded by the day range."""
    avg = F.avg("days")
    return df.groupBy(*keys).agg(
        N("*").alias(total), round_to(avg, 0).alias("avg_days"), round_to(avg / F.lit(30.0), 1).alias("avg_months"),
        F.min("days").alias("min_days"), F.max("days").alias("max_days"), F.percentile("days", F.lit(0.5)).alias("median_days"),
    )


def g32_time_to_job(g: Graph, within: int = 730) -> DataFrame:
    return gap_stats(job_gaps(g).filter(F.col("days") < within), [])


def g32_time_to_job_by_program(g: Graph, within: int = 730, min_n: int = 100, limit: int = 15) -> DataFrame:
    df = job_gaps(g).filter(F.col("days") < within).join(program_names(g), "program_id")
    out = gap_stats(df, ["program"]).filter(F.col("total_transitions") >= min_n)
    return top_k(out, asc("avg_days", "program"), limit)


def g33_retention(g: Graph) -> DataFrame:
    out = g.works_for.filter(F.col("is_current").isNotNull()).groupBy(F.col("is_current").alias("currently_employed")).agg(
        N("*").alias("employment_records"), F.countDistinct("learner").alias("unique_learners")
    )
    return out.orderBy(F.col("currently_employed").desc())


def g33_retention_rate(g: Graph) -> DataFrame:
    row = g33_retention(g).agg(
        F.sum(F.when(F.col("currently_employed"), F.col("unique_learners"))).alias("current"),
        F.sum("unique_learners").alias("whole"),
    )
    return row.select(pct(F.col("current"), F.col("whole")).alias("retention_rate"))


def g40_latest_jobs(g: Graph, limit: int = 10) -> DataFrame:
    latest = top_k(
        g.works_for.filter(F.col("start_date").isNotNull()), desc("start_date") + asc("learner", "company_id"), limit
    )
    df = latest.join(company_names(g), "company_id").join(learner_attrs(g, "full_name"), "learner")
    return df.select("learner", "full_name", "company", "position", "start_date", "is_current").orderBy(
        *desc("start_date"), *asc("learner", "company")
    )


# ---- multi-hop -------------------------------------------------------------------------------


def g35_multi_hop(g: Graph, skill: str = "python", program: str | None = "data", limit: int | None = 10) -> DataFrame:
    """Skill, program and company of learners whose skill and program names match.

    The patterns are applied to the small name tables before any edge join.
    """
    skills = g.has_skill.join(skill_names(g).filter(F.col("skill").rlike(f"(?i).*{skill}.*")), "skill_id").select("learner", "skill")
    programs = program_names(g)
    if program is not None:
        programs = programs.filter(F.col("program").rlike(f"(?i).*{program}.*"))
    member = g.enrolled_in.join(programs, "program_id").select("learner", "program_id", "program")
    work, people = jobs(g).select("learner", "company"), learner_attrs(g, "full_name")
    if limit is not None:  # the order begins with the learner: the first learners that have all sides are enough
        first = people.select("learner")
        for side in (skills, member, work):
            first = first.join(side, "learner", "left_semi")
        people = people.join(top_k(first, asc("learner"), limit), "learner", "left_semi")
        skills, member, work = (side.join(people, "learner", "left_semi") for side in (skills, member, work))
    df = skills.join(member, "learner").join(work, "learner").join(people, "learner")
    out = df.select("learner", "full_name", "skill", "program", "program_id", "company")
    return top_k(out, asc("learner", "skill", "program_id", "company"), limit)


def node_edges(g: Graph) -> DataFrame:
    """All edges as (src, dst, kind) with kind-prefixed node ids."""
    def side(df: DataFrame, key: str, prefix: str, kind: str) -> DataFrame:
        return df.select(
            F.concat(F.lit("learner:"), "learner").alias("src"), F.concat(F.lit(prefix), key).alias("dst"), F.lit(kind).alias("kind")
        )

    return (
        side(g.has_skill, "skill_id", "skill:", "HAS_SKILL")
        .unionByName(side(g.enrolled_in, "program_id", "program:", "ENROLLED_IN"))
        .unionByName(side(g.works_for, "company_id", "company:", "WORKS_FOR"))
    )


def learner_key(learner: DataFrame | str) -> Column:
    """One learner's key: given, or the single row of a table as a scalar subquery that all its uses share."""
    return F.lit(learner) if isinstance(learner, str) else learner.select("learner").scalar()


def g34_neighbourhood(g: Graph, learner: DataFrame | str) -> DataFrame:
    """Everything one edge away from the learner; the filter reaches each edge scan."""
    start = learner_key(learner)
    out = None
    for df, key, kind in (
        (g.has_skill, "skill_id", "HAS_SKILL"), (g.enrolled_in, "program_id", "ENROLLED_IN"), (g.works_for, "company_id", "WORKS_FOR"),
    ):
        one = df.select("learner", F.col(key).alias("node"), F.lit(kind).alias("kind")).filter(F.col("learner") == start)
        out = one if out is None else out.unionByName(one)
    return out


def _both_ways(edges: DataFrame) -> DataFrame:
    """Edges in both directions, stored by source once for all hops."""
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return work_table(both, "walk-edges")


def reachable(edges: DataFrame, start: DataFrame, depth: int | None = None, sides: bool = False) -> DataFrame:
    """Nodes within ``depth`` undirected hops of ``start`` (column ``node``) with their distance; None: all there are.

    Breadth first: per hop the edges that meet the frontier, a distinct and an anti-join with what was seen. Edges
    are stored once, as they are, and followed from either end; repeated ones do no harm. Each frontier is stored, so
    a hop's plan does not grow. Nodes, not paths, are carried, so hubs do not multiply rows. Any type that joins serves as node.
    ``sides``: no node is both a source and a destination, so nodes found at one end are followed from that end only
    and the edges are not searched for them from the other.
    """
    spark, path = start.sparkSession, work_folder(start.sparkSession, "walk-seen")
    stored = work_table(edges.select("src", "dst").filter(F.col("src").isNotNull() & F.col("dst").isNotNull()), "walk-edges")
    found = start.select("node", F.lit(0).alias("depth")).distinct()

    def keep(df: DataFrame, hop: int, part: int) -> DataFrame:
        df.write.parquet(f"{path}/hop={hop}/part={part}")
        return spark.read.schema(found.schema).parquet(f"{path}/hop={hop}/part={part}")

    frontier, hop = dict.fromkeys((("src", "dst"), ("dst", "src")), keep(found, 0, 0)), 0
    while frontier and (depth is None or hop < depth):
        seen, hop = spark.read.schema(found.schema).parquet(path).select("node"), hop + 1
        ends = {(there, here): stored.join(nodes.select(F.col("node").alias(here)), here).select(F.col(there).alias("node")) for (here, there), nodes in frontier.items()}
        groups = [((way,), df) for way, df in ends.items()] if sides else [((("src", "dst"), ("dst", "src")), reduce(DataFrame.unionByName, ends.values()))]
        frontier = {}
        for part, (ways, df) in enumerate(groups):
            new = keep(df.distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(hop)), hop, part)
            if not new.isEmpty():
                frontier |= dict.fromkeys(ways, new)
    return spark.read.schema(found.schema).parquet(path).select("node", "depth")


def g43_shortest_path(edges: DataFrame, start: DataFrame, goal: str, max_depth: int | None = None) -> DataFrame:
    """Shortest undirected path from ``start`` nodes to ``goal``, the alphabetically first one.

    The search goes on from both ends, each time from the end whose frontier is smaller, until a frontier meets
    the other's or one end reaches nothing new (no row). With ``max_depth`` a walk that stops at the bound says
    so: one row without path, its length the bound. Frontiers hold nodes with one pointer to the node before,
    no paths, and are stored. From where they meet, the nodes of shortest paths are walked back to the start,
    each with the first of its followers, and the path is read off these pointers.
    """
    spark = edges.sparkSession
    both, path = _both_ways(edges), work_folder(spark, "walk-ends")

    def level(side: str, hop: int) -> DataFrame:
        return spark.read.schema("node string, next string").parquet(f"{path}/{side}/hop={hop}")

    def seen(side: str) -> DataFrame:
        return spark.read.schema("node string, next string").parquet(f"{path}/{side}").select("node")

    none = F.lit(None).cast("string").alias("next")
    start.select(F.col("node").cast("string").alias("node"), none).distinct().write.parquet(f"{path}/ahead/hop=0")
    spark.range(1).select(F.lit(goal).alias("node"), none).write.parquet(f"{path}/back/hop=0")
    hops, sizes = {"ahead": 0, "back": 0}, {"ahead": level("ahead", 0).count(), "back": 1}
    while True:
        met = level("back", hops["back"]).join(level("ahead", hops["ahead"]).select("node"), "node", "left_semi")
        if not met.isEmpty():
            break
        if not all(sizes.values()):
            return spark.range(0).select(F.array(F.lit("")).alias("path"), F.lit(0).alias("length"))
        if max_depth is not None and sum(hops.values()) >= max_depth:
            return spark.range(1).select(F.lit(None).cast("array<string>").alias("path"), F.lit(max_depth).alias("length"))
        side = min(sizes, key=sizes.get)
        step = level(side, hops[side]).select(F.col("node").alias("src")).join(both, "src")
        step = step.groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("next")).join(seen(side), "node", "left_anti")
        hops[side] += 1
        step.write.parquet(f"{path}/{side}/hop={hops[side]}")
        sizes[side] = level(side, hops[side]).count()

    layers = [work_table(met.select("node", "next"), "walk-layer")]
    for hop in range(hops["ahead"] - 1, -1, -1):
        before = layers[0].select(F.col("node").alias("src")).join(both, "src").groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("next"))
        layers.insert(0, work_table(before.join(level("ahead", hop).select("node"), "node", "left_semi"), "walk-layer"))
    layers += [level("back", hop) for hop in range(hops["back"] - 1, -1, -1)]
    walk = layers[0].orderBy("node").limit(1).select(F.col("node").alias("n0"), "next")
    for i, layer in enumerate(layers[1:], start=1):
        walk = walk.join(layer.select(F.col("node").alias(f"n{i}"), F.col("next").alias("_onward")), F.col("next") == F.col(f"n{i}"))
        walk = walk.select(*[f"n{j}" for j in range(i + 1)], F.col("_onward").alias("next"))
    return walk.select(F.array(*[f"n{j}" for j in range(len(layers))]).alias("path"), F.lit(len(layers) - 1).alias("length"))


def g39_similar_context(g: Graph, learner: DataFrame | str, limit: int | None = 10) -> DataFrame:
    """Learners sharing a skill with the given one, with a program and a company of theirs.

    Each learner kept has a row at least, so the first ``limit`` learners hold the answer; only these are expanded.
    """
    key = learner_key(learner)
    wanted = g.has_skill.filter(F.col("learner") == key).select("skill_id").distinct()
    shared = g.has_skill.filter(F.col("learner") != key).join(wanted, "skill_id", "left_semi")
    similar = shared.groupBy("learner").agg(N("*").alias("shared_skills"))
    member, work = enrolments(g).select("learner", "program_id", "program"), jobs(g).select("learner", "company")
    similar = similar.join(member, "learner", "left_semi").join(work, "learner", "left_semi")
    similar = top_k(similar, desc("shared_skills") + asc("learner"), limit)
    df = similar.join(member, "learner").join(work, "learner")
    out = df.select("learner", "shared_skills", "program", "program_id", "company")
    return top_k(out, desc("shared_skills") + asc("learner", "program_id", "company"), limit)


# ---- catalog ---------------------------------------------------------------------------------


def cat_counts(g: Graph) -> DataFrame:
    """Rows per node label and relationship type, with totals."""
    def counted(tables: dict[str, DataFrame], what: str) -> DataFrame:
        parts = [
            df.agg(N("*").alias("n")).select(F.lit(what).alias("element"), F.lit(name).alias("name"), "n")
            for name, df in tables.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    parts = counted(g.nodes(), "node").unionByName(counted(g.relationships(), "relationship"))
    out = parts.rollup("element", "name").agg(F.sum("n").alias("n"), F.grouping_id().alias("gid"))
    out = out.filter(F.col("gid") < 3)
    return out.select("element", F.when(F.col("gid") == 1, "TOTAL").otherwise(F.col("name")).alias("name"), "n")


def cat_schema(g: Graph) -> DataFrame:
    """Node kinds and relationship types with their properties and types, from the schemas alone."""
    rows = [
        (what, name, f.name, f.dataType.simpleString())
        for what, tables in (("node", g.nodes()), ("relationship", g.relationships()))
        for name, df in tables.items()
        for f in df.schema.fields
    ]
    return g.learner.sparkSession.createDataFrame(rows, "element string, name string, property string, type string")
