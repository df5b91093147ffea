"""Registered graph, journey and tool queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortgraph.bindings import star
from cohortgraph.plans.shape import as_text
from cohortgraph.plans import graph as G
from cohortgraph.plans import journeys as J
from cohortgraph.plans import tools as T

FIVE = ["CA", "CB", "CC", "CW", "CV"]


def _on_graph(question, **options):
    return lambda spark, sf_dir: as_text(question(star.graph(spark, sf_dir), **options))


def _on_numbers(question, **options):
    return lambda spark, sf_dir: as_text(question(star.numbered_graph(spark, sf_dir), **options))


def _on_raw(question, **options):
    return lambda spark, sf_dir: question(star.raw_rows(spark, sf_dir), **options)


def _of_one(question, **options):
    """Question about one learner, the one with most skills."""

    def run(spark, sf_dir):
        g = star.graph(spark, sf_dir)
        return as_text(question(g, J.most_skilled(g), **options))

    return run


def _first_learner(g):
    return g.learner.agg(F.min("hashed_email").alias("learner"))


def _reach(spark, sf_dir):
    """The walk is on numbers for nodes; the nodes found get their names."""
    found = G.reachable(star.numbered_node_edges(spark, sf_dir), star.first_learner_node(spark, sf_dir), 3, sides=True)
    return star.named_nodes(spark, sf_dir, found)


def _path(spark, sf_dir):
    g = star.graph(spark, sf_dir)
    start = _first_learner(g).select(F.concat(F.lit("learner:"), "learner").alias("node"))
    return as_text(G.g43_shortest_path(G.node_edges(g), start, "program:VA-C2001"))


QUERIES = {
    "cat_counts": _on_graph(G.cat_counts),
    "cat_schema": _on_graph(G.cat_schema),
    "g01_top_countries": _on_graph(G.g01_top_countries),
    "g02_program_country_grads": _on_graph(G.g02_program_country_grads, country="CB", term="AI"),
    "g03_gender_country": _on_graph(G.g03_gender_country, codes=FIVE),
    "g03_gender_country_long": _on_graph(G.g03_gender_country_long, codes=FIVE),
    "g04_top_cities": _on_graph(G.g04_top_cities),
    "g05_enrolments": _on_graph(G.g05_enrolments),
    "g06_completion": _on_graph(G.g06_completion),
    "g06_completion_by_cohort": _on_graph(G.g06_completion_by_cohort),
    "g07_lms": _on_graph(G.g07_lms),
    "g07_lms_null_as_zero": _on_graph(G.g07_lms, null_as_zero=True),
    "g08_status_dist": _on_graph(G.g08_status_dist),
    "g09_top_skills": _on_graph(G.g09_top_skills),
    "g10_skills_by_program": _on_numbers(G.g10_skills_by_program, term="AI"),
    "g11_skill_pair_filter": _on_graph(G.g11_skill_pair_filter, names=["Blue Python", "Red Python"], terms=["Data", "data"]),
    "g12_avg_skills": _on_graph(G.g12_avg_skills, min_n=100),
    "g13_learning_dist": _on_graph(G.g13_learning_dist),
    "g14_prof_dist": _on_graph(G.g14_prof_dist),
    "g15_state_country": _on_graph(G.g15_state_country, codes=FIVE),
    "g16_status_pct": _on_graph(G.g16_status_pct),
    "g17_employers": _on_graph(G.g17_employers),
    "g17_employers_valid_country": _on_graph(G.g17_employers, only_valid=True, country="CB"),
    "g17_employers_distinct": _on_graph(G.g17_employers_distinct),
    "g18_emp_by_program": _on_graph(G.g18_emp_by_program),
    "g19_grad_outcomes": _on_graph(G.g19_grad_outcomes, codes=FIVE),
    "g20_skill_rate": _on_graph(G.g20_skill_rate, min_n=100),
    "g21_high_impact": _on_graph(G.g21_high_impact),
    "g22_rare_skills": _on_graph(G.g22_rare_skills, low=50, high=800),
    "g23_program_industry": _on_graph(G.g23_program_industry),
    "g24_skills_gap": _on_graph(G.g24_skills_gap, min_n=50),
    "g25_success_factors": _on_graph(G.g25_success_factors),
    "g26_peer_pairs": _on_graph(G.g26_peer_pairs),
    "g27_program_to_company": _on_graph(G.g27_program_to_company),
    "g28_skill_cooccurrence": _on_graph(G.g28_skill_cooccurrence),
    "g28_cooccurrence_all": _on_graph(G.g28_cooccurrence_all),
    "g29_mobility": _on_graph(G.g29_mobility),
    "g30_journey_paths": _on_graph(G.g30_journey_paths),
    "g31_duration": _on_graph(G.g31_duration),
    "g32_time_to_job": _on_graph(G.g32_time_to_job),
    "g32_time_to_job_by_program": _on_graph(G.g32_time_to_job_by_program),
    "g33_retention": _on_graph(G.g33_retention),
    "g33_retention_rate": _on_graph(G.g33_retention_rate),
    "g34_neighbourhood": _of_one(G.g34_neighbourhood),
    "g34_reachable": _reach,
    "g35_multi_hop": _on_graph(G.g35_multi_hop),
    "g36_program_skills_sample": _on_graph(G.g36_program_skills_sample, limit=None),
    "g37_avg_completion": _on_graph(G.g37_avg_completion),
    "g38_company_regex_skills": _on_graph(G.g38_company_regex_skills),
    "g39_similar_context": _of_one(G.g39_similar_context),
    "g40_latest_jobs": _on_graph(G.g40_latest_jobs),
    "g41_rural": _on_graph(G.g41_rural, country="CB"),
    "g42_single": _on_graph(G.g42_single, country_of_residence_code="CB", gender="female"),
    "g43_shortest_path": _path,
    "g44_region_rollup": _on_graph(G.g44_region_rollup),
    "g45_program_country_learners": _on_graph(G.g45_program_country_learners, term="data", country="CB"),
    "j01_graduates": _on_graph(J.j01_graduates),
    "j01_graduates_flat": _on_raw(J.j01_graduates_flat),
    "j02_top_countries": _on_graph(J.j02_top_countries),
    "j02_top_countries_flat": _on_raw(J.j02_top_countries_flat),
    "j03_skill_program_employed": _on_graph(J.j03_skill_program_employed),
    "j03_flat": _on_raw(J.j03_flat),
    "j04_effective_programs": _on_graph(J.j04_effective_programs, min_rate=0.5),
    "j04_flat": _on_raw(J.j04_flat),
    "j05_skill_combos": _on_graph(J.j05_skill_combos),
    "j05_flat": _on_raw(J.j05_flat),
    "j08_similar_learners": _on_graph(J.j08_similar_learners),
    "j09_recommend_programs": _on_graph(J.j09_recommend_programs, min_rate=0.5),
    "j10_country_time_to_job": _on_graph(J.j10_country_time_to_job),
    "j11_rich_profiles": _on_graph(J.j11_rich_profiles),
    "j12_profile": _of_one(J.j12_profile),
    "j13_timeline": _of_one(J.j13_timeline),
    "j14_state_pct": _on_graph(J.j14_state_pct),
    "t1_top_countries": _on_graph(T.t1_top_countries),
    "t2_program_completion": _on_graph(T.t2_program_completion),
    "t2_one_program": _on_graph(T.t2_program_completion, program="Data Science"),
    "t3_employment_rate": _on_graph(T.t3_employment_rate),
    "t3_one_program": _on_graph(T.t3_employment_rate, program="Data Science"),
    "t4_top_skills": _on_graph(T.t4_top_skills),
    "t4_technical_skills": _on_graph(T.t4_top_skills, category="Technical"),
    "t5_learner_journey": _of_one(T.t5_learner_journey),
    "t6_skills_employed": _on_graph(T.t6_skills_employed),
    "t6_skills_employed_country": _on_graph(T.t6_skills_employed, country="CB"),
    "t7_geo_learners": _on_graph(T.t7_geo_distribution),
    "t7_geo_programs": _on_graph(T.t7_geo_distribution, metric="programs"),
    "t7_geo_companies": _on_graph(T.t7_geo_distribution, metric="companies"),
    "t7_geo_unknown_metric": _on_graph(T.t7_geo_distribution, metric="planets"),
    "t8_time_to_employment": _on_graph(T.t8_time_to_employment),
    "t8_one_program": _on_graph(T.t8_time_to_employment, program="Data Science"),
    "t8_day_component": _on_graph(T.t8_time_to_employment, component=True),
}
