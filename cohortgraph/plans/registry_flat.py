"""Registered flat-table queries."""

from __future__ import annotations

from cohortgraph.bindings import star
from cohortgraph.plans import flat


def _on_raw(question, **options):
    def run(spark, sf_dir):
        return question(star.raw_rows(spark, sf_dir), **options)

    return run


QUERIES = {
    "q00_describe": _on_raw(flat.q00_describe),
    "q01_country_share": _on_raw(flat.q01_country_share),
    "q02_programs_matching": _on_raw(flat.programs_matching, country="nation_5", term="data"),
    "q02_program_in_country": _on_raw(flat.q02_program_in_country, country="nation_5"),
    "q02b_by_city": _on_raw(flat.q02b_by_city, country="nation_5", term="data analytics"),
    "q02b_by_city_broad": _on_raw(flat.q02b_by_city, country="nation_5", term="data"),
    "q03_program_in_country2": _on_raw(flat.q02_program_in_country, country="nation_1"),
    "q03b_two_country_compare": _on_raw(flat.q03b_two_country_compare, first="nation_5", second="nation_7"),
    "q04_active_by_country": _on_raw(flat.q04_active_by_country),
    "q05_grad_rate_country": _on_raw(flat.q05_grad_rate_country, min_n=100),
    "q06_top_cities": _on_raw(flat.q06_top_cities, min_n=50),
    "q07_program_enrolments": _on_raw(flat.q07_program_enrolments),
    "q08_program_grad_rate": _on_raw(flat.q08_program_grad_rate),
    "q09_cohort_performance": _on_raw(flat.q09_cohort_performance),
    "q10_program_duration": _on_raw(flat.q10_program_duration),
    "q11_completion_rates": _on_raw(flat.q11_completion_rates),
    "q12_top_performers": _on_raw(flat.q12_top_performers),
    "q13_state_distribution": _on_raw(flat.q13_state_distribution),
    "q14_state_by_country": _on_raw(flat.q14_state_by_country, min_n=100),
    "q15_by_gender": _on_raw(flat.q15_by_gender),
    "q16_by_education": _on_raw(flat.q16_by_education),
    "q17_monthly_trend": _on_raw(flat.q17_monthly_trend, since="1996-01-01"),
    "q18_employment_by_country": _on_raw(flat.q18_employment_by_country, min_n=50),
    "q19_employment_types": _on_raw(flat.q19_employment_types),
    "q20_salary_distribution": _on_raw(flat.q20_salary_distribution),
    "q21_job_titles": _on_raw(flat.q21_job_titles),
    "q22_ventures": _on_raw(flat.q22_ventures),
    "q23_employment_by_program": _on_raw(flat.q23_employment_by_program),
    "q24_female_employed": _on_raw(flat.q24_female_employed, country="nation_1"),
    "q24_total": _on_raw(flat.q24_total, country="nation_1"),
    "q25_venture_grads": _on_raw(flat.q25_venture_grads, country="nation_1", term="data"),
    "q25_fallback": _on_raw(flat.q25_with_fallback, country="nation_1", term="no such term"),
    "q25_with_match": _on_raw(flat.q25_with_fallback, country="nation_1", term="data"),
    "q26_skill_employment": _on_raw(flat.q26_skill_employment),
    "q27_field_program": _on_raw(flat.q27_field_program),
    "q28_high_performers": _on_raw(flat.q28_high_performers, min_n=3),
    "q29_dropout_risk": _on_raw(flat.q29_dropout_risk),
    "q30_funnel": _on_raw(flat.q30_funnel),
}
