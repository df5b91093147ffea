"""SQL of the flat-table questions."""

from oracle.ctes import pct, r, sql

GRAD = "status = 'Graduated'"
TOT = "CAST(sum({}) AS BIGINT)"


def n(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def outcomes(country_cond: str, keys: str = "", active: bool = True) -> str:
    cols = f"{keys}match_type, count(*) AS total_learners, {n(GRAD)} AS graduates, "
    if active:
        cols += f"{n('act')} AS active, "
    cols += f"{n('drp')} AS dropped_out, {pct(n(GRAD), 'count(*)')} AS graduation_rate_pct"
    inner = f"""
      SELECT *, 'data analytics (SPECIFIC)' AS match_type FROM prow WHERE {country_cond} AND lower(program_name) LIKE '%data analytics%'
      UNION ALL
      SELECT *, 'data (BROAD)' AS match_type FROM prow WHERE {country_cond} AND lower(program_name) LIKE '%data%'"""
    return f"SELECT {cols} FROM ({inner}) GROUP BY ALL"


#: Columns of the raw table, in order; all are text but the first.
RAW = """row_ord hashed_email sand_id full_name profile_photo_url bio gender country_of_residence country_of_origin city_of_residence
country_of_residence_latitude country_of_residence_longitude city_of_residence_latitude city_of_residence_longitude education_level_of_study
education_field_of_study skills_list is_graduate_learner is_active_learner is_a_dropped_out is_running_a_venture is_a_freelancer is_wage_employed
is_placed is_featured is_rural description_of_living_location has_disability type_of_disability is_from_low_income_household learning_details
placement_details employment_details education_details snapshot_id has_employment_details has_education_details has_placement_details
has_profile_profile_photo""".split()

ORACLES = {
    "q00_describe": "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{c}', '{'string' if i else 'bigint'}')" for i, c in enumerate(RAW)) + ") t(position, column_name, column_type)",
    "q01_country_share": sql(f"""SELECT country, count(*) AS total_learners,
        {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage
        FROM prow WHERE country IS NOT NULL GROUP BY country ORDER BY 2 DESC, 1 LIMIT 20"""),
    "q02_programs_matching": sql("""SELECT program_name, count(*) AS learners FROM prow
        WHERE lower(country) LIKE '%nation_5%' AND lower(program_name) LIKE '%data%' GROUP BY 1"""),
    "q02_program_in_country": sql(outcomes("lower(country) LIKE '%nation_5%'")),
    "q02b_by_city": sql(f"""SELECT city, count(*) AS learner_count, {n('grad')} AS graduates,
        {pct(n('grad'), 'count(*)')} AS graduation_rate_pct FROM prow
        WHERE lower(country) LIKE '%nation_5%' AND lower(program_name) LIKE '%data analytics%'
        GROUP BY city HAVING count(*) >= 3 ORDER BY 2 DESC, 1 LIMIT 15"""),
    "q02b_by_city_broad": sql(f"""SELECT city, count(*) AS learner_count, {n('grad')} AS graduates,
        {pct(n('grad'), 'count(*)')} AS graduation_rate_pct FROM prow
        WHERE lower(country) LIKE '%nation_5%' AND lower(program_name) LIKE '%data%'
        GROUP BY city HAVING count(*) >= 3 ORDER BY 2 DESC, 1 LIMIT 15"""),
    "q03_program_in_country2": sql(outcomes("lower(country) LIKE '%nation_1%'")),
    "q03b_two_country_compare": sql(outcomes(
        "country IS NOT NULL AND (lower(country) LIKE '%nation_5%' OR lower(country) LIKE '%nation_7%')",
        "CASE WHEN lower(country) LIKE '%nation_5%' THEN 'nation_5' ELSE 'nation_7' END AS country, ", False)),
    "q04_active_by_country": sql(f"""SELECT country, count(*) AS active_learners,
        {n("gender = 'female'")} AS female_count, {pct(n("gender = 'female'"), 'count(*)')} AS female_pct
        FROM prow WHERE act AND country IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""),
    "q05_grad_rate_country": sql(f"""SELECT country, count(*) AS total_enrollments, {n('grad')} AS graduates,
        {n('drp')} AS dropouts, {n('act')} AS active, {pct(n('grad'), 'count(*)')} AS graduation_rate_pct,
        {pct(n('drp'), 'count(*)')} AS dropout_rate_pct
        FROM prow WHERE country IS NOT NULL GROUP BY 1 HAVING count(*) >= 100"""),
    "q06_top_cities": sql(f"""SELECT country, city, count(*) AS total_learners, {n('grad')} AS graduates,
        {pct(n('grad'), 'count(*)')} AS graduation_rate_pct FROM prow
        GROUP BY 1, 2 HAVING count(*) >= 50 ORDER BY 3 DESC, 1 NULLS LAST, 2 LIMIT 30"""),
    "q07_program_enrolments": sql(f"""SELECT program_name, count(*) AS total_enrollments,
        {pct('count(*)', '(SELECT count(*) FROM prow)')} AS pct_of_total FROM prow GROUP BY 1"""),
    "q08_program_grad_rate": sql(f"""SELECT program_name, count(*) AS total_enrolled, {n('grad')} AS graduates,
        {n('drp')} AS dropouts, {pct(n('grad'), 'count(*)')} AS graduation_rate_pct
        FROM prow GROUP BY 1 HAVING count(*) >= 100"""),
    "q09_cohort_performance": sql(f"""SELECT cohort_code, program_name, count(*) AS enrollments,
        {r('avg(score::DOUBLE)')} AS avg_lms_score, {pct(n('grad'), 'count(*)')} AS graduation_rate_pct
        FROM prow GROUP BY 1, 2 HAVING count(*) >= 100 ORDER BY 3 DESC, 1, 2 LIMIT 30"""),
    "q10_program_duration": sql(f"""SELECT program_name, count(*) AS enrollments,
        {r('avg((end_date - start_date)::DOUBLE)', 1)} AS avg_duration_days,
        {r('avg((end_date - start_date)::DOUBLE / 30.0::DOUBLE)', 1)} AS avg_duration_months
        FROM prow GROUP BY 1 HAVING count(*) >= 100"""),
    "q11_completion_rates": sql(f"""SELECT program_name, count(*) AS enrollments,
        {r('avg(assign_rate::DOUBLE)')} AS avg_assignment_completion_pct,
        {r('avg(test_rate::DOUBLE)')} AS avg_test_completion_pct,
        {r('avg(mile_rate::DOUBLE)')} AS avg_milestone_completion_pct
        FROM prow GROUP BY 1 HAVING count(*) >= 100"""),
    "q12_top_performers": sql("""SELECT program_name, coalesce(country, 'n/a') AS country_of_residence, gender,
        score::DOUBLE AS lms_score, rank_in_program::INT AS rank_in_program FROM (
          SELECT *, row_number() OVER (PARTITION BY program_name ORDER BY score DESC, learner, row_ord) AS rank_in_program
          FROM prow WHERE score > 0) WHERE rank_in_program <= 5 ORDER BY 1, 5 LIMIT 50"""),
    "q13_state_distribution": sql(f"""SELECT CASE WHEN grad THEN 'Graduate' WHEN act THEN 'Active/Enrolled'
          WHEN drp THEN 'Dropped Out' ELSE 'Unknown' END AS learning_state, count(*) AS learner_count,
        {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage FROM prow GROUP BY 1"""),
    "q14_state_by_country": sql(f"""SELECT country, count(*) AS total, {n('grad')} AS graduates, {n('act')} AS active,
        {n('drp')} AS dropped_out, {pct(n('grad'), 'count(*)')} AS graduation_rate_pct,
        {pct(n('drp'), 'count(*)')} AS dropout_rate_pct
        FROM prow WHERE country IS NOT NULL GROUP BY 1 HAVING count(*) >= 100"""),
    "q15_by_gender": sql(f"""SELECT coalesce(gender, 'Unknown') AS gender, count(*) AS total, {n('grad')} AS graduates,
        {n('drp')} AS dropped_out, {pct(n('grad'), 'count(*)')} AS graduation_rate_pct,
        {pct(n('drp'), 'count(*)')} AS dropout_rate_pct FROM prow GROUP BY 1"""),
    "q16_by_education": sql(f"""SELECT edu AS education_level, count(*) AS total, {n('grad')} AS graduates,
        {pct(n('grad'), 'count(*)')} AS graduation_rate_pct, {pct(n('drp'), 'count(*)')} AS dropout_rate_pct
        FROM prow WHERE edu IS NOT NULL GROUP BY 1 HAVING count(*) >= 100"""),
    "q17_monthly_trend": sql(f"""SELECT CAST(date_trunc('month', start_date) AS DATE) AS start_month,
        count(*) AS new_enrollments, {n('grad')} AS graduated, {n('drp')} AS dropped_out
        FROM prow WHERE start_date >= DATE '1996-01-01' GROUP BY 1"""),
    "q18_employment_by_country": sql(f"""SELECT country, count(*) AS total_graduates, {n('employed')} AS employed_graduates,
        {pct(n('employed'), 'count(*)')} AS employment_rate_pct
        FROM prow WHERE grad AND country IS NOT NULL GROUP BY 1 HAVING count(*) >= 50"""),
    "q19_employment_types": sql(f"""SELECT CASE WHEN wage AND NOT venture AND NOT free THEN 'Wage Employed Only'
          WHEN venture AND NOT wage AND NOT free THEN 'Entrepreneur Only'
          WHEN free AND NOT wage AND NOT venture THEN 'Freelancer Only'
          WHEN wage AND venture THEN 'Wage + Entrepreneur' WHEN wage AND free THEN 'Wage + Freelancer'
          WHEN NOT wage AND NOT venture AND NOT free THEN 'Not Employed/Unknown' ELSE 'Multiple/Other' END AS employment_type,
        count(*) AS learner_count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage FROM prow GROUP BY 1"""),
    "q20_salary_distribution": sql(f"""SELECT ['$0-$500','$501-$1000','$1001-$2000','$2001+'][c_custkey % 4 + 1] AS salary_range,
        count(*) AS learner_count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage
        FROM prow WHERE wage GROUP BY 1"""),
    "q21_job_titles": sql("""SELECT title AS job_title, count(*) AS occurrence_count, count(DISTINCT learner) AS unique_learners
        FROM rawjob WHERE pos = 0 GROUP BY 1 HAVING count(*) >= 10 ORDER BY 2 DESC, 1 LIMIT 30"""),
    "q22_ventures": sql("""SELECT country, count(DISTINCT learner) AS entrepreneurs,
        CAST(sum(CASE WHEN wage THEN 0 ELSE c_custkey % 10 END) AS BIGINT) AS total_jobs_created,
        CAST(sum(CASE WHEN wage THEN 0 ELSE c_custkey % 4 END) AS BIGINT) AS female_opportunities
        FROM prow WHERE venture AND country IS NOT NULL GROUP BY 1 HAVING count(DISTINCT learner) >= 10
        ORDER BY 2 DESC, 1 LIMIT 20"""),
    "q23_employment_by_program": sql(f"""SELECT program_name, count(*) AS total_graduates, {n('employed')} AS employed_count,
        {n('wage')} AS wage_employed, {n('venture')} AS entrepreneurs, {n('free')} AS freelancers,
        {pct(n('employed'), 'count(*)')} AS employment_rate_pct
        FROM prow WHERE grad GROUP BY 1 HAVING count(*) >= 50"""),
    "q24_female_employed": sql(f"""SELECT city, program_name, count(*) AS employed_female_graduates,
        CASE WHEN {n('wage')} > 0 AND {n('venture')} = 0 THEN 'Wage Employed'
          WHEN {n('venture')} > 0 AND {n('wage')} = 0 THEN 'Entrepreneur'
          WHEN {n('free')} > 0 THEN 'Freelancer' ELSE 'Mixed' END AS primary_employment_type
        FROM prow WHERE gender = 'female' AND grad AND employed AND lower(country) LIKE '%nation_1%'
        GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY 3 DESC, 1, 2 LIMIT 20"""),
    "q24_total": sql("""SELECT count(*) AS total_employed_female_graduates
        FROM prow WHERE gender = 'female' AND grad AND employed AND lower(country) LIKE '%nation_1%'"""),
    "q25_venture_grads": sql("""SELECT city, program_name, count(*) AS entrepreneurs
        FROM prow WHERE lower(country) LIKE '%nation_1%' AND grad AND venture AND lower(program_name) LIKE '%data%'
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"""),
    "q25_fallback": sql("""SELECT NULL::VARCHAR AS city, program_name, count(*) AS entrepreneurs
        FROM prow WHERE lower(country) LIKE '%nation_1%' AND grad AND venture GROUP BY program_name"""),
    "q25_with_match": sql("""SELECT city, program_name, count(*) AS entrepreneurs
        FROM prow WHERE lower(country) LIKE '%nation_1%' AND grad AND venture AND lower(program_name) LIKE '%data%'
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"""),
    "q26_skill_employment": sql(f"""SELECT skill_name, {n('employed')} AS employed_count, {n('NOT employed')} AS not_employed_count,
        count(*) AS total_count, {pct(n('employed'), 'count(*)')} AS employed_pct FROM (
          SELECT employed, unnest([['Python','Data Analysis','Project Management','SQL','Communication','Graphic Design','Cloud','Sales'][row_ord % 8 + 1],
            lower(['Python','Data Analysis','Project Management','SQL','Communication','Graphic Design','Cloud','Sales'][o_custkey % 8 + 1]), 'n/a', '']) AS skill_name
          FROM prow WHERE grad) GROUP BY 1 HAVING count(*) >= 100 ORDER BY 5 DESC, 1 LIMIT 25"""),
    "q27_field_program": sql(f"""SELECT field AS prior_education_field, program_name, count(*) AS enrollments,
        {n('grad')} AS graduates, {pct(n('grad'), 'count(*)')} AS graduation_rate_pct
        FROM prow WHERE field IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 100 ORDER BY 5 DESC, 1, 2 LIMIT 30"""),
    "q28_high_performers": sql(f"""SELECT gender, coalesce(country, 'n/a') AS country, edu AS education_level, program_name,
        count(*) AS high_performers, {r('avg(score::DOUBLE)')} AS avg_score, {n('wage OR venture')} AS employed_count
        FROM prow WHERE score >= 90 GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3
        ORDER BY 5 DESC, 1 NULLS LAST, 2 NULLS LAST, 3 NULLS LAST, 4 LIMIT 30"""),
    "q29_dropout_risk": sql(f"""SELECT gender, edu AS education_level, program_name, count(*) AS total_enrolled,
        {n('drp')} AS dropped_out, {pct(n('drp'), 'count(*)')} AS dropout_rate_pct
        FROM prow WHERE edu IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 100
        ORDER BY 6 DESC, 1 NULLS LAST, 2, 3 LIMIT 30"""),
    "q30_funnel": sql(f"""SELECT program_name, count(*) AS total_enrolled, {n('n_sub > 0')} AS started_assignments,
        {n('grad')} AS graduated, {n('employed')} AS employed, {pct(n('n_sub > 0'), 'count(*)')} AS started_pct,
        {pct(n('grad'), 'count(*)')} AS graduation_pct, {pct(n('employed'), n('grad'))} AS employment_rate_of_graduates_pct
        FROM prow GROUP BY 1 HAVING count(*) >= 100"""),
}
