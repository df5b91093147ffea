"""SQL of the graph, journey and tool questions."""

from oracle.ctes import pct, r, sql
from oracle.flat import n

FIVE = "('CA','CB','CC','CW','CV')"
VALID = "company NOT IN ('n/a')"
HASH = "sha256(company)[1:16]"
EMP = "pstatus IN ('Wage Employed','Entrepreneur','Multiple')"
ENRP = "enr"
TOP1 = "top1 AS (SELECT learner FROM skl GROUP BY 1 ORDER BY count(*) DESC, learner LIMIT 1)"
SKEMP = f"""ske AS (SELECT skill, count(DISTINCT s.learner) AS total_with_skill,
    count(DISTINCT w.learner) AS employed_with_skill FROM skl s LEFT JOIN (SELECT DISTINCT learner FROM works) w
    ON s.learner = w.learner GROUP BY 1 HAVING count(DISTINCT w.learner) > 0),
  skr AS (SELECT *, {pct('employed_with_skill', 'total_with_skill')} AS employment_rate FROM ske)"""
FIRST5 = """f5 AS (SELECT learner, list_sort(list(skill))[1:5] AS skills FROM skl GROUP BY 1)"""
GAPS = f"""gaps AS (SELECT e.*, w.company, w.start_date AS job_start, w.start_date - e.graduation_date AS days
    FROM enr e JOIN works w ON e.learner = w.learner
    WHERE e.graduation_date IS NOT NULL AND w.start_date >= e.graduation_date)"""
EDGES = f"""edg AS (
    SELECT 'learner:' || learner AS src, 'skill:' || skill_id AS dst FROM skl
    UNION ALL SELECT 'learner:' || learner, 'program:' || cohort_code FROM enr
    UNION ALL SELECT 'learner:' || learner, 'company:' || {HASH} FROM works),
  both_ways AS (SELECT src, dst FROM edg UNION ALL SELECT dst, src FROM edg),
  d0 AS (SELECT 'learner:' || min(learner) AS node FROM lrn),
  d1 AS (SELECT DISTINCT dst AS node FROM both_ways JOIN d0 ON src = node WHERE dst NOT IN (SELECT node FROM d0)),
  d2 AS (SELECT DISTINCT dst AS node FROM both_ways JOIN d1 ON src = node
    WHERE dst NOT IN (SELECT node FROM d0 UNION ALL SELECT node FROM d1)),
  d3 AS (SELECT DISTINCT dst AS node FROM both_ways JOIN d2 ON src = node
    WHERE dst NOT IN (SELECT node FROM d0 UNION ALL SELECT node FROM d1 UNION ALL SELECT node FROM d2))"""
COMP = f"count(*) AS total_enrolled, {n('is_completed')} AS completed, {n('is_dropped')} AS dropped_out, " \
       f"{pct(n('is_completed'), 'count(*)')} AS completion_rate, {pct(n('is_dropped'), 'count(*)')} AS dropout_rate"
STATS = f"""count(*) AS total_transitions, {r('avg(days)', 0)} AS avg_days, {r('avg(days) / 30.0::DOUBLE', 1)} AS avg_months,
    CAST(min(days) AS INTEGER) AS min_days, CAST(max(days) AS INTEGER) AS max_days, quantile_cont(days::DOUBLE, 0.5) AS median_days"""
STATE_COLS = ", ".join(
    f"{n(f'lstate = {chr(39)}{s}{chr(39)}')} AS {s.lower().replace(' ', '_')}" for s in ("Active", "Graduate", "Dropped Out", "Inactive")
)


def packed(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in cols)
    return f"array_to_string(list_sort(list(DISTINCT concat_ws('|', {parts}))), ';')"


PROFILE_CTES = TOP1 + f""",
  s1 AS (SELECT learner, {packed('skill', 'category')} AS skills FROM skl WHERE learner IN (SELECT learner FROM top1) GROUP BY 1),
  p1 AS (SELECT learner, {packed('program_name', 'cohort_code', 'status', 'start_date', 'completion::DOUBLE', 'score::DOUBLE')} AS programs
      FROM enr WHERE learner IN (SELECT learner FROM top1) GROUP BY 1),
  e1 AS (SELECT learner, {packed('company', 'position', 'start_date', 'is_current')} AS employment
      FROM works WHERE learner IN (SELECT learner FROM top1) GROUP BY 1)"""


MONTHS = """((year(job_start) - year(graduation_date)) * 12 + month(job_start) - month(graduation_date)
    - CASE WHEN day(job_start) < day(graduation_date) THEN 1 ELSE 0 END)"""


def tcount(name: str, extra: str = "") -> str:
    return f"SELECT ct.name AS country, ct.code AS country_code, {name} FROM x JOIN ctry ct ON x.code = ct.code ORDER BY 3 DESC, 2 LIMIT 20{extra}"


def pairs(where: str = "", having: str = "", limit: int = 15) -> str:
    return f"""SELECT a.skill AS skill1, b.skill AS skill2, count(*) AS co_occurrence FROM skl a JOIN skl b
        ON a.learner = b.learner AND a.skill_id < b.skill_id {where} GROUP BY 1, 2 {having} ORDER BY 3 DESC, 1, 2 LIMIT {limit}"""


HOP = f"""SELECT s.learner, full_name, skill, program_name AS program, cohort_code AS program_id, company
    FROM skl s JOIN enr e ON s.learner = e.learner JOIN works w ON s.learner = w.learner JOIN lrn l ON l.learner = s.learner"""

#: Properties of node labels and relationship types; text where no type follows.
SCHEMA = {
    ("node", "Learner"): "hashed_email full_name gender education_level country_of_residence_code country_of_origin_code city_of_residence_id "
                         "current_learning_state current_professional_status is_rural:boolean",
    ("node", "Country"): "code name latitude:double longitude:double region",
    ("node", "City"): "id name country_code",
    ("node", "Skill"): "id name category",
    ("node", "Program"): "id name cohort_code provider",
    ("node", "Company"): "id name industry country_code",
    ("relationship", "HAS_SKILL"): "learner skill_id",
    ("relationship", "ENROLLED_IN"): "learner program_id index:bigint enrollment_status start_date:date end_date:date graduation_date:date "
                                     "lms_overall_score:double completion_rate:double is_completed:boolean is_dropped:boolean duration:int",
    ("relationship", "WORKS_FOR"): "learner company_id position start_date:date end_date:date is_current:boolean source",
}

ORACLES = {
    "cat_schema": "SELECT * FROM (VALUES " + ", ".join(
        f"('{what}', '{name}', '{p.partition(':')[0]}', '{p.partition(':')[2] or 'string'}')" for (what, name), text in SCHEMA.items() for p in text.split()
    ) + ") t(element, name, property, type)",
    "cat_counts": sql("""
        SELECT 'node' AS element, name, n FROM (
          SELECT 'Learner' AS name, count(*) AS n FROM lrn UNION ALL SELECT 'Country', count(*) FROM ctry
          UNION ALL SELECT 'City', count(*) FROM city UNION ALL SELECT 'Skill', count(*) FROM (SELECT DISTINCT name FROM skn)
          UNION ALL SELECT 'Program', count(*) FROM prog UNION ALL SELECT 'Company', count(*) FROM cmp)
        UNION ALL SELECT 'node', 'TOTAL', (SELECT count(*) FROM lrn) + (SELECT count(*) FROM ctry) + (SELECT count(*) FROM city)
          + (SELECT count(DISTINCT name) FROM skn) + (SELECT count(*) FROM prog) + (SELECT count(*) FROM cmp)
        UNION ALL SELECT 'relationship', name, n FROM (SELECT 'HAS_SKILL' AS name, count(*) AS n FROM skl
          UNION ALL SELECT 'ENROLLED_IN', count(*) FROM enr UNION ALL SELECT 'WORKS_FOR', count(*) FROM works)
        UNION ALL SELECT 'relationship', 'TOTAL', (SELECT count(*) FROM skl) + (SELECT count(*) FROM enr) + (SELECT count(*) FROM works)"""),
    "g01_top_countries": sql("""SELECT ct.name AS country, code, count(*) AS learner_count FROM lrn JOIN ctry ct ON res_code = code
        GROUP BY 1, 2 ORDER BY 3 DESC, 2 LIMIT 10"""),
    "g02_program_country_grads": sql("""SELECT count(DISTINCT e.learner) AS graduates FROM enr e JOIN lrn l ON e.learner = l.learner
        WHERE res_code = 'CB' AND program_name LIKE '%AI%' AND is_completed"""),
    "g03_gender_country": sql(f"""SELECT ct.name AS country, {n("gender = 'male'")} AS male, {n("gender = 'female'")} AS female,
        {n("gender LIKE 'other%'")} AS other FROM lrn JOIN ctry ct ON res_code = code
        WHERE res_code IN {FIVE} AND gender IS NOT NULL GROUP BY 1"""),
    "g03_gender_country_long": sql(f"""SELECT ct.name AS country, gender, count(*) AS n FROM lrn JOIN ctry ct ON res_code = code
        WHERE res_code IN {FIVE} AND gender IS NOT NULL GROUP BY 1, 2"""),
    "g04_top_cities": sql("""SELECT city.name AS city, city.country_code AS country, n AS learner_count FROM
        (SELECT city_id, count(*) AS n FROM lrn GROUP BY 1) x JOIN city ON city.id = city_id ORDER BY n DESC, city_id LIMIT 10"""),
    "g05_enrolments": sql("""SELECT program_name AS program, cohort_code AS cohort, count(*) AS enrollments
        FROM enr GROUP BY 1, 2 ORDER BY 3 DESC, 2 LIMIT 15"""),
    "g06_completion": sql(f"""SELECT program_name AS program, {COMP} FROM enr GROUP BY 1 HAVING count(*) > 1000
        ORDER BY completion_rate DESC, 1 LIMIT 10"""),
    "g06_completion_by_cohort": sql(f"""SELECT program_name AS program, cohort_code AS cohort, count(*) AS total,
        {pct(n('is_completed'), 'count(*)')} AS completion_percentage, {pct(n('is_dropped'), 'count(*)')} AS dropout_percentage
        FROM enr GROUP BY 1, 2"""),
    "g07_lms": sql(f"""SELECT program_name AS program, count(*) AS learner_count, {r('avg(score::DOUBLE)')} AS avg_lms_score,
        {r('avg(completion::DOUBLE)')} AS avg_completion_rate FROM enr WHERE score IS NOT NULL GROUP BY 1
        HAVING count(*) > 500 ORDER BY 3 DESC, 1 LIMIT 10"""),
    "g07_lms_null_as_zero": sql(f"""SELECT program_name AS program, count(*) AS learner_count,
        {r('avg(coalesce(score, 0)::DOUBLE)')} AS avg_lms_score,
        {r('avg(coalesce(completion, 0)::DOUBLE)')} AS avg_completion_rate FROM enr GROUP BY 1
        HAVING count(*) > 500 ORDER BY 3 DESC, 1 LIMIT 10"""),
    "g08_status_dist": sql("""SELECT CASE WHEN lower(status) = 'dropped out' THEN 'Dropped Out' ELSE status END AS status,
        count(*) AS n FROM enr GROUP BY 1"""),
    "g09_top_skills": sql("""SELECT skill, category, count(*) AS learner_count FROM skl GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20"""),
    "g10_skills_by_program": sql("""SELECT skill, count(DISTINCT s.learner) AS learner_count FROM skl s JOIN enr e ON s.learner = e.learner
        WHERE program_name LIKE '%AI%' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""),
    "g11_skill_pair_filter": sql("""SELECT count(DISTINCT a.learner) AS learners FROM skl a JOIN skl b ON a.learner = b.learner
        WHERE a.skill IN ('Blue Python', 'Red Python') AND (b.skill LIKE '%Data%' OR b.skill LIKE '%data%')"""),
    "g12_avg_skills": sql(f"""SELECT program AS program, count(*) AS learner_count, {r('avg(k::DOUBLE)')} AS avg_skills_per_learner FROM (
        SELECT program_name AS program, e.learner, count(s.skill_id) AS k FROM enr e LEFT JOIN skl s ON e.learner = s.learner GROUP BY 1, 2)
        GROUP BY 1 HAVING count(*) > 100 ORDER BY 3 DESC, 1 LIMIT 10"""),
    "g13_learning_dist": sql("SELECT lstate AS state, count(*) AS learner_count FROM lrn GROUP BY 1"),
    "g14_prof_dist": sql("SELECT pstatus AS status, count(*) AS learner_count FROM lrn GROUP BY 1"),
    "g15_state_country": sql(f"""SELECT ct.name AS country, {STATE_COLS} FROM lrn JOIN ctry ct ON res_code = code
        WHERE res_code IN {FIVE} GROUP BY 1"""),
    "g16_status_pct": sql(f"""SELECT pstatus AS status, count(*) AS learner_count,
        {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage FROM lrn GROUP BY 1"""),
    "g17_employers": sql("""SELECT company, c.industry, count(*) AS employee_count FROM works JOIN cmp c ON company = c.name
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20"""),
    "g17_employers_valid_country": sql(f"""SELECT company, c.industry, count(*) AS employee_count FROM works w JOIN cmp c ON company = c.name
        JOIN lrn l ON l.learner = w.learner WHERE res_code = 'CB' AND {VALID} GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20"""),
    "g17_employers_distinct": sql("""SELECT company, count(DISTINCT learner) AS learner_count FROM works GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "g18_emp_by_program": sql(f"""SELECT program_name AS program, count(*) AS total_learners, count(DISTINCT w.learner) AS employed_learners,
        {pct('count(DISTINCT w.learner)', 'count(*)')} AS employment_rate
        FROM enr e LEFT JOIN (SELECT DISTINCT learner FROM works) w ON e.learner = w.learner GROUP BY 1
        HAVING count(*) > 1000 AND count(DISTINCT w.learner) > 0 ORDER BY 4 DESC, 1 LIMIT 10"""),
    "g19_grad_outcomes": sql(f"""SELECT ct.name AS country, a AS total_grads, b AS employed_grads, {pct('b', 'a')} AS employment_rate FROM
        (SELECT res_code, count(DISTINCT e.learner) AS a FROM enr e JOIN lrn l ON e.learner = l.learner WHERE is_completed AND res_code IN {FIVE} GROUP BY 1) x
        JOIN (SELECT res_code AS rc, count(DISTINCT e.learner) AS b FROM enr e JOIN lrn l ON e.learner = l.learner
          JOIN works w ON w.learner = e.learner WHERE {EMP} GROUP BY 1) y ON res_code = rc JOIN ctry ct ON ct.code = res_code"""),
    "g20_skill_rate": sql("SELECT * FROM skr WHERE total_with_skill > 100 ORDER BY employment_rate DESC, skill LIMIT 15", SKEMP),
    "g21_high_impact": sql("""SELECT count(DISTINCT l.learner) AS high_impact_learners FROM lrn l JOIN enr e ON e.learner = l.learner
        JOIN works w ON w.learner = l.learner WHERE is_completed AND pstatus IN ('Entrepreneur', 'Multiple')"""),
    "g22_rare_skills": sql("""SELECT * FROM skr WHERE total_with_skill BETWEEN 50 AND 800 AND employment_rate >= 80
        ORDER BY employment_rate DESC, total_with_skill DESC, skill LIMIT 15""", SKEMP),
    "g23_program_industry": sql(f"""SELECT program, industry, learner_count, {pct('learner_count', 'tot')} AS industry_share FROM (
        SELECT *, sum(learner_count) OVER (PARTITION BY program) AS tot FROM (
          SELECT program_name AS program, industry, count(DISTINCT e.learner) AS learner_count FROM enr e JOIN works w ON e.learner = w.learner
          JOIN cmp c ON c.name = company WHERE industry IS NOT NULL GROUP BY 1, 2)) WHERE tot > 500 AND {pct('learner_count', 'tot')} >= 5"""),
    "g24_skills_gap": sql(f"""SELECT skill, a AS employed_with_skill, b AS unemployed_with_skill, a + b AS total_grads_with_skill,
        {pct('a', 'a + b')} AS employment_rate FROM (
          SELECT skill, count(DISTINCT s.learner) FILTER (WHERE {EMP}) AS a, count(DISTINCT s.learner) FILTER (WHERE pstatus = 'Unemployed') AS b
          FROM skl s JOIN lrn l ON s.learner = l.learner JOIN enr e ON e.learner = s.learner WHERE is_completed GROUP BY 1)
        WHERE a > 0 AND b > 0 AND a + b > 50 ORDER BY 5 DESC, 1 LIMIT 20"""),
    "g25_success_factors": sql(f"""SELECT 'Employed Graduate' AS category, count(DISTINCT e.learner) AS learner_count,
          {r('avg(score::DOUBLE)')} AS avg_lms_score, {r('avg(completion::DOUBLE)')} AS avg_completion_rate, {r('avg(coalesce(k, 0)::DOUBLE)')} AS avg_skill_count
        FROM enr e JOIN works w ON e.learner = w.learner LEFT JOIN skl s ON s.learner = e.learner
          LEFT JOIN (SELECT learner, count(*) AS k FROM skl GROUP BY 1) sc ON sc.learner = e.learner WHERE is_completed
        UNION ALL SELECT 'Dropout', count(DISTINCT e.learner), {r('avg(score::DOUBLE)')}, {r('avg(completion::DOUBLE)')}, {r('avg(coalesce(k, 0)::DOUBLE)')}
        FROM enr e LEFT JOIN skl s ON s.learner = e.learner
          LEFT JOIN (SELECT learner, count(*) AS k FROM skl GROUP BY 1) sc ON sc.learner = e.learner WHERE is_dropped"""),
    "g26_peer_pairs": sql("""SELECT e1.program_name AS program, e1.cohort_code AS cohort, w1.company, count(*) AS peer_pairs
        FROM enr e1 JOIN enr e2 ON e1.cohort_code = e2.cohort_code AND e1.learner < e2.learner
        JOIN works w1 ON w1.learner = e1.learner JOIN works w2 ON w2.learner = e2.learner AND w1.company = w2.company
        GROUP BY 1, 2, 3 HAVING count(*) >= 10 ORDER BY 4 DESC, 2, 3 LIMIT 20"""),
    "g27_program_to_company": sql("""SELECT program_name AS program, company, count(DISTINCT e.learner) AS hire_count
        FROM enr e JOIN works w ON e.learner = w.learner GROUP BY 1, 2 HAVING count(DISTINCT e.learner) >= 50 ORDER BY 3 DESC, 1, 2 LIMIT 25"""),
    "g28_skill_cooccurrence": sql(pairs("WHERE a.learner IN (SELECT learner FROM works)", "HAVING count(*) > 100", 20)),
    "g28_cooccurrence_all": sql("""SELECT a.skill AS skill1, b.skill AS skill2, count(*) AS co_occurrence FROM skl a JOIN skl b
        ON a.learner = b.learner AND a.skill < b.skill GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15"""),
    "g29_mobility": sql("""SELECT c1.name AS origin_country, c2.name AS work_country, res_code AS residence, n AS learner_count,
        CASE WHEN orig_code = res_code THEN 'Relocated for work' WHEN res_code = wc THEN 'Already relocated, now working'
          ELSE 'Complex mobility' END AS mobility_type FROM (
          SELECT orig_code, res_code, country_code AS wc, count(*) AS n FROM lrn l JOIN works w ON l.learner = w.learner
          JOIN cmp c ON c.name = company WHERE orig_code IS NOT NULL AND res_code IS NOT NULL AND country_code IS NOT NULL
            AND orig_code <> country_code GROUP BY 1, 2, 3) x
        JOIN ctry c1 ON c1.code = orig_code JOIN ctry c2 ON c2.code = wc ORDER BY n DESC, orig_code, wc, res_code LIMIT 15"""),
    "g30_journey_paths": sql("""SELECT program, array_to_string(skills, ',') AS top_skills, industry, count(*) AS learner_count FROM (
          SELECT DISTINCT e.learner, program_name AS program, skills, company, industry FROM enr e JOIN f5 ON f5.learner = e.learner
          JOIN works w ON w.learner = e.learner JOIN cmp c ON c.name = company JOIN lrn l ON l.learner = e.learner
          WHERE lstate = 'Graduate' AND pstatus IN ('Wage Employed', 'Entrepreneur'))
        GROUP BY program, skills, industry ORDER BY count(*) DESC, program, skills, industry NULLS LAST LIMIT 20""", FIRST5),
    "g31_duration": sql(f"""SELECT program_name AS program, count(*) AS enrollment_count, {r('avg(end_date - start_date)', 0)} AS avg_duration_days,
        {r('avg(end_date - start_date) / 30.0::DOUBLE', 1)} AS avg_duration_months, CAST(min(end_date - start_date) AS INTEGER) AS min_days,
        CAST(max(end_date - start_date) AS INTEGER) AS max_days FROM enr WHERE start_date IS NOT NULL GROUP BY 1 HAVING count(*) > 100
        ORDER BY 3 DESC, 1 LIMIT 10"""),
    "g32_time_to_job": sql(f"SELECT {STATS} FROM gaps WHERE days < 730", GAPS),
    "g32_time_to_job_by_program": sql(f"""SELECT program_name AS program, {STATS} FROM gaps WHERE days < 730 GROUP BY 1
        HAVING count(*) >= 100 ORDER BY avg_days, 1 LIMIT 15""", GAPS),
    "g33_retention": sql("""SELECT is_current AS currently_employed, count(*) AS employment_records, count(DISTINCT learner) AS unique_learners
        FROM works GROUP BY 1"""),
    "g33_retention_rate": sql(f"""SELECT {pct('(SELECT count(DISTINCT learner) FROM works WHERE is_current)',
        '(SELECT sum(u) FROM (SELECT is_current, count(DISTINCT learner) AS u FROM works GROUP BY 1))')} AS retention_rate"""),
    "g34_neighbourhood": sql(f"""SELECT learner, skill_id AS node, 'HAS_SKILL' AS kind FROM skl WHERE learner IN (SELECT learner FROM top1)
        UNION ALL SELECT learner, cohort_code, 'ENROLLED_IN' FROM enr WHERE learner IN (SELECT learner FROM top1)
        UNION ALL SELECT learner, {HASH}, 'WORKS_FOR' FROM works WHERE learner IN (SELECT learner FROM top1)""", TOP1),
    "g34_reachable": sql("""SELECT node, 0 AS depth FROM d0 UNION ALL SELECT node, 1 FROM d1 UNION ALL SELECT node, 2 FROM d2
        UNION ALL SELECT node, 3 FROM d3""", EDGES),
    "g35_multi_hop": sql(f"{HOP} WHERE lower(skill) LIKE '%python%' AND lower(program_name) LIKE '%data%' ORDER BY 1, 3, 5, 6 LIMIT 10"),
    "g36_program_skills_sample": sql("""SELECT e.learner, full_name, program_name AS program, cohort_code AS program_id, array_to_string(skills, ',') AS skills
        FROM enr e JOIN f5 ON f5.learner = e.learner JOIN lrn l ON l.learner = e.learner""", FIRST5),
    "g37_avg_completion": sql(f"""SELECT program_name AS program, {r('avg(completion::DOUBLE)')} AS completion_rate, count(*) AS enrollments
        FROM enr GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "g38_company_regex_skills": sql("""SELECT skill, count(*) AS learner_count FROM works w JOIN skl s ON w.learner = s.learner
        WHERE regexp_matches(lower(company), 'tech|software|digital') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "g39_similar_context": sql("""SELECT x.learner, shared_skills, program_name AS program, cohort_code AS program_id, company FROM (
          SELECT learner, count(*) AS shared_skills FROM skl WHERE skill_id IN (SELECT skill_id FROM skl WHERE learner IN (SELECT learner FROM top1))
          AND learner NOT IN (SELECT learner FROM top1) GROUP BY 1) x
        JOIN enr e ON e.learner = x.learner JOIN works w ON w.learner = x.learner ORDER BY 2 DESC, 1, 4, 5 LIMIT 10""", TOP1),
    "g40_latest_jobs": sql(f"""SELECT w.learner, full_name, company, position, start_date, is_current FROM (
          SELECT * FROM works WHERE start_date IS NOT NULL ORDER BY start_date DESC, learner, {HASH} LIMIT 10) w JOIN lrn l ON l.learner = w.learner"""),
    "g41_rural": sql("SELECT count(*) AS learners FROM lrn WHERE res_code = 'CB' AND is_rural"),
    "g42_single": sql("SELECT count(*) AS learners FROM lrn WHERE res_code = 'CB' AND gender = 'female'"),
    "g43_shortest_path": sql("""SELECT array_to_string(path, ',') AS path, length FROM (
        SELECT [node, dst] AS path, 1 AS length FROM d0 JOIN both_ways ON src = node WHERE dst = 'program:VA-C2001'
        UNION ALL SELECT [node, a.dst, b.dst], 2 FROM d0 JOIN both_ways a ON a.src = node JOIN both_ways b ON b.src = a.dst WHERE b.dst = 'program:VA-C2001'
        UNION ALL SELECT [node, a.dst, b.dst, c.dst], 3 FROM d0 JOIN both_ways a ON a.src = node JOIN both_ways b ON b.src = a.dst
          JOIN both_ways c ON c.src = b.dst WHERE c.dst = 'program:VA-C2001') p ORDER BY length, p.path LIMIT 1""", EDGES),
    "g44_region_rollup": sql("""SELECT region, ct.name AS country, CAST(grouping(region, ct.name) AS INTEGER) AS level, count(*) AS learners
        FROM lrn JOIN ctry ct ON res_code = code GROUP BY ROLLUP (region, ct.name)"""),
    "g45_program_country_learners": sql("""SELECT program_name AS program, count(DISTINCT e.learner) AS learners FROM enr e
        JOIN lrn l ON e.learner = l.learner WHERE res_code = 'CB' AND lower(program_name) LIKE '%data%' GROUP BY 1"""),
    "j01_graduates": sql("SELECT count(*) AS graduate_count FROM lrn WHERE lstate = 'Graduate'"),
    "j01_graduates_flat": sql("SELECT count(*) AS graduate_count FROM prow WHERE grad"),
    "j02_top_countries": sql("""SELECT res_code AS country, count(*) AS learner_count FROM lrn WHERE res_code IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "j02_top_countries_flat": sql("""SELECT coalesce(country, 'n/a') AS country, count(*) AS learner_count FROM prow
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "j03_skill_program_employed": sql(f"{HOP} WHERE lower(skill) LIKE '%python%' ORDER BY 1, 3, 5, 6 LIMIT 20"),
    "j03_flat": sql("""SELECT row_ord, CASE WHEN c_custkey % 8 = 0 THEN 'S' || c_custkey ELSE 'n/a' END AS sand_id,
        coalesce(' ' || full_name || ' ', '') AS full_name,
        ['Python','Data Analysis','Project Management','SQL','Communication','Graphic Design','Cloud','Sales'][row_ord % 8 + 1] || ', ' ||
        lower(['Python','Data Analysis','Project Management','SQL','Communication','Graphic Design','Cloud','Sales'][c_custkey % 8 + 1]) || ',n/a, ' AS skills_list
        FROM prow WHERE row_ord % 8 = 0 AND employed ORDER BY row_ord LIMIT 20"""),
    "j04_effective_programs": sql(f"""SELECT program_name AS program, cohort_code AS program_id, count(*) AS enrollments,
        {r('avg(completion::DOUBLE)', 1)} AS avg_completion_rate, {r('avg(score::DOUBLE)', 1)} AS avg_lms_score
        FROM enr WHERE completion >= 0.5 GROUP BY 1, 2 HAVING count(*) >= 3"""),
    "j04_flat": sql("SELECT count(*) AS enrollment_count FROM prow"),
    "j05_skill_combos": sql("""SELECT array_to_string(skills[1:5], ',') AS top_skills, CAST(len(skills) AS INTEGER) AS total_skills, n AS learner_count FROM (
        SELECT skills, count(*) AS n FROM (SELECT s.learner, list_sort(list(skill)) AS skills FROM skl s JOIN lrn l ON s.learner = l.learner
          WHERE lstate = 'Graduate' AND pstatus IN ('Wage Employed', 'Freelancer', 'Multiple') AND s.learner IN (SELECT learner FROM works) GROUP BY 1)
        WHERE len(skills) >= 3 GROUP BY 1) ORDER BY n DESC, skills LIMIT 10"""),
    "j05_flat": sql("""SELECT ['Python','Data Analysis','Project Management','SQL','Communication','Graphic Design','Cloud','Sales'][row_ord % 8 + 1] || ', ' ||
        lower(['Python','Data Analysis','Project Management','SQL','Communication','Graphic Design','Cloud','Sales'][c_custkey % 8 + 1]) || ',n/a, ' AS skills_list,
        count(*) AS learner_count FROM prow WHERE grad AND employed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "j08_similar_learners": sql("""SELECT s.learner, full_name, count(*) AS shared_skills, array_to_string(list_sort(list(skill))[1:5], ',') AS sample_skills
        FROM skl s JOIN lrn l ON s.learner = l.learner WHERE skill_id IN (SELECT skill_id FROM skl WHERE learner IN (SELECT learner FROM top1))
          AND s.learner NOT IN (SELECT learner FROM top1) GROUP BY 1, 2 HAVING count(*) >= 3 ORDER BY 3 DESC, 1 LIMIT 10""", TOP1),
    "j09_recommend_programs": sql(f"""SELECT program_name AS recommended_program, cohort_code AS program_id,
        count(DISTINCT e.learner) AS similar_learners_count, {r('avg(score::DOUBLE)', 1)} AS avg_score FROM enr e
        WHERE is_completed AND completion >= 0.5 AND learner IN (
          SELECT learner FROM skl WHERE skill_id IN (SELECT skill_id FROM skl WHERE learner IN (SELECT learner FROM top1))
          AND learner NOT IN (SELECT learner FROM top1) GROUP BY 1 HAVING count(*) >= 3)
        GROUP BY 1, 2 ORDER BY 3 DESC, 4 DESC NULLS LAST, 2 LIMIT 5""", TOP1),
    "j10_country_time_to_job": sql(f"""SELECT res_code AS country, count(*) AS sample_size, {r('avg(days)', 0)} AS avg_days_to_employment,
        {r('avg(days) / 30.0::DOUBLE', 1)} AS avg_months_to_employment FROM gaps g JOIN lrn l ON l.learner = g.learner
        WHERE days > 0 AND days <= 730 AND is_completed AND res_code IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""", GAPS),
    "j11_rich_profiles": sql("""SELECT l.learner, full_name, lstate AS current_learning_state, pstatus AS current_professional_status,
        s AS skill_count, p AS program_count, coalesce(c, 0) AS company_count FROM lrn l
        JOIN (SELECT learner, count(*) AS s FROM skl GROUP BY 1) a ON a.learner = l.learner
        JOIN (SELECT learner, count(*) AS p FROM enr GROUP BY 1) b ON b.learner = l.learner
        LEFT JOIN (SELECT learner, count(*) AS c FROM works GROUP BY 1) d ON d.learner = l.learner
        ORDER BY s + p + coalesce(c, 0) DESC, l.learner LIMIT 10"""),
    "j12_profile": sql("""SELECT l.learner, full_name, gender, res_code AS country_of_residence_code, education_level,
        lstate AS current_learning_state, pstatus AS current_professional_status, skills, programs, employment
        FROM lrn l JOIN top1 t ON t.learner = l.learner LEFT JOIN s1 ON s1.learner = l.learner LEFT JOIN p1 ON p1.learner = l.learner
        LEFT JOIN e1 ON e1.learner = l.learner""", PROFILE_CTES),
    "j13_timeline": sql(f"""SELECT * FROM (
        SELECT learner, start_date AS date, 'Program' AS type, cohort_code AS label, status AS detail, 1 AS priority FROM enr
          WHERE learner IN (SELECT learner FROM top1) AND start_date IS NOT NULL
        UNION ALL SELECT learner, start_date, 'Employment', position, company, CASE WHEN is_current THEN 2 ELSE 3 END FROM (
          SELECT *, row_number() OVER (PARTITION BY is_current ORDER BY start_date, {HASH}) AS rk FROM works
          WHERE learner IN (SELECT learner FROM top1) AND start_date IS NOT NULL) WHERE rk <= CASE WHEN is_current THEN 5 ELSE 1 END)
        ORDER BY date, priority, label, detail LIMIT 10""", TOP1),
    "j14_state_pct": sql(f"""SELECT lstate AS state, count(*) AS learner_count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage
        FROM lrn GROUP BY 1"""),
    "t1_top_countries": sql("""SELECT ct.name AS country, code AS country_code, count(*) AS learner_count FROM lrn JOIN ctry ct ON res_code = code
        GROUP BY 1, 2 ORDER BY 3 DESC, 2 LIMIT 10"""),
    "t2_program_completion": sql(f"SELECT program_name AS program, {COMP} FROM enr GROUP BY 1 ORDER BY completion_rate DESC, 1 LIMIT 20"),
    "t2_one_program": sql(f"SELECT program_name AS program, {COMP} FROM enr WHERE program_name = 'Data Science' GROUP BY 1"),
    **{
        key: sql(f"""SELECT program_name AS program, count(DISTINCT e.learner) AS total_learners, count(DISTINCT w.learner) AS employed_learners,
        {pct('count(DISTINCT w.learner)', 'count(DISTINCT e.learner)')} AS employment_rate
        FROM enr e LEFT JOIN (SELECT DISTINCT learner FROM works WHERE {VALID}) w ON e.learner = w.learner {where} GROUP BY 1
        HAVING count(DISTINCT w.learner) > 0 {having} ORDER BY 4 DESC, 1 LIMIT 20""")
        for key, where, having in (
            ("t3_employment_rate", "", "AND count(DISTINCT e.learner) > 100"),
            ("t3_one_program", "WHERE program_name = 'Data Science'", ""),
        )
    },
    "t4_top_skills": sql("SELECT skill, category, count(*) AS learner_count FROM skl GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20"),
    "t4_technical_skills": sql("""SELECT skill, category, count(*) AS learner_count FROM skl WHERE category = 'Technical'
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20"""),
    "t5_learner_journey": sql(f"""SELECT l.learner, full_name, gender, education_level, ct.name AS country_of_residence, ci.name AS city_of_residence,
        lstate AS learning_state, pstatus AS professional_status, s.skills, p.programs, e.employment
        FROM lrn l JOIN top1 t ON t.learner = l.learner LEFT JOIN ctry ct ON ct.code = res_code LEFT JOIN city ci ON ci.id = city_id
        LEFT JOIN (SELECT learner, array_to_string(list_sort(list(DISTINCT skill)), ',') AS skills FROM skl GROUP BY 1) s ON s.learner = l.learner
        LEFT JOIN (SELECT learner, {packed('program_name', 'status', 'completion::DOUBLE', 'score::DOUBLE')} AS programs FROM enr GROUP BY 1) p ON p.learner = l.learner
        LEFT JOIN (SELECT learner, {packed('company', 'position', 'is_current', 'start_date')} AS employment FROM works WHERE {VALID} GROUP BY 1) e ON e.learner = l.learner""", TOP1),
    **{
        key: sql(f"""SELECT skill, count(DISTINCT s.learner) AS employed_learners_with_skill FROM skl s JOIN lrn l ON l.learner = s.learner
        WHERE s.learner IN (SELECT learner FROM works WHERE {VALID}) {cond} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
        for key, cond in (("t6_skills_employed", ""), ("t6_skills_employed_country", "AND res_code = 'CB'"))
    },
    "t7_geo_learners": sql(tcount("learner_count"), "x AS (SELECT res_code AS code, count(*) AS learner_count FROM lrn GROUP BY 1)"),
    "t7_geo_programs": sql(tcount("program_count"), """x AS (SELECT res_code AS code, count(DISTINCT cohort_code) AS program_count
        FROM lrn l JOIN enr e ON e.learner = l.learner GROUP BY 1)"""),
    "t7_geo_companies": sql(tcount("company_count"), f"""x AS (SELECT res_code AS code, count(DISTINCT company) AS company_count
        FROM lrn l JOIN works w ON w.learner = l.learner WHERE {VALID} GROUP BY 1)"""),
    "t7_geo_unknown_metric": sql(tcount('x."count" AS "count"'), 'x AS (SELECT res_code AS code, count(*) AS "count" FROM lrn GROUP BY 1)'),
    "t8_time_to_employment": sql(f"""SELECT program_name AS program, count(*) AS sample_size, {r('avg(days)', 0)} AS avg_days,
        {r('quantile_cont(days::DOUBLE, 0.5)', 0)} AS median_days FROM gaps WHERE {VALID} GROUP BY 1 HAVING count(*) > 10 ORDER BY 3, 1 LIMIT 20""", GAPS),
    "t8_day_component": sql(f"""SELECT program_name AS program, count(*) AS sample_size, {r('avg(c)', 0)} AS avg_days,
        {r('quantile_cont(c::DOUBLE, 0.5)', 0)} AS median_days FROM (
          SELECT *, job_start - CAST(graduation_date + to_months(CAST({MONTHS} AS INTEGER)) AS DATE) AS c FROM gaps)
        WHERE {VALID} GROUP BY 1 HAVING count(*) > 10 ORDER BY 3, 1 LIMIT 20""", GAPS),
    "t8_one_program": sql(f"""SELECT program_name AS program, count(*) AS sample_size, {r('avg(days)', 0)} AS avg_days,
        {r('quantile_cont(days::DOUBLE, 0.5)', 0)} AS median_days, CAST(min(days) AS INTEGER) AS min_days, CAST(max(days) AS INTEGER) AS max_days
        FROM gaps WHERE {VALID} AND program_name = 'Data Science' GROUP BY 1""", GAPS),
}
