"""SQL of the cleaning, parsing, entity, edge, validation, profiling and I/O queries."""

from cohortgraph import schemas as S
from oracle.ctes import SKILLS, code, pct, r, sid, sql
from oracle.flat import n
from oracle.history import learning, state_edges

AS_OF = "DATE '2001-12-31'"
D0 = "coalesce(CAST({} AS VARCHAR), '1970-01-01')"
SHA16 = "sha256({})[1:16]"

SKR = f"""sk0 AS (SELECT learner, row_ord, {SKILLS}[row_ord % 8 + 1] AS a, lower({SKILLS}[o_custkey % 8 + 1]) AS b FROM prow),
skx AS (SELECT learner, row_ord, 0 AS pos, {sid('a')} AS skill_id, a AS name FROM sk0
  UNION ALL SELECT learner, row_ord, 1, {sid('b')}, b FROM sk0 WHERE lower(a) <> b),
skc AS (SELECT *, CASE WHEN regexp_matches(lower(name), 'python|sql|data|cloud|ai') THEN 'Technical'
  WHEN regexp_matches(lower(name), 'management|sales') THEN 'Business' WHEN lower(name) = 'communication' THEN 'Soft Skill' ELSE 'Other' END AS category FROM skx)"""
CURR = f"""cur AS (SELECT learner, row_ord, count(*) FILTER (WHERE end_date IS NULL OR end_date >= {AS_OF}) AS k FROM rawjob GROUP BY 1, 2)"""
LASTP = """lastp AS (SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY p.learner ORDER BY p.row_ord DESC) AS rn FROM prow p) WHERE rn = 1)"""
NAT = f"""rc AS (SELECT row_ord, 0 AS r, {code('c_nationkey')} AS code, country AS name, c_nationkey * 1.5::DOUBLE AS latitude FROM prow WHERE country IS NOT NULL
  UNION ALL SELECT row_ord, 1, orig_code, 'nation_' || ((c_nationkey + c_custkey % 3) % 25), NULL FROM prow)"""
CITYQ = """cq AS (SELECT arg_min(city, row_ord) AS name, arg_min(c_custkey % 7, row_ord)::DOUBLE AS latitude, res_code || '-' || upper(city) AS id,
  arg_min(res_code, row_ord) AS country_code FROM prow WHERE res_code IS NOT NULL GROUP BY 3)"""
RWORKS = f"""rw AS (SELECT * FROM (SELECT learner, {SHA16.format('org')} AS company_id, title AS position, start_date, end_date, flag AS is_current,
  row_number() OVER (PARTITION BY learner, org ORDER BY row_ord DESC, pos DESC) AS rn FROM rawjob) WHERE rn = 1)"""
ERRL = """el AS (SELECT row_ord, array_to_string([x FOR x IN [
    CASE WHEN full_name IS NULL THEN 'Missing required field: full_name' END,
    CASE WHEN c_custkey % 8 <> 0 THEN 'Missing required field: sand_id' END,
    CASE WHEN length(coalesce(res_code, country, 'n/a')) <> 2 THEN 'Invalid country_of_residence_code: ' || coalesce(res_code, country, 'n/a') END] IF x IS NOT NULL], ',') AS errors,
    [x FOR x IN [
    CASE WHEN full_name IS NULL THEN 'Missing required field: full_name' END,
    CASE WHEN c_custkey % 8 <> 0 THEN 'Missing required field: sand_id' END,
    CASE WHEN length(coalesce(res_code, country, 'n/a')) <> 2 THEN 'Invalid country_of_residence_code: ' || coalesce(res_code, country, 'n/a') END] IF x IS NOT NULL] AS es
  FROM prow), ee AS (SELECT unnest(es) AS error FROM el)"""


def rng(col: str, src: str) -> str:
    return f"CASE WHEN {src} > 90 THEN '{col} must be between 0 and 90, got ' || {src} || '.0' END"


ERRE = f"""en0 AS (SELECT row_ord, [x FOR x IN [{rng('assignment_completion_rate', 'assign_rate')}, {rng('milestone_completion_rate', 'mile_rate')},
    {rng('test_completion_rate', 'test_rate')}, {rng('lms_overall_score', 'score')}] IF x IS NOT NULL] AS es FROM ent),
  en1 AS (SELECT unnest(es) AS error FROM en0)"""
ERRJ = """ej AS (SELECT row_ord, pos, CASE WHEN end_date < start_date THEN 'end_date (' || end_date || ') before start_date (' || start_date || ')' END AS e1,
    CASE WHEN end_date IS NOT NULL AND flag THEN 'is_current=True but end_date is set' END AS e2 FROM rawjob)"""
CONS = """st AS (SELECT learner, CASE WHEN wage::INT + venture::INT + free::INT >= 2 THEN 'Multiple' WHEN venture THEN 'Entrepreneur'
      WHEN wage THEN 'Wage Employed' WHEN free THEN 'Freelancer' ELSE 'Unemployed' END AS status FROM cust),
  jc AS (SELECT learner, count(*) AS jobs, count(*) FILTER (WHERE flag) AS cur, count(DISTINCT coalesce(CAST(start_date AS VARCHAR), '1970-01-01')) FILTER (WHERE flag) AS ds,
    min(coalesce(CAST(start_date AS VARCHAR), '1970-01-01')) FILTER (WHERE flag) AS ms FROM rawjob GROUP BY 1),
  sj AS (SELECT st.learner, status, coalesce(jobs, 0) AS jobs, coalesce(cur, 0) AS cur, ds, ms FROM st LEFT JOIN jc ON jc.learner = st.learner)"""
METRICS = f"""qm AS (SELECT count(*) AS total_records, {n("errors = ''")} AS valid_records, {n("errors <> ''")} AS invalid_records,
    {r(n("errors <> ''") + '/ count(*)::DOUBLE', 4)} AS error_rate, {r(n("errors = ''") + '/ count(*)::DOUBLE', 4)} AS success_rate FROM el)"""
VALFIELDS = {
    "index": "false", "program_name": "false", "cohort_code": "false", "program_start_date": "start_date IS NULL",
    "program_end_date": "false", "enrollment_status": "false", "program_graduation_date": "graduation_date IS NULL",
    "lms_overall_score": "score IS NULL", "no_of_assignments": "n_assign IS NULL", "no_of_submissions": "n_sub IS NULL",
    "no_of_assignment_passed": "n_pass IS NULL", "assignment_completion_rate": "assign_rate IS NULL",
    "no_of_milestone": "n_mile IS NULL", "no_of_milestone_submitted": "n_mile_sub IS NULL",
    "no_of_milestone_passed": "n_mile_pass IS NULL", "milestone_completion_rate": "mile_rate IS NULL",
    "no_of_test": "n_test IS NULL", "no_of_test_submitted": "n_test_sub IS NULL", "no_of_test_passed": "n_test_pass IS NULL",
    "test_completion_rate": "test_rate IS NULL", "completion_rate": "completion IS NULL",
}
P02 = " UNION ALL ".join(
    f"SELECT '{f}' AS field, {pct(f'count(*) - {n(c)}', 'count(*)')} AS valid_pct, 0.0::DOUBLE AS missing_pct, "
    f"{pct(n(c), 'count(*)')} AS sentinel_pct FROM ent" for f, c in VALFIELDS.items()
)


def long(key: str, items: dict, source: str, extra=None) -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS {key}, {n(c)} AS n{', ' + pct(n(c), 'count(*)') + ' AS share_pct' if extra else ''} FROM {source}" for k, c in items.items()
    )


def share(cols: str, source: str, keys: str) -> str:
    return f"SELECT {cols}, count(*) AS n, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage FROM {source} GROUP BY {keys}"


def top(value: str, source: str, limit: str = "") -> str:
    return f"""SELECT {value} AS value, count(*) AS n, {pct('count(*)', f'(SELECT count(*) FROM {source})')} AS share_pct FROM {source} GROUP BY 1
        ORDER BY 2 DESC, 1 {limit}"""


def edu_top(value: str) -> str:
    return sql(f"""SELECT {value} AS value, count(*) AS n, {n('graduated')} AS graduated, {pct('count(*)', '(SELECT count(*) FROM sc)')} AS share_pct,
        {pct(n('graduated'), 'count(*)')} AS graduation_rate FROM sc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")


ENRCOLS = """learner, cohort_code AS program_id, 1::BIGINT AS "index", status AS enrollment_status, start_date, end_date, graduation_date,
    score::DOUBLE AS lms_overall_score, completion::DOUBLE AS completion_rate, assign_rate::DOUBLE AS assignment_completion_rate,
    mile_rate::DOUBLE AS milestone_completion_rate, test_rate::DOUBLE AS test_completion_rate, n_assign AS number_of_assignments,
    n_sub AS number_of_submissions, n_pass AS number_of_assignments_passed, n_mile AS number_of_milestones, n_mile_sub AS number_of_milestones_submitted,
    n_mile_pass AS number_of_milestones_passed, n_test AS number_of_tests, n_test_sub AS number_of_tests_submitted, n_test_pass AS number_of_tests_passed,
    is_completed, is_dropped, CAST(end_date - start_date AS INTEGER) AS duration"""
FLAGS = {"is_graduate_learner": "grad", "is_active_learner": "act", "is_a_dropped_out": "drp"}
BUCKET = """CASE WHEN d / 365.25::DOUBLE < 0 THEN '< 0 (invalid)' WHEN d / 365.25::DOUBLE < 1 THEN '< 1 year' WHEN d / 365.25::DOUBLE < 2 THEN '1-2 years'
    WHEN d / 365.25::DOUBLE < 3 THEN '2-3 years' WHEN d / 365.25::DOUBLE < 4 THEN '3-4 years' WHEN d / 365.25::DOUBLE < 5 THEN '4-5 years'
    WHEN d / 365.25::DOUBLE < 6 THEN '5-6 years' ELSE '6+ years' END"""
SAND = "CASE WHEN c_custkey % 8 = 0 THEN 'S' || c_custkey END"
TRI = "CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END"
RURAL = "CASE WHEN c_custkey % 5 IN (0, 2) THEN true WHEN c_custkey % 5 IN (1, 3) THEN false END"
BASECOLS = f"""learner AS hashed_email, {SAND} AS sand_id, full_name, CASE WHEN c_custkey % 10 = 0 THEN 'https://photo/x' END AS profile_photo_url,
    NULL::VARCHAR AS bio, field AS education_field, ['Urban','Rural','Prefer not to say'][c_custkey % 3 + 1] AS description_of_living_location,
    NULL::VARCHAR AS type_of_disability, gender, edu_node AS education_level, wage OR venture AS is_placed, c_custkey % 100 = 0 AS is_featured,
    {RURAL} AS is_rural, {TRI} AS has_disability, c_custkey % 3 = 1 AS is_from_low_income_household, 7::BIGINT AS snapshot_id"""

ORACLES = {
    "fn_norm_str": sql(f"SELECT row_ord, full_name, {SAND} AS sand_id FROM prow"),
    "fn_skill_id": sql(f"""SELECT DISTINCT name, {sid('name')} AS id, CASE WHEN regexp_matches(name, 'Python|Data|SQL|Cloud') THEN 'Technical'
        WHEN regexp_matches(name, 'Management|Sales') THEN 'Business' WHEN name LIKE '%Communication' THEN 'Soft Skill' ELSE 'Other' END AS category FROM skn"""),
    "fn_city_id": sql("SELECT row_ord, ['MA','FE','OT','N/'][c_custkey % 4 + 1] || '-' || upper(city) AS city_id FROM prow"),
    "fn_city_id_parity": sql("SELECT row_ord, ['MA','FE','OT','N/'][c_custkey % 4 + 1] || '-' || upper(city[1:3]) AS city_id FROM prow"),
    "fn_parse_date": sql("SELECT row_ord, start_date, graduation_date FROM ent"),
    "fn_parse_num": sql("SELECT row_ord, score::DOUBLE AS score, completion::DOUBLE AS completion FROM ent"),
    "fn_parse_int": sql("SELECT row_ord, n_sub AS submissions, coalesce(n_sub, -99) AS kept FROM ent"),
    "fn_parse_bool": sql(f"SELECT row_ord, {TRI} AS has_disability, wage OR venture AS is_placed FROM prow"),
    "fn_is_rural": sql(f"SELECT row_ord, {RURAL} AS is_rural FROM prow"),
    "fn_gender": sql("SELECT row_ord, gender FROM prow"),
    "fn_education": sql("SELECT row_ord, edu_node AS education_level FROM prow"),
    "fn_hash_id": sql(f"SELECT name, {SHA16.format('name')} AS id FROM cmp"),
    "fn_safe_casts": sql("SELECT row_ord, score::DOUBLE AS d, n_test AS i, start_date AS t FROM ent"),
    "fn_program_match": sql(f"""SELECT {n("program_name LIKE '%Data Analytics%'")} AS specific, {n("program_name LIKE '%Data%'")} AS broad FROM ent"""),
    "fn_valid_company": sql("SELECT count(*) AS n FROM rawjob WHERE org <> 'n/a'"),
    "fn_country_code": sql("""SELECT coalesce(country, 'n/a') AS country_of_residence, res_code AS country_code, count(*) AS n FROM prow GROUP BY 1, 2"""),
    "fn_country_code_auto": sql("""SELECT coalesce(country, 'n/a') AS country_of_residence, coalesce(res_code, 'auto:' || upper(country)) AS country_code, count(*) AS n
        FROM prow GROUP BY 1, 2"""),
    "fn_country_code_auto_parity": sql("""SELECT coalesce(res_code, upper(country[1:2])) AS country_code, count(*) AS n, count(DISTINCT coalesce(country, 'n/a')) AS countries
        FROM prow GROUP BY 1"""),
    "fn_country_code_strict": sql("SELECT coalesce(res_code, 'auto:' || upper(country)) AS country_code, count(*) AS n FROM prow GROUP BY 1"),
    "fn_unmapped_countries": sql("SELECT country, count(*) AS n FROM prow WHERE country IS NOT NULL AND res_code IS NULL GROUP BY 1"),
    "fn_employment_class": sql("""SELECT DISTINCT position AS job_title, company AS organization_name, CASE WHEN position IN ('Founder', 'CEO') THEN 'Entrepreneur'
        WHEN position IN ('Freelance Writer', 'Consultant') THEN 'Freelancer' ELSE 'Wage Employed' END AS cls FROM job"""),
    "fn_is_current_date": sql(f"SELECT end_date IS NULL OR end_date >= {AS_OF} AS is_current, count(*) AS n FROM rawjob GROUP BY 1"),
    "fn_field_map": sql(f"SELECT row_ord, {BASECOLS} FROM prow"),
    "src_country_map": sql("SELECT lower(n_name) AS country_key, 'C' || chr(65 + n_nationkey) AS code FROM nation WHERE n_nationkey < 23"),
    "js_array": sql("""SELECT p.row_ord, 1 AS learning, CAST(coalesce(j.k, 0) AS INTEGER) AS employment, CAST(coalesce(s.k, 0) AS INTEGER) AS education,
        CAST(coalesce(j.k, 0) AS INTEGER) AS doubly_encoded FROM prow p
        LEFT JOIN (SELECT row_ord, count(*) AS k FROM rawjob GROUP BY 1) j ON j.row_ord = p.row_ord
        LEFT JOIN (SELECT row_ord, count(*) AS k FROM sc GROUP BY 1) s ON s.row_ord = p.row_ord"""),
    "js_learning": sql(f"""SELECT learner, row_ord, 0 AS pos, '1' AS "index", program_name, cohort_code, {D0.format('start_date')} AS program_start_date,
        CAST(end_date AS VARCHAR) AS program_end_date, status AS enrollment_status, {D0.format('graduation_date')} AS program_graduation_date,
        CAST(coalesce(score, -99) AS VARCHAR) AS lms_overall_score, CAST(coalesce(completion, -99) AS VARCHAR) AS completion_rate FROM ent"""),
    "js_employment": sql(f"""SELECT learner, row_ord, pos, org AS organization_name, {D0.format('start_date')} AS start_date,
        coalesce(CAST(end_date AS VARCHAR), '9999-12-31') AS end_date, country, title AS job_title, CAST(flag::INT AS VARCHAR) AS is_current FROM rawjob"""),
    "js_education": sql(f"""SELECT learner, row_ord, pos, institution AS institution_name, {D0.format('start_date')} AS start_date, {D0.format('end_date')} AS end_date,
        level AS level_of_study, study_field AS field_of_study, CAST(graduated::INT AS VARCHAR) AS graduated FROM sc"""),
    "js_placement": sql("""SELECT row_ord, CASE WHEN wage THEN 'wage' ELSE 'venture' END AS kind, CASE WHEN wage THEN 'Org ' || (c_custkey % 20) END AS organisation_name,
        CASE WHEN wage THEN ['$0-$500','$501-$1000','$1001-$2000','$2001+'][c_custkey % 4 + 1] END AS salary_range, CASE WHEN NOT wage THEN 'Biz ' || c_custkey END AS business_name,
        CASE WHEN NOT wage THEN c_custkey % 10 END AS jobs_created, CASE WHEN NOT wage THEN c_custkey % 4 END AS female_opportunities FROM prow WHERE wage OR venture"""),
    "js_placement_type": sql("SELECT row_ord, wage OR venture AS has_placement, venture AND NOT wage AS placement_is_venture FROM prow"),
    "js_placement_type_parity": sql("SELECT wage OR venture AS has_placement, false AS placement_is_venture, count(*) AS n FROM prow GROUP BY 1"),
    "js_first_field": sql("SELECT cohort_code, count(*) AS n FROM ent GROUP BY 1"),
    "arr_skills": sql("SELECT * FROM skc", SKR),
    "ent_learner": sql(f"""SELECT {BASECOLS}, res_code AS country_of_residence_code, orig_code AS country_of_origin_code, res_code || '-' || upper(city) AS city_of_residence_id,
        CASE WHEN grad THEN 'Graduate' WHEN drp THEN 'Dropped Out' WHEN act THEN 'Active' ELSE 'Inactive' END AS current_learning_state,
        CASE WHEN coalesce(k, 0) >= 2 THEN 'Multiple' WHEN k = 1 AND venture AND NOT wage THEN 'Entrepreneur' WHEN k = 1 THEN 'Wage Employed'
          WHEN venture THEN 'Entrepreneur' WHEN wage THEN 'Wage Employed' ELSE 'Unemployed' END AS current_professional_status
        FROM lastp p LEFT JOIN (SELECT row_ord, k FROM cur) c ON c.row_ord = p.row_ord""", CURR + ", " + LASTP),
    "ent_country": sql("""SELECT code, name, latitude, NULL::DOUBLE AS longitude FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY row_ord, r) AS rn FROM rc WHERE code IS NOT NULL)
        WHERE rn = 1""", NAT),
    "ent_city": sql("SELECT id, name, country_code, latitude, NULL::DOUBLE AS longitude FROM cq", CITYQ),
    "ent_skill": sql("""SELECT skill_id AS id, name, category FROM (SELECT *, row_number() OVER (PARTITION BY skill_id ORDER BY row_ord, pos) AS rn FROM skc) WHERE rn = 1""", SKR),
    "ent_program": sql("SELECT id, name, id AS cohort_code, 'ALX' AS provider FROM prog"),
    "ent_company": sql(f"""SELECT DISTINCT {SHA16.format('org')} AS id, org AS name, NULL::VARCHAR AS industry, NULL::VARCHAR AS country_code FROM rawjob"""),
    "ent_states": sql("""SELECT state, start_date, end_date, is_current, reason FROM (SELECT *, row_number() OVER (
        PARTITION BY state, start_date ORDER BY learner, row_ord, pos, step) AS rn FROM hl WHERE start_date IS NOT NULL) WHERE rn = 1""", learning("ent")),
    "ent_dedup_first": sql("""SELECT learner, arg_min(row_ord, row_ord) AS row_ord, arg_min(cohort_code, row_ord) AS program_id,
        arg_min_null(score, row_ord)::DOUBLE AS lms_overall_score FROM ent GROUP BY 1"""),
    "ent_dedup_batch": sql("""SELECT learner, program_id, batch FROM (SELECT *, row_number() OVER (PARTITION BY learner ORDER BY batch DESC) AS rn FROM (
        SELECT learner, row_ord // 1000 AS batch, arg_min(cohort_code, row_ord) AS program_id FROM ent GROUP BY 1, 2)) WHERE rn = 1"""),
    "ent_counts": sql("""SELECT 'countries' AS kind, count(DISTINCT code) AS n FROM rc WHERE code IS NOT NULL UNION ALL SELECT 'cities', count(*) FROM cq
        UNION ALL SELECT 'skills', count(DISTINCT skill_id) FROM skc UNION ALL SELECT 'programs', count(*) FROM prog
        UNION ALL SELECT 'companies', count(DISTINCT org) FROM rawjob UNION ALL SELECT 'learners', count(DISTINCT learner) FROM prow""",
        NAT + ", " + CITYQ + ", " + SKR),
    "edge_has_skill": sql("SELECT DISTINCT learner, skill_id FROM skc", SKR),
    "edge_enrolled_in": sql(f"SELECT {ENRCOLS} FROM enr"),
    "edge_enroll_derived": sql("""SELECT row_ord, status = 'Graduated' AS is_completed, status = 'Dropped Out' AS is_dropped,
        CAST(end_date - start_date AS INTEGER) AS duration FROM ent"""),
    "edge_works_for": sql("""SELECT learner, company_id, position, start_date, end_date, is_current, 'employment_details' AS source FROM rw""", RWORKS),
    "edge_work_derived": sql("""SELECT learner, company_id, position, start_date, end_date, end_date IS NULL AS is_current, 'employment_details' AS source,
        CASE WHEN start_date IS NOT NULL AND end_date IS NOT NULL THEN greatest(1, CAST(floor((end_date - start_date) / 30.0) AS INTEGER)) END AS duration FROM rw""", RWORKS),
    "edge_venture": sql(f"""SELECT learner, {SHA16.format("('Biz ' || c_custkey)")} AS company_id, od AS start_date, c_custkey % 10 AS jobs_created,
        floor(c_acctbal)::DOUBLE AS capital_secured, c_custkey % 4 AS female_opportunities, 'Founder' AS role, true AS is_current
        FROM lastp JOIN o ON o_orderkey = row_ord WHERE venture AND NOT wage""", LASTP),
    "edge_geo": sql("""SELECT city.country_code AS city_country, res_code AS country_of_residence_code, orig_code AS country_of_origin_code, count(*) AS n
        FROM lrn JOIN city ON city.id = city_id GROUP BY 1, 2, 3"""),
    "snk_nodes": sql("""SELECT learner, cohort_code AS program_id, score::DOUBLE AS lms_overall_score FROM (
        SELECT *, row_number() OVER (PARTITION BY learner ORDER BY status = 'Graduated' DESC, row_ord DESC) AS rn FROM ent)
        WHERE rn = 1"""),
    "snk_edges": sql("""SELECT learner, cohort_code AS program_id, status AS enrollment_status FROM (
        SELECT *, row_number() OVER (PARTITION BY learner, cohort_code ORDER BY status <> 'Enrolled' DESC, row_ord DESC) AS rn FROM ent
        WHERE status = 'Enrolled' OR (program_name LIKE '%Data%' AND learner IN (SELECT learner FROM lrn WHERE gender IS NOT NULL))) WHERE rn = 1"""),
    "snk_nodes_typed": sql("""SELECT learner AS "hashedEmail", full_name AS "fullName", gender, education_level AS "educationLevel", res_code AS "countryOfResidenceCode",
        orig_code AS "countryOfOriginCode", city_id AS "cityOfResidenceId", lstate AS "currentLearningState", pstatus AS "currentProfessionalStatus",
        is_rural AS "isRural" FROM lrn"""),
    "val_required": sql("SELECT row_ord, errors FROM el", ERRL),
    "val_type": "SELECT 'row_ord must be string, got bigint' AS error, count(*) AS n FROM orders",
    "val_country_len": sql("SELECT split_part(error, ':', 1) AS field, count(*) AS n FROM ee GROUP BY 1", ERRL),
    "val_split": sql("SELECT count(*) AS total, count(*) FILTER (WHERE errors = '') AS good, count(*) FILTER (WHERE errors <> '') AS bad FROM el", ERRL),
    "val_split_good": sql("SELECT row_ord FROM el WHERE errors = ''", ERRL),
    "val_split_bad": sql("SELECT row_ord, errors FROM el WHERE errors <> ''", ERRL),
    "val_enrollment": sql("SELECT row_ord, array_to_string(es, ',') AS errors FROM en0 WHERE len(es) > 0", ERRE),
    "val_employment": sql("SELECT row_ord, pos, concat_ws(',', e1, e2) AS errors FROM ej", ERRJ),
    "val_range": sql("""SELECT row_ord, pos, CASE WHEN end_date < start_date THEN 'education: end_date (' || end_date || ') before start_date (' || start_date || ')'
        ELSE '' END AS errors FROM sc"""),
    "val_emp_consistency": sql("""SELECT learner, rule, cur AS current_jobs, jobs, CASE WHEN rule LIKE 'info%' THEN ms END AS start_date FROM (
        SELECT *, unnest([x FOR x IN [CASE WHEN status = 'Unemployed' AND cur > 0 THEN 'unemployed_with_current_jobs' END,
          CASE WHEN status <> 'Unemployed' AND cur = 0 AND jobs > 0 THEN 'employed_with_past_jobs_only' END,
          CASE WHEN status <> 'Unemployed' AND jobs = 0 THEN 'employed_without_jobs' END,
          CASE WHEN cur > 1 AND ds = 1 THEN 'info_current_jobs_same_start' END] IF x IS NOT NULL]) AS rule FROM sj)""", CONS),
    "val_emp_contradicting_jobs": sql(f"""SELECT learner, org AS organization_name, title AS job_title, {D0.format('start_date')} AS start_date FROM rawjob
        WHERE flag AND learner IN (SELECT learner FROM st WHERE status = 'Unemployed')""", CONS),
    "dq_metrics": sql("SELECT * FROM qm", ERRL + ", " + METRICS),
    "dq_errors_by_type": sql("SELECT error, count(*) AS n FROM ee GROUP BY 1", ERRL),
    "dq_threshold": sql(f"""SELECT total_records, total_records - bad AS valid_records, bad AS invalid_records, {r('bad / total_records::DOUBLE', 4)} AS error_rate,
        {r('(total_records - bad) / total_records::DOUBLE', 4)} AS success_rate, 0.05::DOUBLE AS max_error_rate, bad / total_records::DOUBLE <= 0.05 AS passed
        FROM (SELECT count(*) AS total_records, {n('e1 IS NOT NULL OR e2 IS NOT NULL')} AS bad FROM ej)""", ERRJ),
    "dq_top": sql("SELECT error, count(*) AS n FROM en1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", ERRE),
    "dq_top_fields": sql("SELECT split_part(error, ':', 1) AS field, count(*) AS n FROM ee GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", ERRL),
    "dq_report": sql("""SELECT 'summary' AS section, name, value FROM (SELECT 'total_records' AS name, total_records::DOUBLE AS value FROM qm
          UNION ALL SELECT 'valid_records', valid_records FROM qm UNION ALL SELECT 'invalid_records', invalid_records FROM qm
          UNION ALL SELECT 'error_rate', error_rate FROM qm UNION ALL SELECT 'success_rate', success_rate FROM qm
          UNION ALL SELECT 'max_error_rate', 0.05 UNION ALL SELECT 'passed', CASE WHEN invalid_records / total_records <= 0.05 THEN 1 ELSE 0 END FROM qm)
        UNION ALL SELECT * FROM (SELECT 'top_errors', error, count(*)::DOUBLE FROM ee GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
        UNION ALL SELECT * FROM (SELECT 'problematic_fields', split_part(error, ':', 1), count(*)::DOUBLE FROM ee GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)""", ERRL + ", " + METRICS),
    "dq_mapping_coverage": sql(f"""SELECT count(country) AS named, count(res_code) AS mapped, {pct('count(res_code)', 'count(country)')} AS coverage_pct,
        {pct('count(res_code)', 'count(country)')} < 95 AS warn FROM prow"""),
    "p01_flag_check": sql(" UNION ALL ".join(
        f"SELECT '{f}' AS flag, count(*) AS matches, count(*) AS total, 100.0::DOUBLE AS match_rate FROM prow" for f in FLAGS)),
    "p02_field_completeness": sql(P02),
    "p03_status_values": sql(share("status", "ent", "status")),
    "p04_crosstab": sql("SELECT lower(status) AS status, " + ", ".join(
        f"{n(c)} AS {f}_1, {n('NOT ' + c)} AS {f}_0" for f, c in FLAGS.items()) + " FROM prow GROUP BY 1"),
    "p05_exclusive": sql(long("combination", {
        "graduate_and_active": "grad AND act", "graduate_and_dropped": "grad AND drp", "active_and_dropped": "act AND drp",
        "all_three": "grad AND act AND drp", "none": "NOT grad AND NOT act AND NOT drp"}, "prow")),
    "p06_value_share_program": sql(top("program_name", "ent")),
    "p06_value_share_cohort": sql(top("cohort_code", "ent")),
    "p06_value_share_completion": sql(top("CAST(coalesce(completion, -99) AS VARCHAR)", "ent")),
    "p07_temporal_issues": sql(long("issue", {
        "end_before_start": "end_date < start_date", "graduation_before_start": "graduation_date < start_date", "graduation_after_end": "graduation_date > end_date",
        "graduated_without_date": "status = 'Graduated' AND graduation_date IS NULL", "date_without_graduation": "status <> 'Graduated' AND graduation_date IS NOT NULL"}, "ent")),
    "p08_completion_by_status": sql(f"""SELECT CASE WHEN lower(status) = 'dropped out' THEN 'Dropped Out' ELSE status END AS status, {n('completion = 1')} AS complete,
        {n('completion = 0')} AS incomplete, {n('completion IS NULL')} AS missing FROM ent GROUP BY 1"""),
    "p09_identity": sql(f"""SELECT count(*) AS total_rows, count(DISTINCT learner) AS unique_hashed_email, count(DISTINCT full_name) AS unique_full_name,
        count(DISTINCT {SAND}) AS unique_sand_id, {n('c_custkey % 8 <> 0')} AS missing_sand_id, {pct(n('c_custkey % 8 <> 0'), 'count(*)')} AS missing_sand_id_pct FROM prow"""),
    "p10_multi_program": sql(share("category", """(SELECT CASE WHEN count(*) = 1 THEN 'single' WHEN count(DISTINCT learner) = 1 THEN 'multi_same_key'
        ELSE 'multi_different_keys' END AS category FROM prow WHERE full_name IS NOT NULL GROUP BY full_name)""", "category")),
    "p11_status_combos": sql("""SELECT array_to_string(st, ' + ') AS combination, count(*) AS n FROM (
        SELECT list_sort(list(DISTINCT CASE WHEN lower(status) = 'dropped out' THEN 'Dropped Out' ELSE status END)) AS st FROM prow WHERE full_name IS NOT NULL
        GROUP BY full_name HAVING count(*) > 1) GROUP BY 1"""),
    "p12_concurrent": sql(f"""SELECT count(*) AS people, {n('hit')} AS concurrent, {pct(n('hit'), 'count(*)')} AS concurrent_pct FROM (
        SELECT full_name, bool_or(EXISTS (SELECT 1 FROM prow b WHERE b.full_name = a.full_name AND b.row_ord <> a.row_ord
          AND a.start_date <= b.start_date AND b.start_date < a.end_date)) AS hit FROM prow a WHERE full_name IS NOT NULL AND start_date IS NOT NULL GROUP BY 1)"""),
    "p13_same_person": sql("""SELECT DISTINCT learner AS hashed_email, p.full_name AS person, same_as, keys, enrollments, true AS has_other_enrollments FROM prow p
        JOIN (SELECT full_name, min(learner) AS same_as, count(DISTINCT learner) AS keys, count(*) AS enrollments FROM prow WHERE full_name IS NOT NULL GROUP BY 1
          HAVING count(*) > 1) x ON x.full_name = p.full_name"""),
    "p14_has_flags": sql(" UNION ALL ".join(
        f"SELECT '{f}' AS flag, count(*) - {n(c)} AS flag_0, {n(c)} AS flag_1, {pct(n(f'({c}) = ({held})'), 'count(*)')} AS accuracy_pct FROM prow"
        for f, (c, held) in {
            "has_employment_details": ("row_ord % 3 <> 0", "row_ord % 3 <> 0"),
            "has_education_details": ("c_custkey % 17 <> 0", "c_custkey % 3 = 0 OR c_custkey % 17 <> 0"),
            "has_placement_details": ("wage OR venture", "wage OR venture"),
            "has_profile_profile_photo": ("c_custkey % 10 = 0", "c_custkey % 10 = 0"),
            "has_data": ("row_ord % 8 = 0", "row_ord % 4 = 0"),
            "has_social_economic_data": ("row_ord % 3 = 0", "row_ord % 4 = 0"),
            "has_legacy_points_transactions": ("row_ord % 5 = 0", "row_ord % 5 = 0"),
            "has_disability": ("c_custkey % 3 = 0", "false"),
        }.items())),
    "p15_edu_entries": sql(f"""SELECT entries, count(*) AS n, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage,
        {r('(sum(sum(entries)) OVER ()) / (sum(count(*)) OVER ())::DOUBLE')} AS average, max(max(entries)) OVER () AS maximum
        FROM (SELECT row_ord, CAST(count(*) AS INTEGER) AS entries FROM sc GROUP BY 1) GROUP BY 1"""),
    "p16_edu_institutions": edu_top("institution"),
    "p16_edu_levels": edu_top("level"),
    "p16_edu_fields": edu_top("study_field"),
    "p17_inst_class": sql(share("type, country", """(SELECT CASE WHEN institution LIKE 'Polytechnic%' THEN 'Polytechnic' WHEN institution LIKE 'High School%' THEN 'Secondary/High School'
        WHEN institution LIKE 'Online%' THEN 'Online/Distance' ELSE 'University' END AS type,
        CASE WHEN n_name IN ('NATION_1', 'NATION_2', 'NATION_10') THEN n_name ELSE 'Other/Unknown' END AS country FROM sc)""", "1, 2")),
    "p18_edu_years": sql(f"""SELECT side, y AS year, count(*) AS n, {pct('count(*)', 'sum(count(*)) OVER (PARTITION BY side)')} AS percentage FROM (
        SELECT 'start' AS side, CAST(year(start_date) AS INTEGER) AS y FROM sc UNION ALL SELECT 'end', CAST(year(end_date) AS INTEGER) FROM sc) GROUP BY 1, 2"""),
    "p19_edu_duration": sql(f"""SELECT b AS bucket, count(*) AS n, {pct('count(*)', 'sum(count(*)) OVER ()')} AS percentage,
        {r('(SELECT sum(end_date - start_date) / count(*)::DOUBLE / 365.25::DOUBLE FROM sc WHERE end_date - start_date IS NOT NULL)')} AS average_years,
        {r('(SELECT min(end_date - start_date) / 365.25::DOUBLE FROM sc)')} AS min_years, {r('(SELECT max(end_date - start_date) / 365.25::DOUBLE FROM sc)')} AS max_years
        FROM (SELECT {BUCKET} AS b FROM (SELECT end_date - start_date AS d FROM sc) WHERE d IS NOT NULL) GROUP BY 1"""),
    "p20_edu_progression": sql("""SELECT level || ' → ' || nx AS progression, count(*) AS n FROM (
        SELECT level, lead(level) OVER (PARTITION BY row_ord ORDER BY pos) AS nx FROM sc) WHERE nx IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""),
    "p21_edu_issues": sql(long("issue", {
        "not_graduated_with_past_end": "NOT graduated AND end_date < DATE '1990-01-01'", "invalid_end_date": "end_date IS NULL", "level_missing": "level = 'n/a'",
        "under_six_months": "end_date - start_date BETWEEN 0 AND 182", "over_eight_years": "end_date - start_date > 2922", "future_end_date": "end_date > DATE '1990-01-01'",
        "invalid_start_date": "start_date IS NULL", "end_before_start": "end_date < start_date", "field_missing": "study_field = 'n/a'"}, "sc", True)),
    "p22_emp_crosstab": sql(f"""SELECT *, {pct('n', 'sum(n) OVER (PARTITION BY has_details)')} AS pct_of_has_details, {pct('n', 'sum(n) OVER (PARTITION BY wage_employed)')} AS pct_of_wage_employed
        FROM ({share("CAST(row_ord % 3 <> 0 AS INTEGER) AS has_details, CAST(wage AS INTEGER) AS wage_employed, row_ord % 3 = 0 AS empty_details", "prow", "1, 2, 3")})"""),
    "p23_stale_jobs": sql(share("kind", f"""(SELECT CASE WHEN end_date IS NULL THEN 'sentinel' WHEN end_date < {AS_OF} - 30 THEN 'stale' ELSE 'other' END AS kind
        FROM rawjob WHERE flag)""", "kind")),
    "p24_jobs_per_person": sql(f"""SELECT count(*) AS current_jobs, count(DISTINCT learner) AS people, {r('count(*) / count(DISTINCT learner)::DOUBLE')} AS jobs_per_person
        FROM rawjob WHERE flag"""),
    "p25_source_discrepancy": sql("""SELECT coalesce(a.key, b.key) AS key, coalesce(a.n, 0) AS left_n, coalesce(b.n, 0) AS right_n, coalesce(a.n, 0) - coalesce(b.n, 0) AS difference FROM
        (SELECT country AS key, count(DISTINCT learner) AS n FROM prow WHERE country IS NOT NULL GROUP BY 1) a FULL JOIN
        (SELECT ct.name AS key, count(*) AS n FROM lrn JOIN ctry ct ON res_code = code GROUP BY 1) b ON a.key = b.key"""),
    "src_csv": sql("""SELECT CAST(row_ord AS VARCHAR) AS row_ord, learner AS hashed_email,
        CASE WHEN c_custkey % 61 = 0 THEN '' ELSE ' ' || full_name || ' ' END || chr(10) || 'also "known", as' || chr(13) || chr(10) || learner AS full_name,
        ['Male', 'female', 'Other', 'n/a'][c_custkey % 4 + 1] AS gender, 0 AS differing_cells, 39 AS columns, program_name, status AS enrollment_status FROM prow"""),
    "src_csv_nulls": sql(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*){' FILTER (WHERE row_ord % 11 <> 0)' if c == 'completion_rate' else ' FILTER (WHERE row_ord % 10 <> 0)' if i > 9 else ''} AS filled FROM ent"
        for i, c in enumerate(("learner", "row_ord", "pos", *S.LEARNING_FIELDS)))),
    "src_parquet": sql("SELECT cohort_code AS program_id, count(*) AS n, CAST(sum(n_sub) AS BIGINT) AS submissions FROM ent GROUP BY 1"),
    "src_meta": "SELECT count(*) AS rows, 6 AS columns FROM orders",
    "src_row_range": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 99 AS row_ordinal FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 100)",
    "snk_parquet": "SELECT count(*) AS rows, 39 AS columns FROM orders",
    "inc_two_phase": sql("""SELECT 'learner' AS kind, count(*) AS n FROM lrn UNION ALL SELECT 'country', count(*) FROM ctry UNION ALL SELECT 'city', count(*) FROM city
        UNION ALL SELECT 'skill', count(DISTINCT name) FROM skn UNION ALL SELECT 'program', count(*) FROM prog UNION ALL SELECT 'company', count(*) FROM cmp
        UNION ALL SELECT 'has_skill', count(*) FROM skl UNION ALL SELECT 'enrolled_in', count(*) FROM enr UNION ALL SELECT 'works_for', count(*) FROM works"""),
    "inc_progress": "SELECT (1 - event_id % 2)::INT AS run, 1 AS batches, count(*) AS rows FROM events GROUP BY 1",
    "src_factory": sql("""SELECT source, count(*) AS n, count(DISTINCT learner) AS learners, count(*) FILTER (WHERE wage) AS wage
        FROM prow, (VALUES ('csv'), ('parquet')) s(source) GROUP BY 1"""),
    "snk_clear": sql("SELECT count(*) AS rows, true AS cleared, false AS cleared_again FROM prow"),
    "inc_checkpoint": """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "inc_metrics": sql(f"""SELECT 'total_records' AS kind, count(*) AS n FROM el UNION ALL SELECT 'valid_records', {n("errors = ''")} FROM el
        UNION ALL SELECT 'invalid_records', {n("errors <> ''")} FROM el
        UNION ALL SELECT 'countries', count(DISTINCT code) FROM rc WHERE code IS NOT NULL UNION ALL SELECT 'cities', count(*) FROM cq
        UNION ALL SELECT 'skills', count(DISTINCT skill_id) FROM skc UNION ALL SELECT 'programs', count(*) FROM prog
        UNION ALL SELECT 'companies', count(DISTINCT org) FROM rawjob UNION ALL SELECT 'learners', count(DISTINCT learner) FROM prow""",
        ERRL + ", " + NAT + ", " + CITYQ + ", " + SKR),
}

_LOADED = {"learner": "ent_learner", "country": "ent_country", "city": "ent_city", "skill": "ent_skill", "program": "ent_program", "company": "ent_company",
           "has_skill": "edge_has_skill", "enrolled_in": "edge_enrolled_in", "works_for": "edge_works_for"}
ORACLES["inc_load_raw"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, count(*) AS n, count(*) AS committed, 2 AS version FROM ({ORACLES[name]})" for kind, name in _LOADED.items()
) + f" UNION ALL SELECT 'has_learning_state', count(*), count(*), 2 FROM ({sql('SELECT * FROM se', learning('ent') + ', ' + state_edges('hl', 'state', 'se'))})"
