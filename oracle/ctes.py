"""Shared common table expressions.

They restate the learner view of the base tables in plain SQL, without JSON: ``prow``
is one row per order, ``ent`` the enrolment entries, ``job`` the line-item jobs.
"""

from cohortgraph import schemas as S

SKILLS = "['Python','Data Analysis','Project Management','SQL','Communication','Graphic Design','Cloud','Sales']"
TITLES = "['Software Engineer','Founder','Freelance Writer','Analyst','Consultant','Teacher','CEO','Product Manager']"
KINDS = "['Tech','Software House','Bank','Farm']"
CITIES = "['Aldon','Brill','Corvan','Dunmere','Elst','Farrow','Gavle']"
OTHER = "other/prefer not to say"

GENDER = f"CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN '{OTHER}' END"
EDU = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'Bachelor''s degree or equivalent' WHEN 'AUTOMOBILE' THEN 'high school' "
    "WHEN 'MACHINERY' THEN 'Master''s Degree' WHEN 'FURNITURE' THEN 'PhD' ELSE NULL END"
)
EDU_NODE = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'Bachelor''s degree or equivalent' WHEN 'AUTOMOBILE' THEN 'High School' "
    "WHEN 'MACHINERY' THEN 'Master''s degree' WHEN 'FURNITURE' THEN 'PhD' ELSE NULL END"
)


def code(key: str) -> str:
    return f"CASE WHEN {key} < 23 THEN 'C' || chr(CAST(65 + {key} AS INTEGER)) END"


def r(expr: str, digits: int = 2) -> str:
    s = float(10**digits)
    return f"(floor(({expr}) * {s}::DOUBLE + 0.5::DOUBLE)::DOUBLE / {s}::DOUBLE)"


def pct(part: str, whole: str) -> str:
    return r(f"100.0::DOUBLE * ({part})::DOUBLE / nullif(({whole}),0)::DOUBLE")


def sid(name: str) -> str:
    return f"regexp_replace(lower({name}), '[ -]+', '_', 'g')"


BASE = f"""
o AS (
  SELECT *, CAST(o_orderdate AS DATE) AS od,
    CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 120 AS INTEGER) AS pend
  FROM orders
),
ent AS (
  SELECT sha256(CAST(o_custkey AS VARCHAR)) AS learner, o_orderkey AS row_ord, o_custkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Data Analytics' WHEN '2-HIGH' THEN 'Data Science'
      WHEN '3-MEDIUM' THEN 'Software Engineering' WHEN '4-NOT SPECIFIED' THEN 'AI Career Essentials'
      WHEN '5-LOW' THEN 'Virtual Assistant' END AS program_name,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'DA' WHEN '2-HIGH' THEN 'DS' WHEN '3-MEDIUM' THEN 'SE'
      WHEN '4-NOT SPECIFIED' THEN 'AI' WHEN '5-LOW' THEN 'VA' END || '-C' || year(od) AS cohort_code,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE od END AS start_date, pend AS end_date,
    CASE WHEN o_orderstatus = 'F' THEN 'Graduated' WHEN o_orderstatus = 'O' THEN 'Enrolled'
      WHEN o_orderkey % 50 = 0 THEN 'Dropped out' ELSE 'Dropped Out' END AS status,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 200 <> 3 THEN pend END AS graduation_date,
    CASE WHEN o_orderkey % 10 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 101 END AS score,
    CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderstatus = 'F')::INT END AS completion,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 6 + 10 END AS n_assign,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 8 END AS n_sub,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 5 END AS n_pass,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 101 END AS assign_rate,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey * 7 % 101 END AS mile_rate,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey * 3 % 101 END AS test_rate,
    CASE WHEN o_orderkey % 10 <> 0 THEN 5 END AS n_mile,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 5 END AS n_mile_sub,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 4 END AS n_mile_pass,
    CASE WHEN o_orderkey % 10 <> 0 THEN 4 END AS n_test,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 4 END AS n_test_sub,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey % 3 END AS n_test_pass
  FROM o
),
cust AS (
  SELECT c_custkey, c_nationkey, c_acctbal, n_name, sha256(CAST(c_custkey AS VARCHAR)) AS learner,
    {GENDER} AS gender, {EDU} AS edu, {EDU_NODE} AS edu_node,
    CASE WHEN c_custkey % 61 <> 0 THEN 'Person ' || CAST(floor(c_custkey / 2) AS BIGINT) END AS full_name,
    CASE WHEN c_custkey % 40 <> 0 THEN n_name END AS country,
    CASE WHEN c_custkey % 40 <> 0 THEN {code('c_nationkey')} END AS res_code,
    {code('((c_nationkey + c_custkey % 3) % 25)')} AS orig_code,
    {CITIES}[c_custkey % 7 + 1] AS city,
    CASE WHEN c_custkey % 6 <> 5 THEN 'Field ' || (c_custkey % 6) END AS field,
    c_acctbal > 4000 AS wage, c_acctbal > 1000 AND c_acctbal < 5000 AS venture, c_acctbal < 0 AS free
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
prow AS (
  SELECT e.*, c.* EXCLUDE (learner), e.status = 'Graduated' AS grad, e.status = 'Enrolled' AS act,
    lower(e.status) LIKE '%dropped%' AS drp, wage OR venture OR free AS employed
  FROM ent e JOIN cust c ON e.o_custkey = c.c_custkey
),
rj AS (
  SELECT e.learner, e.row_ord, i AS pos, e.row_ord + i AS k, o.od, n_name,
    CASE WHEN i = 1 THEN o.od - 200 ELSE o.od + 30 END AS s0,
    CASE WHEN i = 1 THEN o.od + CAST(e.row_ord % 400 - 150 AS INTEGER) ELSE o.od + CAST(e.row_ord % 90 + 40 AS INTEGER) END AS e0,
    CASE WHEN i = 1 THEN e.row_ord % 2 = 0 ELSE e.row_ord % 7 = 0 END AS open_end
  FROM ent e JOIN o ON e.row_ord = o.o_orderkey JOIN cust c ON e.o_custkey = c.c_custkey
    CROSS JOIN (SELECT unnest([1, 2]) AS i) t
  WHERE e.row_ord % 3 <> 0 AND (i = 1 OR e.row_ord % 5 = 0)
),
rawjob AS (
  SELECT learner, row_ord, pos - 1 AS pos, n_name AS country,
    CASE WHEN k % 25 = 0 THEN 'n/a' ELSE {KINDS}[k % 4 + 1] || ' ' || (k % 40) END AS org,
    CASE WHEN k % 89 <> 0 THEN s0 END AS start_date, CASE WHEN NOT open_end THEN e0 END AS end_date,
    {TITLES}[k % 8 + 1] AS title, open_end OR k % 31 = 0 AS flag
  FROM rj
),
sc AS (
  SELECT e.learner, e.row_ord, i - 1 AS pos, c.*  EXCLUDE (learner),
    ['University of ','Polytechnic of ','High School ','Online Academy '][(c_custkey + i) % 4 + 1] || n_name AS institution,
    CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE make_date(CAST(1980 + c_custkey % 15 + CASE WHEN i = 2 THEN 5 ELSE 0 END AS INTEGER), 9, 1) END AS start_date,
    CASE WHEN (c_custkey + i) % 9 = 0 THEN NULL ELSE make_date(CAST(1980 + c_custkey % 15
      + CASE WHEN i = 2 THEN 5 + c_custkey % 3 - 1 ELSE c_custkey % 6 END AS INTEGER), 6, 30) END AS end_date,
    CASE WHEN i = 2 THEN 'Master''s degree' ELSE coalesce(edu, 'n/a') END AS level,
    CASE WHEN c_custkey % 23 = 0 THEN 'n/a' ELSE 'Field ' || (c_custkey % 6) END AS study_field,
    (c_custkey + i) % 2 = 0 AS graduated
  FROM ent e JOIN cust c ON e.o_custkey = c.c_custkey CROSS JOIN (SELECT unnest([1, 2]) AS i) t
  WHERE (c_custkey % 3 = 0) OR (i = 1 AND c_custkey % 17 <> 0)
),
cmp AS (
  SELECT DISTINCT s_suppkey % 25 <> 0 AS known,
    CASE WHEN s_suppkey % 25 = 0 THEN 'n/a' ELSE {KINDS}[s_suppkey % 4 + 1] || ' ' || s_suppkey END AS name,
    CASE WHEN s_suppkey % 25 <> 0 THEN {KINDS}[s_suppkey % 4 + 1] END AS industry,
    CASE WHEN s_suppkey % 25 <> 0 THEN {code('s_nationkey')} END AS country_code
  FROM supplier
),
job AS (
  SELECT sha256(CAST(o_custkey AS VARCHAR)) AS learner,
    l_orderkey * 1000000 + l_linenumber * 10000 + l_partkey % 10000 AS row_ord, l_suppkey AS pos,
    CASE WHEN l_suppkey % 25 = 0 THEN 'n/a' ELSE {KINDS}[l_suppkey % 4 + 1] || ' ' || l_suppkey END AS company,
    CASE WHEN (l_orderkey + l_linenumber) % 89 <> 0 THEN CAST(l_shipdate AS DATE) END AS start_date,
    CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS end_date,
    {TITLES}[p_size % 8 + 1] AS position, l_linestatus = 'O' OR l_orderkey % 31 = 0 AS is_current
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
works AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY learner, company ORDER BY row_ord DESC, pos DESC) AS rn FROM job
  ) WHERE rn = 1
),
enr AS (
  SELECT * EXCLUDE (rn), status = 'Graduated' AS is_completed, status = 'Dropped Out' AS is_dropped FROM (
    SELECT *, row_number() OVER (PARTITION BY learner, cohort_code ORDER BY row_ord DESC) AS rn FROM ent
  ) WHERE rn = 1
),
prog AS (SELECT DISTINCT cohort_code AS id, program_name AS name FROM ent),
skn AS (
  SELECT DISTINCT p_name, upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' ||
    {SKILLS}[list_position(['anvil','bolt','gear','gizmo','plate','ring','rod','widget'], split_part(p_name, ' ', 2))] AS name
  FROM part
),
skl AS (
  SELECT DISTINCT sha256(CAST(o_custkey AS VARCHAR)) AS learner, s.name AS skill, {sid('s.name')} AS skill_id,
    CASE WHEN regexp_matches(lower(s.name), '{'|'.join(S.TECHNICAL_TERMS)}') THEN 'Technical'
      WHEN regexp_matches(lower(s.name), '{'|'.join(S.BUSINESS_TERMS)}') THEN 'Business'
      WHEN regexp_matches(lower(s.name), '{'|'.join(S.SOFT_TERMS)}') THEN 'Soft Skill'
      ELSE 'Other' END AS category
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part p ON l_partkey = p_partkey JOIN skn s ON p.p_name = s.p_name
),
ctry AS (
  SELECT 'C' || chr(65 + n_nationkey) AS code, n_name AS name, n_nationkey * 1.5::DOUBLE AS latitude,
    'Region ' || n_regionkey AS region FROM nation WHERE n_nationkey < 22
),
city AS (
  SELECT 'C' || chr(65 + n_nationkey) || '-' || upper(nm) AS id, nm AS name, 'C' || chr(65 + n_nationkey) AS country_code
  FROM nation CROSS JOIN (SELECT unnest({CITIES}) AS nm) t WHERE n_nationkey < 23
),
lrn AS (
  SELECT c.learner, full_name, gender, edu_node AS education_level, res_code, orig_code,
    res_code || '-' || upper(city) AS city_id,
    CASE last_status WHEN 'F' THEN 'Graduate' WHEN 'P' THEN 'Dropped Out' WHEN 'O' THEN 'Active' ELSE 'Inactive' END AS lstate,
    CASE WHEN wage::INT + venture::INT + free::INT >= 2 THEN 'Multiple' WHEN venture THEN 'Entrepreneur'
      WHEN wage THEN 'Wage Employed' WHEN free THEN 'Freelancer' ELSE 'Unemployed' END AS pstatus,
    CASE WHEN c_custkey % 5 IN (0, 2) THEN true WHEN c_custkey % 5 IN (1, 3) THEN false END AS is_rural,
    wage, venture, free
  FROM cust c JOIN (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS last_status FROM orders GROUP BY 1) t
    ON t.o_custkey = c.c_custkey
)
"""


def sql(body: str, extra: str = "") -> str:
    """``extra`` holds further CTEs of the form ``x AS (...)``."""
    return f"WITH {BASE}{', ' + extra if extra else ''}\n{body}"
