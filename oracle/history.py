"""SQL of the state histories and temporal questions, by plain windows and self joins."""

from oracle.ctes import r, sql

AS_OF = "DATE '2001-12-31'"


def learning(source: str) -> str:
    return f"""
le AS (SELECT learner, row_ord, start_date AS s, end_date AS en, graduation_date AS g,
    CASE WHEN status = 'Graduated' THEN 'Graduate' WHEN lower(status) LIKE '%drop%' THEN 'Dropped Out' ELSE 'Active' END AS fin,
    program_name || ' (' || cohort_code || ')' AS what FROM {source}),
lc AS (SELECT *, CASE WHEN fin = 'Graduate' AND g IS NOT NULL THEN g WHEN fin = 'Dropped Out' AND en IS NOT NULL THEN en
    WHEN en < {AS_OF} THEN en END AS closed FROM le),
ln AS (SELECT *, CASE WHEN s IS NOT NULL THEN lead(s) OVER (PARTITION BY learner, s IS NULL ORDER BY s, row_ord) END AS nx,
    row_number() OVER (PARTITION BY learner ORDER BY s DESC NULLS LAST, row_ord DESC) = 1 AS lst FROM lc),
lg AS (SELECT *, CASE WHEN nx - closed > 180 THEN nx - closed END AS gap, s IS NOT NULL AND closed IS NOT NULL AND fin <> 'Active' AS fr FROM ln),
hl AS (
  SELECT learner, row_ord, 0 AS pos, 0 AS step, fin AS state, NULL::DATE AS start_date, coalesce(en, g) AS end_date, lst AS is_current,
    'Enrolled in ' || what || ' (date unknown)' AS reason, true AS date_unknown FROM lg WHERE s IS NULL
  UNION ALL SELECT learner, row_ord, 0, 0, 'Active', s, closed, lst AND NOT fr, 'Enrolled in ' || what, false FROM lg WHERE s IS NOT NULL
  UNION ALL SELECT learner, row_ord, 0, 1, fin, closed, CASE WHEN gap IS NOT NULL THEN closed END, lst,
    CASE WHEN fin = 'Graduate' THEN 'Graduated from ' ELSE 'Dropped out of ' END || what, false FROM lg WHERE fr
  UNION ALL SELECT learner, row_ord, 0, CASE WHEN fr THEN 2 ELSE 1 END, 'Inactive', closed, nx, false,
    'Gap of ' || gap || ' days between programs', false FROM lg WHERE gap IS NOT NULL
)"""


def professional(flags: bool) -> str:
    final = "pstatus" if flags else "'Unemployed'"
    note = "CASE WHEN pstatus = 'Unemployed' THEN 'After last employment ended' ELSE 'Current status from placement/flags' END" \
        if flags else "'After last employment ended'"
    return f"""
pe0 AS (SELECT j.learner, j.row_ord, j.pos, j.start_date AS s, j.end_date AS en, j.is_current AND j.end_date IS NULL AS cur,
    CASE WHEN regexp_matches(lower(position), 'founder|entrepreneur|ceo|owner|venture|startup') THEN 'Entrepreneur'
      WHEN regexp_matches(lower(position), 'freelance|consultant|contractor|self-employed') THEN 'Freelancer' ELSE 'Wage Employed' END AS cls,
    position || ' at ' || company AS what, pstatus FROM job j JOIN lrn l ON l.learner = j.learner),
pe1 AS (SELECT *, row_number() OVER w AS rn, coalesce(lag(en) OVER w, {AS_OF}) AS pend, lead(s) OVER w AS nx,
    count(s) OVER (PARTITION BY learner) AS nd, count(*) FILTER (WHERE s IS NULL) OVER (PARTITION BY learner) AS nu,
    row_number() OVER (PARTITION BY learner ORDER BY s DESC NULLS LAST, row_ord DESC, pos DESC) = 1 AS lst
  FROM pe0 WINDOW w AS (PARTITION BY learner, s IS NULL ORDER BY s, row_ord, pos)),
pe2 AS (SELECT *, s IS NOT NULL AND rn = 1 AND nu = 0 AS ini, s IS NOT NULL AND rn > 1 AND s - pend > 30 AS gp,
    s IS NOT NULL AND lst AND en IS NOT NULL AS fnl FROM pe1),
hp AS (
  SELECT learner, row_ord, pos, 0 AS step, cls AS status, NULL::DATE AS start_date, en AS end_date, (cur AND nd = 0) OR lst AS is_current,
    what || ' (date unknown)' AS details, true AS date_unknown FROM pe2 WHERE s IS NULL
  UNION ALL SELECT learner, row_ord, pos, 0, 'Unemployed', s - 365, s, false, 'Before first employment', false FROM pe2 WHERE ini
  UNION ALL SELECT learner, row_ord, pos, 0, 'Unemployed', pend, s, false, 'Gap of ' || (s - pend) || ' days between jobs', false FROM pe2 WHERE gp
  UNION ALL SELECT learner, row_ord, pos, ini::INT + gp::INT, cls, s, CASE WHEN en IS NULL AND nx - {AS_OF} > 30 THEN {AS_OF} ELSE en END,
    cur OR (lst AND NOT fnl), what, false FROM pe2 WHERE s IS NOT NULL
  UNION ALL SELECT learner, row_ord, pos, ini::INT + gp::INT + 1, {final}, en, NULL, true, {note}, false FROM pe2 WHERE fnl
)"""


def state_edges(h: str, value: str, name: str) -> str:
    return f"""{name} AS (SELECT learner, {value}, start_date AS valid_from, end_date AS valid_to, is_current FROM (
    SELECT *, row_number() OVER (PARTITION BY learner, {value}, start_date ORDER BY row_ord DESC, pos DESC, step DESC) AS rn
    FROM {h} WHERE start_date IS NOT NULL) WHERE rn = 1)"""


LE = learning("ent") + ", " + state_edges("hl", "state", "se")
PE = professional(True) + ", " + state_edges("hp", "status", "pse")


def months(a: str, b: str) -> str:
    return f"((year({b}) - year({a})) * 12 + month({b}) - month({a}) - CASE WHEN day({b}) < day({a}) THEN 1 ELSE 0 END)"


SEQ = f"""SELECT a.learner, a.valid_from AS date_1, b.valid_from AS date_2, c.valid_from AS date_3,
    CAST({months('a.valid_from', 'b.valid_from')} AS INTEGER) AS months_1, CAST({months('b.valid_from', 'c.valid_from')} AS INTEGER) AS months_2
    FROM se a JOIN se b ON a.learner = b.learner AND b.valid_from > a.valid_from
    JOIN se c ON c.learner = a.learner AND c.valid_from > b.valid_from
    WHERE a.state = 'Dropped Out' AND b.state = 'Active' AND c.state = 'Graduate'"""
PAIR = f"""SELECT a.learner, a.valid_from AS date_1, b.valid_from AS date_2, CAST({months('a.valid_from', 'b.valid_from')} AS INTEGER) AS months_1
    FROM pse a JOIN pse b ON a.learner = b.learner AND b.valid_from > a.valid_from
    WHERE a.status = 'Unemployed' AND b.status = 'Wage Employed' ORDER BY months_1, learner, date_1, date_2 LIMIT 20"""
ADJ = """adj AS (SELECT learner, {v} AS f, lead({v}) OVER w AS t, valid_from AS from_date, lead(valid_from) OVER w AS to_date
    FROM {e} WINDOW w AS (PARTITION BY learner ORDER BY valid_from, {v}))"""


def distribution(step: int) -> str:
    return f"""SELECT state, CAST(p AS DATE) AS period, count(*) AS n FROM se
    JOIN (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2005-01-01', INTERVAL {step} MONTH)) AS p) t
      ON p >= valid_from AND p <= coalesce(valid_to, {AS_OF}) GROUP BY 1, 2"""


CURRENT = {
    "date": f"end_date IS NULL OR end_date >= {AS_OF}",
    "flag": "is_current",
    "open": "end_date IS NULL",
}


def jobs_by(rule: str) -> str:
    return f"SELECT learner, count(*) FILTER (WHERE {CURRENT[rule]}) AS current_jobs FROM job GROUP BY 1"


ORACLES = {
    "st_learning": sql("""SELECT CASE WHEN grad THEN 'Graduate' WHEN drp THEN 'Dropped Out' WHEN act THEN 'Active' ELSE 'Inactive' END AS state,
        count(*) AS n FROM prow GROUP BY 1"""),
    "st_professional": sql(f"""SELECT c.learner, CASE WHEN coalesce(current_jobs, 0) >= 2 THEN 'Multiple' WHEN current_jobs = 1 AND venture AND NOT wage THEN 'Entrepreneur'
        WHEN current_jobs = 1 THEN 'Wage Employed' WHEN venture THEN 'Entrepreneur' WHEN wage THEN 'Wage Employed' ELSE 'Unemployed' END AS status
        FROM cust c LEFT JOIN ({jobs_by('date')}) j ON j.learner = c.learner"""),
    "st_status_flags": sql("""SELECT learner, CASE WHEN wage::INT + venture::INT + free::INT >= 2 THEN 'Multiple' WHEN venture THEN 'Entrepreneur'
      WHEN wage THEN 'Wage Employed' WHEN free THEN 'Freelancer' ELSE 'Unemployed' END AS status FROM cust"""),
    "st_job_count": sql(jobs_by("date")),
    "st_job_count_flag": sql(jobs_by("flag")),
    "st_job_count_open_end": sql(jobs_by("open")),
    "hist_learning": sql("SELECT * FROM hl", learning("ent")),
    "hist_learning_json": sql("SELECT * FROM hl", learning("ent")),
    "hist_learning_fallback": sql(f"""SELECT * FROM hl UNION ALL SELECT learner, NULL, NULL, 0, lstate, {AS_OF}, NULL, true, 'Current state', false
        FROM lrn WHERE learner NOT IN (SELECT learner FROM hl)""", learning("ent")),
    "hist_professional": sql("SELECT * FROM hp", professional(True)),
    "hist_professional_no_flags": sql("SELECT * FROM hp", professional(False)),
    "edge_learning_state": sql("SELECT * FROM se", LE),
    "edge_professional_status": sql("SELECT * FROM pse", PE),
    "hist_as_of": sql("""SELECT * FROM se WHERE valid_from <= DATE '1998-06-30' AND (valid_to IS NULL OR valid_to >= DATE '1998-06-30')""", LE),
    "hist_as_of_many": sql("""SELECT d AS as_of, state, count(*) AS n FROM se JOIN (SELECT make_date(y::INT, 6, 30) AS d FROM range(1995, 2002) t(y)) x
        ON valid_from <= d AND (valid_to IS NULL OR valid_to >= d) GROUP BY 1, 2""", LE),
    "hist_as_of_dates": sql("""SELECT day, state, count(*) AS n, CAST(sum(orders) AS BIGINT) AS orders FROM (SELECT od AS day, count(*) AS orders FROM o GROUP BY 1) d
        JOIN se ON valid_from <= day AND (valid_to IS NULL OR valid_to >= day) GROUP BY 1, 2""", LE),
    "hist_time_in_state": sql(f"""SELECT count(*) AS n, {r('avg(b.valid_from - a.valid_from)')} AS avg_days,
        quantile_cont((b.valid_from - a.valid_from)::DOUBLE, 0.5) AS median_days FROM se a JOIN se b ON a.learner = b.learner AND b.valid_from = a.valid_to
        WHERE a.state = 'Active' AND b.state = 'Graduate'""", LE),
    "hist_transitions": sql("""SELECT a.status AS from_state, b.status AS to_state, count(*) AS pairs FROM pse a JOIN pse b
        ON a.learner = b.learner AND b.valid_from > a.valid_from GROUP BY 1, 2""", PE),
    "hist_transitions_first": sql(f"""SELECT a.learner, a.status || ' → ' || b.status AS progression, a.valid_from AS from_date, b.valid_from AS to_date,
        CAST({months('a.valid_from', 'b.valid_from')} AS INTEGER) AS months FROM pse a JOIN pse b ON a.learner = b.learner AND b.valid_from > a.valid_from
        ORDER BY from_date, learner, progression, to_date LIMIT 10""", PE),
    "hist_transitions_adjacent": sql(f"""SELECT learner, f || ' → ' || t AS progression, from_date, to_date,
        CAST({months('from_date', 'to_date')} AS INTEGER) AS months FROM adj WHERE to_date > from_date""", PE + ", " + ADJ.format(v="status", e="pse")),
    "hist_first_transition": sql(PAIR, PE),
    "hist_sequence": sql(SEQ + " ORDER BY months_1, learner, date_1, date_2, date_3 LIMIT 20", LE),
    "hist_sequence_all": sql(SEQ, LE),
    "hist_sequence_earliest": sql("""SELECT learner, date_1, date_2, date_3, months_1, months_2 FROM (
        SELECT *, row_number() OVER (PARTITION BY learner, date_1 ORDER BY date_2, date_3) AS rn FROM q) WHERE rn = 1""", LE + f", q AS ({SEQ})"),
    "hist_reengagement": sql(f"""SELECT learner, date_1, date_2, CAST({months('date_1', 'date_2')} AS INTEGER) AS months_1 FROM (
        SELECT a.learner, a.valid_from AS date_1, min(b.valid_from) AS date_2 FROM se a JOIN se b ON a.learner = b.learner AND b.valid_from > a.valid_from
        WHERE a.state = 'Inactive' AND b.state = 'Active' GROUP BY 1, 2)""", LE),
    "hist_distribution": sql(distribution(1), LE),
    "hist_distribution_quarter": sql(distribution(3), LE),
    "hist_progression_paths": sql(f"""SELECT f || ' → ' || t AS progression, count(*) AS n, {r('avg(' + months('from_date', 'to_date') + ')')} AS avg_months
        FROM adj WHERE to_date > from_date GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", LE + ", " + ADJ.format(v="state", e="se")),
    "j06_unemployed_to_wage": sql(PAIR, PE),
    "j06_flat": sql("SELECT count(*) AS currently_employed FROM prow WHERE wage"),
    "j07_dropout_return": sql(SEQ + " ORDER BY months_1, learner, date_1, date_2, date_3 LIMIT 20", LE),
}
