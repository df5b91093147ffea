"""Histories against hand-made cases and a sequential model on random learners."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortgraph.bindings import star
from cohortgraph.operators import edges, history, temporal
from cohortgraph.plans import registry_history

AS_OF = dt.date(2001, 12, 31)
ENTRY = "learner string, row_ord bigint, pos int, program_name string, cohort_code string, enrollment_status string, " \
    "program_start_date string, program_end_date string, program_graduation_date string"
JOB = "learner string, row_ord bigint, pos int, organization_name string, job_title string, start_date string, end_date string, is_current string"


def learning(spark, rows, **options):
    df = spark.createDataFrame(rows, ENTRY)
    typed = df.select(
        "learner", "row_ord", "pos", "program_name", F.col("cohort_code").alias("program_id"), "enrollment_status",
        *[_date(c).alias(n) for c, n in (
            ("program_start_date", "start_date"), ("program_end_date", "end_date"), ("program_graduation_date", "graduation_date"))],
    )
    return history.learning_history(typed, str(AS_OF), **options)


def _date(c):
    from cohortgraph.functions.cleaning import parse_date

    return parse_date(F.col(c))


def professional(spark, rows, **options):
    return history.professional_history(edges.typed_jobs(spark.createDataFrame(rows, JOB)), str(AS_OF), **options)


def in_order(df, value):
    rows = df.collect()
    key = lambda r: (r.learner, not r.date_unknown, r.entry_ord.row_ord, r.entry_ord.pos, r.step)
    return sorted(rows, key=key)


def states(df, value="state"):
    return [(r[value], str(r.start_date), str(r.end_date), r.is_current) for r in in_order(df, value)]


def test_dropped_out(spark):
    out = states(learning(spark, [("a", 0, 0, "P", "C1", "Dropped Out", "1998-03-01", "1998-06-15", "1970-01-01")]))
    assert out == [("Active", "1998-03-01", "1998-06-15", False), ("Dropped Out", "1998-06-15", "None", True)]


def test_gap_and_no_gap(spark):
    first = ("a", 0, 0, "P1", "C1", "Graduated", "1998-01-01", "1998-06-30", "1998-06-30")
    gap = states(learning(spark, [first, ("a", 0, 1, "P2", "C2", "Enrolled", "1999-03-01", "9999-12-31", "1970-01-01")]))
    assert [s[0] for s in gap] == ["Active", "Graduate", "Inactive", "Active"]
    assert gap[1] == ("Graduate", "1998-06-30", "1998-06-30", False)
    assert gap[2] == ("Inactive", "1998-06-30", "1999-03-01", False) and gap[3][3]
    near = states(learning(spark, [first, ("a", 0, 1, "P2", "C2", "Enrolled", "1998-08-01", "9999-12-31", "1970-01-01")]))
    assert [s[0] for s in near] == ["Active", "Graduate", "Active"] and near[1][2] == "None"


def test_unknown_start_is_kept(spark):
    df = learning(spark, [("a", 0, 0, "P", "C1", "Graduated", "invalid-date", "1998-06-30", "1970-01-01")])
    row = df.first()
    assert (row.state, row.start_date, str(row.end_date), row.date_unknown, row.is_current) == ("Graduate", None, "1998-06-30", True, True)
    assert row.reason == "Enrolled in P (C1) (date unknown)"


def test_ended_job(spark):
    job = ("a", 0, 0, "Acme", "Analyst", "1998-01-01", "1998-12-31", "0")
    out = states(professional(spark, [job]), "status")
    assert [s[0] for s in out] == ["Unemployed", "Wage Employed", "Unemployed"]
    assert out[0][1:3] == ("1997-01-01", "1998-01-01") and out[2] == ("Unemployed", "1998-12-31", "None", True)
    flags = spark.createDataFrame([("a", False, True, False)], "learner string, is_venture boolean, is_wage boolean, is_freelancer boolean")
    last = in_order(professional(spark, [job], flags=flags), "status")[-1]
    assert (last.status, last.details) == ("Wage Employed", "Current status from placement/flags")


def test_job_gap(spark):
    rows = [("a", 0, 0, "A", "Clerk", "1998-01-01", "1998-03-31", "0"), ("a", 0, 1, "B", "Clerk", "1998-08-01", "9999-12-31", "1")]
    out = states(professional(spark, rows), "status")
    assert [s[0] for s in out] == ["Unemployed", "Wage Employed", "Unemployed", "Wage Employed"]
    assert [s[3] for s in out] == [False, False, False, True]


def test_no_jobs(spark):
    people = spark.createDataFrame([("z",)], "learner string")
    job = ("a", 0, 0, "Acme", "Analyst", "1998-01-01", "1998-12-31", "0")
    out = professional(spark, [job], learners=people).filter("learner = 'z'").collect()
    assert [(r.status, r.start_date, r.is_current, r.details) for r in out] == [("Unemployed", AS_OF, True, "No employment history")]


# ---- sequential model ------------------------------------------------------------------------


def model_learning(entries):
    rows, dated = [], sorted((e for e in entries if e["start"]), key=lambda e: (e["start"], e["pos"]))
    fin = {"Graduated": "Graduate", "Dropped Out": "Dropped Out"}
    for e in (e for e in entries if not e["start"]):
        rows.append([fin.get(e["status"], "Active"), None, e["end"] or e["grad"], False])
    for i, e in enumerate(dated):
        state = fin.get(e["status"], "Active")
        if state == "Graduate" and e["grad"]:
            end = e["grad"]
        elif state == "Dropped Out" and e["end"]:
            end = e["end"]
        else:
            end = e["end"] if e["end"] and e["end"] < AS_OF else None
        rows.append(["Active", e["start"], end, False])
        if end and state != "Active":
            rows.append([state, end, None, False])
        if i + 1 < len(dated) and end and (dated[i + 1]["start"] - end).days > 180:
            if rows[-1][2] is None:
                rows[-1][2] = end
            rows.append(["Inactive", end, dated[i + 1]["start"], False])
    if rows:
        rows[-1][3] = True
    return sorted(map(tuple, rows), key=str)


def model_jobs(entries):
    rows, dated = [], sorted((e for e in entries if e["start"]), key=lambda e: (e["start"], e["pos"]))
    unknown = [e for e in entries if not e["start"]]
    for e in unknown:
        rows.append([e["cls"], None, e["end"], e["cur"] and not e["end"] and not dated])
    if dated and not unknown:
        rows.append(["Unemployed", dated[0]["start"] - dt.timedelta(365), dated[0]["start"], False])
    for i, e in enumerate(dated):
        if i:
            end = dated[i - 1]["end"] or AS_OF
            if (e["start"] - end).days > 30:
                if rows[-1][2] is None and rows[-1][1] is not None:
                    rows[-1][2] = end
                rows.append(["Unemployed", end, e["start"], False])
        rows.append([e["cls"], e["start"], e["end"], e["cur"] and not e["end"]])
    if dated and dated[-1]["end"]:
        rows.append(["Unemployed", dated[-1]["end"], None, True])
    rows[-1][3] = True
    return sorted(map(tuple, rows), key=str)


def _day(rng, low=1999, high=2003):
    return dt.date(rng.randint(low, high), rng.randint(1, 12), rng.choice([1, 1, 15]))


def test_random_learners_match_the_model(spark):
    rng = random.Random(7)
    people, text = {}, lambda d: str(d) if d else "1970-01-01"
    for i in range(250):
        people[f"p{i}"] = [
            {
                "pos": p, "start": None if rng.random() < 0.15 else _day(rng), "end": None if rng.random() < 0.3 else _day(rng),
                "grad": None if rng.random() < 0.5 else _day(rng), "status": rng.choice(["Graduated", "Dropped Out", "Enrolled"]),
            } for p in range(rng.randint(1, 6))
        ]
    rows = [
        (k, 0, e["pos"], "P", "C", e["status"], text(e["start"]), text(e["end"]), text(e["grad"])) for k, es in people.items() for e in es
    ]
    got = {}
    for r in learning(spark, rows).collect():
        got.setdefault(r.learner, []).append((r.state, r.start_date, r.end_date, r.is_current))
    for k, es in people.items():
        assert sorted(got[k], key=str) == model_learning(es), k


def test_random_jobs_match_the_model(spark):
    rng = random.Random(11)
    titles = {"Clerk": "Wage Employed", "Founder": "Entrepreneur", "Consultant": "Freelancer"}
    people, text = {}, lambda d, none: str(d) if d else none
    for i in range(250):
        people[f"p{i}"] = []
        for p in range(rng.randint(1, 6)):
            title = rng.choice(list(titles))
            people[f"p{i}"].append({
                "pos": p, "start": None if rng.random() < 0.15 else _day(rng), "end": None if rng.random() < 0.3 else _day(rng),
                "cur": rng.random() < 0.4, "title": title, "cls": titles[title],
            })
    rows = [
        (k, 0, e["pos"], "Org", e["title"], text(e["start"], "1970-01-01"), text(e["end"], "9999-12-31"), str(int(e["cur"])))
        for k, es in people.items() for e in es
    ]
    got = {}
    for r in professional(spark, rows).collect():
        got.setdefault(r.learner, []).append((r.status, r.start_date, r.end_date, r.is_current))
    for k, es in people.items():
        assert sorted(got[k], key=str) == model_jobs(es), k


def test_invariants_and_sequences(spark):
    rng = random.Random(3)
    rows = [
        (f"p{i % 20}", i, 0, "P", "C", rng.choice(["Graduated", "Dropped Out", "Enrolled"]), str(_day(rng)), str(_day(rng)), "1970-01-01")
        for i in range(200)
    ]
    hist = learning(spark, rows)
    assert hist.filter("is_current").groupBy("learner").count().filter("count <> 1").count() == 0
    se = edges.has_learning_state(hist).cache()
    data = [(r.learner, r.state, r.valid_from) for r in se.collect()]
    combos = sorted(
        (temporal_months(a[2], b[2]), a[0], a[2], b[2], c[2])
        for a in data if a[1] == "Dropped Out" for b in data if b[0] == a[0] and b[1] == "Active" and b[2] > a[2]
        for c in data if c[0] == a[0] and c[1] == "Graduate" and c[2] > b[2]
    )
    for k in (1, 3, 20):
        out = temporal.state_sequence(se, "state", ["Dropped Out", "Active", "Graduate"], limit=k).collect()
        assert [(r.months_1, r.learner, r.date_1, r.date_2, r.date_3) for r in out] == combos[:k]


@pytest.mark.parametrize("sequence", [["A", "B", "A", "C"], ["C", "B", "A", "B"], ["A", "B"], ["A", "A", "A"]])
def test_first_combinations_of_many_states(spark, sequence):
    """The first 100 by brute force, also for states that come again; no row carries more than one way."""
    rng = random.Random(len(sequence) + ord(sequence[0]))
    data = {(f"l{rng.randrange(6)}", rng.choice("ABC"), dt.date(2000, 1, 1) + dt.timedelta(rng.randrange(400))) for _ in range(150)}
    df = spark.createDataFrame([(*r, None) for r in data], "learner string, state string, valid_from date, valid_to date").repartition(4)

    def ways(learner, rest, after):
        if not rest:
            return [()]
        return [(d, *w) for x, s, d in data if x == learner and s == rest[0] and (after is None or d > after) for w in ways(learner, rest[1:], d)]

    all_ways = sorted((temporal_months(w[0], w[1]), x, *w) for x in {r[0] for r in data} for w in ways(x, sequence, None))
    dates = [f"date_{i + 1}" for i in range(len(sequence))]
    for k in (1, 7, 100):
        out = temporal.state_sequence(df, "state", sequence, limit=k)
        assert "collect_list" not in out._jdf.queryExecution().toString()
        assert [(r.months_1, r.learner, *(r[d] for d in dates)) for r in out.collect()] == all_ways[:k]
    first = {}
    for w in all_ways:
        key = (w[1], w[2])
        first[key] = min(first.get(key, w[2:]), w[2:])
    assert {(r.learner, r.date_1): tuple(r[d] for d in dates) for r in temporal.earliest_completion(df, "state", sequence).collect()} == first


def test_interval_join_with_a_date_table(spark):
    rng = random.Random(8)
    day = lambda a, b: dt.date(1960, 1, 1) + dt.timedelta(rng.randrange(a, b))
    rows = []
    for i in range(300):
        start = None if i % 50 == 0 else day(0, 20_000)
        end = None if i % 7 == 0 or start is None else start + dt.timedelta(rng.choice([-5, 0, 1, 29, 30, 31, 400, 4_000, 30_000]))
        rows.append((f"l{i}", "S", start, end))
    rows += [("hot", "T", dt.date(1990, 1, 1), None)] * 50
    df = spark.createDataFrame(rows, "learner string, state string, valid_from date, valid_to date").repartition(3)
    days = [(d,) for d in {day(-500, 22_000) for _ in range(120)}] + [(None,), (dt.date(1990, 1, 1),)] * 2
    dates = spark.createDataFrame(days, "day date").repartition(2)
    out = temporal.states_on_dates(df, dates)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = sorted((x, d) for x, _, a, b in rows for (d,) in days if a and d and a <= d and (b is None or b >= d))
    assert sorted((r.learner, r.day) for r in out.collect()) == want
    assert temporal.states_on_dates(df.limit(0), dates).count() == temporal.states_on_dates(df, dates.limit(0)).count() == 0


def temporal_months(a, b):
    return (b.year - a.year) * 12 + b.month - a.month - (b.day < a.day)


def test_one_hot_learner_is_spread(spark):
    """A learner with most rows gives many (learner, day) groups, and the plan has no window over its raw rows."""
    days = [dt.date(1990, 1, 1) + dt.timedelta(i % 900) for i in range(3000)]
    rows = [("hot", i, 0, "P", "C", "Enrolled", str(d), "1970-01-01", "1970-01-01") for i, d in enumerate(days)]
    df = learning(spark, rows)
    assert df.count() == 3000 and df.filter("is_current").count() == 1


def test_no_employment_text_takes_the_snapshot_status(spark):
    people = spark.createDataFrame([("a", None), ("y", "Entrepreneur"), ("z", None)], "learner string, snapshot_status string")
    job = ("a", 0, 0, "Org", "Clerk", "1999-01-01", None, "1")
    out = {r.learner: r for r in professional(spark, [job], learners=people).filter("learner <> 'a'").collect()}
    assert (out["y"].status, out["y"].is_current, out["y"].details) == ("Entrepreneur", True, None)
    assert (out["z"].status, out["z"].details) == ("Unemployed", "No employment history")


def test_venture_placement_of_a_row_makes_its_jobs_ventures(spark):
    jobs = edges.typed_jobs(spark.createDataFrame([("a", 0, 0, "Org", "Product Manager", "1999-01-01", None, "1")], JOB))
    plain = [r.status for r in history.professional_history(jobs, str(AS_OF)).orderBy("step").collect()]
    placed = history.professional_history(jobs.withColumn("placement_is_venture", F.lit(True)), str(AS_OF))
    assert plain[-1] != "Entrepreneur"
    assert [r.status for r in placed.orderBy("step").collect()][-1] == "Entrepreneur"


def test_jobs_are_shuffled_once(spark):
    """Entries are computed once and shuffled by learner; edges and transitions of the history add no shuffle."""
    rows = [(f"p{i % 7}", i, 0, "Org", "Clerk", f"19{90 + i % 9}-01-0{1 + i % 5}", None, "1") for i in range(60)]
    df = professional(spark, rows)
    for result in (df, edges.has_professional_status(df)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan") <= 1
    assert df.filter("details = 'Clerk at Org'").count() == 60


def test_numbered_learners_give_the_rows_of_keyed_ones(spark):
    """The registered history joins, shuffles and sorts numbers; the keys of learners come last."""
    sf = "/root/testdata/sf0.001"
    keyed = history.professional_history(star.jobs(spark, sf), star.AS_OF, star.learner_flags(spark, sf))
    got = registry_history.professional(spark, sf)
    assert got.columns == keyed.columns and got.exceptAll(keyed).isEmpty() and keyed.exceptAll(got).isEmpty()
    for name in ("first_transitions", "adjacent_transitions"):
        plain = getattr(temporal, name)(edges.has_professional_status(keyed), "status").collect()
        numbered = getattr(temporal, name)(registry_history.numbered_status_edges(spark, sf), "status", name=star.learner_key).collect()
        assert sorted(plain) == sorted(numbered)
    plan = registry_history.numbered_professional(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "sha2" not in plan


def test_shuffled_jobs_carry_nothing_twice(spark):
    """The day that orders the entries is their start or a fixed day, so it is made behind the shuffle by learner."""
    rows = [(f"p{i}", i, 0, "Org", "Clerk", "1999-01-01" if i % 2 else "invalid-date", None, "1") for i in range(4)]
    plan = professional(spark, rows)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    shuffled = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert "start#" in plan[shuffled + 1] and "day#" not in plan[shuffled + 1]
