"""Registered history and temporal queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.bindings import star
from cohortgraph.functions.cleaning import is_set
from cohortgraph.operators import edges, history, parse, states, temporal

AS_OF = star.AS_OF


@star.per_session
def learning(spark, sf_dir):
    return history.learning_history(star.enrolments(spark, sf_dir), AS_OF)


@star.per_session
def learning_from_json(spark, sf_dir):
    return history.learning_history(edges.typed_enrollments(parse.enrollments_raw(star.raw_rows(spark, sf_dir))), AS_OF)


@star.per_session
def numbered_professional(spark, sf_dir):
    return history.professional_history(
        star.numbered_jobs(spark, sf_dir), AS_OF, star.numbered_flags(spark, sf_dir), texts=star.job_texts())


@star.per_session
def professional(spark, sf_dir):
    return star.named(numbered_professional(spark, sf_dir))


@star.per_session
def professional_no_flags(spark, sf_dir):
    return star.named(history.professional_history(star.numbered_jobs(spark, sf_dir), AS_OF, texts=star.job_texts()))


@star.per_session
def learning_edges(spark, sf_dir):
    return edges.has_learning_state(learning(spark, sf_dir))


@star.per_session
def numbered_status_edges(spark, sf_dir):
    return edges.has_professional_status(numbered_professional(spark, sf_dir))


def _flat(df):
    """Entry order as two plain columns."""
    out = df.withColumns({"row_ord": F.col("entry_ord.row_ord"), "pos": F.col("entry_ord.pos")})
    return out.drop("entry_ord")


def _snapshot(spark, sf_dir):
    entries = star.enrolments(spark, sf_dir)
    people = star.learner_nodes(spark, sf_dir).select(
        F.col("hashed_email").alias("learner"), F.col("current_learning_state").alias("state")
    )
    return _flat(history.with_snapshot(history.learning_history(entries, AS_OF), people, AS_OF))


def _order_days(spark, sf_dir):
    """Every day with orders, and how many."""
    return star.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))


def _learning(question, **options):
    return lambda spark, sf: question(learning_edges(spark, sf), **options)


def _status(question, **options):
    """Learners are numbers up to the answer, where ``name`` makes their keys."""
    return lambda spark, sf: question(numbered_status_edges(spark, sf), **options)


def _st_learning(spark, sf):
    raw = star.raw_rows(spark, sf)
    state = states.learning_state(*[is_set(F.col(c)) for c in ("is_graduate_learner", "is_active_learner", "is_a_dropped_out")])
    return raw.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def _st_flags(spark, sf):
    flags = star.learner_flags(spark, sf)
    status = states.status_from_flags(F.col("is_venture"), F.col("is_wage"), F.col("is_freelancer"))
    return flags.select("learner", status.alias("status"))


def _st_professional(spark, sf):
    jobs = states.current_jobs(star.jobs(spark, sf), snapshot=AS_OF)
    placed = parse.placement_flags(star.raw_rows(spark, sf)).groupBy("learner").agg(F.max_by("placement_is_venture", "row_ord").alias("placement_is_venture"))
    df = star.learner_flags(spark, sf).join(jobs, "learner", "left").join(placed, "learner", "left")
    status = states.professional_status(F.col("current_jobs"), F.coalesce("placement_is_venture", F.lit(False)), F.col("is_venture"), F.col("is_wage"))
    return df.select("learner", status.alias("status"))


QUERIES = {
    "st_learning": _st_learning,
    "st_professional": _st_professional,
    "st_status_flags": _st_flags,
    "st_job_count": lambda spark, sf: states.current_jobs(star.jobs(spark, sf), snapshot=AS_OF),
    "st_job_count_flag": lambda spark, sf: states.current_jobs(star.jobs(spark, sf), rule="flag"),
    "st_job_count_open_end": lambda spark, sf: states.current_jobs(star.jobs(spark, sf), rule="open_end"),
    "hist_learning": lambda spark, sf: _flat(learning(spark, sf)),
    "hist_learning_json": lambda spark, sf: _flat(learning_from_json(spark, sf)),
    "hist_learning_fallback": _snapshot,
    "hist_professional": lambda spark, sf: _flat(professional(spark, sf)),
    "hist_professional_no_flags": lambda spark, sf: _flat(professional_no_flags(spark, sf)),
    "edge_learning_state": lambda spark, sf: learning_edges(spark, sf),
    "edge_professional_status": lambda spark, sf: star.named(numbered_status_edges(spark, sf)),
    "hist_as_of": _learning(temporal.state_as_of, day="1998-06-30"),
    "hist_as_of_many": lambda spark, sf: temporal.states_on(
        learning_edges(spark, sf), [f"{y}-06-30" for y in range(1995, 2002)]
    ).groupBy("as_of", "state").agg(F.count("*").alias("n")),
    "hist_as_of_dates": lambda spark, sf: temporal.states_on_dates(learning_edges(spark, sf), _order_days(spark, sf)).groupBy("day", "state").agg(
        F.count("*").alias("n"), F.sum("orders").alias("orders")),
    "hist_time_in_state": _learning(temporal.time_to_graduation),
    "hist_transitions": _status(temporal.transition_counts, state="status", values=S.PROFESSIONAL_STATUSES),
    "hist_transitions_first": _status(temporal.first_transitions, state="status", name=star.learner_key),
    "hist_transitions_adjacent": _status(temporal.adjacent_transitions, state="status", name=star.learner_key),
    "hist_first_transition": _status(temporal.state_sequence, state="status", sequence=["Unemployed", "Wage Employed"], name=star.learner_key),
    "hist_sequence": _learning(temporal.state_sequence, state="state", sequence=["Dropped Out", "Active", "Graduate"]),
    "hist_sequence_earliest": _learning(
        temporal.earliest_completion, state="state", sequence=["Dropped Out", "Active", "Graduate"]
    ),
    "hist_sequence_all": _learning(temporal.state_sequence, state="state", sequence=["Dropped Out", "Active", "Graduate"], limit=None),
    "hist_reengagement": _learning(temporal.earliest_completion, state="state", sequence=["Inactive", "Active"]),
    "hist_distribution": _learning(temporal.distribution_over_time, state="state", as_of=AS_OF),
    "hist_distribution_quarter": _learning(temporal.distribution_over_time, state="state", as_of=AS_OF, months=3),
    "hist_progression_paths": _learning(temporal.progression_paths, state="state"),
    "j06_unemployed_to_wage": _status(temporal.state_sequence, state="status", sequence=["Unemployed", "Wage Employed"], name=star.learner_key),
    "j06_flat": lambda spark, sf: star.raw_rows(spark, sf).filter(F.col("is_wage_employed") == "1").agg(
        F.count("*").alias("currently_employed")
    ),
    "j07_dropout_return": _learning(temporal.state_sequence, state="state", sequence=["Dropped Out", "Active", "Graduate"]),
}
