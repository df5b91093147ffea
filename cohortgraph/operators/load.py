"""Whole load: raw table to graph, dimensions before facts, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.functions import cleaning as C
from cohortgraph.operators import edges, entities, history, parse
from cohortgraph.operators.keyed import last_by
from cohortgraph.operators.model import Graph
from cohortgraph.session import bucketed_table
from cohortgraph.sources.writers import write_graph


def load_graph(raw: DataFrame, dim: DataFrame, path: str, as_of: str, **options) -> dict:
    """Build and store the graph, dimensions first; returns the manifest that makes it visible as a whole.

    What feeds several tables is written once to the shared folder and read back: the typed enrolment and job
    entries, the learner table and the flags. They are stored in buckets of learners, so the entries pass one
    shuffle, and the edges and histories made of them none.
    """
    years, parity = options.get("years", C.YEARS), options.get("parity", False)
    entries = (
        bucketed_table(enrolment_entries(raw, years, whole=True), "load-enrolments", "learner"),
        bucketed_table(job_entries(raw, years, parity), "load-jobs", "learner"),
    )
    return write_graph(build_graph(raw, dim, as_of, entries=entries, store=True, **options), path)


def enrolment_entries(raw: DataFrame, years: tuple[int, int] | None, whole: bool = False) -> DataFrame:
    return edges.typed_enrollments(parse.enrollments_raw(raw), years=years, whole=whole)


def job_entries(raw: DataFrame, years: tuple[int, int] | None, parity: bool) -> DataFrame:
    """Typed jobs with the kind of their row's placement."""
    rows = parse.with_placement_flags(raw.select("hashed_email", "row_ord", "employment_details", "placement_details"), parity)
    return edges.typed_jobs(parse.jobs_raw(rows, keep=("placement_is_venture",)), years=years)


def last_flags(raw: DataFrame, parity: bool = False) -> DataFrame:
    """The status flags of each learner's last row, as the learner table takes them, with the kind of its placement and
    whether it has no employment text (``bare``). Rows without a key have none."""
    flags = {n: C.is_set(F.col(c)) for c, n in (
        ("is_running_a_venture", "is_venture"), ("is_wage_employed", "is_wage"), ("is_a_freelancer", "is_freelancer"))}
    rows = parse.with_placement_flags(raw.filter(F.col("hashed_email").isNotNull()).select(
        F.col("hashed_email").alias("learner"), "row_ord", "placement_details",
        *[c.alias(n) for n, c in flags.items()], (F.coalesce("employment_details", F.lit("")) == "").alias("bare")), parity)
    return last_by(rows, ["learner"], "row_ord", [*flags, "placement_is_venture", "bare"], whole=True)


def build_graph(
    raw: DataFrame,
    dim: DataFrame,
    as_of: str,
    snapshot: str = C.SNAPSHOT_DATE,
    parity: bool = False,
    with_history: bool = True,
    entries: tuple[DataFrame, DataFrame] | None = None,
    store: bool = False,
    years: tuple[int, int] | None = C.YEARS,
    provider: str = S.PROVIDER,
) -> Graph:
    """Node and edge tables from a raw table (with ``row_ord``) and a country dimension.

    About a dozen outputs read the raw table, each only its own columns; store the graph
    (``load_graph``) rather than querying the returned plans again and again. ``entries`` are
    already parsed and typed (enrolments, jobs with the kind of their row's placement); ``years`` bounds usable dates;
    ``store`` writes the learner table and the flags before the histories read them, and the ids of skill names before the edges do;
    as all columns are stored then, edges are found as whole rows.
    """
    enrolments, jobs = entries or (enrolment_entries(raw, years), job_entries(raw, years, parity))
    learner = entities.learners(raw, dim, snapshot=snapshot, parity=parity)
    learner = bucketed_table(learner, "load-learners", "hashed_email") if store else learner
    states = statuses = None
    if with_history:
        current = learner.select(F.col("hashed_email").alias("learner"), F.col("current_learning_state").alias("state"))
        flags = last_flags(raw, parity)
        flags = bucketed_table(flags, "load-flags", "learner") if store else flags
        people = learner.select(F.col("hashed_email").alias("learner"), "current_professional_status").join(flags, "learner").select(
            "learner", F.when(F.col("bare"), F.col("current_professional_status")).alias("snapshot_status"))
        past = history.learning_history(enrolments, as_of, by_learner=store)
        work = history.professional_history(jobs, as_of, flags.drop("bare"))
        # learners with and without entries are different ones: a union of their edges keeps the buckets, edges of their union would not
        states = edges.has_learning_state(past).unionByName(
            edges.has_learning_state(history.snapshot_rows(past, enrolments, current, snapshot)))
        statuses = edges.has_professional_status(work).unionByName(
            edges.has_professional_status(history.jobless_rows(work, jobs, people, as_of)))
    return Graph(
        learner=learner,
        country=entities.countries(raw, dim),
        city=entities.cities(raw, dim),
        skill=entities.skills(parse.learner_skills(parse.skill_cells(raw))),
        program=entities.programs(enrolments, provider),
        company=entities.companies(jobs),
        has_skill=parse.stored_skill_edges(raw) if store else edges.has_skill(parse.learner_skills(raw)),
        enrolled_in=edges.enrolled_in(enrolments, whole=store),
        works_for=edges.works_for(jobs, whole=store),
        has_learning_state=states,
        has_professional_status=statuses,
    )
