"""Current-state snapshots from flags and job counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortgraph.functions import cleaning as C


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def learning_state(graduate: Column, active: Column, dropped: Column) -> Column:
    """Graduate before Dropped Out before Active; no flag at all is Inactive."""
    return (
        F.when(_true(graduate), "Graduate")
        .when(_true(dropped), "Dropped Out")
        .when(_true(active), "Active")
        .otherwise("Inactive")
    )


def professional_status(
    current_jobs: Column, venture_placement: Column, is_venture: Column, is_wage: Column
) -> Column:
    """Job count decides; flags only without current jobs. The freelancer flag is not used."""
    jobs = F.coalesce(current_jobs, F.lit(0))
    return (
        F.when(jobs >= 2, "Multiple")
        .when((jobs == 1) & _true(venture_placement), "Entrepreneur")
        .when(jobs == 1, "Wage Employed")
        .when(_true(is_venture), "Entrepreneur")
        .when(_true(is_wage), "Wage Employed")
        .otherwise("Unemployed")
    )


def status_from_flags(
    is_venture: Column, is_wage: Column, is_freelancer: Column, venture_placement: Column | None = None
) -> Column:
    """Two or more flags are Multiple; then venture, wage, freelancer."""
    flags = [_true(c) for c in (is_venture, is_wage, is_freelancer)]
    n = flags[0].cast("int") + flags[1].cast("int") + flags[2].cast("int")
    venture = flags[0] if venture_placement is None else flags[0] | _true(venture_placement)
    return (
        F.when(n >= 2, "Multiple")
        .when(venture, "Entrepreneur")
        .when(flags[1], "Wage Employed")
        .when(flags[2], "Freelancer")
        .otherwise("Unemployed")
    )


def job_is_current(rule: str, end: Column, flag: Column, snapshot: str = C.SNAPSHOT_DATE, text: bool = True) -> Column:
    """The three definitions of a current job: ``flag``, ``date`` or ``open_end``.

    ``text`` tells entries as they arrive from typed ones. The unknown-date marker is a past
    end by the date rule only in text form; typed, it is NULL like an open end.
    """
    if rule == "flag":
        return F.coalesce(flag == "1" if text else flag, F.lit(False))
    if rule == "date":
        return C.is_current_by_date(end, snapshot) if text else F.coalesce(end >= F.lit(snapshot).cast("date"), F.lit(True))
    if rule == "open_end":
        return (C.parse_date(end) if text else end).isNull()
    raise ValueError(f"unknown rule: {rule}")


def current_jobs(jobs: DataFrame, snapshot: str = C.SNAPSHOT_DATE, rule: str = "date") -> DataFrame:
    """Current-job count per learner."""
    text = dict(jobs.dtypes)["end_date"] == "string"
    current = job_is_current(rule, F.col("end_date"), F.col("is_current"), snapshot, text)
    return jobs.groupBy("learner").agg(F.count_if(current).alias("current_jobs"))
