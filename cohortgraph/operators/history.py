"""Slowly changing state histories built from enrolment and job entries.

Enrolments are keyed by (learner, day) first, so that a learner with a large part of the table is
spread over as many groups as it has start days. Only the day summary, at most one row per
learner and calendar day of the accepted years, is ordered per learner.

The whole load has the entries in buckets of learners anyway and orders them there (``by_learner``); there all
entries of a learner are one task's work.

Jobs, the largest table, are shuffled a single time, by learner, and ordered there; what is grouped by
learner afterwards needs no shuffle any more. The order and its window spill, so memory is bounded for
any learner, but all jobs of one learner are one task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgraph.functions import cleaning as C
from cohortgraph.operators import states

NO_DAY = "0001-01-01"  # stands for an unknown start, before every real day


def _date(value: str | Column) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def _row(value: Column, start: Column, end: Column, current: Column, note: Column, unknown: bool, step: Column | int) -> Column:
    return F.struct(
        value.alias("value"), start.cast("date").alias("start_date"), end.cast("date").alias("end_date"),
        current.alias("is_current"), note.alias("note"), F.lit(unknown).alias("date_unknown"),
        (F.lit(step) if isinstance(step, int) else step).alias("step"),
    )


def _emit(df: DataFrame, rows: list[Column], value: str, note: str) -> DataFrame:
    """One output row per non-null item of ``rows``."""
    out = df.select("learner", "entry_ord", F.explode(F.array(*rows)).alias("r")).filter(F.col("r").isNotNull())
    return out.select(
        "learner", "entry_ord", "r.step", F.col("r.value").alias(value), "r.start_date", "r.end_date", "r.is_current",
        F.col("r.note").alias(note), "r.date_unknown",
    )


def end_state(status: Column) -> Column:
    s = F.lower(status)
    return (
        F.when(s.contains("graduate") | s.contains("completed"), "Graduate")
        .when(s.contains("drop") | s.contains("withdraw"), "Dropped Out")
        .otherwise("Active")
    )


def _next_start_by_day(e: DataFrame) -> DataFrame:
    """Add ``next_start`` of the learner's next entry; only summaries of days meet at a learner."""
    by_day = e.groupBy("learner", "day").agg(F.max("entry_ord").alias("last_ord"))
    by_day = by_day.withColumn("next_day", F.lead("day").over(Window.partitionBy("learner").orderBy("day")))
    last_of_day = F.col("entry_ord") == F.col("last_ord")
    return e.join(by_day, ["learner", "day"]).withColumn("next_start", F.when(last_of_day, F.col("next_day")).otherwise(F.col("day")))


def learning_history(enrollments: DataFrame, as_of: str, gap_months: int = 6, by_learner: bool = False) -> DataFrame:
    """Learning-state rows of every learner with enrolment entries.

    ``enrollments`` are typed entries (``edges.typed_enrollments``). The output order of a
    learner is (date_unknown first, start_date of the entry, entry_ord, step). ``by_learner``: the entries
    are stored in buckets of learners, so they are ordered there as they are, without a shuffle.
    """
    gap_days = gap_months * 30
    e = enrollments.select(
        "learner", F.struct("row_ord", "pos").alias("entry_ord"), F.col("start_date").alias("start"),
        F.col("end_date").alias("end"), F.col("graduation_date").alias("grad"),
        end_state(F.col("enrollment_status")).alias("fin"),
        F.concat("program_name", F.lit(" ("), "program_id", F.lit(")")).alias("what"),
    )
    closed = (
        F.when((F.col("fin") == "Graduate") & F.col("grad").isNotNull(), F.col("grad"))
        .when((F.col("fin") == "Dropped Out") & F.col("end").isNotNull(), F.col("end"))
        .when(F.col("end") < _date(as_of), F.col("end"))
    )
    e = e.withColumns({"day": F.coalesce("start", _date(NO_DAY)), "closed": closed})
    if by_learner:
        df = e.withColumn("next_start", F.lead("day").over(Window.partitionBy("learner").orderBy("day", "entry_ord")))
    else:
        df = _next_start_by_day(e)
    gap = F.datediff("next_start", "closed")
    df = df.withColumns(
        {
            "last_entry": F.col("next_start").isNull(),
            "gap": F.when(F.col("start").isNotNull() & (gap > gap_days), gap),
        }
    )
    no, last = F.lit(False), F.col("last_entry")
    known, fin, closed, gap = F.col("start").isNotNull(), F.col("fin"), F.col("closed"), F.col("gap")
    ended = F.col("ended")
    df = df.withColumn("ended", known & closed.isNotNull() & (fin != "Active"))
    null_date = F.lit(None).cast("date")
    rows = [
        F.when(~known, _row(
            fin, null_date, F.coalesce("end", "grad"), last,
            F.concat(F.lit("Enrolled in "), "what", F.lit(" (date unknown)")), True, 0)),
        F.when(known, _row(
            F.lit("Active"), F.col("start"), closed, last & ~ended, F.concat(F.lit("Enrolled in "), "what"), False, 0)),
        F.when(ended, _row(
            fin, closed, F.when(gap.isNotNull(), closed), last,
            F.concat(F.when(fin == "Graduate", "Graduated from ").otherwise("Dropped out of "), F.col("what")), False, 1)),
        F.when(gap.isNotNull(), _row(
            F.lit("Inactive"), closed, F.col("next_start"), no,
            F.concat(F.lit("Gap of "), gap, F.lit(" days between programs")), False, F.when(ended, 2).otherwise(1))),
    ]
    return _emit(df, rows, "state", "reason")


def with_snapshot(history: DataFrame, current: DataFrame, snapshot: str) -> DataFrame:
    """Add one open row at the snapshot date for learners without entries (learner, state)."""
    return history.unionByName(snapshot_rows(history, history, current, snapshot))


def snapshot_rows(history: DataFrame, entries: DataFrame, current: DataFrame, snapshot: str) -> DataFrame:
    """The rows that ``with_snapshot`` adds. Each entry has a row in the history, so ``entries`` may be
    either; of the history itself only the columns are taken."""
    missing = current.join(entries.select("learner").distinct(), "learner", "left_anti")
    order_type = history.schema["entry_ord"].dataType
    return missing.select(
        "learner", F.lit(None).cast(order_type).alias("entry_ord"), F.lit(0).alias("step"), "state",
        _date(snapshot).alias("start_date"), F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"),
        F.lit("Current state").alias("reason"), F.lit(False).alias("date_unknown"),
    )


def professional_history(
    jobs: DataFrame,
    as_of: str,
    flags: DataFrame | None = None,
    gap_months: int = 1,
    infer_initial: bool = True,
    learners: DataFrame | None = None,
    texts: dict[str, Column] | None = None,
) -> DataFrame:
    """Professional-status rows from typed job entries (``edges.typed_jobs``).

    ``flags`` (learner, is_venture, is_wage, is_freelancer, optional placement_is_venture)
    decides the status after an ended last job; without it the learner is unemployed then.
    ``learners`` adds an open Unemployed row for keys without any job. Where it has a non-null
    ``snapshot_status`` (no employment text at all), the row takes this status instead.
    Learners may be numbers. ``texts`` makes position and organization_name behind the shuffle, of
    the entries' ``pos`` and ``title``, where the entries hold numbers instead of texts.
    """
    gap_days = gap_months * 30
    today = _date(as_of)
    venture = F.col("placement_is_venture") if "placement_is_venture" in jobs.columns else None
    e = jobs.filter(F.col("learner").isNotNull()).select(
        "learner", "row_ord", "pos", F.col("start_date").alias("start"), F.col("end_date").alias("end"),
        (F.col("flagged") & F.col("end_date").isNull()).alias("current"),
        *(["position", "organization_name"] if texts is None else ["title"]), *([] if venture is None else ["placement_is_venture"]),
    )

    # the entries are computed and shuffled once; days and texts are made behind the shuffle. The number of partitions is the
    # session's: AQE would fill tasks up by compressed size, so that the sorts behind spill
    e = e.repartition(int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "learner")
    e = e.withColumn("day", F.coalesce("start", _date(NO_DAY)))
    in_order = Window.partitionBy("learner").orderBy("day", "row_ord", "pos")
    all_days = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = e.withColumns(
        {
            "prev_day": F.lag("day").over(in_order),
            "last_end": F.lag("end").over(in_order),
            "next_start": F.lead("day").over(in_order),
            "first_day": F.first("day").over(all_days),
            "last_day": F.last("day").over(all_days),
        }
    )
    if texts is not None:
        df = df.withColumns(texts).drop("title")
    df = df.withColumns(
        {
            "entry_ord": F.struct("row_ord", "pos"),
            "cls": C.employment_class(F.col("position"), F.col("organization_name"), venture),
            "what": F.concat("position", F.lit(" at "), "organization_name"),
            "has_prev": F.coalesce(F.col("prev_day") != _date(NO_DAY), F.lit(False)),
            "prev_end": F.coalesce("last_end", today),
            "last_entry": F.col("next_start").isNull(),
            "closes": F.col("end").isNull() & (F.datediff("next_start", today) > gap_days),
            "only_unknown": F.col("last_day") == _date(NO_DAY),
            "has_unknown": F.col("first_day") == _date(NO_DAY),
        }
    ).drop("placement_is_venture")
    final, note = F.lit("Unemployed"), F.lit("After last employment ended")
    if flags is not None:
        df = df.join(flags, "learner", "left")
        placed = F.col("placement_is_venture") if "placement_is_venture" in flags.columns else None
        final = states.status_from_flags(F.col("is_venture"), F.col("is_wage"), F.col("is_freelancer"), placed)
        note = F.when(final == "Unemployed", note).otherwise("Current status from placement/flags")

    no, yes = F.lit(False), F.lit(True)
    null_date = F.lit(None).cast("date")
    start, end = F.col("start"), F.col("end")
    known = F.col("start").isNotNull()
    df = df.withColumns(
        {
            "before": known & ~F.col("has_prev") & ~F.col("has_unknown") & F.lit(infer_initial),
            "gap": F.when(known & F.col("has_prev"), F.datediff("start", "prev_end")),
            "after": known & F.col("last_entry") & end.isNotNull(),
        }
    )
    gap, gapped = F.col("gap"), F.coalesce(F.col("gap") > gap_days, no)
    earlier = F.col("before").cast("int") + gapped.cast("int")
    rows = [
        F.when(~known, _row(
            F.col("cls"), null_date, end, (F.col("current") & F.col("only_unknown")) | F.col("last_entry"),
            F.concat("what", F.lit(" (date unknown)")), True, 0)),
        F.when(F.col("before"), _row(
            F.lit("Unemployed"), F.date_sub(start, 365), start, no, F.lit("Before first employment"), False, 0)),
        F.when(gapped, _row(
            F.lit("Unemployed"), F.col("prev_end"), start, no,
            F.concat(F.lit("Gap of "), gap, F.lit(" days between jobs")), False, 0)),
        F.when(known, _row(
            F.col("cls"), start, F.when(F.col("closes"), today).otherwise(end),
            F.col("current") | (F.col("last_entry") & ~F.col("after")), F.col("what"), False, earlier)),
        F.when(F.col("after"), _row(final, end, null_date, yes, note, False, earlier + 1)),
    ]
    out = _emit(df, rows, "status", "details")
    if learners is None or not infer_initial:
        return out
    return out.unionByName(jobless_rows(out, jobs, learners, as_of))


def jobless_rows(history: DataFrame, jobs: DataFrame, learners: DataFrame, as_of: str) -> DataFrame:
    """The rows that ``professional_history`` adds for ``learners`` without any job, with the columns of ``history``."""
    known_status = F.col("snapshot_status") if "snapshot_status" in learners.columns else F.lit(None).cast("string")
    missing = learners.select("learner", known_status.alias("snapshot_status")).join(jobs.select("learner").distinct(), "learner", "left_anti")
    return missing.select(
        "learner", F.lit(None).cast(history.schema["entry_ord"].dataType).alias("entry_ord"), F.lit(0).alias("step"),
        F.coalesce("snapshot_status", F.lit("Unemployed")).alias("status"), _date(as_of).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"),
        F.when(F.col("snapshot_status").isNull(), "No employment history").alias("details"), F.lit(False).alias("date_unknown"),
    )
