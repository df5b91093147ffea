"""Questions over state edges: (learner, state, valid_from, valid_to), unique on the first three.

The uniqueness bounds a learner's rows by states times calendar days, so ordering them per
learner is safe. Patterns of several states never build all pairs of a learner's rows: earliest-successor
pointers say which rows can start and go on, and a top ``k`` keeps k prefixes at each state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgraph.functions.rates import asc, desc, round_to, top_k
from cohortgraph.session import work_table

EPOCH = "1970-01-01"
#: Makes a learner's key of the number that stands for it in the edges; None: the edges hold the keys.
Name = Callable[[Column], Column] | None


def _key(name: Name) -> Column:
    return name(F.col("learner")) if name else F.col("learner")


def full_months(a: Column, b: Column) -> Column:
    """Completed calendar months from ``a`` to ``b``."""
    months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    return months - F.when(F.dayofmonth(b) < F.dayofmonth(a), 1).otherwise(0)


def _valid_on(day: Column) -> Column:
    return (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") >= day))


def state_as_of(edges: DataFrame, day: str) -> DataFrame:
    """Rows valid on a day."""
    return edges.filter(_valid_on(F.lit(day).cast("date")))


def states_on(edges: DataFrame, days: list[str]) -> DataFrame:
    """Rows valid on each of several days; the day list travels in the plan, nothing is joined."""
    wanted = F.array(*[F.lit(d).cast("date") for d in days])
    hits = F.filter(wanted, lambda d: (F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") >= d)))
    return edges.select("*", F.explode(hits).alias("as_of"))


def states_on_dates(edges: DataFrame, dates: DataFrame, day: str = "day", bin_days: int = 30) -> DataFrame:
    """Rows of the histories with the rows of ``dates`` they are valid on: a binned interval join.

    Time is cut into bins of ``bin_days`` days, those into years, and all of it into one bin for what
    never ends. A history row goes to the bins it covers at the coarsest level at which it spans few:
    short rows to days' bins, long ones to years, open or very long ones to the single bin. A date goes
    to one bin of each level. So a row is sent a bounded number of times however long it is, and both
    sides meet by an equality that AQE can split; the exact condition follows. Of rows without an end
    only the start decides. Columns of ``dates`` must not clash with those of ``edges``; null days and
    rows without a start match nothing.
    """
    levels = (bin_days, 12 * bin_days, 144 * bin_days)
    number = lambda c: F.datediff(c, F.lit(EPOCH).cast("date"))
    start, end = number(F.col("valid_from")), number(F.col("valid_to"))
    span = end - start
    level, bins = F.lit(len(levels)), F.array(F.lit(0).cast("long"))
    for i, width in reversed(list(enumerate(levels))):
        fits = F.coalesce((span >= 0) & (span < 12 * width), F.lit(False))
        level = F.when(fits, i).otherwise(level)
        bins = F.when(fits, F.sequence(F.floor(start / width), F.floor(F.greatest(end, start) / width))).otherwise(bins)
    usable = F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("valid_from")))
    rows = edges.filter(usable).select("*", level.alias("_level"), F.explode(bins).alias("_bin"))
    places = [F.struct(F.lit(i).alias("_level"), F.floor(number(F.col(day)) / width).alias("_bin")) for i, width in enumerate(levels)]
    places.append(F.struct(F.lit(len(levels)).alias("_level"), F.lit(0).cast("long").alias("_bin")))
    asked = dates.filter(F.col(day).isNotNull()).select("*", F.explode(F.array(*places)).alias("_p")).select(*dates.columns, "_p._level", "_p._bin")
    return rows.join(asked, ["_level", "_bin"]).filter(_valid_on(F.col(day))).drop("_level", "_bin")


def time_to_graduation(edges: DataFrame) -> DataFrame:
    """Days from Active to the Graduate state that starts on the Active end."""
    active = edges.filter((F.col("state") == "Active") & F.col("valid_to").isNotNull()).select(
        "learner", F.col("valid_from").alias("started"), F.col("valid_to").alias("day")
    )
    done = edges.filter(F.col("state") == "Graduate").select("learner", F.col("valid_from").alias("day"))
    days = active.join(done, ["learner", "day"]).select(F.datediff("day", "started").alias("days"))
    return days.agg(
        F.count("*").alias("n"), round_to(F.avg("days"), 2).alias("avg_days"),
        F.percentile("days", F.lit(0.5)).alias("median_days"),
    )


def adjacent_transitions(edges: DataFrame, state: str, name: Name = None) -> DataFrame:
    """Each state with the learner's next later one, in months: one row per state edge that has a successor."""
    w = Window.partitionBy("learner").orderBy("valid_from", state)
    df = edges.select(
        "learner", F.col(state).alias("from_state"), "valid_from",
        F.lead(state).over(w).alias("to_state"), F.lead("valid_from").over(w).alias("to_date"),
    ).filter(F.col("to_date") > F.col("valid_from"))
    return df.select(
        _key(name).alias("learner"), F.concat("from_state", F.lit(" → "), "to_state").alias("progression"),
        F.col("valid_from").alias("from_date"), "to_date", full_months(F.col("valid_from"), F.col("to_date")).alias("months"),
    )


def transition_counts(edges: DataFrame, state: str, values: tuple[str, ...]) -> DataFrame:
    """How many ordered pairs (earlier, strictly later) exist per pair of states.

    Later rows are counted by a running count per state, so no pair is built.
    """
    day = F.datediff("valid_from", F.lit(EPOCH).cast("date"))
    w = Window.partitionBy("learner").orderBy(F.col("day").desc()).rangeBetween(Window.unboundedPreceding, -1)
    df = edges.select("learner", F.col(state).alias("from_state"), day.alias("day"), F.col(state).alias("s"))
    df = df.withColumns({f"later_{i}": F.count_if(F.col("s") == v).over(w) for i, v in enumerate(values)})
    sums = df.groupBy("from_state").agg(*[F.sum(f"later_{i}").alias(f"later_{i}") for i in range(len(values))])
    pairs = F.array(*[F.struct(F.lit(v).alias("to_state"), F.col(f"later_{i}").alias("pairs")) for i, v in enumerate(values)])
    out = sums.select("from_state", F.explode(pairs).alias("p")).select("from_state", "p.to_state", "p.pairs")
    return out.filter(F.col("pairs") > 0).orderBy("from_state", "to_state")


def first_transitions(edges: DataFrame, state: str, limit: int = 10, name: Name = None) -> DataFrame:
    """The earliest ordered pairs of states over all learners (by first, then second start).

    Every row with a later row starts at least one pair, so the first ``limit`` such rows
    contain the answer; only their learners are joined back.
    """
    latest = F.max("valid_from").over(Window.partitionBy("learner"))
    rows = edges.select("learner", F.col(state).alias("s"), "valid_from", latest.alias("latest"))
    rows = rows.filter(F.col("latest") > F.col("valid_from")).withColumn("key", _key(name))
    heads = top_k(rows, asc("valid_from", "key", "s"), limit)
    heads = heads.select("learner", "key", F.col("s").alias("s1"), F.col("valid_from").alias("from_date"))
    tails = edges.select("learner", F.col(state).alias("s2"), F.col("valid_from").alias("to_date"))
    pairs = heads.join(tails, "learner").filter(F.col("to_date") > F.col("from_date"))
    out = pairs.select(
        F.col("key").alias("learner"), F.concat("s1", F.lit(" → "), "s2").alias("progression"), "from_date", "to_date",
        full_months(F.col("from_date"), F.col("to_date")).alias("months"),
    )
    return top_k(out, asc("from_date", "learner", "progression", "to_date"), limit)


def state_sequence(edges: DataFrame, state: str, sequence: list[str], limit: int | None = 20, name: Name = None) -> DataFrame:
    """Learners passing the states of ``sequence`` in order, strictly later each time: all combinations,
    or the exact first ``limit`` of them by months to the second state.
    """
    if limit is None:
        return _all_combinations(edges, state, sequence, name)
    return _first_combinations(edges, state, sequence, max(1, limit), name).limit(limit)


def earliest_completion(edges: DataFrame, state: str, sequence: list[str]) -> DataFrame:
    """For each row in the first state its earliest way through the states of ``sequence``."""
    names = [f"date_{i + 1}" for i in range(len(sequence))]
    rows = _with_pointers(edges, state, sequence).filter("ok_1")
    out = rows.select("learner", F.col("start").alias(names[0]), *[F.get("way", F.lit(i)).alias(n) for i, n in enumerate(names[1:])])
    return _with_months(out, names).orderBy(*_sequence_order(sequence))


def _with_pointers(edges: DataFrame, state: str, sequence: list[str]) -> DataFrame:
    """The rows in any state of ``sequence`` with what lies ahead of them.

    ``ok_i``: the row is in state i and the rest of the sequence can follow, strictly later each time.
    ``way``: of a row that can start, the dates of its earliest way through the other states, which takes
    the earliest possible row each time. All pointers come from one sort by learner and day.
    """
    n = len(sequence)
    df = edges.filter(F.col(state).isin(*sequence)).select(
        "learner", F.col(state).alias("state"), F.col("valid_from").alias("start"), F.datediff("valid_from", F.lit(EPOCH).cast("date")).alias("day"))
    later = Window.partitionBy("learner").orderBy(F.col("day").desc()).rangeBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"ok_{n}": F.col("state") == sequence[-1], f"way_{n}": F.array().cast("array<date>")})
    for i in range(n - 1, 0, -1):
        ahead = F.min(F.when(F.col(f"ok_{i + 1}"), F.struct("start", F.col(f"way_{i + 1}").alias("way")))).over(later)
        df = df.withColumn("ahead", ahead).withColumns({
            f"ok_{i}": (F.col("state") == sequence[i - 1]) & F.col("ahead").isNotNull(),
            f"way_{i}": F.concat(F.array("ahead.start"), F.col("ahead.way"))}).drop("ahead")
    return df.withColumn("way", F.col("way_1"))


def _first_combinations(edges: DataFrame, state: str, sequence: list[str], k: int, name: Name) -> DataFrame:
    """The first ``k`` combinations in their order, best prefixes first.

    Every row that can start has a best combination, its earliest way. A combination among the first k
    starts in one of the k rows with the best earliest ways, and each prefix of it is among the first k
    prefixes that can be completed. So k rows are kept at each step, and nothing grows with the number of
    states.
    """
    names = [f"date_{i + 1}" for i in range(len(sequence))]
    oks = [f"ok_{i + 1}" for i in range(len(sequence))]
    rows = _with_pointers(edges, state, sequence).select(F.col("learner").alias("of"), "start", "way", *oks).filter(" OR ".join(oks))
    rows = work_table(rows, "sequence-rows")  # read for the heads and once for each further state
    heads = rows.filter("ok_1").withColumn("learner", F.col("of")).select(
        "of", _key(name).alias("learner"), F.col("start").alias("date_1"), F.get("way", F.lit(0)).alias("date_2"))
    best = top_k(_with_months(heads, names[:2]), _sequence_order(sequence[:2]), k)
    best = work_table(best.select("of", "learner", "date_1"), "sequence-heads")  # k rows
    for i, date in enumerate(names[1:], start=2):
        ahead = rows.filter(f"ok_{i}").select("of", F.col("start").alias(date))
        best = best.join(ahead, "of").filter(F.col(date) > F.col(names[i - 2]))
        best = top_k(_with_months(best, names[:i]), _sequence_order(sequence[:i]), k)
    return best.drop("of").orderBy(*_sequence_order(sequence))


def _sequence_order(sequence: list[str]) -> list[Column]:
    return asc("months_1", "learner", *[f"date_{i + 1}" for i in range(len(sequence))])


def _with_months(df: DataFrame, names: list[str]) -> DataFrame:
    for i in range(len(names) - 1):
        df = df.withColumn(f"months_{i + 1}", full_months(F.col(names[i]), F.col(names[i + 1])))
    return df


def _all_combinations(edges: DataFrame, state: str, sequence: list[str], name: Name) -> DataFrame:
    """Every combination, one join per further state; the rows are the answer itself."""
    names = [f"date_{i + 1}" for i in range(len(sequence))]
    of = [edges.filter(F.col(state) == v).select("learner", F.col("valid_from").alias(n)) for v, n in zip(sequence, names, strict=True)]
    df = of[0]
    for i in range(1, len(names)):
        df = df.join(of[i], "learner").filter(F.col(names[i]) > F.col(names[i - 1]))
    return _with_months(df, names).withColumn("learner", _key(name)).orderBy(*_sequence_order(sequence))


def distribution_over_time(edges: DataFrame, state: str, as_of: str, months: int = 1) -> DataFrame:
    """Learner-states valid on each period start (every ``months`` months, aligned to the year).

    An edge adds one at its first covered period and takes it away after its last; running
    sums over the periods give the counts without spreading an edge over its periods.
    """
    def floor_to(c: Column) -> Column:
        return F.add_months(F.trunc(c, "year"), (F.floor((F.month(c) - 1) / months) * months).cast("int"))

    start, end = F.col("valid_from"), F.coalesce("valid_to", F.lit(as_of).cast("date"))
    first = F.when(floor_to(start) == start, start).otherwise(F.add_months(floor_to(start), months))
    last = floor_to(end)
    spans = edges.select(F.col(state).alias("state"), first.alias("first"), last.alias("last")).filter("first <= last")
    marks = F.array(
        F.struct(F.col("first").alias("period"), F.lit(1).alias("d")),
        F.struct(F.add_months("last", months).alias("period"), F.lit(-1).alias("d")),
    )
    deltas = spans.select("state", F.explode(marks).alias("m")).groupBy("state", F.col("m.period").alias("period")).agg(F.sum("m.d").alias("d"))
    bounds = deltas.groupBy("state").agg(F.min("period").alias("a"), F.max("period").alias("b"))
    calendar = bounds.select("state", F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {months} MONTH"))).alias("period"))
    w = Window.partitionBy("state").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    out = calendar.join(deltas, ["state", "period"], "left").withColumn("n", F.sum(F.coalesce("d", F.lit(0))).over(w))
    return out.filter(F.col("n") > 0).select("state", "period", "n").orderBy("period", "state")


def progression_paths(edges: DataFrame, state: str, limit: int = 20) -> DataFrame:
    """Most frequent adjacent progressions with their average months."""
    out = adjacent_transitions(edges, state).groupBy("progression").agg(
        F.count("*").alias("n"), round_to(F.avg("months"), 2).alias("avg_months")
    )
    return top_k(out, desc("n") + asc("progression"), limit)
