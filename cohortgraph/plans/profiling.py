"""Profiling studies over the flat table and its parsed entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.functions import cleaning as C
from cohortgraph.functions.jsoncols import parse_json_array
from cohortgraph.functions.rates import asc, desc, pct, round_to, share_of_total, top_k

FLAG_OF_STATUS = {"is_graduate_learner": "graduated", "is_active_learner": "enrolled", "is_a_dropped_out": "dropped out"}


def _n() -> Column:
    return F.count(F.lit(1))


def _one(c: str) -> Column:
    return C.is_set(F.col(c))


def _long(df: DataFrame, key: str, items: dict[str, dict[str, Column]]) -> DataFrame:
    """One-row aggregates to one row per item."""
    structs = [
        F.struct(F.lit(name).alias(key), *[c.alias(k) for k, c in cols.items()]) for name, cols in items.items()
    ]
    return df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _with_status(raw: DataFrame) -> DataFrame:
    """Flat rows with the status of their first enrolment entry."""
    fields = ("enrollment_status",)
    first = F.slice(parse_json_array(F.col("learning_details"), S.entry_array(fields)), 1, 1)
    return raw.select("*", F.explode_outer(first).alias("le")).withColumn("status", F.col("le.enrollment_status"))


def p01_flag_check(raw: DataFrame) -> DataFrame:
    """Flags of every flat row against the statuses of its own entries, with match rate."""
    statuses = F.transform(parse_json_array(F.col("learning_details"), S.entry_array(("enrollment_status",))), lambda e: F.lower(e["enrollment_status"]))
    df = raw.select(*FLAG_OF_STATUS, statuses.alias("statuses"))
    same = {f: F.count_if(_one(f) == F.coalesce(F.array_contains("statuses", v), F.lit(False))).alias(f) for f, v in FLAG_OF_STATUS.items()}
    out = df.agg(_n().alias("total"), *same.values())
    return _long(out, "flag", {
        f: {"matches": F.col(f), "total": F.col("total"), "match_rate": pct(F.col(f), F.col("total"), 4)} for f in FLAG_OF_STATUS
    })


def p02_field_completeness(entries: DataFrame, fields: tuple[str, ...] = S.LEARNING_FIELDS) -> DataFrame:
    """Valid, missing and sentinel share per entry field: one aggregate over all fields, then long form."""
    def missing(c: Column) -> Column:
        return c.isNull() | F.lower(c).isin(*S.NULL_TOKENS)

    def sentinel(c: Column) -> Column:
        return c.isin("1970-01-01", *S.MISSING_NUMBERS)

    aggs = [_n().alias("total")]
    for f in fields:
        aggs += [F.count_if(missing(F.col(f))).alias(f"m_{f}"), F.count_if(sentinel(F.col(f))).alias(f"s_{f}")]
    out = entries.agg(*aggs)
    total = F.col("total")
    return _long(out, "field", {
        f: {
            "valid_pct": pct(total - F.col(f"m_{f}") - F.col(f"s_{f}"), total),
            "missing_pct": pct(F.col(f"m_{f}"), total), "sentinel_pct": pct(F.col(f"s_{f}"), total),
        } for f in fields
    })


def p03_status_values(entries: DataFrame) -> DataFrame:
    out = share_of_total(entries.select(F.col("enrollment_status").alias("status")), ["status"])
    return out.orderBy(*desc("n"), *asc("status"))


def p04_crosstab(raw: DataFrame) -> DataFrame:
    """Status by flag values."""
    aggs = []
    for f in FLAG_OF_STATUS:
        aggs += [F.count_if(_one(f)).alias(f"{f}_1"), F.count_if(~_one(f)).alias(f"{f}_0")]
    return _with_status(raw).groupBy(F.lower("status").alias("status")).agg(*aggs).orderBy("status")


def p05_exclusive(raw: DataFrame) -> DataFrame:
    g, a, d = (_one(f) for f in FLAG_OF_STATUS)
    combos = {
        "graduate_and_active": g & a, "graduate_and_dropped": g & d, "active_and_dropped": a & d,
        "all_three": g & a & d, "none": ~g & ~a & ~d,
    }
    out = raw.agg(*[F.count_if(c).alias(k) for k, c in combos.items()])
    return _long(out, "combination", {k: {"n": F.col(k)} for k in combos})


def p06_value_share(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Values of a column by count and share. The whole is a scalar subquery over the groups."""
    grouped = df.groupBy(F.col(column).alias("value")).agg(_n().alias("n"))
    whole = grouped.agg(F.sum("n")).scalar()
    return top_k(grouped.withColumn("share_pct", pct(F.col("n"), whole)), desc("n") + asc("value"), limit)


def p07_temporal_issues(typed: DataFrame) -> DataFrame:
    """Five date anomalies of typed enrolments."""
    start, end, grad = F.col("start_date"), F.col("end_date"), F.col("graduation_date")
    done = F.lower("enrollment_status") == "graduated"
    issues = {
        "end_before_start": end < start, "graduation_before_start": grad < start, "graduation_after_end": grad > end,
        "graduated_without_date": done & grad.isNull(), "date_without_graduation": ~done & grad.isNotNull(),
    }
    out = typed.agg(*[F.count_if(c).alias(k) for k, c in issues.items()])
    return _long(out, "issue", {k: {"n": F.col(k)} for k in issues})


def p08_completion_by_status(typed: DataFrame) -> DataFrame:
    rate = F.col("completion_rate")
    return typed.groupBy(F.initcap(F.lower("enrollment_status")).alias("status")).agg(
        F.count_if(rate == 1).alias("complete"), F.count_if(rate == 0).alias("incomplete"), F.count_if(rate.isNull()).alias("missing")
    ).orderBy("status")


def p09_identity(raw: DataFrame) -> DataFrame:
    sand, name = C.norm_str(F.col("sand_id")), C.norm_str(F.col("full_name"))
    out = raw.agg(
        _n().alias("total_rows"), F.countDistinct("hashed_email").alias("unique_hashed_email"), F.countDistinct(name).alias("unique_full_name"),
        F.countDistinct(sand).alias("unique_sand_id"), F.count_if(sand.isNull()).alias("missing_sand_id"),
    )
    return out.withColumn("missing_sand_id_pct", pct(F.col("missing_sand_id"), F.col("total_rows")))


def _people(raw: DataFrame, *cols: str) -> DataFrame:
    return raw.select(C.norm_str(F.col("full_name")).alias("person"), "hashed_email", "row_ord", *cols).filter(F.col("person").isNotNull())


def p10_multi_program(raw: DataFrame) -> DataFrame:
    """People by name with one or several enrolments, and whether their keys differ."""
    per = _people(raw).groupBy("person").agg(_n().alias("rows"), F.countDistinct("hashed_email").alias("keys"))
    kind = F.when(F.col("rows") == 1, "single").when(F.col("keys") == 1, "multi_same_key").otherwise("multi_different_keys")
    return share_of_total(per.select(kind.alias("category")), ["category"]).orderBy("category")


def p11_status_combos(raw: DataFrame) -> DataFrame:
    """Sets of statuses of people with several enrolments; the set is bounded by the statuses."""
    df = _people(_with_status(raw), "status")
    per = df.groupBy("person").agg(_n().alias("rows"), F.array_sort(F.collect_set(F.initcap(F.lower("status")))).alias("set"))
    combos = per.filter(F.col("rows") > 1).groupBy(F.array_join("set", " + ").alias("combination")).agg(_n().alias("n"))
    return combos.orderBy(*desc("n"), *asc("combination"))


def p12_concurrent(people: DataFrame) -> DataFrame:
    """People with enrolments that overlap in time.

    ``people`` has person, start_date, end_date. Enrolments are merged per person and start
    day first, so the running maximum sees at most one row per person and calendar day.
    """
    days = people.filter(F.col("start_date").isNotNull() & F.col("end_date").isNotNull()).groupBy("person", "start_date").agg(
        _n().alias("n"), F.max("end_date").alias("last_end")
    )
    before = Window.partitionBy("person").orderBy("start_date").rowsBetween(Window.unboundedPreceding, -1)
    df = days.withColumn("open_until", F.max("last_end").over(before))
    hit = (F.col("open_until") > F.col("start_date")) | ((F.col("n") > 1) & (F.col("last_end") > F.col("start_date")))
    per = df.groupBy("person").agg(F.bool_or(F.coalesce(hit, F.lit(False))).alias("overlaps"))
    out = per.agg(_n().alias("people"), F.count_if("overlaps").alias("concurrent"))
    return out.withColumn("concurrent_pct", pct(F.col("concurrent"), F.col("people")))


def p13_same_person(raw: DataFrame) -> DataFrame:
    """Link every learner key to the first key with the same name: one row per key, no pairs.

    Only names with several rows are linked; ``has_other_enrollments`` holds for all of them.
    """
    keys = _people(raw).groupBy("person", "hashed_email").agg(_n().alias("rows"))
    per = keys.groupBy("person").agg(F.min("hashed_email").alias("same_as"), F.count(F.lit(1)).alias("keys"), F.sum("rows").alias("enrollments"))
    out = keys.join(per.filter(F.col("enrollments") > 1), "person")
    return out.select("hashed_email", "person", "same_as", "keys", "enrollments", F.lit(True).alias("has_other_enrollments"))


#: Flag and the column whose content it claims.
HAS_FLAGS = {
    "has_employment_details": "employment_details", "has_education_details": "education_details",
    "has_placement_details": "placement_details", "has_profile_profile_photo": "profile_photo_url",
    "has_data": "demographic_details", "has_social_economic_data": "demographic_details",
    "has_legacy_points_transactions": "legacy_points_transaction_history", "has_disability": "type_of_disability",
}


def p14_has_flags(raw: DataFrame, flags: dict[str, str] = HAS_FLAGS) -> DataFrame:
    """Flags against real content; ``[]`` and ``"[]"`` are empty. ``1``, ``yes`` and ``true`` set a flag.

    Flags that the table does not have are left out; a flag whose column it does not have gets no accuracy.
    """
    flags = {f: c for f, c in flags.items() if f in raw.columns}
    aggs = [_n().alias("total")]
    for flag, column in flags.items():
        is_one = F.coalesce(F.lower(F.trim(flag)).isin("1", "yes", "true"), F.lit(False))
        match = F.lit(None).cast("long")
        if column in raw.columns:
            content = C.norm_str(F.col(column)).isNotNull() & ~F.regexp_replace(column, r'["\s]', "").isin("[]", "")
            match = F.count_if(is_one == F.coalesce(content, F.lit(False)))
        aggs += [F.count_if(is_one).alias(f"o_{flag}"), match.alias(f"m_{flag}")]
    out = raw.agg(*aggs)
    total = F.col("total")
    return _long(out, "flag", {
        f: {"flag_0": total - F.col(f"o_{f}"), "flag_1": F.col(f"o_{f}"), "accuracy_pct": pct(F.col(f"m_{f}"), total)} for f in flags
    })


def p15_edu_entries(raw: DataFrame) -> DataFrame:
    """Histogram of education entries per row, with the average and maximum beside it."""
    sizes = raw.select(F.size(parse_json_array(F.col("education_details"), S.EDUCATION_ARRAY)).alias("entries")).filter(F.col("entries") > 0)
    out = share_of_total(sizes, ["entries"])
    average = out.agg(round_to(F.sum(F.col("entries") * F.col("n")) / F.sum("n").cast("double"), 2)).scalar()
    return out.withColumns({"average": average, "maximum": out.agg(F.max("entries")).scalar()}).orderBy("entries")


def p16_edu_top(education: DataFrame, column: str, limit: int = 20) -> DataFrame:
    """Institutions, levels or fields by entries, with their graduation rate."""
    grouped = education.groupBy(F.col(column).alias("value")).agg(_n().alias("n"), F.count_if(F.col("graduated") == "1").alias("graduated"))
    whole = grouped.agg(F.sum("n")).scalar()
    out = grouped.withColumns(
        {"share_pct": pct(F.col("n"), whole), "graduation_rate": pct(F.col("graduated"), F.col("n"))}
    )
    return top_k(out, desc("n") + asc("value"), limit)


# own keyword rules: the studies publish the classes, not how they were found
INSTITUTION_TYPES = {
    "Polytechnic": "polytechnic", "Secondary/High School": "high school|secondary|college prep",
    "Online/Distance": "online|distance|open university", "University": "university",
}


def p17_inst_class(education: DataFrame, countries: list[str], types: dict[str, str] = INSTITUTION_TYPES) -> DataFrame:
    """Institution type and country named in the institution, by first matching keyword."""
    name = F.lower("institution_name")
    kind, place = None, None
    for label, pattern in types.items():
        kind = (F if kind is None else kind).when(name.rlike(pattern), F.lit(label))
    for c in countries:
        place = (F if place is None else place).when(name.rlike(rf"\b{c.lower()}\b"), F.lit(c))
    df = education.select(kind.otherwise("Other").alias("type"), place.otherwise("Other/Unknown").alias("country"))
    return share_of_total(df, ["type", "country"]).orderBy(*desc("n"), *asc("type", "country"))


def p18_edu_years(education: DataFrame) -> DataFrame:
    """Start and end years by count; year NULL counts unusable dates."""
    sides = F.array(*[
        F.struct(F.lit(k).alias("side"), F.year(C.parse_date(F.col(c))).alias("year"))
        for k, c in (("start", "start_date"), ("end", "end_date"))
    ])
    df = education.select(F.explode(sides).alias("r")).select("r.*")
    return share_of_total(df, ["side", "year"], by=["side"]).orderBy(*asc("side", "year"))


def _edu_days(education: DataFrame) -> DataFrame:
    days = F.datediff(C.parse_date(F.col("end_date")), C.parse_date(F.col("start_date")))
    return education.select(days.alias("days")).filter(F.col("days").isNotNull())


def p19_edu_duration(education: DataFrame) -> DataFrame:
    """Duration buckets in years of 365.25 days with share; statistics of the whole beside them."""
    years = F.col("days") / F.lit(365.25)
    bucket = F.when(years < 0, "< 0 (invalid)").when(years < 1, "< 1 year")
    for n in range(1, 6):
        bucket = bucket.when(years < n + 1, f"{n}-{n + 1} years")
    df = _edu_days(education).withColumn("bucket", bucket.otherwise("6+ years"))
    out = df.groupBy("bucket").agg(_n().alias("n"), F.sum("days").alias("sum_days"), F.min("days").alias("lo"), F.max("days").alias("hi"))
    whole = out.agg(F.struct(
        F.sum("n").alias("n"),
        round_to(F.sum("sum_days") / F.sum("n").cast("double") / F.lit(365.25), 2).alias("average_years"),
        round_to(F.min("lo") / F.lit(365.25), 2).alias("min_years"),
        round_to(F.max("hi") / F.lit(365.25), 2).alias("max_years"),
    )).scalar()
    return out.select(
        "bucket", "n", pct(F.col("n"), whole["n"]).alias("percentage"),
        *[whole[c].alias(c) for c in ("average_years", "min_years", "max_years")],
    ).orderBy("bucket")


def p20_edu_progression(raw: DataFrame, limit: int = 20) -> DataFrame:
    """Consecutive level pairs inside each row's education array; no shuffle before the count."""
    levels = F.transform(parse_json_array(F.col("education_details"), S.EDUCATION_ARRAY), lambda e: e["level_of_study"])
    pairs = F.zip_with(
        F.slice(levels, 1, F.greatest(F.size(levels) - 1, F.lit(0))), F.slice(levels, 2, F.greatest(F.size(levels), F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" → "), b),
    )
    df = raw.select(F.explode(pairs).alias("progression")).groupBy("progression").agg(_n().alias("n"))
    return top_k(df, desc("n") + asc("progression"), limit)


def p21_edu_issues(education: DataFrame, as_of: str) -> DataFrame:
    start, end = C.parse_date(F.col("start_date")), C.parse_date(F.col("end_date"))
    today, days = F.lit(as_of).cast("date"), F.datediff(end, start)
    issues = {
        "not_graduated_with_past_end": (F.col("graduated") == "0") & (end < today),
        "invalid_end_date": F.col("end_date") == "1970-01-01", "level_missing": F.col("level_of_study") == "n/a",
        "under_six_months": days.between(0, 182), "over_eight_years": days > 2922, "future_end_date": end > today,
        "invalid_start_date": F.col("start_date") == "1970-01-01", "end_before_start": end < start,
        "field_missing": F.col("field_of_study") == "n/a",
    }
    out = education.agg(_n().alias("total"), *[F.count_if(c).alias(k) for k, c in issues.items()])
    return _long(out, "issue", {k: {"n": F.col(k), "share_pct": pct(F.col(k), F.col("total"))} for k in issues})


def p22_emp_crosstab(raw: DataFrame) -> DataFrame:
    """Details flag by wage flag by content, with share of all and share inside each flag value."""
    empty = F.regexp_replace("employment_details", r'["\s]', "").isin("[]", "")
    df = raw.select(
        _one("has_employment_details").cast("int").alias("has_details"), _one("is_wage_employed").cast("int").alias("wage_employed"),
        empty.alias("empty_details"),
    )
    out = share_of_total(df, ["has_details", "wage_employed", "empty_details"])
    for key in ("has_details", "wage_employed"):
        out = out.withColumn(f"pct_of_{key}", pct(F.col("n"), F.sum("n").over(Window.partitionBy(key))))
    return out.orderBy("has_details", "wage_employed", "empty_details")


def p23_stale_jobs(jobs: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Jobs flagged current: open by sentinel, really ended long ago, other."""
    cur = jobs.filter(F.col("is_current") == "1")
    ended = C.parse_date(F.col("end_date"), None)
    kind = (
        F.when(F.col("end_date") == "9999-12-31", "sentinel")
        .when(ended < F.date_sub(F.lit(as_of).cast("date"), days), "stale").otherwise("other")
    )
    return share_of_total(cur.select(kind.alias("kind")), ["kind"]).orderBy("kind")


def p24_jobs_per_person(jobs: DataFrame) -> DataFrame:
    out = jobs.filter(F.col("is_current") == "1").agg(_n().alias("current_jobs"), F.countDistinct("learner").alias("people"))
    ratio = F.col("current_jobs") / F.when(F.col("people") > 0, F.col("people").cast("double"))
    return out.withColumn("jobs_per_person", round_to(ratio, 2))


def p25_source_discrepancy(left: DataFrame, right: DataFrame, key: str = "key", count: str = "n") -> DataFrame:
    """Two count tables side by side with their difference; keys of either side are kept."""
    a = left.select(F.col(key), F.col(count).alias("left_n"))
    b = right.select(F.col(key), F.col(count).alias("right_n"))
    out = a.join(b, key, "full").fillna(0, ["left_n", "right_n"])
    return out.withColumn("difference", F.col("left_n") - F.col("right_n")).orderBy(*desc("difference"), *asc(key))


def name_and_code_counts(raw: DataFrame, learners: DataFrame, countries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Learners per country by the flat table's names and by the loaded codes."""
    by_name = raw.groupBy(C.norm_str(F.col("country_of_residence")).alias("key")).agg(F.countDistinct("hashed_email").alias("n"))
    coded = learners.groupBy(F.col("country_of_residence_code").alias("code")).agg(_n().alias("n"))
    names = countries.select("code", F.col("name").alias("key"))
    by_code = coded.join(names, "code").select("key", "n")
    return by_name.filter(F.col("key").isNotNull()), by_code
