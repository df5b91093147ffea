"""JSON and delimited columns of the flat table as typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph import schemas as S
from cohortgraph.functions import cleaning as C
from cohortgraph.functions.jsoncols import has_fields, parse_json_array
from cohortgraph.session import work_table


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that are computed a single time per row.

    The one-item explode is a boundary: filters and projections above it refer to the finished
    values, and are not rewritten into copies of the expressions.
    """
    kept = [c for c in df.columns if c not in cols]
    item = F.struct(*[c.alias(name) for name, c in cols.items()])
    out = df.select("*", F.explode(F.array(item)).alias("_once"))
    return out.select(*kept, *[F.col(f"_once.{name}").alias(name) for name in cols])


def in_steps(df: DataFrame, columns: dict[str, Column], size: int = 6) -> DataFrame:
    """The columns, a few at a time: all at once can be a method too long for the JVM to compile. Also what nobody takes is made."""
    names = list(columns)
    for i in range(0, len(names), size):
        df = once(df, **{f"_made_{n}": columns[n] for n in names[i : i + size]})
    return df.select(*[F.col(f"_made_{n}").alias(n) for n in names])


def entries(raw: DataFrame, column: str, schema: T.ArrayType, required: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per array entry that has every required key: learner, row_ord, pos, fields; and the row's ``keep`` columns."""
    rows = once(raw.select(F.col("hashed_email").alias("learner"), "row_ord", F.col(column), *keep), text=F.col(column))
    exploded = rows.select("learner", "row_ord", *keep, F.posexplode(parse_json_array(F.col("text"), schema)).alias("pos", "entry"))
    kept = exploded.filter(has_fields(F.col("entry"), required))
    return kept.select("learner", "row_ord", *keep, "pos", "entry.*")


def enrollments_raw(raw: DataFrame) -> DataFrame:
    return entries(raw, "learning_details", S.LEARNING_ARRAY, S.LEARNING_FIELDS)


def jobs_raw(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Jobs, with the row's ``keep`` columns; both spellings of the organization key are accepted."""
    other = tuple(f for f in S.EMPLOYMENT_FIELDS if f != "organization_name")
    df = entries(raw, "employment_details", S.EMPLOYMENT_ARRAY, other, keep)
    df = df.withColumn("organization_name", F.coalesce("organization_name", "organisation_name"))
    return df.filter(F.col("organization_name").isNotNull()).drop("organisation_name")


def education_raw(raw: DataFrame) -> DataFrame:
    return entries(raw, "education_details", S.EDUCATION_ARRAY, S.EDUCATION_FIELDS)


def placement_kind(entry: Column) -> Column:
    """venture when business name or venture metrics are present, else wage."""
    venture = (
        entry["business_name"].isNotNull()
        | entry["jobs_created_to_date"].isNotNull()
        | entry["capital_secured_todate"].isNotNull()
        | entry["female_opp_todate"].isNotNull()
    )
    return F.when(venture, "venture").otherwise("wage")


def first_placement(c: Column) -> Column:
    """First placement entry; NULL unless it has a start date."""
    entry = F.get(parse_json_array(c, S.PLACEMENT_ARRAY), F.lit(0))
    return F.when(entry["job_start_date"].isNotNull(), entry)


def with_placement(raw: DataFrame) -> DataFrame:
    """Add the first placement as the struct ``entry``."""
    rows = once(raw, text=F.col("placement_details"))
    return once(rows, entry=first_placement(F.col("text"))).drop("text")


def placements(raw: DataFrame, parity: bool = False) -> DataFrame:
    """First placement per row with its kind.

    With ``parity`` the wage reading wins whenever the start date exists, as in the
    original load, so a venture is never seen.
    """
    df = with_placement(raw.select(F.col("hashed_email").alias("learner"), "row_ord", "placement_details")).filter(
        F.col("entry").isNotNull()
    )
    kind = F.lit("wage") if parity else placement_kind(F.col("entry"))
    return df.select(
        "learner",
        "row_ord",
        kind.alias("kind"),
        *[F.col("entry")[f].alias(f) for f in S.PLACEMENT_FIELDS[:6]],
        C.parse_int(F.col("entry.jobs_created_to_date")).alias("jobs_created"),
        C.parse_num(F.col("entry.capital_secured_todate")).alias("capital_secured"),
        C.parse_int(F.col("entry.female_opp_todate")).alias("female_opportunities"),
    )


def with_placement_flags(raw: DataFrame, parity: bool = False) -> DataFrame:
    """Add whether the row has a placement and whether it is a venture."""
    entry = F.col("entry")
    venture = F.lit(False) if parity else F.coalesce(placement_kind(entry) == "venture", F.lit(False))
    return with_placement(raw).withColumns({
        "has_placement": entry.isNotNull(),
        "placement_is_venture": F.when(entry.isNotNull(), venture).otherwise(F.lit(False)),
    }).drop("entry")


def placement_flags(raw: DataFrame, parity: bool = False) -> DataFrame:
    """Whether the row's placement is a venture."""
    rows = with_placement_flags(raw.select("hashed_email", "row_ord", "placement_details"), parity)
    return rows.select(F.col("hashed_email").alias("learner"), "row_ord", "has_placement", "placement_is_venture")


def first_entry(raw: DataFrame, column: str, field: str, schema: T.ArrayType) -> Column:
    """Field of the first array entry."""
    return F.get(parse_json_array(raw[column], schema), F.lit(0))[field]


def skill_array(c: Column, delimiter: str = ",", limit: int | None = None) -> Column:
    """Skills of one cell as (id, name, category), first spelling per id.

    ``limit`` keeps the first names only (the original model keeps 50). Works inside the row, no shuffle.
    """
    names = F.transform(F.split(c, delimiter), C.strip)
    names = F.filter(names, lambda s: (s != "") & ~F.lower(s).isin("n/a", "none"))
    names = names if limit is None else F.slice(names, 1, limit)
    names = F.filter(names, lambda s: F.lower(s) != "null")
    items = F.transform(names, lambda s: F.struct(C.skill_id(s).alias("id"), s.alias("name")))
    items = F.filter(items, lambda x: x["id"] != "")
    ids = F.transform(items, lambda x: x["id"])
    items = F.filter(items, lambda x, i: F.array_position(ids, x["id"]) == i + 1)
    return F.transform(
        items, lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"), C.skill_category(x["name"]).alias("category"))
    )


def skill_names(c: Column, delimiter: str = ",") -> Column:
    """Names of one cell that count as skills."""
    names = F.transform(F.split(c, delimiter), C.strip)
    return F.filter(names, lambda s: (s != "") & ~F.lower(s).isin("n/a", "none", "null"))


def stored_skill_edges(raw: DataFrame) -> DataFrame:
    """(learner, skill_id) as ``edges.has_skill(learner_skills(raw))`` gives them; ids are made once for each name, and stored."""
    names = raw.select(F.col("hashed_email").alias("learner"), F.explode(skill_names(F.col("skills_list"))).alias("name"))
    ids = work_table(once(names.select("name").distinct(), skill_id=C.skill_id(F.col("name"))).filter(F.col("skill_id") != ""), "skill-names")
    return names.filter(F.col("learner").isNotNull()).join(ids, "name").select("learner", "skill_id").distinct()


def skill_cells(raw: DataFrame) -> DataFrame:
    """The first row of each skills cell: enough for the skills' own table."""
    cells = raw.groupBy("skills_list").agg(F.min("row_ord").alias("row_ord"))
    return cells.withColumn("hashed_email", F.lit(None).cast("string"))


def learner_skills(raw: DataFrame, delimiter: str = ",", limit: int | None = None) -> DataFrame:
    """(learner, row_ord, pos, skill_id, name, category)."""
    return raw.select(
        F.col("hashed_email").alias("learner"),
        "row_ord",
        F.posexplode(skill_array(F.col("skills_list"), delimiter, limit)).alias("pos", "s"),
    ).select("learner", "row_ord", "pos", F.col("s.id").alias("skill_id"), "s.name", "s.category")


_FLAGS = (
    "is_graduate_learner", "is_active_learner", "is_a_dropped_out", "is_running_a_venture",
    "is_a_freelancer", "is_wage_employed",
)


def silver(
    raw: DataFrame,
    learning: tuple[str, ...] = (),
    employment: tuple[str, ...] = (),
    placement: tuple[str, ...] = (),
) -> DataFrame:
    """Typed flat table: integer flags, clean text, and the named fields of the first entry of
    each JSON array as the structs ``le``, ``em`` and ``pl``.

    Each array is parsed once per row, to the named fields only. The explode of the single
    first entry keeps later filters from being pushed into (and repeating) the JSON parse.
    """
    known = F.col("country_of_residence").isNotNull() & ~F.col("country_of_residence").isin("n/a", "")
    df = raw.withColumns(
        {
            **{f: F.coalesce(C.parse_int(F.col(f)), F.lit(0)).cast("int") for f in _FLAGS},
            "gender": C.norm_gender(F.col("gender")),
            "country": F.when(known, F.col("country_of_residence")),
            "city": C.norm_str(F.col("city_of_residence")),
            "education_level": C.norm_str(F.col("education_level_of_study")),
            "education_field": C.norm_str(F.col("education_field_of_study")),
        }
    )
    for name, column, fields in (
        ("le", "learning_details", learning), ("em", "employment_details", employment), ("pl", "placement_details", placement),
    ):
        if fields:
            df = once(df, **{column: F.col(column)})
            first = F.slice(parse_json_array(F.col(column), S.entry_array(fields)), 1, 1)
            df = df.select("*", F.explode_outer(first).alias(name))
    return df
