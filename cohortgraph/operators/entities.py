"""Node tables from parsed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.functions import cleaning as C
from cohortgraph.functions.jsoncols import parse_json_array
from cohortgraph.operators import parse, states
from cohortgraph.operators.keyed import first_by, last_by


def country_dim(mappings: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(country_key, code) from (name, code) tables. Aliases override; first name in order wins."""
    def keyed(df: DataFrame, rank: int) -> DataFrame:
        order = F.col("ord") if "ord" in df.columns else F.lit(0).cast("bigint")
        return df.select(
            F.lower("name").alias("country_key"), F.upper("code").alias("code"),
            F.struct(F.lit(rank).alias("rank"), order.alias("ord"), F.col("name")).alias("o"),
        )

    df = keyed(mappings, 1)
    if aliases is not None:
        df = df.unionByName(keyed(aliases, 0))
    return first_by(df, ["country_key"], "o", ["code"])


def with_country_code(
    df: DataFrame, dim: DataFrame, name: str = "country_of_residence", out: str = "country_code", mode: str = "null", parity: bool = False
) -> DataFrame:
    """Add the code of a country name. ``mode``: null, auto (``auto:`` and the name, so that no two countries fall together) or strict (error).

    With ``parity`` the automatic code is the first two letters of the name in capitals, under which different
    countries, mapped ones too, can fall together.

    A left join on the lower-case name; Spark broadcasts the dimension when its measured
    size allows.
    """
    if mode not in ("null", "auto", "strict"):
        raise ValueError(f"unknown mode: {mode}")
    clean = C.norm_str(F.col(name))
    joined = df.withColumn("_key", F.lower(clean)).join(
        dim.select(F.col("country_key").alias("_key"), F.col("code").alias("_mapped_code")), "_key", "left"
    )
    code = F.col("_mapped_code")
    if mode == "auto":
        code = F.coalesce(code, F.upper(F.substring(clean, 1, 2)) if parity else F.concat(F.lit("auto:"), F.upper(clean)))
    elif mode == "strict":
        code = F.when(
            code.isNull() & clean.isNotNull(),
            F.raise_error(F.concat(F.lit("country not in mapping: "), clean)).cast("string"),
        ).otherwise(code)
    return joined.withColumn(out, code).drop("_key", "_mapped_code")


def unmapped_countries(df: DataFrame, dim: DataFrame, name: str = "country_of_residence") -> DataFrame:
    """Names without a code and how often they occur."""
    names = df.select(C.norm_str(F.col(name)).alias("country")).filter(F.col("country").isNotNull())
    counts = names.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(dim, F.lower("country") == F.col("country_key"), "left_anti")


def learner_base(raw: DataFrame, keep: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """Renamed and cleaned learner columns, plus the ``keep`` columns as they are; ``whole``: all are asked for, so they are made in steps."""
    text = {
        "sand_id": "sand_id", "full_name": "full_name", "profile_photo_url": "profile_photo_url", "bio": "bio",
        "education_field": "education_field_of_study",
        "description_of_living_location": "description_of_living_location",
        "type_of_disability": "type_of_disability",
    }
    columns = {
        "row_ord": F.col("row_ord"),
        "hashed_email": C.norm_str(F.col("hashed_email")),
        **{dst: C.norm_str(F.col(src)) for dst, src in text.items()},
        "gender": C.norm_gender(F.col("gender")),
        "education_level": C.norm_education(F.col("education_level_of_study")),
        "is_placed": F.coalesce(C.parse_bool(F.col("is_placed")), F.lit(False)),
        "is_featured": F.coalesce(C.parse_bool(F.col("is_featured")), F.lit(False)),
        "is_rural": C.parse_rural(F.col("is_rural")),
        "has_disability": C.parse_bool(F.col("has_disability")),
        "is_from_low_income_household": C.parse_bool(F.col("is_from_low_income_household")),
        "snapshot_id": C.parse_int(F.col("snapshot_id")),
        **{c: F.col(c) for c in keep},
    }
    return parse.in_steps(raw, columns) if whole else raw.select(*[c.alias(n) for n, c in columns.items()])


LEARNER_COLUMNS = (
    "hashed_email", "sand_id", "full_name", "profile_photo_url", "bio", "gender", "education_level",
    "education_field", "country_of_residence_code", "country_of_origin_code", "city_of_residence_id",
    "current_learning_state", "current_professional_status", "is_placed", "is_featured", "is_rural",
    "description_of_living_location", "has_disability", "type_of_disability",
    "is_from_low_income_household", "snapshot_id",
)


#: raw columns of a learner record, beside its key and what its jobs and placement say
LEARNER_SOURCES = (
    "sand_id", "full_name", "profile_photo_url", "bio", "education_field_of_study", "description_of_living_location", "type_of_disability",
    "gender", "education_level_of_study", "is_placed", "is_featured", "is_rural", "has_disability", "is_from_low_income_household",
    "snapshot_id", "country_of_residence", "country_of_origin", "city_of_residence", "is_graduate_learner", "is_active_learner",
    "is_a_dropped_out", "is_running_a_venture", "is_wage_employed",
)


def _sources(raw: DataFrame, snapshot: str, parity: bool) -> DataFrame:
    """The raw columns of learner records, with ``_current`` jobs and whether the placement is a ``_venture``."""
    df = raw.select("hashed_email", "row_ord", *LEARNER_SOURCES, "employment_details", "placement_details")
    df = parse.with_placement(parse.once(df, employment_details=F.col("employment_details")))
    ends = parse_json_array(F.col("employment_details"), S.entry_array(("end_date",)))
    n_current = F.size(F.filter(ends, lambda j: C.is_current_by_date(j["end_date"], snapshot)))
    placement = F.col("entry")
    venture = F.lit(False) if parity else (placement.isNotNull() & (parse.placement_kind(placement) == "venture"))
    return parse.once(df, _current=n_current, _venture=venture).drop("employment_details", "placement_details", "entry")


def _records(sources: DataFrame, dim: DataFrame, country_mode: str) -> DataFrame:
    df = with_country_code(sources, dim, "country_of_residence", "_res", country_mode)
    df = with_country_code(df, dim, "country_of_origin", "_orig", country_mode)
    derived = {
        "country_of_residence_code": F.col("_res"),
        "country_of_origin_code": F.col("_orig"),
        "city_of_residence_id": C.city_id(F.col("city_of_residence"), F.col("_res")),
        "current_learning_state": states.learning_state(
            C.is_set(F.col("is_graduate_learner")), C.is_set(F.col("is_active_learner")), C.is_set(F.col("is_a_dropped_out"))
        ),
        "current_professional_status": states.professional_status(
            F.col("_current"), F.col("_venture"),
            C.is_set(F.col("is_running_a_venture")), C.is_set(F.col("is_wage_employed")),
        ),
    }
    out = learner_base(parse.once(df, **derived), keep=tuple(derived), whole=True)
    return out.select("row_ord", *LEARNER_COLUMNS)


def learner_rows(
    raw: DataFrame, dim: DataFrame, snapshot: str = C.SNAPSHOT_DATE, parity: bool = False, country_mode: str = "null"
) -> DataFrame:
    """Learner record of every raw row with codes and current states."""
    return _records(_sources(raw, snapshot, parity), dim, country_mode)


def learners(raw: DataFrame, dim: DataFrame, snapshot: str = C.SNAPSHOT_DATE, parity: bool = False, country_mode: str = "null") -> DataFrame:
    """One learner per key, last row wins; rows without a key are not written.

    Only the last rows are cleaned, unless every country has to be known (``strict``).
    """
    key = F.col("hashed_email")
    if country_mode == "strict":
        rows = learner_rows(raw, dim, snapshot, parity, country_mode).filter(key.isNotNull())
        return last_by(rows, ["hashed_email"], "row_ord", list(LEARNER_COLUMNS), whole=True).select(*LEARNER_COLUMNS)
    rows = _sources(raw, snapshot, parity).withColumn("hashed_email", C.norm_str(key)).filter(key.isNotNull())
    last = last_by(rows, ["hashed_email"], "row_ord", ["row_ord", *LEARNER_SOURCES, "_current", "_venture"], whole=True)
    return _records(last, dim, country_mode).select(*LEARNER_COLUMNS)


def learner_keys(raw: DataFrame) -> DataFrame:
    """The keys of the learner table, without its values."""
    return raw.select(C.norm_str(F.col("hashed_email")).alias("hashed_email")).filter(F.col("hashed_email").isNotNull()).distinct()


def countries(raw: DataFrame, dim: DataFrame, mode: str = "null") -> DataFrame:
    """Countries of residence (with coordinates) and origin (without); first occurrence wins."""
    def side(name: str, lat: str | None, lon: str | None, rank: int) -> DataFrame:
        cells = raw.groupBy(name, *[c for c in (lat, lon) if c]).agg(F.min("row_ord").alias("row_ord"))  # equal cells are cleaned once
        df = with_country_code(cells, dim, name, "code", mode).filter(F.col("code").isNotNull())
        none = F.lit(None).cast("double")
        return df.select(
            "code",
            C.norm_str(F.col(name)).alias("name"),
            (C.parse_num(F.col(lat)) if lat else none).alias("latitude"),
            (C.parse_num(F.col(lon)) if lon else none).alias("longitude"),
            F.struct(F.col("row_ord"), F.lit(rank).alias("r")).alias("o"),
        )

    both = side(
        "country_of_residence", "country_of_residence_latitude", "country_of_residence_longitude", 0
    ).unionByName(side("country_of_origin", None, None, 1))
    return first_by(both, ["code"], "o", ["code", "name", "latitude", "longitude"])


def cities(raw: DataFrame, dim: DataFrame, mode: str = "null", parity: bool = False) -> DataFrame:
    """Cities of a known country, first occurrence of an id wins; with ``parity`` ids are three-letter prefixes."""
    cells = raw.groupBy("country_of_residence", "city_of_residence", "city_of_residence_latitude", "city_of_residence_longitude")
    df = with_country_code(cells.agg(F.min("row_ord").alias("row_ord")), dim, "country_of_residence", "country_code", mode)
    df = df.select(
        C.city_id(F.col("city_of_residence"), F.col("country_code"), parity).alias("id"),
        C.norm_str(F.col("city_of_residence")).alias("name"),
        "country_code",
        C.parse_num(F.col("city_of_residence_latitude")).alias("latitude"),
        C.parse_num(F.col("city_of_residence_longitude")).alias("longitude"),
        "row_ord",
    ).filter(F.col("id").isNotNull())
    return first_by(df, ["id"], "row_ord", ["id", "name", "country_code", "latitude", "longitude"])


def skills(learner_skills: DataFrame) -> DataFrame:
    df = learner_skills.withColumnRenamed("skill_id", "id")
    return first_by(df, ["id"], F.struct("row_ord", "pos"), ["id", "name", "category"])


def programs(enrollments: DataFrame, provider: str = S.PROVIDER) -> DataFrame:
    """Programs keyed by cohort code; the source does not name their provider."""
    key = "program_id" if "program_id" in enrollments.columns else "cohort_code"
    df = enrollments.select(F.col(key).alias("id"), F.col("program_name").alias("name"), "row_ord", "pos")
    out = first_by(df, ["id"], F.struct("row_ord", "pos"), ["id", "name"])
    return out.select("id", "name", F.col("id").alias("cohort_code"), F.lit(provider).alias("provider"))


def companies(jobs: DataFrame) -> DataFrame:
    """Companies keyed by the hash of their name; industry and country are unknown to the source."""
    names = jobs.select(C.hash_id(F.col("organization_name")).alias("id"), F.col("organization_name").alias("name"))
    none = F.lit(None).cast("string")
    return names.distinct().select("id", "name", none.alias("industry"), none.alias("country_code"))


def state_nodes(history: DataFrame, value: str, note: str) -> DataFrame:
    """Distinct (state, start) pairs of a history; the first learner's properties are kept."""
    df = history.filter(F.col("start_date").isNotNull())
    order = F.struct("learner", "entry_ord", "step")
    return first_by(df, [value, "start_date"], order, [value, "start_date", "end_date", "is_current", note])


def entity_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("kind"), "n")
        out = one if out is None else out.unionByName(one)
    return out
