"""Registered cleaning, parsing, entity, edge, validation, profiling and I/O queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgraph import schemas as S
from cohortgraph.bindings import star
from cohortgraph.functions import cleaning as C
from cohortgraph.functions.jsoncols import has_fields, parse_json_array
from cohortgraph.operators import edges, entities, keyed, load, parse, quality
from cohortgraph.operators import states as ST
from cohortgraph.plans import profiling as P
from cohortgraph.plans import registry_history as H
from cohortgraph.plans.shape import as_text
from cohortgraph.session import shared_dir, work_table
from cohortgraph.sources import readers, writers
from cohortgraph.streaming import incremental

AS_OF = star.AS_OF
CSV_RECORDS = 50_000  # of a compressed file


@star.per_session
def dim(spark, sf):
    return entities.country_dim(star.country_mapping(spark, sf))


@star.per_session
def enrolments(spark, sf):
    return parse.enrollments_raw(star.raw_rows(spark, sf))


@star.per_session
def jobs(spark, sf):
    return parse.jobs_raw(star.raw_rows(spark, sf))


@star.per_session
def schooling(spark, sf):
    return parse.education_raw(star.raw_rows(spark, sf))


@star.per_session
def skills(spark, sf):
    return parse.learner_skills(star.raw_rows(spark, sf))


@star.per_session
def typed(spark, sf):
    return edges.typed_enrollments(enrolments(spark, sf))


@star.per_session
def learners(spark, sf):
    return entities.learners(star.raw_rows(spark, sf), dim(spark, sf), snapshot=AS_OF)


def _n():
    return F.count(F.lit(1))


def per_row(columns):
    """Expressions over the raw table, beside the row order; built when the query runs."""
    return lambda spark, sf: star.raw_rows(spark, sf).select("row_ord", *[c.alias(n) for n, c in columns().items()])


def per_entry(columns):
    return lambda spark, sf: enrolments(spark, sf).select("row_ord", *[c.alias(n) for n, c in columns().items()])


def on_raw(question, **options):
    return lambda spark, sf: as_text(question(star.raw_rows(spark, sf), **options))


def on(table, question, **options):
    return lambda spark, sf: as_text(question(table(spark, sf), **options))


def counted(table, *keys):
    return lambda spark, sf: table(spark, sf).groupBy(*keys).agg(_n().alias("n"))


def _field(name):
    return F.col(name)


def _skill_ids(spark, sf):
    names = star.table(spark, sf, "part").select(star.skill_name(F.col("p_name")).alias("name")).distinct()
    return names.select("name", C.skill_id(F.col("name")).alias("id"), C.skill_category(F.col("name")).alias("category"))


def _job_class(spark, sf):
    df = star.jobs(spark, sf).select(F.col("position").alias("job_title"), "organization_name").distinct()
    return df.select("job_title", "organization_name", C.employment_class(F.col("job_title"), F.col("organization_name")).alias("cls"))


def _country_code(mode):
    def run(spark, sf):
        df = entities.with_country_code(star.raw_rows(spark, sf), dim(spark, sf), mode=mode)
        return df.groupBy("country_of_residence", "country_code").agg(_n().alias("n"))

    return run


def _country_code_parity(spark, sf):
    df = entities.with_country_code(star.raw_rows(spark, sf), dim(spark, sf), mode="auto", parity=True)
    return df.groupBy("country_code").agg(_n().alias("n"), F.countDistinct("country_of_residence").alias("countries"))


def _country_code_strict(spark, sf):
    """Strict mode over all rows, with a mapping completed by the automatic codes of what it lacks."""
    raw, known = star.raw_rows(spark, sf), dim(spark, sf)
    lacking = entities.unmapped_countries(raw, known).select(F.lower("country").alias("country_key"), F.concat(F.lit("auto:"), F.upper("country")).alias("code"))
    full = known.select("country_key", "code").unionByName(lacking)
    return entities.with_country_code(raw, full, mode="strict").groupBy("country_code").agg(_n().alias("n"))


def _dedup_first(spark, sf):
    df = typed(spark, sf).select("learner", "row_ord", "program_id", "lms_overall_score")
    return keyed.dedup_first(df, "learner", "row_ord")


def _dedup_batched(spark, sf):
    df = typed(spark, sf).select("learner", "row_ord", "program_id", "start_date")
    df = df.withColumn("batch", F.floor(F.col("row_ord") / 1000)).drop("start_date")
    return keyed.dedup_batched(df, "learner", "row_ord", "batch").select("learner", "program_id", "batch")


def _upsert_nodes(spark, sf):
    df = typed(spark, sf)
    cols = ["learner", "program_id", "lms_overall_score"]
    target = keyed.last_by(df.filter("enrollment_status <> 'Graduated'"), ["learner"], "row_ord", cols)
    updates = df.filter("enrollment_status = 'Graduated'").select(*cols, "row_ord")
    return keyed.upsert(target.select(*cols), updates, ["learner"], "row_ord")


def _upsert_edges(spark, sf):
    df = typed(spark, sf).select("learner", "program_id", "enrollment_status", "row_ord")
    people = star.learner_nodes(spark, sf).filter(F.col("gender").isNotNull())
    programs = entities.programs(enrolments(spark, sf)).filter(F.col("name").contains("Data"))
    target = keyed.last_by(df.filter("enrollment_status = 'Enrolled'"), ["learner", "program_id"], "row_ord", ["enrollment_status"])
    updates = df.filter("enrollment_status <> 'Enrolled'")
    ends = (("learner", people, "hashed_email"), ("program_id", programs, "id"))
    return keyed.upsert_edges(target, updates, ends, "row_ord")


def _typed_nodes(spark, sf):
    return writers.to_node_table(star.learner_nodes(spark, sf), "Learner")


def _geo(spark, sf):
    people = star.learner_nodes(spark, sf)
    city = star.city_nodes(spark, sf).select(F.col("id").alias("city_of_residence_id"), F.col("country_code").alias("city_country"))
    df = people.groupBy("city_of_residence_id", "country_of_residence_code", "country_of_origin_code").agg(_n().alias("n"))
    return df.join(city, "city_of_residence_id").groupBy("city_country", "country_of_residence_code", "country_of_origin_code").agg(F.sum("n").alias("n"))


def _states(spark, sf):
    df = entities.state_nodes(H.learning(spark, sf), "state", "reason")
    return df.select("state", "start_date", "end_date", "is_current", "reason")


def _entity_counts(spark, sf):
    raw = star.raw_rows(spark, sf)
    return entities.entity_counts({
        "countries": entities.countries(raw, dim(spark, sf)), "cities": entities.cities(raw, dim(spark, sf)),
        "skills": entities.skills(skills(spark, sf)), "programs": entities.programs(enrolments(spark, sf)),
        "companies": entities.companies(jobs(spark, sf)),
        "learners": entities.learner_keys(raw),  # one learner a key; the values are not needed for their number
    })


def _checked_learners(spark, sf):
    raw = entities.with_country_code(star.raw_rows(spark, sf), dim(spark, sf), out="_code")
    df = raw.select(
        "row_ord", F.col("hashed_email"), C.norm_str(F.col("full_name")).alias("full_name"), C.norm_str(F.col("sand_id")).alias("sand_id"),
        F.coalesce("_code", "country_of_residence").alias("country_of_residence_code"), F.lit(None).cast("string").alias("country_of_origin_code"),
    )
    return quality.check_learners(df, ("hashed_email", "full_name", "sand_id"))


def _split(which):
    def run(spark, sf):
        checked, path = _checked_learners(spark, sf), _folder(spark)
        quality.write_split(checked, path)
        good, bad = quality.read_split(spark, path, checked.schema)
        return as_text((good, bad)[which].select("row_ord", *(["errors"] if which else [])))

    return run


def _split_report(spark, sf):
    return quality.write_split(_checked_learners(spark, sf), _folder(spark))


def _checked_enrolments(spark, sf):
    return quality.check_enrollments(typed(spark, sf), 0, 90)


def _checked_jobs(spark, sf):
    return quality.check_employment(edges.typed_jobs(jobs(spark, sf)))


def _checked_schooling(spark, sf):
    df = schooling(spark, sf).select(
        "row_ord", "pos", C.parse_date(F.col("start_date")).alias("start_date"), C.parse_date(F.col("end_date")).alias("end_date")
    )
    return quality.check_range(df, "start_date", "end_date", "education")


def _consistency_input(spark, sf):
    flags = star.learner_flags(spark, sf)
    status = ST.status_from_flags(F.col("is_venture"), F.col("is_wage"), F.col("is_freelancer"))
    return flags.select("learner", status.alias("status"))


def _concurrent(spark, sf):
    names = star.raw_rows(spark, sf).select("row_ord", C.norm_str(F.col("full_name")).alias("person")).filter(F.col("person").isNotNull())
    return P.p12_concurrent(typed(spark, sf).select("row_ord", "start_date", "end_date").join(names, "row_ord"))


def _discrepancy(spark, sf):
    return P.p25_source_discrepancy(*P.name_and_code_counts(
        star.raw_rows(spark, sf), star.learner_nodes(spark, sf), star.country_nodes(spark, sf)
    ))


def _folder(spark):
    return f"{shared_dir(spark)}/cohortgraph-{uuid.uuid4().hex}"


def _csv(spark, sf):
    """All columns with quoted line breaks, byte-order marks and short rows, written, read back and compared cell by cell.

    Rows meet by the digests of their cells, what is asked for beside them; only rows whose digests differ meet with
    all cells. The files are compressed, so their records are bounded.
    """
    path = _folder(spark)
    raw = star.raw_rows(spark, sf, False, True).withColumn("row_ord", F.col("row_ord").cast("string"))
    raw = raw.withColumn("full_name", F.concat("full_name", F.lit('\nalso "known", as\r\n'), "hashed_email"))
    columns = sorted(raw.columns, key=lambda c: (c == "type_of_disability", raw.columns.index(c)))  # NULL in all rows: they come short
    writers.export_csv(raw.select(*columns), path, bom=True, records=CSV_RECORDS)
    back = readers.read_learners(spark, "csv", {"path": path, "whole_files": True})
    rows = parse.once(back, text=F.col("learning_details"))  # the entries are parsed in their row: the files are read once
    entries = F.filter(parse_json_array(F.col("text"), S.LEARNING_ARRAY), lambda e: has_fields(e, S.LEARNING_FIELDS))
    rows = parse.once(rows, entries=entries).filter(F.size("entries") > 0)
    cells = [c for c in columns if c != "row_ord"]
    best = [F.array_max(F.col(f"entries.{c}")).alias(c) for c in ("program_name", "enrollment_status")]
    asked = ["row_ord", "hashed_email", "full_name", "gender", "differing_cells", "columns", "program_name", "enrollment_status"]

    narrow = rows.select("row_ord", "hashed_email", "full_name", "gender", *best, digest(cells).alias("read"))
    met = raw.select("row_ord", digest(cells).alias("written")).join(narrow, "row_ord").withColumn("differs", F.col("written") != F.col("read"))
    met = work_table(met.drop("written", "read").withColumns({"differing_cells": F.lit(0), "columns": F.lit(len(back.columns))}), "csv-compared")
    same, differing = met.filter("not differs").select(*asked), met.filter("differs").select("row_ord").distinct()
    if differing.isEmpty():
        return same
    a, b = (df.join(differing, "row_ord", "left_semi").alias(n) for df, n in ((raw, "a"), (rows.select("*", *best), "b")))
    number = sum((~F.coalesce(F.col(f"a.{c}"), F.lit("")).eqNullSafe(F.coalesce(F.col(f"b.{c}"), F.lit("")))).cast("int") for c in cells)
    both = a.join(b, "row_ord").select("b.*", number.alias("differing_cells"), F.lit(len(back.columns)).alias("columns"))
    return same.unionByName(both.filter("differing_cells > 0").select(*asked))


def digest(columns):
    """SHA-256 of the cells in a row as JSON; NULL counts as empty."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])), 256))


def _csv_nulls(spark, sf):
    path = _folder(spark)
    writers.export_csv(enrolments(spark, sf).drop("entry_ord"), path)
    back = readers.read_learners_csv(spark, path, null_tokens=readers.DEFAULT_NULL_TOKENS, multi_line=False)
    counts = back.agg(*[F.count(f"`{c}`").alias(c) for c in back.columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("filled")) for c in back.columns])).alias("r")).select("r.*")


def _export(spark, sf):
    return writers.export_parquet(star.raw_rows(spark, sf), _folder(spark)).select("rows", "columns")


def _round_trip(spark, sf):
    path = _folder(spark)
    writers.export_parquet(typed(spark, sf), path)
    return readers.read_learners(spark, "parquet", {"path": path}).groupBy("program_id").agg(_n().alias("n"), F.sum("number_of_submissions").alias("submissions"))


def _stored_graph(spark, sf):
    path = _folder(spark)
    writers.write_graph(star.graph(spark, sf), path)
    g = writers.read_graph(spark, path)
    return entities.entity_counts(g.members())


def _load_raw(spark, sf):
    """The whole load from raw rows, twice, and the rows of the tables of the version that readers see. The rows are landed once."""
    path = _folder(spark)
    raw = work_table(star.raw_rows(spark, sf, True, True), "landing")
    for _ in range(2):
        load.load_graph(raw, dim(spark, sf), path, star.AS_OF)
    manifest = writers.graph_manifest(spark, path)
    members = writers.read_graph(spark, path, manifest["version"]).members()
    parts = [df.agg(F.lit(name).alias("kind"), _n().alias("n"), F.lit(manifest["rows"][name]).alias("committed"), F.lit(manifest["version"]).alias("version"))
             for name, df in members.items() if name != "has_professional_status"]
    return reduce(DataFrame.unionByName, parts)


def _ingest_in_two(spark, sf):
    """Events in two deliveries, the second with rows older than those already taken in; the second run resumes."""
    path = _folder(spark)
    events = spark.read.parquet(f"{sf}/events.parquet")
    reports = []
    for late in (0, 1):
        events.filter(F.col("event_id") % 2 == 1 - late).write.parquet(f"{path}/inbox/{late}")
        stream = incremental.stream_files(spark, f"{path}/inbox/*", events.schema)
        reports.append(incremental.ingest(stream, f"{path}/out", ["user_id"], ["ts", "event_id"]))
    return f"{path}/out", reports


def _ingest(spark, sf):
    path, _ = _ingest_in_two(spark, sf)
    return incremental.current(spark, path, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


def _progress(spark, sf):
    """Rows that each run of an ingest in two deliveries took in."""
    _, reports = _ingest_in_two(spark, sf)
    return spark.createDataFrame([(i, r["batches"], r["rows"]) for i, r in enumerate(reports)], "run int, batches int, rows bigint")


def _factory(spark, sf):
    """The raw table written once in each file format and read back by the reader of that name.

    The CSV files are compressed. Such a file is one task's work, so its records are bounded.
    """
    path = _folder(spark)
    raw = star.raw_rows(spark, sf).drop("row_ord")
    raw.write.parquet(f"{path}/parquet")
    csv = spark.read.parquet(f"{path}/parquet").write.option("header", "true").option("escape", '"')
    csv.option("compression", "gzip").option("maxRecordsPerFile", CSV_RECORDS).csv(f"{path}/csv")
    parts = [
        readers.read_learners(spark, name, {"path": f"{path}/{name}"} | options).agg(
            F.lit(name).alias("source"), _n().alias("n"), F.countDistinct("hashed_email").alias("learners"), F.count_if(F.col("is_wage_employed") == "1").alias("wage"))
        for name, options in (("csv", {"multi_line": True}), ("parquet", {}))
    ]
    return parts[0].unionByName(parts[1])


def _clear(spark, sf):
    """Rows of a stored table, and whether it is gone after the confirmed clear."""
    path = _folder(spark)
    rows = writers.export_parquet(star.raw_rows(spark, sf), path).select("rows").first()[0]
    cleared = writers.clear(spark, path, confirm=True)
    return spark.createDataFrame([(rows, cleared, writers.clear(spark, path, confirm=True))], "rows bigint, cleared boolean, cleared_again boolean")


def _run_report(spark, sf):
    """Counts of a load: raw rows, valid rows and written entities."""
    checked = quality.quality_metrics(_checked_learners(spark, sf))
    long = F.array(*[
        F.struct(F.lit(c).alias("kind"), F.col(c).cast("bigint").alias("n")) for c in ("total_records", "valid_records", "invalid_records")
    ])
    return checked.select(F.explode(long).alias("r")).select("r.*").unionByName(_entity_counts(spark, sf))


QUERIES = {
    # scalar cleaning
    "fn_norm_str": per_row(lambda: dict(full_name=C.norm_str(_field("full_name")), sand_id=C.norm_str(_field("sand_id")))),
    "fn_skill_id": _skill_ids,
    "fn_city_id": per_row(lambda: dict(city_id=C.city_id(_field("city_of_residence"), F.substring("gender", 1, 2)))),
    "fn_city_id_parity": per_row(lambda: dict(city_id=C.city_id(_field("city_of_residence"), F.substring("gender", 1, 2), parity=True))),
    "fn_parse_date": per_entry(lambda: dict(
        start_date=C.parse_date(_field("program_start_date")), graduation_date=C.parse_date(_field("program_graduation_date"))
    )),
    "fn_parse_num": per_entry(lambda: dict(score=C.parse_num(_field("lms_overall_score")), completion=C.parse_num(_field("completion_rate")))),
    "fn_parse_int": per_entry(lambda: dict(
        submissions=C.parse_int(_field("no_of_submissions")), kept=C.parse_int(_field("no_of_submissions"), keep_missing=True)
    )),
    "fn_parse_bool": per_row(lambda: dict(has_disability=C.parse_bool(_field("has_disability")), is_placed=C.parse_bool(_field("is_placed")))),
    "fn_is_rural": per_row(lambda: dict(is_rural=C.parse_rural(_field("is_rural")))),
    "fn_gender": per_row(lambda: dict(gender=C.norm_gender(_field("gender")))),
    "fn_education": per_row(lambda: dict(education_level=C.norm_education(_field("education_level_of_study")))),
    "fn_hash_id": lambda spark, sf: star.company_nodes(spark, sf).select("name", C.hash_id(F.col("name")).alias("id")),
    "fn_safe_casts": per_entry(lambda: dict(
        d=C.safe_double(_field("lms_overall_score")), i=C.safe_int(_field("no_of_test")), t=C.safe_date(_field("program_start_date"))
    )),
    "fn_program_match": lambda spark, sf: enrolments(spark, sf).agg(
        F.count_if(C.contains_term(F.col("program_name"), "Data Analytics")).alias("specific"),
        F.count_if(C.contains_term(F.col("program_name"), "DATA")).alias("broad"),
    ),
    "fn_valid_company": lambda spark, sf: jobs(spark, sf).agg(F.count_if(C.valid_company(F.col("organization_name"))).alias("n")),
    "fn_country_code": _country_code("null"),
    "fn_country_code_auto": _country_code("auto"),
    "fn_country_code_auto_parity": _country_code_parity,
    "fn_country_code_strict": _country_code_strict,
    "fn_unmapped_countries": lambda spark, sf: entities.unmapped_countries(star.raw_rows(spark, sf), dim(spark, sf)),
    "fn_employment_class": _job_class,
    "fn_is_current_date": lambda spark, sf: jobs(spark, sf).groupBy(
        C.is_current_by_date(F.col("end_date"), AS_OF).alias("is_current")
    ).agg(_n().alias("n")),
    "fn_field_map": lambda spark, sf: entities.learner_base(star.raw_rows(spark, sf)),
    "src_country_map": lambda spark, sf: dim(spark, sf),
    # JSON and arrays
    "js_array": per_row(lambda: dict(
        learning=F.size(parse.parse_json_array(_field("learning_details"), S.LEARNING_ARRAY)),
        employment=F.coalesce(F.size(parse.parse_json_array(_field("employment_details"), S.EMPLOYMENT_ARRAY)), F.lit(0)),
        education=F.coalesce(F.size(parse.parse_json_array(_field("education_details"), S.EDUCATION_ARRAY)), F.lit(0)),
        doubly_encoded=F.coalesce(F.size(parse.parse_json_array(F.to_json(F.struct("employment_details")).substr(
            F.lit(23), F.length(F.to_json(F.struct("employment_details"))) - 23), S.EMPLOYMENT_ARRAY)), F.lit(0)),
    )),
    "js_learning": lambda spark, sf: enrolments(spark, sf).select(
        "learner", "row_ord", "pos", "index", "program_name", "cohort_code", "program_start_date", "program_end_date", "enrollment_status",
        "program_graduation_date", "lms_overall_score", "completion_rate",
    ),
    "js_employment": lambda spark, sf: jobs(spark, sf).select(
        "learner", "row_ord", "pos", "organization_name", "start_date", "end_date", "country", "job_title", "is_current"
    ),
    "js_education": lambda spark, sf: schooling(spark, sf).select(
        "learner", "row_ord", "pos", "institution_name", "start_date", "end_date", "level_of_study", "field_of_study", "graduated"
    ),
    "js_placement": lambda spark, sf: parse.placements(star.raw_rows(spark, sf)).select(
        "row_ord", "kind", "organisation_name", "salary_range", "business_name", "jobs_created", "female_opportunities"
    ),
    "js_placement_type": lambda spark, sf: parse.placement_flags(star.raw_rows(spark, sf)).select("row_ord", "has_placement", "placement_is_venture"),
    "js_placement_type_parity": lambda spark, sf: parse.placement_flags(star.raw_rows(spark, sf), parity=True).groupBy(
        "has_placement", "placement_is_venture"
    ).agg(_n().alias("n")),
    "js_first_field": lambda spark, sf: star.raw_rows(spark, sf).groupBy(
        parse.first_entry(star.raw_rows(spark, sf), "learning_details", "cohort_code", S.LEARNING_ARRAY).alias("cohort_code")
    ).agg(_n().alias("n")),
    "arr_skills": lambda spark, sf: skills(spark, sf),
    # entities
    "ent_learner": learners,
    "ent_country": lambda spark, sf: entities.countries(star.raw_rows(spark, sf), dim(spark, sf)),
    "ent_city": lambda spark, sf: entities.cities(star.raw_rows(spark, sf), dim(spark, sf)),
    "ent_skill": lambda spark, sf: entities.skills(skills(spark, sf)),
    "ent_program": lambda spark, sf: entities.programs(enrolments(spark, sf)),
    "ent_company": lambda spark, sf: entities.companies(jobs(spark, sf)),
    "ent_states": _states,
    "ent_dedup_first": _dedup_first,
    "ent_dedup_batch": _dedup_batched,
    "ent_counts": _entity_counts,
    # edges
    "edge_has_skill": lambda spark, sf: edges.has_skill(skills(spark, sf)),
    "edge_enrolled_in": lambda spark, sf: edges.enrolled_in(typed(spark, sf)),
    "edge_enroll_derived": lambda spark, sf: edges.with_enrollment_flags(typed(spark, sf)).select(
        "row_ord", "is_completed", "is_dropped", "duration"
    ),
    "edge_works_for": lambda spark, sf: edges.works_for(edges.typed_jobs(jobs(spark, sf))),
    "edge_work_derived": lambda spark, sf: edges.with_employment_derived(edges.works_for(edges.typed_jobs(jobs(spark, sf)))),
    "edge_venture": lambda spark, sf: edges.runs_venture(parse.placements(star.raw_rows(spark, sf))),
    "edge_geo": _geo,
    "snk_nodes": _upsert_nodes,
    "snk_edges": _upsert_edges,
    "snk_nodes_typed": _typed_nodes,
    # validation and quality
    "val_required": lambda spark, sf: as_text(_checked_learners(spark, sf).select("row_ord", "errors")),
    "val_type": lambda spark, sf: quality.type_errors(star.raw_rows(spark, sf), ("sand_id", "hashed_email", "row_ord")),
    "val_country_len": lambda spark, sf: quality.errors_by_field(_checked_learners(spark, sf)),
    "val_split": _split_report,
    "val_split_good": _split(0),
    "val_split_bad": _split(1),
    "val_enrollment": lambda spark, sf: as_text(_checked_enrolments(spark, sf).filter(F.size("errors") > 0).select("row_ord", "errors")),
    "val_employment": lambda spark, sf: as_text(_checked_jobs(spark, sf).select("row_ord", "pos", "errors")),
    "val_range": lambda spark, sf: as_text(_checked_schooling(spark, sf).select("row_ord", "pos", "errors")),
    "val_emp_consistency": lambda spark, sf: quality.employment_consistency(_consistency_input(spark, sf), jobs(spark, sf)),
    "val_emp_contradicting_jobs": lambda spark, sf: quality.contradicting_jobs(_consistency_input(spark, sf), jobs(spark, sf)),
    "dq_metrics": lambda spark, sf: quality.quality_metrics(_checked_learners(spark, sf)),
    "dq_errors_by_type": lambda spark, sf: quality.errors_by_type(_checked_learners(spark, sf)),
    "dq_threshold": lambda spark, sf: quality.quality_gate(quality.quality_metrics(_checked_jobs(spark, sf)), 0.05),
    "dq_top": lambda spark, sf: quality.top_errors(_checked_enrolments(spark, sf), 10),
    "dq_top_fields": lambda spark, sf: quality.top_fields(_checked_learners(spark, sf), 10),
    "dq_report": lambda spark, sf: quality.quality_report(_checked_learners(spark, sf)),
    "dq_mapping_coverage": lambda spark, sf: quality.mapping_coverage(star.raw_rows(spark, sf), dim(spark, sf)),
    # profiling
    "p01_flag_check": on_raw(P.p01_flag_check),
    "p02_field_completeness": on(enrolments, P.p02_field_completeness),
    "p03_status_values": on(enrolments, P.p03_status_values),
    "p04_crosstab": on_raw(P.p04_crosstab),
    "p05_exclusive": on_raw(P.p05_exclusive),
    "p06_value_share_program": on(enrolments, P.p06_value_share, column="program_name"),
    "p06_value_share_cohort": on(enrolments, P.p06_value_share, column="cohort_code"),
    "p06_value_share_completion": on(enrolments, P.p06_value_share, column="completion_rate"),
    "p07_temporal_issues": on(typed, P.p07_temporal_issues),
    "p08_completion_by_status": on(typed, P.p08_completion_by_status),
    "p09_identity": on_raw(P.p09_identity),
    "p10_multi_program": on_raw(P.p10_multi_program),
    "p11_status_combos": on_raw(P.p11_status_combos),
    "p12_concurrent": _concurrent,
    "p13_same_person": on_raw(P.p13_same_person),
    "p14_has_flags": lambda spark, sf: P.p14_has_flags(star.flag_rows(spark, sf)),
    "p15_edu_entries": on_raw(P.p15_edu_entries),
    "p16_edu_institutions": on(schooling, P.p16_edu_top, column="institution_name"),
    "p16_edu_levels": on(schooling, P.p16_edu_top, column="level_of_study"),
    "p16_edu_fields": on(schooling, P.p16_edu_top, column="field_of_study"),
    "p17_inst_class": on(schooling, P.p17_inst_class, countries=["NATION_1", "NATION_2", "NATION_10"]),
    "p18_edu_years": on(schooling, P.p18_edu_years),
    "p19_edu_duration": on(schooling, P.p19_edu_duration),
    "p20_edu_progression": on_raw(P.p20_edu_progression),
    "p21_edu_issues": on(schooling, P.p21_edu_issues, as_of="1990-01-01"),
    "p22_emp_crosstab": on_raw(P.p22_emp_crosstab),
    "p23_stale_jobs": on(jobs, P.p23_stale_jobs, as_of=AS_OF),
    "p24_jobs_per_person": on(jobs, P.p24_jobs_per_person),
    "p25_source_discrepancy": _discrepancy,
    # sources, sinks, increments
    "src_csv": _csv,
    "src_csv_nulls": _csv_nulls,
    "src_parquet": _round_trip,
    "src_meta": lambda spark, sf: readers.source_summary(readers.read_learners_parquet(spark, f"{sf}/orders.parquet")),
    "src_row_range": lambda spark, sf: readers.row_range(spark, f"{sf}/orders.parquet", 100, 500).select("o_orderkey", "row_ordinal"),
    "snk_parquet": _export,
    "inc_two_phase": _stored_graph,
    "inc_load_raw": _load_raw,
    "inc_checkpoint": _ingest,
    "inc_progress": _progress,
    "src_factory": _factory,
    "snk_clear": _clear,
    "inc_metrics": _run_report,
}
