"""One query per operator, over lines derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import (
    ITEM_SHAPE,
    deep_lines,
    full_lines,
    gz_folder,
    item_lines,
    people_lines,
    placed_folder,
    same_name_lines,
    table,
)
from lacuna.functions.values import int32_or_null, json_text, lenient_date, text_or_null
from lacuna.operators.clean import clean_records, clean_report, drop_empty
from lacuna.operators.clean_known import clean_known
from lacuna.operators.filters import (
    extract_emails,
    lines_with_email_domain,
    lines_with_phone,
    lines_with_skill,
    phone_match_rate,
)
from lacuna.operators.profile import (
    VALUE_FIELDS,
    by_file,
    distribution_document,
    facts_of,
    overall,
    profile_facts,
    profile_fields,
    status_counts,
    value_counts,
)
from lacuna.operators.reports import outcome, with_total
from lacuna.plans.jobs import (
    clean_job,
    convert_job,
    converted_rows,
    profile_job,
    profile_reports,
    run_by_file,
)
from lacuna.plans.layouts import project
from lacuna.scratch import new_folder
from lacuna.sinks.files import read_outputs, write_clean_lines, write_lines, write_parquet
from lacuna.sources.ndjson import (
    judge_lines,
    nonblank,
    parse_fields,
    parse_objects,
    parse_values,
    reject_report,
    rejected,
    scan_lines,
    stream_lines,
)
from lacuna.streaming.incremental import ingest, ingest_profile, read_profile, stream_files

Query = Callable[[SparkSession, str], DataFrame]


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects among the customer lines: line_no, file_name, record."""
    return parse_objects(people_lines(spark, sf_dir))


def _full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_objects(full_lines(spark, sf_dir))


def _get(getter: Callable[[str], str], *fields: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        values = [f"{getter('record.' + f)} AS {f}" for f in fields]
        records = parse_fields(people_lines(spark, sf_dir), fields)
        return records.selectExpr("line_no", *values)

    return query


# --- scans


def q_scan_lines(spark, sf_dir):
    return scan_lines(spark, gz_folder(people_lines(spark, sf_dir)))


def q_file_rowcount(spark, sf_dir):
    lines = scan_lines(spark, gz_folder(people_lines(spark, sf_dir)))
    return lines.groupBy("file_name").agg(F.count("*").alias("lines"))


def q_nonblank_lines(spark, sf_dir):
    return nonblank(people_lines(spark, sf_dir)).select("line_no", "value")


def q_parse_valid(spark, sf_dir):
    return parse_values(people_lines(spark, sf_dir)).select("line_no", "file_name")


def q_parse_objects(spark, sf_dir):
    fields = "cast(size(record) AS bigint) AS fields"
    return _people(spark, sf_dir).selectExpr("line_no", fields)


# --- projections and getters


def q_project_wide(spark, sf_dir):
    return project(people_lines(spark, sf_dir), "wide", keep=["line_no"])


def q_project_wide_full(spark, sf_dir):
    return project(full_lines(spark, sf_dir), "wide", keep=["line_no"])


def q_project_narrow(spark, sf_dir):
    return project(people_lines(spark, sf_dir), "narrow", keep=["line_no"])


def q_project_narrow_str(spark, sf_dir):
    return project(people_lines(spark, sf_dir), "narrow_strings", keep=["line_no"])


def q_project_documents(spark, sf_dir):
    """Documents written as JSON lines and projected back: whole texts survive."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.to_json(F.struct("*")).alias("value"))
    return project(lines, ["text", "lang", "source", "n_chars:i"], keep=["doc_id"])


# --- cleaning


def q_clean_records(spark, sf_dir):
    return clean_records(people_lines(spark, sf_dir)).select("line_no", "cleaned")


def q_clean_records_full(spark, sf_dir):
    return clean_records(full_lines(spark, sf_dir)).select("line_no", "cleaned")


def q_count_removed(spark, sf_dir):
    return clean_records(people_lines(spark, sf_dir)).select("line_no", "removed")


def q_count_removed_full(spark, sf_dir):
    return clean_records(full_lines(spark, sf_dir)).select("line_no", "removed")


# The members of the customer lines; not all lines are of this shape.
PEOPLE_SHAPE = """id string, full_name string, gender string, birth_year bigint, job_title string,
 location_country string, mobile_phone string, phone_numbers array<string>,
 emails array<struct<address: string, type: string>>, skills array<string>, job_last_updated string,
 experience array<struct<company: struct<name: string, size: string>, title: string>>,
 version_status struct<contains: array<string>, previous_version: string, status: string>,
 `version_status.status` string, status string"""


def q_clean_known(spark, sf_dir):
    """Cleaned by the expression made from a schema; other lines are found out."""
    return clean_known(people_lines(spark, sf_dir), PEOPLE_SHAPE).select("line_no", "cleaned")


def q_count_removed_known(spark, sf_dir):
    return clean_known(people_lines(spark, sf_dir), PEOPLE_SHAPE).select("line_no", "removed")


def q_clean_known_items(spark, sf_dir):
    """Lines all of which have the shape: orders with their items, some members empty."""
    lines = item_lines(spark, sf_dir)
    return clean_known(lines, ITEM_SHAPE).select("line_no", "cleaned", "removed")


def q_drop_empty_records(spark, sf_dir):
    return drop_empty(clean_records(people_lines(spark, sf_dir))).select("line_no")


def q_clean_report(spark, sf_dir):
    lines = people_lines(spark, sf_dir)
    return clean_report(clean_records(lines), lines.select("file_name"))


def q_clean_job(spark, sf_dir):
    """Whole cleaning program over gzip files; its report per file."""
    source = gz_folder(full_lines(spark, sf_dir))
    return clean_job(spark, source, new_folder(spark, "cleaned"))


def q_clean_job_people(spark, sf_dir):
    """The same where some files hold no record."""
    source = gz_folder(people_lines(spark, sf_dir))
    return clean_job(spark, source, new_folder(spark, "cleaned"))


def q_clean_gz_roundtrip(spark, sf_dir):
    folder = new_folder(spark, "cleaned")
    write_clean_lines(clean_records(people_lines(spark, sf_dir)), folder)
    return scan_lines(spark, folder)


def q_clean_pages(spark, sf_dir):
    """Pages as JSON lines, cleaned and read back: whole texts survive."""
    lines = table(spark, sf_dir, "pages").select("page_id", F.to_json(F.struct("*")).alias("value"))
    cleaned = drop_empty(clean_records(lines)).withColumnRenamed("cleaned", "value")
    return project(cleaned, ["url", "html"], keep=["page_id"])


# --- filters


def q_filter_has_phone(spark, sf_dir):
    return lines_with_phone(people_lines(spark, sf_dir)).select("line_no", "value")


def q_filter_has_phone_roundtrip(spark, sf_dir):
    folder = new_folder(spark, "phones")
    write_lines(lines_with_phone(people_lines(spark, sf_dir)), folder)
    return scan_lines(spark, folder).select("value")


def q_filter_email_domain(spark, sf_dir):
    return lines_with_email_domain(people_lines(spark, sf_dir)).select("line_no", "value")


def q_filter_skills(spark, sf_dir):
    return lines_with_skill(people_lines(spark, sf_dir), "rust").select("line_no", "value")


def q_extract_emails(spark, sf_dir):
    return extract_emails(people_lines(spark, sf_dir)).select("line_no", "address")


def q_phone_match_rate(spark, sf_dir):
    return phone_match_rate(people_lines(spark, sf_dir))


# --- profiles


def q_profile_fields(spark, sf_dir):
    return profile_fields(_people(spark, sf_dir))


def q_profile_fields_full(spark, sf_dir):
    return profile_fields(_full(spark, sf_dir))


def q_profile_fields_events(spark, sf_dir):
    return profile_fields(parse_objects(_event_lines(spark, sf_dir)))


def q_value_counts_events(spark, sf_dir):
    """The values of the one member of an event's properties, a number."""
    return status_counts(_event_lines(spark, sf_dir), "k")


def _event_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_type").alias("file_name"), F.col("props").alias("value"))


def _people_facts(spark, sf_dir):
    """Facts of all files, also those without an object."""
    names = facts_of(people_lines(spark, sf_dir))
    return profile_facts(_people(spark, sf_dir)).unionByName(names)


def q_profile_by_file(spark, sf_dir):
    return by_file(_people_facts(spark, sf_dir))


def q_profile_by_file_full(spark, sf_dir):
    return by_file(profile_facts(_full(spark, sf_dir)))


def q_profile_overall(spark, sf_dir):
    return overall(_people_facts(spark, sf_dir))


def q_value_counts(spark, sf_dir):
    return value_counts(people_lines(spark, sf_dir))


def q_value_counts_full(spark, sf_dir):
    return value_counts(full_lines(spark, sf_dir))


def q_value_counts_nested(spark, sf_dir):
    return value_counts(people_lines(spark, sf_dir), ["version_status.status"], paths=True)


def q_value_distribution_json(spark, sf_dir):
    folder = new_folder(spark, "counts")
    value_counts(people_lines(spark, sf_dir)).write.parquet(folder)
    return distribution_document(spark.read.parquet(folder))


def q_profile_facts_by_value(spark, sf_dir):
    """Value counts out of the one-pass profile."""
    return profile_reports(profile_facts(_people(spark, sf_dir), VALUE_FIELDS))["by_value"]


def q_status_counts(spark, sf_dir):
    return status_counts(people_lines(spark, sf_dir))


# --- conversion and reports


def q_convert_report(spark, sf_dir):
    source = gz_folder(people_lines(spark, sf_dir))
    return convert_job(spark, source, new_folder(spark, "wide"))


def q_wide_parquet_roundtrip(spark, sf_dir):
    folder = new_folder(spark, "wide")
    write_parquet(project(people_lines(spark, sf_dir), "wide", keep=["file_name"]), folder)
    return spark.read.parquet(folder)


def q_narrow_parquet_roundtrip(spark, sf_dir):
    folder = new_folder(spark, "narrow")
    write_parquet(project(people_lines(spark, sf_dir), "narrow"), folder)
    return spark.read.parquet(folder)


def q_narrow_str_parquet_roundtrip(spark, sf_dir):
    folder = new_folder(spark, "narrow")
    write_parquet(project(people_lines(spark, sf_dir), "narrow_strings"), folder, zstd_level=3)
    return spark.read.parquet(folder)


def q_file_status(spark, sf_dir):
    """Conversion of four readable files and one that is missing."""
    source = gz_folder(people_lines(spark, sf_dir))
    names = people_lines(spark, sf_dir).select("file_name").distinct().orderBy("file_name")
    paths = [f"{source}/file_name={row.file_name}" for row in names.toLocalIterator()]
    target = new_folder(spark, "wide")
    status = run_by_file(
        spark,
        [*paths, f"{source}/file_name=missing"],
        lambda group: convert_job(spark, group, target),
    )
    return status.select(F.replace("file_name", F.lit("file_name=")).alias("file_name"), "success")


# --- inputs of one name in several folders


def q_same_name_scan(spark, sf_dir):
    return scan_lines(spark, f"{placed_folder(same_name_lines(spark, sf_dir))}/*/*.gz*")


def q_same_name_profile(spark, sf_dir):
    source = placed_folder(same_name_lines(spark, sf_dir))
    return profile_job(spark, f"{source}/*/*.gz*", new_folder(spark, "profile"))["by_file"]


def q_same_name_overall(spark, sf_dir):
    source = placed_folder(same_name_lines(spark, sf_dir))
    return profile_job(spark, f"{source}/*/*.gz*", new_folder(spark, "profile"))["overall"]


def q_same_name_clean(spark, sf_dir):
    """Cleaned, placed under the inputs' own paths, and read back."""
    source, target = placed_folder(same_name_lines(spark, sf_dir)), new_folder(spark, "cleaned")
    clean_job(spark, f"{source}/*/*.gz*", target)
    return scan_lines(spark, f"{target}/*/*.gz*")


def q_same_name_convert(spark, sf_dir):
    """Converted twice, in groups that each see a part of the folders; rows per output."""
    source, target = placed_folder(same_name_lines(spark, sf_dir)), new_folder(spark, "wide")
    paths = [f"{source}/day={i}/*.gz*" for i in range(3)]
    for size in (1, 2):
        run_by_file(spark, paths, lambda group: convert_job(spark, group, target), group_size=size)
    return converted_rows(spark, target)


# --- totals and rejected lines


def q_clean_report_totals(spark, sf_dir):
    """Counters per file and their sums."""
    lines = people_lines(spark, sf_dir)
    return with_total(clean_report(clean_records(lines), lines.select("file_name")))


def q_convert_report_totals(spark, sf_dir):
    source = placed_folder(people_lines(spark, sf_dir))
    return with_total(convert_job(spark, source, new_folder(spark, "wide")))


def q_file_status_totals(spark, sf_dir):
    """How many files were converted, and how many could not be read."""
    source = placed_folder(people_lines(spark, sf_dir))
    names = people_lines(spark, sf_dir).select("file_name").distinct()
    paths = [f"{source}/{row.file_name}.gz*" for row in names.toLocalIterator()]
    target = new_folder(spark, "wide")
    return outcome(run_by_file(spark, [*paths, f"{source}/none.gz"], lambda group: convert_job(spark, group, target)))


def q_rejected_lines(spark, sf_dir):
    return rejected(judge_lines(deep_lines(spark, sf_dir))).select("line_no", "reason")


def q_rejected_values(spark, sf_dir):
    return rejected(judge_lines(deep_lines(spark, sf_dir), "clean")).select("line_no", "reason")


def q_reject_report(spark, sf_dir):
    return reject_report(judge_lines(deep_lines(spark, sf_dir)))


def q_clean_job_rejects(spark, sf_dir):
    """Records read and lines rejected, per file: together all lines that are not blank."""
    source = placed_folder(deep_lines(spark, sf_dir))
    report = clean_job(spark, f"{source}/*.gz*", new_folder(spark, "cleaned"), rejects=True)
    return report.select(F.replace("file_name", F.lit(".gz")).alias("file_name"), "rows_processed", "rejected")


def q_convert_job_rejects(spark, sf_dir):
    """The rejected lines that a conversion keeps, read back."""
    source, target = placed_folder(deep_lines(spark, sf_dir)), new_folder(spark, "wide")
    convert_job(spark, f"{source}/*.gz*", target, rejects=True)
    kept = scan_lines(spark, f"{target}/_rejects/*.gz*")
    reason = F.substring_index("value", " ", 1).alias("reason")
    return kept.select(F.replace("file_name", F.lit(".gz")).alias("file_name"), reason).groupBy("file_name", "reason").count()


# --- new files as they arrive


def q_incremental_ingest(spark, sf_dir):
    source = gz_folder(people_lines(spark, sf_dir))
    target, checkpoint = new_folder(spark, "ingested"), new_folder(spark, "checkpoint")
    lines = stream_lines(spark, source, files_per_batch=3)
    ingest(
        lines, lambda batch: project(batch, "narrow_strings"), target, checkpoint
    ).awaitTermination()
    return spark.read.parquet(target)


def q_incremental_files(spark, sf_dir):
    """Inputs of one name in three folders, one batch each, large ones dealt out."""
    source = placed_folder(same_name_lines(spark, sf_dir))
    target, checkpoint = new_folder(spark, "ingested"), new_folder(spark, "checkpoint")
    files = stream_files(spark, f"{source}/*", files_per_batch=3)
    ingest(files, lambda batch: project(batch, "narrow_strings", keep=["file_name"]), target, checkpoint).awaitTermination()
    return read_outputs(spark, target)


def q_incremental_compacted(spark, sf_dir):
    """The field profile of batches of one file, merged whenever two lie beside one another."""
    source = gz_folder(people_lines(spark, sf_dir))
    target, checkpoint = new_folder(spark, "facts"), new_folder(spark, "checkpoint")
    files = stream_files(spark, source, files_per_batch=2)
    ingest_profile(files, target, checkpoint, compact_every=2).awaitTermination()
    return profile_reports(read_profile(spark, target))["by_field"]


def q_incremental_profile(spark, sf_dir):
    source = gz_folder(people_lines(spark, sf_dir))
    target, checkpoint = new_folder(spark, "facts"), new_folder(spark, "checkpoint")
    ingest_profile(stream_lines(spark, source, files_per_batch=3), target, checkpoint).awaitTermination()
    return profile_reports(read_profile(spark, target))["by_field"]


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): query for name, query in globals().items() if name.startswith("q_")
} | {
    "cast_date": _get(
        lambda value: lenient_date(text_or_null(value)), "job_last_updated", "gender"
    ),
    "get_string": _get(text_or_null, "gender", "birth_year", "mobile_phone", "phone_numbers", "status"),
    "get_int32": _get(int32_or_null, "birth_year", "mobile_phone", "status"),
    "get_json_text": _get(
        json_text, "gender", "phone_numbers", "emails", "skills", "experience", "version_status"
    ),
}
