"""The end-to-end programs: scan, transform, write, report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lacuna.operators.clean import clean_records, clean_with_counts, for_all
from lacuna.operators.filters import lines_with_phone
from lacuna.operators.profile import (
    VALUE_FIELDS,
    by_field,
    by_file,
    by_value,
    facts_of,
    overall,
    profile_facts,
)
from lacuna.plans.layouts import project
from lacuna.scratch import new_folder
from lacuna.sinks.files import (
    check_outputs,
    exists,
    has_parts,
    parquet_name,
    place,
    read_outputs,
    remove,
    staging,
    write_clean_and_counts,
    write_clean_lines,
    write_lines,
    write_parquet_parts,
    write_rejects,
    write_value_distributions,
)
from lacuna.sources.inputs import Inputs, key_of, listing, qualified, relative
from lacuna.sources.ndjson import judge_lines, list_inputs, parse_objects, scan_lines

Paths = str | Sequence[str]
CLEAN_COUNTS = ("rows_processed", "fields_removed")


def clean_job(
    spark: SparkSession, paths: Paths, folder: str, root: str | None = None, rejects: bool = False
) -> DataFrame:
    """Clean files to gzip NDJSON; report (file_name, rows_processed, fields_removed).

    The cleaned lines of ``part-0.gz`` are ``folder/part-0.gz`` (see ``lacuna.sinks.files``),
    those of ``day=1/part-0.gz`` are in a folder of that name.  Only the outputs of these
    inputs are replaced; the report has a row for every input.  One pass: the counters are
    written with the lines, a line per file and batch, and added up for the report.
    With ``rejects`` lines that are not blank and not read are kept in the same pass, after
    their reason, in ``folder/_rejects/part-0.gz``, and the report counts them (``rejected``).

    Keys start at ``root``, by default the deepest folder that holds all inputs.  Give it
    where later runs add inputs from other folders to the same outputs.
    """
    found = listing(spark, Inputs(paths, root), names=True)
    check_outputs(found.names, ".gz")
    run = staging(folder)
    write_clean_and_counts(clean_with_counts(scan_lines(spark, found), rejects), run)
    counters = [*CLEAN_COUNTS, "rejected"] if rejects else CLEAN_COUNTS
    inputs = _inputs(spark, found.names)
    counted = f"{run}/kind=counts"
    if exists(spark, counted):
        counts = F.split("value", " ")
        sums = [F.sum(F.get(counts, i).cast("long")).alias(c) for i, c in enumerate(counters)]
        report = for_all(inputs, spark.read.text(counted).groupBy("file_name").agg(*sums))
    else:
        report = inputs.select("file_name", *[F.lit(0).cast("long").alias(c) for c in counters])
    report = _written(report, "clean-report")
    place(spark, f"{run}/kind=lines", folder, found.names, ".gz")
    if rejects:
        place(spark, f"{run}/kind=rejects", f"{folder}/_rejects", found.names, ".gz")
    remove(spark, run)
    return report


def _inputs(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(name,) for name in names], "file_name string")


def _written(report: DataFrame, purpose: str) -> DataFrame:
    """A report, a row per input, as a table of its own."""
    path = new_folder(report.sparkSession, purpose)
    report.write.parquet(path)
    return report.sparkSession.read.parquet(path)


def clean_with_totals(spark: SparkSession, paths: Paths, folder: str, root: str | None = None) -> dict[str, int]:
    """Clean in a single pass; only the totals over all files are reported."""
    totals = Observation()
    found = listing(spark, Inputs(paths, root), names=True)
    check_outputs(found.names, ".gz")
    cleaned = clean_records(scan_lines(spark, found)).observe(
        totals,
        F.count(F.lit(1)).alias("rows_processed"),
        F.sum("removed").alias("fields_removed"),
    )
    run = staging(folder)
    write_clean_lines(cleaned, run)
    place(spark, run, folder, found.names, ".gz")
    remove(spark, run)
    return {key: value or 0 for key, value in totals.get.items()}


def convert_job(
    spark: SparkSession,
    paths: Paths,
    folder: str,
    layout: str = "wide",
    strict_dates: bool = True,
    root: str | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Convert files to ZSTD Parquet; report (file_name, rows) with a row for every input.

    The rows of ``part-0.gz`` are ``folder/part-0.parquet``.  Only the outputs of these
    inputs are replaced, and only they are reported.  ``root`` and ``rejects`` are those of
    ``clean_job``; rejected lines are looked for in a second read, since a projection parses
    the fields of its layout only.
    """
    found = listing(spark, Inputs(paths, root), names=True)
    check_outputs(found.names, ".parquet")
    lines = scan_lines(spark, found)
    table = project(lines, layout, keep=["file_name"], strict_dates=strict_dates)
    run = staging(folder)
    write_parquet_parts(table, run, zstd_level=3 if layout == "narrow_strings" else None)
    report = convert_report(spark, run, found.names)
    refused = staging(folder)
    if rejects:
        write_rejects(judge_lines(lines, "convert"), refused)
        counted = _refused(spark, refused, found.names).withColumn("file_name", parquet_name(F.col("file_name")))
        report = report.join(counted, "file_name")
    report = _written(report, "convert-report")
    place(spark, run, folder, found.names, ".parquet")
    if rejects:
        place(spark, refused, f"{folder}/_rejects", found.names, ".gz")
        remove(spark, refused)
    remove(spark, run)
    return report


def _refused(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """``file_name, rejected`` from the rejected lines a run has written."""
    inputs = _inputs(spark, names)
    if not has_parts(spark, folder):
        return inputs.select("file_name", F.lit(0).cast("long").alias("rejected"))
    return for_all(inputs, spark.read.text(folder).groupBy("file_name").agg(F.count("*").alias("rejected")))


def convert_report(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Rows per converted file, which Parquet footers answer, with a row for each input named.

    ``folder`` is what a run has written but not placed, by input name.
    """
    inputs = _inputs(spark, names)
    named = parquet_name(F.col("file_name")).alias("file_name")
    if not has_parts(spark, folder):
        return inputs.select(named, F.lit(0).cast("long").alias("rows"))
    found = spark.read.parquet(folder).groupBy("file_name").agg(F.count("*").alias("rows"))
    return for_all(inputs, found).select(named, "rows")


def converted_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per output in a folder of placed Parquet files, whichever runs wrote them."""
    return read_outputs(spark, folder).groupBy("file_name").agg(F.count("*").alias("rows"))


def profile_job(
    spark: SparkSession,
    paths: Paths,
    folder: str,
    value_fields: Sequence[str] = VALUE_FIELDS,
    root: str | None = None,
) -> dict[str, DataFrame]:
    """Profile files in one pass over the lines; write the facts and the distributions.

    Returns the reports by_file, overall, by_field and by_value, all small
    aggregates of the written facts.  Inputs without a record count as files, too, and
    inputs of one name in several folders are several.
    """
    found = listing(spark, Inputs(paths, root))
    records = parse_objects(scan_lines(spark, found))
    facts = profile_facts(records, value_fields).unionByName(facts_of(list_inputs(spark, found)))
    facts.write.mode("overwrite").parquet(f"{folder}/facts")
    reports = profile_reports(spark.read.parquet(f"{folder}/facts"))
    write_value_distributions(reports["by_value"], f"{folder}/value_distributions")
    return reports


def profile_reports(facts: DataFrame) -> dict[str, DataFrame]:
    """All reports over a table of profile facts."""
    return {
        "by_file": by_file(facts),
        "overall": overall(facts),
        "by_field": by_field(facts),
        "by_value": by_value(facts),
    }


def phone_job(spark: SparkSession, paths: Paths, folder: str) -> None:
    """Write the lines of records with a usable phone, unchanged."""
    write_lines(lines_with_phone(scan_lines(spark, paths)), folder)


def run_by_file(
    spark: SparkSession,
    paths: Sequence[str],
    job: Callable[[list[str]], object],
    group_size: int = 100,
    root: str | None = None,
) -> DataFrame:
    """Run a job over many files, keeping the good ones when some cannot be read.

    Returns (file_name, success, error) for every file, by its path below ``root`` (the
    folder all paths have in common).  The job gets its paths with that root, so a file has
    the same key in whichever group it runs.  Files are taken ``group_size`` at a
    time.  A Spark job fails as a whole, but its error names the file it could not read:
    the group goes on without it.  Only where no file of the group is named is it split in
    halves.  So a bad file costs one more attempt at its own group, whatever their number.
    The job must replace what an earlier attempt wrote, which the jobs of this package do.
    If every file fails and none of the errors names one, the fault is the job's: it is raised.
    """
    outcome: list[tuple[str, bool, str | None]] = []
    paths = relative(spark, paths, root)
    groups = [paths[i : i + group_size] for i in range(0, len(paths), group_size)][::-1]

    def named_by(path: str) -> str:
        if paths.root is None:
            return path.rstrip("/").rsplit("/", 1)[-1]
        return key_of(qualified(spark, path), qualified(spark, paths.root))

    unnamed: Exception | None = None
    while groups:
        group = groups.pop()
        try:
            job(Inputs(group, paths.root))
            outcome += [(named_by(path), True, None) for path in group]
        except Exception as error:  # whatever the read or write of this group raised
            named = _named(str(error), group)
            bad = named[0] if len(named) == 1 else group[0] if len(group) == 1 else None
            unnamed = unnamed if named else error
            if bad is None:
                middle = len(group) // 2
                groups += [group[middle:], group[:middle]]
                continue
            outcome.append((named_by(bad), False, str(error).strip().split("\n", 1)[0]))
            if rest := [path for path in group if path != bad]:
                groups.append(rest)
            if not named and len(outcome) >= FAULTY and not any(ok for _, ok, _ in outcome):
                raise
    if unnamed and not any(ok for _, ok, _ in outcome):
        raise unnamed
    return spark.createDataFrame(outcome, "file_name string, success boolean, error string")


# So many files one by one without a success or a file named: the job itself is at fault.
FAULTY = 20


def _named(message: str, paths: Sequence[str]) -> list[str]:
    """The paths a message names, as they are or escaped; one that only begins another is not meant."""
    text = f"{message}\n{unquote(message)}"
    found = [path for path in paths if path.rstrip("/") in text]
    return [x for x in found if not any(x != y and y.startswith(x.rstrip("/")) for y in found)]
