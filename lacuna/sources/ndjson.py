"""Reading newline-delimited JSON, compressed or plain, as one row per line."""

from __future__ import annotations

import math
import re
import secrets
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions.values import name
from lacuna.session import TASKS_PER_CORE, require
from lacuna.sources.inputs import Forms, Listing, files, key_column, listing, qualified

# A gzip file up to this size is a second or two of work; not worth a shuffle.
SMALL_FILE = 4 << 20

# Containers may be nested so deep; lines with deeper ones are not read, by any operator.
# (The JSON reader and the cleaner both recurse, so some bound must stand.)
MAX_DEPTH = 2000

# Text whose \\u escapes are all characters: a surrogate only as half of a pair.
WELL_FORMED_ESCAPES = (
    r"(?s)^(?:[^\\]++|\\[^u]|\\u(?![dD][89a-fA-F])[0-9a-fA-F]{4}"
    r"|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2})*+$"
)


def scan_lines(
    spark: SparkSession,
    paths: str | Iterable[str] | Listing,
    spread: bool = True,
    tolerate_corrupt: bool = False,
    cores: int | None = None,
    small_file: int | None = None,
) -> DataFrame:
    """One row per line: ``file_name STRING, value STRING``.

    Only a line feed ends a line (one carriage return before it is dropped).
    gzip is chosen by the file extension; all members of a file are read.
    ``file_name`` is the key of the input (``lacuna.sources.inputs``): its name, or the path
    below the root of ``paths`` where inputs lie in several folders.

    A gzip file is one task.  Files that would keep their task busy long after the
    others are done have their lines dealt out to more tasks before the expensive
    parsing (unless ``spread=False``); all other files are read without a shuffle.
    That is, files over ``small_file`` bytes (4 MB) and twice the share of one of ``cores``.
    Give ``cores`` where executors come and go: the default is what there is now.
    Rows are the same either way.
    """
    found = paths if isinstance(paths, Listing) else listing(spark, paths)
    reader = spark.read.option("lineSep", "\n")
    if tolerate_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    raw = reader.text(found.inputs)
    share = max(1, found.total // (cores or spark.sparkContext.defaultParallelism))
    least = SMALL_FILE if small_file is None else small_file
    if not spread or found.largest <= 2 * share or found.largest < least:
        return _name_and_text(raw, found.root, found.forms)
    # Filters on the file size choose files, not rows.
    is_large = F.col("_metadata.file_name").endswith(".gz") & (
        F.col("_metadata.file_size") > 2 * share
    )
    pieces = TASKS_PER_CORE * math.ceil(found.largest / share)
    large = spread_lines(_name_and_text(raw.where(is_large), found.root, found.forms), pieces)
    return _name_and_text(raw.where(~is_large), found.root, found.forms).unionAll(large)


def stream_lines(
    spark: SparkSession, folder: str, files_per_batch: int = 1000, pieces: int = 0
) -> DataFrame:
    """The same rows from a folder that keeps receiving files, each read once.

    Keys start at the folder, or at the part of it before a pattern, so they are the same
    in every batch.  Where single files may hold most of a batch, ``pieces`` deals the lines
    of every batch out to so many tasks before they are parsed.
    """
    reader = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_batch)
    fixed = re.split(r"/[^/]*[*?\[{]", folder, maxsplit=1)[0]
    lines = _name_and_text(reader.text(folder), qualified(spark, fixed))
    return lines.repartition(pieces) if pieces else lines


def list_inputs(spark: SparkSession, paths: str | Iterable[str] | Listing) -> DataFrame:
    """The files to read, as ``file_name, path, length``: empty ones too.

    Only the listing is read.  Its tasks are bounded, whatever the number and size of
    the files.
    """
    found = paths if isinstance(paths, Listing) else listing(spark, paths)
    name = key_column(F.col("path"), found.root, encoded=False)
    rows = files(spark, found.inputs).select(name.alias("file_name"), "path", "length")
    return rows.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def input_names(spark: SparkSession, paths: str | Iterable[str]) -> list[str]:
    """The keys under which results are kept, one for each input."""
    return listing(spark, paths, names=True).names


def spread_lines(lines: DataFrame, pieces: int | None = None) -> DataFrame:
    """Deal the lines of each file out evenly into pieces, however often lines repeat.

    A row's position in its input partition decides: it is the same when a lost
    task is run again, and equal lines do not end up together.  A piece holds
    lines of one file, so output written per file has few parts.  The pieces of a
    file go to tasks of their own: dealt by hash, several would meet in one task.
    """
    pieces = pieces or TASKS_PER_CORE * lines.sparkSession.sparkContext.defaultParallelism
    files = [c for c in lines.columns if c == "file_name"]
    first = F.pmod(F.xxhash64(*files), F.lit(2 * pieces)) if files else F.lit(0)
    return (
        lines.withColumn("_piece", (first + F.monotonically_increasing_id() % pieces).cast("int"))
        .repartitionById(2 * pieces, "_piece")
        .drop("_piece")
    )


def _name_and_text(raw: DataFrame, root: str, forms: Forms | None = None) -> DataFrame:
    name = key_column(F.col("_metadata.file_path"), root, forms=forms)
    text = F.col("value")
    without_cr = F.when(text.endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(text)
    return raw.select(name.alias("file_name"), without_cr.alias("value"))


def readable(text: Column) -> Column:
    """Valid UTF-8, and no escape that stands for half a character."""
    return F.is_valid_utf8(text) & (~text.contains("\\u") | text.rlike(WELL_FORMED_ESCAPES))


def nonblank(lines: DataFrame) -> DataFrame:
    """Lines with something other than white space on them."""
    return lines.where(F.col("value").rlike(r"\S"))


def mentioning(lines: DataFrame, *texts: str) -> DataFrame:
    """Lines that can hold one of these texts inside a JSON string.

    A cheap test ahead of parsing, with no false drops: a JSON string spells its
    characters out unless it uses a backslash, so lines with one are kept too.
    """
    test = F.col("value").contains("\\")
    for text in texts:
        test = test | F.col("value").contains(text)
    return lines.where(test)


#: Why a line is not read.
REASONS = ("bad_utf8", "bad_json", "too_deep", "not_object")

# What each program keeps of the lines that are not blank.
POLICIES = {
    "clean": "values",
    "convert": "objects",
    "profile": "objects",
    "filter": "objects",
    "status": "objects",
}


def judge_lines(lines: DataFrame, policy: str = "objects") -> DataFrame:
    """The lines that are not blank, with ``reason``: NULL for those that are read.

    ``policy`` is what is read: ``values`` any JSON value, ``objects`` only objects, ``all``
    as ``objects`` but the job ends at the first line that is not one; or the name of a
    program (``POLICIES``).  A line is rejected as ``bad_utf8``, ``bad_json`` (half of a
    surrogate pair included), ``too_deep`` (containers nested beyond ``MAX_DEPTH``, whatever
    else is wrong) or ``not_object``.  All other columns stay.
    """
    require(lines.sparkSession)
    kept = POLICIES.get(policy, policy)
    if kept not in ("values", "objects", "all"):
        raise ValueError(f"unknown policy: {policy}")
    text = F.col("value")
    wrapped = F.when(readable(text), F.concat(F.lit("["), text, F.lit(f",{NUMBER}]")))
    others = [name(c) for c in lines.columns]
    parsed = nonblank(lines).select(*others, F.from_json(wrapped, "array<variant>", PLAIN_JSON).alias("_parsed"))
    complete = f"coalesce(size(_parsed) = 2 AND try_cast(get(_parsed, 1) AS bigint) = {NUMBER}, false)"
    other = F.lit(kept != "values") & ~F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    reason = (
        F.when(~F.is_valid_utf8(text), "bad_utf8")
        .when(F.expr(complete), F.when(other, "not_object"))
        .when(_too_deep(text), "too_deep")
        .otherwise("bad_json")
    )
    judged = parsed.select(*others, F.explode(F.array(reason)).alias("reason"))
    if kept == "all":
        refused = F.raise_error(F.concat(F.lit("line rejected as "), F.col("reason"))).cast("string")
        judged = judged.withColumn("reason", F.when(F.col("reason").isNotNull(), refused))
    return judged


def _too_deep(text: Column) -> Column:
    """Brackets outside strings are nested beyond ``MAX_DEPTH``.  Few lines have that many."""
    brackets = F.regexp_replace(F.regexp_replace(text, r'"(?:[^"\\]++|\\.)*+"?', ""), r"[^\[\]{}]++", "")
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("most"))

    def step(state: Column, bracket: Column) -> Column:
        at = state.at + F.when(bracket.isin("[", "{"), 1).otherwise(-1)
        return F.struct(at.alias("at"), F.greatest(state.most, at).alias("most"))

    depth = F.aggregate(F.split(brackets, "(?!^)"), zero, step, lambda state: state.most)
    opened = F.length(text) - F.length(F.translate(text, "[{", ""))
    return F.when(opened > MAX_DEPTH, depth > MAX_DEPTH).otherwise(False)


def rejected(judged: DataFrame) -> DataFrame:
    """The lines that were not read, with their ``reason``."""
    return judged.where(F.col("reason").isNotNull())


def reject_report(judged: DataFrame) -> DataFrame:
    """Per file: lines that are not blank, those read, and those rejected, by reason."""
    reasons = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    kept = F.count_if(F.col("reason").isNull()).alias("kept")
    return judged.groupBy("file_name").agg(F.count("*").alias("lines"), kept, F.count("reason").alias("rejected"), *reasons)


def parse_values(lines: DataFrame, reader: str = "strict") -> DataFrame:
    """Replace ``value`` by ``record VARIANT``, whatever JSON it is; other columns stay.

    Lines that are not one complete JSON value are dropped.  With the ``strict``
    reader invalid UTF-8 and half surrogate pairs void a line, the ``replacing``
    one reads them as replacement characters.  A number beyond the range of a double
    is infinity, here and in every other operator.

    The line is parsed as ``[line, number]`` with a random number: only if the line
    is one complete JSON value does the second element come out as that number, so
    text after the value cannot pass unseen.
    """
    lines, text = _readable_text(lines, "objects", reader)
    wrapped = F.concat(F.lit("["), text, F.lit(f",{NUMBER}]"))
    complete = f"size(_parsed) = 2 AND try_cast(get(_parsed, 1) AS bigint) = {NUMBER}"
    record = f"CASE WHEN {complete} THEN get(_parsed, 0) END"
    parsed = F.from_json(wrapped, "array<variant>", PLAIN_JSON)
    return _pin(lines, parsed, record).where("record IS NOT NULL")


def parse_objects(lines: DataFrame, keep: str = "objects", reader: str = "strict") -> DataFrame:
    """Replace ``value`` by ``record MAP<STRING, VARIANT>``, all members of the object.

    ``keep="objects"`` drops the lines that are not a JSON object, ``keep="all"``
    leaves them with a NULL record.  A repeated key keeps its last value.
    """
    lines, text = _readable_text(lines, keep, reader)
    members = "get(_parsed, 0)"
    repeated = f"size(array_distinct(map_keys({members}))) < size({members})"
    complete = f"try_cast(try_element_at(get(_parsed, 1), '{MARK}') AS bigint) = {NUMBER}"
    record = (
        f"CASE WHEN size(_parsed) = 2 AND {complete} THEN "
        f"CASE WHEN {repeated} THEN map_from_entries(map_entries({members})) ELSE {members} END END"
    )
    parsed = F.from_json(marked(text), "array<map<string, variant>>", PLAIN_JSON)
    records = _pin(lines, parsed, record)
    return records.where("record IS NOT NULL") if keep == "objects" else records


def parse_fields(
    lines: DataFrame, fields: Sequence[str], keep: str = "objects", reader: str = "strict"
) -> DataFrame:
    """Replace ``value`` by ``record STRUCT<field: VARIANT, ...>`` with these members.

    As ``parse_objects``, but members that are not asked for are skipped while
    parsing.  A missing member is NULL, an explicit null is a VARIANT null.
    """
    lines, text = _readable_text(lines, keep, reader)
    members = "".join(f"{name(field)}: variant, " for field in dict.fromkeys(fields))
    schema = f"array<struct<{members}{MARK}: bigint>>"
    record = f"CASE WHEN size(_parsed) = 2 AND get(_parsed, 1).{MARK} = {NUMBER} THEN get(_parsed, 0) END"
    records = _pin(lines, F.from_json(marked(text), schema, PLAIN_JSON), record)
    return records.where("record IS NOT NULL") if keep == "objects" else records


# The member that closes a line and its value, drawn anew by every process: no line
# can foresee it.
MARK = "__line_end__"
NUMBER = secrets.randbits(62)

# JSON as the standard has it, however long a string or number is.
PLAIN_JSON = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "maxStringLen": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "maxNestingDepth": str(MAX_DEPTH + 1),  # one for the array around the line
}


def marked(text: Column) -> Column:
    """``[line, {number}]``, for readers of objects."""
    return F.concat(F.lit("["), text, F.lit(f',{{"{MARK}":{NUMBER}}}]'))


def _readable_text(lines: DataFrame, keep: str, reader: str) -> tuple[DataFrame, Column]:
    """The lines worth parsing, and the text to parse."""
    require(lines.sparkSession)
    if keep not in ("objects", "all"):
        raise ValueError(f"unknown keep: {keep}")
    if reader == "replacing":
        return lines, F.make_valid_utf8("value")
    if reader != "strict":
        raise ValueError(f"unknown reader: {reader}")
    text = F.col("value")
    if keep == "all":
        return lines, F.when(readable(text), text)
    return lines.where(readable(text)), text


def _pin(lines: DataFrame, parsed: Column, record: str) -> DataFrame:
    """The other columns, and ``record`` worked out from ``_parsed``.

    The explode of a one-element array makes the record a column that later
    filters and projections refer to; left as an expression, Catalyst would
    copy it, and the parse with it, into each of them.
    """
    others = [name(c) for c in lines.columns if c != "value"]
    step = lines.select(*others, parsed.alias("_parsed"))
    return step.selectExpr(*others, f"explode(array({record})) AS record")
