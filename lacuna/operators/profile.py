"""How full the fields of a collection are, and which values they take.

``profile_facts`` reads the records once.  Its rows are counters that add up, so
each report below -- per file, overall, per field, per value -- is a small
re-aggregation of them, and facts of separate batches can simply be unioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions.values import (
    is_empty_container,
    is_scalar,
    json_text,
    literal,
    name,
    path,
    text_or_null,
)
from lacuna.sources.ndjson import mentioning, parse_fields

# The fields whose values are counted unless others are named.
VALUE_FIELDS = (
    "gender",
    "location_country",
    "location_continent",
    "job_title",
    "version_status.status",
)


def profile_facts(records: DataFrame, value_fields: Sequence[str] = ()) -> DataFrame:
    """Counters by (file_name, field, value).

    ``value`` is set only for string values of the ``value_fields``, so without
    those there is one row per file and field.  ``objects`` counts each record
    once, at its first field (or at the NULL field of a record without any).
    Partial aggregation folds the rows before the shuffle, so a file holding
    most of the records adds no load to the task that merges it.
    """
    value = "cast(NULL AS string)"
    if value_fields:
        named = ", ".join(literal(field) for field in value_fields)
        value = f"CASE WHEN field IN ({named}) THEN {text_or_null('x')} END"
    return (
        records.selectExpr("file_name", "posexplode_outer(record) AS (i, field, x)")
        .groupBy("file_name", "field", F.expr(value).alias("value"))
        .agg(
            F.expr("count_if(coalesce(i, 0) = 0) AS objects"),
            F.expr("count(field) AS present"),
            F.expr("count_if(is_variant_null(x)) AS `null`"),
            F.expr(f"count_if({is_empty_container('x')}) AS empty"),
        )
    )


def facts_of(names: DataFrame) -> DataFrame:
    """Facts for files that may have no record: add them to the others (``unionByName``),
    and reports have a row for each of these names."""
    counters = [F.lit(0).cast("long").alias(c) for c in ("objects", "present", "null", "empty")]
    nothing = [F.lit(None).cast("string").alias(c) for c in ("field", "value")]
    return names.select("file_name", *nothing, *counters).distinct()


def _totals() -> list[Column]:
    return [
        F.sum("objects").alias("objects"),
        F.sum("present").alias("total_fields"),
        F.sum(F.col("null") + F.col("empty")).alias("null_or_empty"),
    ]


def _with_averages(totals: DataFrame) -> DataFrame:
    objects, fields, void = F.col("objects"), F.col("total_fields"), F.col("null_or_empty")
    return totals.select(
        "*",
        F.try_divide(fields, objects).alias("avg_fields"),
        F.try_divide(void, objects).alias("avg_null_or_empty"),
        (F.try_divide(void, fields) * 100).alias("null_or_empty_pct"),
    )


def by_file(facts: DataFrame) -> DataFrame:
    """Per file: records, fields, fields without content, averages and their ratio."""
    return _with_averages(facts.groupBy("file_name").agg(*_totals()))


def overall(facts: DataFrame) -> DataFrame:
    """The same over all files (ratio of the sums)."""
    totals = facts.agg(F.count_distinct("file_name").alias("files"), *_totals())
    return _with_averages(totals)


def by_field(facts: DataFrame) -> DataFrame:
    """Per field: how often present, null, empty ([] or {}) and non-empty."""
    return (
        facts.where(F.col("field").isNotNull())
        .groupBy("field")
        .agg(
            F.sum("present").alias("present"),
            F.sum("null").alias("null"),
            F.sum("empty").alias("empty"),
            F.sum(F.col("present") - F.col("null") - F.col("empty")).alias("non_empty"),
        )
    )


def by_value(facts: DataFrame) -> DataFrame:
    """Per value field and string value: how often (from facts that carry values)."""
    return (
        facts.where(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.sum("present").alias("count"))
    )


def profile_fields(records: DataFrame) -> DataFrame:
    """``by_field`` straight from the records; also works on a stream."""
    counts = (
        records.selectExpr("explode(record) AS (field, x)")
        .groupBy("field")
        .agg(
            F.expr("count(*) AS present"),
            F.expr("count_if(is_variant_null(x)) AS `null`"),
            F.expr(f"count_if({is_empty_container('x')}) AS empty"),
        )
    )
    return counts.selectExpr("*", "present - `null` - empty AS non_empty")


def value_counts(
    lines: DataFrame, fields: Sequence[str] = VALUE_FIELDS, paths: bool = False
) -> DataFrame:
    """Counts of the string values of the named fields.

    Only those fields are parsed.  Names are literal keys; ``paths=True`` reads a
    dot as a step into a nested object.
    """
    steps = {field: field.split(".") if paths else [field] for field in fields}
    pairs = []
    for field, (top, *rest) in steps.items():
        value = f"record.{name(top)}"
        if rest:
            value = path(value, *rest)
        pairs.append(f"struct({literal(field)} AS field, {text_or_null(value)} AS value)")
    tops = [top for top, *_ in steps.values()]
    return (
        parse_fields(mentioning(lines, *[f'"{top}"' for top in tops]), tops)
        .selectExpr(f"inline(array({', '.join(pairs)}))")
        .where("value IS NOT NULL")
        .groupBy("field", "value")
        .agg(F.count("*").alias("count"))
    )


def status_counts(lines: DataFrame, field: str = "status") -> DataFrame:
    """Counts of the scalar values of one field, as JSON text ("3" and 3 differ)."""
    value = f"record.{name(field)}"
    return (
        parse_fields(mentioning(lines, f'"{field}"'), [field])
        .where(f"{value} IS NOT NULL AND {is_scalar(value)}")
        .groupBy(F.expr(json_text(value)).alias("status"))
        .agg(F.count("*").alias("count"))
    )


def distribution_document(counts: DataFrame) -> DataFrame:
    """The value counts as one indented JSON document: ``field, value, text``.

    Each count is one row of the document.  A row also carries the brace that
    opens or closes its field, which it learns from the first and last value of
    the field, joined, not from a window over all values of it.  Written in
    (field, value) order the rows form the document; without counts it is ``{}``.
    ``counts`` is read several times: pass a written table.
    """
    field, value = F.col("field"), F.col("value")
    ends = counts.groupBy("field").agg(F.min("value").alias("first"), F.max("value").alias("last"))
    first, last = value == F.col("first"), value == F.col("last")
    opens = first & (field == counts.agg(F.min("field")).scalar())
    closes = field == counts.agg(F.max("field")).scalar()
    text = F.concat(
        F.when(opens, "{\n").otherwise(""),
        F.when(first, F.concat(F.lit("  "), _quoted(field), F.lit(": {\n"))).otherwise(""),
        F.concat(F.lit("    "), _quoted(value), F.lit(": "), F.col("count").cast("string")),
        F.when(~last, ",").when(closes, "\n  }\n}").otherwise("\n  },"),
    )
    rows = counts.join(ends, "field").select("field", "value", text.alias("text"))
    none = counts.agg(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"), F.count("*").alias("n"))
    return rows.union(none.where("n = 0").select("field", "value", F.lit("{}").alias("text")))


def _quoted(text: Column) -> Column:
    """The text as a JSON string literal."""
    return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")
