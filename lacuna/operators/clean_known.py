"""Removing null and empty members where the shape of the records is known.

A schema says which members are objects and which are arrays; from it one expression is
generated that prunes a whole record inside the JVM (``clean_records`` reads any nesting, in
Arrow batches, and is several times as fast: README has both figures).  Scalars are parsed as
VARIANT, so they keep their JSON type whatever the schema calls them.

Lines that are not of the shape are found out and go through the code of ``clean_records``: a
member that is another container than the schema says, a member it does not name, a repeated
key, a record that is no object, text that is no JSON.  So the rows are those of
``clean_records`` for any lines; the schema decides only how fast they come.
"""

from __future__ import annotations

import json
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, _parse_datatype_string

from lacuna.functions.values import literal, name
from lacuna.operators.clean import clean_texts
from lacuna.sources.ndjson import MARK, NUMBER, PLAIN_JSON, readable

_RECORD, _CORRUPT = "__record__", "__not_of_the_shape__"
#: Longer lines go the other way; the counters below hold what a line up to here can hold.
LONGEST = 1 << 20
# Three counters in one number, of 20 bits each: members that are there, nulls that are seen,
# containers that are NULL (missing, or null in the text).
_KEY, _NULL, _ABSENT = 1, 1 << 20, 1 << 40


def _members(shape: StructType) -> list:
    """Members in the order in which they are written: that of their code points."""
    return sorted({f.name: f for f in shape.fields}.values(), key=lambda f: f.name)


def _parsed(shape: DataType) -> str:
    """The type to parse: containers as they are, everything else as VARIANT."""
    if isinstance(shape, MapType):
        raise ValueError("a map has no known members")
    if isinstance(shape, ArrayType):
        return f"array<{_parsed(shape.elementType)}>"
    if isinstance(shape, StructType):
        members = [f"{name(f.name)}: {_parsed(f.dataType)}" for f in _members(shape)]
        return f"struct<{', '.join(members or [f'{MARK}: variant'])}>"
    return "variant"


def _left(value: str, shape: DataType, number: count) -> str:
    """JSON text of what is left of a value, or NULL.  Concatenation leaves NULLs out."""
    if isinstance(shape, StructType):
        members = []
        for f in _members(shape):
            left = _left(f"{value}.{name(f.name)}", f.dataType, number)
            members.append(f"concat({literal(json.dumps(f.name, ensure_ascii=False) + ':')}, {left})")
        return f"concat('{{', {_unless_empty(f'concat_ws(\',\', {", ".join(members or ["NULL"])})', number)}, '}}')"
    if isinstance(shape, ArrayType):
        x = f"x{next(number)}"
        texts = f"transform({value}, {x} -> {_left(x, shape.elementType, number)})"
        return f"concat('[', {_unless_empty(f'array_join({texts}, \',\')', number)}, ']')"
    return f"CASE WHEN NOT is_variant_null({value}) AND cast({value} AS string) != '' THEN to_json({value}) END"


def _unless_empty(text: str, number: count) -> str:
    """The text, NULL if it is empty; ``nullif`` would work it out twice at every level."""
    x = f"x{next(number)}"
    return f"get(filter(array({text}), {x} -> {x} != ''), 0)"


def _seen(value: str, shape: DataType, number: count) -> str:
    """The three counters of a value that is there; NULL if a scalar turns out to be a container."""
    if isinstance(shape, StructType):
        parts = []
        for f in _members(shape):
            member = f"{value}.{name(f.name)}"
            absent = _ABSENT if isinstance(f.dataType, StructType | ArrayType) else 0
            inner = _seen(member, f.dataType, number)
            parts.append(f"CASE WHEN {member} IS NULL THEN {absent}L ELSE {_KEY}L + {inner} END")
        return f"({' + '.join(parts or ['0L'])})"
    if isinstance(shape, ArrayType):
        x, a, b = (f"x{next(number)}" for _ in "xab")
        inner = f"CASE WHEN {x} IS NULL THEN {_NULL}L ELSE {_seen(x, shape.elementType, number)} END"
        return f"aggregate(transform({value}, {x} -> {inner}), 0L, ({a}, {b}) -> {a} + {b})"
    kind = f"left(schema_of_variant({value}), 1)"
    return f"CASE WHEN is_variant_null({value}) THEN {_NULL}L WHEN {kind} NOT IN ('A', 'O') THEN 0L END"


def clean_known(lines: DataFrame, schema: StructType | str, other: str = "clean") -> DataFrame:
    """The rows of ``clean_records``, for records whose shape is known.

    ``schema`` (a struct type, or its DDL) names the members, at every depth, and says which
    are structs and arrays; the types of all others do not matter.  Other columns stay; one
    row per line that is JSON: ``cleaned STRING, removed BIGINT``.  ``other`` is what becomes of
    lines of another shape: ``clean`` them, or ``raise``; the plan has no Python then.

    What is removed is counted on the text of a line without the content of its strings: there
    ``null``, ``""``, ``[]`` and members ``{}`` stand for themselves.  Its keys and nulls are
    counted, too, and compared with those the schema has seen, which tells members that it does
    not name.  One case is not told: of a key that is repeated in its object, a null that is
    not the last value counts as removed.
    """
    if other not in ("clean", "raise"):
        raise ValueError(f"unknown way with other lines: {other}")
    shape = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    others = [f for f in lines.schema.fields if f.name != "value"]
    kept = [name(f.name) for f in others]
    # The line as a member, and one after it: what is not a single value cannot hide there, as
    # members beside it would be counted and not seen.
    parsed_type = f"struct<{_RECORD}: {_parsed(shape)}, {MARK}: bigint, {_CORRUPT}: string>"
    options = PLAIN_JSON | {"columnNameOfCorruptRecord": _CORRUPT}
    value = F.col("value")
    marked = F.concat(F.lit(f'{{"{_RECORD}":'), value, F.lit(f',"{MARK}":{NUMBER}}}'))
    text = F.when(readable(value) & (F.length(value) < LONGEST) & value.rlike(r"^\s*\{(?s:.*)\}\s*$"), marked)
    # Each step is pinned by exploding an array of one, or Catalyst would copy the parse, and
    # then the counts, to every place that uses them.
    parsed = lines.select(*kept, "value", F.explode(F.array(F.from_json(text, parsed_type, options))).alias("_parsed"))
    whole = f"_parsed.{MARK} = {NUMBER} AND _parsed.{_CORRUPT} IS NULL AND _parsed.{_RECORD} IS NOT NULL"
    # Strings become their first character between two that no JSON text holds.
    bare = r"""regexp_replace(value, r'"(?:([^"\\]|\\.)(?:[^"\\]++|\\.)*+)?"', concat(char(1), '$1', char(2)))"""
    found = f"CASE WHEN {whole} THEN named_struct('bare', {bare}, 'seen', {_seen(f'_parsed.{_RECORD}', shape, count())}) END"
    step = parsed.selectExpr(*kept, "value", f"_parsed.{_RECORD} AS _record", f"explode(array({found})) AS _f")
    # What is removed besides nulls.
    gone = r"""regexp_count(_f.bare, r'\x01\x02(?!\s*:)') + regexp_count(_f.bare, r'\[\s*\]')
      + regexp_count(_f.bare, r':\s*\{\s*\}')"""
    counts = rf"""named_struct('keys', CAST(regexp_count(_f.bare, r'\x02\s*:') AS bigint),
      'nulls', CAST(regexp_count(_f.bare, 'null') AS bigint), 'gone', CAST({gone} AS bigint), 'seen', _f.seen)"""
    step = step.selectExpr(*kept, "value", "_record", f"explode(array({counts})) AS _n")
    # Nulls of the text that the schema has not seen are containers, each of them a member.
    mask = (1 << 20) - 1
    unseen = f"(_n.nulls - (shiftright(_n.seen, 20) & {mask}))"
    of_shape = f"coalesce(_n.keys = (_n.seen & {mask}) + {unseen} AND {unseen} BETWEEN 0 AND shiftright(_n.seen, 40), false)"
    step = step.selectExpr(*kept, "value", "_record", f"explode(array(CASE WHEN {of_shape} THEN _n.nulls + _n.gone END)) AS removed")
    judged = step.selectExpr(
        *kept,
        f"CASE WHEN removed IS NOT NULL THEN {_left('_record', shape, count())} END AS cleaned",
        "removed",
        "CASE WHEN removed IS NULL THEN value END AS value",
    )
    if other == "raise":
        refused = F.raise_error(F.lit("a line is not of the shape")).cast("bigint")
        removed = F.when(F.col("removed").isNull(), refused).otherwise(F.col("removed"))
        return judged.select(*kept, "cleaned", removed.alias("removed"))
    return clean_texts(judged.withColumn("value", F.when(readable(value), value)))
