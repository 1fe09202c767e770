"""Removing null and empty members at every depth.

Nesting has no bound, which no built-in expression can follow, so this operator
reads and writes its lines in Arrow batches: one batch in, one batch out, nothing
kept between rows.  Every other operator of the package stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.sources.ndjson import MAX_DEPTH, nonblank, readable


def _cleaner(counters: bool = False):
    """Batch function; nested so that it ships to executors by value.

    Rows that come with ``cleaned`` and ``removed`` and without a ``value`` pass.

    With ``counters`` rows are (file_name, kind, value): the cleaned lines, for each file
    of a batch one line with its counts, and, if the lines come with a ``reason``, those
    that are not read after their reason.
    """

    def clean_batches(batches):
        import json
        import re
        import sys

        import pyarrow as pa

        sys.setrecursionlimit(max(sys.getrecursionlimit(), 6 * MAX_DEPTH))

        def reject(token):
            raise ValueError(token)

        def integer(token):
            n = int(token)
            return n if -(2**63) <= n < 2**64 and token != "-0" else real(token)

        def real(token):
            return float(token)  # infinity beyond its range, as for the other readers

        # How such a number is written: as one that is again read so.
        infinite = re.compile(r'"(?:[^"\\]|\\.)*"|Infinity')

        def spelled(text):
            return infinite.sub(lambda m: "1e999" if m[0] == "Infinity" else m[0], text)

        decode = json.JSONDecoder(parse_constant=reject, parse_int=integer, parse_float=real).decode
        encode = json.JSONEncoder(
            separators=(",", ":"), ensure_ascii=False, sort_keys=True, check_circular=False
        ).encode

        def shrink(value, in_object, depth):
            """(what is left of the value or None, members counted as removed)"""
            kind = type(value)
            if kind is not dict and kind is not list:
                return (None, 1) if value is None or value == "" else (value, 0)
            if depth >= MAX_DEPTH:
                reject("too deep")
            if not value:
                return None, int(in_object or kind is list)
            removed = 0
            if kind is dict:
                left = {}
                for key, inner in value.items():
                    if inner is None:  # the common case, without a call
                        removed += 1
                        continue
                    inner, n = shrink(inner, True, depth + 1)
                    removed += n
                    if inner is not None:
                        left[key] = inner
            else:
                left = []
                for inner in value:
                    inner, n = shrink(inner, False, depth + 1)
                    removed += n
                    if inner is not None:
                        left.append(inner)
            return left or None, removed

        strings = re.compile(r'"(?:[^"\\]++|\\.)*+"?', re.DOTALL)

        def nested_too_deep(line):
            """Whether brackets outside strings are, in a line that could not be read."""
            if line.count("[") + line.count("{") <= MAX_DEPTH:
                return False
            depth = 0
            for bracket in re.findall(r"[\[\]{}]", strings.sub("", line)):
                depth += 1 if bracket in "[{" else -1
                if depth > MAX_DEPTH:
                    return True
            return False

        for batch in batches:
            rows, cleaned, counts, refused = [], [], [], []
            with_rejects = "reason" in batch.schema.names
            known = batch.column("reason").to_pylist() if with_rejects else None
            for i, line in enumerate(batch.column("value").to_pylist()):
                if line is None:
                    continue
                if with_rejects and known[i]:
                    refused.append((i, known[i], line))
                    continue
                try:
                    left, removed = shrink(decode(line), False, 0)
                    text = None if left is None else encode(left)
                    if text and "Infinity" in text:
                        text = spelled(text)
                except (ValueError, RecursionError) as error:
                    if with_rejects:
                        deep = error.args == ("too deep",) or nested_too_deep(line)
                        refused.append((i, "too_deep" if deep else "bad_json", line))
                    continue
                rows.append(i)
                cleaned.append(text)
                counts.append(removed)
            done = "removed" in batch.schema.names
            if done:  # the JVM has cleaned the lines that have no text here
                ready = batch.filter(batch.column("removed").is_valid())
                if ready.num_rows:
                    yield ready.select([n for n in batch.schema.names if n != "value"])
                if not rows:
                    continue
            others = [n for n in batch.schema.names if n not in (("value", "cleaned", "removed") if done else ("value",))]
            at = pa.array(rows, pa.int64())
            if counters:
                names = batch.column("file_name").take(at).to_pylist()
                found = {}
                for name, n in zip(names, counts):
                    entry = found.setdefault(name, [0, 0, 0])
                    entry[0] += 1
                    entry[1] += n
                left = [(name, "lines", x) for name, x in zip(names, cleaned) if x is not None]
                every = batch.column("file_name").to_pylist() if refused else []
                for i, reason, line in refused:
                    found.setdefault(every[i], [0, 0, 0])[2] += 1
                    left.append((every[i], "rejects", f"{reason} {line}"))
                left += [(name, "counts", " ".join(map(str, n))) for name, n in found.items()]
                columns = [pa.array(c, pa.string()) for c in (zip(*left) if left else ([], [], []))]
                yield pa.RecordBatch.from_arrays(columns, ["file_name", "kind", "value"])
                continue
            columns = [batch.column(n).take(at) for n in others]
            columns += [pa.array(cleaned, pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, others + ["cleaned", "removed"])

    return clean_batches


def clean_records(lines: DataFrame) -> DataFrame:
    """One row per valid JSON line: the other columns, ``cleaned STRING, removed BIGINT``.

    ``cleaned`` is the compact text, keys sorted, without any null, "", [] or {},
    where containers that lose all their content go too; NULL if nothing is left.
    ``removed`` counts, on the line as read, the nulls, empty strings and empty
    arrays, and the empty objects that are members of an object.  Lines that are
    not JSON give no row.
    """
    return clean_texts(lines.where(readable(F.col("value"))))


def clean_texts(lines: DataFrame) -> DataFrame:
    """``clean_records`` of lines that are readable.  Lines that are cleaned already have
    ``cleaned`` and ``removed`` instead of a ``value``; lines with neither give no row."""
    others = [f for f in lines.schema.fields if f.name not in ("value", "cleaned", "removed")]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in others]
        + ["cleaned string", "removed bigint"]
    )
    return lines.mapInArrow(_cleaner(), schema)


def clean_with_counts(lines: DataFrame, rejects: bool = False) -> DataFrame:
    """``file_name, kind, value``: what is left of each record as a row of kind ``lines``,
    and rows of kind ``counts`` with records read, members removed and lines rejected, to be
    added up.  With ``rejects`` also the lines that are not blank and not read, of kind
    ``rejects``, after their reason (as in ``judge_lines``, policy ``clean``) and a space.
    """
    text = F.col("value")
    if rejects:
        reason = F.when(~F.is_valid_utf8(text), "bad_utf8").when(~readable(text), "bad_json")
        named = nonblank(lines).select("file_name", F.make_valid_utf8(text).alias("value"), reason.alias("reason"))
    else:
        named = lines.where(readable(text)).select("file_name", "value")
    return named.mapInArrow(_cleaner(True), "file_name string, kind string, value string")


def drop_empty(cleaned: DataFrame) -> DataFrame:
    """Only records with something left in them."""
    return cleaned.where(F.col("cleaned").isNotNull())


def clean_report(cleaned: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Per file: records read (emptied ones included) and members removed.

    ``names``: the ``file_name`` of all inputs, for a row of zeros for those without records.
    """
    found = cleaned.groupBy("file_name").agg(
        F.count("*").alias("rows_processed"),
        F.sum("removed").alias("fields_removed"),
    )
    return found if names is None else for_all(names, found)


def for_all(names: DataFrame, report: DataFrame) -> DataFrame:
    """A row of the report for every name, zeros where it has none."""
    counts = [c for c in report.columns if c != "file_name"]
    return names.select("file_name").distinct().join(report, "file_name", "left").fillna(0, counts)
