"""URL filters: allow and block rules in a trie over reversed host labels and path segments.

A rule ``host/path`` fits its host and all hosts below it, if the path of the URL starts
with the rule's path.  Of the rules that fit, the one with the most host labels decides,
among those the one with the longest path, and block wins where both lists hold the same
rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

ALLOW, BLOCK = "allow", "block"
#: Rules up to this many characters in total are broadcast as one trie.
BROADCAST_CHARS = 64 << 20


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z in lower case."""
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Trie:
    """Nested dicts: host labels from the last on, then under ``None`` the whole segments
    of rule paths.  A node keeps the rules that end in it under ``True``, by what of a
    last, unfinished segment they ask for."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(True, {})
            if ends.get(rest, (None,))[0] != BLOCK:
                ends[rest] = (verdict, host + path)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the rule that decides."""
        paths, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                paths.append(node[None])
        segments = path.split("/")
        for start in reversed(paths):
            found, at = None, start
            for segment in segments:
                fits = [rest for rest in at.get(True, ()) if segment.startswith(rest)]
                if fits:
                    found = at[True][max(fits, key=len)]
                at = at.get(segment)
                if at is None:
                    break
            if found:
                return found
        return None


def _clean(rules: Iterable[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    out = [(verdict, host.lower(), path) for verdict, host, path in rules]
    if wrong := [x for x in out if x[0] not in (ALLOW, BLOCK)]:
        raise ValueError(f"neither allow nor block: {wrong[:3]}")
    return out


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] | DataFrame,
    default: str = ALLOW,
    url: str = "url",
    keep: tuple[str, ...] = (),
    broadcast_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """``keep``, ``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``.

    ``rules``: (verdict, host, path), as a list or as a frame with these columns.  Their
    total length is checked: up to ``broadcast_chars`` they are broadcast as a trie, a
    longer frame is joined on the prefixes of each URL instead, with the same result.
    A null URL or one without ``://`` has an empty host and path; it fits no rule with a
    host.  URLs that no rule fits, also on a host with an empty path, have a null rule and
    get ``default``.  Repeated rows are judged alike.
    """
    inner = [f"_keep{i}" for i in range(len(keep))]
    rows = pages.select(
        *[F.col(f"`{name}`").alias(i) for name, i in zip(keep, inner, strict=True)],
        host_of(F.col(f"`{url}`")).alias("host"),
        path_of(F.col(f"`{url}`")).alias("path"),
    )
    if isinstance(rules, DataFrame):
        rules = rules.select("verdict", F.lower("host").alias("host"), "path")
        size = rules.agg(F.sum(F.length("host") + F.length("path"))).first()[0] or 0
        if size > broadcast_chars:
            found = _by_join(rows, rules)
        else:
            found = _by_trie(rows, Trie(_clean(tuple(r) for r in rules.collect())))
    else:
        given = _clean(rules)
        if sum(len(h) + len(p) for _, h, p in given) > broadcast_chars:
            raise ValueError("pass this many rules as a DataFrame")
        found = _by_trie(rows, Trie(given))
    return found.select(
        *[F.col(i).alias(name) for name, i in zip(keep, inner, strict=True)],
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )


def _by_trie(rows: DataFrame, trie: Trie) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(trie)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            seen: dict = {}
            out = []
            for key in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                if key not in seen:
                    seen[key] = known.find(*key) or (None, None)
                out.append(seen[key])
            verdicts, matched = zip(*out, strict=True) if out else ((), ())
            columns = [pa.array(matched, pa.string()), pa.array(verdicts, pa.string())]
            yield pa.RecordBatch.from_arrays(batch.columns + columns, batch.schema.names + ["rule", "verdict"])

    schema = StructType([*rows.schema.fields, StructField("rule", StringType()), StructField("verdict", StringType())])
    return rows.mapInArrow(judge, schema)


def _by_join(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by joins: each distinct URL meets rules of its host suffixes and path folders."""
    folder = lambda path: F.regexp_replace(path, "[^/]*$", "")
    labels = F.split("host", r"\.")
    urls = rows.select("host", "path").distinct()
    suffixes = urls.select(
        "host",
        "path",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size(labels)),
                lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
            )
        ).alias("h"),
    )
    parts = F.split("path", "/")
    keys = suffixes.select(
        "*",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size(parts) - 1),
                lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.when(i > 0, F.lit("/")).otherwise("")),
            )
        ).alias("f"),
    )
    listed = rules.select(
        F.col("host").alias("h"), folder(F.col("path")).alias("f"), F.col("path").alias("p"), "verdict"
    )
    order = F.struct(
        F.size(F.split("h", r"\.")), F.length("p"), (F.col("verdict") == BLOCK)
    )
    fits = keys.join(listed, ["h", "f"]).filter(F.col("path").startswith(F.col("p")))
    best = fits.groupBy("host", "path").agg(
        F.max_by(F.concat("h", "p"), order).alias("rule"), F.max_by("verdict", order).alias("verdict")
    )
    return rows.join(best, ["host", "path"], "left")
