"""Histogram sort: shards of near equal bytes, cut at exactly counted boundaries.

Documents are ordered by ``(hash of the text, order column, number)``, so equal texts are
neighbours.  Where the shards end is found by counting alone: every round takes the key
ranges in which a boundary still lies, sets up to 4096 probes in each at equal distances of
the key, and counts the rows and bytes between them, exactly and over all partitions.  A range
is probed again until the bytes below a probe are within the tolerance of the bytes wanted,
or a single row is left.  Then the rows move once, to their places.

Ranges with many rows are probed too, until each piece is small: one text that makes up a
third of the table is cut by the order column and, if that repeats as well, by the running
number.  Only functions of Spark are used.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.llm.common import partitions, staged

SHARDS = 16
#: A shard may differ from its share of the bytes by this part of it (or half a document).
TOLERANCE = 0.001
#: Each round sets 2 ** PROBE_BITS probes in a range.
PROBE_BITS = 12

_BIAS = 1 << 63
_KEYS = ("_hash", "_order", "_number")
Key = tuple[int, int, int]  # each from 0 to 2^64 - 1


@dataclass
class Range:
    """Rows with keys from ``start`` up to the start of the next range."""

    start: Key
    rows: int
    bytes: int
    least: Key = (0, 0, 0)
    most: Key = (0, 0, 0)

    def probes(self) -> tuple[int, int]:
        """The first key column that differs within the range, and the bits it has in common."""
        for level, (least, most) in enumerate(zip(self.least, self.most, strict=True)):
            if least != most:
                return level, 64 - (least ^ most).bit_length()
        return len(_KEYS), 0


def _unsigned(column: str) -> Column:
    """The same 64 bits with the order of signed numbers as the order of bits."""
    return F.col(column).bitwiseXOR(F.lit(-_BIAS))


def _signed(value: int) -> int:
    return value - _BIAS


def keyed(documents: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """``document`` (all columns), ``size`` and the key columns, written to the shared folder."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = documents.select(
        F.struct("*").alias("document"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.xxhash64(whole).alias("_hash"),
        F.coalesce(F.col(f"`{order}`").cast("long"), F.lit(-_BIAS)).alias("_order"),
        F.monotonically_increasing_id().alias("_number"),
    )
    return staged(rows, "shard-rows")


def _counts() -> list[Column]:
    ends = [f(k).alias(f"{f.__name__}{k}") for k in _KEYS for f in (F.min, F.max)]
    return [F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ends]


def _counted(row, start: Key | None) -> Range:
    least, most = (tuple(row[f"{f}{k}"] + _BIAS for k in _KEYS) for f in ("min", "max"))
    return Range(start or least, row["rows"], row["bytes"], least, most)


def _located(rows: DataFrame, ranges: list[Range], fields: list[dict], types: str) -> DataFrame:
    """The rows with ``_place``: the fields of the range that holds their key.

    The leading bits of the hash name the ranges that begin there and the one before, of which
    the last whose start is not beyond the key is taken.  The table has a few entries for each
    range.
    """
    bits = min(20, 2 + len(ranges).bit_length())
    places = [dict(zip("hdn", map(_signed, r.start), strict=True), **f) for r, f in zip(ranges, fields, strict=True)]
    heads = [r.start[0] >> (64 - bits) for r in ranges]
    table = []
    for bucket in range(1 << bits):
        begin, last = bisect_right(heads, bucket - 1), bisect_right(heads, bucket)
        table.append({"bucket": bucket, "places": places[max(begin - 1, 0) : last]})
    schema = f"array<struct<bucket: bigint, places: array<struct<h: bigint, d: bigint, n: bigint, {types}>>>>"
    spark = rows.sparkSession
    found = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(table)), schema)).alias("x"))
    found = staged(found.select("x.bucket", "x.places"), "shard-places")
    key = F.struct(*[F.col(k).alias(n) for k, n in zip(_KEYS, "hdn", strict=True)])
    own = F.element_at(F.filter("places", lambda p: F.struct(p.h.alias("h"), p.d.alias("d"), p.n.alias("n")) <= key), -1)
    kept = [c for c in rows.columns if c != "bucket"]
    joined = rows.withColumn("bucket", F.shiftrightunsigned(_unsigned("_hash"), 64 - bits)).join(F.broadcast(found), "bucket")
    return joined.select(*kept, own.alias("_place"))


def probe(rows: DataFrame, ranges: list[Range], bits: dict[int, int]) -> dict[int, list[Range]]:
    """Some ranges, by number, cut at 2 to the ``bits`` probes each: the parts that hold rows."""
    shapes, fields = {}, []
    for i, r in enumerate(ranges):
        if i not in bits:
            fields.append({"range": None})
            continue
        level, common = r.probes()
        end = min(common + bits[i], 64)
        shapes[i] = (level, common, end)
        fields.append({"range": i, "level": level, "low": 64 - end, "mask": (1 << (end - common)) - 1})
    located = _located(rows.select("size", *_KEYS), ranges, fields, "range: int, level: int, low: int, mask: bigint")
    keys = " ".join(f"WHEN {level} THEN {k}" for level, k in enumerate(_KEYS))
    part = f"shiftrightunsigned((CASE _place.level {keys} END) ^ {-_BIAS + 1}L ^ 1L, _place.low) & _place.mask"
    found = located.where("_place.range IS NOT NULL").selectExpr("_place.range AS range", f"{part} AS part", "size", *_KEYS)
    out: dict[int, list[Range]] = {i: [] for i in shapes}
    # At most as many rows as there are probes.
    for row in found.groupBy("range", "part").agg(*_counts()).orderBy("range", "part").collect():
        level, common, end = shapes[row["range"]]
        of = ranges[row["range"]]
        lead = of.least[level] >> (64 - common) << (end - common) if common else 0
        start = (*of.least[:level], (lead | row["part"]) << (64 - end), *([0] * (len(_KEYS) - level - 1)))
        out[row["range"]].append(_counted(row, start))
    for i, parts in out.items():
        parts[0].start = min(parts[0].start, ranges[i].start)
    return out


def _joined(parts: list[Range], below: int, targets: list[float], most_rows: int, most_bytes: int) -> list[Range]:
    """Neighbouring parts as one while they are small and no boundary is wanted in or between them."""
    out: list[Range] = []
    closed = True
    for p in parts:
        # Boundaries wanted within this part, its two ends included.
        wanted = bisect_right(targets, below + p.bytes) > bisect_right(targets, below - 1)
        if closed or wanted or out[-1].rows + p.rows > most_rows or out[-1].bytes + p.bytes > most_bytes:
            out.append(p)
        else:
            out[-1] = Range(out[-1].start, out[-1].rows + p.rows, out[-1].bytes + p.bytes, out[-1].least, p.most)
        closed = wanted or p.rows > most_rows or p.bytes > most_bytes
        below += p.bytes
    return out


def cut(rows: DataFrame, shards: int, tolerance: float, pieces: int) -> tuple[list[Range], list[int]]:
    """Ranges in key order, none with more rows or bytes than one of ``pieces``, and for each shard
    the number of its first range."""
    totals = rows.agg(*_counts()).first()
    if not totals["rows"]:
        return [Range((0, 0, 0), 0, 0)], [0] * shards
    whole = _counted(totals, (0, 0, 0))
    share = whole.bytes / shards
    targets = [k * share for k in range(1, shards)]
    most_rows, most_bytes = -(-whole.rows // pieces), -(-whole.bytes // pieces)
    ranges = [whole]
    while True:
        below, open_ranges, bits = 0, {}, {}
        for i, r in enumerate(ranges):
            inside = targets[bisect_right(targets, below) : bisect_right(targets, below + r.bytes)]
            far = any(min(t - below, below + r.bytes - t) > tolerance * share for t in inside)
            if r.rows > 1 and (far or r.rows > most_rows or r.bytes > most_bytes):
                open_ranges[i] = below
                # As many probes as make parts of the size wanted, so that all rounds together
                # count a few times as many parts as there are pieces.
                wanted = max(r.rows // most_rows, r.bytes // most_bytes).bit_length() + 2
                bits[i] = PROBE_BITS if far else min(PROBE_BITS, wanted)
            below += r.bytes
        if not open_ranges:
            break
        found = probe(rows, ranges, bits)
        ranges = [
            part
            for i, r in enumerate(ranges)
            for part in (_joined(found[i], open_ranges[i], targets, most_rows, most_bytes) if i in found else [r])
        ]
    starts = [0]
    for r in ranges:
        starts.append(starts[-1] + r.bytes)
    # The boundary whose bytes below are nearest to the bytes wanted; of two, the lower.
    first = [0]
    for t in targets:
        at = bisect_right(starts, t) - 1
        first.append(at if at + 1 == len(starts) or t - starts[at] <= starts[at + 1] - t else at + 1)
    return ranges, first


def shard(
    documents: DataFrame,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    pieces: int | None = None,
    text: str = "text",
    order: str = "doc_id",
) -> DataFrame:
    """``document`` (a struct of all columns), ``size``, ``shard`` and ``slot`` of every row.

    ``size`` is the UTF-8 bytes of the text plus one; a null text has none and is ordered as
    an empty one.  Shards are consecutive in the order (hash of the text, ``order`` column,
    number of the row) and their sizes are equal but for ``tolerance`` of a share, or for
    where no boundary between two rows comes nearer.  ``slot`` counts from 0 without gaps in
    each shard, in that order.  So equal texts stand together, but a group of them larger
    than a shard goes on in the next.  A null ``order`` comes first; repeated rows are placed
    one by one.  An empty table gives no rows.  Other columns, whatever they are called, stay
    in ``document``.

    ``pieces`` (eight times the shuffle partitions) bounds the rows and bytes that are ordered together,
    and the size of the table of boundaries that goes to every task.
    """
    rows = keyed(documents, text, order)
    ranges, first = cut(rows, shards, tolerance, pieces or max(shards, 8 * partitions(documents.sparkSession)))
    fields, base, at = [], 0, 0
    for i, r in enumerate(ranges):
        while at + 1 < len(first) and first[at + 1] <= i:
            at, base = at + 1, 0
        fields.append({"piece": i, "shard": at, "base": base})
        base += r.rows
    placed = _located(rows, ranges, fields, "piece: bigint, shard: int, base: bigint")
    within = Window.partitionBy("_place.piece").orderBy(*_KEYS)
    slot = F.col("_place.base") + F.row_number().over(within) - 1
    return placed.select("document", "size", F.col("_place.shard").alias("shard"), slot.alias("slot"))


def write_shards(documents: DataFrame, folder: str, shards: int = SHARDS, **how) -> DataFrame:
    """The documents under ``folder/shard=<k>/`` as Parquet, in the order of their slots within
    a file; returns ``shard, rows, bytes`` of what was written."""
    found = shard(documents, shards, **how)
    found.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    written = documents.sparkSession.read.parquet(folder)
    return written.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
