"""Benchmark decontamination by the q-gram lemma.

Within e edits, a benchmark item of m characters and its copy share at least
m - q + 1 - q e of their q-grams, all on diagonals that differ by at most e.  Shared
q-grams are counted in overlapping bands of diagonals; where a count meets the bound, a
banded alignment decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lacuna.llm.common import pieces

Q = 8
#: Edits allowed, as a part of an item's characters.
EDITS = 0.1
#: Items are broadcast in blocks of about so many characters, whatever their number.
BLOCK_CHARS = 4 << 20

HITS = pa.schema([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])
_HITS_SQL = "array<struct<item_id: bigint, start: bigint, end: bigint, edits: bigint>>"


def normal(text: str | None) -> str:
    """Lower case, white space as single spaces."""
    return " ".join((text or "").lower().split())


def _folded(text: str) -> bytes:
    """One byte per character; equal characters stay equal, so no shared q-gram is lost."""
    return text.encode("latin-1", "replace").replace(b"\0", b"?")


def _grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each position on as one integer."""
    wide = data.astype(np.uint64)
    two = wide[:-1] | wide[1:] << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    return four[:-4] | four[4:] << np.uint64(32)


def align(item: str, text: str, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of the whole item with a part of the text, on
    diagonals (position in text - in item) from ``low`` to ``high``, if within ``most`` edits."""
    width = high - low + 1
    a = np.frombuffer(item.encode("utf-32-le"), np.uint32)
    b = np.full(len(item) + width, 0xFFFFFFFF, np.uint32)
    begin, stop = max(low, 0), min(high + len(item), len(text))
    if stop > begin:
        b[begin - low : stop - low] = np.frombuffer(text[begin:stop].encode("utf-32-le"), np.uint32)
    far, steps = len(item) + width + 1, np.arange(width)
    at = np.arange(width) + low
    cost = np.where((at >= 0) & (at <= len(text)), 0, far)
    origin = at.copy()
    for i, char in enumerate(a):
        step = cost + (b[i : i + width] != char)
        skip = np.append(cost[1:] + 1, far)
        from_ = np.append(origin[1:], 0)
        take = skip < step
        step, origin = np.where(take, skip, step), np.where(take, from_, origin)
        slope = step - steps
        run = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == run, steps, 0))
        cost, origin = run + steps, origin[source]
        if cost.min() > most:
            return None
    end = at + len(item)
    cost = np.where((end >= 0) & (end <= len(text)), cost, far)
    k = int(cost.argmin())
    return (int(cost[k]), int(origin[k]), int(end[k])) if cost[k] <= most else None


@dataclass
class Items:
    """Benchmark items and the index of their q-grams."""

    ids: list[int]
    texts: list[str]
    edits: float = EDITS
    budget: np.ndarray = field(init=False)
    need: np.ndarray = field(init=False)

    def __post_init__(self):
        sizes = np.array([len(t) for t in self.texts], np.int64)
        # The bound must stay above zero, or it would filter nothing.
        self.budget = np.maximum(np.minimum((sizes * self.edits).astype(np.int64), (sizes - Q) // Q), 0)
        self.need = sizes - Q + 1 - Q * self.budget
        self.short = [k for k, n in enumerate(sizes) if 0 < n < Q]
        grams, owners, at = [], [], []
        for k, text in enumerate(self.texts):
            if len(text) >= Q:
                found = _grams(np.frombuffer(_folded(text), np.uint8))
                grams.append(found)
                owners.append(np.full(len(found), k))
                at.append(np.arange(len(found)))
        grams = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int64)
        self.at = np.concatenate(at)[order] if at else np.zeros(0, np.int64)
        self.grams, self.first, self.count = np.unique(grams[order], return_index=True, return_counts=True)
        self.bits = max(12, int(np.ceil(np.log2(max(len(self.grams), 1)))) + 5)
        self.mask = np.zeros(1 << self.bits, bool)
        self.mask[self._slot(self.grams)] = True
        self.least = int(self.need[sizes >= Q].min()) if (sizes >= Q).any() else 0

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def find(self, texts: list[str], part: int = 1 << 20) -> list[list[tuple[int, int, int, int]]]:
        """For each normalised text the regions that align: (item_id, start, end, edits).

        Long texts are looked at in parts that overlap by more than any region's length.
        """
        over = 2 * max((len(t) for t in self.texts), default=0) + Q
        cuts = [(d, a) for d, t in enumerate(texts) for a in range(0, max(len(t) - over, 1), part)]
        out: list[set] = [set() for _ in texts]
        for (d, a), found in zip(cuts, self._find([texts[d][a : a + part + over] for d, a in cuts]), strict=True):
            out[d] |= {(i, a + start, a + end, edits) for i, start, end, edits in found}
        for k in self.short:
            for d, text in enumerate(texts):
                if (where := text.find(self.texts[k])) >= 0:
                    out[d].add((self.ids[k], where, where + len(self.texts[k]), 0))
        return [sorted(x, key=str) for x in out]

    def _find(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        out: list[list] = [[] for _ in texts]
        for d, k, band in self._bands(texts):
            w, e = int(self.budget[k]) + 1, int(self.budget[k])
            low, high = band * w, band * w + 2 * w - 1
            item, text = self.texts[k], texts[d]
            where = text.find(item, max(low, 0), high + len(item) + 1)
            found = (0, where, where + len(item)) if where >= 0 else align(item, text, low - e, high + e, e)
            if found:
                out[d].append((self.ids[k], found[1], found[2], found[0]))
        return out

    def _bands(self, texts: list[str]) -> Iterator[tuple[int, int, int]]:
        """(text, item, band) whose shared q-grams meet the bound."""
        if not len(self.grams):
            return
        raw = [_folded(t) for t in texts]
        data = np.frombuffer(b"\0".join(raw) + bytes(Q), np.uint8)
        starts = np.cumsum([0] + [len(x) + 1 for x in raw])
        grams = _grams(data)
        hits = np.flatnonzero(self.mask[self._slot(grams)])
        where = np.searchsorted(self.grams, grams[hits])
        where[where == len(self.grams)] = 0
        sure = self.grams[where] == grams[hits]
        hits, where = hits[sure], where[sure]
        owner = np.searchsorted(starts, hits, side="right") - 1
        rich = np.bincount(owner, minlength=len(texts)) > 0
        hits, where, owner = (x[rich[owner]] for x in (hits, where, owner))
        # Every occurrence of each shared q-gram, a bounded number of them at a time.
        many = self.count[where]
        cuts = np.searchsorted(np.cumsum(many), np.arange(1 << 22, many.sum() + (1 << 22), 1 << 22))
        ends = sorted({int(np.searchsorted(owner, owner[min(c, len(owner) - 1)], side="right")) for c in cuts}) if len(owner) else []
        begin = 0
        for end in ends:
            if end > begin:
                yield from self._counted(hits[begin:end], where[begin:end], owner[begin:end], starts)
            begin = end

    def _counted(self, hits, where, owner, starts) -> Iterator[tuple[int, int, int]]:
        many = self.count[where]
        spread = np.repeat(np.arange(len(hits)), many)
        nth = np.arange(len(spread)) - np.repeat(np.cumsum(many) - many, many)
        entry = self.first[where][spread] + nth
        item = self.owners[entry]
        diagonal = (hits - starts[owner])[spread] - self.at[entry]
        pair = owner[spread] * len(self.texts) + item
        # A pair with too few shared q-grams in all has no rich band.
        _, back, total = np.unique(pair, return_inverse=True, return_counts=True)
        enough = total[back] >= self.need[item]
        item, diagonal, pair = item[enough], diagonal[enough], pair[enough]
        band = diagonal // (self.budget[item] + 1)
        pair, band = np.concatenate((pair, pair)), np.concatenate((band, band - 1))
        order = np.lexsort((band, pair))
        pair, band = pair[order], band[order]
        new = np.flatnonzero(np.append(True, (np.diff(pair) != 0) | (np.diff(band) != 0))) if len(pair) else np.zeros(0, int)
        counts = np.diff(np.append(new, len(pair)))
        for k, n in zip(new, counts, strict=True):
            if n >= self.need[pair[k] % len(self.texts)]:
                yield int(pair[k] // len(self.texts)), int(pair[k] % len(self.texts)), int(band[k])


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_chars`` characters; null and blank items have none."""
    rows = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("i"), F.col(f"`{text}`").cast("string").alias("t")).filter(
        "trim(t) != ''"
    )
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-total // block_chars)
    for k in range(blocks):
        part = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        yield [(r.i, t) for r in part.orderBy("i", "t").collect() if (t := normal(r.t))]


def _mapper(items: Items, column: str):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct(list(HITS)))
        for batch in batches:
            for piece in pieces(batch, column, 1 << 20):
                hits = items.find([normal(t) for t in piece.column(column).to_pylist()])
                rows = [[dict(zip(HITS.names, h, strict=True)) for h in x] for x in hits]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(rows, kind)], [*piece.schema.names, "_hits"])

    return found


def with_hits(documents: DataFrame, benchmark: DataFrame, edits: float = EDITS, text: str = "text") -> DataFrame:
    """``documents`` with a column ``_hits``: the regions, in the normalised text, that align
    with a benchmark item.  A null or empty text has none.  Whole texts are looked at; the
    items go out in blocks, one pass over the documents for each."""
    out = None
    found = documents.withColumn("_hits", F.array().cast(_HITS_SQL))
    for block in item_blocks(benchmark):
        items = Items([i for i, _ in block], [t for _, t in block], edits)
        source = documents if out is None else out.withColumnRenamed("_hits", "_earlier")
        schema = StructType([*source.schema.fields, found.schema["_hits"]])
        out = source.mapInArrow(_mapper(items, text), schema)
        if "_earlier" in out.columns:
            out = out.withColumn("_hits", F.concat("_earlier", "_hits")).drop("_earlier")
    return found if out is None else out


def contamination(documents: DataFrame, benchmark: DataFrame, edits: float = EDITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, contaminated, n_items, item_ids, regions`` for every row of ``documents``.

    An item with a null id counts and is listed as null.  Items shorter than ``Q``
    characters must occur exactly; longer ones within ``edits`` of their length.
    """
    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    found = with_hits(rows, benchmark, edits)
    ids = F.array_sort(F.array_distinct(F.col("_hits.item_id")))
    return found.select(
        "doc_id",
        (F.size("_hits") > 0).alias("contaminated"),
        F.size(ids).cast("long").alias("n_items"),
        ids.alias("item_ids"),
        F.col("_hits").alias("regions"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """The rows without a region that aligns with a benchmark item, in no shuffle."""
    return with_hits(documents, benchmark, edits).filter(F.size("_hits") == 0).drop("_hits")
