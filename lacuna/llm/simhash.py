"""SimHash near-dedup: fingerprints, links found in BK-trees, connected components.

Two fingerprints that differ in at most r bits agree on two whole blocks of r + 2, so
each pair of blocks deals the distinct fingerprints into shards by the value of those
blocks, and no link is lost.  A shard's fingerprints form a BK-tree: children hang under
the integer Hamming distance to their parent, and a search follows only the edges within
the radius.  What a search finds leaves the tree, so a group of n fingerprints gives
n - 1 links, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import from_rows, partitions, staged

SHINGLE, RADIUS, SEED = 4, 4, 42
_SLICE = 1 << 15

LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64 majority bits of the hashes of all word shingles; 0 if there is no word."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    over = min(shingle, len(words)) - 1
    starts, ends = starts[: len(words) - over].tolist(), ends[over:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), _SLICE):
        found = [digest(line[a:b], SEED) for a, b in zip(starts[k : k + _SLICE], ends[k : k + _SLICE], strict=True)]
        rows = np.array(found, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(
    documents: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, h, fp`` per row; a null text counts as empty, ``h`` is a hash of the text."""
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(whole).alias("h"), whole.cast("binary").alias("t")
    )

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("t")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(found.view(np.int64))], ["doc_id", "h", "fp"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(signed, f"doc_id {kind}, h bigint, fp bigint")


class BKTree:
    """Fingerprints as a BK-tree whose finds are taken out.

    Each node counts what is still in it and below, so a search passes by what is empty.
    """

    def __init__(self, values: list[int]):
        self.values, self.children, self.parent, self.live = values, [{} for _ in values], [-1] * len(values), [0] * len(values)
        self.inside = [True] * len(values)
        for new in range(len(values)):
            at = 0
            while at != new:
                self.live[at] += 1
                d = (values[at] ^ values[new]).bit_count()
                below = self.children[at].setdefault(d, new)
                if below == new:
                    self.parent[new] = at
                at = below
            self.live[new] += 1

    def take(self, value: int, radius: int) -> list[int]:
        """The nodes within the radius, which leave the tree."""
        found, todo = [], [0] if self.live[0] else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius and self.inside[at]:
                found.append(at)
            children = self.children[at]
            if len(children) <= 2 * radius:
                todo += [x for e, x in children.items() if -radius <= e - d <= radius and self.live[x]]
            else:
                near = (children.get(e) for e in range(d - radius, d + radius + 1))
                todo += [x for x in near if x is not None and self.live[x]]
        for node in found:
            self.inside[node] = False
            at = node
            while at >= 0:
                self.live[at] -= 1
                at = self.parent[at]
        return found


def group_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what the radius connects among distinct unsigned values."""
    if len(values) == 2:
        return [(values[0], values[1])] if (values[0] ^ values[1]).bit_count() <= radius else []
    tree, links = BKTree(values), []
    for first in range(len(values)):
        if not tree.inside[first]:
            continue
        todo = [x for x in tree.take(values[first], radius) if x != first]
        links += [(values[first], values[x]) for x in todo]
        while todo:
            found = tree.take(values[todo.pop()], radius)
            links += [(values[first], values[x]) for x in found]
            todo += found
    return links


def _shards(radius: int) -> Column:
    """The shard keys of a fingerprint: the values of each pair of blocks, and which pair."""
    n = radius + 2
    edges = [64 * i // n for i in range(n + 1)]

    def block(i: int) -> Column:
        width = edges[i + 1] - edges[i]
        return F.shiftrightunsigned(F.col("fp"), edges[i]).bitwiseAND(F.lit((1 << width) - 1))

    keys = []
    for t, (i, j) in enumerate(combinations(range(n), 2)):
        width = edges[j + 1] - edges[j]
        keys.append(F.shiftleft(block(i), width).bitwiseOR(block(j)) * len(list(combinations(range(n), 2))) + t)
    return F.explode(F.array(*keys))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` between distinct ``fp`` at most ``radius`` bits apart: enough of them to
    connect all that are, found shard by shard.  ``radius``: up to 30."""
    sharded = prints.select("fp").distinct().select(_shards(radius).alias("s"), "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, kept = None, np.zeros(0, np.uint64)

        def closed() -> list[tuple[int, int]]:
            return group_links(kept.tolist(), radius) if len(kept) > 1 else []

        for batch in batches:
            s, fp = batch.column("s").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(s)) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(s)]))
            out = []
            if len(s) and s[0] == shard:
                kept = np.concatenate((kept, fp[: ends[0]]))
                starts, ends = starts[1:], ends[1:]
            if len(starts):
                out += closed()
                for a, b in zip(starts[:-1], ends[:-1], strict=True):
                    if b - a > 1:
                        out += group_links(fp[a:b].tolist(), radius)
                shard, kept = s[starts[-1]], fp[starts[-1] :].copy()
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in np.array(out, np.uint64).T.copy()], ["a", "b"]
                )
        if out := closed():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in np.array(out, np.uint64).T.copy()], ["a", "b"]
            )

    dealt = sharded.repartition(partitions(prints.sparkSession), "s").sortWithinPartitions("s")
    return dealt.mapInArrow(search, "a bigint, b bigint").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of undirected links ``a, b``, by alternating stars: link
    every larger neighbour of a node to its least one, then every smaller one, until the
    links are stars.  Each round is written to the shared folder; only a count and a
    checksum of the links reach the driver."""

    def ordered(frame: DataFrame) -> DataFrame:
        return frame.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(frame: DataFrame) -> tuple:
        part = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(part)).first())

    def stars(links: DataFrame) -> DataFrame:
        # Larger neighbours v of u go to m, the least of u and its neighbours.
        both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l"))
        both = both.select("l.*")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = ordered(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # Smaller neighbours v of u, and u itself, go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        to_least = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))))
        return ordered(large.join(least, "a").select(to_least.alias("l")).select("l.*"))

    # Hashes do not compress, and links are few: the files stay plain.
    now = staged(ordered(pairs), "links", "none")
    seen = mark(now)
    while seen[0]:
        now = staged(stars(now), "links", "none")
        before, seen = seen, mark(now)
        if seen == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, h, fp, component_id, keep_id, keep_h`` per row of ``documents``.

    ``component_id`` is the smallest id of all rows whose fingerprints links connect (null
    if none of them has an id); (``keep_id``, ``keep_h``) is the row that stands for them:
    smallest id, null last, then smallest hash of the text.  Repeated rows are alike in
    all of it.  An empty table gives no rows.
    """
    prints = staged(fingerprints(documents, shingle, doc_id, text), "fingerprints", "none")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    classes = prints.groupBy("fp").agg(F.min(first).alias("first"))
    linked = components(links(prints, radius)).withColumnRenamed("node", "fp")
    met = linked.join(classes, "fp")
    roots = met.groupBy("root").agg(F.min("first").alias("of_all"))
    better = met.join(roots, "root").select("fp", "of_all")
    all_of = classes.join(better, "fp", "left").select("fp", F.coalesce("of_all", "first").alias("best"))
    return prints.join(all_of, "fp").select(
        "doc_id",
        "h",
        "fp",
        F.col("best.doc_id").alias("component_id"),
        F.col("best.doc_id").alias("keep_id"),
        F.col("best.h").alias("keep_h"),
    )


def keep_one(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``documents`` that stand for their group, one of each, all columns kept."""
    found = near_duplicates(documents, shingle, radius)
    chosen = found.select(F.col("keep_id").alias("_id"), F.col("keep_h").alias("_h")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").alias("i"), F.xxhash64(text).alias("t"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("d")
    )
    met = rows.join(chosen, rows["i"].eqNullSafe(chosen["_id"]) & (rows["t"] == chosen["_h"]), "left_semi")
    return met.dropDuplicates(["i", "t"]).select("d.*")
