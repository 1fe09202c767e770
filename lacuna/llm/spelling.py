"""Spelling variants: words one edit apart, found in a bidirectional FM-index by search schemes.

If two words differ by one edit, one half of the shorter is free of it.  So a word is
searched twice: its left half is matched exactly and extended to the right over the rest,
its right half to the left, allowing one error on the way.  Both directions work on one
index, two suffix orders of the delimited vocabulary ``$word$word$`` whose intervals are
kept in step; the second search is the first one in the mirrored index.

A neighbour shares the half that is matched exactly.  So words are dealt out by that half
to shards, each with an index of its own that one task builds; a half that very many
words share is cut into blocks, and its searches go to every block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import partitions, pieces, staged

#: Runs of these characters are words.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_CHARS, LEAST_COUNT = 5, 3
#: One of so many words of a document loses a character.
ONE_OF = 97
#: Words a task holds before it hands their counts on.
HELD_WORDS = 500_000
#: About so many characters make a shard, or a block of a half that many words share.
SHARD_CHARS = 1 << 19

_LOWER = {c: c + 32 for c in range(65, 91)}
_END, _MARK = 0, 1  # codes of the end of the text and of the delimiter; characters follow


def words(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", one_of: int = ONE_OF) -> DataFrame:
    """``word, n``: how often each word occurs in all documents, after the deletions.

    A run of letters is lower-cased from A to Z.  If ``one_of`` divides the CRC32 of
    ``<doc_id>:<run>``, its character number CRC32 mod length goes, which may leave an empty
    word.  A null text has no words, a null id is an empty one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{LETTERS}]+").findall
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in pieces(batch, "t"):
                for name, whole in zip(part.column("id").to_pylist(), part.column("t").to_pylist(), strict=True):
                    if not whole:
                        continue
                    prefix = zlib.crc32(f"{name}:".encode())
                    for run, n in Counter(runs(whole)).items():
                        low = run.lower() if run.isascii() else run.translate(_LOWER)
                        h = zlib.crc32(low.encode(), prefix)
                        if h % one_of == 0:
                            at = h % len(low)
                            low = low[:at] + low[at + 1 :]
                        held[low] += n
                if len(held) > HELD_WORDS:
                    yield handed()
                    held.clear()
        if held:
            yield handed()

    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    rows = documents.select(name.alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """Suffix order of a text of small integers that ends in 0, with ranks of all of them.

    ``rank[b, c]`` counts c in the transform before block b; ``bits[b, c]`` has the places of
    c among the 64 of the block.
    """

    def __init__(self, text: np.ndarray, size: int):
        self.order = _suffix_order(text)
        last = text[self.order - 1]
        n = len(text)
        blocks = n // 64 + 1
        self.bits = np.zeros((blocks, size), np.uint64)
        at = np.arange(n)
        np.bitwise_or.at(self.bits, (at >> 6, last), np.uint64(1) << (at & 63).astype(np.uint64))
        self.rank = np.zeros((blocks, size), np.int32)
        np.cumsum(np.bitwise_count(self.bits[:-1]), axis=0, out=self.rank[1:], dtype=np.int32)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])[:-1].astype(np.int32)

    def all_before(self, at: np.ndarray) -> np.ndarray:
        """How often each code stands before these places, a row each."""
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.rank[at >> 6] + np.bitwise_count(self.bits[at >> 6] & mask[:, None])

    def before(self, at: np.ndarray, code: np.ndarray) -> np.ndarray:
        """How often a code stands before a place."""
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.rank[at >> 6, code] + np.bitwise_count(self.bits[at >> 6, code] & mask).astype(np.int32)

    def step(self, low: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one code more in front."""
        start = self.before(low, code)
        return self.first[code] + start, self.before(low + size, code) - start

    def steps(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for every code: sizes, and the lows."""
        start = self.all_before(low)
        return self.all_before(low + size) - start, self.first + start


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the length that is compared."""
    n = len(text)
    rank = np.zeros(n, np.int64)
    for k in range(7):  # codes are below 256
        rank[: n - k] |= text[k:].astype(np.int64) << (8 * (6 - k))
    width = 7
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(rank[order[1:]] != rank[order[:-1]])
        if new[order[-1]] == n - 1:
            return order
        rank = new * (n + 1)
        rank[: n - width] += new[width:] + 1
        width *= 2


class Vocabulary:
    """Words of a shard, delimited, in an index of either direction."""

    def __init__(self, known: list[str]):
        self.words = known
        points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in known]
        alphabet = np.unique(np.concatenate(points)) if points else np.zeros(0, np.uint32)
        self.codes = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.uint8)
        self.codes[alphabet] = np.arange(2, len(alphabet) + 2)
        self.size = len(alphabet) + 2
        lengths = np.array([len(p) for p in points], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])  # of the delimiters in front
        text = np.full(int(self.starts[-1]) + 2, _MARK, np.uint8)
        text[-1] = _END
        if points:
            where = np.arange(int(lengths.sum())) + np.repeat(np.arange(1, len(points) + 1), lengths)
            text[where] = self.codes[np.concatenate(points)]
        self.length = len(text) - 1
        # Extending to the left reads the text, extending to the right its mirror.
        self.left = Index(text, self.size)
        self.right = Index(np.concatenate([text[-2::-1], text[-1:]]), self.size)

    def coded(self, asked: list[str]) -> np.ndarray:
        """Words of one length as rows; 0, which no word holds, for characters not known."""
        points = np.frombuffer("".join(asked).encode("utf-32-le"), np.uint32).reshape(len(asked), -1)
        inside = points < len(self.codes)
        return np.where(inside, self.codes[np.where(inside, points, 0)], 0)

    def near(self, asked: list[str], rightwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the word asked, number of a known word) that differ by one edit in
        the right half of the word asked, or else in the left: a known word with one character
        more, or with one replaced by a greater one."""
        query = self.coded(asked)
        n, length = query.shape
        half = length // 2
        anchor, ahead = (self.left, self.right) if rightwards else (self.right, self.left)
        if not rightwards:
            query, half = query[:, ::-1], length - half
        # The half that is matched exactly, from its inner end to the delimiter.  ``low`` is the
        # interval in the index that goes on, kept in step with that of the anchor.
        who = np.flatnonzero((query[:, :half] > _MARK).all(axis=1))
        at, low = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64)
        size = np.full(len(who), self.length + 1, np.int64)
        for k in [*range(half - 1, -1, -1), None]:
            code = query[who, k].astype(np.int64) if k is not None else np.full(len(who), _MARK)
            sizes, lows = anchor.steps(at, size)
            row = np.arange(len(who))
            smaller = np.cumsum(sizes, axis=1)[row, code] - sizes[row, code]
            at, low, size = lows[row, code].astype(np.int64), low + smaller, sizes[row, code].astype(np.int64)
            who, at, low, size = (x[size > 0] for x in (who, at, low, size))
        # The other half: ``who, low, size`` without an error so far, ``erred`` with one.
        nothing = np.zeros(0, np.int64)
        erred = (nothing, nothing, nothing)
        codes = np.arange(self.size)
        for k in range(half, length + 1):
            sizes, lows = ahead.steps(low, size)
            wanted = query[who, k].astype(np.int64) if k < length else np.full(len(who), _MARK)
            other = (sizes > 0) & (codes > _MARK) & (codes != wanted[:, None])
            row, code = np.nonzero(other)
            more = (who[row], lows[row, code].astype(np.int64), sizes[row, code].astype(np.int64))
            erred = tuple(np.concatenate(x) for x in zip(erred, more, strict=True))
            if k == length:
                break
            code_of = query[erred[0], k].astype(np.int64)
            to, left = ahead.step(erred[1], erred[2], code_of)
            erred = tuple(x[left > 0].astype(np.int64) for x in (erred[0], to, left))
            greater = code > wanted[row]
            erred = tuple(np.concatenate([x, y[greater]]) for x, y in zip(erred, more, strict=True))
            row = np.arange(len(who))
            low, size = lows[row, wanted].astype(np.int64), sizes[row, wanted].astype(np.int64)
            who, low, size = (x[size > 0] for x in (who, low, size))
        to, left = ahead.step(erred[1], erred[2], np.full(len(erred[0]), _MARK))
        found, at = erred[0][left > 0], to[left > 0]
        # Words are distinct, so one suffix is left: it begins at the delimiter that came last.
        place = ahead.order[at]
        if rightwards:
            place = self.length - 1 - place  # in the text itself, the delimiter after the word
            word = np.searchsorted(self.starts, place, side="left") - 1
        else:
            word = np.searchsorted(self.starts, place, side="left")
        return found, word


def _searched(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of words in one shard: known words and asked ones, in one direction."""
    rightwards = rows.column("rightwards")[0].as_py()
    flags = rows.column("known").to_numpy()
    known = rows.filter(pa.array(flags)).combine_chunks()
    asked = rows.filter(pa.array(~flags)).combine_chunks()
    if not known.num_rows or not asked.num_rows:
        return
    # A word can be known under two halves.
    spelled, first = np.unique(np.array(known.column("word").to_pylist(), object), return_index=True)
    counts = known.column("n").to_numpy()[first]
    vocabulary = Vocabulary(spelled.tolist())
    names = asked.column("word").to_pylist()
    own = asked.column("n").to_numpy()
    lengths = np.array([len(w) for w in names])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        # So many at a time that their code rows stay small.
        some = max(1, (1 << 22) // int(length + 64))
        for begin in range(0, len(at), some):
            part = at[begin : begin + some]
            found, word = vocabulary.near([names[i] for i in part], rightwards)
            left = np.array([names[part[i]] for i in found], object)
            right = spelled[word]
            if not rightwards:  # what shares the left half too was found by the other search
                half = int(length) // 2
                new = np.array([x[:half] != y[:half] for x, y in zip(left, right, strict=True)], bool)
                found, word, left, right = found[new], word[new], left[new], right[new]
            if len(found):
                n_left, n_right = own[part[found]], counts[word]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([left, right]), pa.string()),
                        pa.array(np.concatenate([right, left]), pa.string()),
                        pa.array(np.concatenate([n_right, n_left]), pa.int64()),
                    ],
                    ["word", "near", "near_n"],
                )


def near_words(vocabulary: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``word, near, near_n``: every ordered pair of words of ``word, n`` that differ by one
    inserted, deleted or replaced character, once.  Words must be distinct and of two
    characters at least; the vocabulary is read several times: pass a written table."""
    size = F.length("word")

    def roles(asked: bool, rightwards: bool, longer: int) -> DataFrame:
        """Words with the half under which they ask, or are known to words of their length or
        one less (``longer``)."""
        length = size - longer
        half = F.floor(length / 2).cast("int")
        shared = F.left("word", half) if rightwards else F.right("word", (length - half).cast("int"))
        rows = vocabulary.where(size - longer >= 2)
        return rows.select(
            "word",
            "n",
            F.lit(not asked).alias("known"),
            F.lit(rightwards).alias("rightwards"),
            F.xxhash64(F.lit(rightwards), length, shared).alias("half"),
        )

    rows = None
    for rightwards in (True, False):
        for part in (roles(True, rightwards, 0), roles(False, rightwards, 0), roles(False, rightwards, 1)):
            rows = part if rows is None else rows.unionAll(part)
    weight = F.sum(size + 1)
    totals = rows.groupBy("half", "rightwards").agg(weight.alias("chars"))
    blocks = F.ceil(F.col("chars") / shard_chars).cast("int")
    large = staged(totals.select("half", blocks.alias("blocks")).where("blocks > 1"), "spelling-halves")
    total = totals.agg(F.sum("chars")).first()[0] or 0
    shards = max(2, -(-total // shard_chars), min(partitions(vocabulary.sparkSession), total // (shard_chars >> 4)))
    sizes = rows.join(large, "half", "left")  # halves of many words are few
    # A half in blocks: block i of what is known meets part j of what is asked in cell (i, j).
    block = F.pmod(F.xxhash64("word", F.lit("block")), F.col("blocks"))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k.cast("bigint"))
    cells = F.when(F.col("known"), F.transform(every, lambda j: block * F.col("blocks") + j)).otherwise(
        F.transform(every, lambda i: i * F.col("blocks") + block)
    )
    cell = F.explode_outer(F.when(F.col("blocks") > 1, cells))
    dealt = sizes.select("word", "n", "known", "rightwards", "half", cell.alias("cell"))
    common = F.pmod("half", F.lit(shards))
    shard = F.when(F.col("cell").isNull(), common).otherwise(F.xxhash64("half", "cell"))
    dealt = dealt.select("word", "n", "known", "rightwards", shard.alias("shard"), F.col("cell").isNotNull().alias("own"))

    def search(table: pa.Table) -> pa.Table:
        found = list(_searched(table))
        return pa.Table.from_batches(found, _PAIRS) if found else _PAIRS.empty_table()

    return dealt.groupBy("shard", "own", "rightwards").applyInArrow(search, "word string, near string, near_n bigint")


_PAIRS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: from ``word, form`` follow forms (null: none) to the last; no cycles.

    Every round doubles the steps taken, so the rounds are as many as the bits of the
    longest chain.
    """
    ahead = staged(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(
            ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        ahead = step.select("word", "root")
        if step.where("moved").isEmpty():
            return ahead


def variants(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    one_of: int = ONE_OF,
) -> DataFrame:
    """``word, n, n_near, form, form_n, root``: a row for every distinct word of at least
    ``least_chars`` characters and ``least_count`` occurrences.

    ``n_near`` counts the words one edit away.  ``form`` is the most frequent of them (of
    several, the first in code-point order) if it occurs twice as often at least, else null;
    ``root`` is what following the forms ends at, the word itself if it has none.  An empty
    table, or one of null texts, gives no rows; repeated rows count as often as they stand.
    """
    counted = words(documents, doc_id, text, one_of)
    vocabulary = staged(counted.where((F.length("word") >= least_chars) & (F.col("n") >= least_count)), "spelling-words")
    pairs = near_words(vocabulary)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    largest: Column = -F.col("best.minus")
    chosen = F.coalesce(largest >= 2 * F.col("n"), F.lit(False))
    formed = vocabulary.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"),
        F.when(chosen, largest).alias("form_n"),
    )
    formed = staged(formed, "spelling-forms")
    return formed.join(roots(formed), "word", "left").withColumn("root", F.coalesce("root", "word"))
