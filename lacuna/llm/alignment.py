"""Cross-tokenizer alignment by merge-path partitioning.

Tokenizers A and B cut the same bytes; where tokens of both end, a group ends, and the
tokens of a group belong together.  Merging the two lists of ends finds those places.  The
merge of a long text is a path through a grid; binary searches on equally spaced diagonals
of the grid cut it into pieces of equal work that need nothing of each other.  A piece
yields the groups that lie in it and the loose tokens at its two ends, which are stitched
with those of the pieces beside it.

The rest is counting.  Groups repeat as words do, so the tokens of a block of documents are
kept as numbers of distinct groups with a dictionary.  Each block sends the token pairs it
holds with their document counts once, and gets the corpus-wide counts of those pairs back.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lacuna.llm.common import pieces as slices
from lacuna.llm.common import staged

#: Ends of both tokenizers that one piece merges.
PIECE = 1 << 14
#: A block closes at so many ends; so many are handed on at a time.
BLOCK, HANDED = 1 << 22, 1 << 19
#: A group of more pairs than this is counted by its distinct tokens.
WIDE = 1 << 10
#: Both ids of a pair in one number.
_ID_BITS = 20

# Byte-level models write bytes as characters: printable ones as they are, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHAR_BYTES = {chr(b): b for b in _PRINTABLE} | {
    chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)
}


class ByteLevel:
    """Tokenizer A: ids of a text and the bytes of every id; special tokens are plain text."""

    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as file:
            setup = json.load(file)
        known = setup["model"]["vocab"]
        special = {x["content"]: x["id"] for x in setup["added_tokens"]}
        self.bytes = [b""] * (max([*known.values(), *special.values()], default=-1) + 1)
        for text, i in special.items():
            self.bytes[i] = text.encode()
        for text, i in known.items():
            if text not in special:
                self.bytes[i] = bytes(_CHAR_BYTES[c] for c in text)
        self.fast = self._ranked(setup, {self.bytes[i]: i for t, i in known.items() if t not in special})

    def _ranked(self, setup: dict, ranks: dict[bytes, int]) -> tiktoken.Encoding | None:
        """The same model for the faster library, if the order of its merges is that of its ids."""
        merges = [x.split(" ") if isinstance(x, str) else x for x in setup["model"]["merges"]]
        order = [setup["model"]["vocab"].get("".join(x), -1) for x in merges]
        pre = setup["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        rising = all(x < y for x, y in zip(order, order[1:], strict=False)) and len(ranks) == 256 + len(merges)
        if not plain or not rising or setup["normalizer"]:
            return None
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as error:  # its pattern gives up on very long white space
                if isinstance(error, KeyboardInterrupt | SystemExit):
                    raise
        if self.library is None:
            self.library = Tokenizer.from_file(self.path)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: ids of a text, before which it puts a space, and the bytes of every id."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.library.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, num_threads=1)


_LOADED: dict = {}


def _loaded(kind, path: str):
    """One tokenizer for each file and Python worker."""
    if path not in _LOADED:
        _LOADED[path] = kind(path)
    return _LOADED[path]


def _lengths(tokenizer) -> np.ndarray:
    return np.array([len(x) for x in tokenizer.bytes], np.int32)


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """Where the merge of two rising lists of ends is cut: (taken of a, taken of b), from
    (0, 0) to all.  On the diagonal d the point with i + j = d is searched at which the merge
    has taken i of ``a``; equal ends are not parted."""
    total = len(a) + len(b)
    d = np.arange(piece, total, piece)
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (low < high).any():
        open_ = low < high
        i = (low + high) // 2
        # a[i] comes among the first d if it is not behind b[d - i - 1].
        taken = np.zeros(len(d), bool)
        taken[open_] = a[i[open_]] <= b[d[open_] - i[open_] - 1]
        low, high = np.where(open_ & taken, i + 1, low), np.where(open_ & ~taken, i, high)
    cuts = [(0, 0)]
    for i, j in zip(low.tolist(), (d - low).tolist(), strict=True):
        if i and j < len(b) and a[i - 1] == b[j]:
            j += 1
        cuts.append((i, j))
    return [*cuts, (len(a), len(b))]


Batches = Iterator[pa.RecordBatch]


def _cut_pieces(paths: tuple[str, str], lengths: tuple[np.ndarray, np.ndarray], piece: int) -> Callable[[Batches], Batches]:
    """Encode each text and cut the merge of its ends: a row per piece.

    ``doc`` is the number of the row, ``a`` and ``b`` are ids, ``a_at`` and ``b_at`` the byte
    at which their first tokens begin.  A text without tokens gives an empty piece.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _loaded(ByteLevel, paths[0]), _loaded(Pieces, paths[1])
        length_a, length_b = lengths
        doc = TaskContext.get().partitionId() << 33
        for batch in (part for whole_batch in batches for part in slices(whole_batch, "t")):
            rows: list[tuple] = []
            held = 0
            for name, whole in zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist(), strict=True):
                doc += 1
                a, b = (first.ids(f" {whole}"), second.ids(whole)) if whole else ([], [])
                raw = f" {whole}".encode()
                if b"".join(map(first.bytes.__getitem__, a)) != raw or b"".join(map(second.bytes.__getitem__, b)) != raw:
                    a, b = [], []
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                a_end, b_end = np.cumsum(length_a[a]), np.cumsum(length_b[b])
                cuts = diagonals(a_end, b_end, piece)
                a, b = a.astype("<u4"), b.astype("<u4")
                for k, ((i0, j0), (i1, j1)) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    a_at, b_at = int(a_end[i0 - 1]) if i0 else 0, int(b_end[j0 - 1]) if j0 else 0
                    rows.append((doc, name, k, len(cuts) - 1, a[i0:i1].tobytes(), b[j0:j1].tobytes(), a_at, b_at))
                held += len(a) + len(b)
                if held > HANDED:
                    yield _batch(rows, _PIECE_ROWS)
                    rows, held = [], 0
            yield _batch(rows, _PIECE_ROWS)

    return encode


_PIECE_ROWS = pa.schema(
    [
        ("doc", pa.int64()),
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("pieces", pa.int32()),
        ("a", pa.binary()),
        ("b", pa.binary()),
        ("a_at", pa.int64()),
        ("b_at", pa.int64()),
    ]
)
# kind "part": numbers of groups, in order; "group": tokens of a group; "loose": tokens at the
# end of a piece; "pair": pairs of ids, for a block of whole documents with the number of
# documents that hold them in ``n``, for one of parts of long ones with ``doc``.
_ROWS = pa.schema(
    [
        ("kind", pa.string()),
        ("block", pa.int64()),
        ("doc", pa.int64()),
        ("doc_id", pa.int64()),
        ("at", pa.int64()),
        ("whole", pa.bool_()),
        ("a", pa.binary()),
        ("b", pa.binary()),
        ("pair", pa.int64()),
        ("n", pa.int64()),
    ]
)
_SQL_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string", pa.bool_(): "boolean"}


def _sql(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL_TYPES[f.type]}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _kind(kind: str, rows: int, **columns) -> pa.RecordBatch:
    """Rows of one kind; columns that are not given are null."""
    arrays = {"kind": pa.array([kind] * rows, pa.string())} | columns
    return pa.record_batch(
        [pa.array(arrays[f.name], f.type) if f.name in arrays else pa.nulls(rows, f.type) for f in _ROWS], schema=_ROWS
    )


def _expanded(groups: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of each group: (group, pair, how often), a pair of distinct ids once."""
    size_a, size_b = (np.array([len(g[k]) for g in groups], np.int64) for k in (0, 1))
    wide = size_a * size_b > WIDE
    out = []
    for k in np.flatnonzero(wide).tolist():
        (a, n_a), (b, n_b) = (np.unique(x, return_counts=True) for x in groups[k])
        pair = (a.astype(np.int64)[:, None] << _ID_BITS | b).ravel()
        out.append((np.full(len(pair), k), pair, (n_a[:, None] * n_b).ravel()))
    narrow = np.flatnonzero(~wide)
    if len(narrow):
        a = np.concatenate([groups[k][0] for k in narrow.tolist()]).astype(np.int64)
        b = np.concatenate([groups[k][1] for k in narrow.tolist()]).astype(np.int64)
        size_a, size_b = size_a[narrow], size_b[narrow]
        first = np.cumsum(size_b) - size_b
        times = np.repeat(size_b, size_a)  # a row for each token of a and each of b
        of = np.repeat(np.repeat(np.arange(len(narrow)), size_a), times)
        step = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        pair = np.repeat(a, times) << _ID_BITS | b[first[of] + step]
        order = np.lexsort((pair, of))
        of, pair = of[order], pair[order]
        new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (pair[1:] != pair[:-1])]) if len(of) else [])
        out.append((narrow[of[new]], pair[new], np.diff([*new.tolist(), len(of)])))
    group, pair, times = (np.concatenate(x) for x in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 3
    order = np.argsort(group, kind="stable")
    return group[order], pair[order], times[order]


@dataclass
class Block:
    """Whole documents, or parts of long ones, as numbers of distinct groups."""

    number: int
    whole: bool
    # A group of one token each is the number of its pair, any other the bytes of its ids.
    known: dict[int | tuple[bytes, bytes], int] = field(default_factory=dict)
    parts: list[tuple] = field(default_factory=list)
    ends: int = 0

    def add(self, doc: int, name: int | None, at: int, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> None:
        """Append the groups between neighbouring cuts of both lists of ids."""
        known = self.known
        numbers = np.empty(len(cut_a) - 1, "<u4")
        single = (np.diff(cut_a) == 1) & (np.diff(cut_b) == 1)
        pairs = a[cut_a[:-1][single]].astype(np.int64) << _ID_BITS | b[cut_b[:-1][single]]
        pairs, place = np.unique(pairs, return_inverse=True)
        numbers[single] = np.array([known.setdefault(p, len(known)) for p in pairs.tolist()], "<u4")[place]
        for k in np.flatnonzero(~single).tolist():
            group = (a[cut_a[k] : cut_a[k + 1]].tobytes(), b[cut_b[k] : cut_b[k + 1]].tobytes())
            numbers[k] = known.setdefault(group, len(known))
        self.parts.append((doc, name, at, numbers))

    def rows(self) -> Iterator[pa.RecordBatch]:
        def kind(name: str, rows: int, **columns) -> pa.RecordBatch:
            return _kind(name, rows, block=[self.number] * rows, whole=[self.whole] * rows, **columns)

        if not self.parts:
            return
        docs, names, ats, numbers = (list(x) for x in zip(*self.parts, strict=True))
        yield kind("part", len(docs), doc=docs, doc_id=names, at=ats, a=[x.tobytes() for x in numbers])
        if not self.known:
            return
        one = (1 << _ID_BITS) - 1
        keys = [
            k if isinstance(k, tuple) else ((k >> _ID_BITS).to_bytes(4, "little"), (k & one).to_bytes(4, "little"))
            for k in self.known
        ]
        yield kind("group", len(keys), at=np.arange(len(keys)), a=[k[0] for k in keys], b=[k[1] for k in keys])
        group, pair, _ = _expanded([(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")) for a, b in keys])
        first = np.searchsorted(group, np.arange(len(keys) + 1))
        # Distinct pairs of each document, some documents at a time.
        counted: list[tuple[np.ndarray, np.ndarray]] = []
        for begin in range(0, len(docs), 1024):
            distinct = [np.unique(x) for x in numbers[begin : begin + 1024]]
            of = np.repeat(np.arange(len(distinct)), [len(x) for x in distinct])
            asked = np.concatenate(distinct).astype(np.int64)
            times = first[asked + 1] - first[asked]
            entry = np.repeat(first[asked] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
            both = np.unique(np.repeat(of, times) << (2 * _ID_BITS) | pair[entry])
            of, held = both >> (2 * _ID_BITS), both & ((1 << (2 * _ID_BITS)) - 1)
            if self.whole:
                counted.append(np.unique(held, return_counts=True))
            else:
                yield kind("pair", len(of), doc=np.array(docs[begin : begin + 1024])[of], pair=held)
        if counted:
            every, at = np.unique(np.concatenate([c[0] for c in counted]), return_inverse=True)
            total = np.bincount(at, np.concatenate([c[1] for c in counted]), len(every)).astype(np.int64)
            yield kind("pair", len(every), pair=every, n=total)


def _merged(lengths: tuple[np.ndarray, np.ndarray]) -> Callable[[Batches], Batches]:
    """Merge each piece by itself: blocks of its groups, and the loose tokens of pieces of long texts."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_a, length_b = lengths
        number = TaskContext.get().partitionId() << 24
        texts, parts = Block(number, True), Block(number + 1, False)
        for batch in batches:
            loose: list[tuple] = []
            for doc, name, piece, of, a, b, a_at, b_at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
                a_end, b_end = a_at + np.cumsum(length_a[a]), b_at + np.cumsum(length_b[b])
                at = np.searchsorted(b_end, a_end)
                both = np.flatnonzero(np.append(b_end, -1)[at] == a_end)
                cut_a, cut_b = both + 1, at[both] + 1  # a group goes up to such an end
                if of == 1:
                    cut_a, cut_b = np.append(0, cut_a), np.append(0, cut_b)
                else:
                    closed = len(cut_a) > 0
                    head_a, head_b = (cut_a[0], cut_b[0]) if closed else (len(a), len(b))
                    tail_a, tail_b = (cut_a[-1], cut_b[-1]) if closed else (len(a), len(b))
                    loose.append((doc, name, 2 * piece, closed, a[:head_a].tobytes(), b[:head_b].tobytes()))
                    if len(a) > tail_a or len(b) > tail_b:
                        loose.append((doc, name, 2 * piece + 1, False, a[tail_a:].tobytes(), b[tail_b:].tobytes()))
                block = texts if of == 1 else parts
                if len(cut_a) > 1 or of == 1:
                    block.add(doc, name, 2 * piece + 1, a, b, cut_a, cut_b)
                block.ends += len(a_end) + len(b_end) + 1
                if block.ends > BLOCK:
                    yield from block.rows()
                    number += 2
                    texts, parts = (Block(number, True), parts) if of == 1 else (texts, Block(number + 1, False))
            if loose:
                docs, names, ats, closed, a, b = (list(x) for x in zip(*loose, strict=True))
                yield _kind("loose", len(docs), doc=docs, doc_id=names, at=ats, whole=closed, a=a, b=b)
        yield from texts.rows()
        yield from parts.rows()

    return merge


def _stitched(loose: DataFrame, blocks: int) -> DataFrame:
    """Loose tokens of neighbouring pieces as groups, in blocks of their own.

    ``at`` is the place of the tokens in their text, ``whole`` says that a group ends with them.
    """

    def stitch(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("doc", "at", "whole", "doc_id", "a", "b")), strict=True))
        block = Block(-1 - table.column("block")[0].as_py(), False)
        a, b = [], []
        for doc, at, closed, name, some_a, some_b in rows:
            a.append(some_a)
            b.append(some_b)
            if closed:
                ids = [np.frombuffer(b"".join(x), "<u4") for x in (a, b)]
                block.add(doc, name, at, *ids, *[np.array([0, len(x)]) for x in ids])
                a, b = [], []
        return pa.Table.from_batches(block.rows(), _ROWS)

    dealt = loose.withColumn("block", F.pmod(F.xxhash64("doc"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(stitch, _sql(_ROWS))


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's parts with the counts of its pairs: figures of each part."""
    groups = left.filter(pc.equal(left.column("kind"), "group")).sort_by("at")
    parts = left.filter(pc.equal(left.column("kind"), "part"))
    tokens = [
        (np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4"))
        for a, b in zip(groups.column("a").to_pylist(), groups.column("b").to_pylist(), strict=True)
    ]
    spelled = [f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))}" for a, b in tokens]
    group, pair, times = _expanded(tokens)
    known, first = np.unique(right.column("pair").to_numpy(), return_index=True)
    at = first[np.searchsorted(known, pair)]
    counts, best = right.column("n").to_numpy()[at], right.column("best").to_numpy()[at]
    figures = [
        np.array([len(a) for a, _ in tokens], np.int64),
        np.array([len(b) for _, b in tokens], np.int64),
        np.ones(len(tokens), np.int64),
        *(_summed(group, x, len(tokens)) for x in (times, times * best, times * counts)),
    ]
    out = []
    for raw in parts.column("a").to_pylist():
        numbers = np.frombuffer(raw, "<u4")
        out.append((*(int(x[numbers].sum()) for x in figures), ";".join(map(spelled.__getitem__, numbers.tolist()))))
    columns = [list(x) for x in zip(*out, strict=True)]
    keys = [parts.column(c) for c in ("doc", "doc_id", "at")]
    return pa.table([*keys, *[pa.array(c, f.type) for c, f in zip(columns, list(_SCORES)[3:], strict=True)]], schema=_SCORES)


def _summed(group: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Whole-number sums by group."""
    out = np.zeros(size, np.int64)
    np.add.at(out, group, values.astype(np.int64))
    return out


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_SCORES = pa.schema(
    [("doc", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())]
    + [(f, pa.int64()) for f in FIGURES]
    + [("groups", pa.string())]
)


def _one_text(table: pa.Table) -> pa.Table:
    """The parts of a long text put together."""
    table = table.sort_by("at")
    sums = [pa.array([sum(table.column(f).to_pylist())], pa.int64()) for f in FIGURES]
    groups = ";".join(table.column("groups").to_pylist())
    return pa.table([table.column("doc_id").slice(0, 1), *sums, pa.array([groups])], ["doc_id", *FIGURES, "groups"])


def align(
    documents: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    piece: int = PIECE,
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    A cuts a space and the text, B the text, before which it puts a space itself.  ``groups``
    is ``a1,a2|b1;a3|b2,b3``: the ids of the tokens of each group, in order.  A link is a
    token of A and one of B in one group.  The count of a pair of ids is the number of
    documents in which it is linked; ``count_sum`` adds it up over the links, ``n_best``
    counts the links whose count is the highest that their id of A has with any.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
    tokens: zeros and an empty string.  Repeated rows, equal and null ids are documents of
    their own; other columns are not read.  An empty table gives no rows.
    """
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    lengths = _lengths(ByteLevel(path_a)), _lengths(Pieces(path_b))
    if max(map(len, lengths)) >= 1 << _ID_BITS:
        raise ValueError(f"more than 2^{_ID_BITS} ids")
    cut, merged = _cut_pieces((path_a, path_b), lengths, piece), _merged(lengths)
    texts = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"))
    rows = staged(texts.mapInArrow(lambda batches: merged(cut(batches)), _sql(_ROWS)), "alignment-rows")
    loose = rows.where("kind = 'loose'")
    # A few thousand loose tokens to a block.
    stitched = staged(_stitched(loose, 1 + loose.count() // 4096), "alignment-stitched")
    every = rows.unionAll(stitched)

    # A document counts once for a pair, however many of its parts hold it.
    of_texts = rows.where("kind = 'pair' AND whole").select("block", "pair", "n")
    of_parts = every.where("kind = 'pair' AND NOT whole").select("block", "doc", "pair")
    added = of_texts.select("pair", "n").unionAll(of_parts.select("doc", "pair").distinct().select("pair", F.lit(1).cast("long")))
    counts = added.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = staged(counts.withColumn("a", F.shiftright("pair", _ID_BITS)), "alignment-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    judged = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))

    def scores(held: DataFrame, asked: DataFrame) -> DataFrame:
        """The parts of some blocks with the counts of the pairs they ask for."""
        told = asked.join(judged, "pair").select(F.col("block").alias("asks"), "pair", "n", "best")
        held = held.where("kind IN ('part', 'group')").drop("pair", "n")
        return held.groupBy("block").cogroup(told.groupBy("asks")).applyInArrow(_scored, _sql(_SCORES))

    figures = ", ".join(f"{f} bigint" for f in FIGURES)
    texts = scores(rows.where("whole"), of_texts.select("block", "pair")).select("doc_id", *FIGURES, "groups")
    parts = scores(every.where("NOT whole AND kind != 'loose'"), of_parts.select("block", "pair").distinct())
    return texts.unionAll(parts.groupBy("doc").applyInArrow(_one_text, f"doc_id bigint, {figures}, groups string"))
