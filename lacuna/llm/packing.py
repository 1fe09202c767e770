"""Lexical retrieval packing: fixed windows filled with documents that share rare words.

Documents are encoded once and written to the shared folder.  Token ids serve as terms:
their document frequencies over the whole corpus, one number per id of the vocabulary,
go to every task.  Each task packs shards of documents: an inverted index with BM25
weights returns the unused neighbours of a seed document, which fill its window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import pieces, staged
from lacuna.llm.tokens import encoder

WINDOW, END_ID = 1024, 0
K1, B = 1.2, 0.75
#: Terms in more than this part of a shard's documents are held as columns, others as postings.
DENSE = 0.25
#: So many neighbours are sorted first; a window seldom takes more.
HEAD = 64
#: Columns and postings are thinned when fewer documents than this part of the last time's are unused.
THIN = 0.8
#: Ids are sorted so many at a time, whole documents.
SORTED_IDS = 1 << 20
#: Texts of so many bytes are encoded together.
TEXTS_BYTES = 8 << 20
#: A shard closes at so many documents or ids; what a task reads makes one or more shards.
SHARD_DOCUMENTS, SHARD_IDS = 8192, 16 << 20

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_PIECES_SQL = ", ".join(f"{name} bigint" for name in PIECES.names)


def encoded(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of each text and the end id, little-endian; a null text is empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        end = np.array([END_ID], known.dtype).tobytes()
        for batch in batches:
            for some in pieces(batch, "t", TEXTS_BYTES):
                ids = pa.array([x + end for x in known.many(some.column("t"))], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), ids], ["doc_id", "ids"])

    rows = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.mapInArrow(encode, "doc_id bigint, ids binary")


@dataclass
class Corpus:
    """Statistics over all documents: how many, mean length, document frequency by term."""

    documents: int
    length: float
    frequency: np.ndarray

    @property
    def idf(self) -> np.ndarray:
        n, f = max(self.documents, 1), self.frequency
        weight = np.log1p((n - f + 0.5) / (f + 0.5))
        return np.where(f < 2, 0.0, weight).astype(np.float32)  # a term of one document has no neighbours


def statistics(ids: DataFrame, vocabulary: int, dtype: str) -> Corpus:
    """Read from ``encoded()``; a task sends one row per term, the driver gets the vocabulary's."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(vocabulary + 2, np.int64)
        for batch in batches:
            docs = [np.frombuffer(raw.as_buffer(), dtype) for raw in batch.column("ids")]
            for _, term, _ in terms_of(docs):
                found[:-2] += np.bincount(term, minlength=vocabulary)
            found[-2:] += (len(docs), sum(map(len, docs)))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], ["term", "n"])

    summed = ids.select("ids").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    every = np.zeros(vocabulary + 2, np.int64)
    for row in summed.collect():
        every[row.term] = row.n
    return Corpus(int(every[-2]), float(every[-1]) / max(int(every[-2]), 1), every[:-2])


def terms_of(docs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays of documents' numbers, their different terms in order, and how often each stands
    there; documents of some ``SORTED_IDS`` ids at a time."""
    ends = np.cumsum([len(d) for d in docs])
    start = 0
    while start < len(docs):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + SORTED_IDS, side="right")))
        some = docs[start:end]
        ids = np.concatenate(some)
        # A key is the document's number, then the term.
        kind, bits = (np.uint32, 16) if ids.dtype.itemsize <= 2 and len(some) <= 1 << 16 else (np.uint64, 32)
        keys = ids.astype(kind)
        keys |= np.repeat(np.arange(len(some), dtype=kind) << kind(bits), [len(d) for d in some])
        keys.sort()
        first = np.flatnonzero(np.append([True] * len(keys[:1]), keys[1:] != keys[:-1]))
        counts = np.diff(np.append(first, len(keys)))
        keys = keys[first]
        yield (keys >> kind(bits)).astype(np.int32) + np.int32(start), (keys & kind((1 << bits) - 1)).astype(np.int64), counts
        start = end


class Shard:
    """The ends of documents that do not fill a window, and a BM25 index of the documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.docs = docs
        none = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, term, tf = map(np.concatenate, zip(none, *terms_of(docs), strict=True))
        tf = tf.astype(np.float32)
        shared = idf[term] > 0
        term, owner, tf = term[shared], owner[shared], tf[shared]
        lengths = np.array([len(d) for d in docs], np.float32)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[owner] / max(mean, 1)))
        self.bounds = np.searchsorted(owner, np.arange(len(docs) + 1))
        # Terms are numbered in their order; the numbers of the documents' terms, by document.
        sizes = np.bincount(term, minlength=len(idf))
        at = (np.cumsum(sizes > 0, dtype=np.int32) - 1)[term]
        self.asked = at
        sizes = sizes[sizes > 0]
        dense = sizes > DENSE * len(docs)
        # The column of a term; -1 if it has postings.
        self.column = np.where(dense, np.cumsum(dense) - 1, -1)
        # Documents that were unused when the index was last thinned; rows of columns and owners of postings.
        self.alive = np.arange(len(docs))
        self.columns = np.zeros((len(docs), int(dense.sum())), np.float32)
        often = dense[at]
        self.columns[owner[often], self.column[at[often]]] = weight[often]
        owner, weight, at = owner[~often], weight[~often], at[~often]
        order = np.argsort(at.astype(np.uint16) if len(sizes) <= 1 << 16 else at, kind="stable")  # a radix sort, if short
        self.owner, self.weight, self.at = owner[order], weight[order].astype(np.float32), at[order]
        self.runs = self._runs()

    def _runs(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Owners and weights of the postings of each term."""
        first = np.searchsorted(self.at, np.arange(len(self.column) + 1)).tolist()
        return [(self.owner[a:b], self.weight[a:b]) for a, b in pairwise(first)]

    def thin(self, unused: np.ndarray) -> None:
        """Drop columns and postings of used documents, once enough are used; the order of the others stays."""
        if np.count_nonzero(unused) < THIN * len(self.alive):
            kept = unused[self.alive]
            left = kept[self.owner]
            self.owner = (np.cumsum(kept, dtype=np.int32) - 1)[self.owner[left]]
            self.weight, self.at = self.weight[left], self.at[left]
            self.runs = self._runs()
            self.alive, self.columns = self.alive[kept], self.columns[kept]

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a term with the seed, best BM25 score first."""
        at = self.asked[self.bounds[seed] : self.bounds[seed + 1]]
        if not len(at):
            return
        self.thin(unused)
        column = self.column[at]
        score = np.zeros(len(self.alive))
        if runs := [self.runs[k] for k in at[column < 0].tolist()]:
            owners, weights = zip(*runs, strict=True)
            score += np.bincount(np.concatenate(owners), np.concatenate(weights), len(self.alive))
        if self.columns.shape[1]:
            asked = np.zeros(self.columns.shape[1], np.float32)
            asked[column[column >= 0]] = 1
            score += self.columns @ asked
        found = np.flatnonzero((score > 0) & unused[self.alive])
        score, found = score[found], self.alive[found]
        least = np.partition(score, -HEAD)[-HEAD] if len(found) > HEAD else 0
        for part in (score >= least, score < least):
            yield from found[part][np.lexsort((found[part], -score[part]))].tolist()


def pack(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences, each a list of (document, start, length), that hold every id once.

    Whole windows of a document stand alone.  What remains of the documents fills windows:
    the longest is the seed, its neighbours follow while they fit, and the first that does
    not is cut; its rest stays for later.  Without a neighbour the next longest is taken.
    The last window is cut into powers of two, so nothing is padded.
    """
    begin = np.array([len(d) // window * window for d in docs], np.int64)
    size = np.array([len(d) for d in docs], np.int64) - begin
    for k, whole in enumerate(begin):
        for start in range(0, int(whole), window):
            yield [(k, start, window)]
    shard, unused = Shard(docs, idf, mean), size > 0
    queue = iter(np.lexsort((np.arange(len(docs)), -size)).tolist())
    rests: list[int] = []
    row: list[tuple[int, int, int]] = []
    room = window

    def put(k: int) -> bool:
        """Append what fits of a document; whether the window is full."""
        nonlocal room
        n = int(min(room, size[k]))
        row.append((k, int(begin[k]), n))
        begin[k] += n
        size[k] -= n
        unused[k] = size[k] > 0
        room -= n
        if unused[k]:
            rests.append(k)
        return room == 0

    def next_one() -> int | None:
        while rests:
            if unused[k := rests.pop()]:
                return k
        return next((k for k in queue if unused[k]), None)

    while (seed := next_one()) is not None:
        full = put(seed)
        if not full:
            for k in shard.neighbours(seed, unused):
                if unused[k] and k != seed and (full := put(k)):
                    break
        while not full and (k := next_one()) is not None:
            full = put(k)
        if full:
            yield row
            row, room = [], window
    if row:
        yield from _powers(row)


def _powers(row: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces of a sequence cut into sequences whose lengths are powers of two."""
    left = sum(n for _, _, n in row)
    todo = row[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            k, start, n = todo.pop()
            out.append((k, start, min(n, room)))
            if n > room:
                todo.append((k, start + room, n - room))
            room -= min(n, room)
        yield out


def pack_documents(
    documents: DataFrame, tokenizer: str | None = None, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``sequence_id`` is the task's number times 2^33 plus a running number.  Rows are packed
    one by one: repeated ids are several documents, a null id is kept, a null text is an
    empty document (its end id alone).  An empty table gives no rows.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    vocabulary, dtype = encoder(path).size, encoder(path).dtype.str
    ids = staged(encoded(documents, path, doc_id, text), "packing-ids")
    corpus = statistics(ids, vocabulary, dtype)
    # As many weights as the vocabulary has ids, whatever the corpus.
    shared = documents.sparkSession.sparkContext.broadcast((corpus.idf, corpus.length))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = shared.value
        sequence = TaskContext.get().partitionId() << 33
        names: list = []
        docs: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            nonlocal sequence
            columns: list[list] = [[] for _ in PIECES.names]
            for row in pack(docs, idf, mean, window):
                offset = 0
                for k, start, n in row:
                    crc = zlib.crc32(docs[k][start : start + n].astype("<u4"))
                    for column, value in zip(columns, (names[k], start, n, crc, len(docs[k]), sequence, offset), strict=True):
                        column.append(value)
                    offset += n
                sequence += 1
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=PIECES)

        held = 0
        for batch in batches:
            for name, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                names.append(name)
                docs.append(np.frombuffer(raw, dtype))
                held += len(docs[-1])
                if len(docs) >= SHARD_DOCUMENTS or held >= SHARD_IDS:
                    yield closed()
                    names, docs, held = [], [], 0
        if docs:
            yield closed()

    return ids.mapInArrow(fill, _PIECES_SQL)
