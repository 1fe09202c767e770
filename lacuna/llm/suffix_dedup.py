"""Suffix-array dedup: remove passages that a document with a smaller id holds too.

Every string of ``LENGTH`` bytes is a suffix cut to that length.  Sorting them all by
their bytes would move fifty bytes for each byte of text, so they are first ordered by
tokens.  A token is the hash of ``TOKEN`` bytes; the leading token of a string is the
least of those inside it.  Strings that are equal have the same leading token, and
neighbouring strings mostly share it, so a *run* of them is handled as one suffix of the
token order: (leading token, hash of all bytes its strings cover).

1. Splitters from a sample range-partition the runs by leading token (and what follows,
   where one token is frequent).  A bucket sorts its runs by multikey quicksort.  Of equal
   runs all but those of the smallest id are removed.  A leading token with one run is done.
2. Runs that share a leading token but differ, also across the boundary of two buckets,
   hold strings that may be equal.  Those strings are partitioned by sampled splitters of
   their leading bytes, sorted by multikey quicksort of their bytes, eight at a time, and
   compared with their neighbours.
3. Removed ranges meet their documents again.

Each task folds what it has before it is shuffled: of equal runs or strings only those of
the smallest id go on, so a passage in a third of all documents is one entry per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import partitions, staged

LENGTH = 50
#: Bytes in a token; shorter ones make fewer runs, longer ones fewer that merely start alike.
TOKEN = 20
#: Bytes of text hashed at once, and runs (or strings) a task folds at once.
_PIECE, _FOLD = 256 << 10, 1 << 20
#: Splitters are drawn from about so many documents and entries.
SAMPLE_DOCUMENTS, SAMPLE_PER_DOCUMENT = 2000, 32

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_CODES = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * _U(2) + _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


_UP = _powers(int(_BASE), _PIECE * 2)
_DOWN = _powers(pow(int(_BASE), -1, 1 << 64), _PIECE * 2)


def _token_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes from each position on."""
    done, length, part, width = None, 0, codes, 1
    while True:
        if size & width:
            if done is None:
                done, length = part, width
            else:
                n = len(codes) - length - width + 1
                done = part[:n] * _U(pow(int(_BASE), length, 1 << 64)) + done[width : width + n]
                length += width
        if 2 * width > size:
            return _mixed(done)
        n = len(part) - width
        part = part[:n] * _U(pow(int(_BASE), width, 1 << 64)) + part[width:]
        width *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs(texts: list[bytes], length: int = LENGTH, token: int = TOKEN) -> tuple[np.ndarray, ...]:
    """(document, first, count, lead, hash) of the runs of some short texts: ``count`` strings
    from byte ``first`` on have the leading token ``lead``."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    long = np.flatnonzero(sizes >= length)
    if not len(long):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    codes = _CODES[data]
    lead = _least(_token_hashes(codes, token), length - token + 1)
    first, last = begin[long], begin[long] + sizes[long] - length + 1
    cuts = np.unique(np.concatenate((np.flatnonzero(lead[1:] != lead[:-1]) + 1, first, last)))
    ends = np.append(cuts[1:], len(lead))
    which = np.searchsorted(first, cuts, side="right") - 1
    inside = (which >= 0) & (cuts < last[which])
    cuts, ends, which = cuts[inside], ends[inside], which[inside]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * _UP[: len(codes)], dtype=np.uint64)))
    whole = (sums[ends - 1 + length] - sums[cuts]) * _DOWN[cuts]
    count = ends - cuts
    whole = _mixed(whole + count.astype(np.uint64) * _BASE)
    return long[which], cuts - first[which], count, lead[cuts] >> _U(16), whole >> _U(16)  # 96 bits in all


def _slices(ids: list[int], texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(ids, offsets, texts) of about ``_PIECE`` bytes; longer texts are cut, overlapping so
    that each string lies in one slice."""
    some: tuple[list, list, list] = ([], [], [])
    held = 0
    for i, text in zip(ids, texts, strict=True):
        for at in range(0, max(len(text) - length + 1, 0), _PIECE):
            part = text[at : at + _PIECE + length - 1]
            if held and held + len(part) > _PIECE:
                yield some
                some, held = ([], [], []), 0
            for column, value in zip(some, (i, at, part), strict=True):
                column.append(value)
            held += len(part)
    if held:
        yield some


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """The order that sorts by all keys: sort by one, then only what it leaves tied by the next."""
    order = np.argsort(keys[0])
    tied, group = np.arange(len(order)), keys[0][order]
    for key in keys[1:]:
        same = group[1:] == group[:-1]
        tie = np.zeros(len(group), bool)
        tie[1:] |= same
        tie[:-1] |= same
        number = np.cumsum(np.append(True, ~same))[tie] if len(group) else np.zeros(0, int)
        tied = tied[tie]
        if not len(tied):
            break
        values = key[order[tied]]
        inner = np.lexsort((values, number))
        order[tied] = order[tied][inner]
        _, group = np.unique(values[inner], return_inverse=True)
        group = number[inner] * (int(group.max()) + 1) + group
    return order


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted row differs from the one before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _group_value(new: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each row the value in the first row of its group."""
    starts = np.flatnonzero(new)
    return np.repeat(values[starts], np.diff(np.append(starts, len(values))))


def _packed(columns: list[np.ndarray], tail: bytes = b"") -> bytes:
    """Numbers as compressed byte planes (planes of zeros cost next to nothing), and bytes."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]
    head = np.int64(len(columns[0])).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes) + tail)


def _unpacked(blob: bytes, kinds: tuple) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    data, n, at, out = np.frombuffer(raw, np.uint8), int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(data[at : at + n * width].reshape(width, n).T.copy().view(kind).reshape(n))
        at += n * width
    return out, raw[at:]


def _joined(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*held, strict=True)]


# What rows carry, by kind.  A document is its id and, where ids repeat, a hash of its text.
_RUN = (np.uint64, np.uint64, np.int64, np.uint64, np.int64, np.int64)  # lead, hash, doc, row, first, count
_RANGE = (np.int64, np.uint64, np.int64, np.int64)  # doc, row, first, end
_OPEN = (*_RANGE, np.uint64, np.uint8)  # and lead, and whether that is hot
# Ranges a task has removed (_GONE) go to a bucket, which sends them home (_REMOVED) with its own.
_RUNS, _GONE, _REMOVED, _OPENED, _SPANS, _STRINGS, _TEXT = range(7)
_ROW_SQL = "part int, kind int, blob binary"
#: A leading token with more unequal runs in a bucket has its strings dealt out singly.
HOT_RUNS = 4096


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "kind", "blob"])


def _by_part(part: np.ndarray, columns: list[np.ndarray], kind: int) -> list[tuple[int, int, bytes]]:
    """One row for each part."""
    if not len(part):
        return []
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(part[order]) != 0))
    ends = np.append(cuts[1:], len(order))
    return [
        (int(part[order[a]]), kind, _packed([c[order[a:b]] for c in columns])) for a, b in zip(cuts, ends, strict=True)
    ]


def _home(doc: np.ndarray, row: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(doc.view(np.uint64) ^ row) % _U(parts)).astype(np.int64)


def _merged(ranges: list[np.ndarray]) -> list[np.ndarray]:
    """Overlapping and touching ranges (doc, row, first, end) of a document as one."""
    doc, row, first, end = ranges
    if not len(doc):
        return ranges
    order = np.lexsort((first, row, doc))
    doc, row, first, end = (x[order] for x in ranges)
    # Lay the documents one after the other on one line.
    number = np.cumsum(_new(doc, row)) - 1
    stride = int(end.max()) + 2
    reach = np.maximum.accumulate(end + number * stride)
    starts = np.flatnonzero(np.append(True, (first + number * stride)[1:] > reach[:-1]))
    last = np.append(starts[1:], len(doc)) - 1
    return [doc[starts], row[starts], first[starts], reach[last] - number[starts] * stride]


def _folded(entries: list[np.ndarray], length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sorted entries (two keys, doc, row, first, count): those of the smallest id of equal
    keys, and the merged ranges of the others."""
    order = multikey_order(entries[:3])
    one, two, doc, row, first, count = (x[order] for x in entries)
    kept = doc == _group_value(_new(one, two), doc)
    gone = [doc[~kept], row[~kept], first[~kept], (first + count - 1 + length)[~kept]]
    return [x[kept] for x in (one, two, doc, row, first, count)], _merged(gone)


def _removed_rows(ranges: list[np.ndarray], parts: int) -> list[tuple[int, int, bytes]]:
    return _by_part(_home(ranges[0], ranges[1], parts), ranges, _REMOVED)


def _gone_row(ranges: list[np.ndarray], parts: int) -> list[tuple[int, int, bytes]]:
    return [(TaskContext.get().partitionId() % parts, _GONE, _packed(ranges))] if len(ranges[0]) else []


def _bucket(keys: list[np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """How many splitters are at most each row, by all keys."""
    n = len(splitters[0])
    both = [np.concatenate((s, k)) for s, k in zip(splitters, keys, strict=True)]
    is_row = np.concatenate((np.zeros(n, np.int64), np.ones(len(keys[0]), np.int64)))
    order = multikey_order([*both, is_row])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(1 - is_row[order])
    return out[n:]


def _sampled_splitters(rows: DataFrame, parts: int, length: int, token: int) -> list[np.ndarray]:
    """``parts`` - 1 or fewer keys (lead, hash) that cut the runs into equal shares, from at
    most ``SAMPLE_DOCUMENTS`` x ``SAMPLE_PER_DOCUMENT`` of them; results do not depend on them."""
    count = rows.select("i").count()
    share = SAMPLE_DOCUMENTS / max(count, 1)
    chosen = rows.filter(F.pmod(F.xxhash64("i"), F.lit(1_000_000)) < share * 1e6) if share < 1 else rows

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in _slices([0] * batch.num_rows, batch.column("t").to_pylist(), length):
                which, _, _, lead, whole = runs(texts, length, token)
                order = np.lexsort((_mixed(whole), which))
                nth = np.arange(len(which)) - np.searchsorted(which, which)
                picked = order[nth < SAMPLE_PER_DOCUMENT]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[picked].view(np.int64)) for x in (lead, whole)], ["lead", "whole"]
                )

    found = chosen.mapInArrow(some, "lead bigint, whole bigint").limit(2 * SAMPLE_DOCUMENTS * SAMPLE_PER_DOCUMENT).toArrow()
    lead, whole = (found.column(c).to_numpy().view(np.uint64) for c in ("lead", "whole"))
    order = multikey_order([lead, whole])
    at = np.unique(np.linspace(0, len(order), parts + 1).astype(np.int64)[1:-1])
    at = at[at < len(order)]
    return [lead[order[at]], whole[order[at]]]


def _map_runs(splitters: list[np.ndarray], parts: int, length: int, token: int):
    """Step 1: the runs of a task's documents, folded, by bucket."""

    def out(held: list) -> pa.RecordBatch:
        entries, gone = _folded(_joined(held), length)
        return _batch(_gone_row(gone, parts) + _by_part(_bucket(entries[:2], splitters), entries, _RUNS))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids = list(zip(batch.column("i").to_pylist(), batch.column("r").to_pylist(), strict=True))
            for names, offsets, texts in _slices(ids, batch.column("t").to_pylist(), length):
                which, first, count, lead, whole = runs(texts, length, token)
                if len(which):
                    doc = np.array([i for i, _ in names], np.int64)[which]
                    row = np.array([r for _, r in names], np.int64).view(np.uint64)[which]
                    held.append([lead, whole, doc, row, first + np.array(offsets, np.int64)[which], count])
                    n += len(which)
                if n >= _FOLD:
                    yield out(held)
                    held, n = [], 0
        if n:
            yield out(held)

    return mapped


def _meet_runs(splitters: list[np.ndarray], parts: int, length: int):
    """Step 1, a bucket: ranges of equal runs, and the runs that go on to step 2."""
    edges = np.unique(splitters[0])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, removed = [], []
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                (held if kind == _RUNS else removed).append(_unpacked(blob, _RUN if kind == _RUNS else _RANGE)[0])
        if not held:
            if removed:
                yield _batch(_removed_rows(_merged(_joined(removed)), parts))
            return
        (lead, _, doc, row, first, count), gone = _folded(_joined(held), length)
        held.clear()
        gone = _merged(_joined([gone, *removed]))
        starts = np.flatnonzero(_new(lead))
        sizes = np.diff(np.append(starts, len(lead)))
        several = np.repeat(np.maximum.reduceat(doc, starts) != np.minimum.reduceat(doc, starts), sizes)
        # A token that a splitter has may be in the next bucket too, so it stays open.
        edge = np.isin(lead, edges)
        hot = edge | (several & (np.repeat(sizes, sizes) > HOT_RUNS))
        opened = [doc, row, first, first + count - 1 + length, lead, hot.astype(np.uint8)]
        some = [x[several | hot] for x in opened]
        yield _batch(_removed_rows(gone, parts) + _by_part(_home(some[0], some[1], parts), some, _OPENED))

    return mapped


class _Ranges:
    """Ranges by document."""

    def __init__(self, held: list, kinds: tuple):
        columns = _joined(held) if held else [np.zeros(0, k) for k in kinds]
        order = np.lexsort((columns[2], columns[1], columns[0]))
        self.columns = [c[order] for c in columns]
        starts = np.flatnonzero(_new(self.columns[0], self.columns[1]))
        ends = np.append(starts[1:], len(order))[: len(starts)]
        keys = zip(self.columns[0][starts].tolist(), self.columns[1][starts].tolist(), strict=True)
        self.of = dict(zip(keys, zip(starts.tolist(), ends.tolist(), strict=True), strict=True))

    def __call__(self, doc: int | None, row: int) -> list[np.ndarray]:
        a, b = self.of.get((doc, row), (0, 0))
        return [c[a:b] for c in self.columns]


def _read_batch(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(blob) as reader:
        return reader.read_next_batch()


def _map_strings(parts: int, length: int):
    """Step 2: the bytes of open runs by leading token, and the strings of hot ones."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ranges = [], None
        spans: list[tuple] = []
        strings: list[list[np.ndarray]] = []
        size = 0

        def out() -> pa.RecordBatch:
            rows = []
            if strings:
                entries, gone = _folded(_joined(strings), length)
                rows += _gone_row(gone, parts)
                rows += _by_part((_mixed(entries[0]) % _U(parts)).astype(np.int64), entries, _STRINGS)
            by: dict[int, list] = {}
            for span in sorted(spans, key=lambda x: x[0]):
                by.setdefault(int(_mixed(np.array([span[0]], np.uint64))[0] % _U(parts)), []).append(span)
            for part, some in by.items():
                lead, doc, row, first, data = zip(*some, strict=True)
                numbers = [np.array(x, k) for x, k in zip((lead, doc, row, first, [len(d) for d in data]), _SPAN, strict=True)]
                rows.append((part, _SPANS, _packed(numbers, b"".join(data))))
            return _batch(rows)

        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if kind == _OPENED:
                    held.append(_unpacked(blob, _OPEN)[0])
                    continue
                ranges = ranges or _Ranges(held, _OPEN)
                some = _read_batch(blob)
                for doc, row, text in zip(*(some.column(c).to_pylist() for c in ("i", "r", "t")), strict=True):
                    row &= (1 << 64) - 1
                    _, _, *columns = ranges(doc, row)
                    for a, b, v, hot in zip(*(c.tolist() for c in columns), strict=True):
                        if not hot:
                            spans.append((v, doc, row, a, text[a:b]))
                            size += b - a
                            continue
                        data = np.frombuffer(text, np.uint8)[a:b]
                        n = b - a - length + 1
                        strings.append(
                            [
                                _token_hashes(_CODES[data], length),
                                _token_hashes(_mixed(_CODES)[data], length),
                                np.full(n, doc, np.int64),
                                np.full(n, row, np.uint64),
                                np.arange(a, a + n),
                                np.ones(n, np.int64),
                            ]
                        )
                        size += 48 * n
                    if size >= 32 << 20:
                        yield out()
                        spans, strings, size = [], [], 0
        if spans or strings:
            yield out()

    return mapped


_SPAN = (np.uint64, np.int64, np.uint64, np.int64, np.int64)  # lead, doc, row, first, size


def equal_strings(doc: np.ndarray, first: np.ndarray, size: np.ndarray, data: bytes, length: int) -> tuple[np.ndarray, ...]:
    """(span, position) of the strings in some spans of bytes that also start in a span of a
    smaller id: all strings sorted by multikey quicksort, neighbours compared."""
    wide = np.frombuffer(data + bytes(length + 8), np.uint8).astype(np.uint64)
    two = wide[:-1] << _U(8) | wide[1:]
    four = two[:-2] << _U(16) | two[2:]
    eight = four[:-4] << _U(32) | four[4:]
    count = size - length + 1
    span = np.repeat(np.arange(len(size)), count)
    inside = np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(np.cumsum(size) - size, count) + inside
    words = [eight[at + 8 * k] for k in range(length // 8)]
    if rest := length % 8:
        words.append(eight[at + 8 * (length // 8)] >> _U(64 - 8 * rest))
    order = multikey_order([*words, doc[span]])
    span, inside = span[order], inside[order]
    owner = doc[span]
    gone = owner != _group_value(_new(*(w[order] for w in words)), owner)
    return span[gone], inside[gone]


def _meet_strings(parts: int, length: int):
    """Step 2, a bucket: ranges of strings that a smaller id has."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, strings, removed = [], [], []
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if kind == _SPANS:
                    spans.append(_unpacked(blob, _SPAN))
                elif kind == _STRINGS:
                    strings.append(_unpacked(blob, _RUN)[0])
                else:
                    removed.append(_unpacked(blob, _RANGE)[0])
        if strings:
            removed.append(_folded(_joined(strings), length)[1])
        if spans:
            lead, doc, row, first, size = _joined([s for s, _ in spans])
            data = np.frombuffer(b"".join(d for _, d in spans), np.uint8)
            begin = np.cumsum(size) - size
            spans.clear()
            # Whole leading tokens at a time, so that the strings of a few MB are in memory.
            order = np.argsort(lead, kind="stable")
            new = _new(lead[order])
            spent = np.cumsum(size[order])
            cuts, last = [0], 0
            for k in np.flatnonzero(new)[1:].tolist():
                if spent[k - 1] - last > 8 << 20:
                    cuts.append(k)
                    last = spent[k - 1]
            for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
                some = order[a:b]
                text = b"".join([data[x : x + n].tobytes() for x, n in zip(begin[some].tolist(), size[some].tolist(), strict=True)])
                span, inside = equal_strings(doc[some], first[some], size[some], text, length)
                which = some[span]
                start = first[which] + inside
                removed.append(_merged([doc[which], row[which], start, start + length]))
        if removed:
            yield _batch(_removed_rows(_merged(_joined(removed)), parts))

    return mapped


def _by_home(parts: int):
    """Documents as compressed batches, by home."""

    def out(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables)
        doc = table.column("i").fill_null(0).to_numpy().astype(np.int64)
        row = table.column("r").to_numpy().astype(np.int64).view(np.uint64)
        home = _home(doc, row, parts)
        order = np.argsort(home, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(home[order]) != 0))
        rows = []
        for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            sink = pa.BufferOutputStream()
            some = table.take(pa.array(order[a:b])).combine_chunks().to_batches()[0]
            with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(some)
            rows.append((int(home[order[a]]), _TEXT, sink.getvalue().to_pybytes()))
        return _batch(rows)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= 16 << 20:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    return mapped


def _widened(text: bytes, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges, each with all bytes of the characters at its two ends."""
    first, end = first.copy(), end.copy()
    for k in range(len(first)):
        while first[k] > 0 and text[first[k]] & 0xC0 == 0x80:
            first[k] -= 1
        while end[k] < len(text) and text[end[k]] & 0xC0 == 0x80:
            end[k] += 1
    return first, end


def _apply(batches: Iterator[pa.RecordBatch], whole_characters: bool) -> Iterator[pa.RecordBatch]:
    """Step 3: documents without their removed ranges."""
    held, ranges = [], None
    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if kind == _REMOVED:
                held.append(_unpacked(blob, _RANGE)[0])
            elif kind == _TEXT:
                ranges = ranges or _Ranges([_merged(_joined(held))] if held else [], _RANGE)
                some = _read_batch(blob)
                kept, removed, count = [], [], []
                for doc, row, text in zip(*(some.column(c).to_pylist() for c in ("i", "r", "t")), strict=True):
                    _, _, first, end = ranges(doc, row & ((1 << 64) - 1))
                    removed.append(int((end - first).sum()))
                    count.append(len(first))
                    if whole_characters:
                        first, end = _widened(text, first, end)
                    starts, stops = [0, *end.tolist()], [*first.tolist(), len(text)]
                    kept.append(b"".join([text[a:b] for a, b in zip(starts, stops, strict=True)]))
                figures = [pa.array([len(x) for x in some.column("t").to_pylist()], pa.int64())]
                figures += [pa.array(x, pa.int64()) for x in (removed, count)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("d"), *figures, pa.array(kept, pa.binary())], ["d", "n_bytes", "n_removed", "n_spans", "kept"]
                )


def suffix_dedup(
    documents: DataFrame,
    length: int = LENGTH,
    token: int = TOKEN,
    doc_id: str = "doc_id",
    text: str = "text",
    whole_characters: bool = False,
) -> DataFrame:
    """Every row of ``documents`` as ``document`` with ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept``, the remaining bytes.

    A byte goes if a string of ``length`` bytes over it also starts in a row with a smaller
    id.  Strings do not cross rows; a null text is empty.  Rows that share an id, repeated
    rows included, do not remove from each other, and each is treated alike; a row without
    an id neither loses nor removes anything.  Texts of any length are handled in slices.
    ``token`` is at most ``length`` and changes no result.  With ``whole_characters`` a character
    of which a byte goes is left out of ``kept`` wholly, so that it is valid UTF-8; the figures
    count the bytes as ever.
    """
    spark = documents.sparkSession
    parts = partitions(spark)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    key = F.col(f"`{doc_id}`").cast("long")
    repeated = bool(documents.groupBy(key.alias("i")).count().filter("`count` > 1 AND i IS NOT NULL").limit(1).count())
    row = F.xxhash64(whole) if repeated else F.lit(0).cast("long")
    named = documents.select(
        key.alias("i"), row.alias("r"), whole.cast("binary").alias("t"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("d")
    )
    texts = named.select("i", "r", "t").filter("i IS NOT NULL")
    splitters = _sampled_splitters(texts, parts, length, token)

    def met(rows: DataFrame) -> DataFrame:
        return rows.repartitionById(parts, "part")

    runs_by_bucket = texts.mapInArrow(_map_runs(splitters, parts, length, token), _ROW_SQL)
    found = staged(met(runs_by_bucket).mapInArrow(_meet_runs(splitters, parts, length), _ROW_SQL), "suffix-runs")

    bare = texts.select("i", "r", "t", F.lit(None).cast("int").alias("d")).mapInArrow(_by_home(parts), _ROW_SQL)
    opened = found.filter(F.col("kind") == _OPENED)
    strings = met(opened.union(bare)).sortWithinPartitions("kind").mapInArrow(_map_strings(parts, length), _ROW_SQL)
    more = met(strings).mapInArrow(_meet_strings(parts, length), _ROW_SQL)

    slim = [c for c in documents.columns if c != text]
    carried = named.withColumn("d", F.struct(*[F.col(f"d.`{c}`") for c in slim]) if slim else F.struct(F.lit(0).alias("_")))
    ranges = found.filter(F.col("kind") == _REMOVED).union(more)
    kind = carried.schema["d"].dataType.simpleString()
    whole_rows = carried.mapInArrow(_by_home(parts), _ROW_SQL)
    return (
        met(ranges.union(whole_rows))
        .sortWithinPartitions("kind")
        .mapInArrow(lambda batches: _apply(batches, whole_characters), f"d {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
        .withColumnRenamed("d", "document")
    )

