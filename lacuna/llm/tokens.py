"""Token ids of whole texts, as the tokenizers library gives them, at the speed of a cache.

A byte-pair tokenizer treats each pre-token by itself, and none of those known here
reaches over white space.  So a text is cut at white space, the ids of chunks and of
pre-tokens met before are looked up, and only new pre-tokens go to the library's model.
Texts the cut does not suit go through the library whole.  Many texts at once are cut
and looked up by different word, and their new words go to the model together.
"""

from __future__ import annotations

import json
import re
from array import array
from contextlib import suppress
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

#: Chunks, and pre-tokens, remembered by one Python worker.
REMEMBERED = 400_000

# Python counts these four as white space, the library does not.
_ODD = re.compile("[\x1c-\x1f]")
# Marks that form one pre-token when they end a word.
_MARKS = ".,;:!?*#$%&|<>()[]{}+-=/"
# Byte-level models write bytes as characters: printable ones as they are, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}
_BYTE_TABLE = np.array([_BYTE_CHARS.get(b, b) for b in range(256)], "<u2")
# Letters below U+0250: composed already.
_PLAIN = "^[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"
# Where a long text may be cut: a space between two words begins a chunk.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_PART = 1 << 20
# So many new words go to the model in one call.
_TOGETHER = 20_000
_LEADING_SPACE = re.compile(r" ?\S+|\s+(?!\S)|\s+")


class _NotBetweenWords(Exception):
    """A space of the text does not stand between two words."""


def _byte_chars(piece: str) -> str:
    """The piece as a byte-level model writes it."""
    if piece.isascii() and piece.removeprefix(" ").isalpha():
        return piece.replace(" ", "\u0120")
    return piece.encode().decode("latin-1").translate(_BYTE_CHARS)


class _Entries:
    """Numbered runs of ids, of which texts are put together; entry 0 is empty."""

    def __init__(self, dtype: np.dtype):
        self.dtype, self.n = dtype, 0
        self.parts: list[bytes] = []
        self.sizes: list[np.ndarray] = []
        self.add([b""])

    def add(self, ids: list[bytes]) -> np.ndarray:
        """The numbers of these entries."""
        return self.add_sized(b"".join(ids), np.fromiter(map(len, ids), np.int32, len(ids)) // self.dtype.itemsize)

    def add_sized(self, raw: bytes, sizes: np.ndarray) -> np.ndarray:
        """The numbers of entries that stand back to back."""
        self.parts.append(raw)
        self.sizes.append(sizes.astype(np.int32, copy=False))
        self.n += len(sizes)
        return np.arange(self.n - len(sizes), self.n, dtype=np.int32)

    def joined(self, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids of these entries back to back, and where each ends in bytes."""
        sizes = np.concatenate(self.sizes)
        counts = sizes[numbers]
        ends = np.cumsum(counts, dtype=np.int32)  # an Arrow array of strings has fewer bytes, and ids
        source = np.repeat((np.cumsum(sizes, dtype=np.int32) - sizes)[numbers] - (ends - counts), counts)
        source += np.arange(len(source), dtype=np.int32)
        return np.frombuffer(b"".join(self.parts), self.dtype)[source].tobytes(), ends.astype(np.int64) * self.dtype.itemsize


class CachedEncoder:
    """``ids(text)``: what ``Tokenizer.encode(text, add_special_tokens=False).ids`` gives."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as file:
            content = file.read()
        setup = json.loads(content)
        self.tokenizer = Tokenizer.from_str(content)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._code = "H" if self.size <= 1 << 16 else "I"
        self._space = ""
        self._model = self.tokenizer.model
        self._normal = self.tokenizer.normalizer
        self._pre = self.tokenizer.pre_tokenizer
        self._added = [x["content"] for x in setup["added_tokens"]]
        self._room = remembered
        self._pieces: dict[str, bytes] = {}
        outer = self

        class Chunks(dict):
            def __missing__(self, chunk: str) -> bytes:
                found = outer._chunk(chunk)
                if len(self) < outer._room:
                    self[chunk] = found
                return found

        class Spaced(dict):
            """The ids of what follows a space, that space included."""

            def __missing__(self, rest: str) -> bytes:
                runs = rest.split()
                if not runs or rest[0].isspace() or rest[-1].isspace():
                    raise _NotBetweenWords
                if len(runs) > 1:  # other white space inside: seldom met again
                    return b"".join([outer._chunks[x] for x in _LEADING_SPACE.findall(" " + rest)])
                found = outer._chunk(" " + rest)
                if len(self) < outer._room:
                    self[rest] = found
                return found

        self._chunks = Chunks()
        self._spaced = Spaced()
        self._cut = self._cutter(setup)
        self._words: Tokenizer | None = None
        if self._space:  # no id but a word's first begins with a space
            self._words = Tokenizer(self._model)
            self._words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self._begins = np.zeros(self.size, bool)
            self._begins[[i for piece, i in self.tokenizer.get_vocab().items() if piece[0] == "\u0120"]] = True

    def _cutter(self, setup: dict):
        """How to cut texts for this tokenizer; None if no cut is known to be safe."""
        plain = not any(x["lstrip"] or x["rstrip"] or re.search(r"\s", x["content"]) for x in setup["added_tokens"])
        pre = setup["pre_tokenizer"] or {}
        if not plain or setup["model"]["type"] != "BPE" or setup.get("post_processor"):
            return None
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not self._normal:
            self._space = " "
            return _LEADING_SPACE.findall
        steps = pre.get("pretokenizers", [])
        if (
            [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and r"[^\s\p{L}\p{N}]+" in steps[0]["pattern"].get("Regex", "")
            and " " not in steps[0]["pattern"]["Regex"]
            and not steps[1]["use_regex"]
            and not steps[1]["add_prefix_space"]
        ):
            return str.split  # white space never becomes a token
        return None

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        core = chunk.rstrip(_MARKS)
        if chunk.isascii() or max(chunk) < "\u0250":  # composed already; letters have one lower case each
            word = core.lower() if self._normal else core
            if word.removeprefix(self._space).isalpha():
                if word == chunk:  # the caller remembers it
                    return self._pieces.get(word) or self._mapped(_byte_chars(word))
                found = self._piece(word)
                return found + self._piece(chunk[len(core) :]) if len(core) < len(chunk) else found
        if any(x in chunk for x in self._added):
            return self._whole(chunk)
        if self._normal:
            chunk = self._normal.normalize_str(chunk)
        return b"".join([self._mapped(piece) for piece, _ in self._pre.pre_tokenize_str(chunk)])

    def _piece(self, piece: str) -> bytes:
        found = self._pieces.get(piece)
        if found is None:
            known = self._spaced.get(piece[1:]) if piece[:1] == " " else self._chunks.get(piece)
            if known is not None:
                return known
            found = self._mapped(_byte_chars(piece))
            if len(self._pieces) < self._room:
                self._pieces[piece] = found
        return found

    def _mapped(self, piece: str) -> bytes:
        return array(self._code, [x.id for x in self._model.tokenize(piece)]).tobytes()

    def bytes(self, text: str) -> bytes:
        """The ids as little-endian integers of ``dtype``."""
        if self._cut is None or _ODD.search(text):
            return self._whole(text)
        if self._space and len(text) <= _PART:
            first, *rest = text.split(" ")
            try:
                if first and not first[-1].isspace():
                    begin = [self._chunks[x] for x in self._cut(first)]
                    return b"".join([*begin, *map(self._spaced.__getitem__, rest)])
            except _NotBetweenWords:
                pass
        out, at = [], 0
        while len(text) - at > _PART and (space := _BETWEEN.search(text, at + _PART)):
            out += [self._chunks[x] for x in self._cut(text[at : space.start()])]
            at = space.start()
        return b"".join([*out, *map(self._chunks.__getitem__, self._cut(text[at:] if at else text))])

    def many(self, texts: pa.Array) -> list[bytes]:
        """``bytes`` of each text; a null text is empty."""
        texts = pc.fill_null(texts, "")
        if not self._words or not len(texts):
            return [self.bytes(t) for t in texts.to_pylist()]
        cut = pc.split_pattern(pc.if_else(pc.greater(pc.binary_length(texts), _PART), "", texts), " ")
        words, bounds = cut.flatten(), np.cumsum([0, *pc.list_value_length(cut).to_numpy()])
        coded, first = words.dictionary_encode(), bounds[:-1]
        entries = _Entries(self.dtype)
        at = coded.indices.to_numpy()
        word, marks = self._after_space(coded.dictionary, np.bincount(at, minlength=len(coded.dictionary)), entries)
        runs = np.stack([word[at], marks[at]], axis=1)
        # A text with other white space beside a space, and an empty or long one, goes by itself.
        heads = words.take(pa.array(first)).to_pylist()
        runs[first, 0] = [-(not x or x[-1].isspace()) for x in heads]
        apart = np.minimum.reduceat(runs[:, 0], first) < 0
        begin = [b"" if x else b"".join([self._chunks[c] for c in self._cut(h)]) for x, h in zip(apart, heads, strict=True)]
        runs[first] = np.stack([entries.add(begin), np.zeros(len(begin), np.int32)], axis=1)
        raw, ends = entries.joined(np.maximum(runs, 0).ravel())
        stops = ends[2 * bounds[1:] - 1].tolist()
        return [
            self.bytes(texts[k].as_py()) if x else raw[a:b]
            for k, (x, (a, b)) in enumerate(zip(apart.tolist(), pairwise([0, *stops]), strict=True))
        ]

    def _after_space(self, words: pa.Array, times: np.ndarray, entries: _Entries) -> tuple[np.ndarray, np.ndarray]:
        """For each of these different words with the space before it, the entry of its ids
        and that of the marks at its end; -1 if white space begins or ends it, or it is
        empty or odd."""
        cores = pc.ascii_rtrim(words, _MARKS)
        plain = pc.match_substring_regex(cores, _PLAIN).to_numpy(zero_copy_only=False)
        word, marks = np.full(len(words), -1, np.int32), np.zeros(len(words), np.int32)

        coded = cores.filter(pa.array(plain)).dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self._spaced.get, different))
        new = np.array([x is None for x in found], bool)
        at = coded.indices.to_numpy()
        again = np.bincount(at, times[plain], len(different))[new] > 1
        number = np.zeros(len(different), np.int32)
        number[~new] = entries.add([x for x in found if x is not None])
        number[new] = self._modelled([w for w, x in zip(different, found, strict=True) if x is None], again, entries)
        word[plain] = number[at]

        n_marks = pc.subtract(pc.binary_length(words), pc.binary_length(cores)).to_numpy()
        marked = np.flatnonzero(plain & (n_marks > 0))
        ends = [w[-n:] for w, n in zip(words.take(pa.array(marked)).to_numpy(zero_copy_only=False), n_marks[marked].tolist(), strict=True)]
        known = sorted(set(ends))
        of = dict(zip(known, entries.add([self._piece(x) for x in known]).tolist(), strict=True))
        marks[marked] = [of[x] for x in ends]

        rest = np.flatnonzero(~plain)
        ids = [self._other(x) for x in words.take(pa.array(rest)).to_pylist()]
        fit = np.array([x is not None for x in ids], bool)
        word[rest[fit]] = entries.add([x for x in ids if x is not None])
        return word, marks

    def _other(self, word: str) -> bytes | None:
        """The ids of what follows a space and of that space; None if its text is to go by itself."""
        head, _, tail = word.partition("\n")
        if tail and word.split() == [head, tail] and not _ODD.search(word):  # a word that begins a line is a chunk
            return b"".join([self._spaced[head], self._chunks["\n"], self._chunks[tail]])
        if not _ODD.search(word):
            with suppress(_NotBetweenWords):
                return self._spaced[word]
        return None

    def _modelled(self, words: list[str], again: np.ndarray, entries: _Entries) -> np.ndarray:
        """Entries of the ids of new plain words and the space before each, by the model; half
        of the room is for any, all of it for those met ``again``."""
        numbers = [np.zeros(0, np.int32)]
        for start in range(0, len(words), _TOGETHER):
            some = words[start : start + _TOGETHER]
            written = _BYTE_TABLE[np.frombuffer(f" {' '.join(some)}".encode(), np.uint8)].tobytes().decode("utf-16-le")
            found = self._words.encode_batch_fast([written.replace("\u0120", " \u0120")], add_special_tokens=False)[0]
            ids = np.array(found.ids, self.dtype)
            at = np.flatnonzero(self._begins[ids])
            if len(at) != len(some):  # the model leaves out or joins what it does not know
                numbers.append(entries.add([self._mapped(_byte_chars(" " + w)) for w in some]))
                continue
            at = np.append(at, len(ids))
            raw = ids.tobytes()
            numbers.append(entries.add_sized(raw, np.diff(at)))
            repeated = again[start : start + _TOGETHER] | (len(self._spaced) < self._room // 2)
            kept = np.flatnonzero(repeated)[: max(self._room - len(self._spaced), 0)]
            cuts = at * self.dtype.itemsize
            for k, a, b in zip(kept.tolist(), cuts[kept].tolist(), cuts[kept + 1].tolist(), strict=True):
                self._spaced[some[k]] = raw[a:b]
        return np.concatenate(numbers)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.bytes(text), self.dtype)


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """One encoder for each file and Python worker, kept for its next tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]
