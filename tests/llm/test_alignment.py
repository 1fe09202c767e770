"""Alignment of two tokenizers against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lacuna.llm import alignment

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain_tokens(text: str) -> tuple[list, list]:
    """(id, bytes) of all tokens, without the operator's code."""
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    found = library.encode(f" {text}", add_special_tokens=False)
    raw = f" {text}".encode()
    chars = {}
    other = 256
    for byte in range(256):
        if 33 <= byte < 127 or 161 <= byte < 173 or 174 <= byte:
            chars[chr(byte)] = byte
        else:
            chars[chr(other)] = byte
            other += 1
    names = [library.id_to_token(i) for i in found.ids]
    a = [(i, bytes(chars[c] for c in t)) for i, t in zip(found.ids, names)]
    pieces = SentencePieceProcessor(model_file=B)
    b = []
    for i in pieces.encode(text):
        t = pieces.id_to_piece(i)
        b.append((i, bytes([int(t[3:5], 16)]) if pieces.is_byte(i) else t.replace("▁", " ").encode()))
    if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
        return [], []
    return a, b


def groups_of(a: list, b: list) -> list[tuple[list, list]]:
    def ends(tokens):
        at, out = 0, []
        for _, t in tokens:
            at += len(t)
            out.append(at)
        return out

    both = set(ends(a)) & set(ends(b))
    out = []
    for k, tokens in enumerate((a, b)):
        number = 0
        for (i, _), end in zip(tokens, ends(tokens)):
            if number == len(out):
                out.append(([], []))
            out[number][k].append(i)
            number += end in both
    return out


def expected(texts: list) -> list[tuple]:
    found = [groups_of(*plain_tokens(t)) if t else [] for t in texts]
    links = [[(x, y) for a, b in groups for x in a for y in b] for groups in found]
    count = Counter(pair for each in links for pair in set(each))
    highest: dict = {}
    for (x, _), n in count.items():
        highest[x] = max(n, highest.get(x, 0))
    out = []
    for groups, each in zip(found, links):
        spelled = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(count[p] == highest[p[0]] for p in each)
        sizes = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(each))
        out.append((*sizes, best, sum(count[p] for p in each), spelled))
    return out


def corpus() -> list:
    rng = random.Random(3)
    words = "the of naïve 日本語 transformations l'été 3.14159 😀 x y <s> <|endoftext|> ﬁne Á \x00 ▁ aaaaaaaaaaaaaaaaaaaa".split(" ")
    texts: list = [None, "", " ", "\n", "  leading", "trailing  ", "a\r\n\tb", "<s>", "<|endoftext|>", "▁", "▁a", "﻿"]
    texts += [rng.choice(["", " ", "\n"]).join(rng.choice(words) + rng.choice([" ", "  ", "\n ", ", "]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += [texts[-1], texts[-1], "z" * 3000, " " * 2000 + "x" * 500, "日本" * 900]
    return texts


@pytest.mark.parametrize("piece", [alignment.PIECE, 16, 5])
def test_alignment_is_that_of_brute_force(spark, piece):
    """Also where long texts are cut into many pieces, with groups over several of them."""
    texts = corpus()
    rows = [(i % 70 if i % 70 else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS groups", "2 AS doc")
    found = alignment.align(frame, piece=piece).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, *(r[f] for f in alignment.FIGURES), r.groups) for r in found)
    want = sorted((-1 if i is None else i, *x) for (i, _), x in zip(rows, expected(texts)))
    assert got == want


def test_wide_groups_count_by_distinct_ids(monkeypatch):
    rng = np.random.default_rng(1)
    groups = [(rng.integers(0, 9, n, np.uint32), rng.integers(0, 5, m, np.uint32)) for n, m in [(1, 1), (40, 60), (3, 2), (2, 700)]]
    wide = [x.tolist() for x in alignment._expanded(groups)]
    monkeypatch.setattr(alignment, "WIDE", 1 << 30)
    assert wide == [x.tolist() for x in alignment._expanded(groups)]


def test_diagonals_cut_equal_pieces_and_part_no_equal_ends():
    rng = random.Random(2)
    for _ in range(200):
        a, b = (np.array(sorted(rng.sample(range(1, 80), rng.randint(1, 60))), np.int64) for _ in range(2))
        piece = rng.randint(2, 9)
        cuts = alignment.diagonals(a, b, piece)
        assert cuts[0] == (0, 0) and cuts[-1] == (len(a), len(b))
        merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        for k, (i, j) in enumerate(cuts[1:-1], 1):
            assert k * piece <= i + j <= k * piece + 1
            front = merged[: i + j]
            assert sum(1 for _, of in front if of == 0) == i
            assert not (i and j < len(b) and a[i - 1] == b[j])


def test_no_documents(spark):
    found = alignment.align(spark.createDataFrame([], "doc_id long, text string"))
    assert found.collect() == []
    none = alignment.align(spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in none] == [(1, 0, 0, 0, 0, 0, 0, "")] * 2
