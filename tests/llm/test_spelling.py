"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from lacuna.llm import spelling


def one_edit(word: str, letters: str = "abcdeéßÉsx") -> set[str]:
    """Every string one edit away that uses the characters of the test words."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    deleted = {a + b[1:] for a, b in cuts if b}
    replaced = {a + c + b[1:] for a, b in cuts if b for c in letters}
    inserted = {a + c + b for a, b in cuts for c in letters}
    return (deleted | replaced | inserted) - {word}


def expected(rows: list[tuple], one_of: int) -> dict[str, tuple]:
    counts: Counter[str] = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % one_of == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    form, near = {}, {}
    for word in n:
        near[word] = [x for x in one_edit(word) if x in n]
        best = min(near[word], key=lambda x: (-n[x], x), default=None)
        form[word] = best if best and n[best] >= 2 * n[word] else None
    out = {}
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        out[word] = (n[word], len(near[word]), form[word], n.get(form[word]), root)
    return out


def corpus(seed: int, rows: int) -> list[tuple]:
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéß") for _ in range(rng.choice([4, 5, 5, 6, 7, 9]))) for _ in range(40)]
    stems += ["aaaaa", "aaaaaa", "aaaaaaa", "abababab", "ababababa"]
    out = []
    for i in range(rows):
        found = []
        for _ in range(60):
            word = rng.choice(stems)
            if rng.random() < 0.5:
                word = rng.choice(sorted(one_edit(word, "abcdeéß")))
            found.append(word.title() if rng.random() < 0.1 else word)
        out.append((i, rng.choice([" ", ", ", "\n", "1"]).join(found)))
    return out


@pytest.mark.parametrize("shard_chars", [1 << 19, 300])
def test_variants_are_those_of_brute_force(spark, shard_chars, monkeypatch):
    """Also where a half of the words is cut into blocks."""
    monkeypatch.setattr(spelling.near_words, "__defaults__", (shard_chars,))
    rows = [*corpus(1, 60), (None, "aaaaa aaaaa aaaaa"), (7, None), (8, ""), (9, "x" * 3000 + " aaaaab"), (9, "aaaaab aaaaab")]
    rows += [(10 + i, "xsxsx " * 3 + "xsxsxx " * 20 + "xsxxsxx " * 90) for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS word", "'y' AS root")
    found = spelling.variants(frame, one_of=7).collect()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found}
    assert len(found) == len(got)
    assert got == expected(rows, 7)
    assert sum(1 for x in got.values() if x[2]) > 20
    assert any(got[x[2]][2] for x in got.values() if x[2]), "no chain of forms"


def test_no_words(spark):
    for rows in ([], [(1, None), (2, ""), (3, "one two")]):
        found = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.collect() == []
        assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_searches_find_exactly_the_words_one_edit_away():
    rng = random.Random(5)
    known = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(400)})
    index = spelling.Vocabulary(known)
    for word in known[::3]:
        found = []
        for rightwards in (True, False):
            _, numbers = index.near([word], rightwards)
            assert len(set(numbers.tolist())) == len(numbers)
            found += [known[i] for i in numbers]
        want = {x for x in one_edit(word) & set(known) if len(x) > len(word) or (len(x) == len(word) and x > word)}
        assert set(found) == want
