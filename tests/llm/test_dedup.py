"""SimHash near-dedup, suffix dedup and the pipeline, against brute force."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lacuna.llm import decontam, quality, simhash, suffix_dedup
from lacuna.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
CLASHING = "h i t r d part kind blob fp node root component_id _h _text_hash".split()


def documents(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.select("*", *[F.lit(None).cast("int").alias(c) for c in CLASHING])


# --- SimHash


def brute_print(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    found = [b" ".join(words[k : k + shingle]) for k in range(max(len(words) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(keys, near):
    """For each index the smallest index it is connected to."""
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            if near(keys[a], keys[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [find(k) for k in range(len(keys))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=5), st.lists(st.tuples(st.integers(0, 4), st.integers(0, 63)), max_size=40), st.integers(0, 5))
def test_links_connect_what_the_radius_does(seeds, flips, radius):
    values = list(seeds)
    for k, bit in flips:
        if values:
            values.append(values[-1 - k % len(values)] ^ (1 << bit))
    values = list(dict.fromkeys(values))
    want = brute_groups(values, lambda a, b: (a ^ b).bit_count() <= radius)
    links = simhash.group_links(values, radius) if len(values) > 1 else []
    assert all((a, b) != (b, a) for a, b in links) and len(links) < max(len(values), 1)
    linked = {frozenset(x) for x in links}
    assert brute_groups(values, lambda a, b: frozenset((a, b)) in linked) == want


def test_fingerprint_is_the_majority():
    for text in ("", " \n", "One two", "a b c d", "A\tb c\x0bd e f", "é ß 漢 字 x" * 20, "w " * 70_000, "a\x1cb c d e f g"):
        assert simhash.fingerprint(text.encode()) == brute_print(text)


def test_near_duplicates(spark):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(30):
        base = rng.choices(words, k=200)
        for c in range(4):
            copy = list(base)
            for _ in range(c * 2):
                copy[rng.randrange(200)] = "zz"
            rows.append((k * 4 + c, " ".join(copy)))
    rows += [(500, None), (501, ""), (502, " \t"), (None, "short one"), (503, "Short ONE"), (7, "repeated id"), (7, "repeated id")]
    rows += [(None, rows[0][1])]
    frame = documents(spark, rows)
    out = simhash.near_duplicates(frame).collect()
    prints = [brute_print(t) for _, t in rows]
    group = brute_groups(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    want = sorted((str(i), p, least.get(g)) for (i, _), p, g in zip(rows, prints, group, strict=True))
    assert sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in out) == want
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    rest = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rest) == len(set(group)) and {i for i, _ in rest} >= set(least.values())
    assert simhash.near_duplicates(frame.limit(0)).count() == 0 and simhash.keep_one(frame.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(100, 150)] + [(5, 5), (300, 301), (301, 300)]
    out = simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    of = {r.node: r.root for r in out}
    assert len(out) == len(of) == 61 + 51 + 2
    assert {of[k] for k in range(61)} == {0} and {of[k] for k in (200, *range(100, 150))} == {100} and of[301] == 300


# --- suffix dedup


def brute_cut(rows, length):
    """Per row (removed, spans, kept)."""
    data = [(i, (t or "").encode()) for i, t in rows]
    out = []
    for i, b in data:
        cover = bytearray(len(b))
        if i is not None:
            earlier = {x[p : p + length] for j, x in data if j is not None and j < i for p in range(len(x) - length + 1)}
            for p in range(len(b) - length + 1):
                if b[p : p + length] in earlier:
                    cover[p : p + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if cover[k] and not (k and cover[k - 1]))
        out.append((str(i), len(b), sum(cover), spans, bytes(c for c, x in zip(b, cover, strict=True) if not x)))
    return sorted(out)


def corpus(rng):
    passage = ["".join(rng.choices("abcdé f", k=n)) for n in (47, 50, 60, 300)]
    line = "Licensed under the one licence that everyone has.\n"
    rows = []
    for k in range(60):
        parts = ["".join(rng.choices("abcdefgh ij", k=rng.randrange(80))) for _ in range(4)]
        text = parts[0] + rng.choice(passage) + parts[1] + (line if k % 3 else "") + parts[2] + rng.choice(passage)[: rng.randrange(200)]
        rows.append((rng.randrange(50), text + parts[3]))
    rows += [(99, None), (98, ""), (97, "x" * 49), (96, "x" * 5000), (95, "x" * 50), (None, passage[3]), (None, None)]
    return rows + [rows[0], rows[1], (94, rows[0][1]), (93, "ab" * 2000), (92, "ab" * 30)]


@pytest.mark.parametrize("hot", [1, 4096])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
    monkeypatch.setattr(suffix_dedup, "_PIECE", 700)
    rows = corpus(random.Random(hot))
    out = suffix_dedup.suffix_dedup(documents(spark, rows)).collect()
    got = sorted((str(r.document.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out)
    assert got == brute_cut(rows, 50)


def test_suffix_dedup_token_and_empty(spark):
    rows = corpus(random.Random(8))[:40]
    found = [suffix_dedup.suffix_dedup(documents(spark, rows), 30, token).select("document.doc_id", "n_removed", "n_spans", "kept").collect() for token in (5, 30)]
    want = brute_cut(rows, 30)
    for out in found:
        assert sorted((str(r.doc_id), r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == sorted((a, c, d, e) for a, _, c, d, e in want)
    assert suffix_dedup.suffix_dedup(documents(spark, [])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2), st.integers(0, 2)), max_size=30))
def test_multikey_order(rows):
    keys = [np.array([r[k] for r in rows], np.uint64) for k in range(3)]
    order = suffix_dedup.multikey_order(keys) if rows else []
    assert [rows[k] for k in order] == sorted(rows)


# --- pipeline


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]

    def check(k, frame, want):
        name, stage = corpus_pipeline.STAGES[k]
        out = stage(spark, frame, SF)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
        got = sorted(tuple(r) for r in out.collect())
        assert got == sorted(want), name
        return spark.createDataFrame(got, docs.select(*corpus_pipeline.COLUMNS).schema)

    kept = {r.doc_id for r in quality.quality(docs).filter("kept").collect()}
    now = [r for r in rows if r[0] in kept]
    frame = check(0, docs, now)

    groups = brute_groups([brute_print(r[1]) for r in now], lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for r, g in zip(now, groups, strict=True):
        first[g] = min(first.get(g, r[0]), r[0])
    now = [r for r in now if r[0] in set(first.values())]
    frame = check(1, frame, now)

    cut = {int(i): (n, kept) for i, _, n, _, kept in brute_cut([r[:2] for r in now], 50)}
    left = []
    for i, text, lang, source, _ in now:
        n, rest = cut[i]
        rest = rest.decode() if n else text  # no character of this table is cut in two
        if not n or rest.strip():
            left.append((i, rest, lang, source, len(rest)))
    frame = check(2, frame, left)

    items = [decontam.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    now = [r for r in left if not any(t in decontam.normal(r[1]) for t in items)]
    frame = check(3, frame, now)
    packed = corpus_pipeline.STAGES[4][1](spark, frame, SF).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in now}
    run = QUERIES | {"pipeline": corpus_pipeline.run}
    assert sorted(tuple(r)[:5] for r in run["pipeline"](spark, SF).collect())[0][0] == min(r[0] for r in now)


def test_characters_cut_in_two_go_and_others_stay(spark):
    """Judged by character, from the removed bytes a plain search finds."""
    common = "日本語のテキスト" * 3
    texts = ["a�" + common + "b", "é" + common + "keep � this", "日" + common[1:] + "語 ü � end", "本語" + common + "�", common.replace("キ", "ギ")]
    raw = [t.encode() for t in texts]
    want = []
    for i, data in enumerate(raw):
        gone = set()
        for at in range(len(data) - 49):
            if any(data[at : at + 50] in other for other in raw[:i]):
                gone |= set(range(at, at + 50))
        left, at = "", 0
        for c in texts[i]:
            size = len(c.encode())
            if not gone & set(range(at, at + size)):
                left += c
            at += size
        want.append((i, left, "en", "s", len(left)))
    assert any("�" in w[1] and w[1] != t for w, t in zip(want, texts))
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.passage_dedup(spark, frame, SF).collect()
    assert sorted(tuple(r) for r in got) == [w for w in want if w[1].strip()]


def test_stages_take_odd_rows(spark):
    good = " ".join(f"the w{k} of" for k in range(40))
    rows = [(None, None, None, None, None), (1, good, None, None, None), (1, good, "en", None, None), (None, good + " é", None, None, 1), (2, "", "x", "y", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("extra", F.lit(1))
    for docs in (frame, frame.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.collect()
