"""Histogram sort against a plain sort of all rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lacuna.llm import sharding


def placed(frame, **how):
    found = sharding.shard(frame, **how)
    assert found.columns == ["document", "size", "shard", "slot"]
    return found.select("document.doc_id", "document.text", "size", "shard", "slot", F.xxhash64(F.coalesce("document.text", F.lit(""))).alias("h")).collect()


def assert_sorted_whole_and_even(rows, found, shards, tolerance):
    """Every row once, in key order over shards and slots, cut where a plain sort says."""
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    found = sorted(found, key=lambda r: (r.shard, r.slot))
    for k in range(shards):
        slots = [r.slot for r in found if r.shard == k]
        assert slots == list(range(len(slots)))
    keys = [(r.h, -(2**63) if r.doc_id is None else r.doc_id) for r in found]
    assert keys == sorted(keys)
    assert all(r.size == len((r.text or "").encode()) + 1 for r in found)
    below = [0]
    for r in found:
        below.append(below[-1] + r.size)
    share = below[-1] / shards
    for k in range(1, shards):
        first = next((i for i, r in enumerate(found) if r.shard >= k), len(found))
        nearest = min(abs(x - k * share) for x in below)
        assert abs(below[first] - k * share) <= max(nearest, tolerance * share)


def table(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return frame.selectExpr("*", "'x' AS shard", "1 AS slot", "2 AS size", "3 AS _hash", "'b' AS bucket")


@pytest.mark.parametrize("shards, tolerance, pieces", [(16, 0.001, None), (3, 0.2, 40), (1, 0.001, 8)])
def test_shards_are_even_consecutive_and_whole(spark, shards, tolerance, pieces):
    rng = random.Random(shards)
    rows = [(i, "é" * rng.randint(0, 40) + str(rng.random())) for i in range(600)]
    rows += [(rng.randint(0, 10**12), "a text of many copies") for _ in range(400)]
    rows += [(5, "the same row again")] * 300 + [(None, None)] * 9 + [(None, "")] * 3 + [(7, None), (-1, "x" * 5000)]
    found = placed(table(spark, rows), shards=shards, tolerance=tolerance, pieces=pieces)
    assert_sorted_whole_and_even(rows, found, shards, tolerance)


def test_one_row_repeated_fills_all_shards(spark):
    rows = [(1, "the same")] * 320
    found = placed(table(spark, rows), shards=16)
    assert_sorted_whole_and_even(rows, found, 16, 0.001)
    assert set(Counter(r.shard for r in found).values()) == {20}


def test_fewer_rows_than_shards_and_none(spark):
    assert placed(table(spark, [])) == []
    rows = [(1, "a"), (2, None)]
    assert_sorted_whole_and_even(rows, placed(table(spark, rows)), 16, 0.001)


def test_layout_does_not_matter(spark):
    rows = [(i, f"text {i % 50}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    some, other = (sorted(placed(frame.repartition(n, "doc_id"))) for n in (1, 7))
    assert some == other


def test_written_shards(spark, tmp_path):
    rows = [(i, "x" * (i % 9)) for i in range(200)]
    report = sharding.write_shards(table(spark, rows), str(tmp_path / "out"), shards=4).collect()
    assert sum(r.rows for r in report) == 200 and len(report) == 4
    again = spark.read.parquet(str(tmp_path / "out")).select("document.doc_id", "document.text").collect()
    assert Counter(map(tuple, again)) == Counter(rows)


def test_query_places_whole_texts(spark):
    from lacuna.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op13_sharding"](spark, sf).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "bytes", None)
