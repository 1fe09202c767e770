"""Streams of files: large files dealt out, facts compacted, repeated batches."""

import gzip

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lacuna.operators.profile import by_field, by_value, profile_facts
from lacuna.plans.layouts import project
from lacuna.sinks.files import read_outputs
from lacuna.sources.ndjson import parse_objects, scan_lines
from lacuna.streaming import incremental
from lacuna.streaming.incremental import FactsFolder, compact_profile, ingest, ingest_profile, read_profile, stream_files


def as_rows(frame):
    return sorted(map(repr, frame.collect()))


def put(folder, name, lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress("\n".join(lines).encode(), compresslevel=1))


@pytest.fixture()
def source(tmp_path):
    folder = tmp_path / "in"
    for day in range(6):
        put(folder, f"day={day}/part-0.gz", [f'{{"id":"{day}-{i}","gender":"{"mf"[i % 2]}","x":null}}' for i in range(5)])
    return folder


def test_one_large_file_of_a_batch_uses_all_cores(spark, tmp_path, monkeypatch):
    import lacuna.sources.ndjson as ndjson

    folder = tmp_path / "in"
    put(folder, "large.gz", [f'{{"id":"large-{i}"}}' for i in range(9000)])
    for k in range(10):
        put(folder, f"small{k}.gz", [f'{{"id":"{k}-{i}"}}' for i in range(100)])
    monkeypatch.setattr(ndjson, "SMALL_FILE", 1000)
    out = str(tmp_path / "out")
    files = stream_files(spark, str(folder))

    def transform(lines):
        return project(lines, ["id"], keep=["file_name"]).withColumn("task", F.spark_partition_id())

    ingest(files, transform, out, str(tmp_path / "checkpoint")).awaitTermination()
    rows = read_outputs(spark, out)
    assert rows.select("id").distinct().count() == rows.count() == 10_000
    assert rows.where("file_name = 'large.parquet'").select("task").distinct().count() >= spark.sparkContext.defaultParallelism
    assert rows.where("file_name LIKE 'small%'").groupBy("file_name").agg(F.count_distinct("task").alias("n")).where("n > 1").isEmpty()


def test_files_of_one_name_arrive_once_each(spark, source, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        files = stream_files(spark, f"{source}/*", files_per_batch=2)
        ingest(files, lambda x: project(x, ["id"], keep=["file_name"]), out, checkpoint).awaitTermination()
        return {r.file_name: r["count"] for r in read_outputs(spark, out).groupBy("file_name").count().collect()}

    want = {f"day={day}/part-0.parquet": 5 for day in range(6)}
    assert run() == want
    put(source, "day=9/part-0.gz", ['{"id":"new"}'])
    assert run() == want | {"day=9/part-0.parquet": 1}


@pytest.mark.parametrize("every", [1, 2, 100])
def test_profile_is_that_of_all_files_however_often_compacted(spark, source, tmp_path, every):
    out, checkpoint = str(tmp_path / "facts"), str(tmp_path / "checkpoint")

    def run():
        files = stream_files(spark, f"{source}/*", files_per_batch=1)
        ingest_profile(files, out, checkpoint, compact_every=every).awaitTermination()
        facts = read_profile(spark, out)
        return as_rows(by_field(facts)), as_rows(by_value(facts))

    def batch():
        facts = profile_facts(parse_objects(scan_lines(spark, f"{source}/*/*.gz")), incremental.VALUE_FIELDS)
        return as_rows(by_field(facts)), as_rows(by_value(facts))

    assert run() == batch()
    found = FactsFolder.read(spark, out)
    assert len(found.batches) <= every + 1
    for day in (7, 8, 9):
        put(source, f"day={day}/part-0.gz", [f'{{"id":"{day}","gender":"f"}}'])
    assert run() == batch()
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_profile(stream_files(spark, str(source)), out, str(tmp_path / "other"))


def write_batches(folder, numbers):
    for n in numbers:
        (folder / f"batch={n}").mkdir(parents=True)
        row = {"file_name": [f"f{n % 7}"], "field": ["a"], "value": [None], "objects": [1], "present": [1], "null": [n % 2], "empty": [0]}
        schema = pa.schema([(c, pa.string() if c in ("file_name", "field", "value") else pa.int64()) for c in row])
        pq.write_table(pa.table(row, schema), folder / f"batch={n}" / "part-0.parquet")


def test_a_thousand_batches_are_read_from_a_few_folders(spark, tmp_path):
    out = tmp_path / "facts"
    write_batches(out, range(1000))
    want = as_rows(by_field(read_profile(spark, str(out))))
    during = by_field(read_profile(spark, str(out)))  # planned before, read after
    compact_profile(spark, str(out), 998)
    assert as_rows(by_field(read_profile(spark, str(out)))) == want == as_rows(during)
    assert len(FactsFolder.read(spark, str(out)).paths()) == 2
    write_batches(out, range(1000, 1003))
    compact_profile(spark, str(out), 1001)
    assert sorted(p.name for p in out.iterdir()) == ["batch=1000", "batch=1001", "batch=1002", "batch=999", "generation=1001", "generation=998"]
    compact_profile(spark, str(out), 1002)
    assert sorted(p.name for p in out.iterdir()) == ["batch=1002", "generation=1001", "generation=1002"]
    total = by_field(read_profile(spark, str(out))).first()
    assert (total.present, total.null) == (1003, 501)


def test_a_generation_that_is_not_whole_does_not_count(spark, tmp_path):
    out = tmp_path / "facts"
    write_batches(out, range(5))
    want = as_rows(by_field(read_profile(spark, str(out))))
    compact_profile(spark, str(out), 3)
    (out / "generation=3" / "_SUCCESS").unlink()  # as a run leaves it that ended before
    assert as_rows(by_field(read_profile(spark, str(out)))) == want
    compact_profile(spark, str(out), 3)
    assert as_rows(by_field(read_profile(spark, str(out)))) == want
    assert FactsFolder.read(spark, str(out)).upto == 3


def test_a_repeated_batch_counts_once(spark, source, tmp_path, monkeypatch):
    """A batch fails after its facts, or those of a merge, are written, and is run again."""
    out, checkpoint = str(tmp_path / "facts"), str(tmp_path / "checkpoint")
    merge = incremental.compact_profile
    failures = iter(["after", "before"])

    def failing(*args):
        kind = next(failures, None)
        if kind != "before":
            merge(*args)
        if kind:
            raise RuntimeError(f"lost {kind} the merge")

    monkeypatch.setattr(incremental, "compact_profile", failing)
    for attempt in range(3):
        query = ingest_profile(stream_files(spark, f"{source}/*", 1), out, checkpoint, compact_every=1)
        if attempt < 2:
            with pytest.raises(Exception, match="the merge"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    facts = read_profile(spark, out)
    want = by_field(profile_facts(parse_objects(scan_lines(spark, f"{source}/*/*.gz"))))
    assert as_rows(by_field(facts)) == as_rows(want)


def test_no_batches(spark, tmp_path):
    with pytest.raises(ValueError, match="no batches"):
        read_profile(spark, str(tmp_path / "none"))
