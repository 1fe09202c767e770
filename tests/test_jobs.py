"""End-to-end programs on gzip files, batch and incremental."""

import gzip

import pyarrow.parquet as pq
import pytest

from lacuna.operators.clean import clean_records
from lacuna.operators.profile import by_field, profile_facts, profile_fields
from lacuna.plans.jobs import (
    clean_job,
    clean_with_totals,
    convert_job,
    converted_rows,
    phone_job,
    profile_job,
    run_by_file,
)
from lacuna.plans.layouts import WIDE, project
from lacuna.scratch import new_folder, shared_root
from lacuna.sinks.files import place, remove, staging, write_clean_lines
from lacuna.sources.inputs import listing
from lacuna.sources.ndjson import parse_objects, scan_lines, spread_lines, stream_lines
from lacuna.streaming.incremental import ingest, ingest_profile, read_profile

FILES = {
    "a.gz": ['{"id":"1","gender":"m","mobile_phone":"+1","summary":null}', '{"id":null}', "bad", ""],
    "b.gz": ['{"id":"2","gender":"f","emails":[]}', "[1,null]", '{"id":"3","birth_year":1980}'],
}


@pytest.fixture()
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, lines in FILES.items():
        (folder / name).write_bytes(gzip.compress("\n".join(lines).encode()))
    return folder


def names(folder):
    """Files a run has left, below the folder, but for the checksums of the local file system."""
    found = (str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())
    return sorted(x for x in found if not x.rsplit("/", 1)[-1].startswith("."))


def as_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_clean(spark, source, tmp_path):
    out = tmp_path / "out"
    assert as_rows(clean_job(spark, str(source), str(out))) == [("a.gz", 2, 2), ("b.gz", 3, 2)]
    assert names(out) == ["a.gz", "b.gz"]
    assert gzip.decompress((out / "b.gz").read_bytes()).count(b"\n") == 3
    assert as_rows(scan_lines(spark, str(out))) == [
        ("a.gz", '{"gender":"m","id":"1","mobile_phone":"+1"}'),
        ("b.gz", "[1]"),
        ("b.gz", '{"birth_year":1980,"id":"3"}'),
        ("b.gz", '{"gender":"f","id":"2"}'),
    ]


def test_clean_with_totals(spark, source, tmp_path):
    totals = clean_with_totals(spark, str(source), str(tmp_path / "out"))
    assert totals == {"rows_processed": 5, "fields_removed": 4}
    assert names(tmp_path / "out") == ["a.gz", "b.gz"]


def test_convert_wide(spark, source, tmp_path):
    out = str(tmp_path / "out")
    want = [("a.parquet", 2), ("b.parquet", 2)]
    assert as_rows(convert_job(spark, str(source), out)) == want
    assert as_rows(convert_job(spark, str(source), out)) == want  # replaces, does not append
    table = spark.read.parquet(out)
    assert table.columns == [c.partition(":")[0] for c in WIDE]
    assert table.where("birth_year = 1980").first().id == "3"
    assert names(tmp_path / "out") == ["a.parquet", "b.parquet"]
    footer = pq.ParquetFile(tmp_path / "out" / "a.parquet").metadata
    assert footer.row_group(0).column(0).compression == "ZSTD"
    assert as_rows(converted_rows(spark, out)) == want


def test_convert_narrow(spark, source, tmp_path):
    report = convert_job(spark, str(source), str(tmp_path / "out"), "narrow_strings")
    assert as_rows(report) == [("a.parquet", 2), ("b.parquet", 2)]


def test_profile(spark, source, tmp_path):
    reports = profile_job(spark, str(source), str(tmp_path / "out"))
    assert as_rows(reports["by_value"]) == [("gender", "f", 1), ("gender", "m", 1)]
    files = reports["by_file"].select("file_name", "objects", "total_fields", "null_or_empty")
    assert as_rows(files) == [("a.gz", 2, 5, 2), ("b.gz", 2, 5, 1)]
    assert list((tmp_path / "out" / "value_distributions" / "document").glob("part-*"))


def test_phone_lines_stay_as_they_are(spark, source, tmp_path):
    phone_job(spark, str(source), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text == FILES["a.gz"][0] + "\n"


def test_unreadable_files_stand_alone(spark, source, tmp_path):
    whole = gzip.compress(b"".join(b'{"id":"%d"}\n' % i for i in range(100000)))
    (source / "cut.gz").write_bytes(whole[: len(whole) // 2])
    paths = [str(source / name) for name in ("a.gz", "cut.gz", "b.gz", "gone.gz")]
    out = str(tmp_path / "out")
    status = run_by_file(spark, paths, lambda group: convert_job(spark, group, out))
    rows = {r.file_name: r for r in status.collect()}
    assert {name: r.success for name, r in rows.items()} == {
        "a.gz": True, "b.gz": True, "cut.gz": False, "gone.gz": False,
    }
    assert rows["gone.gz"].error and rows["a.gz"].error is None
    assert spark.read.parquet(out).count() == 4


def test_a_fault_of_the_job_is_raised(spark):
    def broken(group):
        raise RuntimeError("no such column")

    with pytest.raises(RuntimeError):
        run_by_file(spark, [f"{i}.gz" for i in range(50)], broken)


def test_every_file_has_a_status(spark, source):
    """More than a hundred unreadable files, and the good ones run about once."""
    paths = [str(source / f"gone{i}.gz") for i in range(120)]
    paths[60:60] = [str(source / "a.gz")]
    seen = []

    def job(group):
        seen.append(len(group))
        bad = [path for path in group if "gone" in path]
        if bad:
            raise RuntimeError(f"cannot read file:{bad[0]}, no such file")

    rows = run_by_file(spark, paths, job, group_size=10).collect()
    assert len(rows) == 121 and [r.file_name for r in rows if r.success] == ["a.gz"]
    assert len(seen) <= 121 + 13


def test_outputs_are_replaced_and_only_those(spark, source, tmp_path):
    (source / "empty.gz").write_bytes(gzip.compress(b""))
    (source / "bad.gz").write_bytes(gzip.compress(b"nope\n{\n"))
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        out = str(tmp_path / mode)
        report = as_rows(clean_job(spark, str(source), f"{out}/clean"))
        assert report == [("a.gz", 2, 2), ("b.gz", 3, 2), ("bad.gz", 0, 0), ("empty.gz", 0, 0)]
        (source / "a.gz").write_bytes(gzip.compress(b'{"id":null}\n'))
        assert as_rows(clean_job(spark, str(source / "a.gz"), f"{out}/clean")) == [("a.gz", 1, 1)]
        assert {r[0] for r in as_rows(scan_lines(spark, f"{out}/clean"))} == {"b.gz"}
        want = [("a.parquet", 1), ("b.parquet", 2), ("bad.parquet", 0), ("empty.parquet", 0)]
        assert as_rows(convert_job(spark, str(source), f"{out}/wide")) == want
        (source / "a.gz").write_bytes(gzip.compress(b"[]\n"))
        assert as_rows(convert_job(spark, str(source / "a.gz"), f"{out}/wide")) == [("a.parquet", 0)]
        assert spark.read.parquet(f"{out}/wide").count() == 2
        nothing = convert_job(spark, str(source / "empty.gz"), f"{out}/none")
        assert as_rows(nothing) == [("empty.parquet", 0)]
        (source / "a.gz").write_bytes(gzip.compress("\n".join(FILES["a.gz"]).encode()))
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


@pytest.fixture()
def days(tmp_path):
    """Inputs of one name in three folders: 1, 2 and 0 objects; a name that needs escapes."""
    rows = {"day=1/part-0.gz": 1, "day=2/part-0.gz": 2, "x y%20+é/part-0.gz": 0}
    for name, n in rows.items():
        path = tmp_path / "days" / name
        path.parent.mkdir(parents=True)
        path.write_bytes(gzip.compress(b'{"id":"1","gender":"m","none":null}\n' * n))
    return tmp_path / "days"


KEYS = ["day=1/part-0.gz", "day=2/part-0.gz", "x y%20+é/part-0.gz"]


def test_inputs_of_one_name_are_kept_apart(spark, days, tmp_path):
    paths = f"{days}/*/*.gz"
    assert as_rows(scan_lines(spark, paths).select("file_name")) == [(KEYS[0],), (KEYS[1],), (KEYS[1],)]
    out = tmp_path / "out"
    for _ in range(2):  # a second run replaces the outputs of the first
        report = as_rows(clean_job(spark, paths, str(out / "clean")))
        assert report == [(KEYS[0], 1, 1), (KEYS[1], 2, 2), (KEYS[2], 0, 0)]
        assert names(out / "clean") == KEYS[:2]
        parquet = [key.replace(".gz", ".parquet") for key in KEYS]
        converted = as_rows(convert_job(spark, paths, str(out / "wide")))
        assert converted == [(parquet[0], 1), (parquet[1], 2), (parquet[2], 0)]
        assert names(out / "wide") == parquet[:2]
        assert as_rows(converted_rows(spark, str(out / "wide"))) == [(parquet[0], 1), (parquet[1], 2)]
    assert as_rows(scan_lines(spark, f"{out}/clean/*/*.gz").groupBy("file_name").count()) == [(KEYS[0], 1), (KEYS[1], 2)]


def test_profile_of_inputs_of_one_name(spark, days, tmp_path):
    reports = profile_job(spark, f"{days}/*/*.gz", str(tmp_path / "out"))
    assert as_rows(reports["by_file"].select("file_name", "objects")) == [(KEYS[0], 1), (KEYS[1], 2), (KEYS[2], 0)]
    assert reports["overall"].first().files == 3


def test_groups_of_inputs_of_one_name(spark, days, tmp_path):
    """Each file alone in its group still has the key it has among all."""
    out = str(tmp_path / "out")
    paths = [f"{days}/{key}" for key in KEYS] + [f"{days}/day=3/part-0.gz"]
    for size in (1, 4):
        status = run_by_file(spark, paths, lambda group: convert_job(spark, group, out), group_size=size)
        want = [(key, True) for key in KEYS]
        assert as_rows(status.select("file_name", "success")) == sorted([*want, ("day=3/part-0.gz", False)])
        assert sum(r.rows for r in converted_rows(spark, out).collect()) == 3


def test_keys_from_a_given_root(spark, days, tmp_path):
    """A later run over one folder only does not take the place of another's outputs."""
    out = tmp_path / "out"
    clean_job(spark, f"{days}/day=1", str(out), root=str(days))
    clean_job(spark, f"{days}/day=2", str(out), root=str(days))
    assert names(out) == KEYS[:2]


def test_parts_of_an_input_are_one_input(spark, tmp_path):
    """What several tasks wrote lies side by side, is replaced together and read as one."""
    source = tmp_path / "in"
    source.mkdir()
    lines = [f'{{"id":"{i}"}}' for i in range(3000)]
    (source / "big.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    (source / "small.gz").write_bytes(gzip.compress(b'{"id":"x"}\n'))
    found = listing(spark, str(source), names=True)
    out = tmp_path / "out"
    for pieces in (6, 2):
        run = staging(str(out))
        spread = spread_lines(scan_lines(spark, found), pieces)
        write_clean_lines(clean_records(spread), run)
        place(spark, run, str(out), found.names, ".gz")
        remove(spark, run)
        left = [x for x in names(out) if x.startswith("big.gz")]
        assert left[0] == "big.gz" and 1 < len(left) <= 2 * pieces
        assert as_rows(scan_lines(spark, str(out)).groupBy("file_name").count()) == [("big.gz", 3000), ("small.gz", 1)]
    assert listing(spark, str(out), names=True).names == ["big.gz", "small.gz"]
    assert as_rows(convert_job(spark, str(out), str(tmp_path / "wide"))) == [("big.parquet", 3000), ("small.parquet", 1)]


def test_stream_keys_start_at_the_folder(spark, days):
    table = stream_lines(spark, f"{days}/*").writeStream.format("memory").queryName("stream_keys")
    table.trigger(availableNow=True).start().awaitTermination()
    assert {r.file_name for r in spark.table("stream_keys").collect()} == set(KEYS[:2])


def test_files_without_records_are_profiled(spark, source, tmp_path):
    (source / "empty.gz").write_bytes(gzip.compress(b""))
    (source / "bad.gz").write_bytes(gzip.compress(b"nope\n"))
    reports = profile_job(spark, str(source), str(tmp_path / "out"))
    files = {r.file_name: r.objects for r in reports["by_file"].collect()}
    assert files == {"a.gz": 2, "b.gz": 2, "bad.gz": 0, "empty.gz": 0}
    assert reports["overall"].first().files == 4


def test_no_values_are_an_empty_document(spark, source, tmp_path):
    profile_job(spark, str(source), str(tmp_path / "out"), ["nothing"])
    parts = (tmp_path / "out" / "value_distributions" / "document").glob("part-*")
    assert "".join(p.read_text() for p in parts) == "{}\n"


def test_a_new_checkpoint_does_not_replace_facts(spark, source, tmp_path):
    out = str(tmp_path / "facts")
    ingest_profile(stream_lines(spark, str(source), pieces=4), out, str(tmp_path / "one")).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_profile(stream_lines(spark, str(source)), out, str(tmp_path / "two"))


def test_incremental_ingest(spark, source, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        lines = stream_lines(spark, str(source))
        ingest(
            lines, lambda x: project(x, "narrow", keep=["file_name"]), out, checkpoint
        ).awaitTermination()
        return as_rows(spark.read.parquet(out).selectExpr("file_name", "coalesce(id, '-')"))

    first = [("a.parquet", "-"), ("a.parquet", "1"), ("b.parquet", "2"), ("b.parquet", "3")]
    assert run() == first
    assert run() == first  # no file twice
    (source / "c.gz").write_bytes(gzip.compress(b'{"id":"9"}\n'))
    assert run() == [*first, ("c.parquet", "9")]


def test_incremental_profile(spark, source, tmp_path):
    out, checkpoint = str(tmp_path / "facts"), str(tmp_path / "checkpoint")

    def run():
        ingest_profile(stream_lines(spark, str(source), 1), out, checkpoint).awaitTermination()
        return as_rows(by_field(read_profile(spark, out)))

    def batch():
        return as_rows(by_field(profile_facts(parse_objects(scan_lines(spark, str(source))))))

    assert run() == batch()
    (source / "c.gz").write_bytes(gzip.compress(b'{"id":null,"new":1}\n'))
    assert run() == batch()


def test_streaming_aggregate(spark, source, tmp_path):
    """The field profile as a running aggregate."""
    stream = profile_fields(parse_objects(stream_lines(spark, str(source))))
    query = (
        stream.writeStream.format("memory")
        .queryName("running_profile")
        .outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    want = profile_fields(parse_objects(scan_lines(spark, str(source))))
    assert as_rows(spark.table("running_profile")) == as_rows(want)


def test_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(root)
