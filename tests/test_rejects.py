"""Lines that are not read: why, how many, and where they are kept."""

import gzip

import pytest
from pyspark.sql import functions as F

from lacuna.operators.clean import clean_records
from lacuna.operators.reports import outcome, with_total
from lacuna.plans.jobs import clean_job, convert_job
from lacuna.sources.ndjson import (
    MAX_DEPTH,
    POLICIES,
    judge_lines,
    nonblank,
    parse_objects,
    parse_values,
    reject_report,
    rejected,
    scan_lines,
)

DEEP, DEEPER = (f'{{"a":{"[" * n}1{"]" * n}}}'.encode() for n in (MAX_DEPTH - 1, MAX_DEPTH))
LINES = {
    b'{"id":"1","x":null}': None,
    b' {"id":"2"} ': None,
    b"[1]": "not_object",
    b"null": "not_object",
    b'"text"': "not_object",
    b"": "blank",
    b" \t ": "blank",
    b'{"id":': "bad_json",
    b'{"a":1} x': "bad_json",
    b'{"a":1}] {}': "bad_json",
    b'{"a":"\\ud800"}': "bad_json",
    b'{"a":"\xff"}': "bad_utf8",
    DEEP: None,
    DEEPER: "too_deep",
    b"[" * (MAX_DEPTH + 1) + b"]" * (MAX_DEPTH + 1): "too_deep",
    b"{" * 9000: "too_deep",
    b'{"a":"' + b"[" * 9000 + b'"}': None,
    b'{"a":"' + b"[" * 9000: "bad_json",
    b'{"a":["' + b'\\"[' * 4000 + b'"]}': None,
}


@pytest.fixture()
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    items = list(LINES)
    (folder / "a.gz").write_bytes(gzip.compress(b"\n".join(items[::2])))
    (folder / "b.gz").write_bytes(gzip.compress(b"\n".join(items[1::2])))
    (folder / "none.gz").write_bytes(gzip.compress(b""))
    return str(folder)


def reasons(judged):
    rows = judged.select(F.encode("value", "UTF-8").alias("raw"), "reason").collect()
    return sorted((r.reason or "-", len(r.raw)) for r in rows)


def want(policy):
    left = [(reason, line) for line, reason in LINES.items() if reason != "blank"]
    if policy == "values":
        left = [(None if reason == "not_object" else reason, line) for reason, line in left]
    return left


@pytest.mark.parametrize("policy", ["objects", "values", *POLICIES])
def test_every_line_is_kept_or_has_its_reason(spark, source, policy):
    lines = scan_lines(spark, source)
    judged = judge_lines(lines, policy)
    expected = want(POLICIES.get(policy, policy))
    assert sorted(r.reason or "-" for r in judged.collect()) == sorted(r or "-" for r, _ in expected)
    kept, refused = judged.where("reason IS NULL").count(), rejected(judged).count()
    assert kept + refused == nonblank(lines).count() == len(expected)
    read = parse_values(lines) if POLICIES.get(policy, policy) == "values" else parse_objects(lines)
    assert read.count() == kept


def test_cleaner_and_policy_agree(spark, source):
    lines = scan_lines(spark, source)
    assert clean_records(lines).count() == judge_lines(lines, "clean").where("reason IS NULL").count()


def test_report_per_file(spark, source):
    report = reject_report(judge_lines(scan_lines(spark, source)))
    total = with_total(report).where("total").first()
    found = [r for r, _ in want("objects")]
    assert (total.files, total.lines, total.kept, total.rejected) == (2, len(found), found.count(None), len(found) - found.count(None))
    assert [total[r] for r in ("bad_utf8", "bad_json", "too_deep", "not_object")] == [1, 5, 3, 3]


def test_the_strictest_policy_ends_the_job(spark, source, lines):
    with pytest.raises(Exception, match="line rejected as"):
        judge_lines(scan_lines(spark, source), "all").collect()
    assert judge_lines(lines('{"a":1}', " "), "all").count() == 1
    with pytest.raises(ValueError, match="unknown policy"):
        judge_lines(lines("{}"), "some")


def test_jobs_keep_rejected_lines(spark, source, tmp_path):
    out = tmp_path / "clean"
    for _ in range(2):
        report = clean_job(spark, source, str(out), rejects=True)
        rows = {r.file_name: r for r in report.collect()}
        assert rows["none.gz"][1:] == (0, 0, 0)
        expected = [r for r, _ in want("values")]
        assert sum(r.rejected for r in rows.values()) == len(expected) - expected.count(None)
        assert sum(r.rows_processed for r in rows.values()) == expected.count(None)
        kept = [r.value for r in scan_lines(spark, f"{out}/_rejects").collect()]
        assert sorted(x.split(" ")[0] for x in kept) == sorted(r for r in expected if r)  # as the JVM calls them
        assert 'bad_json {"a":1} x' in kept and 'bad_utf8 {"a":"�"}' in kept
    wide = str(tmp_path / "wide")
    report = convert_job(spark, source, wide, "narrow_strings", rejects=True)
    expected = [r for r, _ in want("objects")]
    total = with_total(report).where("total").first()
    assert (total.files, total.rows, total.rejected) == (3, expected.count(None), len(expected) - expected.count(None))
    assert scan_lines(spark, f"{wide}/_rejects").count() == total.rejected
    assert spark.read.parquet(wide).count() == total.rows


def test_totals_stand_apart_from_files_without_a_name(spark):
    rows = [("a", 1, 5), (None, 2, 7)]
    report = spark.createDataFrame(rows, "file_name string, rows long, rejected long")
    found = {(r.file_name, r.total): (r.files, r.rows, r.rejected) for r in with_total(report).collect()}
    assert found == {("a", False): (1, 1, 5), (None, False): (1, 2, 7), (None, True): (2, 3, 12)}


def test_outcome(spark):
    status = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "file_name string, success boolean")
    assert tuple(outcome(status).first()) == (2, 1)
