"""Reading lines from real bytes, and which lines count as JSON."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from lacuna.operators.clean import clean_records
from lacuna.sources import ndjson
from lacuna.sources.ndjson import (
    mentioning,
    nonblank,
    parse_fields,
    parse_objects,
    parse_values,
    scan_lines,
    spread_lines,
)

BAD = [
    "", "  ", '{"a":', '{"a":1} x', '{"a":1}] {}', '{"a":01}', "{'a':1}", '{"a":NaN}',
    '{"a":1},{"b":2}', '{"a":1},"b":2', '{"a":1,}', '{"a":"\t"}', '{"a":"\\ud800"}',
    '{"a":"\\udc00x"}', '{"a":"\\q"}', "1 2", "1,2", "nul", '{"a":"\\u12"}', "]", "}",
]
OTHER = ["[]", "null", '""', "[1,null]", "5", "true", '"x"']
OBJECTS = [
    '{"a":1}', "{}", ' {"a": [1, {"b": null}]} ', '{"a":"\\ud83d\\ude00"}', '{"a":"\\\\ud800"}',
    '{"a":1,"a":2}', '{"a":"} x"}', '{"__line_end__":1}',
]


def kept(frame):
    return sorted(r.n for r in frame.select("n").collect())


def test_which_lines_are_json(lines):
    frame = lines(*BAD, *OTHER, *OBJECTS)
    n_bad, n_other, n = len(BAD), len(BAD) + len(OTHER), len(BAD) + len(OTHER) + len(OBJECTS)
    assert kept(parse_values(frame)) == list(range(n_bad, n))
    assert kept(parse_objects(frame)) == list(range(n_other, n))
    assert kept(parse_fields(frame, ["a"])) == list(range(n_other, n))
    assert kept(parse_objects(frame, keep="all")) == list(range(n))
    every = parse_fields(frame, ["a"], keep="all")
    assert kept(every.where("record IS NOT NULL")) == list(range(n_other, n))


def test_last_duplicate_wins(lines):
    line = '{"a":1,"a":2,"b":{"c":1,"c":null}}'
    whole = parse_values(lines(line)).select(F.to_json("record")).first()[0]
    assert whole == '{"a":2,"b":{"c":null}}'
    members = parse_objects(lines(line)).selectExpr("explode(record) AS (key, x)")
    rows = members.selectExpr("key", "to_json(x)").collect()
    assert sorted(tuple(r) for r in rows) == [("a", "2"), ("b", '{"c":null}')]
    fields = parse_fields(lines(line), ["a", "b"]).select(F.to_json("record.a"), F.to_json("record.b"))
    assert tuple(fields.first()) == ("2", '{"c":null}')


def test_missing_is_not_null(lines):
    record = parse_fields(lines('{"a":null}'), ["a", "b"]).first().record
    assert record.a is not None and record.b is None


def test_unknown_options(lines):
    with pytest.raises(ValueError):
        parse_objects(lines("{}"), keep="some")
    with pytest.raises(ValueError):
        parse_values(lines("{}"), reader="lax")


def write(folder, name, data):
    path = folder / name
    path.write_bytes(data)
    return str(path)


def test_scan_bytes(spark, tmp_path):
    two_members = gzip.compress(b'{"a":1}\n') + gzip.compress(b'{"a":2}\r\n\n{"a":"x\ry"}')
    write(tmp_path, "two.gz", two_members)
    write(tmp_path, "plain.ndjson", b'{"a":3}\n')
    write(tmp_path, "empty.gz", gzip.compress(b""))
    rows = {(r.file_name, r.value) for r in scan_lines(spark, str(tmp_path)).collect()}
    assert rows == {
        ("two.gz", '{"a":1}'),
        ("two.gz", '{"a":2}'),
        ("two.gz", ""),
        ("two.gz", '{"a":"x\ry"}'),
        ("plain.ndjson", '{"a":3}'),
    }
    assert nonblank(scan_lines(spark, str(tmp_path))).count() == 4


def test_invalid_utf8(spark, tmp_path):
    path = write(tmp_path, "bad.ndjson", b'{"a":"\xff"}\n{"a":"ok"}\n')
    assert parse_objects(scan_lines(spark, path)).count() == 1
    assert parse_values(scan_lines(spark, path)).count() == 1
    assert parse_fields(scan_lines(spark, path), ["a"]).count() == 1
    assert parse_fields(scan_lines(spark, path), ["a"], reader="replacing").count() == 2


def test_truncated_gzip(spark, tmp_path):
    data = gzip.compress(b"".join(b'{"a":%d}\n' % i for i in range(200000)))
    path = write(tmp_path, "cut.gz", data[: len(data) // 2])
    with pytest.raises(Exception):
        scan_lines(spark, path).count()
    assert 0 < scan_lines(spark, path, tolerate_corrupt=True).count() < 200000


def test_spread_keeps_rows_and_evens_out(spark):
    same = spark.range(0, 4000, 1, 1).selectExpr("'f' AS file_name", "'{}' AS value")
    spread = spread_lines(same, 8)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) > 4 and max(sizes) <= 1500
    assert spread.columns == ["file_name", "value"]


def test_pieces_of_a_file_do_not_meet(spark):
    rows = spark.range(0, 3600, 1, 1).selectExpr("'{}' AS value")
    named = rows.withColumn("file_name", F.lit("f")).unionAll(rows.withColumn("file_name", F.lit("g")))
    for lines, keys in ((rows, []), (named, ["file_name"])):
        pieces = spread_lines(lines, 36).groupBy(F.spark_partition_id(), *keys).count().collect()
        assert [r["count"] for r in pieces] == [100] * 36 * (1 + len(keys))


def test_only_a_dominating_file_is_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ndjson, "SMALL_FILE", 1)
    for i in range(20):
        write(tmp_path, f"small{i}.gz", gzip.compress(b'{"a":1}\n'))
    flat = scan_lines(spark, str(tmp_path))
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    data = b"".join(b'{"a":"%s"}\n' % random.randbytes(20).hex().encode() for _ in range(5000))
    write(tmp_path, "large.gz", gzip.compress(data))
    lines = scan_lines(spark, str(tmp_path))
    assert dict(lines.groupBy("file_name").count().collect()) == {
        "large.gz": 5000, **{f"small{i}.gz": 1 for i in range(20)},
    }
    large = lines.where("file_name = 'large.gz'").groupBy(F.spark_partition_id()).count()
    assert large.count() > 8
    small = scan_lines(spark, str(tmp_path), spread=False)
    assert sorted(small.collect()) == sorted(lines.collect())


def test_mentioning_never_drops_a_match(lines):
    frame = lines('{"k":"a@b"}', '{"k":"a\\u0040b"}', '{"k":"other"}')
    assert kept(mentioning(frame, "@b")) == [0, 1]


def test_parse_is_done_once(lines):
    for parse, function in ((parse_values, "from_json"), (parse_objects, "from_json")):
        records = parse(lines("{}"))
        frame = records.where("to_json(record) > 'x'").selectExpr("to_json(record)")
        plan = frame._jdf.queryExecution().toString()
        assert plan[plan.index("== Physical Plan ==") :].count(function) == 1


def test_forged_end_of_line(lines):
    forged = '{"a":1},{"__line_hash__":"x"}] {}'
    assert parse_objects(lines(forged)).count() == 0
    assert parse_fields(lines(forged), ["a"]).count() == 0
    assert parse_values(lines('1,"x"] {}')).count() == 0


def nested(depth):
    return '{"a":' + "[" * depth + "1" + "]" * depth + "}"


@pytest.mark.parametrize(
    "value, count",
    [
        ('{"a":"' + "x" * 21_000_000 + '"}', 1),
        ('{"a":0.' + "1" * 1500 + "}", 1),
        (nested(1500), 1),
        (nested(ndjson.MAX_DEPTH + 1), 0),
        ('{"a":1e400}', 1),
        ('{"a":[-1e+0400]}', 1),
        ('{"a":' + "9" * 400 + "}", 1),
        ('{"a":1e300,"b":"1e400 \\" 1e999"}', 1),
        ('{"a":' + "9" * 308 + "}", 1),
        ('{"a":1e-400}', 1),
    ],
)
def test_all_readers_keep_the_same_lines(lines, value, count):
    frame = lines(value)
    assert parse_values(frame).count() == count
    assert parse_objects(frame).count() == count
    for fields in (["a"], ["b"]):
        assert parse_fields(frame, fields).selectExpr("n", "record").count() == count
    assert clean_records(frame).count() == count


def test_a_session_that_drops_repeated_keys_is_refused(spark, lines):
    for key in ("spark.sql.variant.allowDuplicateKeys", "spark.sql.mapKeyDedupPolicy"):
        before = spark.conf.get(key)
        spark.conf.set(key, "false" if "allow" in key else "EXCEPTION")
        try:
            for parse in (parse_values, parse_objects):
                with pytest.raises(RuntimeError, match="prepare"):
                    parse(lines("{}"))
        finally:
            spark.conf.set(key, before)
