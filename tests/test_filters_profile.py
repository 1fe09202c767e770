"""Contact filters and profiles on small corpora."""

import json

from pyspark.sql import functions as F

from lacuna.operators.filters import (
    extract_emails,
    lines_with_email_domain,
    lines_with_phone,
    lines_with_skill,
    phone_match_rate,
)
from lacuna.operators.profile import (
    by_field,
    by_file,
    by_value,
    overall,
    profile_facts,
    profile_fields,
    status_counts,
    value_counts,
)
from lacuna.sinks.files import write_value_distributions
from lacuna.sources.ndjson import parse_objects

PHONE = ['{"mobile_phone":"+1"}', '{"phone_numbers":["","+1"]}', '{"mobile\\u005fphone":"+1"}']
NO_PHONE = [
    '{"mobile_phone":"  "}', '{"mobile_phone":7}', '{"mobile_phone":"\u00a0\ufeff"}',
    '{"phone_numbers":[null,"  ",7]}', '{"phone_numbers":"+1"}', "{}", "null", '["+1"]', "", "bad",
]
GOOGLE = ['{"emails":[{"address":"a@google.com"}]}', '{"emails":[1,{"address":"a\\u0040google.com"}]}']
NOT_GOOGLE = [
    '{"emails":["a@google.com"]}', '{"emails":{"address":"a@google.com"}}',
    '{"emails":[{"address":"A@GOOGLE.COM"}]}', '{"emails":[{"address":"a@google.com.x"}]}',
    '{"emails":[{"address":["a@google.com"]}]}', '{"other":"a@google.com"}',
]


def kept(frame):
    return sorted(r.n for r in frame.collect())


def test_phone(lines):
    frame = lines(*PHONE, *NO_PHONE)
    matched = lines_with_phone(frame)
    assert kept(matched) == [0, 1, 2] and matched.columns == frame.columns
    assert [r.value for r in matched.orderBy("n").collect()] == PHONE
    assert tuple(phone_match_rate(frame).first()) == (3, len(PHONE) + len(NO_PHONE) - 1)


def test_email_domain(lines):
    assert kept(lines_with_email_domain(lines(*GOOGLE, *NOT_GOOGLE))) == [0, 1]
    quote = '{"emails":[{"address":"it\'s \\"me\\"@x"}]}'
    assert kept(lines_with_email_domain(lines(quote, *GOOGLE), "'s \"me\"@x")) == [0]


def test_skills(lines):
    frame = lines('{"skills":["go","rust"]}', '{"skills":"rust"}', '{"skills":["rusty"]}', "{}")
    assert kept(lines_with_skill(frame, "rust")) == [0]
    assert kept(lines_with_skill(frame, "rusty", "go")) == [0, 2]


def test_extract_emails(lines):
    frame = lines('{"emails":[{"address":"a@x"},"b@x",{"address":7},{"address":"c@x"}]}', "{}")
    assert sorted(r.address for r in extract_emails(frame).collect()) == ["a@x", "c@x"]
    assert sorted(r.address for r in extract_emails(frame, bare_strings=True).collect()) == [
        "a@x", "b@x", "c@x",
    ]


RECORDS = {
    "f1": ['{"a":null,"b":"","g":"m"}', '{"a":[],"g":"m","x":{}}', "{}", "[]", "bad"],
    "f2": ['{"a":1,"g":"f","g2":"m","a.b":"lit","a":{"b":"in"}}', '{"g":7}', '{"g":""}'],
}


def record_lines(spark):
    rows = [(name, line) for name, lines in RECORDS.items() for line in lines]
    return spark.createDataFrame(rows, "file_name string, value string")


def as_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_fields(spark):
    records = parse_objects(record_lines(spark))
    want = [
        ("a", 3, 1, 1, 1), ("a.b", 1, 0, 0, 1), ("b", 1, 0, 0, 1), ("g", 5, 0, 0, 5),
        ("g2", 1, 0, 0, 1), ("x", 1, 0, 1, 0),
    ]
    assert as_rows(profile_fields(records)) == want
    assert as_rows(by_field(profile_facts(records))) == want
    assert as_rows(by_field(profile_facts(records, ["g"]))) == want


def test_files(spark):
    facts = profile_facts(parse_objects(record_lines(spark)), ["g", "a.b"])
    files = as_rows(by_file(facts).select("file_name", "objects", "total_fields", "null_or_empty"))
    assert files == [("f1", 3, 6, 3), ("f2", 3, 6, 0)]
    total = overall(facts).first()
    assert (total.files, total.objects, total.total_fields, total.null_or_empty) == (2, 6, 12, 3)
    assert total.avg_fields == 2 and total.avg_null_or_empty == 0.5 and total.null_or_empty_pct == 25


def test_files_without_fields(spark):
    empty = spark.createDataFrame([("f", "{}")], "file_name string, value string")
    row = by_file(profile_facts(parse_objects(empty))).first()
    assert (row.objects, row.total_fields, row.null_or_empty_pct) == (1, 0, None)


def test_profile_of_a_split_adds_up(spark):
    records = parse_objects(record_lines(spark))
    parts = [profile_facts(records.where(F.col("file_name") == f), ["g"]) for f in RECORDS]
    joined = parts[0].unionByName(parts[1])
    assert as_rows(by_field(joined)) == as_rows(by_field(profile_facts(records)))
    assert as_rows(overall(joined)) == as_rows(overall(profile_facts(records)))


def test_values(spark):
    frame = record_lines(spark)
    want = [("a.b", "lit", 1), ("g", "", 1), ("g", "f", 1), ("g", "m", 2)]
    assert as_rows(value_counts(frame, ["g", "a.b"])) == want
    assert as_rows(by_value(profile_facts(parse_objects(frame), ["g", "a.b"]))) == want
    assert as_rows(value_counts(frame, ["a.b"], paths=True)) == [("a.b", "in", 1)]


def test_status(lines):
    frame = lines(
        '{"status":"new"}', '{"status":"3"}', '{"status":3}', '{"status":3}', '{"status":null}',
        '{"status":true}', '{"status":[1]}', '{"status":{}}', "{}", '["status"]', "bad",
    )
    assert as_rows(status_counts(frame)) == [('"3"', 1), ('"new"', 1), ("3", 2), ("true", 1)]


def test_distribution_document(spark, tmp_path):
    rows = [("g", "m", 2), ("g", 'a "q"\n', 1), ("c", "", 5), ("c", "é", 1), ("z", "only", 9)]
    counts = spark.createDataFrame(rows, "field string, value string, count bigint")
    write_value_distributions(counts, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out" / "document").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    want = {f: {v: c for g, v, c in sorted(rows) if g == f} for f in ("c", "g", "z")}
    assert json.loads(text) == want
    assert text == json.dumps(want, indent=2, ensure_ascii=False) + "\n"


def test_one_hot_value_is_folded_before_the_shuffle(spark):
    line = '{"g":"hot"}'
    hot = spark.range(0, 20000, 1, 4).selectExpr("'f' AS file_name", f"'{line}' AS value")
    assert as_rows(value_counts(hot, ["g"])) == [("g", "hot", 20000)]
    plan = value_counts(hot, ["g"])._jdf.queryExecution().toString()
    assert "partial_count" in plan
