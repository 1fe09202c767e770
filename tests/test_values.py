"""Getters, emptiness and text tests, one small case per rule."""

import datetime

import pytest

from lacuna.functions import values as v
from lacuna.plans.layouts import LAYOUTS, NARROW, WIDE, project
from lacuna.sources.ndjson import parse_values

CASES = [
    # member as JSON, strict string, int32, JSON text
    (None, None, None, None),
    ("null", None, None, "null"),
    ('"abc"', "abc", None, '"abc"'),
    ('""', "", None, '""'),
    ("7", None, 7, "7"),
    ('"7"', "7", None, '"7"'),
    ("3000000000", None, -1294967296, "3000000000"),
    ("9223372036854775807", None, -1, "9223372036854775807"),
    ("-9223372036854775808", None, 0, "-9223372036854775808"),
    ("2147483648", None, -2147483648, "2147483648"),
    ("12345678901234567890", None, None, "12345678901234567890"),
    ("true", None, None, "true"),
    ('[null,"x"]', None, None, '[null,"x"]'),
    ('{"b":1,"a":[]}', None, None, '{"a":[],"b":1}'),
]


def members(lines, jsons):
    return lines(*["{}" if j is None else f'{{"x":{j}}}' for j in jsons])


def test_getters(lines):
    table = project(members(lines, [c[0] for c in CASES]), ["x"], keep=["n"])
    assert [r.x for r in table.orderBy("n").collect()] == [c[1] for c in CASES]
    table = project(members(lines, [c[0] for c in CASES]), ["x:i"], keep=["n"])
    assert [r.x for r in table.orderBy("n").collect()] == [c[2] for c in CASES]
    table = project(members(lines, [c[0] for c in CASES]), ["x:j"], keep=["n"])
    assert [r.x for r in table.orderBy("n").collect()] == [c[3] for c in CASES]


def test_floats_are_not_integers(lines):
    table = project(members(lines, ["1990.5", "1990.0", "1e3"]), ["x:i"])
    assert [r.x for r in table.collect()] == [None] * 3


def test_getters_agree_on_whole_records(lines):
    records = parse_values(members(lines, [c[0] for c in CASES]))
    x = v.path("record", "x")
    rows = records.selectExpr(
        "n", v.text_or_null(x), v.int32_or_null(x), v.json_text(x)
    ).orderBy("n")
    assert [tuple(r)[1:] for r in rows.collect()] == [c[1:] for c in CASES]


DATES = ["2020-01-15", "2020-1-2", "2020/01/02", "2020", "2020-01", "2020-02-30", "bad", ""]


def test_lenient_dates(lines):
    table = project(
        members(lines, [f'"{d}"' for d in DATES]), ["x:d"], keep=["n"], strict_dates=False
    )
    assert [r.n for r in table.where("x IS NOT NULL").orderBy("n").collect()] == [0, 1, 2]
    jan_2 = datetime.date(2020, 1, 2)
    assert [r.x for r in table.orderBy("n").collect()] == [
        datetime.date(2020, 1, 15), jan_2, jan_2, None, None, None, None, None,
    ]


@pytest.mark.parametrize("strict", [True, False])
def test_dates_in_other_forms(lines, strict):
    good = [
        " 2020-01-02", "2020-01-02 ", "2020-01-02 10:00:00", "2020-01-02T10:00:00", "2020-01-02T00:00:00Z",
        "2020 01 02", "2020/1/2 3:4", "2020-01-02 10:00:00+05", "2020-01-02 10:00:00.123 UTC",
    ]
    table = project(members(lines, [f'"{d}"' for d in good]), ["x:d"], strict_dates=strict)
    assert {r.x for r in table.collect()} == {datetime.date(2020, 1, 2)}
    bad = ["2020-01/02", "2020-01-02abc", "2020-01-02 10", "20200102", "2020-01-02 25:00:00", "02-01-2020"]
    table = project(members(lines, [f'"{d}"' for d in bad]), ["x:d"], strict_dates=False)
    assert {r.x for r in table.collect()} == {None}


@pytest.mark.parametrize("text", ["2020", "2020-02-30", "bad", ""])
def test_strict_dates_end_the_job(lines, text):
    with pytest.raises(Exception, match="not a date"):
        project(members(lines, [f'"{text}"']), ["x:d"]).collect()


def test_strict_dates_pass_null_and_dates(lines):
    table = project(members(lines, ["null", None, "7", '"2020-01-15"']), ["x:d"], keep=["n"])
    assert [r.x for r in table.orderBy("n").collect()] == [None] * 3 + [datetime.date(2020, 1, 15)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_emptiness(spark, lines, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        _emptiness(lines)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def _emptiness(lines):
    cases = {"null": True, "[]": True, "{}": True, '""': False, "0": False, "[null]": False}
    records = parse_values(members(lines, cases))
    rows = records.selectExpr("n", v.is_void(v.path("record", "x"))).orderBy("n").collect()
    assert [r[1] for r in rows] == list(cases.values())


def test_literal_and_nested_paths(lines):
    line = '{"a.b":1,"a":{"b":2},"it\'s":3}'
    record = parse_values(lines(line)).selectExpr(
        v.json_text(v.path("record", "a.b")),
        v.json_text(v.path("record", "a", "b")),
        v.json_text(v.path("record", "it's")),
    )
    assert tuple(record.first()) == ("1", "2", "3")


@pytest.mark.parametrize("blank", ["", "  ", "\u00a0", "\ufeff", "\u2003\t", "\u3000"])
def test_blank_text(spark, blank):
    text = v.literal(blank)
    assert spark.range(1).selectExpr(v.has_visible_text(text)).first()[0] is False


@pytest.mark.parametrize("shown", ["x", " x ", "\u0085", "\u200b"])
def test_visible_text(spark, shown):
    assert spark.range(1).selectExpr(v.has_visible_text(v.literal(shown))).first()[0] is True


def test_layouts(lines):
    kinds = [c.partition(":")[2] for c in WIDE]
    assert (kinds.count(""), kinds.count("i"), kinds.count("j")) == (59, 4, 15)
    assert len(NARROW) == 12
    types = dict(project(lines("{}"), "narrow").dtypes)
    assert types["job_last_updated"] == "date" and types["experience"] == "string"
    assert set(dict(project(lines("{}"), "narrow_strings").dtypes).values()) == {"string"}
    for layout in LAYOUTS:
        assert project(lines("{}", "[]", "5", "nope"), layout).count() == 1
