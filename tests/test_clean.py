"""Removal of null and empty members, against fixed cases and a second model."""

import json
import random

from pyspark.sql import functions as F

from lacuna.operators.clean import clean_records, clean_report, drop_empty

CASES = [
    # line, cleaned, removed
    ('{"a":1,"b":null,"c":""}', '{"a":1}', 2),
    ('{"a":[],"b":{},"c":"  "}', '{"c":"  "}', 2),
    ('{"a":{"b":null}}', None, 1),
    ('{"a":[null,"",[],{},{"z":null}]}', None, 4),
    ('{"a":[0,false,null]}', '{"a":[0,false]}', 1),
    ("{}", None, 0),
    ("[]", None, 1),
    ("null", None, 1),
    ('""', None, 1),
    ("[1,null]", "[1]", 1),
    ("5", "5", 0),
    ("false", "false", 0),
    ('{"a":1,"a":2}', '{"a":2}', 0),
    ('{"b":{"d":[{}],"c":1},"a":"é\\u0041"}', '{"a":"éA","b":{"c":1}}', 0),
    ('{"version_status.status":"x","version_status":{"status":"y"}}',
     '{"version_status":{"status":"y"},"version_status.status":"x"}', 0),
    ('{"n":12345678901234567890,"f":1.5,"z":0,"q":"\\"\\\\"}',
     '{"f":1.5,"n":12345678901234567890,"q":"\\"\\\\","z":0}', 0),
]
NOT_JSON = ["", "   ", '{"a":', '{"a":1} x', '{"a":1}] {}', '{"a":01}', "{'a':1}", '{"a":NaN}',
            '{"a":"\\ud800"}']


def test_cases(lines):
    rows = clean_records(lines(*[c[0] for c in CASES], *NOT_JSON)).orderBy("n").collect()
    assert [(r.cleaned, r.removed) for r in rows] == [c[1:] for c in CASES]


def test_deep_lines(lines):
    depth = 999
    full = "[" * depth + "1" + "]" * depth
    void = '{"a":' * depth + "null" + "}" * depth
    too_deep = "[" * 200_000 + "]" * 200_000
    rows = clean_records(lines(full, void, too_deep, '{"ok":1}')).orderBy("n").collect()
    assert [(r.n, r.cleaned, r.removed) for r in rows] == [
        (0, full, 0), (1, None, 1), (3, '{"ok":1}', 0),
    ]


def random_json(rng, depth):
    kind = rng.randrange(9 if depth else 6)
    if kind < 6:
        return rng.choice([None, "", "x", 0, 17, True, [], {}, "null", '"', "[]", "é "])
    if kind < 7:
        return [random_json(rng, depth - 1) for _ in range(rng.randrange(4))]
    keys = ["a", "b", "", "c.d", "null"]
    return {k: random_json(rng, depth - 1) for k in rng.sample(keys, rng.randrange(5))}


def keeps(value):
    """Does anything survive: a scalar other than null and the empty string?"""
    if isinstance(value, dict):
        return any(map(keeps, value.values()))
    if isinstance(value, list):
        return any(map(keeps, value))
    return value is not None and value != ""


def pruned(value):
    if isinstance(value, dict):
        return {k: pruned(x) for k, x in value.items() if keeps(x)}
    if isinstance(value, list):
        return [pruned(x) for x in value if keeps(x)]
    return value


def counted(value, owner=None):
    own = value in (None, "") or value == [] or (value == {} and owner is dict)
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return int(own) + sum(counted(x, type(value)) for x in inner)


def test_random_against_model(lines):
    rng = random.Random(7)
    values = [random_json(rng, 6) for _ in range(3000)]
    cleaned = clean_records(lines(*[json.dumps(x) for x in values]))
    rows = cleaned.orderBy("n").collect()
    assert len(rows) == len(values)
    for row, value in zip(rows, values):
        assert row.removed == counted(value)
        if keeps(value):
            assert row.cleaned == json.dumps(
                pruned(value), separators=(",", ":"), sort_keys=True, ensure_ascii=False
            )
        else:
            assert row.cleaned is None


def test_cleaning_twice_changes_nothing(lines):
    rng = random.Random(8)
    frame = lines(*[json.dumps(random_json(rng, 6)) for _ in range(1000)])
    once = drop_empty(clean_records(frame)).select("n", F.col("cleaned").alias("value"))
    twice = clean_records(once).join(once, "n")
    assert twice.where("cleaned <> value OR cleaned IS NULL OR removed > 0").count() == 0


def test_report_counts_emptied_records(lines):
    frame = lines('{"a":null}', '{"a":1,"b":""}', "nope").withColumn("file_name", F.lit("f"))
    assert [tuple(r) for r in clean_report(clean_records(frame)).collect()] == [("f", 2, 2)]


def test_other_columns_stay(lines):
    frame = lines('{"a":1}', "bad", '{"b":2}').withColumn("day", F.to_date(F.lit("2020-01-02")))
    rows = clean_records(frame)
    assert rows.columns == ["n", "day", "cleaned", "removed"]
    assert [(r.n, str(r.day)) for r in rows.orderBy("n").collect()] == [
        (0, "2020-01-02"), (2, "2020-01-02"),
    ]
    bare = clean_records(frame.select("value"))
    assert bare.columns == ["cleaned", "removed"] and bare.count() == 2


def test_numbers_beyond_a_double_stay(lines):
    rows = clean_records(lines('{"a":-1e400,"b":null,"c":"\\"Infinity 1e400"}')).collect()
    assert [(r.cleaned, r.removed) for r in rows] == [('{"a":-1e999,"c":"\\"Infinity 1e400"}', 1)]
