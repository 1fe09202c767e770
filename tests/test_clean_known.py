"""The schema-driven cleaner gives the rows of the general one, for lines of the shape and others."""

import json
import random

import pytest
from pyspark.sql.types import MapType, StringType, StructField, StructType

from lacuna.operators.clean import clean_records
from lacuna.operators.clean_known import clean_known

SHAPE = """a string, `b.c` bigint, o struct<x: string, `y"z`: int, n: struct<k: string>, l: array<string>>,
 l array<string>, m array<struct<p: string, q: array<int>>>, w array<array<string>>, e struct<>, `é` string"""


def same(lines, values, shape=SHAPE):
    frame = lines(*values)
    want, got = ({r.n: (r.cleaned, r.removed) for r in x.collect()} for x in (clean_records(frame), clean_known(frame, shape)))
    assert got == want
    return got


def test_lines_of_the_shape(lines):
    got = same(
        lines,
        [
            '{"a":"x","b.c":7,"o":{"x":null,"y\\"z":"","n":{"k":null},"l":["",null]}}',
            '{"o":null,"l":[],"m":[{"p":"1","q":[1,null]},{},null,{"p":"","q":[]}],"w":[[],[null,[]][0:0]]}',
            '{"m":[{"p":"1","q":[1,null]},{},null,{"p":"","q":[]}],"w":[[],["",null],["z"]],"e":{}}',
            '{"a":1.50,"b.c":"text","é":"ü\\u00e9 \\"quoted\\" \\\\ []{}null,\\"\\":"}',
            '{ "a" : null , "o" : { } , "l" : [ ] , "e": {} }',
            "{}",
        ],
    )
    assert got[0] == ('{"a":"x","b.c":7}', 5)
    assert 1 not in got and len(got) == 5


def test_lines_of_other_shapes(lines):
    same(
        lines,
        [
            '{"a":{"deep":[null,""]}}',  # a container for a scalar
            '{"a":[],"l":"n/a","o":[1],"m":{}}',  # scalars and other containers for containers
            '{"unknown":1,"a":"x"}',
            '{"unknown":null,"a":"x"}',
            '{"o":{"unknown":{"a":null}}}',
            '{"a":1,"a":null}',
            '{"o":{"x":"2"},"o":{"x":"1"}}',
            '[1,null,""]',
            "null",
            '""',
            "5",
            "",
            "  ",
            "{",
            '{"a":1} x',
            '{"a":1}] {}',
            "{'a':1}",
            '{"a":01}',
            '{"a":"\\ud800"}',
            '{"":"","a":{"":null}}',
            '{"":1}',
        ],
    )


def test_a_repeated_key_keeps_its_last_value(lines):
    frame = lines('{"a":null,"a":1}', '{"o":null,"o":{"x":"1"}}')
    assert [r.cleaned for r in clean_known(frame, SHAPE).orderBy("n").collect()] == ['{"a":1}', '{"o":{"x":"1"}}']


def test_long_lines_go_the_other_way(lines):
    same(lines, [json.dumps({"a": "x" * (1 << 20), "l": [None, ""]}), json.dumps({"l": [""] * 400_000})])


@pytest.mark.parametrize("seed", range(3))
def test_random_records(lines, seed):
    rng = random.Random(seed)
    scalars = [None, "", "x", "null", "[]", '"', "\\", ' "":null', 0, -5, 2.5, True, 10**15]

    def value(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.6:
            return rng.choice(scalars)
        if kind < 0.8:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        return {k: value(depth - 1) for k in rng.sample(["x", 'y"z', "n", "k", "l", "p", "q"], rng.randint(0, 3))}

    def record():
        fitting = {
            "a": rng.choice(scalars),
            "o": rng.choice([None, {}, {"x": rng.choice(scalars), "n": {"k": rng.choice(scalars)}, "l": ["", "y", None]}]),
            "m": rng.choice([None, [], [{"p": rng.choice(scalars), "q": [1, None]}, None, {}]]),
            "w": rng.choice([None, [[rng.choice(scalars)], [], None]]),
        }
        other = {k: value(3) for k in rng.sample(["a", "o", "l", "m", "w", "e", "new"], 3)}
        return {k: v for k, v in (fitting | (other if rng.random() < 0.4 else {})).items() if rng.random() < 0.8}

    same(lines, [json.dumps(record(), ensure_ascii=rng.random() < 0.5) for _ in range(300)])


def test_without_python(lines):
    values = ['{"a":"x","l":["",null]}', '{"o":{"n":{"k":null}}}']
    frame = clean_known(lines(*values), SHAPE, other="raise")
    assert "InArrow" not in frame._jdf.queryExecution().executedPlan().toString()
    assert [(r.cleaned, r.removed) for r in frame.orderBy("n").collect()] == [('{"a":"x"}', 2), (None, 1)]
    with pytest.raises(Exception, match="not of the shape"):
        clean_known(lines(*values, '{"unknown":1}'), SHAPE, other="raise").collect()


def test_a_map_is_no_shape(lines):
    with pytest.raises(ValueError, match="map"):
        clean_known(lines("{}"), StructType([StructField("m", MapType(StringType(), StringType()))]))
