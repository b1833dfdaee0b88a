"""Drift by VARIANT against a plain walk over the parsed JSON."""

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.streaming import variant as V
from tidepool.streaming.drift import rescue_columns

LINES = [
    '{"a":1,"b":{"c":[{"d":1.5},{"d":"x","e":null}]}}', '{"a":"q","b":{"c":[]}}', '{"b":"mixed"}', '{"b":[1,[2,{"deep":true}],[]]}',
    "{bad", "[1,2]", "5", "null", "", '{"a":12345678901234567890,"t":{},"z":true}', '{"odd name":{"x.y":1,"q\\"uote":2}}', '{"a":1,"a":2}',
    '{"e":1.5e300}', '{"\\"\'":1,"":{"":2}}', None]


def kind(x):
    if isinstance(x, bool):
        return "BOOLEAN"
    if isinstance(x, int):
        return "BIGINT" if -(2 ** 63) <= x < 2 ** 63 else "DECIMAL"
    if isinstance(x, float):
        return "DECIMAL" if abs(x) < 1e30 else "DOUBLE"
    return {type(None): "VOID", str: "STRING", dict: "OBJECT", list: "ARRAY"}[type(x)]


def walk(x, path, out):
    out.add((path, kind(x)))
    if isinstance(x, dict):
        for k, y in x.items():
            walk(y, f"{path}.{k}", out)
    elif isinstance(x, list):
        for y in x:
            walk(y, f"{path}[*]", out)


def no_repeats(pairs):
    if len({k for k, _ in pairs}) < len(pairs):
        raise ValueError
    return dict(pairs)


def brute(lines):
    counts = Counter()
    for line in lines:
        out = set()
        try:
            walk(json.loads(line, object_pairs_hook=no_repeats), "$", out)
        except (ValueError, TypeError):
            out = {("$", "NOT JSON")}
        counts.update(out)
    return counts


def counted(spark, lines):
    df = spark.createDataFrame([(x, "clash") for x in lines], "value string, v string").repartition(2)
    return {(r.path, r.type): r.lines for r in V.field_counts(df).collect()}


def test_fields_at_any_depth(spark):
    assert counted(spark, LINES) == brute(LINES)


def test_empty_table(spark):
    assert counted(spark, []) == {}


leaves = st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from(["", "x", "1"]) | st.sampled_from([0.5, 2.25])
trees = st.recursive(leaves, lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["a", "b", "c d"]), c, max_size=3), max_leaves=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trees, max_size=5))
def test_any_lines(spark, docs):
    lines = [json.dumps(d) for d in docs]
    assert counted(spark, lines) == brute(lines)


def test_objects_keyed_by_data_are_an_error(spark):
    df = spark.createDataFrame([(json.dumps({f"k{i}": i}),) for i in range(30)], "value string")
    with pytest.raises(ValueError, match="more than 20 different fields"):
        V.field_counts(df, max_places=20)


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("at", T.StructType([T.StructField("x", T.DoubleType())])),
                       T.StructField("tags", T.ArrayType(T.StructType([T.StructField("k", T.LongType())])))])


@pytest.mark.parametrize(("line", "reason", "row"), [
    ('{"id":1,"name":"n","at":{"x":2},"tags":[{"k":1},{"k":null}]}', None, (1, "n", 2.0, [1, None])),
    ('{"id":"1"}', "bad_type", (None, None, None, None)),
    ('{"id":1.5,"name":7}', "bad_type", (None, "7", None, None)),
    ('{"id":2,"at":{"x":"far","y":1}}', "unknown_field", (2, None, None, None)),
    ('{"id":2,"at":"here"}', "bad_type", (2, None, None, None)),
    ('{"id":3,"tags":[{"k":1,"w":2}]}', "unknown_field", (3, None, None, [1])),
    ('{"id":3,"tags":[{"k":"x"},{"k":2}]}', "bad_type", (3, None, None, [None, 2])),
    ('{"id":null}', None, (None, None, None, None)),
    ("[]", "not_json", (None, None, None, None)), ("7", "not_json", (None, None, None, None)),
    ('{"id":1,"id":2}', "not_json", (None, None, None, None)), (None, "not_json", (None, None, None, None))])
def test_rescue_below_the_top_level(spark, line, reason, row):
    df = spark.createDataFrame([(line,)], "value string")
    r = rescue_columns(df, SCHEMA).select("id", "name", F.col("at.x").alias("x"), F.col("tags.k").alias("ks"), "_rescued_data", "rescue_reason").first()
    assert (r.rescue_reason, (r.id, r["name"], r.x, r.ks)) == (reason, row)
    assert r["_rescued_data"] == (line if reason else None)


def test_one_parse_of_a_line(spark):
    plan = rescue_columns(spark.createDataFrame([("{}",)], "value string"), SCHEMA)._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json") == 1


def test_rescue_looks_each_field_up_once(spark):
    schema = T.StructType([T.StructField("one", T.LongType()), T.StructField("two", T.StringType())])
    rows = rescue_columns(spark.createDataFrame([('{"one":1,"two":"x"}',), ('{"one":"q"}',), ("{bad",)], "value string"), schema)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(f"$['{f.name}']") for f in schema.fields] == [1, 1]
    assert [tuple(r) for r in rows.collect()] == [(1, "x", None, None), (None, None, '{"one":"q"}', "bad_type"), (None, None, "{bad", "not_json")]
