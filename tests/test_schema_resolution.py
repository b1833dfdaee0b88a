"""Nested schema resolution: every rule, errors at once and errors by row."""

import pytest
from pyspark.sql import functions as F

from tidepool.operators import schema_resolution as R


def rec(name, *fields, **more):
    return {"type": "record", "name": name, "fields": list(fields), **more}


def field(name, type_, **more):
    return {"name": name, "type": type_, **more}


def arr(items):
    return {"type": "array", "items": items}


def read(spark, writer, reader, *values):
    """Values of a writer type (in Spark's layout) read as the reader's."""
    schema = R.T.StructType([R.T.StructField("v", R.spark_type(writer))])
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(R.resolve(writer, reader)(F.col("v")).alias("v")).collect()]


@pytest.mark.parametrize(("w", "r", "value", "want"), [
    ("int", "long", 5, 5), ("int", "double", 5, 5.0), ("long", "float", 7, 7.0), ("float", "double", 0.5, 0.5),
    ("string", "bytes", "é", "é".encode()), ("bytes", "string", b"ab", "ab"), ("boolean", "boolean", True, True),
    (["null", "int"], ["null", "long"], 3, 3), (["null", "int"], ["null", "long"], None, None), ("int", ["null", "string", "long"], 4, (None, 4)),
    (["int", "long"], "double", 9, 9.0), (["null", "string"], "string", "x", "x"), (["int", "string"], ["string", "long"], (8, None), (None, 8)),
    (["int", "string"], ["string", "long"], (None, "s"), ("s", None)), (["null", "int", "string"], ["null", "string", "int"], None, None),
    (arr("int"), arr("double"), [1, None], [1.0, None]), (arr(["null", "int"]), arr(["null", "long"]), [1, None], [1, None]),
    ({"type": "map", "values": arr("int")}, {"type": "map", "values": arr("long")}, {"a": [1], "b": []}, {"a": [1], "b": []}),
])
def test_types(spark, w, r, value, want):
    got = read(spark, w, r, value)[0]
    assert (tuple(got) if isinstance(got, tuple) else bytes(got) if isinstance(got, bytearray) else got) == want


def test_records_by_name_alias_and_default(spark):
    inner_w = rec("Point", field("x", "int"), field("old", "string"), field("gone", "double"))
    inner_r = rec("Place", field("new", "string", aliases=["old"]), field("x", "double"), field("z", "long", default=7),
                  field("tags", arr("string"), default=["a"]), field("m", {"type": "map", "values": "int"}, default={"k": 1}),
                  field("u", ["int", "string"], default=3), field("n", ["null", "int"], default=None), field("b", "bytes", default="ÿ"), aliases=["Point", "Point2"])
    w, r = rec("Row", field("p", ["null", inner_w]), field("ps", arr(inner_w | {"name": "Point2"}))), rec("Row", field("ps", arr(inner_r)), field("p", ["null", "Place"]))
    schema = R.spark_type(w)
    df = spark.createDataFrame([(("x" and {"x": 1, "old": "o", "gone": 0.5}), [{"x": 2, "old": None, "gone": None}, None]), (None, [])], schema)
    got = R.read_as(df, w, r).collect()
    whole = (("o", 1.0, 7, ["a"], {"k": 1}, (3, None), None, b"\xff"))
    assert tuple(tuple(x) if isinstance(x, tuple) else bytes(x) if isinstance(x, bytearray) else x for x in got[0].p) == whole
    assert got[0].ps[0].x == 2.0 and got[0].ps[0].new is None and got[0].ps[1] is None
    assert got[1].p is None and got[1].ps == []


def test_enums(spark):
    w = {"type": "enum", "name": "S", "symbols": ["A", "B", "C"]}
    assert read(spark, w, {"type": "enum", "name": "S", "symbols": ["A", "X"], "default": "X"}, "A", "B", None) == ["A", "X", None]
    strict = {"type": "enum", "name": "S", "symbols": ["A"]}
    assert read(spark, w, strict, "A", None) == ["A", None]
    with pytest.raises(Exception, match="no symbol B"):
        read(spark, w, strict, "B")


def test_a_branch_that_does_not_resolve_fails_by_row(spark):
    assert read(spark, ["int", "string"], "long", (4, None)) == [4]
    with pytest.raises(Exception, match="a row of string cannot be read as long"):
        read(spark, ["int", "string"], "long", (None, "x"))
    with pytest.raises(Exception, match="null cannot be read as long"):
        read(spark, ["null", "int"], "long", None)


@pytest.mark.parametrize(("w", "r", "told"), [
    ("long", "int", "long cannot be read as int"), ("string", "long", "string cannot"), (arr("string"), arr("int"), r"\$\[\*\]: string"),
    (rec("A", field("x", "int")), rec("A", field("y", "int")), r"\$\.y: the writer lacks it"), (rec("A"), rec("B"), "record A cannot be read as record B"),
    (rec("A", field("x", rec("I", field("d", "string")))), rec("A", field("x", rec("I", field("d", "int")))), r"\$\.x\.d: string"),
    ({"type": "fixed", "name": "F", "size": 4}, {"type": "fixed", "name": "F", "size": 8}, "4 fixed bytes"),
    (["string", "boolean"], "int", "string cannot be read as int; .*boolean cannot"), ("int", ["null", "string"], "int cannot be read as null; .*as string"),
    ("Nowhere", "int", "unknown type 'Nowhere'"), ({"type": "map", "values": "int"}, arr("int"), "map cannot be read as array")])
def test_what_cannot_resolve_is_an_error_at_once(w, r, told):
    with pytest.raises(R.SchemaMismatch, match=told):
        R.resolve(w, r)


def test_a_record_that_holds_itself_is_an_error():
    node = rec("Node", field("v", "int"), field("next", ["null", "Node"]))
    with pytest.raises(R.SchemaMismatch, match="holds itself"):
        R.resolve(node, node)


def test_empty_table_and_other_columns(spark):
    w, r = rec("A", field("x y", "int")), rec("A", field("x y", "long"))
    df = spark.createDataFrame([], "`x y` int, _row string")
    got = R.read_as(df, w, r)
    assert got.dtypes == [("x y", "bigint")] and got.collect() == []
