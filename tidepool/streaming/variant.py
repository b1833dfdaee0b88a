"""Drift at any depth (T7, S10): JSON lines parsed once, into VARIANT.

`field_counts` finds every field of the lines, nested ones and those inside arrays included, with the
types it holds and the number of lines that hold it so: `schema_of_variant_agg` merges the lines' own
schemas map-side, and where a place holds several types (it reports VARIANT there) the objects and the
arrays among them are asked again, one aggregate a place, until no place is left.  The lines are counted
in one more scan.  `unknown_fields` names, line by line, what a reader schema lacks at any depth.

A path is written `$.user.plan`, array elements as `[*]`.  Types are VARIANT's own names without
precision: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID (a JSON null).  A line that is
not JSON, or repeats a key in an object, has no variant: it counts under `$` as NOT JSON.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_JSON = "NOT JSON"
MAX_PLACES = 10_000

Steps = tuple  # of field names, None for the elements of an array

# What a reader type takes: the VARIANT types that fit it.
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
SCALARS = (*NUMBERS, "STRING", "BOOLEAN")
FITS: dict[type, tuple[str, ...]] = {
    T.ByteType: ("BIGINT",), T.ShortType: ("BIGINT",), T.IntegerType: ("BIGINT",), T.LongType: ("BIGINT",),
    T.FloatType: NUMBERS, T.DoubleType: NUMBERS, T.DecimalType: NUMBERS, T.StringType: SCALARS, T.BooleanType: ("BOOLEAN",),
    T.StructType: ("OBJECT",), T.MapType: ("OBJECT",), T.ArrayType: ("ARRAY",),
}


def kind(v: Column) -> Column:
    """The type name of a variant value."""
    return F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1)  # ahead of fields and precision


def member(v: Column, name: str) -> Column:
    """A field of an object, as variant; NULL where there is none."""
    if name and "'" not in name:
        return F.try_variant_get(v, f"$['{name}']", "variant")
    if name and '"' not in name:
        return F.try_variant_get(v, f'$["{name}"]', "variant")
    return F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.lit(name))  # a path cannot spell it


def _members(found: Column, name: str) -> Column:
    return F.filter(F.transform(found, lambda x: member(x, name)), lambda x: x.isNotNull())


def _of_kind(found: Column, name: str) -> Column:
    return F.filter(found, lambda x: kind(x) == name)


def _types(found: Column, path: str) -> Column:
    return F.transform(F.array_distinct(F.transform(found, kind)), lambda t: F.struct(F.lit(path).alias("path"), t.alias("type")))


def elements(v: Column) -> Column:
    """The elements of an array, as array<variant>; empty where it is none."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>"))


def values(v: Column, steps: Steps) -> Column:
    """All values of a line at a place, as array<variant>."""
    found = F.filter(F.array(v), lambda x: x.isNotNull())
    for step in steps:
        found = F.flatten(F.transform(found, elements)) if step is None else _members(found, step)
    return found


def path_of(steps: Steps) -> str:
    return "$" + "".join("[*]" if s is None else f".{s}" for s in steps)


def _type(described: str) -> T.DataType:
    """The description of a variant schema as a Spark type (Spark's own parser; objects are structs)."""
    return T.DataType.fromDDL(re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], described))


def _walk(found: T.DataType, steps: Steps, places: dict[Steps, None], mixed: list[Steps]) -> None:
    places[steps] = None
    if isinstance(found, T.StructType):
        for f in found.fields:
            _walk(f.dataType, (*steps, f.name), places, mixed)
    elif isinstance(found, T.ArrayType):
        if not isinstance(found.elementType, T.NullType):
            _walk(found.elementType, (*steps, None), places, mixed)
        else:
            mixed.append((*steps, None))  # empty arrays, or arrays of nulls
    elif isinstance(found, T.VariantType):
        mixed.append(steps)


def places(rows: DataFrame, v: str = "v", max_places: int = MAX_PLACES) -> list[Steps]:
    """Every place that some line has a value at.  A corpus whose objects have data for keys (more than
    `max_places` places) is an error: such objects are maps, and no schema."""
    found: dict[Steps, None] = {(): None}
    asked: list[Steps] = [()]
    while asked:
        of = [(s, k) for s in asked for k in ("OBJECT", "ARRAY")]
        among = [_of_kind(values(F.col(v), s), k) for s, k in of]
        got = rows.agg(*[F.schema_of_variant_agg(F.when(F.size(a) > 0, F.to_variant_object(a))).alias(f"s{i}") for i, a in enumerate(among)]).first()
        mixed: list[Steps] = []
        for (steps, _), described in zip(of, got, strict=True):
            if described in (None, "VOID"):
                continue
            shape = _type(described)
            if isinstance(shape, T.ArrayType) and not isinstance(shape.elementType, (T.NullType, T.VariantType)):
                _walk(shape.elementType, steps, found, mixed)
        if len(found) > max_places:
            raise ValueError(f"more than {max_places} different fields: {', '.join(path_of(s) for s in list(found)[:5])}, ...")
        asked = [s for s in dict.fromkeys(mixed) if s not in asked]
        found |= dict.fromkeys(asked)
    return list(found)


def field_counts(raw: DataFrame, line: str = "value", max_places: int = MAX_PLACES) -> DataFrame:
    """path, type, lines: the lines that hold a value of the type at the path."""
    rows = raw.select(F.try_parse_json(line).alias("v"))
    held = [_types(values(F.col("v"), s), path_of(s)) for s in places(rows, "v", max_places)]
    none = F.array(F.struct(F.lit("$").alias("path"), F.lit(NOT_JSON).alias("type")))
    each = rows.select(F.explode(F.when(F.col("v").isNull(), none).otherwise(F.flatten(F.array(*held)))).alias("f"))
    return each.groupBy("f.path", "f.type").agg(F.count(F.lit(1)).alias("lines"))


def against(counts: DataFrame, schema: T.StructType) -> DataFrame:
    """The counts with `status` for a reader schema: known, bad_type, unknown_field (it and all below), not_json."""
    takes: dict[str, tuple[str, ...] | None] = {}

    def walk(t: T.DataType, steps: Steps) -> None:
        takes[path_of(steps)] = (*FITS.get(type(t), SCALARS), "VOID")
        if isinstance(t, T.StructType):
            for f in t.fields:
                walk(f.dataType, (*steps, f.name))
        elif isinstance(t, T.ArrayType):
            walk(t.elementType, (*steps, None))

    walk(schema, ())
    status = F.when(F.col("type") == NOT_JSON, "not_json").when(~F.col("path").isin(list(takes)), "unknown_field")
    for path, types in takes.items():
        status = status.when((F.col("path") == path) & F.col("type").isin(list(types)), "known")
    return counts.withColumn("status", status.otherwise("bad_type"))


def unknown_fields(v: Column, schema: T.StructType, steps: Steps = ()) -> Column:
    """Paths of a line's fields that the schema lacks, at any depth (array<string>)."""
    keys = F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<string>"))
    names = F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")
    found = F.transform(F.array_except(keys, names), lambda k: F.concat(F.lit(path_of(steps) + "."), k))
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            found = F.concat(found, unknown_fields(member(v, f.name), f.dataType, (*steps, f.name)))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            each = _unknown_in(f.dataType.elementType, (*steps, f.name, None))
            found = F.concat(found, F.array_distinct(F.flatten(F.transform(elements(member(v, f.name)), each))))
    return found


def _unknown_in(schema: T.StructType, steps: Steps):
    return lambda x: unknown_fields(x, schema, steps)


def typed(v: Column, want: T.DataType) -> tuple[Column, Column]:
    """(the value in the reader's type, whether a value is there that does not fit it).  A part that does
    not fit is NULL; what is beside it stays."""
    there = F.coalesce(v.isNotNull() & ~F.is_variant_null(v), F.lit(False))
    fits = F.coalesce(kind(v).isin(list(FITS.get(type(want), SCALARS))), F.lit(False))
    if isinstance(want, T.StructType):
        parts = {f.name: typed(member(v, f.name), f.dataType) for f in want.fields}
        value = F.struct(*[x.alias(n) for n, (x, _) in parts.items()])
        bad = reduce(lambda a, b: a | b, [b for _, b in parts.values()], F.lit(False))
        return F.when(fits, value), (there & ~fits) | bad
    if isinstance(want, T.ArrayType):
        value = F.transform(elements(v), lambda x: typed(x, want.elementType)[0])
        return F.when(fits, value), (there & ~fits) | F.exists(elements(v), lambda x: typed(x, want.elementType)[1])
    value = F.when(fits, F.try_variant_get(v, "$", want.simpleString()))
    return value, there & value.isNull()
