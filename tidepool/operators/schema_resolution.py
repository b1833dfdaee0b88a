"""P13 for nested data: rows written with one schema read with another, as one expression tree.

Schemas are Avro schemas (parsed JSON); rows are laid out as Spark's Avro reader lays them out: records
are structs, enums strings, fixed and bytes binary, and a union is its one branch (nullable), a long or a
double for int + long or float + double, or else a struct `member0, member1, ...` of its branches without
null.  `resolve` walks both schemas once and returns a Column, so a table is one projection: no codec, no
Python per row.

The rules are those of the Avro specification: fields by name or the reader's alias; a field that only
the reader has takes its default, one that only the writer has is left out; int -> long -> float ->
double, string <-> bytes; an unknown enum symbol becomes the reader enum's default; arrays and maps by
their elements; of a reader's union the first branch that matches.  What can never resolve is a
`SchemaMismatch` at once, with its path; what depends on the row (a branch of the writer's union, a symbol,
a null) is an error when such a row is read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = Any  # str | dict | list
Convert = Callable[[Column], Column]

PRIMITIVES: dict[str, T.DataType] = {
    "null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType(),
}
PROMOTIONS: dict[str, tuple[str, ...]] = {
    "int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",), "string": ("bytes",), "bytes": ("string",),
}


class SchemaMismatch(ValueError):
    """The writer's schema cannot be read with the reader's."""


class _Names:
    """Named types of one schema, for references to them."""

    def __init__(self):
        self.of: dict[str, dict] = {}

    def define(self, schema: dict) -> None:
        for name in (schema["name"], _full(schema)):
            self.of[name] = schema

    def look_up(self, schema: Schema, path: str) -> Schema:
        """A schema with names resolved and primitives as plain strings."""
        if isinstance(schema, dict) and isinstance(schema["type"], (dict, list)):
            return self.look_up(schema["type"], path)
        if isinstance(schema, dict) and schema["type"] in PRIMITIVES:
            return schema["type"]
        if isinstance(schema, str) and schema not in PRIMITIVES:
            if schema not in self.of:
                raise SchemaMismatch(f"{path}: unknown type {schema!r}")
            return self.of[schema]
        if isinstance(schema, dict) and schema["type"] in ("record", "enum", "fixed"):
            self.define(schema)
        return schema


def _full(schema: dict) -> str:
    return schema["name"] if "." in schema["name"] or not schema.get("namespace") else f"{schema['namespace']}.{schema['name']}"


def _kind(schema: Schema) -> str:
    return "union" if isinstance(schema, list) else schema if isinstance(schema, str) else schema["type"]


def _same_name(writer: dict, reader: dict) -> bool:
    short = lambda n: n.rpartition(".")[2]
    return short(writer["name"]) in {short(n) for n in (reader["name"], *reader.get("aliases", ()))}


def _members(union: list, names: _Names, path: str) -> list[Schema]:
    """The branches of a union without null, as Spark lays them out: int + long are one long, and so on."""
    branches = [names.look_up(b, path) for b in union]
    rest = [b for b in branches if b != "null"]
    kinds = {_kind(b) for b in rest}
    if len(rest) == 2 and kinds in ({"int", "long"}, {"float", "double"}):
        return ["long" if "long" in kinds else "double"]
    return rest


def _nullable(union: list, names: _Names, path: str) -> bool:
    return any(names.look_up(b, path) == "null" for b in union)


def spark_type(schema: Schema, names: _Names | None = None, path: str = "$", inside: tuple = ()) -> T.DataType:
    """The Spark type that values of a schema have."""
    names = names or _Names()
    schema = names.look_up(schema, path)
    kind = _kind(schema)
    if kind in PRIMITIVES:
        return PRIMITIVES[kind]
    if kind == "enum":
        return T.StringType()
    if kind == "fixed":
        return T.BinaryType()
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"], names, f"{path}[*]", inside))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"], names, f"{path}.*", inside))
    if kind == "union":
        members = _members(schema, names, path)
        if len(members) == 1:
            return spark_type(members[0], names, path, inside)
        return T.StructType([T.StructField(f"member{i}", spark_type(m, names, path, inside)) for i, m in enumerate(members)])
    if kind == "record":
        if id(schema) in inside:
            raise SchemaMismatch(f"{path}: {schema['name']} holds itself; a table cannot")
        return T.StructType([T.StructField(f["name"], spark_type(f["type"], names, f"{path}.{f['name']}", (*inside, id(schema)))) for f in schema["fields"]])
    raise SchemaMismatch(f"{path}: unknown type {kind!r}")


def default_value(value: Any, schema: Schema, names: _Names, path: str) -> Column:
    """A default of a schema (JSON) as a Column.  A union's default is of its first branch."""
    schema = names.look_up(schema, path)
    kind, want = _kind(schema), spark_type(schema, names, path)
    if kind == "union":
        first = names.look_up(schema[0], path)
        made = default_value(value, first, names, path)
        return made.cast(want) if first == "null" else _as_branch(made, first, schema, names, path)
    if kind == "null":
        return F.lit(None)
    if kind in ("bytes", "fixed"):
        return F.lit(value.encode("latin-1"))
    if kind == "array":
        return F.array(*[default_value(v, schema["items"], names, path) for v in value]).cast(want)
    if kind == "map":
        pairs = [c for k, v in value.items() for c in (F.lit(k), default_value(v, schema["values"], names, path))]
        return F.create_map(*pairs).cast(want)
    if kind == "record":
        fields = []
        for f in schema["fields"]:
            if f["name"] not in value and "default" not in f:
                raise SchemaMismatch(f"{path}.{f['name']}: the default lacks it")
            fields.append(default_value(value.get(f["name"], f.get("default")), f["type"], names, f"{path}.{f['name']}").alias(f["name"]))
        return F.struct(*fields).cast(want)
    return F.lit(value).cast(want)


def _as_branch(value: Column, branch: Schema, union: list, names: _Names, path: str) -> Column:
    """A value of one branch in the layout of its union."""
    members, want = _members(union, names, path), spark_type(union, names, path)
    if len(members) == 1:
        return value.cast(want)
    at = next(i for i, m in enumerate(members) if m == branch)
    made = F.struct(*[(value if i == at else F.lit(None)).alias(f"member{i}") for i in range(len(members))]).cast(want)
    return F.when(value.isNotNull(), made)


class _Resolver:
    def __init__(self):
        self.w, self.r = _Names(), _Names()

    def __call__(self, writer: Schema, reader: Schema, path: str) -> Convert:
        writer, reader = self.w.look_up(writer, path), self.r.look_up(reader, path)
        if _kind(writer) == "union":
            return self.from_union(writer, reader, path)
        if _kind(reader) == "union":
            return self.to_union(writer, reader, path)
        w, r = _kind(writer), _kind(reader)
        want = spark_type(reader, self.r, path)
        if w in PRIMITIVES and (r == w or r in PROMOTIONS.get(w, ())):
            return lambda c: c.cast(want)
        if w == r == "array":
            each = self(writer["items"], reader["items"], f"{path}[*]")
            return lambda c: F.transform(c, lambda x: each(x)).cast(want)
        if w == r == "map":
            each = self(writer["values"], reader["values"], f"{path}.*")
            return lambda c: F.transform_values(c, lambda _, x: each(x)).cast(want)
        if w == r and w in ("record", "enum", "fixed") and _same_name(writer, reader):
            return getattr(self, w)(writer, reader, path, want)
        raise SchemaMismatch(f"{path}: {_told(writer)} cannot be read as {_told(reader)}")

    def fixed(self, writer: dict, reader: dict, path: str, want: T.DataType) -> Convert:
        if writer["size"] != reader["size"]:
            raise SchemaMismatch(f"{path}: {writer['size']} fixed bytes cannot be read as {reader['size']}")
        return lambda c: c

    def enum(self, writer: dict, reader: dict, path: str, want: T.DataType) -> Convert:
        symbols = list(reader["symbols"])
        if set(writer["symbols"]) <= set(symbols):
            return lambda c: c
        if "default" in reader:
            return lambda c: F.when(c.isNotNull(), F.when(c.isin(symbols), c).otherwise(F.lit(reader["default"])))
        return lambda c: F.when(c.isNull() | c.isin(symbols), c).otherwise(_error(F.concat(F.lit(f"{path}: the reader has no symbol "), c), want))

    def record(self, writer: dict, reader: dict, path: str, want: T.DataType) -> Convert:
        have = {f["name"]: f for f in writer["fields"]}
        parts: list[tuple[str, Callable[[Column], Column]]] = []
        for f in reader["fields"]:
            at = f"{path}.{f['name']}"
            source = next((n for n in (f["name"], *f.get("aliases", ())) if n in have), None)
            if source is not None:
                parts.append((f["name"], _member_of(source, self(have[source]["type"], f["type"], at))))
            elif "default" in f:
                parts.append((f["name"], _always(default_value(f["default"], f["type"], self.r, at))))
            else:
                raise SchemaMismatch(f"{at}: the writer lacks it and it has no default")
        return lambda c: F.when(c.isNotNull(), F.struct(*[get(c).alias(n) for n, get in parts])).cast(want)

    def to_union(self, writer: Schema, reader: list, path: str) -> Convert:
        reasons = []
        for branch in reader:
            branch = self.r.look_up(branch, path)
            try:
                convert = self(writer, branch, path)
            except SchemaMismatch as e:
                reasons.append(str(e))
                continue
            if branch == "null":
                want = spark_type(reader, self.r, path)
                return lambda c: F.lit(None).cast(want)
            members = _members(reader, self.r, path)
            kept = branch if branch in members else members[0]
            return lambda c: _as_branch(convert(c), kept, reader, self.r, path)
        raise SchemaMismatch("; ".join(reasons) or f"{path}: an empty union")

    def from_union(self, writer: list, reader: Schema, path: str) -> Convert:
        members, want = _members(writer, self.w, path), spark_type(reader, self.r, path)
        converts: list[Convert] = []
        reasons = []
        for m in members:
            try:
                converts.append(self(m, reader, path))
            except SchemaMismatch as e:
                reasons.append(str(e))
                converts.append(_fails(f"{path}: a row of {_told(m)} cannot be read as {_told(reader)}", want))
        if members and len(reasons) == len(members):
            raise SchemaMismatch("; ".join(reasons))
        takes_null = _kind(reader) == "null" or (_kind(reader) == "union" and _nullable(reader, self.r, path))
        nulls = _always(F.lit(None).cast(want)) if takes_null else _fails(f"{path}: null cannot be read as {_told(reader)}", want)
        if not _nullable(writer, self.w, path):
            nulls = _always(F.lit(None).cast(want))
        if not members:
            return nulls
        if len(members) == 1:
            return lambda c: F.when(c.isNotNull(), converts[0](c)).otherwise(nulls(c))

        def pick(c: Column) -> Column:
            chosen = F.when(c.isNull(), nulls(c))
            for i, convert in enumerate(converts):
                chosen = chosen.when(c[f"member{i}"].isNotNull(), convert(c[f"member{i}"]))
            return chosen.otherwise(nulls(c))

        return pick


def _member_of(name: str, convert: Convert) -> Convert:
    return lambda c: convert(c.getField(name))


def _always(value: Column) -> Convert:
    return lambda _: value


def _error(message: Column, want: T.DataType) -> Column:
    return F.raise_error(message).cast(want)


def _fails(message: str, want: T.DataType) -> Convert:
    return lambda _: _error(F.lit(message), want)


def _told(schema: Schema) -> str:
    return f"{_kind(schema)} {schema['name']}" if isinstance(schema, Mapping) and "name" in schema else _kind(schema)


def resolve(writer: Schema, reader: Schema) -> Convert:
    """A function from a Column in the writer's layout to one in the reader's."""
    return _Resolver()(writer, reader, "$")


def read_as(df: DataFrame, writer: Schema, reader: Schema) -> DataFrame:
    """A table of the writer's record (a column per field) as one of the reader's; other columns are left out."""
    have = [f["name"] for f in writer["fields"]]
    row = resolve(writer, reader)(F.struct(*[F.col(f"`{n}`") for n in have]))
    return df.select(row.alias("_row")).select("_row.*")
