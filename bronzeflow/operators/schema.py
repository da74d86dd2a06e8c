"""JSON-Schema subset compiled to an array of errors per row.

A schema becomes one SQL expression. ``check_variant`` checks message bodies
held as VARIANT, where every type is open; ``check_struct`` checks typed
columns, where types are settled when the plan is built and only nulls, ranges
and patterns are left to look at. A null field of a struct stands for JSON null.

Errors of an object itself (missing or unknown members) come before those of
its members, so the first error is the one closest to the root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.functions.sql import text
from bronzeflow.operators.once import compute_once

ERROR_TYPE = "struct<path:string,validator:string,message:string>"
SUPPORTED = {
    "type", "required", "properties", "additionalProperties", "const", "enum", "pattern",
    "minLength", "maxLength", "minimum", "maximum", "items", "minItems", "oneOf", "allOf", "not",
    "$ref", "$defs", "$id", "$schema", "title", "description", "format", "examples",
}
TRUE, FALSE = "true", "false"
_ONE_NEWLINE = r"\n?\z"


def java_pattern(pattern: str) -> str:
    """``$`` at the end also allows one final newline, as the schema dialect's engine does."""
    return pattern[:-1] + _ONE_NEWLINE if pattern.endswith("$") else pattern


def _not(condition: str) -> str:
    return {TRUE: FALSE, FALSE: TRUE}.get(condition, f"NOT ({condition})")


def _and(*conditions: str) -> str:
    if FALSE in conditions:
        return FALSE
    return " AND ".join(f"({c})" for c in conditions if c != TRUE) or TRUE


def _or(*conditions: str) -> str:
    if TRUE in conditions:
        return TRUE
    return " OR ".join(f"({c})" for c in conditions if c != FALSE) or FALSE


class VariantNode:
    """A JSON value of unknown type; SQL NULL when the member is absent."""

    def __init__(self, value: str, **parts: str):
        self.value = value
        self.present = f"{value} IS NOT NULL"
        self.kind = parts.get("kind", f"schema_of_variant({value})")
        self.text = parts.get("text", f"try_variant_get({value}, '$', 'string')")
        self.number = parts.get("number", f"try_variant_get({value}, '$', 'double')")
        self.names = parts.get(
            "names", f"map_keys(try_variant_get({value}, '$', 'map<string,variant>'))"
        )
        self.elements = f"try_variant_get({value}, '$', 'array<variant>')"
        self.shown = f"coalesce(to_json({value}), 'null')"
        self.children: dict[str, VariantNode] = {}

    def has_type(self, name: str) -> str:
        number = f"{self.kind} RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL)'"
        return {
            "string": f"{self.kind} = 'STRING'",
            "null": f"{self.kind} = 'VOID'",
            "boolean": f"{self.kind} = 'BOOLEAN'",
            "array": f"startswith({self.kind}, 'ARRAY')",
            "object": f"startswith({self.kind}, 'OBJECT')",
            "number": number,
            "integer": f"{number} AND floor({self.number}) = {self.number}",
        }[name]

    def equals(self, value) -> str:
        """Whether the value is this JSON scalar, type included."""
        if value is None:
            return self.has_type("null")
        if isinstance(value, bool):
            return _and(self.has_type("boolean"), f"{self.text} = '{str(value).lower()}'")
        if isinstance(value, str):
            return _and(self.has_type("string"), f"{self.text} = {text(value)}")
        return _and(self.has_type("number"), f"{self.number} = {float(value)}D")

    def child(self, name: str) -> VariantNode:
        return self.children.get(name) or VariantNode(_member(self.value, name))

    def unknown(self, known: list[str]) -> str | None:
        """Sorted names of members outside ``known``; None when there cannot be any."""
        return f"array_sort(array_except({self.names}, array({', '.join(map(text, known))})))"

    def element(self, value: str) -> VariantNode:
        return VariantNode(value)


class ColumnNode:
    """A typed column; null stands for JSON null, the member itself is always there."""

    def __init__(self, value: str, data_type: T.DataType | None):
        self.value = value
        self.data_type = data_type
        self.present = FALSE if data_type is None else TRUE
        self.text = value
        self.number = f"CAST({value} AS DOUBLE)"
        self.elements = value
        nested = isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))
        self.shown = f"coalesce({f'to_json({value})' if nested else f'CAST({value} AS STRING)'}, 'null')"

    def has_type(self, name: str) -> str:
        if name == "null":
            return f"{self.value} IS NULL"
        fractional = (T.FloatType, T.DoubleType, T.DecimalType)
        if name == "integer" and isinstance(self.data_type, fractional):
            return f"{self.value} IS NOT NULL AND floor({self.value}) = {self.value}"
        classes = {
            "string": (T.StringType,),
            "boolean": (T.BooleanType,),
            "array": (T.ArrayType,),
            "object": (T.StructType, T.MapType),
            "integer": (T.IntegralType,),
            "number": (T.NumericType,),
        }[name]
        return f"{self.value} IS NOT NULL" if isinstance(self.data_type, classes) else FALSE

    def equals(self, value) -> str:
        if value is None:
            return f"{self.value} IS NULL"
        wanted = {bool: T.BooleanType, str: T.StringType}.get(type(value), T.NumericType)
        if not isinstance(self.data_type, wanted):
            return FALSE
        literal = text(value) if isinstance(value, str) else str(value).lower()
        return f"{self.value} <=> {literal}"

    def child(self, name: str) -> ColumnNode:
        if isinstance(self.data_type, T.StructType) and name in self.data_type.names:
            return ColumnNode(f"{self.value}.`{name}`", self.data_type[name].dataType)
        return ColumnNode("NULL", None)

    def unknown(self, known: list[str]) -> str | None:
        names = self.data_type.names if isinstance(self.data_type, T.StructType) else []
        extra = sorted(set(names) - set(known))
        return f"array({', '.join(map(text, extra))})" if extra else None

    def element(self, value: str) -> ColumnNode:
        return ColumnNode(value, self.data_type.elementType)


def check_variant(df: DataFrame, column: str, schema: dict, into: str) -> DataFrame:
    """Add the errors of a VARIANT column: empty when valid, null when the column is.

    The members named in the schema are taken apart once, in projections of
    their own, instead of once per rule.
    """
    names = list(schema.get("properties", {}))
    taken = [f"schema_of_variant({column}) AS _kind"]
    taken.append(f"map_keys(try_variant_get({column}, '$', 'map<string,variant>')) AS _names")
    parts, root = [], VariantNode(column, kind="_kind", names="_names")
    for i, name in enumerate(names):
        taken.append(f"{_member(column, name)} AS _v{i}")
        member = VariantNode(f"_v{i}")
        parts += [
            f"{member.kind} AS _k{i}", f"{member.text} AS _t{i}", f"{member.number} AS _n{i}"
        ]
        root.children[name] = VariantNode(f"_v{i}", kind=f"_k{i}", text=f"_t{i}", number=f"_n{i}")
    errors = f"CASE WHEN {column} IS NOT NULL THEN {_all_errors(root, schema, text('$'), schema)} END"
    apart = df.selectExpr("*", *taken).selectExpr("*", *parts)
    return compute_once(apart, into, F.expr(errors)).select(*df.columns, into)


def check_struct(df: DataFrame, column: str, schema: dict, into: str) -> DataFrame:
    """Add the errors of a struct column: empty when valid."""
    node = ColumnNode(f"`{column}`", df.schema[column].dataType)
    return compute_once(df, into, F.expr(_all_errors(node, schema, text("$"), schema)))


def first_error(errors: Column) -> Column:
    """Text of the error closest to the root, null without errors."""
    return F.try_element_at(errors, F.lit(1))["message"]


def _all_errors(node, schema: dict, path: str, root: dict) -> str:
    """SQL of the array of all errors."""
    singles, arrays = _rules(node, schema, path, root)
    empty = f"CAST(array() AS array<{ERROR_TYPE}>)"
    found = f"array_compact(array({', '.join(singles)}))" if singles else empty
    more = [f"coalesce({a}, {empty})" for a in arrays]
    return f"concat({', '.join([found, *more])})" if more else found


def _rules(node, schema: dict, path: str, root: dict) -> tuple[list[str], list[str]]:
    """(SQL of one error or null each, SQL of arrays of errors)."""
    unsupported = set(schema) - SUPPORTED
    if unsupported:
        raise ValueError(f"unsupported schema keywords: {sorted(unsupported)}")
    if "$ref" in schema:
        own_part = {k: v for k, v in schema.items() if k != "$ref"}
        schema = {**_resolve(schema["$ref"], root), **own_part}

    own: list[str] = []
    members: list[str] = []
    arrays: list[str] = []

    def fail(condition: str, validator: str, message: str, lead: str = node.shown) -> None:
        when = _and(node.present, condition)
        if when != FALSE:
            error = (
                f"named_struct('path', {path}, 'validator', {text(validator)}, "
                f"'message', concat({lead}, {text(message)}))"
            )
            own.append(f"CASE WHEN {when} THEN {error} END")

    if "type" in schema:
        kinds = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        matches = _or(*[node.has_type(kind) for kind in kinds])
        fail(_not(matches), "type", f" is not of type {', '.join(kinds)}")
    if "const" in schema:
        fail(_not(node.equals(schema["const"])), "const", f" is not {schema['const']}")
    if "enum" in schema:
        hit = _or(*[node.equals(value) for value in schema["enum"]])
        fail(_not(hit), "enum", f" is not one of {schema['enum']}")
    if "pattern" in schema:
        miss = f"NOT {node.text} RLIKE {text(java_pattern(schema['pattern']))}"
        fail(_and(node.has_type("string"), miss), "pattern", f" does not match {schema['pattern']}")
    bounds: list[tuple[str, str, str, Callable[[], str]]] = [
        ("minLength", "string", "is shorter than", lambda: f"length({node.text}) <"),
        ("maxLength", "string", "is longer than", lambda: f"length({node.text}) >"),
        ("minimum", "number", "is less than", lambda: f"{node.number} <"),
        ("maximum", "number", "is greater than", lambda: f"{node.number} >"),
        ("minItems", "array", "has fewer items than", lambda: f"size({node.elements}) <"),
    ]
    for keyword, kind, words, beyond in bounds:
        if keyword in schema and node.has_type(kind) != FALSE:
            off = f"{beyond()} {schema[keyword]}"
            fail(_and(node.has_type(kind), off), keyword, f" {words} {schema[keyword]}")
    if "oneOf" in schema:
        valid = [
            f"CAST(size({_all_errors(node, branch, path, root)}) = 0 AS INT)"
            for branch in schema["oneOf"]
        ]
        fail(f"{' + '.join(valid)} <> 1", "oneOf", " does not match exactly one alternative")
    if "not" in schema:
        clean = f"size({_all_errors(node, schema['not'], path, root)}) = 0"
        fail(clean, "not", " is excluded")
    for branch in schema.get("allOf", []):
        extra, extra_arrays = _rules(node, branch, path, root)
        own += extra
        arrays += extra_arrays

    properties = schema.get("properties", {})
    is_object = node.has_type("object")
    for name in schema.get("required", []):
        missing = _and(is_object, _not(node.child(name).present))
        fail(missing, "required", " is a required property", text(name))
    if schema.get("additionalProperties", True) is False and is_object != FALSE:
        extra = node.unknown(list(properties))
        if extra:
            listed = f"array_join({extra}, ', ')"
            fail(_and(is_object, f"size({extra}) > 0"), "additionalProperties", " not expected", listed)
    for name, member in properties.items():
        inner = f"'{path[1:-1]}.{name}'" if path.startswith("'") else f"concat({path}, '.{name}')"
        singles, nested = _rules(node.child(name), member, inner, root)
        members += singles
        arrays += nested
    if "items" in schema and node.has_type("array") != FALSE:
        i, item = f"i{len(path)}", f"item{len(path)}"
        inner = f"concat({path}, '[', CAST({i} AS STRING), ']')"
        errors = _all_errors(node.element(item), schema["items"], inner, root)
        each = f"flatten(transform({node.elements}, ({item}, {i}) -> {errors}))"
        arrays.append(f"CASE WHEN {_and(node.present, node.has_type('array'))} THEN {each} END")
    return own + members, arrays


def _member(value: str, name: str) -> str:
    quoted = text(f"$['{name}']")
    return f"try_variant_get({value}, {quoted}, 'variant')"


def _resolve(ref: str, root: dict) -> dict:
    target = root
    for part in ref.removeprefix("#/").split("/"):
        target = target[part]
    return target
