"""Checks of documents and rows: a subset of JSON Schema compiled to expressions, rules as one row per broken rule, and what follows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NONE = "array<string>"


def resolve(root: dict, ref: str) -> dict:
    """The part of a schema that a local JSON pointer names."""
    if not ref.startswith("#/"):
        raise ValueError(f"only local references are known, not {ref}")
    return reduce(lambda node, part: node[part.replace("~1", "/").replace("~0", "~")], ref[2:].split("/"), root)


def _is(kind: Column, name: str) -> Column:
    """Whether the text of schema_of_variant is a JSON Schema type."""
    number = kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)")
    return {
        "object": kind.startswith("OBJECT"), "array": kind.startswith("ARRAY"), "string": kind == "STRING", "boolean": kind == "BOOLEAN", "null": kind == "VOID",
        "number": number, "integer": kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\\(\\d+,0\\))"),
    }[name]


def _say(broken: Column, path: Column, what: str) -> Column:
    return F.when(F.coalesce(broken, F.lit(False)), F.array(F.concat(path, F.lit(f": {what}")))).otherwise(F.array().cast(_NONE))


def schema_errors(value: Column, schema: dict | bool, root: dict | None = None, path: Column | None = None, seen: tuple[str, ...] = ()) -> Column:
    """ARRAY<STRING> of `path: what is wrong` for a VARIANT against a schema; empty if it holds.

    Known: type, const, enum, pattern, minLength, maxLength, minimum, maximum, exclusiveMinimum, required, minProperties,
    properties, additionalProperties, propertyNames, items, minItems, maxItems and local $ref (one that contains itself raises, as the
    schema is compiled to one expression). A value of the wrong type is not looked into.
    """
    root = schema if root is None and isinstance(schema, dict) else root
    path = F.lit("$") if path is None else path
    if schema is True:
        return F.array().cast(_NONE)
    if schema is False:
        return _say(value.isNotNull(), path, "not allowed")
    kind = F.schema_of_variant(value)
    as_ = lambda t: F.try_variant_get(value, "$", t)
    if "$ref" in schema:
        if schema["$ref"] in seen:
            raise ValueError(f"{schema['$ref']} contains itself")
        below = schema_errors(value, resolve(root, schema["$ref"]), root, path, (*seen, schema["$ref"]))
        rest = {k: v for k, v in schema.items() if k != "$ref"}
        return F.concat(below, schema_errors(value, rest, root, path, seen)) if rest else below
    found: list[Column] = []
    if "const" in schema:
        found.append(_say(~_equals(value, kind, schema["const"]), path, f"expected {schema['const']!r}"))
    if "enum" in schema:
        found.append(_say(~reduce(Column.__or__, [_equals(value, kind, v) for v in schema["enum"]], F.lit(False)), path, "not one of the allowed values"))
    text, number = as_("string"), as_("double")
    of = lambda name, test, what: found.append(_say(_is(kind, name) & test, path, what))
    if "pattern" in schema:
        of("string", ~text.rlike(schema["pattern"]), f"does not match {schema['pattern']}")
    for key, name, test, what in (
        ("minLength", "string", lambda n: F.length(text) < n, "shorter than"), ("maxLength", "string", lambda n: F.length(text) > n, "longer than"),
        ("minimum", "number", lambda n: number < n, "below"), ("maximum", "number", lambda n: number > n, "above"), ("exclusiveMinimum", "number", lambda n: number <= n, "not above"),
        ("minItems", "array", lambda n: F.size(as_("array<variant>")) < n, "fewer items than"), ("maxItems", "array", lambda n: F.size(as_("array<variant>")) > n, "more items than"),
        ("minProperties", "object", lambda n: F.size(as_("map<string,variant>")) < n, "fewer properties than"),
    ):
        if key in schema:
            of(name, test(schema[key]), f"{what} {schema[key]}")
    members = as_("map<string,variant>")
    for name in schema.get("required", []):
        of("object", ~F.map_contains_key(members, name), f"{name} is missing")
    known = schema.get("properties", {})
    for name, own in known.items():
        inner = F.try_element_at(members, F.lit(name))
        found.append(F.when(_is(kind, "object") & F.map_contains_key(members, name), schema_errors(inner, own, root, F.concat(path, F.lit(f".{name}")), seen)).otherwise(F.array().cast(_NONE)))
    extra = schema.get("additionalProperties", True)
    if extra is not True or "propertyNames" in schema:
        def entry(e: Column) -> Column:
            at = F.concat(path, F.lit("."), e["key"])
            parts = []
            if "propertyNames" in schema:
                parts.append(schema_errors(F.parse_json(F.concat(F.lit('"'), F.regexp_replace(e["key"], r'(["\\])', r"\\$1"), F.lit('"'))), schema["propertyNames"], root, F.concat(at, F.lit(" (name)")), seen))
            if extra is not True:
                unknown = ~e["key"].isin(*known) if known else F.lit(True)
                parts.append(F.when(unknown, F.array(F.concat(at, F.lit(": unexpected"))) if extra is False else schema_errors(e["value"], extra, root, at, seen)).otherwise(F.array().cast(_NONE)))
            return F.concat(*parts)

        found.append(F.when(_is(kind, "object"), F.flatten(F.transform(F.map_entries(members), entry))).otherwise(F.array().cast(_NONE)))
    if "items" in schema:
        listed = F.flatten(F.transform(as_("array<variant>"), lambda v, i: schema_errors(v, schema["items"], root, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), seen)))
        found.append(F.when(_is(kind, "array"), listed).otherwise(F.array().cast(_NONE)))
    whole = F.concat(*found) if found else F.array().cast(_NONE)
    if "type" in schema:
        allowed = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        fits = reduce(Column.__or__, [_is(kind, t) for t in allowed])
        return F.when(~F.coalesce(fits, F.lit(False)), F.array(F.concat(path, F.lit(f": expected {' or '.join(allowed)}")))).otherwise(whole)
    return whole


def _equals(value: Column, kind: Column, wanted: object) -> Column:
    """A VARIANT equals a plain JSON value; numbers by value, the rest by type and value."""
    if wanted is None:
        return kind == "VOID"
    if isinstance(wanted, bool):
        return (kind == "BOOLEAN") & F.coalesce(F.try_variant_get(value, "$", "boolean") == wanted, F.lit(False))
    if isinstance(wanted, (int, float)):
        return _is(kind, "number") & F.coalesce(F.try_variant_get(value, "$", "double") == float(wanted), F.lit(False))
    return (kind == "STRING") & F.coalesce(F.try_variant_get(value, "$", "string") == str(wanted), F.lit(False))


def versioned_errors(frame: DataFrame, document: str, schemas: dict[int, dict], default: int) -> DataFrame:
    """`frame` with `errors`: those of its JSON text against the schema of its `v`, or of the default; each once, in order; a text that is no JSON has one."""
    parsed = frame.withColumn("_v", F.try_parse_json(document))
    version = F.coalesce(F.try_variant_get("_v", "$.v", "int"), F.lit(default))
    errors = schema_errors(F.col("_v"), schemas[default])
    for number, schema in schemas.items():
        if number != default:
            errors = F.when(version == number, schema_errors(F.col("_v"), schema)).otherwise(errors)
    return parsed.withColumn("errors", F.when(F.col("_v").isNull(), F.array(F.lit("$: no JSON"))).otherwise(F.array_distinct(errors))).drop("_v")


def broken_rules(frame: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """rule, key: one row per row and rule that it breaks (true), in one pass; a rule that cannot be decided (null) is not broken."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]))
    return frame.select(F.explode(broken).alias("rule"), key)


def unknown_members(frame: DataFrame, key: str, column: str, known: DataFrame, member: str, rule: str) -> DataFrame:
    """rule, key of rows whose value is given and no member of the known ones."""
    return frame.where(F.col(column).isNotNull()).join(known.select(F.col(member).alias("_m")), F.col(column) == F.col("_m"), "left_anti").select(F.lit(rule).alias("rule"), key)


def quarantined(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """`frame` with `quarantine`, the name of the first rule a row breaks, null for good rows; nothing is dropped or raised."""
    out = F.lit(None).cast("string")
    for name, test in reversed(rules.items()):
        out = F.when(F.coalesce(test, F.lit(False)), name).otherwise(out)
    return frame.withColumn("quarantine", out)


def report_status(errors: Column, warnings: Column) -> Column:
    """error if there are errors, else warning if there are warnings, else ok."""
    return F.when(F.coalesce(errors, F.lit(0)) > 0, "error").when(F.coalesce(warnings, F.lit(0)) > 0, "warning").otherwise("ok")
