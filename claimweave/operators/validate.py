"""JSON Schema contracts as column expressions over the parsed document.

The documents are checked as variants, so closed objects, required keys, types,
constants, enumerations, bounds and patterns are all built-in expressions; a
list is checked item by item with higher-order functions.

``errors`` holds one text a violation, sorted: ``$.path: what``.  Defined
results: a null payload or one that is not JSON has the one error
``$: not JSON``; a schema keyword outside of the supported ones is refused when
the schema is compiled; an explicit null violates its type.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUPPORTED = {"$schema", "$id", "title", "description", "type", "required", "additionalProperties", "properties", "items", "const", "enum", "minimum", "maximum", "minLength", "minItems", "pattern", "format", "default"}
_TYPES = {"string": ("STRING",), "boolean": ("BOOLEAN",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",)}


def _check(condition: Column, path: str, text: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.array(F.lit(f"{path}: {text}"))).otherwise(F.array().cast("array<string>"))


def _kind(value: Column) -> Column:
    """Name of a variant's type, without parameters."""
    return F.regexp_extract(F.schema_of_variant(value), r"^([A-Z]+)", 1)


def _members(value: Column) -> Column:
    """Members of an object; null for anything else.  Its whole type, which is costly, is not derived."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _has(value: Column, key: str) -> Column:
    """Whether an object has a key, be its value null."""
    return F.try_variant_get(value, f"$.{key}", "variant").isNotNull() if re.fullmatch(r"[A-Za-z_]\w*", key) else F.array_contains(F.map_keys(_members(value)), key)


def _errors(value: Column, schema: dict, path: str) -> list[Column]:
    unknown = set(schema) - SUPPORTED
    if unknown:
        raise ValueError(f"{path}: keywords {sorted(unknown)} are not supported")
    out: list[Column] = []
    kind = _kind(value)
    there = value.isNotNull()
    types = schema.get("type", [])
    types = [types] if isinstance(types, str) else types
    is_object, is_array = _members(value).isNotNull(), F.try_variant_get(value, "$", "array<variant>").isNotNull()
    if set(types) <= {"object", "array"}:
        if types:
            fits = is_object if types == ["object"] else is_array if types == ["array"] else is_object | is_array
            out.append(_check(there & ~fits, path, f"not of type {'/'.join(types)}"))
    else:
        allowed = [name for t in types for name in _TYPES[t]]
        whole = F.when(kind.isin("DECIMAL", "DOUBLE"), F.try_variant_get(value, "$", "double") % 1 == 0) if "integer" in types and "number" not in types else F.lit(False)
        out.append(_check(there & ~kind.isin(*allowed) & ~F.coalesce(whole, F.lit(False)), path, f"not of type {'/'.join(types)}"))
    text, number = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")
    is_text, is_number = kind == "STRING", kind.isin("BIGINT", "DOUBLE", "DECIMAL")
    for keyword in ("const", "enum"):
        if keyword in schema:
            options = [schema[keyword]] if keyword == "const" else schema[keyword]
            hit = F.lit(False)
            for o in options:
                hit = hit | F.coalesce((is_text & (text == o)) if isinstance(o, str) else ((kind == "BOOLEAN") & (text == str(o).lower())) if isinstance(o, bool) else (is_number & (number == float(o))) if o is not None else (kind == "VOID"), F.lit(False))
            out.append(_check(there & ~hit, path, f"not one of {options}"))
    if "minimum" in schema:
        out.append(_check(is_number & (number < schema["minimum"]), path, f"below {schema['minimum']}"))
    if "maximum" in schema:
        out.append(_check(is_number & (number > schema["maximum"]), path, f"above {schema['maximum']}"))
    if "minLength" in schema:
        out.append(_check(is_text & (F.length(text) < schema["minLength"]), path, f"shorter than {schema['minLength']}"))
    if "pattern" in schema:
        out.append(_check(is_text & ~text.rlike(schema["pattern"]), path, f"does not match {schema['pattern']}"))
    if schema.get("format") == "date":
        out.append(_check(is_text & F.try_to_date(text, "yyyy-MM-dd").isNull(), path, "not a date"))
    if "properties" in schema or schema.get("additionalProperties") is False or "required" in schema:
        properties = schema.get("properties", {})
        keys = F.map_keys(_members(value))
        for key in schema.get("required", []):
            out.append(_check(is_object & ~_has(value, key), path, f"'{key}' is missing"))
        if schema.get("additionalProperties") is False:
            extra = F.array_except(keys, F.array(*[F.lit(k) for k in properties]) if properties else F.array().cast("array<string>"))
            named = F.transform(extra, lambda k: F.concat(F.lit(f"{path}: unexpected '"), k, F.lit("'")))
            out.append(F.coalesce(F.when(is_object, named), F.array().cast("array<string>")))
        for key, sub in properties.items():
            out.extend(_errors(F.try_variant_get(value, f"$.{key}", "variant"), sub, f"{path}.{key}"))
    if "items" in schema or "minItems" in schema:
        items = F.try_variant_get(value, "$", "array<variant>")
        if "minItems" in schema:
            out.append(_check(is_array & (F.size(items) < schema["minItems"]), path, f"fewer than {schema['minItems']} items"))
        if "items" in schema:
            found = F.flatten(F.transform(items, lambda item: F.concat(F.array().cast("array<string>"), *_errors(item, schema["items"], f"{path}[]"))))
            out.append(F.coalesce(F.when(is_array, F.array_distinct(found)), F.array().cast("array<string>")))
    return out


def _found(value: Column, schema: dict) -> Column:
    """Sorted errors of a parsed document against the schema."""
    found = F.array_sort(F.concat(F.array().cast("array<string>"), *_errors(value, schema, "$")))
    return F.when(value.isNull(), F.array(F.lit("$: not JSON"))).otherwise(found)


def schema_errors(payload: Column, schema: dict) -> Column:
    """Sorted errors of a JSON text against the schema; an empty array for a valid one."""
    return _found(F.try_parse_json(payload), schema)


def validate(df: DataFrame, payload: str, schema: dict) -> DataFrame:
    """``df`` with ``errors`` and ``is_valid``."""
    # a column of its own, so that a text is parsed once and not for every check
    parsed = df.withColumn("__parsed", F.try_parse_json(payload))
    return parsed.withColumn("errors", _found(F.col("__parsed"), schema)).drop("__parsed").withColumn("is_valid", F.size("errors") == 0)


def require_valid(df: DataFrame, payload: str, schema: dict) -> DataFrame:
    """``df`` unchanged; a violation fails the query with its errors."""
    checked = validate(df, payload, schema)
    return checked.where(F.when(F.col("is_valid"), F.lit(True)).otherwise(F.raise_error(F.array_join("errors", "; ")).cast("boolean"))).select(*df.columns)


def unexpected_keys(payload: Column, allowed: tuple[str, ...]) -> Column:
    """Top-level keys outside of a whitelist."""
    return F.array_sort(F.array_except(F.json_object_keys(payload), F.array(*[F.lit(k) for k in allowed])))
