"""Nested documents: JSON text or VARIANT fields, containment, key tests, arrays, maps."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_variant(col: Column | str) -> Column:
    """Text to VARIANT; malformed text gives NULL."""
    return F.try_parse_json(col)


def text_at(v: Column, path: str) -> Column:
    """The value at ``path`` as text (``->>``)."""
    return F.try_variant_get(v, path, "string")


def _step(path: str, key: str) -> str:
    escaped = key.replace("\\", "\\\\").replace("'", "\\'")
    return f"{path}['{escaped}']"


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_object(v: Column) -> Column:
    return _kind(v).startswith("OBJECT")


def _is_array(v: Column) -> Column:
    return _kind(v).startswith("ARRAY")


def _is_number(v: Column) -> Column:
    return _kind(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")


def _scalar_equals(v: Column, value: Any) -> Column:
    """Typed equality: ``"1"`` and ``1`` differ, ``1`` and ``1.0`` do not."""
    if value is None:
        return _kind(v) == "VOID"
    if isinstance(value, bool):
        return (_kind(v) == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == F.lit(value))
    if isinstance(value, (int, float)):
        wanted = F.lit(str(value)).cast("decimal(38,10)")
        return _is_number(v) & (F.try_variant_get(v, "$", "decimal(38,10)") == wanted)
    return (_kind(v) == "STRING") & (F.try_variant_get(v, "$", "string") == F.lit(value))


def _matches(v: Column, pattern: Any, nested: bool) -> Column:
    if isinstance(pattern, dict):
        tests = [_is_object(v)]
        for key, value in pattern.items():
            tests.append(_matches(F.try_variant_get(v, _step("$", key), "variant"), value, True))
    elif isinstance(pattern, list):
        items = F.try_variant_get(v, "$", "array<variant>")
        tests = [_is_array(v)]
        tests += [_any_matches(items, value) for value in pattern]
    else:
        tests = [_scalar_equals(v, pattern)]
        if not nested:
            # At the top level an array contains a scalar that is one of its elements.
            items = F.try_variant_get(v, "$", "array<variant>")
            inside = _is_array(v) & F.exists(items, lambda item: _scalar_equals(item, pattern))
            return F.coalesce(tests[0], F.lit(False)) | F.coalesce(inside, F.lit(False))
    hit = tests[0]
    for test in tests[1:]:
        hit = hit & test
    return F.coalesce(hit, F.lit(False))


def _any_matches(items: Column, value: Any) -> Column:
    return F.exists(items, lambda item: _matches(item, value, True))


def contains_json(v: Column, pattern: str | dict | list) -> Column:
    """``v @> pattern``: every key of the pattern is there with an equal (or containing) value.

    The pattern is fixed, so it unfolds into a conjunction of typed path tests that run per row.
    """
    wanted = json.loads(pattern) if isinstance(pattern, str) else pattern
    return F.when(v.isNotNull(), _matches(v, wanted, False))


def _keys(json_text: Column) -> Column:
    return F.json_object_keys(json_text)


def has_key(json_text: Column, key: str) -> Column:
    """``?``: the top-level object has the key, also when its value is null."""
    return F.array_contains(_keys(json_text), key)


def has_any_key(json_text: Column, keys: list[str]) -> Column:
    """``?|``"""
    return F.arrays_overlap(_keys(json_text), F.array(*map(F.lit, keys)))


def has_all_keys(json_text: Column, keys: list[str]) -> Column:
    """``?&``"""
    return contains_all(_keys(json_text), keys)


def contains_all(arr: Column, values: list) -> Column:
    """``arr @> values``: every value is an element."""
    hit = F.lit(True)
    for value in values:
        hit = hit & F.array_contains(arr, value)
    return F.when(arr.isNotNull(), hit)


def any_element_rlike(v: Column, path: str, pattern: str) -> Column:
    """Regex on a field that may be one text or an array of texts."""
    field = F.try_variant_get(v, path, "variant")
    one = F.try_variant_get(field, "$", "string").rlike(pattern) & (_kind(field) == "STRING")
    items = F.try_variant_get(field, "$", "array<string>")
    many = _is_array(field) & F.exists(items, lambda item: item.rlike(pattern))
    return F.coalesce(one, F.lit(False)) | F.coalesce(many, F.lit(False))


def parse_pairs(text: Column) -> Column:
    """``'a => 1, b => 2'`` to a map."""
    return F.str_to_map(text, F.lit(r",\s*"), F.lit(r"\s*=>\s*"))


def not_equal_or_missing(col: Column, value: str) -> Column:
    """Document-store inequality: rows without the field pass."""
    return ~col.eqNullSafe(F.lit(value))


def non_empty(arr: Column) -> Column:
    """The array has a first element; false for missing arrays."""
    return F.coalesce(F.size(arr) > 0, F.lit(False))
