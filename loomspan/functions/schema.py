"""JSON schemas of extraction requests, and results of many pages brought into one object by schema."""

from __future__ import annotations

import json

from loomspan.functions.text import json_equal

#: Schema keywords that strict output formats do not take.
UNSUPPORTED = (
    "default", "patternProperties", "unevaluatedProperties", "propertyNames", "minProperties", "maxProperties", "minLength", "maxLength", "pattern", "format", "minimum", "maximum", "multipleOf", "unevaluatedItems", "contains", "minContains", "maxContains", "minItems", "maxItems", "uniqueItems",
)
#: Names of JSON types in a schema, by Python type.
TYPES = {str: "string", bool: "boolean", int: "number", float: "number", dict: "object", list: "object", type(None): "object"}


def is_recursive(schema) -> bool:
    """Whether a schema holds references or definitions."""
    if not isinstance(schema, dict):
        return False
    written = json.dumps(schema)
    return bool(schema.get("$defs") or schema.get("definitions")) or any(mark in written for mark in ('"$ref"', "#/$defs/", "#/definitions/"))


def strict(schema):
    """Every object closed and all its properties required, in definitions and alternatives too."""
    if not isinstance(schema, dict):
        return schema
    out = dict(schema)
    if isinstance(out.get("$defs"), dict):
        out["$defs"] = {k: strict(v) for k, v in out["$defs"].items()}
    for k in ("anyOf", "oneOf", "allOf"):
        if out.get(k):
            out[k] = [strict(v) for v in out[k]]
    if out.get("not"):
        out["not"] = strict(out["not"])
    if out.get("type") == "object":
        properties = out.get("properties") or {}
        out |= {"properties": {k: strict(v) for k, v in properties.items()}, "required": list(properties), "additionalProperties": False}
    elif out.get("type") == "array":
        out["items"] = strict(out.get("items"))
    return out


def without_keywords(schema, keywords: tuple[str, ...] = UNSUPPORTED):
    """Without these keys, at any depth."""
    if isinstance(schema, list):
        return [without_keywords(v, keywords) for v in schema]
    if isinstance(schema, dict):
        return {k: without_keywords(v, keywords) for k, v in schema.items() if k not in keywords}
    return schema


def array_path(schema: dict) -> list[str] | None:
    """Where the first array property of a schema stands, looking into objects on the way."""
    for name, part in (schema.get("properties") or {}).items():
        if part.get("type") == "array":
            return [name]
        if part.get("type") == "object" and (rest := array_path(part)):
            return [name, *rest]
    return None


def gather(schema: dict, results: list) -> dict:
    """One object of many results of a schema.

    The items of its array are those of all results that have every property of
    the item schema, each with its type, without repeats; other properties come
    from the first result that has them. Without an array, first values win and
    objects are merged.
    """
    if not schema:
        return {}
    path = array_path(schema)
    known = [r for r in results if isinstance(r, dict)]
    if path is None:
        out: dict = {}
        for r in known:
            for k, v in r.items():
                if not out.get(k):
                    out[k] = v
                elif isinstance(out[k], dict) and isinstance(v, dict):
                    out[k] = {**out[k], **v}
        return out
    parent, level = schema, (top := {})
    for name in path[:-1]:
        parent, level = parent["properties"][name], level.setdefault(name, {})
    name = path[-1]
    wanted = (parent["properties"][name].get("items") or {}).get("properties") or {}
    level[name] = []

    def fits(item) -> bool:
        return isinstance(item, dict) and all(k in item and TYPES.get(type(item[k])) == p.get("type") for k, p in wanted.items())

    for r in known:
        for step in path[:-1]:
            r = r.get(step) if isinstance(r, dict) else None
        if not isinstance(r, dict):
            continue
        for k in parent["properties"]:
            if k != name and k in r and k not in level:
                level[k] = list(r[k]) if isinstance(r[k], list) else r[k]
            elif k != name and isinstance(r.get(k), list) and isinstance(level.get(k), list):
                level[k] += [v for v in r[k] if v not in level[k]]
        for item in r.get(name) if isinstance(r.get(name), list) else ():
            own = {k: item[k] for k in wanted} if fits(item) else {}
            if own and not any(json_equal(own, held) for held in level[name]):
                level[name].append(own)
    return top
