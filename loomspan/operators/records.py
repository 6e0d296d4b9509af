"""Merging records that were extracted from many pages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mergeable(a: dict, b: dict) -> bool:
    """At least one field that both have is equal, and none that both have differs; lists don't count."""
    same = 0
    for k in set(a) | set(b):
        x, y = a.get(k), b.get(k)
        if isinstance(x, list) or isinstance(y, list) or x is None or y is None:
            continue
        if x != y:
            return False
        same += 1
    return same > 0


def merged(a: dict, b: dict) -> dict:
    """b's known values over a's; lists are joined without repeats, objects field by field."""
    out = dict(a)
    for k, y in b.items():
        x = out.get(k)
        if y is None:
            out.setdefault(k, None)
        elif isinstance(y, list):
            kept = {json.dumps(v, sort_keys=True): v for v in reversed([*(x if isinstance(x, list) else []), *y])}
            out[k] = list(reversed(kept.values()))
        elif isinstance(y, dict) and isinstance(x, dict):
            out[k] = merged(x, y)
        else:
            out[k] = y
    return out


def merge_complements(items: list[dict]) -> list[dict]:
    """Greedy: each item joins the first one that it completes."""
    out: list[dict] = []
    for item in items:
        item = {k: None if v == "null" else v for k, v in item.items()}
        for i, held in enumerate(out):
            if mergeable(held, item):
                out[i] = merged(held, item)
                break
        else:
            out.append(item)
    seen = {json.dumps(x, sort_keys=True): x for x in reversed(out)}
    return list(reversed(seen.values()))


def merge_records(records: DataFrame, keys: list[str], order: str, record: str = "record") -> DataFrame:
    """Records (JSON objects) by key, merged in order; one row per merged record."""
    grouped = records.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, record))).alias("__all"))
    run = F.udf(lambda rows: [json.dumps(x, sort_keys=True) for x in merge_complements([json.loads(r) for r in rows])], "array<string>", useArrow=True)
    return grouped.select(*keys, F.explode(run(F.transform("__all", lambda x: x[record]))).alias(record))


def split_schema(schema: dict, keys: list[str]) -> tuple[dict, dict]:
    """A JSON schema as (single-answer, multi-entity) schemas by dotted keys."""
    single, multi = {"type": "object", "properties": {}}, {"type": "object", "properties": {}}
    names = {k.split(".")[0] for k in keys}
    for name, part in schema.get("properties", {}).items():
        (multi if name in names else single)["properties"][name] = part
    for s in (single, multi):
        req = [r for r in schema.get("required", []) if r in s["properties"]]
        if req:
            s["required"] = req
    return ({} if not single["properties"] else single), ({} if not multi["properties"] else multi)


def mix(schema: dict, single: dict | None, multi: dict | None) -> dict:
    """One object of both results, in the order of the schema; lists of both are joined."""
    out = {}
    for name in schema.get("properties", {}):
        a, b = (single or {}).get(name), (multi or {}).get(name)
        if isinstance(a, list) and isinstance(b, list):
            out[name] = [*b, *a]
        elif b is not None or a is not None:
            out[name] = b if b is not None else a
    return out
