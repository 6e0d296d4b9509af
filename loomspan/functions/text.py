"""Text, JSON, diff, schedule and cost functions."""

from __future__ import annotations

import json
import re
import unicodedata
from datetime import datetime, timedelta, timezone
from difflib import unified_diff
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# column expressions ----------------------------------------------------------
def edit_similarity(a: Column, b: Column) -> Column:
    """1 - distance in characters / the longer length in bytes."""
    return F.when(F.greatest(F.octet_length(a), F.octet_length(b)) == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / F.greatest(F.octet_length(a), F.octet_length(b)))


def word_jaccard(a: Column, b: Column) -> Column:
    x, y = (F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(t, F.lit(""))), r"\s+"), "")) for t in (a, b))
    either = F.size(F.array_union(x, y))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / either)


def numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1))


def table_count(md: Column) -> Column:
    """Delimiter rows of pipe tables: a pipe at both ends, one dash or more a column."""
    return F.regexp_count(md, F.lit(r"(?m)^\s*(?:\|\s*:?-+:?\s*)+\|\s*$"))


def utf16_length(text: Column) -> Column:
    """Code units: code points, those beyond the basic plane twice."""
    return F.length(text) + F.regexp_count(text, F.lit(r"[\x{10000}-\x{10FFFF}]"))


def _places(value: Column, n: int) -> Column:
    return F.floor(value * 10**n + 0.5) / 10**n


def compare_outputs(a: Column, b: Column) -> Column:
    """Struct of lengths, numbers, tables and a grade of rendering a of a document against rendering b."""
    n, m = F.array_distinct(numbers(a)), F.array_distinct(numbers(b))
    x, y = utf16_length(a), utf16_length(b)
    ratio = F.when(y > 0, x / y).otherwise(F.when(x > 0, 0.0).otherwise(1.0))
    kept = F.when(F.size(m) > 0, F.size(F.array_intersect(n, m)) / F.size(m)).otherwise(F.when(F.size(n) > 0, 0.0).otherwise(1.0))
    grade = F.when((ratio >= 0.8) & (kept >= 0.9), "good").when((ratio >= 0.5) & (kept >= 0.7), "acceptable").otherwise("poor")
    return F.struct(
        x.alias("length"), y.alias("other_length"), _places(ratio, 3).alias("length_ratio"), F.size(n).alias("numbers"), F.size(m).alias("other_numbers"),
        _places(kept, 3).alias("numbers_kept"), table_count(a).alias("tables"), table_count(b).alias("other_tables"), grade.alias("grade"),
    )


def trim_tokens(text: Column, most: int, chars_per_token: float = 2.8) -> Column:
    return F.substring(text, 1, int(most * chars_per_token))


def without_page_marks(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|[^|]*page-\d+[^|]*\|>\n?", "")


def expires_at(created: Column, ttl_ms: Column) -> Column:
    return created + F.make_dt_interval(secs=(ttl_ms / 1000).cast("decimal(18,6)"))


#: Price per million tokens by model (input, output). A model whose name holds a TIERED key has
#: two tiers instead, the second beyond 200,000 input tokens. Other models cost nothing.
PRICES = {
    "openai/o3-mini": (1.1, 4.4), "gpt-4o-mini": (0.15, 0.6), "openai/gpt-4o-mini": (0.15, 0.6), "openai/gpt-4o": (2.5, 10.0), "gpt-5": (1.25, 10.0), "openai/gpt-5": (1.25, 10.0),
    "gpt-5-mini": (0.25, 2.0), "openai/gpt-5-mini": (0.25, 2.0), "gpt-5-nano": (0.05, 0.4), "openai/gpt-5-nano": (0.05, 0.4), "google/gemini-2.0-flash-001": (0.15, 0.6), "gemini-2.0-flash": (0.15, 0.6),
    "deepseek/deepseek-r1": (0.55, 2.19), "google/gemini-2.0-flash-thinking-exp:free": (0.55, 2.19), "google/gemini-2.5-flash-lite": (0.1, 0.4),
}
TIERED = {"gemini-2.5-pro": ((1.25, 10.0), (2.5, 15.0))}


def price_table(spark) -> DataFrame:
    return spark.createDataFrame([(m, i, o) for m, (i, o) in PRICES.items()], "model string, input_price double, output_price double")


def with_llm_cost(usage: DataFrame, prices: DataFrame, model: str = "model", n_in: str = "n_in", n_out: str = "n_out", tiers: dict | None = None) -> DataFrame:
    """usage with cost. prices: model, input_price, output_price, one row a model; small, as price lists are."""
    priced = usage.join(prices.withColumnRenamed("model", "__m"), F.col(model) == F.col("__m"), "left")
    i, o = F.coalesce("input_price", F.lit(0.0)), F.coalesce("output_price", F.lit(0.0))
    for name, ((low_i, low_o), (high_i, high_o)) in (TIERED if tiers is None else tiers).items():
        own, high = F.contains(F.col(model), F.lit(name)), F.col(n_in) > 200_000
        i = F.when(own, F.when(high, high_i).otherwise(low_i)).otherwise(i)
        o = F.when(own, F.when(high, high_o).otherwise(low_o)).otherwise(o)
    cost = (F.col(n_in) * i + F.col(n_out) * o) / 1_000_000
    return priced.withColumn("cost", cost).select(*usage.columns, "cost")


def map_diff(previous: Column, current: Column) -> Column:
    """Keys whose values differ, with both values."""
    both = F.map_zip_with(previous, current, lambda k, a, b: F.struct(a.alias("previous"), b.alias("current")))
    return F.map_filter(both, lambda k, v: ~v["previous"].eqNullSafe(v["current"]))


def is_pdf(content: Column) -> Column:
    """The PDF mark within the first 1024 bytes, at a byte boundary."""
    return F.hex(F.substring(content, 1, 1024)).rlike("^(..)*25504446")


def canonical_colour(hex_: Column) -> Column:
    return F.when(hex_.rlike("^#[0-9a-fA-F]{6}$"), F.upper(hex_)).when(hex_.rlike("^#[0-9a-fA-F]{3}$"), F.upper(F.regexp_replace(hex_, "([0-9a-fA-F])", "$1$1")))


# values ----------------------------------------------------------------------
def normal_json(value):
    """Strings in composed form, without zero-width characters, white space collapsed; objects by key."""
    if isinstance(value, str):
        return re.sub(r"\s+", " ", re.sub("[\u200b-\u200d\ufeff\u2060]", "", unicodedata.normalize("NFC", value))).strip()
    if isinstance(value, list):
        return [normal_json(v) for v in value]
    if isinstance(value, dict):
        return {k: normal_json(value[k]) for k in sorted(value)}
    return value


def json_equal(a, b) -> bool:
    return json.dumps(normal_json(a), sort_keys=True) == json.dumps(normal_json(b), sort_keys=True)


def json_diff(previous: str | None, current: str | None) -> list[tuple[str, str, str]]:
    """(path, previous, current) of the leaves that differ; a change of type is one difference."""
    out = []

    def walk(a, b, path):
        if isinstance(a, dict) and isinstance(b, dict):
            for k in sorted(set(a) | set(b)):
                walk(a.get(k), b.get(k), f"{path}.{k}" if path else k)
        elif isinstance(a, list) and isinstance(b, list):
            for k in range(max(len(a), len(b))):
                walk(a[k] if k < len(a) else None, b[k] if k < len(b) else None, f"{path}[{k}]")
        elif not json_equal(a, b):
            out.append((path, json.dumps(a), json.dumps(b)))

    walk(json.loads(previous or "null"), json.loads(current or "null"), "")
    return out


def line_diff(previous: str, current: str) -> str:
    return "\n".join(unified_diff(previous.split("\n"), current.split("\n"), "previous", "current", lineterm=""))


def parse_diff(diff: str) -> list[dict]:
    """Chunks with their changes: type, content, line numbers before and after."""
    chunks, a, b = [], 0, 0
    for line in diff.split("\n"):
        if m := re.match(r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@", line):
            a, b = int(m[1]), int(m[3])
            chunks.append({"old_start": a, "new_start": b, "changes": []})
        elif chunks and line[:1] in ("+", "-", " "):
            kind = {"+": "add", "-": "del", " ": "normal"}[line[0]]
            chunks[-1]["changes"].append({"type": kind, "content": line[1:], "old_line": None if kind == "add" else a, "new_line": None if kind == "del" else b})
            a, b = a + (kind != "add"), b + (kind != "del")
    return chunks


def _field(text: str, low: int, high: int) -> set[int]:
    out = set()
    for part in text.split(","):
        span, _, step = part.partition("/")
        first, _, last = span.partition("-")
        if span == "*":
            a, b = low, high
        else:
            a = int(first)
            b = int(last) if last else (high if step else a)
        if not (low <= a <= b <= high) or (step and int(step) < 1):
            raise ValueError(f"schedule field out of range: {part}")
        out |= set(range(a, b + 1, int(step or 1)))
    return out


def cron_fields(expression: str) -> list[set[int]]:
    parts = expression.split()
    if len(parts) != 5:
        raise ValueError("a schedule has five fields")
    out = [_field(p, lo, hi) for p, (lo, hi) in zip(parts, ((0, 59), (0, 23), (1, 31), (1, 12), (0, 7)), strict=True)]
    out[4] = {d % 7 for d in out[4]}
    return out


def next_run(expression: str, after: datetime, zone: str = "UTC") -> datetime | None:
    """The next minute that fits all five fields (day of month and day of week both), within 366 days."""
    minute, hour, day, month, week = cron_fields(expression)
    t = after.astimezone(ZoneInfo(zone)).replace(second=0, microsecond=0) + timedelta(minutes=1)
    end = t + timedelta(days=366)
    while t <= end:
        if t.month not in month or t.day not in day or (t.weekday() + 1) % 7 not in week:
            t = (t + timedelta(days=1)).replace(hour=0, minute=0)
        elif t.hour not in hour:
            t = (t + timedelta(hours=1)).replace(minute=0)
        elif t.minute not in minute:
            t += timedelta(minutes=1)
        else:
            return t
    return None


def next_runs(expression: str, after: Column) -> Column:
    """next_run of a column of times without zone (taken as UTC). Every hour and every day need no Python; others run in Arrow batches."""
    minute, hour, day, month, week = cron_fields(expression)
    whole = len(day) == 31 and len(month) == 12 and len(week) == 7
    if whole and len(minute) == 1 and len(hour) in (1, 24):
        unit = "hour" if len(hour) == 24 else "day"
        shift = F.expr(f"interval {min(minute) + (60 * min(hour) if unit == 'day' else 0)} minutes")
        own = F.date_trunc(unit, after).cast("timestamp_ntz") + shift
        return F.when(own > F.date_trunc("minute", after).cast("timestamp_ntz"), own).otherwise(own + F.expr(f"interval 1 {unit}"))

    def run(times):
        return times.map(lambda t: None if t is None or t != t else next_run(expression, t.to_pydatetime().replace(tzinfo=timezone.utc)).replace(tzinfo=None))

    return F.pandas_udf(run, "timestamp_ntz")(after)


def schedule_text(text: str) -> str:
    """A schedule in words as five fields."""
    t = re.sub(r"\s+", " ", text.strip().lower())
    if m := re.fullmatch(r"every (\d+) minutes?(?: starting at :(\d\d))?", t):
        n, at = int(m[1]), int(m[2] or 0)
        if 1 <= n <= 60 and 60 % n == 0 and at < 60:
            if n == 60:
                return f"{at} * * * *"
            return f"*/{n} * * * *" if not m[2] else ",".join(str(x) for x in sorted({(at + k) % 60 for k in range(0, 60, n)})) + " * * * *"
    if m := re.fullmatch(r"hourly(?: at :(\d\d))?", t):
        if int(m[1] or 0) < 60:
            return f"{int(m[1] or 0)} * * * *"
    if m := re.fullmatch(r"every (\d+) hours?", t):
        if 1 <= int(m[1]) <= 24 and 24 % int(m[1]) == 0:
            return "0 0 * * *" if int(m[1]) == 24 else f"0 */{m[1]} * * *"
    if m := re.fullmatch(r"daily(?: at (\d{1,2})(?::(\d\d))?)?", t):
        if int(m[1] or 0) < 24 and int(m[2] or 0) < 60:
            return f"{int(m[2] or 0)} {int(m[1] or 0)} * * *"
    if t == "weekly":
        return "0 0 * * 0"
    raise ValueError(f"schedule not understood: {text}")


def search_query(base: str, categories: dict[str, str] | None = None, include: list[str] | None = None, exclude: list[str] | None = None) -> str:
    """The query with its site and file type operators; categories: name to site, or pdf."""
    sites = [f"site:{s}" for k, s in (categories or {}).items() if k != "pdf"] + (["filetype:pdf"] if "pdf" in (categories or {}) else []) + [f"site:{d}" for d in include or []]
    return " ".join([base] + ([f"({' OR '.join(sites)})"] if sites else []) + [f"-site:{d}" for d in exclude or []])
