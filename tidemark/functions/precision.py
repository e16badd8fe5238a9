"""Payloads in canonical form: numbers by a registry of exact precisions, keys in order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.catalog import PRECISION
from tidemark.functions.text import exact_number


def _quoted(text: Column) -> Column:
    """A JSON string literal."""
    shown = F.to_json(F.struct(text.alias("x")))
    return F.substring(shown, F.lit(6), F.length(shown) - 6)


def canonical_payload(payload: Column, source: str, stream: str) -> Column:
    """The payload's JSON with sorted keys; registered numbers as whole numbers, or as text with all digits of their scale.

    A stream without rules is an error. A registered field that is null, a boolean, or does not fit fails; so does a
    number that no rule names, also within a nested value, and text that is no JSON object. Other values stay as they are.
    """
    if (source, stream) not in PRECISION:
        raise ValueError(f"no precision rules for {source} {stream}")
    rules = PRECISION[source, stream]
    fail = lambda what, c: F.raise_error(F.concat(F.lit(what), F.coalesce(c, F.lit("null")))).cast("string")
    parsed, shape = F.from_json(payload, "map<string,string>"), F.schema_of_variant(F.try_parse_json(payload))
    entry = lambda k, v: F.struct(k.alias("k"), F.concat(_quoted(k), F.lit(":"), v).alias("shown"))

    def ruled(name: str, scale: int | None) -> Column:
        text = exact_number(parsed[name], scale, name).cast("string")
        return F.when(F.map_contains_key(parsed, name), entry(F.lit(name), text if scale is None else _quoted(text)))

    def free(k: Column) -> Column:
        value = parsed[k]
        kind = F.call_function("regexp_extract", shape, F.concat(F.lit(r"[<, ]`?\Q"), k, F.lit(r"\E`?: ([A-Z]+)")), F.lit(1))
        bare = F.regexp_replace(value, r'"(\\.|[^"\\])*"', '""')
        shown = (
            F.when(kind == "STRING", _quoted(value))
            .when(kind.isin("BOOLEAN", "VOID"), F.coalesce(value, F.lit("null")))
            .when(kind.isin("OBJECT", "ARRAY") & ~bare.rlike("[0-9]"), value)
            .otherwise(fail("a number has no precision rule: ", k))
        )
        return entry(k, shown)

    others = F.filter(F.map_keys(parsed), lambda k: ~k.isin(*rules)) if rules else F.map_keys(parsed)
    entries = F.concat(F.filter(F.array(*(ruled(n, s) for n, s in rules.items())), lambda e: e.isNotNull()), F.transform(others, free))
    joined = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(entries), lambda e: e["shown"]), ","), F.lit("}"))
    return F.when(shape.startswith("OBJECT"), joined).otherwise(fail("payload is no JSON object: ", payload))


def without_floats(payload: Column) -> Column:
    """The payload, unless it holds a number with a fraction or an exponent outside of its strings."""
    bare = F.regexp_replace(payload, r'"(\\.|[^"\\])*"', '""')
    return F.when(bare.rlike(r"[0-9][.eE][0-9+-]"), F.raise_error(F.concat(F.lit("a float in the payload: "), payload)).cast("string")).otherwise(payload)
