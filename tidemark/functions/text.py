"""Scalar text functions: identifiers, money, dates, epochs, payload numbers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date formats that fund pages use, in the order in which they are tried; fixed values.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "M/d/yyyy", "MM/dd/yy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "yyyyMMdd")


def identifiers(headers: Sequence[str]) -> list[str]:
    """Snake-case names of headers: anything else an underscore, a leading digit prefixed, repeats numbered."""
    out: list[str] = []
    for k, h in enumerate(headers):
        name = re.sub(r"_+", "_", re.sub(r"[^a-z0-9]+", "_", h.strip().lower())).strip("_") or f"column_{k + 1}"
        name = f"col_{name}" if name[0].isdigit() else name
        n, unique = 2, name
        while unique in out:
            unique, n = f"{name}_{n}", n + 1
        out.append(unique)
    return out


def amount(text: Column) -> Column:
    """A number in money text: signs, separators and percent dropped, (x) negative, K, M and B scaled, a dash null."""
    t = F.regexp_replace(F.trim(text), r"[$,%\s]", "")
    inner = F.regexp_replace(t, r"^\((.*)\)$", "-$1")
    scale = F.when(inner.rlike("(?i)k$"), 1e3).when(inner.rlike("(?i)m$"), 1e6).when(inner.rlike("(?i)b$"), 1e9).otherwise(1.0)
    return F.when(t.rlike("^[-–—]*$"), None).otherwise(F.regexp_replace(inner, "(?i)[kmb]$", "").try_cast("double") * scale)


def any_date(text: Column) -> Column:
    t = F.trim(text)
    return F.coalesce(*(F.to_date(F.try_to_timestamp(t, F.lit(f))) for f in DATE_FORMATS), F.to_date(F.try_to_timestamp(t)))


def half_up_millis(seconds: Column) -> Column:
    """Milliseconds of decimal epoch seconds, half rounded up."""
    return F.round(seconds.try_cast("decimal(20,9)") * 1000).cast("long")


def missing_dot(text: Column) -> Column:
    """A value of which a lone dot means none."""
    return F.when(F.trim(text) != ".", text.try_cast("double"))


def exact_number(text: Column, scale: int | None, label: str) -> Column:
    """A payload number: a whole one, or a decimal of at most `scale` digits; overflow and anything else fails."""
    t = F.trim(text)
    fail = F.raise_error(F.concat(F.lit(f"{label} does not fit its precision: "), F.coalesce(text, F.lit("null"))))
    if scale is None:
        v = F.when(t.rlike(r"^-?[0-9]+$"), t.try_cast("decimal(38,0)"))
    else:
        wide = t.try_cast(f"decimal(38,{scale})")
        v = F.when(t.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$") & (F.length(F.regexp_replace(F.regexp_extract(t, r"\.([0-9]+)", 1), "0+$", "")) <= scale), wide)
    return F.when(v.isNotNull(), v).otherwise(fail.cast("string").try_cast(f"decimal(38,{scale or 0})"))


def close_to(a: Column, b: Column, relative: float = 1e-12) -> Column:
    return F.abs(a - b) <= relative * F.greatest(F.abs(a), F.abs(b))
