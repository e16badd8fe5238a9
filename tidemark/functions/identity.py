"""Deterministic identity and digests as column expressions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The namespace and version of event ids.
EVENT_NAMESPACE = uuid.UUID("f1d1ef17-95ce-4f9f-bd81-f9958cdf8ee5")
ENVELOPE_VERSION = 1


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """The version 5 UUID of a name, as lower-case text; the same as the standard library's."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12)
    )


def required_text(label: str, c: Column) -> Column:
    text = F.trim(c)
    return F.when(F.length(text) > 0, text).otherwise(F.raise_error(F.lit(f"{label} must be set and non-empty")))


def event_key(source_id: Column, stream_id: Column, partition_id: Column, offset: Column) -> Column:
    parts = {"source_id": source_id, "stream_id": stream_id, "partition_id": partition_id, "source_offset": offset}
    return F.concat_ws("|", F.lit(str(ENVELOPE_VERSION)), *(required_text(k, c) for k, c in parts.items()))


def event_id(source_id: Column, stream_id: Column, partition_id: Column, offset: Column) -> Column:
    return uuid5(EVENT_NAMESPACE, event_key(source_id, stream_id, partition_id, offset))


def state_id(namespace: uuid.UUID, *parts: Column) -> Column:
    """Ids of checkpoints, policies, manifests and proofs: of their parts' texts, with bars between."""
    return uuid5(namespace, F.concat_ws("|", *(p.cast("string") for p in parts)))


def metric_id(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *parts), 256)


def line_digest(sorted_lines: Column) -> Column:
    """SHA-256 of the lines, each ended by a newline; of nothing for none."""
    text = F.when(F.size(sorted_lines) > 0, F.concat(F.array_join(sorted_lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return F.sha2(text, 256)


def iso_instant(ts: Column) -> Column:
    """ISO text of an instant in UTC: no fraction if it has none, else six digits, and an offset of zero."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))), F.lit("+00:00"))


def order_key(offset: Column) -> Column:
    """Digits sort as numbers and before any other text. A struct of (is text, number, text)."""
    text = F.trim(offset)
    digits = text.rlike("^[0-9]+$")
    return F.struct(F.when(digits, 0).otherwise(1).alias("is_text"), F.when(digits, text.try_cast("decimal(38,0)")).alias("number"), F.when(~digits, text).alias("text"))


def json_safe(c: Column) -> Column:
    """Fails on text with non-ASCII characters, whose escapes Spark's JSON writer does not make."""
    return F.when(c.isNull() | (F.octet_length(c) == F.char_length(c)), c).otherwise(F.raise_error(F.lit("bucket payloads must be ASCII")))


def sorted_collect(order: Sequence[Column], value: Column) -> Column:
    """Values of a group in the order of the keys, as an array."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(order)]
    return F.transform(F.array_sort(F.collect_list(F.struct(*keys, value.alias("v")))), lambda x: x["v"])
