"""Fund metrics: the contract of normalised records, made of parsed records by a mapping; fetching is a client object's."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import metric_id
from tidemark.functions.text import amount, any_date


@dataclass(frozen=True)
class Issuer:
    """What an issuer's records hold: the field of each metric, its unit, whether it is a count, and the field of the day."""

    source_id: str
    fields: Mapping[str, str]
    units: Mapping[str, str] = field(default_factory=dict)
    counts: Sequence[str] = ()
    day_field: str = "as_of_date"
    required: Sequence[str] = ()


def normalise(parsed: DataFrame, issuer: Issuer) -> DataFrame:
    """Long metric rows of parsed records (artifact_id, record_index, fields): metric_id, source_id, metric_name, unit,
    value columns, the day at midnight UTC, dimensions and provenance.

    A record without a day, or without a required metric, fails. Fields that the issuer does not name are left out;
    a dash or an empty cell is a null value.
    """
    cells = F.array(*(F.struct(F.lit(m).alias("name"), F.lit(issuer.units.get(m)).cast("string").alias("unit"), F.col("fields")[f].alias("text")) for m, f in issuer.fields.items()))
    day = any_date(F.col("fields")[issuer.day_field])
    said = F.concat(F.lit(f"{issuer.source_id}: no day in record "), "artifact_id", F.lit(":"), F.col("record_index").cast("string"))
    rows = parsed.select("artifact_id", "record_index", F.when(day.isNotNull(), day).otherwise(F.raise_error(said).cast("date")).alias("day"), F.explode(cells).alias("m"))
    value = amount(F.col("m.text"))
    lacking = F.col("m.name").isin(list(issuer.required)) & value.isNull()
    checked = F.when(lacking, F.raise_error(F.concat(F.lit(f"{issuer.source_id} lacks "), F.col("m.name"))).cast("double")).otherwise(value)
    whole = F.col("m.name").isin(list(issuer.counts))
    observed, none = F.col("day").cast("timestamp"), F.lit(None)
    return rows.select(
        metric_id(F.lit(issuer.source_id), F.concat_ws(":", F.date_format("day", "yyyy-MM-dd"), F.col("record_index").cast("string")), F.col("m.name"), F.coalesce("m.text", F.lit(""))).alias("metric_id"), F.lit(issuer.source_id).alias("source_id"),
        F.col("m.name").alias("metric_name"), F.col("m.unit").alias("metric_unit"), F.col("m.text").alias("metric_value_string"), F.when(whole, checked.cast("long")).alias("metric_value_int"),
        checked.alias("metric_value_float"), none.cast("boolean").alias("metric_value_bool"), observed.alias("observed_at_utc"), F.lit("{}").alias("dimensions_json"),
        F.to_json(F.struct("artifact_id", "record_index")).alias("provenance_json"),
    )


def fetch_artifact(client, source_id: str, url: str, expected_md5_base64: str | None = None) -> dict:
    """An artifact through client.get(url) -> (bytes, content type): its content, digest and deterministic id.

    Empty content fails, and content whose MD5 is not the one that the source names.
    """
    import base64

    content, kind = client.get(url)
    if not content:
        raise ValueError(f"{url} has no content")
    if expected_md5_base64 is not None and base64.b64encode(hashlib.md5(content).digest()).decode() != expected_md5_base64:
        raise ValueError(f"{url}: the content's MD5 is not {expected_md5_base64}")
    digest = hashlib.sha256(content).hexdigest()
    return {"artifact_id": str(uuid.uuid5(uuid.NAMESPACE_URL, f"{source_id}|{url}|{digest}")), "source_id": source_id, "url": url, "sha256": digest, "content_type": kind, "content": content, "fetched_at_utc": datetime.now(UTC)}


def download_link(answer: Mapping, day: str) -> tuple[str, str]:
    """(file name, address) in a source's answer to the question for a day's file; there must be exactly one."""
    if str(answer.get("code")) != "0":
        raise ValueError(f"the source answers with code {answer.get('code')!r} for {day}")
    files = [g for d in (answer.get("data") or {}).get("details") or [] for g in d.get("groupDetails") or []]
    if len(files) != 1 or not files[0].get("filename") or not files[0].get("url"):
        raise ValueError(f"one file was expected for {day}, not {len(files)}")
    return files[0]["filename"], files[0]["url"]
