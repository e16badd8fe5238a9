"""Parsed records of artifacts: CSV, JSON, HTML tables and text lines, by format."""

from __future__ import annotations

import csv
import io
import json
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from tidemark.cluster import ship
from tidemark.functions.text import identifiers

RECORD = "artifact_id string, parser string, record_index long, fields map<string,string>"


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.depth, self.cell = 0, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            self.tables.append([])
        elif self.depth and tag == "tr":
            self.tables[-1].append([])
        elif self.depth and tag in ("td", "th") and self.tables[-1]:
            self.cell = []

    def handle_endtag(self, tag):
        if tag == "table":
            self.depth = max(0, self.depth - 1)
        elif tag in ("td", "th") and self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def parse_csv(text: str) -> list[dict]:
    rows = [r for r in csv.reader(io.StringIO(text)) if any(c.strip() for c in r)]
    return _headed(rows)


def _headed(rows: list[list[str]]) -> list[dict]:
    if not rows:
        return []
    names = identifiers(rows[0])
    return [dict(zip(names, (c.strip() for c in r))) for r in rows[1:]]


def parse_html(text: str) -> list[dict]:
    parser = _Tables()
    parser.feed(text)
    return [r | {"table": str(k)} for k, t in enumerate(parser.tables) for r in _headed([row for row in t if row])]


def parse_json(text: str) -> list[dict]:
    """The objects of a list, of the first list of objects in an object, or the object itself; nested values as JSON."""
    data = json.loads(text)
    if isinstance(data, dict):
        data = next((v for v in data.values() if isinstance(v, list) and v and isinstance(v[0], dict)), [data])
    if not isinstance(data, list) or not all(isinstance(x, dict) for x in data):
        raise ValueError("JSON artifact holds no objects")
    return [dict(zip(identifiers(list(x)), (v if isinstance(v, str) else json.dumps(v, sort_keys=True) for v in x.values()))) for x in data]


def parse_lines(text: str) -> list[dict]:
    return [{"line": line.strip()} for line in text.splitlines() if line.strip()]


PARSERS = {"csv": parse_csv, "json": parse_json, "html": parse_html, "pdf": parse_lines, "text": parse_lines}


def parse(artifacts: DataFrame) -> DataFrame:
    """RECORD rows of artifacts (artifact_id, format, content as text). Null content gives none; an unknown format fails."""

    def rows(frames):
        for frame in frames:
            out = []
            for artifact_id, form, content in zip(frame["artifact_id"], frame["format"], frame["content"]):
                if form not in PARSERS:
                    raise ValueError(f"no parser for format {form!r}")
                out += [(artifact_id, form, k, {n: str(v) for n, v in r.items()}) for k, r in enumerate(PARSERS[form](content or ""))] if content else []
            yield pd.DataFrame(out, columns=["artifact_id", "parser", "record_index", "fields"])

    ship(artifacts.sparkSession)
    return artifacts.select("artifact_id", "format", "content").mapInPandas(rows, RECORD)
