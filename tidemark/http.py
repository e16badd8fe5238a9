"""The service over HTTP as a WSGI application; `wsgiref` or any WSGI server can run it."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path
from typing import Any

from tidemark.api import Busy, Empty, HistoricalData, Service, Tables
from tidemark.catalog import DATASETS
from tidemark.operators import sinks
from tidemark.operators.filters import require_scalars
from tidemark.operators.native import iso_text
from tidemark.operators.serving import rights_decision, window_warnings
from tidemark.plans.windows import LatestRows, RandomRows

_COMMON = {"mode", "start_date", "end_date", "n_latest_rows", "n_random_rows", "fields", "filters", "strict"}


def _routes() -> dict[str, tuple[str, str, set[str]]]:
    """Historical paths: dataset, method and the parameters that a request may have."""
    out = {}
    for source in ("binance", "okx", "bybit"):
        out[f"/v1/historical/{source}/spot/trades"] = (f"{source}_spot_trades", f"get_{source}_spot_trades", _COMMON | {"include_datetime_col"})
        out[f"/v1/historical/{source}/spot/klines"] = (f"{source}_spot_trades", f"get_{source}_spot_klines", _COMMON | {"kline_size"})
    for name, spec in DATASETS.items():
        if spec.bucket_mode != "exchange":
            family, _, rest = name.partition("_")
            out[f"/v1/historical/{family}/{rest}"] = (name, f"get_{name}", _COMMON)
    return out


HISTORICAL = _routes()


def _shown(value: Any) -> Any:
    if isinstance(value, datetime | date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, bytes):
        return value.hex()
    raise TypeError(type(value).__name__)


class Application:
    """Routes: /health, the historical ones, /v1/raw/query, /v1/raw/export and its status.

    Bad requests are 422, conflicts with a query's contract 409, missing rights 403, no rows or no export 404, and a full
    queue 503. Exports run in a thread each and leave their files in a folder of their own.
    """

    def __init__(self, tables: Tables, exports: str, rights: dict | None = None, running: int = 4, waiting: int = 16):
        self.tables, self.rights, self.service = tables, rights, Service(tables, rights, running, waiting)
        self.exports, self.jobs = Path(exports), {}

    def __call__(self, environ: dict, start_response: Callable) -> Iterable[bytes]:
        try:
            body = environ["wsgi.input"].read(int(environ.get("CONTENT_LENGTH") or 0))
            payload = json.loads(body or b"{}")
            if not isinstance(payload, dict):
                raise json.JSONDecodeError("an object is wanted", "", 0)
            code, out = self.answer(environ["REQUEST_METHOD"], environ["PATH_INFO"], payload, environ.get("HTTP_X_ACCESS_TOKEN"))
        except json.JSONDecodeError as e:
            code, out = 422, {"code": "BAD_JSON", "message": str(e)}
        except (LookupError, PermissionError, ValueError, TypeError, Busy) as e:
            kinds = ((Empty, 404, "NO_ROWS"), (LookupError, 404, "NOT_FOUND"), (PermissionError, 403, "RIGHTS"), (Busy, 503, "QUEUE_LIMIT_REACHED"), (TypeError, 422, "BAD_REQUEST"))
            code, name = next(((c, n) for k, c, n in kinds if isinstance(e, k)), (409, "CONTRACT_ERROR"))
            out = {"code": name, "message": str(e)}
        except Exception as e:  # the backend's
            code, out = 503, {"code": "BACKEND_ERROR", "message": str(e)[:2000]}
        data = json.dumps(out, default=_shown).encode()
        start_response(f"{code} {'OK' if code < 300 else 'Error'}", [("Content-Type", "application/json"), ("Content-Length", str(len(data)))])
        return [data]

    def answer(self, method: str, path: str, payload: dict, token: str | None) -> tuple[int, dict]:
        if (method, path) == ("GET", "/health"):
            return 200, {"status": "ok"}
        if method == "POST" and path in HISTORICAL:
            return 200, self.historical(path, payload, token)
        if (method, path) == ("POST", "/v1/raw/query"):
            return 200, self.service.query(payload | {"auth_token": token})
        if (method, path) == ("POST", "/v1/raw/export"):
            return 202, self.submit(payload | {"auth_token": token})
        if method == "GET" and path.startswith("/v1/raw/export/"):
            return 200, self.status(path.rpartition("/")[2])
        raise LookupError(f"no route {method} {path}")

    def historical(self, path: str, payload: dict, token: str | None) -> dict:
        dataset, name, allowed = HISTORICAL[path]
        if extra := set(payload) - allowed:
            raise TypeError(f"unknown parameters: {sorted(extra)}")
        if payload.get("filters"):
            require_scalars(payload["filters"])
        if self.rights is not None:
            rights_decision(self.rights, dataset, token)
        df = iso_text(getattr(HistoricalData(self.tables), name)(**payload))
        window = LatestRows(1) if payload.get("n_latest_rows") else RandomRows(1) if payload.get("n_random_rows") else None
        with self.service.gates[payload.get("mode", "native")].admitted():
            out = sinks.envelope(df, payload.get("mode", "native"), dataset, window_warnings(window))
        if not out["rows"]:
            raise Empty("no rows for this query")
        return out

    def submit(self, request: dict) -> dict:
        self.service.frame(request)  # contract errors belong to the request, not to the job
        export_id = uuid.uuid4().hex
        job = self.jobs[export_id] = {"export_id": export_id, "status": "queued"}

        def run() -> None:
            job["status"] = "running"
            try:
                job["artifact"] = self.service.export(request, str(self.exports / export_id), request.get("format", "parquet"))
                job["status"] = "succeeded"
            except Exception as e:
                job.update(status="failed", error_code=type(e).__name__, error_message=str(e)[:2000])

        job["thread"] = threading.Thread(target=run, daemon=True)
        job["thread"].start()
        return {"export_id": export_id, "status": "queued"}

    def status(self, export_id: str) -> dict:
        if export_id not in self.jobs:
            raise LookupError(f"no export {export_id}")
        return {k: v for k, v in self.jobs[export_id].items() if k != "thread"}
