"""Load checkpoints: one small JSON record per (source, table), swapped in by rename.

Records of different tables are different files, so concurrent loads do not touch each other's.
"""

from __future__ import annotations

import json
import re
import uuid
from datetime import date, datetime, timezone
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..session import hadoop_path, read_text, replace_text

STATUS_SCHEMA = (
    "source string, table string, status string, rows bigint, hwm string, hwm_type string, updated_at string"
)


def encode_hwm(value: Any) -> tuple[str, Any]:
    """(type tag, JSON value): scalars as they are, dates and times as ISO text."""
    if value is None or isinstance(value, (bool, int, float, str)):
        return type(value).__name__, value
    if isinstance(value, datetime):
        return "datetime", value.isoformat(timespec="microseconds")
    if isinstance(value, date):
        return "date", value.isoformat()
    if isinstance(value, Decimal):
        return "decimal", str(value)
    return "str", str(value)


def decode_hwm(tag: str, value: Any) -> Any:
    if value is None:
        return None
    if tag == "datetime":
        return datetime.fromisoformat(value)
    if tag == "date":
        return date.fromisoformat(value)
    if tag == "decimal":
        return Decimal(value)
    return value


class LoadState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _file(self, source: str, table: str) -> str:
        return f"{self.path}/{re.sub(r'[^A-Za-z0-9_.$-]', '_', source)}@{table}.json"

    def _read(self, path: str) -> dict | None:
        text = read_text(self.spark, path)
        if text is None:
            return None
        try:
            found = json.loads(text)
        except ValueError as exc:
            # a corrupt record must not turn into a silent full reload
            raise RuntimeError(f"unreadable load state {path}") from exc
        return found if isinstance(found, dict) else {"hwm": found}

    def _write(self, source: str, table: str, record: dict) -> None:
        record = {**record, "source": source, "table": table, "updated_at": _now()}
        # replaces the record in one step; deleting it first could lose the mark
        replace_text(self.spark, self._file(source, table), json.dumps(record, sort_keys=True))

    def record(self, source: str, table: str) -> dict:
        return self._read(self._file(source, table)) or {}

    def get(self, source: str, table: str) -> Any:
        """The mark to resume after, in its own type; None for a fresh load."""
        r = self.record(source, table)
        return decode_hwm(r.get("hwm_type", ""), r.get("hwm"))

    def begin(self, source: str, table: str) -> dict:
        r = {"rows": 0, "hwm": None, "load_no": 0, "series": uuid.uuid4().hex[:8], **self.record(source, table), "status": "in_progress"}
        self._write(source, table, r)
        return r

    def advance(self, source: str, table: str, hwm: Any, rows: int) -> None:
        """After a commit: move the mark, add the rows, and take the next landing number."""
        r = self.record(source, table)
        tag, value = encode_hwm(hwm)
        r.update(hwm=value, hwm_type=tag, rows=int(r.get("rows") or 0) + rows, status="in_progress",
                 load_no=int(r.get("load_no") or 0) + 1)
        self._write(source, table, r)

    def complete(self, source: str, table: str) -> None:
        self._write(source, table, {"rows": 0, **self.record(source, table), "status": "complete"})

    def reset(self, source: str, table: str) -> None:
        """Forget mark and count, so the next load starts over; landed loads keep their numbers."""
        r = self.record(source, table)
        if r:
            kept = {k: r[k] for k in ("load_no", "series") if k in r}
            self._write(source, table, {"rows": 0, "hwm": None, "status": "reset", **kept})

    def import_legacy(self, source: str, path: str) -> int:
        """Take over a one-file state {table: record or bare mark}."""
        found = self._read(path) or {}
        for table, r in found.items():
            r = dict(r) if isinstance(r, dict) else {"hwm": r}
            r["hwm_type"] = encode_hwm(r.get("hwm"))[0]
            self._write(source, table, r)
        return len(found)

    def status(self) -> DataFrame:
        fs, p = hadoop_path(self.spark, self.path)
        names = [s.getPath().toString() for s in fs.listStatus(p)] if fs.exists(p) else []
        rows = []
        for name in sorted(n for n in names if n.endswith(".json")):
            r = self._read(name) or {}
            hwm = r.get("hwm")
            rows.append((r.get("source"), r.get("table"), r.get("status", "none"), int(r.get("rows") or 0),
                         None if hwm is None else str(hwm), r.get("hwm_type"), r.get("updated_at")))
        return self.spark.createDataFrame(rows, STATUS_SCHEMA)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")
