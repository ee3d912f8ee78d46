"""Reference SQL for the registered queries, written for DuckDB over the same parquet tables.

The SQL is written from the meaning of each report, not from the Spark plans.  A query is assembled
from the raw views it mentions, its body, and casts to its contract.
"""

from __future__ import annotations

import re

from layerhouse.catalog import SNAPSHOTS
from layerhouse.sources.warehouse import EVENT_DAY, LAST_DAY, ORDER_DAY
from oracle.bodies import BODIES
from oracle.raw import RAW

SNAPSHOT_DAYS = {
    "event_day": f"DATE '{EVENT_DAY}'", "order_day": f"DATE '{ORDER_DAY}'", "last_day": f"DATE '{LAST_DAY}'", "end_date": "end_date",
}

_CASTS = {
    "i": "CAST({c} AS INTEGER)", "l": "CAST({c} AS BIGINT)", "d": "CAST({c} AS DOUBLE)",
    "s": "CAST({c} AS VARCHAR)", "b": "CAST({c} AS BOOLEAN)",
}


#: Snapshots: the partition a load writes, as SQL.
_DAYS = {name: SNAPSHOT_DAYS[day] for name, day in SNAPSHOTS.items()} | {
    f"{name}_three_snapshots_load": "end_date" for name in ("e8", "l8", "l9")}


def _needed(text: str, found: set[str]) -> set[str]:
    for word in set(re.findall(r"\b[a-z0-9_]+\b", text)) & RAW.keys() - found:
        found.add(word)
        _needed(RAW[word], found)
    return found


def assemble(name: str, columns: list[tuple[str, str]]) -> str:
    body = BODIES[name].strip()
    views = [v for v in RAW if v in _needed(body, set())]
    ctes = ",\n".join(f"{v} AS ({RAW[v].strip()})" for v in views)
    values = {column: column for column, _ in columns}
    if day := _DAYS.get(name):
        values["dt"] = day
    casts = ", ".join(f"{_CASTS[kind].format(c=values[column])} AS {column}" for column, kind in columns)
    head = f"WITH {ctes},\n" if ctes else "WITH "
    return f"{head}answer AS ({body})\nSELECT {casts} FROM answer"
