"""Matching as a stream.

State is kept per (id, client, port): pending queries by name, and whether a
zone transfer runs. A pending query expires when the watermark passes the time
of the first query of its run plus the timeout; files have no meaning here, so
this replaces the batch rule that looks at a file's last message. Within a
micro-batch messages are taken in ``seq`` order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewire.operators.matching import AXFR, FLOW, IXFR, TIMEOUT_MS

OUTPUT = "kind string, request string, response string, expired boolean"


def _step(state: dict, row: dict) -> dict | None:
    """One message against the state; an output row or nothing."""
    pending = state["pending"]
    name = json.dumps(row["qname"])
    if row["qr"] == 0:
        if row["qtype"] in (AXFR, IXFR):
            state["transfer"] = 0
        first = pending[name][0] if name in pending else row["time"]
        pending[name] = [first, row["payload"], row["qname"] is not None]
        return None
    if state["transfer"] is not None:
        if state["transfer"] > 0:
            return None
        state["transfer"] = 1
    if name in pending:
        _, query, _ = pending.pop(name)
        return {"kind": "pair", "request": query, "response": row["payload"], "expired": False}
    if row["qname"] is not None:
        return {"kind": "response", "request": None, "response": row["payload"], "expired": False}
    return None


def _expire(state: dict, limit: int) -> list[dict]:
    out = []
    for name in [n for n, p in state["pending"].items() if p[0] < limit]:
        _, query, asked = state["pending"].pop(name)
        if asked:
            out.append({"kind": "pending", "request": query, "response": None, "expired": True})
    return out


def match_stream(messages: DataFrame, timeout_ms: int = TIMEOUT_MS, watermark: str = "2 seconds") -> DataFrame:
    """Joined rows (request and response structs, expired) of a streaming or batch ``messages``.

    ``messages`` has the matching columns; ``time`` is in milliseconds.
    """
    own = F.struct(*messages.columns)
    payload = messages.withColumn("payload", F.to_json(own)).withColumn("ts", F.timestamp_millis("time"))
    kind = messages.select(own.alias("m")).schema["m"].dataType

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        memory = json.loads(state.get[0]) if state.exists else {"transfer": None, "pending": {}}
        out: list[dict] = []
        now = state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            out += _expire(memory, now - timeout_ms)
        else:
            rows = pd.concat(list(batches))
            rows = rows.sort_values("seq") if "seq" in rows else rows
            for row in rows[["qr", "qname", "qtype", "time", "payload"]].astype(object).to_dict("records"):
                row = {k: None if v is None or v != v else v for k, v in row.items()}
                row["time"] = int(row["time"])
                done = _step(memory, row)
                if done:
                    out.append(done)
        if memory["pending"] or memory["transfer"] is not None:
            state.update((json.dumps(memory),))
            if memory["pending"]:
                state.setTimeoutTimestamp(max(now + 1, min(p[0] for p in memory["pending"].values()) + timeout_ms + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["kind", "request", "response", "expired"])

    grouped = payload.withWatermark("ts", watermark).select(*FLOW, F.col("seq").cast("long").alias("seq"), "qr", "qname", "qtype", "time", "payload", "ts").groupBy(*FLOW)
    found = grouped.applyInPandasWithState(run, OUTPUT, "memory string", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.from_json("request", kind).alias("request"), F.from_json("response", kind).alias("response"), "expired")
