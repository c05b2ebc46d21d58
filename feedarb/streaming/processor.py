"""The arbitration state machine as a keyed stateful operator.

One state per (stream type, symbol), kept in the state store and so across
restarts.  Copies and confirmations come as one tagged stream, see ``tag_copies``
and ``tag_confirmations``; a micro-batch bounds what a group brings to one task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import feedarb
from feedarb.params import ArbitrationParams
from feedarb.sources.landing import GROUP
from feedarb.streaming import steps

# Columns of the tagged input besides the group.
CONFIRMATION, COPY = 0, 1

MESSAGE_FIELDS = {
    "stream_type": "string",
    "symbol": "string",
    "kind": "string",
    "at_us": "bigint",
    "msg_key": "string",
    "source_id": "string",
    "seq_offset": "bigint",
    "value": "binary",
    "headers": "string",
    "window_start_us": "bigint",
    "slowest_source_id": "string",
    "counts": "map<string,bigint>",
    "total_events": "bigint",
    "sources_seen": "bigint",
    "reason": "string",
    "sources_confirmed": "bigint",
    "sources_expected": "bigint",
    "stalled_for_us": "bigint",
    "ignored_sources": "array<string>",
    "gate_open": "boolean",
    "pending": "bigint",
    "state_no": "bigint",
    "consumed": "bigint",
    "forwarded": "bigint",
    "duplicates": "bigint",
    "ignored": "bigint",
}
MESSAGE_SCHEMA = ", ".join(f"{name} {dtype}" for name, dtype in MESSAGE_FIELDS.items())


def tag_copies(copies: DataFrame) -> DataFrame:
    """Payload and headers travel unread; headers as one JSON text."""
    value = F.col("value") if "value" in copies.columns else F.lit(None)
    headers = F.to_json("headers") if "headers" in copies.columns else F.lit(None).cast("string")
    return copies.select(
        *GROUP,
        F.lit(COPY).alias("tag"),
        "seq_offset",
        "arr_us",
        "msg_key",
        "source_id",
        value.cast("binary").alias("value"),
        headers.alias("headers"),
    )


def tag_confirmations(confirmed: DataFrame) -> DataFrame:
    """From (group, source_id, terminated_us); a replay adds ``seq_offset``, the copy
    before which the confirmation takes effect."""
    placed = "seq_offset" in confirmed.columns
    place = F.col("seq_offset") if placed else F.lit(None).cast("bigint").alias("seq_offset")
    return confirmed.select(
        *GROUP,
        F.lit(CONFIRMATION).alias("tag"),
        place,
        F.col("terminated_us").alias("arr_us"),
        F.lit(None).cast("string").alias("msg_key"),
        "source_id",
        F.lit(None).cast("binary").alias("value"),
        F.lit(None).cast("string").alias("headers"),
    )


def in_order(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies by offset, confirmations by time, a confirmation first when both tie.

    Offsets decide among copies; a copy never lies before an earlier offset in time.
    """
    copies = rows[rows["tag"] == COPY].sort_values("seq_offset", kind="stable")
    copies = copies.assign(arr_us=copies["arr_us"].cummax())
    others = rows[rows["tag"] == CONFIRMATION]
    if others.empty:
        return copies
    return pd.concat([others, copies]).sort_values(["arr_us", "tag"], kind="stable")


class ArbitrationProcessor(StatefulProcessor):
    """``live`` also lets windows close and warnings come without any copies."""

    def __init__(self, params: ArbitrationParams, live: bool = False):
        self.params = params
        self.live = live

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getValueState("group", "body string")

    def handleInputRows(
        self, key: tuple[str, str], rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        batch = in_order(pd.concat(list(rows), ignore_index=True))
        state, params, lag = self._load(), self.params, self.params.lag_for(key[0])
        before = None if state is None else state["due"]
        out: list[steps.Message] = []
        firsts: list[int] = []
        counted = {"forwarded": 0, "duplicate": 0, "ignored": 0}
        columns = [batch[c].tolist() for c in ("tag", "arr_us", "msg_key", "source_id")]
        for row, (tag, at, msg_key, source) in enumerate(zip(*columns)):
            if tag == CONFIRMATION:
                # A group that never had a copy has nothing to update.
                if state is not None:
                    steps.pass_time(state, at, params, out)
                    steps.take_confirmation(state, source)
                continue
            if state is None:
                state = steps.new_state(at, params)
            steps.pass_time(state, at, params, out)
            fate = steps.take_copy(state, msg_key, source, params, lag, out)
            counted[fate] += 1
            if fate == "forwarded":
                firsts.append(row)
        if state is not None:
            state["batches"] += 1
            out.append(self._snapshot(state, counted))
            self._store(state, before)
        yield self._forwarded(key, batch.iloc[firsts])
        yield self._frame(key, out)

    def handleExpiredTimer(
        self, key: tuple[str, str], timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[pd.DataFrame]:
        state = self._load()
        out: list[steps.Message] = []
        if state is not None:
            now = timerValues.getCurrentProcessingTimeInMs() * 1000
            steps.pass_time(state, max(now, state["clock"]), self.params, out)
            self._store(state, None)
        yield self._frame(key, out)

    def close(self) -> None:
        pass

    def _load(self) -> steps.State | None:
        return json.loads(self.stored.get()[0]) if self.stored.exists() else None

    def _store(self, state: steps.State, before: int | None) -> None:
        self.stored.update((json.dumps(state, separators=(",", ":")),))
        due = state["due"]
        if self.live and due != before:
            if before is not None:
                self.handle.deleteTimer(before // 1000)
            self.handle.registerTimer(due // 1000)

    def _snapshot(self, state: steps.State, counted: dict[str, int]) -> steps.Message:
        gate_open = state["closed"] is None
        return {
            "kind": "state",
            "at_us": state["clock"],
            "state_no": state["batches"],
            "gate_open": gate_open,
            "pending": len(state["cache"]),
            "window_start_us": state["window"] if gate_open else 0,
            "counts": dict(state["wins"]),
            "ignored_sources": sorted(state["ignored"]),
            "consumed": sum(counted.values()),
            "forwarded": counted["forwarded"],
            "duplicates": counted["duplicate"],
            "ignored": counted["ignored"],
        }

    @staticmethod
    def _forwarded(key: tuple[str, str], rows: pd.DataFrame) -> pd.DataFrame:
        """Input rows of first copies, payload untouched, as messages."""
        known = {
            "stream_type": key[0],
            "symbol": key[1],
            "kind": "forwarded",
            "at_us": rows["arr_us"],
            **{c: rows[c] for c in ("msg_key", "source_id", "seq_offset", "value", "headers")},
        }
        columns = {name: known.get(name) for name in MESSAGE_FIELDS}
        return pd.DataFrame(columns, index=rows.index, dtype=object)

    @staticmethod
    def _frame(key: tuple[str, str], out: list[steps.Message]) -> pd.DataFrame:
        """Messages as one frame; members no message has become empty columns."""
        present = set().union(*(message.keys() for message in out))
        columns = {
            name: [message.get(name) for message in out] if name in present else None
            for name in MESSAGE_FIELDS
        }
        columns.update(stream_type=key[0], symbol=key[1])
        return pd.DataFrame(columns, index=range(len(out)), dtype=object)


def arbitrate(tagged: DataFrame, params: ArbitrationParams, live: bool = False) -> DataFrame:
    """Forwarded copies, audit messages and state snapshots as one stream.

    Each micro-batch adds one ``state`` row per group with its own counts.  Needs
    the RocksDB state store (see ``stateful_settings``).
    """
    # Python workers cannot count on finding this package, least of all the one that
    # reads the operator's state layout; its code travels with the operator.
    cloudpickle.register_pickle_by_value(feedarb)
    return tagged.groupBy(*GROUP).transformWithStateInPandas(
        statefulProcessor=ArbitrationProcessor(params, live),
        outputStructType=MESSAGE_SCHEMA,
        outputMode="Append",
        timeMode="ProcessingTime" if live else "None",
    )


# What a session needs for the operator above.
STATEFUL_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
