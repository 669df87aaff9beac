"""Cooldowns of origins as streaming state.

An origin's state is its last block; it is cleared by a success that is not older, and it times out
when the block ends. The batch form of the same rules is ``gleaner.operators.pacing.cooldowns``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "origin STRING, change STRING, observed_us BIGINT, blocked_until_us BIGINT"
STATE = "observed_us BIGINT, blocked_until_us BIGINT"


def changes(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows for every block and clearing of one origin; events have ts_us, status and wait_us."""
    if state.hasTimedOut:
        observed, until = state.get
        state.remove()
        yield pd.DataFrame([(key[0], "expired", observed, until)], columns=["origin", "change", "observed_us", "blocked_until_us"])
        return
    held = tuple(state.get) if state.exists else None
    rows = []
    events = pd.concat(list(batches)).sort_values(["ts_us", "status"], kind="stable")
    for ts, status, wait in zip(events["ts_us"], events["status"], events["wait_us"]):
        if status == 429 and (held is None or ts >= held[0]):
            held = (int(ts), int(ts + wait))
            rows.append((key[0], "blocked", *held))
        elif 200 <= status < 300 and held is not None and ts >= held[0]:
            rows.append((key[0], "cleared", int(ts), held[1]))
            held = None
    if held is None:
        if state.exists:
            state.remove()
    else:
        state.update(held)
        left = (held[1] - held[0]) // 1000
        state.setTimeoutDuration(max(1, left))
    yield pd.DataFrame(rows, columns=["origin", "change", "observed_us", "blocked_until_us"])


def tracked(log: DataFrame) -> DataFrame:
    """The changes of a streaming log with origin, ts_us, status and wait_us."""
    return log.groupBy("origin").applyInPandasWithState(changes, OUTPUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
