"""What the alert stream keeps per customer, in Spark's state store.

* ``alerts``   how many alerts the customer has, up to the number that matters
* ``known``    the ids of the events that have alerted, for good
* ``waiting``  transactions that the watermark has not passed yet
* ``next``     the moment of the earliest of these, for which a timer is set

Transactions wait until the watermark has passed them and are then scored in the
order of their event time, whatever order they arrived in. A transaction that
comes later than the watermark allows is scored at once, with the alerts that its
customer has by then; none is dropped.

A task holds what one customer does within the delay of the watermark and one
micro-batch, as tuples. All else stays in the store.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The class travels to the executors with its code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WAITING = "at bigint, event_id string, transaction_id string, base int, need int, rule_name string"
ALERT = "alert_id string, transaction_id string, customer_id string, rule_name string, risk_score int, alert_status string"

_CHUNK = 1000
_FIRST = -(1 << 62)  # an event without a time comes before all others


def _known_key(event_id: str | None) -> tuple[str]:
    return ("=" + event_id if event_id is not None else "",)


def _moment(row: tuple) -> tuple:
    """Event time, then id, transaction, score and rule; NULLs first, as in the batch."""
    return tuple((value is not None, value) if value is not None else (False, 0) for value in (*row[:4], row[5]))


class AlertState(StatefulProcessor):
    def __init__(self, points: int, most: int, highest: int):
        """``points`` per earlier alert, of which ``most`` count, and the ``highest`` score."""
        self._points, self._most, self._highest = points, most, highest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._alerts = handle.getValueState("alerts", "alerts int")
        self._known = handle.getMapState("known", "event_id string", "raised boolean")
        self._waiting = handle.getListState("waiting", WAITING)
        self._next = handle.getValueState("next", "at bigint")

    def _plan(self, moment: int) -> None:
        """Have the timer go off when the watermark passes ``moment``, or earlier.

        Timers are in milliseconds and go off at a watermark that equals them.
        """
        at = max(moment // 1000, 0) + 1
        planned = self._next.get() if self._next.exists() else None
        if planned is not None and planned[0] <= at:
            return
        if planned is not None:
            self._handle.deleteTimer(planned[0])
        self._handle.registerTimer(at)
        self._next.update((at,))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first, chunk = None, []
        for row in rows:
            if row.is_mark:
                continue
            at = row.at if row.at is not None else _FIRST
            first = at if first is None else min(first, at)
            chunk.append((at, row.event_id, row.transaction_id, row.base, row.need, row.rule_name))
            if len(chunk) == _CHUNK:
                self._waiting.appendList(chunk)
                chunk = []
        if chunk:
            self._waiting.appendList(chunk)
        if first is not None:
            self._plan(first)
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        due, later = [], []
        for row in self._waiting.get():
            row = tuple(row)
            (due if row[0] // 1000 < watermark else later).append(row)
        due.sort(key=_moment)
        count = before = self._alerts.get()[0] if self._alerts.exists() else 0
        for _, event_id, transaction_id, base, need, rule_name in due:
            if need > count or self._known.containsKey(_known_key(event_id)):
                continue
            yield Row(
                alert_id=None if event_id is None else f"STREAM-{event_id}",
                transaction_id=transaction_id,
                customer_id=key[0],
                rule_name=rule_name,
                risk_score=min(base + count * self._points, self._highest),
                alert_status="OPEN",
            )
            self._known.updateValue(_known_key(event_id), (True,))
            count = min(count + 1, self._most)
        if count != before:
            self._alerts.update((count,))
        self._next.clear()
        if later:
            self._waiting.put(later)
            self._plan(min(row[0] for row in later))
        else:
            self._waiting.clear()

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        """An alert that was raised before the stream began: known, and not counted."""
        self._known.updateValue(_known_key(initialState.event_id), (True,))

    def close(self) -> None:
        pass
