"""Order lifecycle as events occur (Q6, Q8): drafts that expire, transitions that may not be.

The state holds each order's last status and change.  A pending order expires by event time
five minutes after its last change; any further change takes that back.  When the
watermark passes the time, the order is reported as ``expired``; if a later change reaches
an expired order, it is reported as ``withdrawn``.  A status that the lifecycle does not allow
after the one before is reported once, as ``illegal``.

Orders are kept in groups of up to 256 neighbouring ids, whatever the size of the table: every
call on a state or timer is a round trip between Python and the JVM, and a group needs one read,
one write and one timer, at its next expiry, where single orders needed up to four each.

Event time drives it, so results do not depend on when the stream runs, as long as changes
arrive within the watermark's ``delay`` (Spark drops rows at or before the watermark as late).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.model import CANCELLABLE_FROM, NEXT_STATUS
from tidemark.operators.silver import change_rows
from tidemark.streaming.state_store import use_rocksdb

EXPIRY_MS = 5 * 60 * 1000
OUTPUT = ("order_id long, event string, customer_id long, order_date timestamp, from_status string, "
          "to_status string, at_ms long")
_STATE = ("orders array<struct<order_id: long, status: string, customer_id: long, order_date: timestamp, "
          "timer: long, expired: boolean>>, timer long")
GROUP = 256  # neighbouring order ids in one state


class OrderLifecycle(StatefulProcessor):
    def __init__(self, legal: set[tuple[str, str]], expiry_ms: int = EXPIRY_MS):
        self.legal, self.expiry_ms = legal, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.group = handle.getValueState("group", _STATE)

    def _held(self) -> tuple[dict, int | None]:
        held = self.group.get()
        return ({}, None) if held is None else ({o[0]: tuple(o) for o in held[0]}, held[1])

    def _keep(self, orders: dict, first_timer: int | None) -> None:
        """Writes the group and moves its timer to its next expiry."""
        timer = min((o[4] for o in orders.values() if o[4] is not None), default=None)
        if timer != first_timer:
            if first_timer is not None:
                self.handle.deleteTimer(first_timer)
            if timer is not None:
                self.handle.registerTimer(timer)
        self.group.update(([*orders.values()], timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        orders, first_timer = self._held()
        out = []
        for r in sorted(rows, key=lambda r: (r.ts_ms, r._cdc_lsn, r._cdc_offset)):
            _, before, _, _, _, expired = orders.get(r.order_id, (None, None, None, None, None, False))

            def event(kind):
                out.append(Row(order_id=r.order_id, event=kind, customer_id=r.customer_id, order_date=r.order_date,
                               from_status=before, to_status=r.status, at_ms=r.ts_ms))

            if expired:
                event("withdrawn")
            status = None if r._is_deleted else r.status
            if not r._is_deleted and before is not None and (before, status) not in self.legal:
                event("illegal")
            timer = r.ts_ms + self.expiry_ms if status == "pending" else None
            orders[r.order_id] = (r.order_id, status, r.customer_id, r.order_date, timer, False)
        self._keep(orders, first_timer)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        orders, _ = self._held()
        at, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        out = []
        for o, status, customer, date, timer, _ in [*orders.values()]:
            if timer is not None and (timer <= at or timer < watermark):  # as Spark fires timers
                out.append(Row(order_id=o, event="expired", customer_id=customer, order_date=date,
                               from_status=status, to_status=None, at_ms=timer))
                orders[o] = (o, status, customer, date, None, True)
        self._keep(orders, None)  # Spark takes back the timer that has fired
        return iter(out)

    def close(self) -> None:
        pass


def legal_pairs() -> set[tuple[str, str]]:
    """Status pairs that may follow one another: no change, the next step, a cancellation."""
    known = {*NEXT_STATUS, *NEXT_STATUS.values(), "cancelled"}
    return {(s, s) for s in known} | set(NEXT_STATUS.items()) | {(s, "cancelled") for s in CANCELLABLE_FROM}


def order_events(bronze: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Lifecycle events of a stream of bronze rows."""
    use_rocksdb(bronze.sparkSession)
    # the process that plans a stateful processor does not see the session's archives
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = change_rows(bronze.where("cdc_table = 'orders'"), "orders").withWatermark("_cdc_ts", delay)
    rows = rows.selectExpr("order_id", "status", "customer_id", "order_date", "_cdc_ts", "unix_millis(_cdc_ts) AS ts_ms",
                           "_cdc_lsn", "_cdc_offset", "_is_deleted")
    return rows.withColumn("orders", F.floor(F.col("order_id") / GROUP)).groupBy("orders").transformWithState(
        OrderLifecycle(legal_pairs()), outputStructType=OUTPUT, outputMode="append", timeMode="eventTime")
