"""Hand-written change records for unit tests."""

import datetime as dt
import json

from tidemark.model import KAFKA_SCHEMA, topic_for

EPOCH = dt.datetime(1970, 1, 1)


def envelope(op, before=None, after=None, ts_ms=0, lsn=0, table="orders", db="retail"):
    payload = {"op": op, "ts_ms": ts_ms, "source": {"db": db, "table": table, "lsn": lsn}}
    if before is not None:
        payload["before"] = before
    if after is not None:
        payload["after"] = after
    return json.dumps({"payload": payload})


def record(value, offset, table="orders", partition=0, ts_ms=0, latency_ms=0):
    ts = EPOCH + dt.timedelta(milliseconds=ts_ms + latency_ms)
    return (topic_for(table), partition, offset, ts, value)


def records_df(spark, rows):
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def order(order_id, status="pending", customer_id=1, total=10.0, **kw):
    d = {"order_id": order_id, "customer_id": customer_id, "status": status,
         "channel": "web", "total_amount": total,
         "order_date": "2023-12-09T10:00:00.000000Z"}
    d.update(kw)
    return d
