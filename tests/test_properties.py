"""Random change logs against a brute-force model of the silver rules."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from records import envelope, order, record, records_df
from tidemark.model import PRIMARY_KEYS
from tidemark.operators import bronze as B
from tidemark.operators import silver as S

OPS = ["c", "u", "d", "r"]
STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]

event = st.tuples(st.integers(1, 6),            # key
                  st.sampled_from(OPS),         # op
                  st.integers(0, 5),            # ts_ms (collisions on purpose)
                  st.sampled_from(STATUSES))
logs = st.lists(event, min_size=1, max_size=40)


def _records(log, dup_every=0):
    rows = []
    for i, (k, op, ts, status) in enumerate(log):
        img = order(k, status)
        v = envelope(op, before=img if op == "d" else None,
                     after=None if op == "d" else img, ts_ms=ts, lsn=i)
        rows.append(record(v, offset=i, partition=k % 2))
        if dup_every and i % dup_every == 0:
            rows.append(record(v, offset=i, partition=k % 2))
    return rows


def _model(log):
    """Newest event per key by (ts, lsn): status and deleted flag."""
    best = {}
    for i, (k, op, ts, status) in enumerate(log):
        if k not in best or (ts, i) > best[k][0]:
            best[k] = ((ts, i), status, op == "d")
    return {k: (v[1], v[2]) for k, v in best.items()}


def _silver(spark, rows):
    s = S.state(B.decode(records_df(spark, rows)), "orders")
    return {r["order_id"]: (r["status"], r["_is_deleted"]) for r in s.collect()}


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(log=logs, data=st.data())
def test_state_matches_model_under_shuffle_and_replay(spark, log, data):
    rows = _records(log, dup_every=3)
    perm = data.draw(st.permutations(range(len(rows))))
    assert _silver(spark, [rows[i] for i in perm]) == _model(log)


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(log=logs, cut=st.integers(0, 40), newest_first=st.booleans())
def test_guarded_merge_of_two_batches_matches_model(spark, log, cut, newest_first):
    rows = _records(log)
    a, b = rows[:cut], rows[cut:]
    keys = PRIMARY_KEYS["orders"]
    first, second = (b, a) if newest_first else (a, b)
    s1 = S.state(B.decode(records_df(spark, first)), "orders")
    s2 = S.state(B.decode(records_df(spark, second)), "orders")
    merged = S.merge_upsert(s1, s2, keys, guarded=True)
    got = {r["order_id"]: (r["status"], r["_is_deleted"]) for r in merged.collect()}
    assert got == _model(log)


def test_envelope_is_valid_json():
    assert json.loads(envelope("c", after=order(1)))["payload"]["op"] == "c"
