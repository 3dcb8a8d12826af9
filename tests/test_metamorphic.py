"""Shuffling, replaying or splitting the change log leaves silver unchanged."""

from pyspark.sql import functions as F

from tidemark.model import PRIMARY_KEYS
from tidemark.operators import bronze as B
from tidemark.operators import silver as S
from tidemark.plans.flow import Flow

from conftest import SF_SMALL

COLS = ["order_id", "status", "total_amount", "_cdc_op", "_cdc_lsn", "_is_deleted"]


def _sorted(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_shuffle_replay_and_split_batches(spark):
    p = Flow(spark, SF_SMALL)
    recs = p.records_of("orders")
    expected = _sorted(S.state(B.decode(recs), "orders"))
    shuffled = recs.orderBy(F.rand(7))
    assert _sorted(S.state(B.decode(shuffled), "orders")) == expected
    replayed = recs.unionByName(recs.sample(0.5, seed=3))
    assert _sorted(S.state(B.decode(replayed), "orders")) == expected
    # k batches in arbitrary order through the guarded merge
    keys = PRIMARY_KEYS["orders"]
    k = 4
    parts = recs.withColumn("_b", F.pmod(F.hash("offset"), F.lit(k)))
    state = None
    for b in [2, 0, 3, 1]:
        batch = S.latest_per_key(S.change_rows(B.decode(parts.filter(F.col("_b") == b)
                                                        .drop("_b")), "orders"), keys)
        state = batch if state is None else S.merge_upsert(state, batch, keys, guarded=True)
        state = state.checkpoint()  # cut lineage between batches
    assert _sorted(state) == expected
