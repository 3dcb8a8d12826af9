"""The medallion flow as one lazy object: records -> bronze -> silver -> gold.

Nothing is computed until an action; each layer is a DataFrame plan over the
input tables, so a query that needs one gold product scans only what that product
needs.  Silver of a table reads only that table's records: the topic filter is a
plain column predicate, pushed into the union branch that produces the topic.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.model import TABLES
from tidemark.operators.bronze import decode, quarantine, topic_filter
from tidemark.operators.silver import change_rows, state
from tidemark.plans import gold as G
from tidemark.plans import kpi as K
from tidemark.plans.jobs import collect_errors
from tidemark.sources.feed import retail_feeds, retail_records, to_records
from tidemark.sources.store import Store, free
from tidemark.sources.tables import LazyFrames, Tables, retail_views


class Flow:
    def __init__(self, spark: SparkSession, sf_dir: str, run_ts: Column | None = None,
                 delete_image: str = "before"):
        self.spark = spark
        self.sf_dir = sf_dir
        self.run_ts = run_ts
        self.delete_image = delete_image
        self.tables = Tables(spark, sf_dir)

    @cached_property
    def views(self):
        return retail_views(self.tables)

    @cached_property
    def feeds(self):
        return retail_feeds(self.views)

    @cached_property
    def records(self) -> DataFrame:
        return retail_records(self.views)

    def records_of(self, table: str) -> DataFrame:
        """Records of one table: only that table's feed is built and scanned."""
        return topic_filter(to_records(self.feeds[table], table), [table])

    @cached_property
    def bronze(self) -> DataFrame:
        return decode(self.records, self.run_ts)

    @cached_property
    def quarantine(self) -> DataFrame:
        return quarantine(self.records, self.run_ts)

    def bronze_of(self, table: str) -> DataFrame:
        return decode(self.records_of(table), self.run_ts)

    @cached_property
    def changes(self) -> dict[str, DataFrame]:
        """Valid change rows of each table."""
        return LazyFrames({t: lambda t=t: change_rows(self.bronze_of(t), t, self.run_ts) for t in TABLES})

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return LazyFrames({t: lambda t=t: state(self.bronze_of(t), t, self.run_ts, self.delete_image)
                           for t in TABLES})

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        return LazyFrames({n: lambda b=build: b(self.silver, lambda: self.bronze)
                           for n, build in G.GOLD_BUILDERS.items()})

    def keep(self, layer: LazyFrames, names, root: str) -> Store:
        """Stores frames of a layer, a few at a time, and puts what was stored in their place.
        A plan that reads a frame several times would else build it as often from the input.
        Returns the store, from which frames that nothing reads any more can be dropped."""
        store, frames = Store(self.spark, root, "zstd"), {n: layer[n] for n in names}
        collect_errors(frames, lambda n: store.write(frames[n], n), parallel=3)
        layer.update({n: store.read(n) for n in names})
        free(self.spark)
        return store

    @cached_property
    def kpis(self) -> dict[str, DataFrame]:
        return LazyFrames({n: lambda b=build, p=product: b(self.gold[p])
                           for n, (build, product) in K.KPI_BUILDERS.items()})
