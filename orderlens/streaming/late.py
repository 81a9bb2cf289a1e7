"""Events that repeat or come late: what a stream accepts, and what it leaves aside.

Repeats are dropped by keyed state that lives as long as the watermark says. Events behind the
watermark cannot be told from repeats any more and are left aside, but not lost: every arrival
is kept once, and those whose key was never accepted are the late ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlens.operators.keyed import absent_from
from orderlens.sources.tables import TableStore


class LateGate:
    """Accepted events and arrivals of one stream, under a shared root folder."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], time: str, delay: str):
        self.spark, self.store, self.schema = spark, TableStore(spark, root), schema
        self.keys, self.time, self.delay = list(keys), time, delay

    def _kept(self, table: str) -> DataFrame:
        return self.store.read_batches(table, self.schema)

    def run(self, source: DataFrame) -> None:
        """Take in what has arrived. Both tables are written by epoch, so a repeated epoch changes nothing.

        With no event ahead of the watermark, state of a key lives until its time plus the
        delay has passed; a key that comes again after that is a new event.
        """
        def keep(table: str):
            return lambda rows, epoch: self.store.put_batch(table, rows, epoch) and None

        unique = source.withWatermark(self.time, self.delay).dropDuplicatesWithinWatermark(self.keys)
        started = [
            df.writeStream.foreachBatch(keep(name))
            .option("checkpointLocation", f"{self.store.root}/state-{name}")
            .trigger(availableNow=True)
            .start()
            for name, df in (("arrived", source), ("accepted", unique))
        ]
        for query in started:
            query.awaitTermination()

    def accepted(self) -> DataFrame:
        return self._kept("accepted")

    def late(self) -> DataFrame:
        """Arrivals behind the watermark whose key was never accepted, one row per key."""
        return absent_from(self._kept("arrived"), self.accepted(), self.keys).dropDuplicates(self.keys)
