"""Counts that a stream keeps between micro-batches as a table: what each batch added, and snapshots of all before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Micro-batches after which their changes are merged into one snapshot.
EVERY = 16


class PaneStore:
    """Sums by key, to which each micro-batch adds.

    A batch writes what it adds to a folder of its own, and replaces that when it is retried, so every
    batch counts once. Every `every` batches all that is still needed is merged into a snapshot, and what
    the snapshot before last was made of is removed. So a batch reads one snapshot and fewer than
    `every` small tables, however many batches there were.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], value: str, schema: str, every: int = EVERY):
        self.spark, self.folder, self.schema, self.every = spark, folder, schema, every
        self.keys, self.value = list(keys), value

    def write(self, added: DataFrame, batch_id: int) -> DataFrame:
        """Keeps what a batch adds, and reads it back."""
        added.select(*self.keys, self.value).write.mode("overwrite").parquet(self._added(batch_id))
        return self.spark.read.schema(self.schema).parquet(self._added(batch_id))

    def read(self, batch_id: int) -> DataFrame:
        """What all batches up to this one have added, in rows that add up."""
        return self.spark.read.schema(self.schema).parquet(*self.paths(batch_id))

    def paths(self, batch_id: int) -> list[str]:
        """The newest snapshot before a batch, and what batches have added since, this one included."""
        base = batch_id // self.every * self.every - 1
        while base >= 0 and not self._exists(self._snapshot(base)):
            base -= self.every
        # a batch without rows may have no folder
        added = [path for number in range(max(base, -1) + 1, batch_id + 1) if self._exists(path := self._added(number))]
        return ([self._snapshot(base)] if base >= 0 else []) + added

    def compact(self, batch_id: int, needed: Column) -> None:
        """After the last of `every` batches: a snapshot of the rows that later batches may need."""
        if (batch_id + 1) % self.every:
            return
        live = self.read(batch_id).filter(needed).groupBy(*self.keys).agg(F.sum(self.value).alias(self.value))
        live.write.mode("overwrite").parquet(self._snapshot(batch_id))
        # a retry of this batch needs the snapshot before it, and what came since
        before = batch_id - self.every
        for path in (self._snapshot(before - self.every), *(self._added(n) for n in range(max(0, before - self.every + 1), before + 1))):
            self._remove(path)

    def _snapshot(self, batch_id: int) -> str:
        return f"{self.folder}/snapshot-{batch_id}"

    def _added(self, batch_id: int) -> str:
        return f"{self.folder}/added-{batch_id}"

    def _file(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), found

    def _exists(self, path: str) -> bool:
        system, found = self._file(f"{path}/_SUCCESS")
        return system.exists(found)

    def _remove(self, path: str) -> None:
        system, found = self._file(path)
        system.delete(found, True)
