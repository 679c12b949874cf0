"""Several outputs of one pass: rows are computed once, and each output is read back by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import scratch_dir


class Outputs:
    """Rows written once, in a folder for each value of a label, so that an output reads only its own files.

    Rows are written by the tasks that make them, without a further shuffle. A null label is an output too.
    Values that never occur give empty outputs. The label is read back as the column it was.
    """

    def __init__(self, rows: DataFrame, label: str, purpose: str):
        self.label = label
        path = scratch_dir(rows.sparkSession, purpose)
        rows.write.partitionBy(label).parquet(path)
        self._written = rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)

    def of(self, value: str | None) -> DataFrame:
        return self._written.filter(F.col(self.label).eqNullSafe(F.lit(value)))
