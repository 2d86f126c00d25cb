"""Tables that a stream adds to batch by batch, so that a batch that runs again changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.session import written


class BatchTable:
    """A folder of Parquet folders, one for each batch. Writing a batch again replaces what it wrote before."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def write(self, batch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def batches(self) -> list[int]:
        return sorted(int(x.partition("=")[2]) for x in written(self.spark, self.path) if x.startswith("batch="))

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def before(self, batch: int | None = None) -> DataFrame:
        """What the batches before this one have written, or all batches; later ones may be there already."""
        return self._read([f"{self.path}/batch={b}" for b in self.batches() if batch is None or b < batch])


class Ledger(BatchTable):
    """Counters by key that batches add to: rows of keys and n. Sums of many batches are kept, so that few files are read."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], every: int = 16):
        super().__init__(spark, path, schema)
        self.keys, self.every = keys, every

    def _sums(self) -> list[int]:
        return sorted(int(x.partition("=")[2]) for x in written(self.spark, self.path) if x.startswith("upto="))

    def before(self, batch: int | None = None) -> DataFrame:
        """(keys, n): the counters' totals before a batch, or of all batches."""
        start = max((s for s in self._sums() if batch is None or s < batch), default=None)
        parts = [f"{self.path}/upto={start}"] if start is not None else []
        parts += [f"{self.path}/batch={b}" for b in self.batches() if (start is None or b > start) and (batch is None or b < batch)]
        return self._read(parts).groupBy(*self.keys).agg(F.sum("n").alias("n"))

    def write(self, batch: int, rows: DataFrame) -> None:
        """Adds a batch's rows; every so many batches their sum is written as well."""
        super().write(batch, rows)
        if (batch + 1) % self.every == 0:
            self.before(batch + 1).write.mode("overwrite").parquet(f"{self.path}/upto={batch}")
