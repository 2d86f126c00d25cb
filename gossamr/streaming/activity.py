"""What is running and what it has counted, without a pass of its own: observed metrics and a listener."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from gossamr.session import scratch_path


class Activity(StreamingQueryListener):
    """How many streams run, how many rows each has read, and the sums of the metrics that they observe.

    Use: with Activity(spark) as activity. Streams count by their name, or id where they have none. Metrics must be whole
    numbers that add up over batches; live() is 0 as soon as all streams have ended.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.changed = spark, threading.Condition()
        self.running: dict[str, str] = {}
        self.rows: Counter = Counter()
        self.metrics: dict[str, Counter] = {}

    def __enter__(self) -> Activity:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.running[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self.changed:
            self.rows[progress.name or str(progress.id)] += progress.numInputRows
            for name, row in progress.observedMetrics.items():
                self.metrics.setdefault(name, Counter()).update({k: v for k, v in row.asDict().items() if v is not None})
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.running.pop(str(event.runId), None)
            self.changed.notify_all()

    def live(self) -> int:
        with self.changed:
            return len(self.running)

    def wait(self, seconds: float) -> bool:
        """Wait until no stream runs; whether that has come true."""
        with self.changed:
            return self.changed.wait_for(lambda: not self.running, seconds)


def counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
    """df, written to the shared folder, and the metrics (aggregates) of it that were observed while it was written."""
    seen = Observation(name)
    path = scratch_path(df.sparkSession, name)
    df.observe(seen, *[x.alias(k) for k, x in (metrics or {"rows": F.count(F.lit(1))}).items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get
