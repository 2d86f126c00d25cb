"""The frontier as streams: admission without repeats, and holds of hosts as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gossamr.functions import urls
from gossamr.operators.frontier import check_hosts, skip_reason
from gossamr.session import ship
from gossamr.sources import links
from gossamr.sources.options import Options


def pages_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Pages as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def admission_stream(pages: DataFrame, tops: DataFrame, options: Options = Options()) -> DataFrame:
    """(url, host_id) of the distinct clean links of a stream of pages that pass all filters. State: one row for each URL."""
    found = check_hosts(links.extract(pages), tops, options.match_domain).withColumn("url", urls.clean(F.col("link")))
    return found.filter(F.col("host_id").isNotNull() & F.col("url").isNotNull() & skip_reason(F.col("url"), options).isNull()).select("url", "host_id").dropDuplicates(["url"])


def _hold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    until = state.get[0] if state.exists else 0
    for batch in batches:
        until = max(until, int(batch["until"].max()))
    state.update((until,))
    state.setTimeoutDuration(max(1000, until * 1000 - state.getCurrentProcessingTimeMs()))
    yield pd.DataFrame({"host_id": [key[0]], "until": [until]})


def hold_stream(responses: DataFrame) -> DataFrame:
    """(host_id, until), the latest hold of each host, from a stream of (host_id, until in seconds); a hold's state goes when it ends.

    With timers Spark plans batches without data for ever; run_available() turns those off, so that it ends.
    """
    ship(responses.sparkSession)
    return responses.groupBy("host_id").applyInPandasWithState(_hold, "host_id long, until long", "until long", "update", GroupStateTimeout.ProcessingTimeTimeout)


def run_available(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Process what is there, once, and stop."""
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        stream.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink).awaitTermination()
    finally:
        conf.set(key, before)


def collect_available(stream: DataFrame, name: str, mode: str = "update") -> DataFrame:
    """The rows that a stream makes of what is there, as a table in memory: for tests and small reports."""
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(key, before)
    return stream.sparkSession.table(name)
