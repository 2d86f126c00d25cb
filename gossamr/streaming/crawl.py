"""The crawl as streams: admission as keyed state, and a run that parses pages batch by batch."""

from __future__ import annotations

import sys
import threading
from collections.abc import Iterator

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gossamr.functions import urls
from gossamr.operators import frontier
from gossamr.session import ship
from gossamr.sources import links
from gossamr.sources.options import Options
from gossamr.streaming.batches import BatchTable, Ledger

ADMITTED = "url string, host_id long, page_id long, pos int, enqueue boolean, checked boolean, is_phantom boolean"
#: The state store that transformWithState needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Admission(StatefulProcessor):
    """Of one simplified form: the URLs that have arrived, and whether the form itself is in field.

    The first URL of a form that is not in field is queued, and the form inserted as a checked phantom; all others that
    are new are inserted as checked.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.arrived = handle.getMapState("arrived", "url string", "page_id long")
        self.inserted = handle.getValueState("inserted", "known boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        form, known = key[0], self.inserted.exists()
        fresh: dict[str, tuple] = {}
        for batch in rows:
            known = known or bool(batch["known"].any())
            first = batch.sort_values(["page_id", "pos"]).drop_duplicates("url")
            for url, host, page, pos in zip(first["url"], first["host_id"], first["page_id"], first["pos"], strict=True):
                mine = (int(page), int(pos), int(host))
                if url not in fresh or mine < fresh[url]:
                    fresh[url] = mine
        known_before = known
        fresh = {u: x for u, x in fresh.items() if not self.arrived.containsKey((u,)) and not (u == form and known)}
        if not fresh:
            return
        winner = None if known_before else min(fresh, key=lambda u: (fresh[u][:2], u))
        out = []
        for url, (page, pos, host) in fresh.items():
            if url == form and url != winner:
                continue  # the winner's phantom stands for it
            self.arrived.updateValue((url,), (page,))
            out.append((url, host, page, pos, url == winner, url != winner, False))
        if winner is not None:
            self.inserted.update((True,))
            if winner != form:
                page, pos, host = fresh[winner]
                out.append((form, host, page, pos, False, True, True))
        yield pd.DataFrame(out, columns=["url", "host_id", "page_id", "pos", "enqueue", "checked", "is_phantom"])

    def close(self) -> None:
        pass


def admission_rows(found: DataFrame, field: DataFrame, blacklist: list[str] | None = None, options: Options = Options()) -> DataFrame:
    """The new rows of field (url, host_id, page_id, pos, enqueue, checked, is_phantom) that a stream of classified links
    (clean_url, host_id, skip_reason, page_id, pos) makes, given what field (url) holds at its start.

    Keyed by simplified form; batches must come in order of pages for the result to be that of frontier.admit(). A
    phantom stands also for its form's own later arrival. Needs RocksDB as state store (see stateful()).
    """
    ok = found.filter("host_id is not null and clean_url is not null and skip_reason is null")
    form = urls.simplify(F.col("url"), blacklist or []) if options.comp_param else F.col("url")
    rows = ok.select(F.col("clean_url").alias("url"), "host_id", F.col("page_id").cast("long").alias("page_id"), F.col("pos").cast("int").alias("pos")).withColumn("form", form)
    rows = rows.join(field.select("url").distinct(), "url", "left_anti")
    known = field.select(F.col("url").alias("form"), F.lit(True).alias("_in")).distinct()
    rows = rows.join(known, "form", "left").withColumn("known", F.col("_in").isNotNull()).drop("_in")
    ship(found.sparkSession)
    register_pickle_by_value(sys.modules[__name__])  # the driver's own worker, that asks for the state's schema, gets no files
    return rows.groupBy("form").transformWithStateInPandas(Admission(), ADMITTED, "Append", "None")


class stateful:
    """While inside, the session keeps streaming state in RocksDB, and plans batches without data only if empty_batches."""

    def __init__(self, spark: SparkSession, empty_batches: bool = False):
        self.conf = spark.conf
        self.wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": str(empty_batches).lower()}

    def __enter__(self) -> stateful:
        self.before = {k: self.conf.get(k, None) for k in self.wanted}
        for k, v in self.wanted.items():
            self.conf.set(k, v)
        return self

    def __exit__(self, *_) -> None:
        for k, v in self.before.items():
            self.conf.unset(k) if v is None else self.conf.set(k, v)


class Crawl:
    """The state of a crawl under a folder, that pages are parsed into batch by batch: field, download_queue, the counters
    of novelty, and how many pages each batch parsed.

    Each batch reads what the batches before it wrote and replaces what it wrote itself, so one that runs again after a
    failure, even when later ones are there, leaves the tables as they are.
    """

    def __init__(self, spark: SparkSession, path: str, tops: DataFrame, blacklist: list[str] | None = None, options: Options = Options(), page_limit: int | None = None):
        self.spark, self.tops, self.blacklist, self.options, self.page_limit = spark, tops, blacklist or [], options, page_limit
        self.field = BatchTable(spark, f"{path}/field", "url string, checked boolean, is_phantom boolean")
        self.queue = BatchTable(spark, f"{path}/queue", "url string, host_id long, page_id long, pos int, priority long")
        self.prefixes = Ledger(spark, f"{path}/prefixes", "prefix long, i int, n long", ["prefix", "i"])
        self.parsed = Ledger(spark, f"{path}/parsed", "what string, n long", ["what"])
        self.done = threading.Event()

    def pages_before(self, batch: int | None = None) -> int:
        row = self.parsed.before(batch).first()
        return row.n if row else 0

    def parse(self, pages: DataFrame, batch: int) -> None:
        """Parse a batch of pages (page_id, url, html), the least ids first if the page limit is near."""
        if self.page_limit is not None:
            pages = pages.orderBy("page_id").limit(max(0, self.page_limit - self.pages_before(batch)))
        found = frontier.classify(links.extract(pages), self.tops, self.options)
        admitted, new = frontier.admit(found, self.field.before(batch), self.blacklist, self.options)
        ranked = frontier.novelty(admitted, earlier=self.prefixes.before(batch))
        self.queue.write(batch, ranked.select("url", F.col("host_id").cast("long").alias("host_id"), F.col("page_id").cast("long").alias("page_id"), F.col("pos").cast("int").alias("pos"), "priority"))
        self.prefixes.write(batch, frontier.prefix_counts(admitted).select("prefix", F.col("i").cast("int").alias("i"), "n"))
        self.field.write(batch, new)
        self.parsed.write(batch, pages.agg(F.lit("pages").alias("what"), F.count("*").alias("n")))
        if self.page_limit is not None and self.pages_before() >= self.page_limit:
            self.done.set()

    def start(self, pages: DataFrame, checkpoint: str, seconds: float | None = None, locality: DataFrame | None = None, instance_id: int | None = None) -> StreamingQuery:
        """Start parsing a stream of pages: what is there and then stop, or, with seconds, every so often until stopped.

        With an instance only pages of its locality (url_id, instance_id) are parsed: each instance has a query, a
        checkpoint and a Crawl of its own.
        """
        if locality is not None and instance_id is not None:
            pages = pages.join(locality.filter(F.col("instance_id") == instance_id).select(F.col("url_id").alias("page_id")).distinct(), "page_id", "left_semi")
        writer = pages.writeStream.foreachBatch(self.parse).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()

    def run(self, pages: DataFrame, checkpoint: str, seconds: float | None = None, timeout: float | None = None, **only) -> None:
        """start(), and wait until the stream ends, the page limit is reached, or the timeout has passed."""
        query = self.start(pages, checkpoint, seconds, **only)
        waited = 0.0
        while not query.awaitTermination(1) and not self.done.is_set():
            waited += 1
            if timeout is not None and waited >= timeout:
                break
        query.stop()
