"""The scheduler as a stream: each host's waiting URLs as state, released when its hold ends."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gossamr.session import ship

RELEASED = "host_id long, url_id long, priority long, released long"
#: Waiting URLs that are kept or released at a time.
CHUNK = 10_000
#: Shares of a host: each has all its holds, and the URLs whose hash is dealt to it.
SHARES = 8
NEVER = -(1 << 62)


class Scheduler(StatefulProcessor):
    """Of one share of a host: the second until which it is held, and the URLs that wait for it.

    A URL is released when it comes, unless the host is held; then in the second after the hold, which later responses
    may have made longer. What waits is released by the first event after that second, or by a timer, whichever is first.
    The events of a batch are scanned as arrays, so that state is read and written once for each batch, not for each event.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "second long")
        self.waiting = handle.getListState("waiting", "urls binary")  # pairs of priority and url_id

    def _taken(self) -> np.ndarray:
        """What waits, which then does no more."""
        parts = [np.frombuffer(urls, "<i8").reshape(-1, 2) for (urls,) in self.waiting.get()]
        self.waiting.clear()
        return np.concatenate([np.empty((0, 2), "<i8"), *parts])

    @staticmethod
    def _frames(host: int, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = rows.sort_values(["released", "priority", "url_id"]).assign(host_id=host)[["host_id", "url_id", "priority", "released"]]
        for at in range(0, len(rows), CHUNK):
            yield rows.iloc[at : at + CHUNK]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows))
        second, is_url, url, priority, until = (events[c].to_numpy() for c in ("second", "is_url", "url_id", "priority", "until"))
        known = self.until.exists()
        # the holds in turn: the end of all so far; one that begins after it starts a new stretch, number 0 is the known one
        holds = np.flatnonzero(~is_url & (until >= second))
        holds = holds[np.argsort(second[holds], kind="stable")]
        begins = second[holds]
        ends = np.maximum.accumulate(np.concatenate([[self.until.get()[0] if known else NEVER], until[holds]]))
        stretch = np.concatenate([[0], np.cumsum(ends[:-1] < begins)])
        last = ends[np.append(np.flatnonzero(np.diff(stretch)), len(stretch) - 1)]
        over = len(last) - int(ends[-1] >= second.max())  # number of stretches that have ended
        second, url, priority = second[is_url], url[is_url], priority[is_url]
        before = np.searchsorted(begins, second, side="right")
        of = np.where(ends[before] >= second, stretch[before], -1)
        if known and over:
            old = self._taken()
            priority, url = np.concatenate([priority, old[:, 0]]), np.concatenate([url, old[:, 1]])
            second, of = np.concatenate([second, np.zeros(len(old), "<i8")]), np.concatenate([of, np.zeros(len(old), of.dtype)])
        free = of < over
        out = pd.DataFrame({"url_id": url, "priority": priority, "released": np.where(of < 0, second, last[of] + 1), "waited": of >= 0})[free]
        yield from self._frames(int(key[0]), out[~(out["waited"] & out.duplicated())])
        stay = np.column_stack([priority, url])[~free].astype("<i8")
        if len(stay):
            self.waiting.appendList([(stay[at : at + CHUNK].tobytes(),) for at in range(0, len(stay), CHUNK)])
        if over < len(last):
            self.until.update((int(ends[-1]),))
            self.handle.registerTimer((int(ends[-1]) + 1) * 1000)
        elif known:
            self.until.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.until.exists() or self.until.get()[0] >= expiredTimerInfo.getExpiryTimeInMs() // 1000:
            return
        (until,) = self.until.get()
        self.until.clear()
        out = pd.DataFrame(np.unique(self._taken(), axis=0), columns=["priority", "url_id"])
        yield from self._frames(int(key[0]), out.assign(released=until + 1))

    def close(self) -> None:
        pass


def release_stream(events: DataFrame, late: str = "0 seconds", shares: int = SHARES) -> DataFrame:
    """(host_id, url_id, priority, released: second) of a stream of events (host_id, second, url_id, priority, until).

    An event with a url_id queues it, at its second; one without holds its host until a second, that included. Of one
    second holds come first. Of a second's releases URLs go by priority, then id, in each share of a host. Events must not
    come later than `late` after others; a URL of a host and priority that waits twice is released once. A host's URLs are
    dealt to shares by their hash, and each share gets all its holds, so that no task has a whole host. Needs RocksDB
    (crawl.stateful).
    """
    rows = events.filter("host_id is not null and second is not null and (url_id is not null or until is not null)")
    rows = rows.select("host_id", F.col("second").cast("long").alias("second"), F.col("url_id").isNotNull().alias("is_url"), F.coalesce("url_id", F.lit(0)).cast("long").alias("url_id"), F.coalesce("priority", F.lit(0)).cast("long").alias("priority"), F.coalesce("until", F.lit(0)).cast("long").alias("until"))
    dealt = F.when(F.col("is_url"), F.array(F.pmod(F.xxhash64("url_id"), F.lit(shares)).cast("int"))).otherwise(F.sequence(F.lit(0), F.lit(shares - 1)))
    rows = rows.withColumn("share", F.explode(dealt)).withColumn("at", F.timestamp_seconds("second")).withWatermark("at", late)
    ship(events.sparkSession)
    register_pickle_by_value(sys.modules[__name__])  # the driver's own worker, that asks for the state's schema, gets no files
    return rows.groupBy("host_id", "share").transformWithStateInPandas(Scheduler(), RELEASED, "Append", "EventTime")
