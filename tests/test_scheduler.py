import random
import time

import pytest

from gossamr.operators import frontier
from gossamr.streaming import crawl, scheduler
from gossamr.streaming import frontier as streams

SCHEMA = "host_id long, second long, url_id long, priority long, until long"


def one_by_one(events):
    """Releases by reading events in turn."""
    held, waiting, out = {}, {}, []

    def flush(host, now):
        if host in held and held[host] < now:
            end = held.pop(host)
            out.extend((host, u, p, end + 1) for p, u in waiting.pop(host, []))

    for host, second, url, priority, until in sorted(events, key=lambda e: (e[1], e[2] is not None, e[3] or 0, e[2] or 0)):
        flush(host, second)
        if url is None:
            if until >= second:
                held[host] = max(until, held.get(host, 0))
        elif host in held:
            waiting.setdefault(host, []).append((priority, url))
        else:
            out.append((host, url, priority, second))
    for host in list(held):
        flush(host, 1 << 60)
    return sorted(out)


def made_up(rng, n):
    events = []
    for i in range(n):
        second = 1000 + i // 4
        if rng.random() < 0.3:
            events.append((rng.randint(1, 4), second, None, None, second + rng.randint(-3, 25)))
        else:
            events.append((rng.randint(1, 4), second, i, rng.randint(0, 3), None))
    return events


@pytest.mark.parametrize("seed", range(3))
def test_releases_equal_events_in_turn(spark, seed):
    events = made_up(random.Random(seed), 300)
    df = spark.createDataFrame([*events, (None, 5, 1, 1, None), (1, None, 2, 2, None), (1, 5, None, None, None)], SCHEMA).repartition(3)
    assert sorted(map(tuple, frontier.releases(df).collect())) == one_by_one(events)


def test_releases_over_many_chunks_of_seconds(spark):
    events = [(h, 37 * (s - 1000), u, p, until and 37 * (s - 1000) + 40 * (until - s)) for h, s, u, p, until in made_up(random.Random(9), 400)]
    df = spark.createDataFrame([*events, (1, 5, None, None, 2000), (1, 5, None, None, 1000)], SCHEMA).repartition(3)
    held = sorted([*events, (1, 5, None, None, 2000)], key=lambda e: (e[1], e[2] is not None))
    assert sorted(map(tuple, frontier.releases(df).collect())) == one_by_one(held)


@pytest.mark.parametrize("seed", range(2))
def test_stream_releases_what_a_batch_does(spark, tmp_path, seed):
    """Three batches of events, and one far later, whose watermark lets all timers end."""
    events = made_up(random.Random(10 + seed), 150)
    parts = [events[:47], events[47:100], events[100:], [(9, 1_000_000, -1, 0, None)]]
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with crawl.stateful(spark, empty_batches=True):
        scheduler.release_stream(source).writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = sorted(map(tuple, spark.read.schema(scheduler.RELEASED).parquet(str(tmp_path / "out")).collect()))
    assert got == one_by_one([*events, (9, 1_000_000, -1, 0, None)])


class Counting:
    """A state variable that counts how often it is asked."""

    def __init__(self, calls):
        self.calls, self.value = calls, []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            if name in ("update", "appendList"):
                self.value = [args[0]] if name == "update" else self.value + args[0]
            if name == "clear":
                self.value = []
            return {"exists": bool(self.value), "get": (self.value[0] if self is self.one else iter(self.value)) if self.value else iter([])}.get(name)

        return call


def test_state_is_asked_once_a_batch_not_once_an_event():
    """Two batches of 2,000 events of one host, whose hold goes on from one to the other."""
    import pandas as pd

    calls = []
    until, waiting = Counting(calls), Counting(calls)
    until.one, waiting.one = until, until
    handle = type("Handle", (), {"getValueState": lambda *_: until, "getListState": lambda *_: waiting, "getMapState": lambda *_: waiting, "registerTimer": lambda *_: None})()
    work = scheduler.Scheduler()
    work.init(handle)
    out = []
    for part in (0, 1):
        rows = [(1000 + part, i > 0, part * 2000 + i, i % 3, 1500) for i in range(2000)]
        for frame in work.handleInputRows((1, 0), iter([pd.DataFrame(rows, columns=["second", "is_url", "url_id", "priority", "until"])]), None):
            out.append(frame)
    assert sum(map(len, out)) == 0 and len(calls) < 20
    last = pd.concat(work.handleInputRows((1, 0), iter([pd.DataFrame([(1501, True, 9999, 0, 0)], columns=["second", "is_url", "url_id", "priority", "until"])]), None))
    assert len(last) == 3999 and set(last["released"]) == {1501} and not until.value and not waiting.value
