import random
import re
import time

import pytest

import spec
from gossamr.operators import frontier
from gossamr.sources.options import Options
from gossamr.streaming import crawl
from gossamr.streaming import frontier as streams
from gossamr.streaming.batches import BatchTable, Ledger

FOUND = "page_id long, pos int, clean_url string, host_id long, skip_reason string"


def _urls(rng, n):
    return [f"http://h{rng.randint(0, 2)}.org/" + "/".join(rng.choice("abc") for _ in range(rng.randint(0, 2))) + rng.choice(["", "", "?" + "&".join(f"{rng.choice(['p', 'q'])}={rng.choice(['1', '2', ''])}" for _ in range(rng.randint(1, 3)))]) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_novelty_goes_on_from_earlier_rounds(spark, seed):
    rng = random.Random(seed)
    urls = list(dict.fromkeys(_urls(rng, 70)))
    want, counts, got = spec.novelty(urls, lambda u: re.split("[:/.?&=,;]", u)), None, []
    cuts = sorted(rng.sample(range(len(urls)), 2))
    for a, b in zip([0, *cuts], [*cuts, len(urls)], strict=True):
        own = spark.createDataFrame([(i, 0, urls[i]) for i in range(a, b)], "page_id long, pos int, url string")
        got += [r.priority for r in frontier.novelty(own, earlier=counts).orderBy("page_id").collect()]
        mine = frontier.prefix_counts(own)
        counts = mine if counts is None else counts.unionByName(mine).groupBy("prefix", "i").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_keyed_admission_equals_the_sequential_rules(spark, tmp_path, seed):
    rng = random.Random(seed)
    arrivals = _urls(rng, 60)
    known = set(_urls(rng, 8))
    for k in range(3):
        rows = [(i, 0, u, 1, None) for i, u in enumerate(arrivals) if i // 20 == k] + [(100 + k, 1, "http://x.org/", None, None), (100 + k, 2, "http://x.org/a", 1, "blacklisted")]
        spark.createDataFrame(rows, FOUND).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    source = spark.readStream.schema(FOUND).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = crawl.admission_rows(source, spark.createDataFrame([(u,) for u in known], "url string"), ["p=1"])
    with crawl.stateful(spark):
        streams.run_available(out, str(tmp_path / "out"), str(tmp_path / "state"))
    rows = spark.read.schema(crawl.ADMITTED).parquet(str(tmp_path / "out")).collect()
    queue, after = spec.admission(arrivals, known, ["p=1"])
    assert [r.url for r in sorted((r for r in rows if r.enqueue), key=lambda r: r.page_id)] == queue
    assert {r.url: r.checked for r in rows} == {u: c for u, c in after.items() if c is not None} and len({r.url for r in rows}) == len(rows)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != crawl.ROCKSDB


def _pages(spark, n=12):
    rng = random.Random(n)
    return [(i, f"http://h.org/p{i}", "".join(f'<a href="/{rng.choice("abc")}/{rng.choice("de")}{rng.choice(["", "?q=1", "?q=1&r=2", "?r=2&q=1"])}">x</a>' for _ in range(5))) for i in range(n)]


SCHEMA = "page_id long, url string, html string"


def _state(c):
    return {name: sorted(map(tuple, t.before().collect()), key=repr) for name, t in (("queue", c.queue), ("field", c.field), ("prefixes", c.prefixes), ("parsed", c.parsed))}


def _folder(spark, path, pages, files):
    for k in range(files):
        spark.createDataFrame(pages[k * len(pages) // files : (k + 1) * len(pages) // files], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return streams.pages_stream(spark, path, SCHEMA, 1)


def test_batches_of_a_crawl_equal_one(spark, tmp_path):
    tops = spark.createDataFrame([(1, "h.org")], "id long, hostname string")
    pages = _pages(spark)
    one = crawl.Crawl(spark, str(tmp_path / "one"), tops)
    one.parse(spark.createDataFrame(pages, SCHEMA), 0)
    many = crawl.Crawl(spark, str(tmp_path / "many"), tops)
    many.run(_folder(spark, str(tmp_path / "in"), pages, 3), str(tmp_path / "state"))
    assert many.field.batches() == [0, 1, 2]
    a, b = _state(one), _state(many)
    assert a["queue"] == b["queue"] and a["prefixes"] == b["prefixes"] and a["parsed"] == b["parsed"] == [("pages", 12)]
    assert {(u, c) for u, c, _ in a["field"]} == {(u, c) for u, c, _ in b["field"]}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    tops = spark.createDataFrame([(1, "h.org")], "id long, hostname string")
    pages = _pages(spark, 20)
    c = crawl.Crawl(spark, str(tmp_path / "c"), tops)
    parts = [spark.createDataFrame(pages[k * 5 : k * 5 + 5], SCHEMA) for k in range(4)]
    for k, part in enumerate(parts):
        c.parse(part, k)
    before = _state(c)
    for k in (1, 3, 0, 2):
        c.parse(parts[k], k)
        assert _state(c) == before


def test_page_limit_is_exact_and_stops_the_run(spark, tmp_path):
    tops = spark.createDataFrame([(1, "h.org")], "id long, hostname string")
    c = crawl.Crawl(spark, str(tmp_path / "c"), tops, page_limit=7)
    c.run(_folder(spark, str(tmp_path / "in"), _pages(spark), 4), str(tmp_path / "state"), seconds=0.5, timeout=60)
    assert c.done.is_set() and c.pages_before() == 7
    assert max(r.page_id for r in c.queue.before().collect()) <= 6


def test_each_instance_parses_its_own_pages(spark, tmp_path):
    tops = spark.createDataFrame([(1, "h.org")], "id long, hostname string")
    locality = spark.createDataFrame([(i, 1 + i % 2) for i in range(12)], "url_id long, instance_id long")
    stream = _folder(spark, str(tmp_path / "in"), _pages(spark), 2)
    for instance in (1, 2):
        c = crawl.Crawl(spark, str(tmp_path / f"c{instance}"), tops)
        c.run(stream, str(tmp_path / f"s{instance}"), locality=locality, instance_id=instance)
        assert c.pages_before() == 6 and {r.page_id % 2 for r in c.queue.before().collect()} == {instance - 1}


def test_tables_by_batch(spark, tmp_path):
    t = BatchTable(spark, str(tmp_path / "t"), "x long")
    assert t.before().collect() == [] and t.batches() == []
    for b, xs in ((0, [1, 2]), (1, [3]), (1, [4])):
        t.write(b, spark.createDataFrame([(x,) for x in xs], "x long"))
    assert sorted(r.x for r in t.before().collect()) == [1, 2, 4] and sorted(r.x for r in t.before(1).collect()) == [1, 2]
    ledger = Ledger(spark, str(tmp_path / "l"), "k string, n long", ["k"], every=2)
    for b in range(5):
        ledger.write(b, spark.createDataFrame([("a", b), ("b", 1)], "k string, n long"))
    assert ledger._sums() == [1, 3]
    for b in range(6):
        assert {r.k: r.n for r in ledger.before(b).collect()} == ({"a": sum(range(b)), "b": b} if b else {})


def test_options_reach_the_crawl(spark, tmp_path):
    tops = spark.createDataFrame([(1, "h.org")], "id long, hostname string")
    c = crawl.Crawl(spark, str(tmp_path / "c"), tops, options=Options(comp_param=False, url_blacklist_rx="/b/"))
    c.parse(spark.createDataFrame(_pages(spark), SCHEMA), 0)
    found = {r.url for r in c.queue.before().collect()}
    assert found and not any("/b/" in u for u in found) and {u for u in found if u.endswith("?r=2&q=1")}
