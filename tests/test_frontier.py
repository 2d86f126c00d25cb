import random
import re

from pyspark.sql import functions as F

import spec
from gossamr.operators import frontier
from gossamr.sources.options import Options


def _random_urls(rng, n):
    return [f"http://h{rng.randint(0, 2)}.org/" + "/".join(rng.choice("abc") for _ in range(rng.randint(0, 2))) + rng.choice(["", "", "?" + "&".join(f"{rng.choice(['p', 'q', 'r+s'])}={rng.choice(['1', '2', ''])}" for _ in range(rng.randint(1, 3)))]) for _ in range(n)]


def test_admission_and_novelty_equal_the_sequential_rules(spark):
    for seed in range(6):
        rng = random.Random(seed)
        arrivals = _random_urls(rng, 60)
        known = _random_urls(rng, 8)
        rows = [(i // 10, i % 10, u, 1, None) for i, u in enumerate(arrivals)]
        links = spark.createDataFrame(rows, "page_id long, pos int, clean_url string, host_id long, skip_reason string")
        field = spark.createDataFrame([(u,) for u in set(known)], "url string")
        admitted, delta = frontier.admit(links, field, ["p=1"])
        queue, after = spec.admission(arrivals, set(known), ["p=1"])
        ranked = frontier.novelty(admitted).orderBy("page_id", "pos").collect()
        assert [r.url for r in ranked] == queue
        assert {r.url: r.checked for r in delta.collect()} == {u: c for u, c in after.items() if c is not None}
        assert [r.priority for r in ranked] == spec.novelty(queue, lambda u: re.split("[:/.?&=,;]", u))


def test_admission_without_simplification(spark):
    links = spark.createDataFrame([(0, 0, "http://a/?q=1", 1, None), (0, 1, "http://a/?q=1&r=", 1, None), (0, 2, "http://b/", None, None), (0, 3, "http://a/x.png", 1, "blacklisted")], "page_id long, pos int, clean_url string, host_id long, skip_reason string")
    admitted, delta = frontier.admit(links, spark.createDataFrame([], "url string"), options=Options(comp_param=False))
    assert {r.url for r in admitted.collect()} == {"http://a/?q=1", "http://a/?q=1&r="}
    assert not any(r.checked for r in delta.collect())


def test_skip_reasons_come_in_order(spark):
    o = Options(url_whitelist_rx="ok", max_url_len=20)
    df = spark.createDataFrame([("http://ok/x.PNG",), ("http://no/x.png",), ("http://ok/" + "a" * 10,), ("http://ok/" + "a" * 11,)], "u string")
    assert [r[0] for r in df.select(frontier.skip_reason(F.col("u"), o)).collect()] == ["blacklisted", "not whitelisted", None, "too long"]


def test_hosts_largest_id_wins_and_instances_restrict(spark):
    tops = spark.createDataFrame([(1, "a.x.org"), (2, "b.x.org"), (3, "c.y.org")], "id long, hostname string")
    assert {r.canonical: r.host_id for r in frontier.whitelist(tops, True).collect()} == {"x.org": 2, "y.org": 3}
    inst = spark.createDataFrame([(1, 7), (3, 8)], "host_id long, instance_id long")
    assert {r.host_id for r in frontier.whitelist(tops, True, inst, 7).collect()} == {1}
    links = spark.createDataFrame([("http://z.x.org/",), ("mailto:a@x.org",), (None,)], "link string")
    assert [r.host_id for r in frontier.check_hosts(links, tops, True).orderBy(F.col("link").desc_nulls_last()).collect()] == [None, 2, None]


def test_holds(spark):
    rows = [(1, 503, "5"), (1, 503, "30"), (1, 503, "10"), (2, 429, None), (3, 503, "1000"), (4, 503, "Wed, 21 Oct"), (5, 200, "9"), (None, 503, "9"), (6, 503, None)]
    df = spark.createDataFrame(rows, "host_id long, code int, retry_after string")
    assert {r.host_id: r.until for r in frontier.holds(df, 100, 7).collect()} == {1: 130, 2: 107}
    queue = spark.createDataFrame([(1, 0, 1), (2, 0, 2)], "url_id long, priority long, host_id long")
    held = frontier.holds(df, 100, 7)
    assert {r.url_id for r in frontier.available(queue, held, 107).collect()} == set()
    assert {r.url_id for r in frontier.available(queue, held, 108).collect()} == {2}


def test_schedule_takes_hosts_in_turn(spark):
    queue = spark.createDataFrame([(1, 5, 1), (2, 1, 1), (3, 9, 2), (4, 0, 3), (5, 0, 3)], "url_id long, priority long, host_id long")
    none = spark.createDataFrame([], "host_id long, until long")
    assert [r.url_id for r in frontier.download_pop(queue, none, 0, 4).collect()] == [2, 3, 4, 1]


def test_seeds_and_redirects(spark):
    seeds = spark.createDataFrame([("http://A.org/x?",), ("b.org",), ("httpbin.org",)], "seed string")
    assert {(r.hostname, r.url) for r in frontier.seed_hosts(seeds, ("http", "https")).collect()} == {("a.org", "http://A.org/x"), ("b.org", "http://b.org"), ("b.org", "https://b.org"), ("httpbin.org", "http://httpbin.org"), ("httpbin.org", "https://httpbin.org")}
    field = spark.createDataFrame([(1, "http://a.org/x y")], "id long, url string")
    seen, new = frontier.register_redirects(field, spark.createDataFrame([(9, "http://a.org:80/x y#f"), (9, "http://a.org/z")], "from_id long, url string"))
    assert {(r.target, r.known) for r in seen.collect()} == {("http://a.org/x y", True), ("http://a.org/z", False)}
    assert [r.url for r in new.collect()] == ["http://a.org/z"]


def test_healthcheck_can_be_off(spark):
    field = spark.createDataFrame([(i, i) for i in range(10)], "id long, checkd long")
    errors = spark.createDataFrame([(i,) for i in range(5, 10)], "url_id long")
    assert frontier.healthcheck(field, errors, 5, 5).first().asDict() == {"err_count": 5, "failed": True}
    assert frontier.healthcheck(field, errors, 5, 0).first().failed is False
    assert frontier.healthcheck(field, errors, 0, 5).first().err_count == 0


def test_seeding_writes_its_new_rows_once(spark):
    """New hosts and URLs are read by several tables of the state, and numbered once."""
    empty = lambda schema: spark.createDataFrame([], schema)
    state = {"tops": empty("id long, hostname string"), "field": empty("id long, url string, checkd int"), "nodes": empty("url_id long, depth int"), "download_queue": empty("url_id long, priority long, host_id long")}
    out = frontier.seed(spark.createDataFrame([("http://a.org/x",), ("http://b.org/",)], "seed string"), state)
    assert any("seed-urls" in x for x in out["field"].inputFiles()) and any("seed-hosts" in x for x in out["tops"].inputFiles())
    assert {r.url for r in out["field"].collect()} == {"http://a.org/x", "http://b.org/"} and out["download_queue"].count() == 2
