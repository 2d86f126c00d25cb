import io
import random
import re
import zipfile

import pytest

import spec
from gossamr.operators import store, tables
from gossamr.sources import headers, schemas, volumes
from gossamr.sources.links import extract, extract_html
from gossamr.sources.options import Options
from pyspark.sql import functions as F


@pytest.mark.parametrize(("threshold", "most", "step"), [(200, 60, 1), (5000, 60, 1), (30, 60, 977), (0, 3, 1 << 40), (10, 0, 1)])
def test_pack_is_the_sequential_cut(spark, threshold, most, step):
    """Small and large volumes, volumes of one page, runs of empty pages, far ids; nulls count as empty."""
    rng = random.Random(threshold)
    sizes = [0 if rng.random() < 0.2 else rng.randint(0, most) for _ in range(1500)]
    rows = [(i * step - 700, None if x == 0 and i % 2 else x) for i, x in enumerate(sizes)]
    got = sorted((r.url_id, r.volume_id) for r in store.pack(spark.createDataFrame(rows, "url_id long, siz long"), threshold).collect())
    assert [v for _, v in got] == spec.volumes(sizes, threshold)


def test_pack_of_nothing_and_without_tasks_for_whole_groups(spark):
    df = spark.createDataFrame([(i, 10) for i in range(5000)], "url_id long, siz long")
    assert store.pack(df.limit(0), 200).count() == 0
    plan = store.pack(df, 200)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    # one task has the top of a scan, whose rows are chunks: at most 1,024
    assert all("Sort [_chunk" in plan[m.start() - 150 : m.start()] for m in re.finditer("SinglePartition", plan))


def test_purged_edge_sets_equal_one_at_a_time(spark):
    for seed in range(5):
        rng = random.Random(seed)
        sets = {}
        for i in range(12):
            sets.setdefault(tuple(sorted(rng.sample(range(20, 26), rng.randint(1, 3)))), set()).add(i)
        ids = rng.sample([*range(12), *range(20, 26)], 4)
        df = spark.createDataFrame([(sorted(v), list(k)) for k, v in sets.items()], schemas.TABLES["edge_sets"])
        got = store.purge_edge_sets(df, spark.createDataFrame([(i,) for i in ids], "id long"))
        assert {tuple(r.to_set): r.from_set for r in got.collect()} == spec.purge_sets(sets, ids)


def test_rows_without_a_purged_id_are_left_alone(spark):
    """They are neither taken apart nor grouped: their arrays keep an order that grouping would not."""
    rows = [([2, 1], [30, 29]), ([4, 3], [31, 30]), ([6], [32, 31, 30]), ([8, 7], [33])]
    df = spark.createDataFrame(rows, schemas.TABLES["edge_sets"])
    got = {tuple(r.to_set): r.from_set for r in store.purge_edge_sets(df, spark.createDataFrame([(32,), (1_000,)], "id long"), store.edge_set_postings(df)).collect()}
    assert got == {(30, 29): [2, 1], (31, 30): [4, 3], (30, 31): [6], (33,): [8, 7]}
    df = spark.createDataFrame([(sorted(a), sorted(b)) for a, b in rows], schemas.TABLES["edge_sets"])
    got = {tuple(r.to_set): r.from_set for r in store.purge_edge_sets(df, spark.createDataFrame([(32,), (7,), (8,)], "id long")).collect()}
    assert got == {(29, 30): [1, 2], (30, 31): [3, 4, 6]}


def test_purge_of_volumes(spark):
    state = {"content": spark.createDataFrame([(1, 5), (2, 6), (3, 6)], "url_id long, volume_id long"), "volume_loc": spark.createDataFrame([(5, 1), (6, 1)], "volume_id long, instance_id long"), "nodes": spark.createDataFrame([(1, 0), (2, 1)], "url_id long, depth int")}
    out = store.purge(state, spark.createDataFrame([(1,)], "id long"))
    assert [r.volume_id for r in out["volume_loc"].collect()] == [6] and out["content"].count() == 2 and out["nodes"].count() == 1


def test_archives_are_zip_files_of_any_reader(spark):
    """Members in order, empty and long ones, many volumes in a task; a reader of its own checks sizes and checksums."""
    rng = random.Random(3)
    rows = [(v, u, k, rng.randbytes(rng.choice([0, 10, 70_000])) + b"a" * rng.choice([0, 200_000])) for v in (3, 4, 9) for u in rng.sample(range(50), 8) for k in ("", "h")]
    archives = volumes.zip_volumes(spark.createDataFrame([*rows, (11, 5, "", None)], "volume_id int, url_id long, kind string, body binary").repartition(3)).collect()
    assert sorted(r.volume_id for r in archives) == [3, 4, 9, 11]
    for r in archives:
        with zipfile.ZipFile(io.BytesIO(r.archive)) as z:
            own = sorted((u, k, b) for v, u, k, b in rows if v == r.volume_id) or [(5, "", b"")]
            assert z.testzip() is None and [(i.filename, z.read(i)) for i in z.infolist()] == [(f"{u}{k}", b) for u, k, b in own]
    df = spark.createDataFrame(archives)
    assert sorted((r.volume_id, r.url_id, r.kind, bytes(r.body), r.siz) for r in volumes.members_of(df).collect() if r.volume_id < 11) == sorted((v, u, k, b, len(b)) for v, u, k, b in rows)
    assert volumes.zip_volumes(spark.createDataFrame([], "volume_id long, url_id long, kind string, body binary")).count() == 0


def test_purge_of_tables_and_archives_in_one_call(spark):
    content = spark.createDataFrame([(1, 5), (2, 6), (3, 6)], "url_id long, volume_id long")
    state = {"content": content, "directory": spark.createDataFrame([(5, 1), (6, 1), (7, None)], "id long, written long"), "volume_loc": spark.createDataFrame([(5, 1), (6, 1)], "volume_id long, instance_id long"), "field": spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, url string")}
    archives = volumes.zip_volumes(content.selectExpr("volume_id", "url_id", "'' AS kind", "encode(concat('body ', url_id), 'utf-8') AS body"))
    out, left = store.purge_all(state, archives, spark.createDataFrame([(1,), (3,)], "id long"))
    assert [(r.volume_id, r.url_id, bytes(r.body)) for r in volumes.members_of(left).collect()] == [(6, 2, b"body 2")]
    assert sorted(r.id for r in out["directory"].collect()) == [6, 7] and [r.volume_id for r in out["volume_loc"].collect()] == [6] and [r.id for r in out["field"].collect()] == [2]


def test_ownership(spark):
    field = spark.createDataFrame([(i, None if i == 5 else 1) for i in range(1, 6)], "id long, checkd long")
    errors = spark.createDataFrame([(4,)], "url_id long")
    loc = spark.createDataFrame([(2, 7), (3, 8), (4, 7)], "url_id long, instance_id long")
    flags = lambda me: {r.id: (r.is_local, r.is_remote) for r in store.ownership(field, errors, loc, me).collect()}
    assert flags(None) == {1: (True, False), 2: (False, False), 3: (False, False), 4: (False, False), 5: (False, False)}
    assert flags(7) == {1: (False, False), 2: (True, False), 3: (False, True), 4: (False, False), 5: (False, False)}


def test_volumes_on_disk(spark, tmp_path):
    (tmp_path / "data").mkdir()
    with zipfile.ZipFile(tmp_path / "data" / "3.zip", "w") as z:
        z.writestr("12", b"body")
        z.writestr("12h", b"head")
    (tmp_path / "tmp" / "12").mkdir(parents=True)
    (tmp_path / "tmp" / "12" / "1012").write_bytes(b"loose")
    (tmp_path / "tmp" / "12" / "1012h").write_bytes(b"hd")
    assert {(r.volume_id, r.url_id, r.kind, bytes(r.body), r.siz) for r in volumes.read_volumes(spark, str(tmp_path)).collect()} == {(3, 12, "", b"body", 4), (3, 12, "h", b"head", 4)}
    assert {(r.url_id, r.kind, bytes(r.body), r.siz) for r in volumes.read_loose(spark, str(tmp_path)).collect()} == {(1012, "", b"loose", 5), (1012, "h", b"hd", 2)}


def test_headers(spark):
    raw = "HTTP/1.1 302 Found\r\nContent-Type: a/b\r\n\r\nHTTP/1.0 200 OK\r\ncontent-type:  Text/HTML; charset=x \r\nbroken line\r\nX: a:b\r\n"
    df = spark.createDataFrame([(raw, "HTTP/1.1 404 Not Found"), ("", "garbage here"), (None, None)], "raw string, line string")
    raw_, line = F.col("raw"), F.col("line")
    one, two, three = df.select(headers.annotated_content_type(raw_).alias("a"), headers.served_content_type(raw_).alias("s"), headers.last_value(raw_, "x").alias("x"), headers.last_status(raw_).alias("l"), headers.status(line).alias("t"), headers.acceptable(headers.annotated_content_type(raw_)).alias("ok")).collect()
    assert (one.a, one.s, one.x, one.l.code, one.l.phrase, one.t.code, one.t.phrase, one.ok) == ("Text/HTML; charset=x", "a/b", "a:b", 200, "OK", 404, "Not Found", True)
    assert (two.a, two.s, two.t.code, two.t.phrase) == (None, "text/plain", None, "garbage here")
    assert three.a is None and three.s == "text/plain"
    assert df.select(headers.acceptable(F.lit("image/x"), ("*",))).first()[0] is True


def test_links(spark):
    html = '<html><head><base href="/b/"></head><body><!-- <a href="/no">x</a> --><A HREF=\'y?a=1&amp;b=2\'>1</a><a name="q">2</a><a href="">3</a><p><a class=z href="//o.org/">4<a href=plain>5</body>'
    df = spark.createDataFrame([(1, "http://h.org/d/e", html), (2, "http://h.org/", None)], "page_id long, url string, html string")
    assert [(r.pos, r.link) for r in extract_html(df).orderBy("pos").collect()] == [(0, "http://h.org/d/y?a=1&b=2"), (1, "http://o.org/"), (2, "http://h.org/d/plain")]
    assert extract_html(df, honor_base=True).filter("pos = 2").first().link == "http://h.org/b/plain"
    assert [r.href for r in extract(df).orderBy("pos").collect()] == ["/no", "y?a=1&b=2", "//o.org/"]


def test_options():
    o = Options.from_ini("[root]\nmax_url_len=99\ncomp_param=no\ntrace_protocols=http ftp\nmatch_domain=yes\n")
    assert (o.max_url_len, o.comp_param, o.trace_protocols, o.match_domain, o.healthcheck_tail) == (99, False, ("http", "ftp"), True, 100)
    assert Options.from_ini("") == Options()


def test_table_changes(spark):
    t = spark.createDataFrame([(1, "a")], "k long, v string")
    rows = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], "k long, v string")
    assert {r.k for r in tables.insert_new(t, rows, "k").collect()} == {1, 2} and tables.insert_new(t, rows, "k").filter("k = 1").first().v == "a"
    assert {(r.k, r.v) for r in tables.upsert_latest(t, rows, [F.desc("v")], "k").collect()} == {(1, "b"), (2, "d")}
    assert schemas.empty(spark, "field").columns == ["id", "url", "checkd", "parsed"]


def test_alternative_representations_and_headers_are_read(spark, tmp_path):
    for name in ("tmp/s/alt/1/1001", "tmp/s/alt/1/1001h", "tmp/s/2/1002"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(name.encode())
    from gossamr.sources import volumes

    got = {(r.url_id, r.kind, bytes(r.body).decode()) for r in volumes.read_loose(spark, str(tmp_path), "s", "alt").collect()}
    assert got == {(1001, "", "tmp/s/alt/1/1001"), (1001, "h", "tmp/s/alt/1/1001h")}
    assert [r.url_id for r in volumes.read_loose(spark, str(tmp_path), "s").filter("kind = ''").collect()] == [1002]


def test_tables_of_a_crawl_schema_are_read(spark, tmp_path):
    from gossamr.sources import schemas

    schemas.empty(spark, "edges").union(spark.sql("SELECT 1L, 2L")).write.parquet(str(tmp_path / "s" / "edges"))
    assert [tuple(r) for r in schemas.scan(spark, str(tmp_path), "edges", "s").collect()] == [(1, 2)]


def test_instances_are_looked_up_by_name(spark):
    from gossamr.operators import tables

    table = spark.createDataFrame([(7, "a")], "id long, instance_name string")
    assert tables.instance_id(table, "a") == 7 and tables.instance_id(table, None) is None
    with pytest.raises(LookupError):
        tables.instance_id(table, "b")


def test_healthchecks_are_due_at_intervals():
    from gossamr.operators.frontier import healthcheck_due

    assert [n for n in range(1, 40) if healthcheck_due(n, 20, 10)] == [20, 30] and not healthcheck_due(100, 20, 0)


def test_postings_hash_a_row_once(spark, monkeypatch):
    """The hash of a row's sets is below the step that makes a row for each member."""
    monkeypatch.setattr(store, "bucketed", lambda rows, *_: rows)
    sets = spark.createDataFrame([([1, 2], [3]), ([4], [2, 5])], "from_set array<long>, to_set array<long>")
    found = store.edge_set_postings(sets)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Generate") < plan.find("xxhash64")
    assert sorted(r.member for r in found.collect()) == [1, 2, 2, 3, 4, 5] and found.select("row").distinct().count() == 2
