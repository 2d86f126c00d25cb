import random

import pytest
from pyspark.sql import functions as F

import spec
from gossamr.operators import graph, params
from gossamr.operators.components import components


def _graph(seed, n=25, m=45):
    rng = random.Random(seed)
    return sorted({(rng.randint(0, n), rng.randint(0, n)) for _ in range(m)})


def test_components(spark):
    for edges in (_graph(1), [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8)], []):
        df = spark.createDataFrame([*edges, (None, 3)], "from_id long, to_id long")
        for small in (0, 1000):
            assert {r.node: r.component for r in components(df, small=small).collect()} == spec.components(edges)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)]
    for small in (0, 1000):
        assert {r.component for r in components(spark.createDataFrame(edges, "from_id long, to_id long"), small=small).collect()} == {0}


@pytest.mark.parametrize("seed", range(3))
def test_depth_trace_yield(spark, seed):
    edges = _graph(seed)
    nodes = sorted({x for e in edges for x in e})
    roots = nodes[:2]
    df = spark.createDataFrame(edges, "from_id long, to_id long")
    start = spark.createDataFrame([(n, 0 if n in roots else None) for n in nodes], "url_id long, depth int")
    depths = graph.bfs(start, df)
    found = {r.url_id: r.depth for r in depths.collect()}
    assert found == spec.bfs(set(nodes), roots, edges)
    targets = [n for n, d in found.items() if d is not None and n % 2]
    got = graph.path_yield(start, df, depths, spark.createDataFrame([(t,) for t in targets], "url_id long"))
    want = spec.path_yield(nodes, edges, found, targets)
    assert {r.url_id: pytest.approx(r["yield"]) for r in got.collect()} == want


def _filled(nodes, given, edges):
    """Depths by levels, where nodes that have one keep it."""
    depth, level = dict(given), 0
    while level <= max(depth.values()):
        for a, b in edges:
            if depth.get(a) == level and b not in depth:
                depth[b] = level + 1
        level += 1
    return {n: depth.get(n) for n in nodes}


@pytest.mark.parametrize("seed", range(4))
def test_depths_that_are_there_are_kept(spark, seed):
    edges, rng = _graph(seed, 60, 110), random.Random(seed)
    nodes = sorted({x for e in edges for x in e})
    given = {nodes[0]: 0} | {n: rng.randint(0, 9) for n in rng.sample(nodes[1:], 8)}
    start = spark.createDataFrame([(n, given.get(n)) for n in nodes], "url_id long, depth int")
    got = {r.url_id: r.depth for r in graph.bfs(start, spark.createDataFrame(edges, "from_id long, to_id long")).collect()}
    assert got == _filled(nodes, given, edges)


def test_depths_of_a_first_run_are_those_of_a_second(spark):
    """Edges that came later reach further nodes, and change no depth."""
    edges = [(i, i + 1) for i in range(12)] + [(0, 20), (20, 21)]
    df = spark.createDataFrame(edges, "from_id long, to_id long")
    nodes = spark.createDataFrame([(i, 0 if i == 0 else None) for i in [*range(13), 20, 21, 30]], "url_id long, depth int")
    first = graph.bfs(nodes, df.filter("from_id <> 20"), max_depth=5)
    second = {r.url_id: r.depth for r in graph.bfs(first, df).collect()}
    assert second == {**{i: i for i in range(13)}, 20: 1, 21: 2, 30: None}


@pytest.mark.parametrize("block", [64, 128])
def test_yield_over_blocks_of_targets(spark, block):
    rng = random.Random(block)
    layers = [[0], range(1, 21), range(21, 81), range(81, 400)]
    edges = sorted({(rng.choice(above), n) for above, below in zip(layers, layers[1:]) for n in below for _ in range(3)})
    nodes = sorted({x for e in edges for x in e})
    found = spec.bfs(set(nodes), [0], edges)
    targets = [n for n, d in found.items() if d is not None]
    df = spark.createDataFrame(edges, "from_id long, to_id long")
    depths = spark.createDataFrame(list(found.items()), "url_id long, depth int")
    got = graph.path_yield(depths, df, depths, spark.createDataFrame([(t,) for t in [*targets, 10_000]], "url_id long"), block)
    assert len(targets) > 2 * block and {r.url_id: pytest.approx(r["yield"]) for r in got.collect()} == spec.path_yield(nodes, edges, found, targets)
    assert {r["yield"] for r in graph.path_yield(depths, df, depths, spark.createDataFrame([], "url_id long")).collect()} == {0.0}


def test_trace_reports_go_down_from_the_target(spark):
    edges = [(1, 2), (1, 3), (2, 4), (3, 4)]
    depths = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 2)], "url_id long, depth int")
    field = spark.createDataFrame([(1, "http://a/"), (2, "http://z/"), (3, "http://b/"), (4, "http://t/")], "id long, url string")
    traced = graph.trace(spark.createDataFrame([(4,)], "url_id long"), spark.createDataFrame(edges, "from_id long, to_id long"), depths)
    assert [(r.depth, r.url) for r in graph.trace_report(traced, field).collect()] == [(2, "http://t/"), (1, "http://b/"), (1, "http://z/"), (0, "http://a/")]


def test_bfs_needs_a_root_and_can_be_bounded(spark):
    df = spark.createDataFrame([(1, 2), (2, 3)], "from_id long, to_id long")
    with pytest.raises(ValueError):
        graph.bfs(spark.createDataFrame([(1, None)], "url_id long, depth int"), df)
    start = spark.createDataFrame([(1, 0), (2, None), (3, None)], "url_id long, depth int")
    assert {r.url_id: r.depth for r in graph.bfs(start, df, 1).collect()} == {1: 0, 2: 1, 3: None}


def test_build_with_redirects(spark):
    field = spark.createDataFrame([(1, "http://a.org/", 1), (2, "http://a.org/b", 1), (3, "http://a.org/c", None)], "id long, url string, checkd long")
    links = spark.createDataFrame([(1, "http://a.org/c#x"), (1, "http://a.org/"), (1, "http://z.org/"), (1, "http://a.org/new")], "page_id long, link string")
    tops = spark.createDataFrame([(1, "a.org")], "id long, hostname string")
    nodes, edges = graph.build(field, links, tops, spark.createDataFrame([(2, 3), (1, 2)], "from_id long, to_id long"))
    assert {r.url_id for r in nodes.collect()} == {1, 3}
    assert {tuple(r) for r in edges.collect()} == {(1, 3), (2, 3)}
    with pytest.raises(Exception, match="more than one redirect"):
        graph.build(field, links, tops, spark.createDataFrame([(2, 3), (2, 1)], "from_id long, to_id long"))[1].collect()
    old = spark.createDataFrame([(1, None), (2, 0)], "url_id long, depth int")
    assert graph.build(field, links, tops, nodes=old)[1].count() == 0


def test_squash_and_scores(spark):
    rng = random.Random(4)
    edges, urls = [], {}
    for i in range(40):
        urls[i] = f"http://h.org/{rng.randint(0, 1)}?" + "&".join(f"{k}={rng.randint(0, 2)}" for k in rng.sample("abcd", rng.randint(0, 3)))
        edges += [(i, 100 + c) for c in rng.choice([[1], [1, 2], [2, 3]])]
    sets = params.squash(spark.createDataFrame(edges, "from_id long, to_id long"))
    assert sorted(len(r.from_set) for r in sets.collect()) and sum(len(r.from_set) for r in sets.collect()) == 40
    field = spark.createDataFrame([(i, u.rstrip("?")) for i, u in urls.items()], "id long, url string")
    groups = params.split_by_head(sets, field)
    by_group = {}
    for r in groups.collect():
        by_group.setdefault(r.group_id, []).append(frozenset(spec.param_set(r.url.partition("?")[2])))
    want = spec.pair_scores(by_group.values())
    for f in (params.score, params.score_pairs):
        assert {r.nameval: (r.agreement, r.irrelevancy) for r in f(groups).collect()} == want


def test_classes_as_rows_are_squashed_sets_also_after_purges(spark):
    rng = random.Random(7)
    edges = [(i, c) for i in range(60) for c in rng.choice([[1], [1, 2], [2, 3], [1, 2, 3], [1, None], [None]])] + [(None, 1), (99, 1), (99, 1)]
    gone = [2, 5, 17, 40, 0]
    edges = spark.createDataFrame(edges, "from_id long, to_id long")

    def named(pairs):
        sets = {}
        for parent in {p for p, _ in pairs}:
            sets.setdefault(frozenset(c for p, c in pairs if p == parent and c is not None), set()).add(parent)
        return {(min(v), p) for v in sets.values() for p in v}, {(min(v), c) for k, v in sets.items() for c in k}

    pairs = [tuple(r) for r in edges.collect() if r.from_id is not None]
    members = params.classes(edges)
    children = params.class_children(members, edges)
    assert ({tuple(r) for r in members.collect()}, {tuple(r) for r in children.collect()}) == named(pairs)
    assert "collect" not in members._jdf.queryExecution().toString()
    left = params.purge_classes(members, children, spark.createDataFrame([(x,) for x in gone], "id long"))
    kept = [(p, c) for p, c in pairs if p not in gone and c not in gone and c is not None]
    found = [[tuple(r) for r in x.collect()] for x in left]
    assert (set(found[0]), set(found[1])) == named(kept) and all(len(x) == len(set(x)) for x in found)
    none = params.classes(edges.limit(0))
    assert none.count() == 0 and params.purge_classes(none, params.class_children(none, edges.limit(0)), spark.range(3))[0].count() == 0


def test_redirect_classes_and_neighbors(spark):
    rows = graph.redirect_classes(spark.createDataFrame([(2, 1), (3, 2), (8, 9)], "from_id long, to_id long"), spark.createDataFrame([(1, True)], "url_id long, has_body boolean"))
    assert {tuple(r) for r in rows.collect()} == {(1, 3, 1, True), (1, 3, 2, False), (1, 3, 3, False), (8, 2, 8, False), (8, 2, 9, False)}
    links = spark.createDataFrame([("http://n.org/a b#c",), ("ftp://n.org/",), ("http://a.org/",), ("mailto:x@y",)], "link string")
    tops = spark.createDataFrame([(1, "a.org")], "id long, hostname string")
    assert [r.url for r in graph.neighbors(links, tops).collect()] == ["http://n.org/a+b"]


def test_bucketed_edges_are_not_shuffled_again(spark):
    from gossamr.session import bucketed

    edges = bucketed(spark.range(0, 1000).selectExpr("id % 50 AS from_id", "id AS to_id"), "edges", "from_id", rows_per_bucket=200, least=10)
    some = spark.range(20).withColumnRenamed("id", "from_id").hint("merge")
    joined = edges.join(some, "from_id", "left_semi")
    assert joined.count() == 400
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1


@pytest.mark.parametrize("seed", range(3))
def test_classes_grow_with_pairs(spark, seed):
    """Pairs in four batches: new nodes, pairs within a class, pairs that join classes, loops, nulls."""
    edges = [*_graph(seed, 60, 70), (5, 5), (99, 99)]
    random.Random(seed).shuffle(edges)
    known = spark.createDataFrame([], "node long, component long")
    for k in range(4):
        pairs = spark.createDataFrame([*edges[k::4], (None, 3)], "from_id long, to_id long")
        known = spark.createDataFrame([tuple(r) for r in graph.grown_classes(known, pairs).collect()], "node long, component long")
    assert {r.node: r.component for r in known.collect()} == spec.components(edges)


def test_yield_is_summed_natively_from_edges_kept_once(spark, monkeypatch):
    """No row is sent to Python with the counts of its block, and edges meet depths once for all levels."""
    named, keep = [], graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, name, *by: named.append(name) or keep(df, name, *by))
    edges = spark.createDataFrame([(0, 1), (0, 2), (1, 3), (2, 3), (3, 4), (2, 4)], "from_id long, to_id long")
    depths = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (3, 2), (4, 2)], "url_id long, depth int")
    targets = spark.createDataFrame([(3,), (4,)], "url_id long")
    got = graph.path_yield(depths, edges, depths, targets)
    assert {r.url_id: r["yield"] for r in got.collect()} == {0: 0.0, 1: 0.5, 2: 1.5, 3: 1.0, 4: 1.0}
    assert "InArrow" not in got._jdf.queryExecution().optimizedPlan().toString() and named.count("near-edges") == 1
    named.clear()
    assert {tuple(r) for r in graph.trace(targets, edges, depths).collect()} == {(3, 2, 3), (3, 1, 1), (3, 1, 2), (3, 0, 0), (4, 2, 4), (4, 1, 2), (4, 0, 0)}
    assert named.count("near-edges") == 1


def test_layered_edges_are_read_not_made_again(spark, data):
    from gossamr.plans import fixtures

    nodes, edges = fixtures.layered(spark, data)
    assert all("layered-edges" in x for df in (nodes, edges) for x in df.inputFiles()) and edges.inputFiles()
