"""The link graph: edges, depth, paths, yield, redirect classes, neighbours.

Loops run one level at a time; every level is written to the shared folder, so that lineage stays short and a lost
executor costs one level at most. The driver sees counts only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gossamr.functions import urls
from gossamr.operators import tables
from gossamr.operators.components import components
from gossamr.operators.frontier import check_hosts
from gossamr.session import bucketed, materialize, sized
from gossamr.sources.options import Options


def build(field: DataFrame, links: DataFrame, tops: DataFrame, redirect: DataFrame | None = None, nodes: DataFrame | None = None, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """(nodes: url_id; edges: from_id, to_id) of fetched pages.

    links (page_id: an id of field, link); children are known URLs on allowed hosts. Every child becomes a node, also
    of a link to itself, which is no edge. redirect (from_id, to_id): of a page without links its one target is both;
    more than one target is an error. nodes (url_id, depth): leave out pages that are nodes of a depth other than 0.
    """
    pages = field.filter("checkd is not null").select(F.col("id").alias("from_id"))
    if nodes is not None:
        pages = pages.join(nodes.filter("depth is null or depth <> 0").select(F.col("url_id").alias("from_id")), "from_id", "left_anti")
    cleaned = check_hosts(links, tops, options.match_domain).filter("host_id is not null").select(F.col("page_id").alias("from_id"), urls.clean(F.col("link")).alias("url"))
    children = cleaned.dropDuplicates(["from_id", "url"]).join(field.select("url", F.col("id").alias("to_id")), "url").join(pages, "from_id", "left_semi").select("from_id", "to_id")
    if redirect is not None:
        hops = redirect.join(pages, "from_id", "left_semi").join(links.select(F.col("page_id").alias("from_id")), "from_id", "left_anti")
        single = hops.groupBy("from_id").agg(F.count_distinct("to_id").alias("_n"), F.min("to_id").alias("to_id"))
        checked = single.withColumn("to_id", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("more than one redirect of "), F.col("from_id")))).otherwise(F.col("to_id")))
        children = children.unionByName(checked.select("from_id", "to_id"))
    return children.select(F.col("to_id").alias("url_id")).distinct(), children.filter("from_id <> to_id").distinct()


def bfs(nodes: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(url_id, depth) of all nodes (url_id, depth): depths that are there stay, a node without one gets the least number
    of steps from one that has it; null where no path leads. A node of depth 0 is needed.

    Levels go on past the largest depth given. Of each only what is new is kept, and the nodes still without depth are
    written anew when a quarter of them has got one.
    """
    every = materialize(nodes.groupBy("url_id").agg(F.min("depth").cast("int").alias("depth")), "bfs-nodes")
    given = every.filter("depth is not null")
    if given.filter("depth = 0").isEmpty():
        raise ValueError("no node of depth 0")
    per_level = {r["depth"]: r["count"] for r in given.groupBy("depth").count().collect()}
    last = max(per_level)
    left = materialize(every.filter("depth is null").select("url_id"), "bfs-left")
    edges = bucketed(edges.select("from_id", "to_id"), "bfs-edges", "from_id")
    found, since, level, size, remain = [], [], 0, 0, left.count()
    n_since = 0
    while (size or level <= last) and remain and (max_depth is None or level < max_depth):
        frontier = given.filter(F.col("depth") == level).select("url_id")
        if size:
            frontier = frontier.unionByName(found[-1].select("url_id"))
        size, level = size + per_level.get(level, 0), level + 1
        to = edges.join(sized(frontier.select(F.col("url_id").alias("from_id")), size), "from_id", "left_semi").select(F.col("to_id").alias("url_id")).distinct()
        fresh = to.join(left, "url_id", "left_semi")
        for x in since:
            fresh = fresh.join(x, "url_id", "left_anti")
        fresh = materialize(fresh.withColumn("depth", F.lit(level)), "bfs")
        size = fresh.count()
        if not size:
            continue
        found.append(fresh)
        since.append(fresh.select("url_id"))
        n_since, remain = n_since + size, remain - size
        if 4 * n_since >= remain:
            for x in since:
                left = left.join(x, "url_id", "left_anti")
            left, since, n_since = materialize(left, "bfs-left"), [], 0
    out = given
    for x in found:
        out = out.unionByName(x)
    return every.select("url_id").join(out, "url_id", "left")


def unreached(field: DataFrame, depths: DataFrame) -> DataFrame:
    """(unreached): fetched pages that are nodes without depth."""
    return depths.filter("depth is null").join(field.filter("checkd is not null").select(F.col("id").alias("url_id")), "url_id", "left_semi").agg(F.count("*").alias("unreached"))


def parents(level_set: DataFrame, edges: DataFrame, depths: DataFrame) -> DataFrame:
    """(target, url_id, depth): distinct predecessors one step nearer the roots of level_set (target, url_id, depth)."""
    back = level_set.select("target", F.col("url_id").alias("to_id"), F.col("depth").alias("_d")).join(edges, "to_id")
    near = back.join(depths.select(F.col("url_id").alias("from_id"), "depth"), "from_id").filter("depth = _d - 1")
    return near.select("target", F.col("from_id").alias("url_id"), "depth").distinct()


def _near(edges: DataFrame, reached: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(from_id, to_id, depth: of to_id), the distinct edges to nodes one step farther from the roots, and their numbers by depth."""
    near = edges.select("from_id", "to_id").join(reached.select(F.col("url_id").alias("from_id"), F.col("depth").alias("_from")), "from_id")
    near = near.join(reached.select(F.col("url_id").alias("to_id"), "depth"), "to_id").filter("_from = depth - 1").select("from_id", "to_id", "depth").distinct()
    near = materialize(near, "near-edges", "depth")
    return near, {r["depth"]: r["count"] for r in near.groupBy("depth").count().collect()}


def _back(near: DataFrame, steps: dict[int, int], depth: int) -> DataFrame:
    """(url_id, from_id): the edges of _near() that lead to nodes of a depth, for broadcast if they are few."""
    return sized(near.filter(F.col("depth") == depth).select(F.col("to_id").alias("url_id"), "from_id"), steps.get(depth, 0))


def trace(targets: DataFrame, edges: DataFrame, depths: DataFrame) -> DataFrame:
    """(target, depth, url_id): all nodes on shortest paths from depth 0 to the reached targets (url_id), targets included.

    Edges that lead one step away from the roots are kept by depth, once; a level is then one join with those of its depth,
    that are broadcast where they are few.
    """
    reached = materialize(depths.filter("depth is not null").select("url_id", "depth"), "trace-depths")
    near, steps = _near(edges, reached)
    start = materialize(targets.select("url_id").distinct().join(reached, "url_id").select(F.col("url_id").alias("target"), "url_id", "depth"), "trace-targets", "depth")
    levels = [start]
    above = None
    for depth in range(start.agg(F.max("depth")).first()[0] or 0, 0, -1):
        # what is at this depth: the targets there, and the nodes before those one step down, by how far up they are
        here = start.filter(F.col("depth") == depth).select("target", "url_id")
        here = here if above is None else here.unionByName(above.select("target", "url_id"))
        up = here.join(_back(near, steps, depth), "url_id").select("target", F.col("from_id").alias("url_id"), F.lit(depth - 1).alias("depth")).distinct()
        above = materialize(up, "trace")
        levels.append(above)
    out = levels[0].select("target", "depth", "url_id")
    for level in levels[1:]:
        out = out.unionByName(level.select("target", "depth", "url_id"))
    return out


#: Targets that share a row of bits.
BLOCK = 64


def path_yield(nodes: DataFrame, edges: DataFrame, depths: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(url_id, yield) of all nodes: for each target, 1 shared evenly by the nodes of each level of its paths above 0.

    Targets are numbered and dealt to blocks; a node has rows of 64 bits for the blocks of which it is on paths, and those of
    its children on the next level are joined by or. How many nodes of a level have a bit are sums over these rows, and a
    node's yield is what its bits are worth. There are never more rows than nodes on the targets' paths, and many fewer
    where nodes are on the paths of most.
    """
    near, steps = _near(edges, materialize(depths.filter("depth is not null").select("url_id", "depth"), "yield-depths"))
    own = targets.select("url_id").distinct().join(depths.filter("depth > 0").select("url_id", "depth"), "url_id")
    bits = [f"w{k}" for k in range(block // 64)]
    word = [F.expr(f"CASE WHEN id % {block} div 64 = {k} THEN shiftleft(1L, CAST(id % 64 AS INT)) ELSE 0L END").alias(w) for k, w in enumerate(bits)]
    own = materialize(tables.numbered(own, 0, "url_id").select("url_id", F.expr(f"id div {block}").alias("block"), *word, "depth"), "yield-targets", "depth")
    deepest = own.agg(F.max("depth")).first()[0]
    if deepest is None:
        return nodes.select("url_id").distinct().withColumn("yield", F.lit(0.0))
    level, every = None, None
    for depth in range(deepest, 0, -1):
        rows = own.filter(F.col("depth") == depth).select("url_id", "block", *bits)
        if level is not None:
            rows = rows.unionByName(level.join(_back(near, steps, depth + 1), "url_id").select(F.col("from_id").alias("url_id"), "block", *bits))
        level = materialize(rows.groupBy("url_id", "block").agg(*[F.bit_or(w).alias(w) for w in bits]), "yield-level")
        mine = level.withColumn("depth", F.lit(depth))
        every = mine if every is None else every.unionByName(mine)
    # in rows of one word each, so that 64 counts make a part
    word = F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("word"), F.col(w).alias("bits")) for k, w in enumerate(bits)]), lambda x: x["bits"] != 0)).alias("w")
    total = _worth(every.select("url_id", "block", "depth", word).select("url_id", "block", "depth", "w.*")).groupBy("url_id").agg(F.sum("share").alias("yield"))
    return nodes.select("url_id").distinct().join(total, "url_id", "left").select("url_id", F.coalesce("yield", F.lit(0.0)).alias("yield"))


def _worth(rows: DataFrame) -> DataFrame:
    """(url_id, share) of rows of bits (url_id, block, word, depth, bits): the sum, over the bits set, of 1 by the number of
    rows of the same block, word and level that have the bit.
    """
    part = ["block", "word", "depth"]
    counts = rows.groupBy(*part).agg(*[F.sum(F.expr(f"shiftrightunsigned(bits, {i}) & 1")).alias(f"n{i}") for i in range(64)])
    worth = counts.select(*part, F.array(*[1 / F.greatest(F.lit(1), f"n{i}") for i in range(64)]).alias("worth"))
    share = "aggregate(sequence(0, 63), 0D, (sum, i) -> IF(shiftrightunsigned(bits, i) & 1 = 1, sum + worth[i], sum))"
    return rows.join(worth, part).select("url_id", F.expr(share).alias("share"))


def paydirt(field: DataFrame, depths: DataFrame, rx: str) -> DataFrame:
    """(url_id) of the reached nodes whose URL matches."""
    return field.filter(F.col("url").rlike(rx)).select(F.col("id").alias("url_id")).join(depths.filter("depth is not null"), "url_id", "left_semi")


def grown_classes(known: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, component) after pairs (from_id, to_id) have come to the classes known (node, component: the least of its nodes).

    Classes known are single nodes for the steps over the new pairs; the classes that these join get the new label. A
    pair within a class costs nothing more.
    """
    label = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"_{side}"))
    named = pairs.select("from_id", "to_id").filter("from_id is not null and to_id is not null").join(label("from_id"), "from_id", "left").join(label("to_id"), "to_id", "left")
    named = materialize(named.select("from_id", "to_id", F.coalesce("_from_id", "from_id").alias("a"), F.coalesce("_to_id", "to_id").alias("b")), "classes-pairs")
    joined = materialize(components(named, "a", "b", small=0), "classes-joined")
    moved = joined.filter("node <> component").select(F.col("node").alias("component"), F.col("component").alias("_to"))
    old = known.join(sized(moved), "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    ends = named.select(F.col("from_id").alias("node")).unionByName(named.select(F.col("to_id").alias("node"))).distinct()
    new = ends.join(known.select("node"), "node", "left_anti").join(joined, "node")
    return old.unionByName(new.select("node", "component"))


def redirect_classes(redirect: DataFrame, extra: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """(component, size, id, has_body): the weakly connected classes of redirect. extra: url_id, has_body.

    known: classes (node, component) of the pairs that were there before, of which redirect then holds the new ones only.
    """
    found = components(redirect, small=0) if known is None else grown_classes(known, redirect)
    sizes = found.groupBy("component").agg(F.count("*").alias("size"))
    out = found.join(sizes, "component").select("component", "size", F.col("node").alias("id"))
    if extra is None:
        return out.withColumn("has_body", F.lit(None).cast("boolean"))
    return out.join(extra.select(F.col("url_id").alias("id"), "has_body"), "id", "left").select("component", "size", "id", F.coalesce("has_body", F.lit(False)).alias("has_body"))


def neighbors(links: DataFrame, tops: DataFrame, options: Options = Options()) -> DataFrame:
    """(url): distinct clean links of allowed schemes to hosts that are not allowed."""
    out = check_hosts(links, tops, options.match_domain).filter("host is not null and host_id is null")
    cleaned = out.select(urls.clean(F.col("link")).alias("url"))
    return cleaned.filter(F.col("url").isNotNull() & urls.scheme(F.col("url")).isin(*options.trace_protocols)).distinct()


def trace_report(traced: DataFrame, field: DataFrame) -> DataFrame:
    """(target, depth, url) of trace(), in the order of a report: by target, from its depth downward, URLs sorted in a level."""
    return traced.join(field.select(F.col("id").alias("url_id"), "url"), "url_id").select("target", "depth", "url").orderBy("target", F.desc("depth"), "url")


def class_report(classes: DataFrame, field: DataFrame) -> DataFrame:
    """(size, component, id, line) of redirect_classes(), largest classes first; line: the URL, marked ! if it has a body."""
    named = classes.join(field.select("id", "url"), "id")
    line = F.when(F.col("has_body"), F.concat(F.lit("!"), F.col("url"))).otherwise(F.col("url"))
    return named.select("size", "component", "id", line.alias("line")).orderBy(F.desc("size"), "component", "id")
