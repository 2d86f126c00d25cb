"""Pages with the same links, and which query parameters do not matter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gossamr.functions import urls
from gossamr.session import materialize


def squash(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(from_set, to_set): parents that have the same children; both sorted. Only parents that are nodes (url_id) count.

    Parents are grouped by the hash of their children first, so that long arrays are not shuffled as keys.
    """
    if nodes is not None:
        edges = edges.join(nodes.select(F.col("url_id").alias("from_id")).distinct(), "from_id", "left_semi")
    children = edges.groupBy("from_id").agg(F.array_sort(F.collect_set("to_id")).alias("to_set"))
    return children.groupBy(F.xxhash64("to_set").alias("_h"), "to_set").agg(F.array_sort(F.collect_list("from_id")).alias("from_set")).select("from_set", "to_set")


def classes(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(class_id, from_id): parents of squash() as rows, a class named by the least of them.

    Parents are compared by how many children they have and two xors of hashes of them, 128 bits in all, which are summed
    map-side: no array is made, so neither a page with most of the links nor a class of most of the pages is one row.
    Null children do not count; parents without any are a class.
    """
    if nodes is not None:
        edges = edges.join(nodes.select(F.col("url_id").alias("from_id")).distinct(), "from_id", "left_semi")
    links = edges.select("from_id", "to_id").filter("from_id is not null").distinct()
    some = F.col("to_id").isNotNull()
    mixed = lambda *more: F.coalesce(F.bit_xor(F.when(some, F.xxhash64(*more, "to_id"))), F.lit(0).cast("long"))
    digests = links.groupBy("from_id").agg(F.count("to_id").alias("_n"), mixed().alias("_x"), mixed(F.lit(1)).alias("_y"))
    named = digests.groupBy("_n", "_x", "_y").agg(F.min("from_id").alias("class_id"))
    return digests.join(named, ["_n", "_x", "_y"]).select("class_id", "from_id")


def class_children(members: DataFrame, edges: DataFrame) -> DataFrame:
    """(class_id, to_id): the children that the parents of a class of classes() have, read off the one that names it."""
    named = members.filter("from_id = class_id").select("class_id")
    return edges.select(F.col("from_id").alias("class_id"), "to_id").filter("to_id is not null").join(named, "class_id", "left_semi").distinct()


def purge_classes(members: DataFrame, children: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """classes() and class_children() without the ids (id) on either side: classes left without parents or children go,
    those that come to have the same children are one, all are named by the least parent left.
    """
    gone = ids.select("id").distinct()
    parents = members.join(gone, F.col("from_id") == F.col("id"), "left_anti")
    kids = children.join(gone, F.col("to_id") == F.col("id"), "left_anti").join(parents.select("class_id").distinct(), "class_id", "left_semi")
    kids = materialize(kids, "purge-children")
    same = materialize(classes(kids.select(F.col("class_id").alias("from_id"), "to_id")).select(F.col("from_id").alias("class_id"), F.col("class_id").alias("_same")), "purge-same")
    parents = materialize(parents.join(same, "class_id").select("_same", "from_id"), "purge-parents")
    names = parents.groupBy("_same").agg(F.min("from_id").alias("class_id"))
    left = parents.join(names, "_same").select("class_id", "from_id")
    return left, kids.withColumnRenamed("class_id", "_same").join(names, "_same").select("class_id", "to_id")


def split_by_head(edge_sets: DataFrame, field: DataFrame) -> DataFrame:
    """(group_id, head, url_id, url): members of classes of at least two parents, by URL head, in groups of at least two."""
    members = edge_sets.filter(F.size("from_set") > 1).select(F.xxhash64("to_set").alias("class_id"), F.explode("from_set").alias("from_id"))
    return head_groups(members, field)


def head_groups(members: DataFrame, field: DataFrame) -> DataFrame:
    """As split_by_head(), of the rows of classes()."""
    named = members.select(F.col("class_id").alias("_class"), F.col("from_id").alias("url_id")).join(field.select(F.col("id").alias("url_id"), "url"), "url_id").withColumn("head", urls.head(F.col("url"))).filter("head is not null")
    named = named.withColumn("group_id", F.xxhash64("_class", "head"))
    many = named.groupBy("group_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("group_id")
    return named.join(many, "group_id", "left_semi").select("group_id", "head", "url_id", "url")


def _params(groups: DataFrame) -> DataFrame:
    return groups.withColumn("params", urls.param_set(urls.query(F.col("url"))))


def score_pairs(groups: DataFrame) -> DataFrame:
    """(nameval, agreement, irrelevancy) by comparing each pair of a group: the rule as it is stated. For small groups
    only, whose size is bounded by the caller; score() gives the same by counting.
    """
    rows = _params(groups).select("group_id", "url_id", "params")
    a, b = rows.select("group_id", F.col("url_id").alias("i"), F.col("params").alias("p")), rows.select("group_id", F.col("url_id").alias("j"), F.col("params").alias("q"))
    pairs = a.join(b, "group_id").filter("i < j and p <> q")
    each = pairs.select(F.explode(F.array_union("p", "q")).alias("nameval"), "p", "q")
    both = F.array_contains("p", F.col("nameval")) & F.array_contains("q", F.col("nameval"))
    return each.groupBy("nameval").agg(F.count_if(both).alias("agreement"), F.count_if(~both).alias("irrelevancy"))


def score(groups: DataFrame) -> DataFrame:
    """As score_pairs(), by counting: with c of a group's n members holding p, and g of equal sets that hold p,
    agreement = C(c, 2) - sum of C(g, 2) and irrelevancy = c (n - c). Linear in the members.
    """
    rows = _params(groups).select("group_id", "params")
    alike = rows.groupBy("group_id", "params").agg(F.count("*").alias("g"))
    held = alike.select("group_id", "g", F.explode("params").alias("nameval")).groupBy("group_id", "nameval").agg(F.sum("g").alias("c"), F.sum(F.expr("g * (g - 1) div 2")).alias("same"))
    sizes = rows.groupBy("group_id").agg(F.count("*").alias("n"))
    each = held.join(sizes, "group_id").select("nameval", (F.expr("c * (c - 1) div 2") - F.col("same")).alias("a"), (F.col("c") * (F.col("n") - F.col("c"))).alias("i"))
    return each.groupBy("nameval").agg(F.sum("a").alias("agreement"), F.sum("i").alias("irrelevancy")).filter("agreement > 0 or irrelevancy > 0")
