"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gossamr.session import discard, materialize, ship, sized

#: Edges up to which one task finds the components by itself: 16 bytes each.
SMALL = 1_000_000


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return row.n, row.x


def _in_one_task(flat: DataFrame) -> DataFrame:
    """Labels of at most SMALL edges, by repeated halving of paths in arrays."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("component", T.LongType())])

    def run(batches):
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not parts:
            return
        u, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        names, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b = place[: len(u)], place[len(u) :]
        label = np.arange(len(names))
        while len(a):
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            np.minimum.at(label, high, low)
            while not np.array_equal(label[label], label):
                label = label[label]
            left = label[a] != label[b]
            a, b = a[left], b[left]
        for at in range(0, len(names), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000], pa.int64()) for x in (names, names[label])], names=schema.names)

    ship(flat.sparkSession)
    return flat.coalesce(1).mapInArrow(run, schema)


def components(edges: DataFrame, src: str = "from_id", dst: str = "to_id", small: int = SMALL) -> DataFrame:
    """(node, component) for every node of the edges, whatever their direction; component is the least node reached.

    Nulls are left out; a node with only a self-loop is its own component. Every step is an aggregation with map-side
    combine and a join of its result; a hub's edges are split over tasks by adaptive execution. Each round writes its
    edges to the shared folder, and the driver sees only a count and a checksum of them. Up to `small` edges, counted
    before, are labelled in one task instead of some dozen small jobs.
    """
    pairs = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v")).filter("u is not null and v is not null")
    loops = pairs.filter("u = v").select(F.col("u").alias("node")).distinct()
    flat = materialize(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    mark = _mark(flat)
    if mark[0] <= small:
        found = materialize(_in_one_task(flat), "components")
        return found.unionByName(loops.join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
    while mark[0]:
        both = flat.unionByName(flat.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(sized(least, 2 * mark[0]), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(sized(least, 2 * mark[0]), "u").select(F.col("v").alias("a"), "m").filter("a <> m").select(F.col("a").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        before, old = mark, flat
        flat = materialize(small, "components")
        discard(old)
        mark = _mark(flat)
        if mark == before:
            break
    labelled = flat.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = flat.select(F.col("v").alias("node")).unionByName(loops).distinct().join(flat.select(F.col("u").alias("node")), "node", "left_anti")
    return labelled.unionByName(roots.select("node", F.col("node").alias("component")))
