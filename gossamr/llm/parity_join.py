"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Two sets of sizes a <= b with J >= p/q differ in at most
D = (q-p)/(q+p) * (a+b) shingles. Shingles are XOR-hashed: each flips one bit of a parity sketch, and adds its 64-bit
hash by XOR to one of P segments; a shingle of the difference changes at most one bit and one segment, so that the
Hamming distance of the sketches and the number of unequal segments are lower bounds of the symmetric difference.

Per band of sizes P exceeds the band's largest D, so linked sets agree in at least one segment (pigeonhole): segments
are joined on equality. P has some segments to spare: of two linked sets, if either has at most so many segments with less
than w shingles, they agree in one with w or more. So a set with few enough segments of less than two shingles, in
which many unlinked sets agree, leaves those out; else one with few enough empty ones leaves out these; else it deals
its shingles anew by another hash as well, and meets others that do; after SEEDS tries, which next to no set needs, it
emits all segments. The join's pairs are never listed:

1. equal sets are one node; nodes that share segment values form a bucket;
2. each node is verified against the pivot (least node) of a bucket with which it shares most segments, if their sizes
   and sketches allow a link: components;
3. within buckets that hold several components, all pairs of nodes of different components are compared by size and
   sketch; large buckets are dealt out in blocks. Of the pairs that may be linked a block emits a spanning forest of
   its components, nearest pairs first; they are verified, components merge, pairs found unlinked are set aside, and
   the step is repeated with the buckets that had pairs, until no pair is left. Should pairs remain after ROUNDS rounds, all of them are verified.
   Pairs of one component need no verification.

Verification compares the shingle sets of the two texts. The result is exact but for collisions of 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gossamr.llm.common import WordHashes, emit, field, lowered_words_of, mixed, ngram_hashes
from gossamr.operators.components import components
from gossamr.session import materialize, ship, sized

#: Ratio of a band's upper to its lower bound of sizes, and segments to spare as a share of D.
BAND, SPARE = 1.4, 0.25
#: Hashes by which a set may deal its shingles to segments.
SEEDS = 6
#: Nodes of a bucket that are compared in one block.
BLOCK = 2048
#: Keys of the most rows that are looked for, and counters of a task that looks.
HEAVY, COUNTERS = 1000, 20_000
#: What is known of a key from all its nodes.
OF_KEY = {"size": "count(1)", "pivot": "min(node)", "mark": "bit_xor(xxhash64(node))"}
#: Set hashes a task keeps to emit the segments of copies only once.
SEEN = 500_000
#: Rounds in which blocks emit forests, and unlinked pairs that are sent to the blocks, before all pairs are verified.
ROUNDS, UNLINKED = 5, 500_000


def bands(upto: int) -> list[int]:
    """Lower bounds of the bands of sizes, past `upto`."""
    lows = [1]
    while lows[-1] <= upto:
        lows.append(int(lows[-1] * BAND) + 1)
    for _ in range(8):
        lows.append(int(lows[-1] * BAND) + 1)
    return lows


class Sketcher:
    """Shingle sets, segments and parity sketches for one pass."""

    def __init__(self, k: int, p: int, q: int):
        self.k, self.p, self.q, self.hashes = k, p, q, WordHashes()
        self.lows = bands(64)
        # the smallest sets of a band have so many shingles in a segment on average; the share of empty ones follows
        mean = p / q / (2 * BAND * (q - p) / (q + p) * (1 + SPARE))
        self.spared = (1 + SPARE) * math.exp(-mean) <= 0.9 * SPARE

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the k-word shingles; fewer than k words are one shingle."""
        words = lowered_words_of(text)
        if not words:
            return np.empty(0, np.uint64)
        h = self.hashes.of(words)
        n = min(self.k, len(h))
        return np.unique(ngram_hashes(h, n) + np.uint64(n))

    def furthest(self, total: int) -> int:
        """The largest symmetric difference of linked sets whose sizes sum to total."""
        return (self.q - self.p) * total // (self.q + self.p)

    def band(self, n: int) -> int:
        if n >= self.lows[-9]:
            self.lows = bands(2 * n)
        return int(np.searchsorted(self.lows, n, "right")) - 1

    def own_bands(self, n: int) -> list[int]:
        """Bands of the larger sets that a set of size n can be linked with: its own, and the next ones in reach."""
        b, reach = self.band(n), n * self.q // self.p
        if reach >= self.lows[-2]:
            self.lows = bands(2 * reach)
        return list(range(b, int(np.searchsorted(self.lows, reach, "right"))))

    def segments(self, b: int) -> tuple[int, int]:
        """Number of segments of a band, and how many of them are to spare."""
        far = self.furthest(2 * (self.lows[b + 1] - 1))
        spare = max(1, math.ceil(SPARE * far)) if self.spared else 0
        return far + 1 + spare, spare

    def keys(self, h: np.ndarray) -> np.ndarray:
        """Join keys of a set: its segments in each band it takes part in. Bands that allow no difference need none."""
        out = [np.empty(0, np.uint64)]
        for b in self.own_bands(len(h)):
            count, spare = self.segments(b)
            if count == spare + 1:
                continue
            for seed in range(SEEDS):
                dealt = mixed(h + np.uint64(seed)) if seed else h
                where = ((dealt >> np.uint64(32)) % np.uint64(count)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                at = where[order]
                heads = np.nonzero(np.r_[True, at[1:] != at[:-1]])[0]
                values = mixed(np.bitwise_xor.reduceat(h[order], heads))
                tags = mixed(np.uint64(((seed << 16) + b) << 32) + np.arange(count, dtype=np.uint64) + np.uint64(1))
                filled = np.diff(np.r_[heads, len(h)])
                last = seed == SEEDS - 1 or not self.spared
                enough = count - len(heads) <= spare
                strong = filled >= (2 if seed == 0 and count - int((filled >= 2).sum()) <= spare else 1)
                if not enough and last:
                    out.append(mixed(tags[np.setdiff1d(np.arange(count), at[heads])] ^ np.uint64(0x5851F42D4C957F2D)))
                out.append(mixed(values[strong] + tags[at[heads][strong]]))
                if enough or last:
                    break
        return np.concatenate(out)

    def parity(self, h: np.ndarray) -> bytes:
        """The set's parity sketch. Its width, a power of 2, is at least 8 bits for each shingle of its band's largest D;
        a sketch folds to half its width by XOR of its halves.
        """
        far = self.furthest(2 * (self.lows[self.band(len(h)) + 1] - 1))
        width = 64 << max(0, math.ceil(math.log2(max(1, far) / 8)))
        bits = np.bincount((mixed(h) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
        return np.packbits(bits.astype(np.uint8)).tobytes()


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def features(docs: DataFrame, k: int, p: int, q: int) -> DataFrame:
    """Of each document (row): doc_id, text_key, n (set size), node (hash of the set; null: empty), keys, sketch.

    keys and sketch are null for a set that the task has met already.
    """

    def start():
        sk, seen = Sketcher(k, p, q), set()

        def work(ids, text_keys, texts):
            out = []
            for doc_id, text_key, text in zip(ids, text_keys, texts, strict=True):
                h = sk.shingles(text)
                if not len(h):
                    out.append((doc_id, text_key, 0, None, None, None))
                    continue
                node = _signed(xxhash.xxh3_64_intdigest(h.tobytes()))
                if node in seen:
                    out.append((doc_id, text_key, len(h), node, None, None))
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                out.append((doc_id, text_key, len(h), node, sk.keys(h).view(np.int64), sk.parity(h)))
            return [list(x) for x in zip(*out, strict=True)] if out else [[] for _ in range(6)]

        return work

    fields = [field("doc_id", "long"), field("text_key", "long"), field("n", "long"), field("node", "long"), field("keys", "long[]"), field("sketch", "binary")]
    return emit(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), ["doc_id", "text_key", "text"], fields, start)


def _heavy(rows: DataFrame) -> DataFrame:
    """(key): of the keys of rows at most HEAVY that seem to have over BLOCK rows; those of most rows are among them.

    Tasks count with COUNTERS counters each, so that a key missed has a share of the rows of about 4 / COUNTERS at most.
    """
    dealt = rows.select("key", F.pmod(F.spark_partition_id(), F.lit(64)).alias("part"))
    parts = dealt.groupBy("part").agg(F.expr(f"approx_top_k(key, {HEAVY}, {COUNTERS})").alias("top"))
    top = parts.select(F.explode("top").alias("top")).groupBy(F.col("top.item").alias("key")).agg(F.sum("top.count").alias("seen"))
    return top.filter(F.col("seen") > BLOCK).orderBy(F.desc("seen"), "key").limit(HEAVY).select("key")


def buckets(feats: DataFrame) -> DataFrame:
    """(bucket, size, pivot, node, shared): nodes with a segment value in common, one bucket for each set of nodes.

    Keys of few rows are read key by key. A key that many rows hold is never in one task: its rows are dealt by key and
    node, its size, pivot and mark are summed before they meet, and come back by a broadcast of at most HEAVY rows.
    """
    rows = feats.filter("keys is not null").select("node", F.explode("keys").alias("key"))
    heavy = F.broadcast(materialize(_heavy(rows), "parity-heavy"))
    each = rows.join(heavy, "key", "left_anti").repartition("key").dropDuplicates(["key", "node"])
    counted = each.select("node", *(F.expr(f"{x} over (partition by key)").alias(c) for c, x in OF_KEY.items())).filter("size > 1")
    if not heavy.isEmpty():
        spread = materialize(rows.join(heavy, "key").distinct(), "parity-spread")
        of_key = spread.groupBy("key").agg(*(F.expr(x).alias(c) for c, x in OF_KEY.items())).filter("size > 1")
        counted = counted.unionByName(spread.join(F.broadcast(of_key), "key").drop("key"))
    return counted.groupBy(F.xxhash64("size", "pivot", "mark").alias("bucket"), "size", "pivot", "node").agg(F.count("*").alias("shared"))


def _folded(x: bytes, y: bytes) -> int:
    """Hamming distance of two sketches, the wider one folded to the width of the other."""
    if len(x) < len(y):
        x, y = y, x
    a, b, width = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(x)
    while width > 8 * len(y):
        width //= 2
        a = (a >> width) ^ (a & ((1 << width) - 1))
    return (a ^ b).bit_count()


def _possible(pairs: DataFrame, sketches: DataFrame, p: int, q: int) -> DataFrame:
    """Those of the pairs (a, b) whose sizes and sketches (node, n, sketch) allow a link."""
    of = lambda side: sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
    sizes = (F.least("n_a", "n_b") * q >= F.greatest("n_a", "n_b") * p)
    both = pairs.join(of("a"), "a").join(of("b"), "b").filter(sizes)

    def start():
        def work(a, b, n_a, n_b, x, y):
            kept = [i for i in range(len(a)) if _folded(x[i], y[i]) * (q + p) <= (q - p) * (n_a[i] + n_b[i])]
            return [a[i] for i in kept], [b[i] for i in kept]

        return work

    return emit(both, ["a", "b", "n_a", "n_b", "sketch_a", "sketch_b"], [field("a", "long"), field("b", "long")], start)


def verified(pairs: DataFrame, n_pairs: int, docs: DataFrame, chosen: DataFrame, k: int, p: int, q: int) -> DataFrame:
    """Those of the n_pairs pairs (a, b) of nodes that are linked, by the shingle sets of their texts.

    chosen: node, and _id and _key of a row of docs that has its text.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    needed = materialize(chosen.join(sized(nodes, 2 * n_pairs), "node", "left_semi"), "parity-needed")
    texts = docs.join(sized(needed), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")))
    texts = materialize(texts.select("node", "text"), "parity-texts")
    if texts.count() > needed.count():  # rows that repeat both id and text
        texts = materialize(texts.dropDuplicates(["node"]), "parity-texts")
    of = lambda side: texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")

    def start():
        sk, last = Sketcher(k, p, q), [None, None]

        def work(a, b, text_a, text_b):
            out = []
            for x, y, s, t in zip(a, b, text_a, text_b, strict=True):
                if last[0] != y:
                    last[:] = y, sk.shingles(t)
                h, g = sk.shingles(s), last[1]
                common = len(h) + len(g) - len(np.union1d(h, g))
                if q * common >= p * (len(h) + len(g) - common):
                    out.append((x, y))
            return [list(z) for z in zip(*out, strict=True)] if out else [[], []]

        return work

    return emit(both, ["a", "b", "text_a", "text_b"], [field("a", "long"), field("b", "long")], start)


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mixed(b.view(np.uint64)))


def _forest(comp_a: np.ndarray, comp_b: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of edges between components, in the order given, those that a spanning forest takes."""
    names, flat = np.unique(np.concatenate([comp_a, comp_b]), return_inverse=True)
    u, v, parent, taken = flat[: len(comp_a)], flat[len(comp_a) :], np.arange(len(names)), []
    left = order
    while len(left):
        for e in left[:1000].tolist():
            x, y = u[e], v[e]
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)
                taken.append(e)
        while (up := parent[parent]).tolist() != parent.tolist():
            parent = up
        left = left[1000:]
        left = left[parent[u[left]] != parent[v[left]]]
    return np.array(taken, np.int64)


def _block_pairs(rows: DataFrame, p: int, q: int, unlinked, exhaustive: bool) -> DataFrame:
    """Pairs (a, b, bucket) of one block, of different components, that sizes and sketches allow to be linked: all of
    them if exhaustive, else a spanning forest of each block without the pairs in unlinked (a broadcast array of keys).

    rows: block, bucket, across (pairs must be of different halves), half, node, component, n, sketch; those of a block
    follow one another. All pairs of a block are compared, offset by offset for all blocks at once.
    """
    schema = T.StructType([field("a", "long"), field("b", "long"), field("bucket", "long")])
    widest = 2 ** math.ceil(math.log2(2 * BAND * q / p))  # widths follow the bands' bounds in powers of 2

    def compare(t: pa.Table) -> pa.RecordBatch:
        block, half, node, comp, n = (t.column(c).to_numpy() for c in ("block", "half", "node", "component", "n"))
        across = t.column("across").to_numpy(zero_copy_only=False)
        sketch = t.column("sketch").to_pylist()
        width = np.fromiter(map(len, sketch), np.int64, len(sketch))
        wide = {}  # matrices of sketches of one width, wider ones that sizes allow to be linked folded to it
        for level in np.unique(width):
            place, parts = np.full(len(width), -1), []
            for own in np.unique(width[(width >= level) & (width <= widest * level)]):
                at = np.nonzero(width == own)[0]
                place[at] = np.arange(len(at)) + sum(map(len, parts))
                raw = np.frombuffer(b"".join([sketch[i] for i in at]), np.uint64).reshape(len(at), -1)
                while 8 * raw.shape[1] > level:
                    raw = raw[:, : raw.shape[1] // 2] ^ raw[:, raw.shape[1] // 2 :]
                parts.append(raw)
            wide[int(level)] = place, np.concatenate(parts)
        found, offset, live = [], 1, np.arange(len(block))
        while True:
            live = live[live + offset < len(block)]
            live = live[block[live] == block[live + offset]]
            if not len(live):
                break
            i, j = live, live + offset
            small, big = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            low = np.minimum(width[i], width[j])
            ok = (comp[i] != comp[j]) & (small * q >= big * p) & (~across[i] | (half[i] != half[j]))
            i, j, low = i[ok], j[ok], low[ok]
            for level in np.unique(low):
                place, matrix = wide[int(level)]
                x, y = i[low == level], j[low == level]
                distance = np.bitwise_count(matrix[place[x]] ^ matrix[place[y]]).sum(axis=1, dtype=np.int64)
                near = distance * (q + p) <= (q - p) * (n[x] + n[y])
                found.append(np.stack([x[near], y[near], distance[near]]))
            offset += 1
        x, y, distance = np.concatenate(found, 1) if found else np.empty((3, 0), np.int64)
        a, b, of = np.minimum(node[x], node[y]), np.maximum(node[x], node[y]), t.column("bucket").to_numpy()[x]
        if not exhaustive and len(a):
            new = ~np.isin(_pair_key(a, b), unlinked.value)
            a, b, of, x, y, distance = a[new], b[new], of[new], x[new], y[new], distance[new]
            tag = mixed(block[x].view(np.uint64))
            keys = [mixed(comp[z].view(np.uint64) + tag) for z in (x, y)]
            taken = _forest(*keys, np.lexsort((b, a, distance)))
            a, b, of = a[taken], b[taken], of[taken]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, of)], names=schema.names)

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            block = t.column("block").to_numpy()
            cut = int(np.nonzero(block != block[-1])[0][-1]) + 1 if len(block) and block[0] != block[-1] else 0
            if cut:
                yield compare(t.slice(0, cut).combine_chunks())
            held = t.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield compare(held)

    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def _crossing(members: DataFrame, wanted: DataFrame | None, labels: DataFrame, sketches: DataFrame, p: int, q: int, unlinked, exhaustive: bool) -> DataFrame:
    """Pairs of nodes that share a bucket, are of different components and may be linked, with the bucket; see _block_pairs.

    wanted: the buckets to look at, or None for all. They are marked among the members, and found in the same pass
    over each bucket that tells whether it holds several components. Large buckets are told by sums instead of a pass.
    """
    known = members.join(sized(labels), "node", "left").select("node", "bucket", "size", F.coalesce("component", "node").alias("component"))
    several = "min(component) {0} <> max(component) {0}"
    if wanted is not None:
        known = known.unionByName(wanted.select("bucket").distinct(), allowMissingColumns=True)
        several += " and count(1) {0} > count(node) {0}"
    # a bucket of over BLOCK nodes is summed before it meets, and not read by one task; a wanted one has a row in both
    spread = known.filter(F.coalesce("size", F.lit(0)) <= BLOCK).repartition("bucket")
    rows = spread.select("*", F.expr(several.format("over (partition by bucket)")).alias("open")).filter("open and node is not null").drop("open")
    many = known.filter(F.coalesce("size", F.lit(BLOCK + 1)) > BLOCK)
    opened = materialize(many.groupBy("bucket").agg(F.expr(several.format("")).alias("open")).filter("open").select("bucket"), "parity-open")
    rows = rows.unionByName(many.filter("node is not null").join(sized(opened), "bucket", "left_semi")).join(sketches, "node")
    chunks = F.ceil(F.col("size") / F.lit(BLOCK // 2)).cast("int")
    small = rows.filter(F.col("size") <= BLOCK).select("*", F.col("bucket").alias("block"), F.lit(False).alias("across"), F.lit(0).alias("half"))
    large = rows.filter(F.col("size") > BLOCK).withColumn("half", F.pmod(F.xxhash64("node"), chunks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    large = large.select("*", F.xxhash64("bucket", F.least("half", "other"), F.greatest("half", "other")).alias("block"), (F.col("half") != F.col("other")).alias("across")).drop("other")
    placed = small.unionByName(large).select("block", "bucket", "across", "half", "node", "component", "n", "sketch")
    return _block_pairs(placed.repartition("block").sortWithinPartitions("block"), p, q, unlinked, exhaustive)


def _refused_keys(refused: DataFrame) -> np.ndarray:
    """Keys of pairs verified as unlinked; at most UNLINKED are counted before."""
    t = refused.toArrow()
    return np.sort(_pair_key(t.column("a").to_numpy(), t.column("b").to_numpy())) if t.num_rows else np.empty(0, np.uint64)


def _components(docs: DataFrame, k: int, p: int, q: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_key, n_shingles, component) of docs, and names (component, first, rows) of the components of
    several rows; first: the row (no_id, doc_id, text_key) of least id, rows without id last.
    """
    feats = materialize(features(docs, k, p, q), "parity-features")
    members = materialize(buckets(feats), "parity-buckets")
    nodes = members.select("node").distinct()
    chosen = feats.join(sized(nodes), "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
    chosen = materialize(chosen.select("node", F.col("one.doc_id").alias("_id"), F.col("one.text_key").alias("_key")), "parity-nodes")
    best = members.filter("node <> pivot").groupBy("node", "pivot").agg(F.sum("shared").alias("shared")).groupBy("node").agg(F.max_by("pivot", F.struct("shared", "pivot")).alias("pivot"))
    sketches = materialize(feats.filter("keys is not null").select("node", "n", "sketch").join(sized(chosen.select("node")), "node", "left_semi").dropDuplicates(["node"]), "parity-sketches")
    best = best.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    best = materialize(_possible(best, sketches, p, q), "parity-pivots")
    edges, tried = materialize(verified(best, best.count(), docs, chosen, k, p, q), "parity-links"), best
    labels = materialize(components(edges, "a", "b"), "parity-labels")
    wanted = None
    for turn in range(ROUNDS + 1):
        refused = tried.join(edges, ["a", "b"], "left_anti")
        exhaustive = turn == ROUNDS or refused.count() > UNLINKED
        keys = None if exhaustive else docs.sparkSession.sparkContext.broadcast(_refused_keys(refused))
        found = materialize(_crossing(members, wanted, labels, sketches, p, q, keys, exhaustive), "parity-found")
        pairs = materialize(found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "parity-pairs")
        n_pairs = pairs.count()
        if not n_pairs:
            break
        # a bucket without such pairs will have none later
        wanted = found
        links = materialize(verified(pairs, n_pairs, docs, chosen, k, p, q), "parity-links")
        edges, tried = edges.unionByName(links), tried.unionByName(pairs)
        if not links.isEmpty():
            labels = materialize(components(edges, "a", "b"), "parity-labels")
        if exhaustive:
            break
    rows = feats.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    names = rows.filter("component is not null").groupBy("component").agg(first, F.count("*").alias("rows")).filter("rows > 1")
    return rows, materialize(names, "parity-names")


def jaccard_join(docs: DataFrame, k: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs (doc_id, text) under links J >= p/q of k-word shingles.

    component_id is the least doc_id that links reach. Documents without words (null and empty texts too) are linked
    with nothing: their component is their own id. Rows of equal sets, repeated rows among them, are linked. Null ids
    take part; the least id that is not null names the component. An empty table gives an empty one.
    """
    rows, names = _components(docs.select("doc_id", "text"), k, p, q)
    out = rows.join(sized(names.select("component", "first.doc_id").withColumnRenamed("doc_id", "component_id")), "component", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def dedup_near(docs: DataFrame, k: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """docs with one row of each component, that of least doc_id (of several such the least hash of the text).

    Rows are told apart by id and text: an id with several texts takes part with each of them. Rows without words stay,
    all of them. A row that is repeated whole stays once. Rows without doc_id take part; one of them stays only where the
    component has no id at all. An empty table gives an empty one; all columns stay as they are.
    """
    rows, names = _components(docs.select("doc_id", "text"), k, p, q)
    own = rows.join(sized(names.select("component", F.col("first.doc_id").alias("_first"), F.col("first.text_key").alias("_first_key"))), "component")
    stays = F.col("doc_id").eqNullSafe(F.col("_first")) & (F.col("text_key") == F.col("_first_key"))
    known = own.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.max(stays).alias("_stays"), F.count("*").alias("_rows"))
    known = materialize(known.filter("not _stays or _rows > 1"), "parity-copies")
    marked = docs.join(sized(known), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left")
    single = marked.filter("_key is null").select(*docs.columns)
    repeated = marked.filter("_key is not null and _stays").dropDuplicates(["_id", "_key"]).select(*docs.columns)
    return single.unionByName(repeated)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component under 100 * intersection >= 85 * union of 4-word shingles."""
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, p=85, q=100)


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS pos FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT rid, array_to_string(list_slice(ws, pos, pos + 3), ' ') AS sh FROM i),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.rid < b.rid GROUP BY a.rid, b.rid),
l AS (SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(rid, k) AS (SELECT rid, rid FROM n UNION SELECT e.y, r.k FROM r JOIN e ON e.x = r.rid),
c AS (SELECT r.rid, min(d.doc_id) AS component_id FROM r JOIN d ON d.rid = r.k GROUP BY r.rid)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)
"""
