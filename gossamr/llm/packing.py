"""Best-fit packing by a grouping genetic algorithm.

Documents become items of at most `capacity` tokens. Items are dealt at random to shards of some ten thousand, each large
enough that packing it alone costs a fraction of one sequence. A shard is evolved on several islands: a genome is an
assignment of items to sequences; crossover injects whole well-filled sequences of one parent into the other, removes
the sequences that hold an injected item, and puts the displaced items back by best fit, largest first. After each
epoch the best genome of an island migrates to the next one; in the end the best island's genome counts.
"""

from __future__ import annotations

import json
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.llm.common import emit, field, public_pattern
from gossamr.session import materialize

#: The id that ends every document.
END = 0
#: Texts with only these characters are encoded by the quicker of the two libraries, which agree on them.
LATIN = re.compile("[^\x00-ɏ]")
#: Runs of blanks that the quicker one cannot split any more: its pattern goes back over each of them.
BLANKS = re.compile(r"\s{4096}")


class Encoder:
    """ids of texts as the tokenizers library makes them from a file, without added special tokens.

    Merging is tiktoken's for texts of basic Latin characters, from the same file's vocabulary; all other texts, and
    those with very long runs of blanks, go through tokenizers itself. Texts of any length are encoded whole.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # fixed by the file format: the characters that stand for bytes
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.quick = tiktoken.Encoding("packing", pat_str=public_pattern(), mergeable_ranks=ranks, special_tokens=special)
        self.path, self._exact = path, None

    @property
    def exact(self):
        """The tokenizers library's encoder, loaded when a text needs it."""
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.path)
        return self._exact

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            ids = []
        elif LATIN.search(text) or BLANKS.search(text):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.quick.encode(text, allowed_special="all")
        return np.array([*ids, END], "<u4")


_LOADED: dict[str, Encoder] = {}


def loaded(path: str) -> Encoder:
    """The encoder for a file, one for each worker process."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece: a document's ids and END, cut so that only the first piece is short."""

    def start():
        encoder = loaded(path)

        def work(doc_ids, texts):
            rows = []
            for doc_id, text in zip(doc_ids, texts, strict=True):
                ids = encoder(text)
                ends = range(len(ids) - (math.ceil(len(ids) / capacity) - 1) * capacity, len(ids) + 1, capacity)
                at = 0
                for k, end in enumerate(ends):
                    rows.append((doc_id, k, at, end - at, zlib.crc32(ids[at:end].tobytes())))
                    at = end
            return [list(x) for x in zip(*rows, strict=True)] if rows else [[] for _ in range(5)]

        return work

    return emit(docs, ["doc_id", "text"], [field("doc_id", "long"), field("piece", "int"), field("start", "long"), field("length", "long"), field("ids_crc32", "long")], start)


class Shard:
    """Packs one shard's items."""

    def __init__(self, sizes: np.ndarray, capacity: int, seed: int):
        self.sizes, self.capacity, self.rng = sizes, capacity, random.Random(seed)
        self.bound = max(math.ceil(int(sizes.sum()) / capacity), int((sizes > capacity // 2).sum()))

    def place(self, genome: np.ndarray, items: list[int]) -> np.ndarray:
        """Best-fit the items, in the order given, into the sequences of a genome (-1: not placed)."""
        genome, sizes = genome.copy(), self.sizes.tolist()
        held = genome >= 0
        n = int(genome.max()) + 1 if held.any() else 0
        fills = np.bincount(genome[held], self.sizes[held], n).astype(int).tolist() if n else []
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for b, fill in enumerate(fills):
            if fill:
                room[self.capacity - fill].append(b)
                mask |= 1 << (self.capacity - fill)
        for i in items:
            size = sizes[i]
            fit = mask >> size
            if fit:
                left = size + (fit & -fit).bit_length() - 1
                b = room[left].pop()
                if not room[left]:
                    mask ^= 1 << left
            else:
                left, b, n = self.capacity, n, n + 1
            genome[i] = b
            room[left - size].append(b)
            mask |= 1 << (left - size)
        return np.unique(genome, return_inverse=True)[1].astype(np.int32)

    def first(self, spread: float) -> np.ndarray:
        """A genome by best fit, from the largest item down, with sizes blurred by a random share."""
        blurred = [-s * (1 + spread * (self.rng.random() - 0.5)) for s in self.sizes.tolist()]
        return self.place(np.full(len(self.sizes), -1, np.int32), sorted(range(len(blurred)), key=blurred.__getitem__))

    def fills(self, genome: np.ndarray) -> np.ndarray:
        return np.bincount(genome, self.sizes)

    def fitness(self, genome: np.ndarray) -> tuple[float, float]:
        """Fewer sequences first, then the mean square of their fill."""
        fills = self.fills(genome)
        return -len(fills), float(((fills / self.capacity) ** 2).mean()) if len(fills) else 0.0

    def cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inject well-filled sequences of b into a, remove a's sequences that share items, best-fit what they held."""
        fills = self.fills(b)
        good = np.nonzero(fills >= np.median(fills))[0]
        chosen = np.zeros(len(fills), bool)
        chosen[self.rng.sample(good.tolist(), max(1, len(good) // 2))] = True
        injected = chosen[b]
        hit = np.zeros(int(a.max()) + 1, bool)
        hit[a[injected]] = True
        genome = np.where(injected, len(hit) + b, np.where(hit[a], -1, a))
        genome = np.where(genome >= 0, np.unique(genome, return_inverse=True)[1] - int((genome < 0).any()), -1).astype(np.int32)
        return self._refill(genome)

    def shake(self, a: np.ndarray) -> np.ndarray:
        """Empty the worst sequences and some random ones, and best-fit what they held."""
        fills = self.fills(a)
        out = np.zeros(len(fills), bool)
        out[np.argsort(fills)[: max(1, len(fills) // 50)]] = True
        out[self.rng.sample(range(len(fills)), max(1, len(fills) // 50))] = True
        return self._refill(np.where(out[a], -1, a).astype(np.int32))

    def _refill(self, genome: np.ndarray) -> np.ndarray:
        loose = np.nonzero(genome < 0)[0]
        return self.place(genome, loose[np.argsort(-self.sizes[loose], kind="stable")].tolist())

    def evolve(self, population: list[np.ndarray], generations: int) -> list[np.ndarray]:
        """The population after so many generations, best first; it ends early at the lower bound."""
        ranked = sorted(population, key=self.fitness, reverse=True)
        for _ in range(generations):
            if -self.fitness(ranked[0])[0] <= self.bound:
                break
            a, b = self.rng.sample(ranked, 2) if len(ranked) > 1 else (ranked[0], ranked[0])
            ranked = sorted([*ranked, self.cross(ranked[0], b), self.cross(a, ranked[0]), self.shake(ranked[0])], key=self.fitness, reverse=True)[: len(population)]
        return ranked


def _epoch(state: DataFrame, capacity: int, members: int, generations: int, epoch: int) -> DataFrame:
    """One epoch on every island. state: shard, island, sizes (int32), genomes (int32, concatenated)."""

    def start():
        def work(shards, islands, sizes, genomes):
            out, counts, squares = [], [], []
            for shard, island, raw, kept in zip(shards, islands, sizes, genomes, strict=True):
                own = np.frombuffer(raw, "<i4")
                pack = Shard(own, capacity, (shard * 1009 + island) * 31 + epoch)
                population = list(np.frombuffer(kept, "<i4").reshape(-1, len(own))) if kept else [pack.first(0.0 if k + island == 0 else 0.02 * (k + island)) for k in range(members)]
                best = pack.evolve(population, generations)[:members]
                out.append(np.concatenate(best).astype("<i4").tobytes())
                n, square = pack.fitness(best[0])
                counts.append(-n)
                squares.append(square)
            return shards, islands, sizes, out, counts, squares

        return work

    fields = [field("shard", "long"), field("island", "int"), field("sizes", "binary"), field("genomes", "binary"), field("n", "int"), field("square", "double")]
    return emit(state, ["shard", "island", "sizes", "genomes"], fields, start)


def pack(items: DataFrame, capacity: int = 2048, shard_items: int = 16384, islands: int = 2, epochs: int = 2, members: int = 4, generations: int = 6) -> DataFrame:
    """(item, sequence_id, offset) for items (item: unique long, length: 1 to capacity)."""
    shards = max(1, math.ceil(items.count() / shard_items))
    dealt = items.select("item", "length", F.pmod(F.xxhash64("item"), F.lit(shards)).alias("shard"))
    grouped = dealt.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("item", "length"))).alias("own"))
    spark = items.sparkSession

    def pack_sizes():
        return lambda s, own: (s, [np.array([x["item"] for x in o], "<i8").tobytes() for o in own], [np.array([x["length"] for x in o], "<i4").tobytes() for o in own])

    base = materialize(emit(grouped, ["shard", "own"], [field("shard", "long"), field("ids", "binary"), field("sizes", "binary")], pack_sizes), "packing-shards")
    state = base.select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "sizes", F.lit(None).cast("binary").alias("genomes"))
    parallel = max(spark.sparkContext.defaultParallelism, math.ceil(shards * islands / 32))
    for epoch in range(epochs):
        state = materialize(_epoch(state.repartition(parallel, "shard", "island"), capacity, members, generations, epoch), "packing-epoch")
        if epoch + 1 < epochs and islands > 1:
            elite = state.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.expr("substring(genomes, 1, octet_length(sizes))").alias("elite"))
            state = state.join(elite, ["shard", "island"]).select("shard", "island", "sizes", F.concat("elite", "genomes").alias("genomes"))
    best = state.groupBy("shard").agg(F.max_by("genomes", F.struct(-F.col("n"), F.col("square"), -F.col("island"))).alias("genomes"))

    def place():
        def work(shard, ids, sizes, genomes):
            parts = []
            for s, i, z, g in zip(shard, ids, sizes, genomes, strict=True):
                item, size = np.frombuffer(i, "<i8"), np.frombuffer(z, "<i4").astype(np.int64)
                genome = np.frombuffer(g, "<i4")[: len(item)]
                order = np.argsort(genome, kind="stable")
                run = np.cumsum(size[order]) - size[order]
                heads = np.r_[True, genome[order][1:] != genome[order][:-1]]
                offset = run - np.maximum.accumulate(np.where(heads, run, 0))
                parts.append((item[order], s * (1 << 20) + genome[order].astype(np.int64), offset))
            return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[], [], []]

        return work

    return emit(base.join(best, "shard"), ["shard", "ids", "sizes", "genomes"], [field("item", "long"), field("sequence_id", "long"), field("offset", "long")], place)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, **options) -> DataFrame:
    """All pieces of docs (doc_id, text) with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts have one token (END). Repeated rows are packed as often as they occur. An empty table gives
    an empty one.
    """
    items = materialize(pieces(docs, path, capacity).withColumn("item", F.monotonically_increasing_id()), "packing-pieces")
    return items.join(pack(items, capacity, **options), "item").drop("item")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place, at 2048 tokens a sequence."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
