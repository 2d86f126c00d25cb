import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gossamr.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, texts, capacity):
    """The result against the whole-document ids of the tokenizers library."""
    exact = Tokenizer.from_file(PATH)
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array([*exact.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity)
            at += r.length
            assert zlib.crc32(ids[r.start : at].tobytes()) == r.ids_crc32
        assert at == len(ids)
    for pieces in by_bin.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_bin), -(-sum(r.length for r in rows) // capacity)


def test_documents_are_packed_tightly(spark, words):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choices(words, k=rng.randint(0, 90))) for i in range(300)} | {900: None, 901: "", 902: "<|endoftext|> x 漢字", 903: " ".join(words * 40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    for options in ({}, {"shard_items": 60, "islands": 3, "epochs": 3}):
        used, bound = check(packing.pack_documents(df, PATH, 128, **options).collect(), texts, 128)
        assert used <= bound * 1.02 + (6 if options else 1)


def test_encoder_agrees_with_tokenizers():
    rng, ours, exact = random.Random(2), packing.loaded(PATH), Tokenizer.from_file(PATH)
    parts = ["a", "th", " ", "  ", "\n", "1", "é", "'s", "x" * 70, "\x1c", "\t", "<|endoftext|>", "ÿ", "Ġ", "\xa0", " "]
    for text in ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(500)]:
        assert ours(text)[:-1].tolist() == exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(3))
def test_operators_keep_a_partition(seed):
    rng = np.random.default_rng(seed)
    shard = packing.Shard(rng.integers(1, 101, 200).astype(np.int32), 100, seed)
    a, b = shard.first(0.0), shard.first(0.3)
    for g in (a, b, shard.cross(a, b), shard.cross(b, a), shard.shake(a)):
        assert len(g) == 200 and shard.fills(g).max() <= 100 and shard.fills(g).sum() == shard.sizes.sum() and shard.fills(g).min() > 0
    assert shard.fitness(shard.evolve([a, b], 8)[0]) >= max(shard.fitness(a), shard.fitness(b))


def test_evolution_beats_bad_parents():
    """Triples of 50, 30, 20: best fit from the largest down is optimal, a random order is not; crossover mends it."""
    sizes = np.tile([50, 30, 20], 40).astype(np.int32)
    shard = packing.Shard(sizes, 100, 1)
    bad = [shard.place(np.full(120, -1, np.int32), list(np.random.default_rng(i).permutation(120))) for i in range(4)]
    best = shard.evolve(bad, 40)[0]
    assert len(shard.fills(best)) <= min(len(shard.fills(g)) for g in bad)


def triplets(seed):
    """Sizes that fill 40 sequences of 1000 to the last place, three to each: best fit from the largest down leaves gaps."""
    rng, sizes = np.random.default_rng(seed), []
    for _ in range(40):
        a, b = int(rng.integers(260, 490)), int(rng.integers(251, 400))
        sizes += [a, b, 1000 - a - b]
    return np.array(sizes, np.int32)


def test_evolution_improves_on_best_fit():
    fit, best = [], []
    for seed in range(6):
        shard = packing.Shard(triplets(seed), 1000, seed)
        parents = [shard.first(0.02 * k) for k in range(4)]
        fit.append(len(shard.fills(parents[0])))
        best.append(len(shard.fills(shard.evolve(parents, 25)[0])))
        assert shard.bound == 40 < fit[-1] and 40 <= best[-1] <= fit[-1]
    assert sum(best) < sum(fit)


def test_islands_migrate_and_improve_on_best_fit(spark):
    used = alone = 0
    for seed in range(3):
        sizes = triplets(seed)
        shard = packing.Shard(sizes, 1000, 0)
        alone += len(shard.fills(shard.first(0.0)))
        items = spark.createDataFrame(list(enumerate(sizes.tolist())), "item long, length long")
        rows = packing.pack(items, 1000, islands=3, epochs=3, generations=25).collect()
        fills = {}
        for r in rows:
            fills[r.sequence_id] = fills.get(r.sequence_id, 0) + int(sizes[r.item])
        assert sorted(r.item for r in rows) == list(range(len(sizes))) and max(fills.values()) <= 1000
        used += len(fills)
    assert 120 <= used < alone


def test_edges(spark, edge_docs, no_docs):
    rows = packing.pack_documents(edge_docs, PATH).collect()
    assert sum(r.piece == 0 for r in rows) == 11
    assert sum(r.length == 1 for r in rows if r.doc_id in (2, 3)) == 2
    assert packing.pack_documents(no_docs, PATH).count() == 0


@pytest.mark.parametrize("text", [" " * 1_000_000, " \n" * 500_000, "a" + "\t" * 4096 + "b", "word " * 50 + "0" * 5000 + ".1.1.1"])
def test_runs_of_blanks_and_digits_are_encoded_whole(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert packing.loaded(PATH)(text).tolist() == [*want, 0]


def test_query_packs_runs_of_blanks(spark, tmp_path):
    texts = {1: " " * 1_000_000, 2: " \n" * 500_000, 3: "0" * 5000 + ".1.1.1", 4: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    used, bound = check(packing.op3_packing(spark, str(tmp_path)).collect(), texts, 2048)
    assert used <= bound + 1
