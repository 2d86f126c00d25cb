import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gossamr.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ours = byte_bpe.loaded(PATH)
    return ours, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def test_equals_tiktoken(both):
    ours, theirs = both
    rng = random.Random(1)
    texts = ["", " ", "\n\n", "'s don't I'll", "<|endoftext|>", "".join(rng.choice("abcdef") for _ in range(3000))]
    texts += ["".join(rng.choice(["a", "b", "e", "th", "in", " ", "  ", "\n", "1", "é", "あ", "🎉", "'s", "x" * rng.randint(1, 300), "\x1c", "\t"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [f"a {chr(c)}{chr(c)}b1 {chr(c)} \n" for c in [*range(0, 0x3000), *range(0xFE00, 0x10000), 0x1D7CE, 0x1F600]]
    for text, ids in zip(texts, ours.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text), repr(text)
        assert ours.decode(ids) == text.encode()


def test_long_pieces_and_matrix_rows_merge_alike(both):
    ours, _ = both
    rng = random.Random(2)
    pieces = ["".join(rng.choice("theinrsoa") for _ in range(rng.randint(2, 400))).encode() for _ in range(60)]
    assert [ours._queued(p) for p in pieces] == [ours._matrix([p], max(2, len(p)))[0] for p in pieces]


def test_pair_table():
    pairs = {i * 7919 + 3: i for i in range(5000)}
    table = byte_bpe.PairTable(pairs)
    assert table(np.fromiter(pairs, np.int64)).tolist() == list(pairs.values())
    assert (table(np.arange(4, 7000, 7919, dtype=np.int64)) == byte_bpe.NONE).all()


def test_cache_may_be_emptied(both, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 3)
    ours = byte_bpe.ByteBPE(PATH)
    texts = ["one two three", "four five six", "one six"]
    assert ours.encode_batch(texts) == [ours.encode_batch([t])[0] for t in texts]


def test_edges(spark, edge_docs, no_docs):
    rows = byte_bpe.decode(byte_bpe.encode(edge_docs, PATH), PATH).collect()
    assert len(rows) == 11
    for r in rows:
        assert bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == len(r.ids) // 4
        assert r.n_words is None or r.n_words < 10
    assert byte_bpe.encode(no_docs, PATH).count() == 0
