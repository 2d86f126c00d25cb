import random

import numpy as np
import pytest

from gossamr.llm import parity_join as pj


def brute(docs, k, p, q):
    """Components by comparing all pairs of sets of word tuples."""
    sets = {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and q * common >= p * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(words, seed, groups=8, copies=14):
    rng, out = random.Random(seed), []
    for _ in range(groups):
        base = [rng.choice(words) + str(rng.randint(0, 30)) for _ in range(rng.choice([2, 3, 6, 20, 60, 150]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
            out.append((len(out), (" ".join(text).upper() if rng.random() < 0.2 else " ".join(text))))
    return out + [(len(out), None), (len(out) + 1, ""), (len(out) + 2, " \t")]


@pytest.mark.parametrize("seed,k,p", [(1, 4, 85), (2, 5, 80), (3, 1, 50)])
def test_components_equal_brute_force(spark, words, seed, k, p):
    docs = near_copies(words, seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in pj.jaccard_join(df, k, p, 100).collect()}
    assert got == brute(docs, k, p, 100)


def test_blocks_and_the_exhaustive_way_lose_nothing(spark, words, monkeypatch):
    monkeypatch.setattr(pj, "BLOCK", 6)
    monkeypatch.setattr(pj, "ROUNDS", 0)
    docs = near_copies(words, 7, 3, 30)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in pj.jaccard_join(df, 4, 85, 100).collect()} == brute(docs, 4, 85, 100)


def test_bounds_hold_for_linked_pairs():
    """Any linked pair shares a key, and its sketches pass the Hamming test."""
    rng, sk = np.random.default_rng(1), pj.Sketcher(4, 85, 100)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        far = sk.furthest(2 * len(a))
        keep = a[int(rng.integers(0, far // 2 + 1)) :]
        b = np.unique(np.r_[keep, rng.integers(0, 1 << 63, int(rng.integers(0, far // 2 + 1))).astype(np.uint64)])
        common = len(np.intersect1d(a, b))
        if not len(b) or common == len(a) == len(b) or 100 * common < 85 * (len(a) + len(b) - common):
            continue
        assert np.intersect1d(sk.keys(a), sk.keys(b)).size
        x, y = (np.unpackbits(np.frombuffer(sk.parity(s), np.uint8)) for s in (a, b))
        if len(x) != len(y):
            x, y = sorted((x, y), key=len)
            y = y[: len(x)] ^ y[len(x) :]
        assert (x != y).sum() <= len(a) + len(b) - 2 * common


def test_edges(spark, edge_docs, no_docs):
    rows = pj.jaccard_join(edge_docs).collect()
    assert len(rows) == 11
    assert {r.component_id for r in rows if r.doc_id in (2, 3, 5)} == {2, 3, 5}
    assert pj.jaccard_join(no_docs).count() == 0
    kept = pj.dedup_near(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 1, 2, 3, 4, 5, 6, 7] and ids.count(None) == 2


def test_keys_of_many_rows_are_dealt_out_and_lose_nothing(spark, words, monkeypatch):
    """Keys and buckets over BLOCK take the way of sums; buckets are the same as by windows alone."""
    docs = near_copies(words, 11, 2, 60)
    feats = pj.features(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), 4, 85, 100).cache()
    plain = sorted(map(tuple, pj.buckets(feats).collect()))
    monkeypatch.setattr(pj, "BLOCK", 5)
    assert pj._heavy(feats.select("node", pj.F.explode("keys").alias("key"))).count()
    assert sorted(map(tuple, pj.buckets(feats).collect())) == plain
    monkeypatch.setattr(pj, "HEAVY", 2)
    assert sorted(map(tuple, pj.buckets(feats).collect())) == plain
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in pj.jaccard_join(df, 4, 85, 100).collect()} == brute(docs, 4, 85, 100)
    feats.unpersist()


def test_rows_are_told_apart_by_id_and_text(spark, words):
    a, b, c = (" ".join(f"{w}{t}{i}" for i, w in enumerate(words)) for t in "abc")
    rows = [(1, a), (1, b), (2, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, pj.dedup_near(docs).collect())) == sorted(rows)
    more = spark.createDataFrame([(3, c + " one more"), (1, c), (1, c), (2, c), (4, b)], "doc_id long, text string")
    assert sorted(map(tuple, pj.dedup_near(docs.union(more)).collect())) == sorted([(1, a), (1, b), (1, c)])


def test_widths_far_apart_are_compared(spark):
    """At one half, sets of 188 and 376 shingles are linked; their sketches have widths 4 to 1."""
    many = [f"w{i}" for i in range(376)]
    docs = [(1, " ".join(many)), (2, " ".join(many[:188])), (3, " ".join(many[:200])), (4, " ".join(many[:187]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in pj.jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), 1, 50, 100).collect()}
    assert got == brute(docs, 1, 50, 100)


def test_query_equals_its_sql(spark):
    import duckdb

    con, d = duckdb.connect(), "/root/testdata/sf0.01"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    df, want = pj.op6_jaccard_join(spark, d), con.sql(pj.OP6_SQL)
    assert df.columns == want.columns and sorted(map(tuple, df.collect())) == sorted(want.fetchall())
