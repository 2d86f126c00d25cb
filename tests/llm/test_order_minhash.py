import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gossamr.llm import order_minhash as omh


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    return {r.i: r.fp for r in omh.add_fingerprint(df, "text", "fp").select("i", "fp").collect()}


def like(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    return omh.add_fingerprint(omh.add_fingerprint(df, "a", "x"), "b", "y").select(omh.likeness("x", "y")).first()[0]


def test_equal_texts_equal_prints_and_occurrences_count(spark):
    texts = ["a b c a b c a b c d", "a b c a b c a b c d", "a b c d", "", "  ", None, "one", "one one one one one one", "one one one one one one one"]
    got = prints(spark, texts)
    assert got[0] == got[1] != got[2] and got[3] == got[4] == [] and got[5] is None and len(got[6]) == 1 and got[7] != got[8]


def test_likeness_falls_with_edits_and_with_reordering(spark, words):
    rng = random.Random(1)
    base = [f"{rng.choice(words)}{rng.randint(0, 500)}" for _ in range(600)]
    few = list(base)
    for i in range(0, 600, 100):
        few[i] = "edited"
    many = list(base)
    for i in range(0, 600, 10):
        many[i] = "edited"
    blocks = [base[i : i + 10] for i in range(0, 600, 10)]
    rng.shuffle(blocks)
    mixed = [w for b in blocks for w in b]
    other = [f"{rng.choice(words)}{rng.randint(501, 900)}" for _ in range(600)]
    one, two, three, four, five = (like(spark, " ".join(base), " ".join(x)) for x in (base, few, many, mixed, other))
    assert one == 1 > two > three > five == 0 and two > 0.7 and four < two


def test_brute_force_of_selection(spark, words):
    """The selected tuples against a plain reading of the definition, with Spark's own hash of k-mers."""
    rng = random.Random(5)
    text = " ".join(rng.choice(words[:6]) for _ in range(120))
    df = spark.createDataFrame([(text,)], "text string")
    kmers = df.select(F.expr("transform(sequence(0, size(split(text, ' ')) - 3), i -> xxhash64(split(text, ' ')[i], split(text, ' ')[i + 1], split(text, ' ')[i + 2]))")).first()[0]
    seen, pairs = {}, []
    for place, k in enumerate(kmers):
        short = (k << 26 & (1 << 64) - 1)
        short = (short - (1 << 64) if short >> 63 else short) >> 26
        pairs.append((short, seen.get(short, 0), place, k))
        seen[short] = seen.get(short, 0) + 1
    table = spark.createDataFrame(pairs, "short long, occurrence int, place int, k long")
    hashed = [(r.h & (1 << 64) - 1) >> 1 for r in table.select(F.xxhash64("short", "occurrence").alias("h"), "place").orderBy("place").collect()]
    buckets = {}
    for h, (_, _, place, k) in zip(hashed, pairs, strict=True):
        buckets.setdefault(h >> 57, []).append((h >> 26, place, k))
    tuples = [(b, [k for _, k in sorted((p, k) for _, p, k in sorted(v)[:2])]) for b, v in sorted(buckets.items())]
    want = [(b << 16) + (spark.sql(f"SELECT xxhash64({', '.join(f'{k}L' if k != -2**63 else str(k) for k in ks)})").first()[0] & 65535) for b, ks in tuples]
    assert prints(spark, [text])[0] == want


@pytest.mark.parametrize("rows_per_range", [2, 2000])
def test_next_documents(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(omh, "RANGE_ROWS", rows_per_range)
    rng = random.Random(2)
    docs = [(i * i, f"text {i} " * rng.randint(0, 5) if i % 5 else None) for i in range(60)] + [(i * i, f"text {i} again") for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    tie = {(r.doc_id, r.t): r.h for r in df.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select("doc_id", "t", F.xxhash64("t").alias("h")).collect()}
    order = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0], tie[r]), reverse=True)
    want = sorted((r[0], r[1], order[(k + 1) % len(order)][1]) for k, r in enumerate(order))
    assert sorted((r.doc_id, r.text, r.next_text) for r in omh.with_next(df).collect()) == want


def test_edges_and_query(spark, edge_docs, no_docs, tmp_path):
    assert omh.with_next(no_docs).count() == 0 and omh.with_next(edge_docs).count() == 11
    edge_docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = omh.op5_fingerprints(spark, str(tmp_path)).collect()
    assert len(rows) == 11 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    one = spark.createDataFrame([(9, "abcdef ghi jkl")], "doc_id long, text string")
    one.write.parquet(str(tmp_path / "one" / "documents.parquet"))
    r = omh.op5_fingerprints(spark, str(tmp_path / "one")).first()
    assert r.near_next == 1 and r.edited_sha256 == hashlib.sha256(b"abcdef ghiabcd").hexdigest()
