import random
import re
import zlib
from collections import Counter

import pytest

from gossamr.llm import spelling
from gossamr.llm.spelling import Trie, group_variants, near_words, roots, vocabulary


def one_apart(a, b):
    """Whether one inserted, deleted or replaced character makes a of b, by trying where they first differ."""
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (len(b) - len(a) == 1 and a[i:] == b[i + 1 :] or len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def brute(counts):
    """(form, root, n, n_near, form_n) of each word."""
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def brute_words(rows, min_chars=5, min_count=3):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in out.items() if n >= min_count and len(w) >= min_chars}


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("letters", ["ab", "abcé", "aÀÿz"])
def test_trie_finds_the_pairs_of_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(60):
        words = sorted({"".join(rng.choices(letters, k=rng.randint(0, 6))) for _ in range(rng.randint(1, 40))})
        found = list(Trie(words).pairs())
        assert len(found) == len(set(found)) and sorted(found) == sorted((a, b) for a in words for b in words if one_apart(a, b))


@pytest.mark.parametrize("most", [3, 25, 20_000])
def test_variants_equal_brute_force(spark, most):
    """Small partitions are split again and again: every pair is still counted once."""
    rng = random.Random(most)
    counts = {"".join(rng.choices("abé", k=rng.randint(1, 7))): rng.choice([1, 2, 3, 5, 10, 30, 100]) for _ in range(250)}
    counts |= {"zzzzzz" + "".join(rng.choices("abcde", k=rng.randint(0, 3))): rng.randint(1, 50) for _ in range(40)}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(group_variants(vocab, most=most)) == brute(counts)


def test_a_third_of_all_words_shares_a_long_prefix(spark):
    rng = random.Random(5)
    counts = {"x" * 300 + "".join(rng.choices("abcdef", k=rng.randint(0, 4))) + "y" * rng.randint(0, 2): rng.randint(1, 90) for _ in range(120)}
    counts |= {"".join(rng.choices("abcdefgh", k=rng.randint(4, 5))): rng.randint(1, 90) for _ in range(200)}
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(group_variants(vocab, most=10)) == brute(counts)


def test_very_long_words(spark):
    a = "ab" * 60_000
    counts = {a: 9, a[:70_000] + a[70_001:]: 3, a + "c": 4, "c" + a: 2, a[:-1] + "c": 1, "b" * 5: 3}
    assert result(group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), min_chars=5)) == brute(counts)


def test_roots_of_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [(f"x{i}", "w20") for i in range(50)]
    assert {r.word: r.root for r in roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {w: "w37" for w, _ in chain}


def test_words_of_texts(spark, words):
    rng = random.Random(9)
    rows = [(rng.choice([None, *range(-3, 60)]), rng.choice([None, " ".join(rng.choices([*words, "Naïve", "ÉCOLE", "Straße", "x×y÷z", "O'Neill", "漢字", "a_b1c"], k=rng.randint(0, 60)))])) for _ in range(300)]
    got = {r.word: r.n for r in vocabulary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_words(rows) and len(got) > 10


def test_query_equals_brute_force_on_a_table(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert result(spelling.op13_spelling(spark, data)) == brute(brute_words(rows))


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    counts = brute_words(rows, 1, 1)
    assert {r.word: r.n for r in vocabulary(edge_docs, 1, 1).collect()} == counts
    assert result(group_variants(vocabulary(edge_docs, 1, 1))) == brute(counts)
    assert result(group_variants(vocabulary(no_docs))) == {}
    assert near_words(spark.createDataFrame([("a", 1)], "word string, n long")).collect() == []
