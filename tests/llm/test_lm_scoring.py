import math
import random
from collections import Counter

import pytest

from gossamr.llm import lm_scoring as lm


def brute(docs, good, strength=50.0):
    """Exact counts of words and bigrams of all texts but the one that is scored, without hashing."""
    one, two = [Counter(), Counter()], [Counter(), Counter()]
    for i, t in docs:
        w = (t or "").lower().split()
        for k in ([0, 1] if i in good else [1]):
            one[k].update(w)
            two[k].update(zip(w, w[1:], strict=False))
    vocabulary, out = len(one[1]) + 1, {}
    for i, t in docs:
        w, losses = (t or "").lower().split(), []
        mine, pairs = Counter(w), Counter(zip(w, w[1:], strict=False))
        inside = (int(i in good), 1)
        total = [sum(c.values()) - x * len(w) for c, x in zip(one, inside, strict=True)]
        for k in (0, 1):
            s = total[0] / total[1] if k and all(total) else 1.0
            loss = 0.0
            for j, x in enumerate(w):
                p = ((one[k][x] - inside[k] * mine[x]) * s + 1) / (total[0] + vocabulary)
                if j:
                    history = (one[k][w[j - 1]] - inside[k] * mine[w[j - 1]]) * s
                    p = (min((two[k][w[j - 1], x] - inside[k] * pairs[w[j - 1], x]) * s, history) + strength * p) / (history + strength)
                loss -= math.log(p)
            losses.append(loss / len(w) if w else None)
        out[i] = losses
    return out


def test_scores_equal_brute_force_and_tell_domains_apart(spark, words):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choices(words[:10] if i % 2 else words[5:], k=rng.randint(1, 40)))) for i in range(80)]
    good = {i for i in range(40) if i % 2}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(40)] + [(3, 1), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in lm.score(df, labels).collect()}
    for i, (a, b) in brute(docs, good).items():
        assert (got[i].target_loss, got[i].background_loss) == (pytest.approx(a, rel=1e-5), pytest.approx(b, rel=1e-5)) and got[i].score == pytest.approx(a - b, abs=1e-4)
    assert max(got[i].score for i in range(41, 80, 2)) < min(got[i].score for i in range(40, 80, 2))


def test_counts_cover_every_word(spark):
    df = spark.createDataFrame([("a b a", True), ("b c", False), (None, None)], "text string, is_target boolean").repartition(2)
    rows = lm.counts(df).collect()
    words = [r for r in rows if r.slot < 1 << lm.WORD_BITS]
    assert sorted((r.target, r.background) for r in words) == [(0, 1), (1, 2), (2, 2)] and sum(r.background for r in rows) == 5 + 3


def test_being_a_target_document_earns_no_better_score(spark):
    """Texts of words of their own: those labelled good would score far better if their own counts were left in."""
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{rng.randrange(100_000)}" for _ in range(50))) for i in range(200)]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 200, 2)], "doc_id long, quality int")
    got = lm.score(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()
    mean = [sum(r.score for r in got if r.doc_id % 2 == k) / 100 for k in (0, 1)]
    assert abs(mean[0] - mean[1]) < 0.05


def test_query_equals_its_sql(spark):
    import duckdb

    con, d = duckdb.connect(), "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{d}/{name}.parquet'")
    df = lm.op10_lm_scoring(spark, d)
    want = con.sql(lm.OP10_SQL)
    assert df.columns == want.columns and sorted(map(tuple, df.collect())) == sorted(want.fetchall())


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = lm.score(edge_docs, labels).collect()
    assert len(rows) == 11 and all(r.score is None for r in rows if r.doc_id in (2, 3, 5)) and all(r.score is not None for r in rows if r.doc_id in (1, 4, 6, 7))
    assert lm.score(no_docs, labels).count() == 0 and lm.score(edge_docs, labels.limit(0)).count() == 11


@pytest.mark.parametrize("chunk", [30, 1_000_000])
def test_models_grow_with_the_corpus(spark, chunk):
    """More words and bigrams than tables of 2^20 and 2^21 slots keep apart, over many chunks and buckets."""
    rng = random.Random(5)
    docs = [(i, " ".join(f"w{rng.randrange(6000)}" for _ in range(100))) for i in range(400)]
    docs += [(1000 + i, t) for i, t in docs[:20]] + [(2000, "one"), (2001, "")]
    good = {i for i, _ in docs if i % 3 == 0}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    pairs = {p for _, t in docs for p in zip(t.split(), t.split()[1:], strict=False)}
    assert lm.counts(df.selectExpr("text", "doc_id % 3 = 0 AS is_target")).count() == len({w for _, t in docs for w in t.split()}) + len(pairs)
    rows = lm.score(df, spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int"), chunk=chunk).collect()
    want = brute(docs, good)
    assert len(rows) == len(docs)
    for r in rows:
        a, b = want[r.doc_id]
        assert (r.target_loss, r.background_loss) == ((pytest.approx(a, rel=1e-9), pytest.approx(b, rel=1e-9)) if a else (None, None))
