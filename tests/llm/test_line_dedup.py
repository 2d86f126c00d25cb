import random
from collections import Counter

import pytest

from gossamr.llm import line_dedup as ld
from gossamr.session import materialize


def brute(docs, least):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    seen = Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or seen[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_equals_brute_force(spark, words, broadcast_rows):
    rng = random.Random(1)
    lines = [*words[:8], "", "  ", " Alpha\t", "ÀB", "àb", "\x1calpha"]
    docs = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 4)) + [f"own {i}"]) if i % 9 else None) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = ld.dedup_lines(df, min_docs=10, batch_docs=15, fanout=2, broadcast_rows=broadcast_rows)
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == brute(docs, 10)


def test_runs_are_sorted_compacted_and_leave_out_settled_keys(spark):
    runs = ld.LineRuns(spark, 4, min_docs=3, fanout=2)
    batch = lambda rows: spark.createDataFrame(rows, "key long, docs long")
    runs.add(batch([(2, 3), (1, 1)]))
    runs.add(batch([(2, 9), (1, 1), (3, 1)]))
    assert [len(level) for level in runs.levels] == [0, 1]
    runs.add(batch([(1, 1), (2, 5)]))
    assert {r.key: r.docs for r in runs.totals().collect()} == {1: 3, 2: 3, 3: 1}
    assert {r.key for r in runs.frequent().collect()} == {1, 2}


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]


def test_runs_are_not_shuffled(spark):
    """A join shuffles the batch alone, sums and compaction nothing."""
    runs = ld.LineRuns(spark, 5, min_docs=3, fanout=9)
    batch = materialize(spark.range(100).selectExpr("id AS key", "1L AS docs"), "batch")
    for _ in range(3):
        runs.add(batch)
    join = exchanges(runs.unsettled(batch))
    assert len(join) == 1 and "hashpartitioning(key" in join[0] and ", 5)" in join[0]
    assert not exchanges(runs.totals())
    runs.drop()


def test_defaults_compact(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    runs, _ = ld.count_lines(docs)
    assert runs.compacted >= 1 and len(runs.levels) >= 2 and runs.levels[1]
    runs.drop()


def test_edges(spark, edge_docs, no_docs):
    out = ld.dedup_lines(edge_docs, min_docs=2)
    assert out.columns == [*edge_docs.columns, "n_lines", "n_dropped"] and out.count() == 11
    assert {r.n_dropped for r in out.filter("text = '' and doc_id = 1").collect()} == {1}
    assert ld.dedup_lines(no_docs).count() == 0
