import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gossamr.llm import parity_join, pii
from gossamr.llm.queries import ORACLES, QUERIES
from test_line_dedup import brute as brute_lines
from test_packing import check
from test_parity_join import brute as brute_links
from test_pii import brute as brute_spans
from test_pii import brute_disclosures
from test_quality_rules import brute as brute_measures


def test_stages_one_by_one(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    by_name = dict(corpus_pipeline.STAGES)
    texts = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    kept = by_name["quality_rules"](spark, docs, data).persist()
    assert kept.columns == columns
    good = {r.doc_id for r in QUERIES["op8_quality_rules"](spark, data).filter("kept").collect()}  # held against brute force in its own tests
    assert sorted(texts(kept)) == sorted((i, t) for i, t in texts(docs) if i in good)
    assert all((m := brute_measures(t))[0] >= 50 and 100 * m[4] <= 50 * m[0] for _, t in texts(kept))

    lines = by_name["line_dedup"](spark, kept, data).persist()
    want = {i: t for i, _, _, t in brute_lines(texts(kept), corpus_pipeline.LINE_DOCS) if t}
    assert lines.columns == columns and dict(texts(lines)) == want and lines.filter(F.col("n_chars") != F.length("text")).count() == 0

    single = by_name["jaccard_join"](spark, lines, data).persist()
    links = brute_links(texts(lines), 5, 80, 100)
    assert single.columns == columns and {i for i, _ in texts(single)} == {i for i, (_, c) in links.items() if i == c}

    masked = by_name["pii"](spark, single, data).persist()
    before = dict(texts(single))
    assert masked.columns == columns and set(dict(texts(masked))) == set(before)
    risky: dict = {}
    for (w, _), p in brute_disclosures(list(before.values()), 60, 1.0, 0.6, 0.5).items():
        risky[w] = max(p, risky.get(w, 0))
    for i, t in texts(masked):
        assert not brute_spans(t), i
        spans = pii.protected_spans(before[i])[1]
        terms = [(m.start(), m.end(), "removed" if risky[m[0].lower()] >= 0.75 else "generalised") for m in re.finditer(r"[^\W_]{2,}", before[i]) if m[0].lower() in risky and not any(s < m.end() and e > m.start() for s, e, _ in spans)]
        assert t == pii.sanitised(before[i], sorted(spans + terms, key=lambda x: (x[0], pii.KINDS.index(x[2])))), i

    used, bound = check(by_name["packing"](spark, masked, data).collect(), dict(texts(masked)), 2048)
    assert used <= bound + 1 or used <= 1.02 * bound


def test_run_ends_in_packed_documents(spark, data):
    rows = corpus_pipeline.run(spark, data)
    assert {"doc_id", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


def test_very_long_runs_pass_every_stage(spark, words):
    prose = [" ".join(words[(i * k + k) % 20] + str(i * k) for k in range(1, 120)) for i in range(1, 5)]
    texts = [prose[0] + " " + "0" * 5000 + ".1.1.1", prose[1] + " " * 1_000_000, prose[2] + " \n" * 500_000, prose[3]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:]:  # the first one drops documents of one long word
        docs = stage(spark, docs, "").persist()
    assert {r.doc_id for r in docs.collect()} == {0, 1, 2, 3}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_agrees(spark, data, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    df, relation = QUERIES[name](spark, data), con.sql(ORACLES[name])
    order = [relation.columns.index(c) for c in sorted(relation.columns)]
    assert sorted(df.columns) == sorted(relation.columns)
    assert sorted(repr([r[c] for c in sorted(df.columns)]) for r in df.collect()) == sorted(repr([r[i] for i in order]) for r in relation.fetchall())


def test_every_operator_has_its_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14)) and parity_join.BLOCK > 0
