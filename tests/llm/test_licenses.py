import random

import pytest
from pyspark.sql import functions as F

from gossamr.llm import licenses


@pytest.fixture(scope="module")
def model(spark):
    return licenses.LicenseModel(spark)


def test_held_out_templates(model):
    """A model that has not seen one template of each family names half of their variants, where chance is one in 14."""
    assert model.accuracy >= 0.5 and 0 < model.cutoff < 1


def test_cutoff_is_calibrated_on_the_corpus(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    own = licenses.LicenseModel(spark, docs)
    assert 0 < own.cutoff < 1 and own.cutoff != 0.5
    plain = own.predict(licenses.windows(licenses.lines(docs))).filter("family <> 'unknown'")
    assert licenses.confirmed(plain).filter("family = 'unknown'").count() <= 0.01 * licenses.lines(docs).count()


def test_bounded_scores_lose_nothing(spark):
    """The same lines as with every window of every line scored in full."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = licenses.LicenseModel(spark, docs)
    every = licenses.confirmed(model.predict(licenses.windows(licenses.lines(docs)))).filter("family <> 'unknown'")
    want = {(r.doc_id, r.line, r.family) for r in every.collect()}
    assert {(r.doc_id, r.line, r.family) for r in licenses.scan(docs, model).collect()} == want and want


def test_families_and_unknown(spark, model):
    given = [
        ("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0 (the \"License\");", "apache"), ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("All rights reserved.", "proprietary"), ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl"),
        ("The license plate of the old car was hard to read in the rain.", None), ("Copyright law is a difficult subject.", None), ("Nothing of the kind.", None), ("", None), (None, None),
    ]
    df = spark.createDataFrame([(i, t, "clash") for i, (t, _) in enumerate(given)], "doc_id long, text string, family string")
    got = {r.doc_id: r.family for r in licenses.scan(df, model).collect()}
    assert {i: f for i, (_, f) in enumerate(given) if f} == got


def test_lines_are_named_and_plan_is_native(spark, model):
    df = spark.createDataFrame([(1, "a\nb\nReleased under the MIT License.\nLicensed under CC0 1.0.")], "doc_id long, text string")
    rows = licenses.scan(df, model)
    assert {(r.line, r.family) for r in rows.collect()} == {(2, "mit"), (3, "cc0")}
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_edges(spark, model, edge_docs, no_docs, tmp_path):
    assert licenses.scan(edge_docs, model).count() == 0 and licenses.scan(no_docs, model).count() == 0
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "Licensed under CC0 1.0."), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((str(r.doc_id), r.n_licenses, r.family) for r in licenses.op2_licenses(spark, str(tmp_path)).collect())
    assert got == [("1", 1, "mit"), ("1", 1, "mit"), ("2", 0, "unknown"), ("None", 1, "cc0")]


def test_notices_inside_long_lines(spark, model):
    """Notices of each kind of place in lines of hundreds of words, and two licences in one line."""
    prose = ("the old harbour town lies between green hills and a wide river where people trade fish salt and cloth every spring " * 20).split()
    notices = [("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0", "apache"), ("This work is licensed under the GNU General Public License, version 3.", "gpl"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc")]
    rows, want = [], set()
    for i, (notice, family) in enumerate(notices):
        for n in (25, 100, 203, 399):
            for before in (0, n // 2, n):
                rows.append((len(rows), " ".join([*prose[:before], notice, *prose[before:n]])))
                want.add((len(rows) - 1, family))
    rows += [(1000, " ".join([*prose[:200], notices[0][0], *prose[:150], notices[1][0], *prose[:90]])), (1001, " ".join([*prose[:200], "the license plate of the old car was hard to read", *prose[:200]]))]
    got = {(r.doc_id, r.family) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == want | {(1000, "mit"), (1000, "apache")}


def test_every_text_calibrates_the_cutoff(spark):
    """Cutoff and number of negatives are those of all distinct windows of all texts, found with Spark alone; copies change nothing."""
    rng, cues = random.Random(3), " ".join(t for texts in licenses.TEMPLATES.values() for t in texts).split()
    line = lambda: " ".join([*rng.choices(licenses.FILLER, k=rng.randint(0, 30)), *rng.choices(cues, k=rng.randint(0, 9)), *rng.choices(licenses.FILLER, k=rng.randint(0, 30))])
    texts = ["\n".join(line() for _ in range(rng.randint(1, 3))) for _ in range(700)]
    texts += [t for t in licenses.TEMPLATES["mit"]] + [None, "", "\n \n", "license", "of the of the of the of the", "\u212aite naïve 🎉 LICENSE, 1.0.\nLicensed under\ncc by xx xx xx xx", *texts[:50]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    own = licenses.LicenseModel(spark, docs, false_rate=0.0004)

    rows = spark.createDataFrame([(t, float(own.names.index(f)), held) for t, f, held in licenses.training_rows()], "text string, label double, held boolean").coalesce(1)
    rows = licenses.with_grams(rows, "text").withColumn("_grams", F.concat("_words", "_pairs"))
    counting, fitted = licenses.LicenseModel._fit(rows.filter("not held"))
    windows = licenses.windows(licenses.lines(docs)).select("_words", "_pairs").filter("size(_words) > 0").dropDuplicates(["_words"])
    sure = licenses.confirmed(windows.withColumn("family", F.explode(F.array(*map(F.lit, licenses.TEMPLATES))))).filter("overlap >= 0.5").select("_words")
    plain = windows.join(sure, "_words", "left_anti").select(F.concat("_words", "_pairs").alias("_grams"))
    plain = plain.unionByName(rows.filter("held and label = 0").select("_grams"))
    raws = [r._raw.toArray().tolist() for r in fitted.transform(counting.transform(plain)).select("_raw").collect()]
    scores = sorted((max(own._softmax(x, own.temperature)) for x in raws if max(x) > x[0]), reverse=True)
    n = int(0.0004 * (windows.count() + rows.filter("held and label = 0").count()))
    assert len(scores) > n and own.cutoff == pytest.approx(scores[n], abs=2e-9)
    assert own.judged == windows.count() + rows.filter("held and label = 0").count() and sum(p >= own.cutoff for p in scores) <= n


def test_nth_largest(spark):
    rng = random.Random(5)
    values = [rng.choice([0, 1, 999, 1000, 10**6, 10**9, rng.randrange(10**9), rng.randrange(2000)]) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in values], "score long").repartition(3)
    assert [licenses.nth_largest(df, n) for n in (0, 7, 250, 499)] == [sorted(values, reverse=True)[n] for n in (0, 7, 250, 499)]


def shuffled(spark) -> int:
    """Bytes that the session's tasks have written for shuffles so far."""
    context = spark._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    executors = context.statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_calibration_shuffles_no_words(spark):
    """What calibrates goes between tasks as a few bytes for each window, though most windows are likely ones, and leaves the licences as they are."""
    rng, cues = random.Random(11), " ".join(t for texts in licenses.TEMPLATES.values() for t in texts).split()
    line = lambda: " ".join([*rng.choices(cues, k=rng.randint(9, 60)), *rng.choice(licenses.TEMPLATES[rng.choice(list(licenses.TEMPLATES))]).split()[rng.randint(0, 4):]])
    docs = spark.createDataFrame([(i // 2, "\n".join(line() for _ in range(rng.randint(1, 4)))) for i in range(2000)] + [(7, None), (8, "")], "doc_id long, text string")
    before = shuffled(spark)
    licenses.LicenseModel(spark, docs.limit(0))
    start = shuffled(spark)
    own = licenses.LicenseModel(spark, docs, false_rate=0.0004)
    likely = licenses.windows(licenses.lines(docs), own)
    spent = shuffled(spark) - start - (start - before)
    assert likely.count() > 0.5 * own.judged > 5_000
    assert spent < 40 * own.judged

    own.cutoff, rows = 0.5, lambda df: sorted((r.doc_id, r.text_key, r.line, r.family, r.probability, r.overlap) for r in df.collect())
    want = rows(licenses.confirmed(own.predict(likely)).filter("family <> 'unknown'"))
    assert rows(own.granted()) == want and len(want) > 1_000
