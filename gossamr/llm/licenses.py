"""License scans: a trained classifier of paragraphs, in DataFrame and spark.ml functions only.

A paragraph is a line, a long one is taken in overlapping windows. Its words and pairs of words are a sparse vector, and a
multinomial logistic regression gives each licence family and "unknown" a probability, sharpened or flattened by a
temperature. A family is predicted if it is likeliest and its probability reaches a cutoff, and it counts only if the
paragraph shares enough pairs with a template of the family.

Temperature and cutoff come from a model that has not seen some templates of each family and some of the negatives:
the temperature from how it judges those, the cutoff so that at most a share of false_rate of what is judged is taken for a licence
falsely. Judged are the negatives not seen and every distinct window of every text of the corpus, none is sampled; false are those
negatives and windows that no template confirms and whose likeliest family reaches the cutoff. The model in use is then
fitted to all rows. One pass scores the windows with both models where they are made; equal ones are found by hashes of
their words, of 64 bits to count all and of 128 bits for the false ones, so no words are shuffled.

Every paragraph of every text is judged by the model. As it is linear, what a paragraph's features can add at most to any
family's lead over unknown is one sum over its words, and where that sum cannot make a family likely, the paragraph is
unknown by proof; the others, few, are scored in full. The training rows are made from the templates below by dropping
and surrounding words, and from texts that speak of related things without granting a licence; their number is a parameter.
"""

from __future__ import annotations

import math
import random

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.session import discard, materialize

#: Templates by family: notices and opening or characteristic sentences of the licences.
TEMPLATES = {
    "agpl": ["licensed under the gnu affero general public license version 3", "you should have received a copy of the gnu affero general public license along with this program", "spdx license identifier agpl 3.0 or later"],
    "apache": ["licensed under the apache license version 2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at apache.org licenses license 2.0", "distributed on an as is basis without warranties or conditions of any kind either express or implied", "spdx license identifier apache 2.0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "released under the bsd license", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "spdx license identifier bsd 3 clause"],
    "cc-by": ["this work is licensed under a creative commons attribution 4.0 international license", "licensed under cc by 4.0", "spdx license identifier cc by 4.0"],
    "cc-by-nc": ["this work is licensed under a creative commons attribution noncommercial 4.0 international license", "licensed under cc by nc 4.0", "spdx license identifier cc by nc 4.0"],
    "cc-by-sa": ["this work is licensed under a creative commons attribution sharealike 4.0 international license", "licensed under cc by sa 4.0", "text is available under the creative commons attribution sharealike license"],
    "cc0": ["dedicated to the public domain under the creative commons cc0 1.0 universal public domain dedication", "licensed under cc0 1.0", "to the extent possible under law the author has waived all copyright and related rights to this work"],
    "gpl": ["this work is licensed under the gnu general public license version 3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "released under the gpl", "spdx license identifier gpl 3.0 or later"],
    "lgpl": ["licensed under the gnu lesser general public license version 2.1", "this library is free software under the terms of the gnu lesser general public license", "spdx license identifier lgpl 2.1 or later"],
    "mit": ["released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "licensed under the mit license", "spdx license identifier mit"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2.0", "licensed under the mozilla public license version 2.0", "spdx license identifier mpl 2.0"],
    "proprietary": ["all rights reserved no part of this publication may be reproduced without prior written permission of the publisher", "copyright all rights reserved", "this software is proprietary and confidential unauthorized copying is strictly prohibited"],
    "unlicense": ["this is free and unencumbered software released into the public domain", "licensed under the unlicense"],
}
#: Sentences that hold cues but grant no licence.
NEGATIVES = [
    "she renewed her driving license at the office last week", "the license plate of the car was hard to read", "the city will license new taxi drivers next year", "copyright law is taught in the second term", "he wrote a book about the history of copyright", "the apache are a people of the southwest", "an apache helicopter landed near the town", "students at mit built a new robot", "the institute mit released a study on energy", "ask for permission before you enter the garden", "the warranty of the machine ends in may", "your permission is needed to open the file", "the general public was invited to the opening", "free software meetings are held every month", "public domain films are shown on sunday", "the foundation published its annual report", "fishing without a license is fined", "the gnu is a large antelope of the plains", "creative people share common attributes", "a mozilla event took place in the old hall", "the bsd conference is next year", "all rights and duties of the tenant are listed below", "reserved seats are at the front", "the terms of the contract were changed without notice",
]
UNKNOWN = "unknown"
#: Words of a window and of the step to the next one: any notice of up to WINDOW - STEP words lies whole in one.
WINDOW, STEP = 32, 8
#: Share of pairs that confirms a family; scores are whole numbers of 1 / UNITS.
LEAST, UNITS = 0.5, 10**9
#: Numbers of training rows made from each template, of negatives with random words; slots of the table that bounds scores.
VARIANTS, NOISE, SLOTS = 12, 200, 1 << 15
FILLER = ["the", "of", "and", "is", "was", "this", "file", "project", "work", "code", "see", "for", "details", "in", "by", "text", "data", "author", "page", "site", "with", "from", "they", "house", "water", "green", "note", "news", "year", "people"]


def training_rows(variants: int = VARIANTS, noise: int = NOISE, seed: int = 7) -> list[tuple[str, str, bool]]:
    """(text, family, held out): deterministic, len(templates) * variants + a bounded number of negatives.

    Held out are all rows of the last template of each family and of every fourth negative.
    """
    rng, rows = random.Random(seed), []

    def vary(text: str, drop: float) -> str:
        words = [w for w in text.split() if rng.random() > drop]
        return " ".join([*rng.choices(FILLER, k=rng.randint(0, 6)), *words, *rng.choices(FILLER, k=rng.randint(0, 6))])

    for family, texts in TEMPLATES.items():
        for k, text in enumerate(texts):
            rows += [(text if i == 0 else vary(text, 0.12), family, k == len(texts) - 1) for i in range(variants)]
    for k, text in enumerate(NEGATIVES):
        rows += [(text if i == 0 else vary(text, 0.12), UNKNOWN, k % 4 == 3) for i in range(variants)]
    rows += [(" ".join([*rng.choices(FILLER, k=rng.randint(3, 20)), rng.choice(["license", "copyright", "permission", "warranty", "licensed", "permitted"])]), UNKNOWN, i % 4 == 3) for i in range(noise)]
    return rows


def grams(text: Column) -> Column:
    """Words of a text: letters and digits, with decimal parts."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+(?:[.][0-9]+)*)"), F.lit(1))


def with_grams(df: DataFrame, text: str) -> DataFrame:
    """df with _words and _pairs (arrays of strings)."""
    return with_pairs(df.withColumn("_words", grams(F.col(text))))


def with_pairs(df: DataFrame) -> DataFrame:
    """df (_words and others) with _pairs."""
    return df.withColumn("_pairs", F.expr("CASE WHEN size(_words) < 2 THEN cast(array() as array<string>) ELSE transform(sequence(0, size(_words) - 2), i -> concat(_words[i], ' ', _words[i + 1])) END"))


def _let(value: Column, body) -> Column:
    """body(x) with x bound to value, so that it is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def slot(word: Column, following: Column | None = None) -> Column:
    """The slot of a word, or of a pair of words; that of a pair without a second word is the word's."""
    return F.pmod(F.xxhash64(word) if following is None else F.xxhash64(word, following), F.lit(SLOTS)).cast("int")


def _all_starts(n: Column) -> Column:
    """Starts of the windows of n words: one of up to WINDOW words, else overlapping ones."""
    return F.when(n <= WINDOW, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.greatest(n - WINDOW + STEP - 1, F.lit(0)), F.lit(STEP)))


class LicenseModel:
    """The fitted classifier with its temperature and cutoff, and the table that bounds scores."""

    def __init__(self, spark: SparkSession, corpus: DataFrame | None = None, variants: int = VARIANTS, noise: int = NOISE, false_rate: float = 0.002):
        self.names = [UNKNOWN, *TEMPLATES]
        rows = [(text, float(self.names.index(family)), held) for text, family, held in training_rows(variants, noise)]
        data = with_grams(spark.createDataFrame(rows, "text string, label double, held boolean").coalesce(1), "text").withColumn("_grams", F.concat("_words", "_pairs")).cache()
        self.held, (self.counting, self.model) = self._fit(data.filter("not held")), self._fit(data)
        known = [(r.raw, int(r.label)) for r in self._raw(data.filter("held"), self.held).select("raw", "label").collect()]
        data.unpersist()
        self.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=lambda t: sum(-math.log(max(1e-12, self._softmax(raw, t)[y])) for raw, y in known))
        best = [(max(range(len(raw)), key=raw.__getitem__), y) for raw, y in known]
        self.accuracy = sum(x == y for x, y in best) / len(best)
        self._bound()
        wrong = spark.createDataFrame([(int(max(self._softmax(raw, self.temperature)) * UNITS),) for (raw, y), (x, _) in zip(known, best, strict=True) if y == 0 and x > 0], "score long").coalesce(1)
        self.judged, self.taken = sum(y == 0 for _, y in known), None
        if corpus is not None:
            self.judged += windows(lines(corpus), keys=True).distinct().count()
            self.taken = materialize(self._taken(windows(lines(corpus), self)), "license-windows")  # scan() reads them again
            false = self.taken.filter("score IS NOT NULL").groupBy("_key", "_other").agg(F.max("score").alias("score"))
            wrong = materialize(wrong.unionByName(false.select("score")), "license-scores")
        # the likeliest of all classes has at least the probability of chance, so that as a cutoff takes nothing away
        n = int(false_rate * self.judged)
        self.cutoff = (nth_largest(wrong, n) + 1) / UNITS if wrong.count() > n else 1 / len(self.names)
        if corpus is not None:
            discard(wrong)

    def _taken(self, paragraphs: DataFrame) -> DataFrame:
        """Of paragraphs (doc_id, text_key, line, _words, _pairs) those that count: with family, probability and overlap those
        that the model in use takes for a family and a template of it confirms, with score (else null) those that the model
        that has not seen all rows takes for a family and no template confirms. _key and _other tell their words apart.

        Each is scored where it is made and words stay there; what goes on has the same few bytes for each.
        """
        rows = self._likeliest(self._likeliest(paragraphs, "_held", self.held), "_own").filter((F.col("_held.best") > 0) | (F.col("_own.best") > 0))
        rows = rows.crossJoin(F.broadcast(template_pairs(paragraphs.sparkSession).agg(F.collect_list("_pairs").alias("_templates"))))
        score = F.when((F.col("_held.best") > 0) & (shared() < LEAST), F.floor(UNITS / F.col("_held.total")).cast("long"))
        rows = rows.select("doc_id", "text_key", "line", F.xxhash64("_words").alias("_key"), F.xxhash64(F.lit(UNKNOWN), "_words").alias("_other"), score.alias("score"), self._name("_own").alias("family"), (1 / F.col("_own.total")).alias("probability"), "_pairs")
        return confirmed(rows).drop("_pairs").filter((F.col("family") != UNKNOWN) | F.col("score").isNotNull())

    def granted(self) -> DataFrame:
        """(doc_id, text_key, line, family, probability, overlap) of the windows of the corpus that grant a licence."""
        return self.taken.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= self.cutoff)).select("doc_id", "text_key", "line", "family", "probability", "overlap")

    @staticmethod
    def _fit(rows: DataFrame):
        counting = CountVectorizer(inputCol="_grams", outputCol="_features", minDF=2, binary=True).fit(rows)
        regression = LogisticRegression(featuresCol="_features", labelCol="label", rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction", regParam=0.002, maxIter=40, family="multinomial")
        return counting, regression.fit(counting.transform(rows))

    def _raw(self, rows: DataFrame, fitted: tuple | None = None) -> DataFrame:
        counting, model = fitted or (self.counting, self.model)
        return model.transform(counting.transform(rows)).withColumn("raw", vector_to_array("_raw"))

    def _bound(self) -> None:
        """gains: by slot, the most that features there add to any family's lead over unknown, as shares of the lead that it
        takes to be likelier than unknown, in either model (the one in use and the one that has not seen all rows); need: the
        sum of gains below which neither can find a family likeliest.
        """
        spark, gains, needs = SparkSession.active(), [0.0] * SLOTS, []
        for counting, model in (self.held, (self.counting, self.model)):
            weights, offsets = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
            lead, own = (weights[1:] - weights[0]).max(axis=0).tolist(), [0.0] * SLOTS
            needs.append(-float((offsets[1:] - offsets[0]).max()) - 1e-6)
            features = spark.createDataFrame([(i, *[*x.split(" "), None][:2]) for i, x in enumerate(counting.vocabulary)], "i int, a string, b string").coalesce(1)
            for i, at in features.select("i", slot(F.col("a"), F.col("b"))).collect():
                own[at] += max(0.0, lead[i])
            gains = [max(x, y / max(needs[-1], 1e-9)) for x, y in zip(gains, own, strict=True)]
        unit = max(*gains, 1e-9) / 127  # gains are kept in a byte each, rounded up
        self.gains, self.need = bytearray(min(127, math.ceil(x / unit)) for x in gains), math.floor(1 / unit) if min(needs) > 0 else 0

    def starts(self, words: Column) -> Column:
        """Starts of the windows of a column of words that the model may predict to be a licence; it would none of the others."""
        n, gain = F.size(words), lambda at: F.ascii(F.substring(F.lit(self.gains), at + 1, F.lit(1)).cast("string"))
        each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: gain(slot(F.get(words, i))) + gain(slot(F.get(words, i), F.get(words, i + 1))))
        total = lambda x: F.aggregate(x, F.lit(0), lambda a, y: a + y)
        # sums by steps, then of the steps of each window
        steps = lambda g: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / STEP).cast("int")), lambda j: total(F.slice(g, j * STEP + 1, F.lit(STEP))))
        lead = lambda c, at: sum((F.coalesce(F.get(c, F.floor(at / STEP).cast("int") + k), F.lit(0)) for k in range(WINDOW // STEP)), F.lit(0))
        some = _let(_let(each, steps), lambda c: F.when(total(c) >= self.need, F.filter(_all_starts(n), lambda at: lead(c, at) >= self.need)))
        return F.when(n > 0, some)

    @staticmethod
    def _softmax(raw: list[float], t: float) -> list[float]:
        top = max(raw)
        e = [math.exp((x - top) / t) for x in raw]
        return [x / sum(e) for x in e]

    def predict(self, paragraphs: DataFrame) -> DataFrame:
        """paragraphs (_words, _pairs and others) with family and probability; family is unknown below the cutoff."""
        probability = 1 / F.col("_own.total")
        family = F.when(probability >= self.cutoff, self._name("_own")).otherwise(UNKNOWN)
        return self._likeliest(paragraphs, "_own").select(*[c for c in paragraphs.columns if c not in ("family", "probability")], family.alias("family"), probability.alias("probability"))

    def _name(self, at: str) -> Column:
        """The name of the class that a column of _likeliest() holds."""
        return F.get(F.array(*map(F.lit, self.names)), F.col(at).best)

    def _likeliest(self, paragraphs: DataFrame, name: str, fitted: tuple | None = None) -> DataFrame:
        """paragraphs (_words, _pairs and others) with a column of best, the number of the likeliest class, and total, by which
        1 is divided for its probability.
        """
        rows = self._raw(paragraphs.withColumn("_grams", F.concat("_words", "_pairs")), fitted).withColumn("_top", F.array_max("raw"))
        best = F.expr("array_position(raw, _top) - 1").cast("int").alias("best")
        total = F.expr(f"aggregate(raw, 0D, (a, x) -> a + exp((x - _top) / {self.temperature}D))").alias("total")
        # exploded, so that filters are not pushed below and the model is not applied a second time for them
        return rows.select(*paragraphs.columns, F.explode(F.array(F.struct(best, total))).alias(name))


def template_pairs(spark: SparkSession) -> DataFrame:
    """(family, _pairs) of each template."""
    return with_grams(spark.createDataFrame([(f, t) for f, texts in TEMPLATES.items() for t in texts], "family string, t string").coalesce(1), "t").select("family", "_pairs")


def nth_largest(scores: DataFrame, n: int) -> int:
    """The score (long, 0 to UNITS) that n others come before in descending order; at most about a thousand counts are collected at a time."""
    width, within = UNITS, F.lit(True)
    while width > 1:
        width //= 1000
        at = F.floor(F.col("score") / width).cast("long")
        for r in sorted(scores.filter(within).groupBy(at.alias("at")).agg(F.count("*").alias("rows")).collect(), reverse=True):
            if n < r.rows:
                break
            n -= r.rows
        within = at == r.at
    return r.at


def shared() -> Column:
    """The largest share of the pairs of one of _templates or, if fewer, of _pairs that both hold; 0 without templates."""
    share = "array_max(transform(_templates, t -> size(array_intersect(t, _pairs)) / cast(greatest(1, least(size(array_distinct(t)), size(array_distinct(_pairs)))) as double)))"
    return F.coalesce(F.expr(share), F.lit(0.0))


def confirmed(predicted: DataFrame, least: float = LEAST) -> DataFrame:
    """predicted (family, _pairs and others) with overlap: the largest share of a template's or, if fewer, of the
    paragraph's pairs that both hold, over the family's templates; families under `least` become unknown.
    """
    table = template_pairs(predicted.sparkSession).groupBy("family").agg(F.collect_list("_pairs").alias("_templates"))
    joined = predicted.join(F.broadcast(table), "family", "left").withColumn("overlap", shared())
    return joined.withColumn("family", F.when(F.col("overlap") >= least, F.col("family")).otherwise(UNKNOWN)).drop("_templates")


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line, _paragraph): the lines of each document; text_key: hash of the text."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line", "_paragraph"))


def windows(paragraphs: DataFrame, model: LicenseModel | None = None, keys: bool = False) -> DataFrame:
    """paragraphs (_paragraph and others) in windows of _words and _pairs: one of up to WINDOW words whole, a longer one
    in overlapping windows; with a model only those that it may predict to be a licence. With keys only the hash of the
    words of each window that has any, as _key.
    """
    rows = paragraphs.withColumn("_all", grams(F.col("_paragraph"))).drop("_paragraph")
    if keys:
        cut = rows.select("_all", F.explode(F.when(F.size("_all") > 0, _all_starts(F.size("_all")))).alias("_at"))
        return cut.select(F.xxhash64(F.slice("_all", F.col("_at") + 1, F.lit(WINDOW))).alias("_key"))
    starts = _all_starts(F.size("_all")) if model is None else model.starts(F.col("_all"))
    cut = rows.select("*", F.explode(starts).alias("_at"))
    return with_pairs(cut.withColumn("_words", F.slice("_all", F.col("_at") + 1, F.lit(WINDOW))).drop("_all", "_at"))


def scan(docs: DataFrame, model: LicenseModel | None = None) -> DataFrame:
    """(doc_id, text_key, line, family, probability, overlap) of each line of docs (doc_id, text) and licence it grants.

    A line's windows are classified one by one; a family that several of them show has the figures of the likeliest.
    Null and empty texts have no lines that grant one. Rows of equal id and text give the same lines once; an id with
    several texts has those of each. An empty table gives an empty one. Other columns are left out.
    """
    if model is None:
        found = LicenseModel(docs.sparkSession, docs).granted()
    else:
        likely = model.predict(windows(lines(docs), model)).filter(F.col("family") != UNKNOWN)
        found = confirmed(likely).filter(F.col("family") != UNKNOWN)
    best = found.groupBy("doc_id", "text_key", "line", "family").agg(F.max(F.struct("probability", "overlap")).alias("_m"))
    return best.select("doc_id", "text_key", "line", "family", "_m.probability", "_m.overlap")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_licenses (lines), families (sorted, distinct) and family (that of highest probability, else unknown) of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = [F.count_distinct("line").alias("n_licenses"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"), F.max_by("family", F.struct("probability", "family")).alias("family"), F.max("probability").alias("probability")]
    by_doc = scan(docs).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(*found)
    rows = docs.select("doc_id", F.xxhash64("text").alias("_text_key"))
    joined = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    return joined.select("doc_id", F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"), F.coalesce("families", F.lit("")).alias("families"), F.coalesce("family", F.lit(UNKNOWN)).alias("family"), F.round("probability", 6).alias("probability"))
