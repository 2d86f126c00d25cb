"""Quality rules with risk-controlled cutoffs.

Each rule compares one measure of a text with a cutoff from a grid that is fixed beforehand. The labelled documents of a
stratum (language), of which those of one text count once, are split by a hash of the text. From the smaller part a path is designed: steps that make one rule
after the other stricter, those first that reject the smallest share of good documents, so that what a step rejects
contains what the steps before it do. The larger part is the holdout: the path is walked, and a step counts as
certified while an exact binomial test rejects "more than alpha of the good documents fail this step or one before".
A fixed sequence of nested tests needs no correction, and since the union of the rules is tested, alpha is shared by
all rules. Over the strata the level delta is divided (Bonferroni), so that with probability 1 - delta no stratum loses
more than alpha of its good documents. Strata whose holdout is too small for any certificate, which their number of
good documents tells beforehand, are pooled to one stratum; if that is too small as well, only the base rules hold there.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gossamr.llm.common import WordHashes, append, field, ngram_hashes, words_of
from gossamr.session import materialize, sized

#: Rules: measure (a ratio of the columns of MEASURES), side on which it fails, cutoffs from lenient to strict.
RULES = [
    ("symbol_ratio", ">", [3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05]),
    ("dup_line_ratio", ">", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    ("repeat_ratio", ">", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    ("long_word_mean", ">", [40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.5, 9.0]),
    ("short_word_mean", "<", [1.0, 1.5, 2.0, 2.5, 3.0, 3.25, 3.5]),
    ("upper_ratio", ">", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15]),
    ("bang_ratio", ">", [2.0, 1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05]),
]
#: Columns that measure() appends.
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bangs"]
#: One in DESIGN labelled documents designs the paths, the others are the holdout.
DESIGN = 3
#: Languages that can be a stratum of their own, those of most labels, and the name of the stratum that all others share.
LANGUAGES, POOL = 200, "*"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def _measure_one(text: str | None, hashes: WordHashes) -> tuple[int, ...]:
    if not text:
        return (0,) * len(MEASURES)
    words = words_of(text)
    n, repeated = len(words), 0
    if n >= 4:
        grams = ngram_hashes(hashes.of(words), 3)
        order = np.argsort(grams)
        same = grams[order[1:]] == grams[order[:-1]]
        if same.any():
            twice = np.zeros(len(grams), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            covered = np.zeros(n, bool)
            at = np.nonzero(twice)[0]
            covered[at] = covered[at + 1] = covered[at + 2] = True
            repeated = int(covered.sum())
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            if line in seen:
                again += 1
            seen.add(line)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    letters = upper + int(((raw >= 97) & (raw <= 122)).sum())
    return n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), again, repeated, lines, upper, letters, text.count("!")


def measure(docs: DataFrame) -> DataFrame:
    """docs (text and any other columns) with MEASURES appended; null and empty texts give zeros."""

    def start():
        hashes = WordHashes()
        return lambda texts: [list(x) for x in zip(*[_measure_one(t, hashes) for t in texts], strict=True)]

    return append(docs, ["text"], [field(c, "long") for c in MEASURES], start)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ratio(name: str) -> Column:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / words,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "repeat_ratio": F.col("n_repeat_words") / words,
        "long_word_mean": F.col("word_chars") / words,
        "short_word_mean": F.col("word_chars") / words,
        "upper_ratio": F.col("n_upper") / F.greatest("n_letters", F.lit(1)),
        "bang_ratio": F.col("n_bangs") / words,
    }[name]


def _fails(rule: str, side: str, cutoff: Column) -> Column:
    return _ratio(rule) > cutoff if side == ">" else _ratio(rule) < cutoff


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exactly, summed in logarithms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def needed(alpha: float, delta: float) -> int:
    """Good documents of the least holdout that can certify anything: none of them may fail."""
    return math.ceil(math.log(delta) / math.log1p(-alpha))


def design(good: dict[str, list[int]], bad: dict[str, list[int]], weight: float) -> list[tuple[str, int]]:
    """The path (rule, place in its grid) of a stratum. good, bad: documents of each kind that fail each cutoff, by rule.

    A rule's cutoff is a step if it rejects more bad documents, net of `weight` times the good ones, than all more
    lenient ones of the rule.
    """
    steps = []
    for rule, _, grid in RULES:
        best = 0.0
        for i in range(len(grid)):
            if (gain := bad[rule][i] - weight * good[rule][i]) > best:
                best = gain
                steps.append((good[rule][i], i / len(grid), rule, i))
    return [(rule, i) for _, _, rule, i in sorted(steps)]


def strata_of(good: dict[str | None, int], alpha: float, delta: float, others: int = 0) -> tuple[dict[str | None, str | None], float]:
    """Which languages make which stratum (POOL: the pooled one; languages left out get no cutoffs), and each test's level.

    good: good documents of the holdout by language; others: those of all further languages, that can only be pooled.
    Only these numbers decide, not which documents fail.
    """
    own = [x for x, n in good.items() if n >= needed(alpha, delta / max(1, len(good)))]
    rest = [x for x in good if x not in own]
    level = delta / (len(own) + (1 if rest or others else 0)) if good else delta
    pooled = rest if others + sum(good[x] for x in rest) >= needed(alpha, level) else []
    return {x: x for x in own} | dict.fromkeys(pooled, POOL), level


def certified(failed: list[int], n: int, alpha: float, level: float) -> int:
    """How many steps of a path are certified. failed: good documents of n that fail each step or one before it."""
    for i, k in enumerate(failed):
        if n == 0 or binomial_tail(k, n, alpha) > level:
            return i
    return len(failed)


def _levels(rule: str, side: str, grid: list[float]) -> Column:
    """How many cutoffs of a rule's grid a document passes: the lenient ones, as it fails all after the first that it fails."""
    ratio = _ratio(rule)
    return F.size(F.filter(F.array(*map(F.lit, grid)), lambda c: ratio <= c if side == ">" else ratio >= c))


def _first_failed(path: list[tuple[str, int]]) -> Column:
    """The place of the first step of a path that a document (its levels in columns _level_<rule>) fails, or the path's length."""
    firsts = [F.lit(len(path))]
    for rule, _, grid in RULES:
        place = [min((at for at, (r, i) in enumerate(path) if r == rule and i >= level), default=len(path)) for level in range(len(grid) + 1)]
        if place[0] < len(path):
            firsts.append(F.get(F.array(*map(F.lit, place)), F.col(f"_level_{rule}")))
    return F.least(*firsts) if len(firsts) > 1 else firsts[0]


def _among(languages: list) -> Column:
    """Whether a row's language is one of a list, that may hold null."""
    named = [x for x in languages if x is not None]
    return F.coalesce(F.col("lang").isin(named), F.lit(False)) | (F.col("lang").isNull() if None in languages else F.lit(False))


def _texts(labelled: DataFrame) -> DataFrame:
    """The labelled texts that the base rules keep: a row for each text of a language, good if none of its labels is bad."""
    key = F.col("text_key") if "text_key" in labelled.columns else F.xxhash64("text")
    rows = labelled.filter(F.col("quality").isin(0, 1) & ~base_failed())
    once = rows.groupBy("lang", key.alias("_text"), *MEASURES).agg((F.min("quality") == 1).alias("_good"))
    return once.select("lang", "_good", (F.pmod(F.xxhash64("_text"), F.lit(DESIGN)) == 0).alias("_design"), *[_levels(*r).alias(f"_level_{r[0]}") for r in RULES])


def fit(labelled: DataFrame, alpha: float = 0.05, delta: float = 0.05, weight: float = 5.0) -> dict[str | None, dict[str, float]]:
    """Cutoffs by language, of the LANGUAGES with most labels. labelled: doc_id, text or text_key (its hash), MEASURES,
    lang, quality (1 good, 0 bad); null quality is left out. See cutoff_table() for all languages.
    """
    return _fitted(_texts(labelled), alpha, delta, weight)[0]


def cutoff_table(labelled: DataFrame, alpha: float = 0.05, delta: float = 0.05, weight: float = 5.0) -> DataFrame:
    """(_stratum: language, _cut_<rule>) of every language with cutoffs: those of fit(), and all further ones as pooled."""
    rows = materialize(_texts(labelled), "quality-texts")
    cutoffs, known, pooled = _fitted(rows, alpha, delta, weight)
    table = _table(labelled.sparkSession, cutoffs)
    if pooled is None:
        return table
    further = rows.filter(F.col("_good") & ~F.col("_design") & ~_among(known)).select(F.col("lang").alias("_stratum")).distinct()
    return table.unionByName(further.select("_stratum", *[F.lit(pooled.get(rule)).cast("double").alias(f"_cut_{rule}") for rule, _, _ in RULES]))


def _table(spark: SparkSession, cutoffs: dict[str | None, dict[str, float]]) -> DataFrame:
    schema = T.StructType([T.StructField("_stratum", T.StringType()), *[T.StructField(f"_cut_{rule}", T.DoubleType()) for rule, _, _ in RULES]])
    return spark.createDataFrame([(lang, *[cut.get(rule) for rule, _, _ in RULES]) for lang, cut in cutoffs.items()], schema)


def _fitted(rows: DataFrame, alpha: float, delta: float, weight: float) -> tuple[dict, list, dict | None]:
    """Cutoffs by language, the languages looked at one by one, and the cutoffs of all others, if they are pooled.

    Aggregations over all labelled texts. To the driver come the number of good texts of each of the LANGUAGES that have
    most and of all others together, and of strata a row of counts for each rule and level, and for each step.
    """
    good = rows.filter("_good and not _design")
    held = good.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    known = [r["lang"] for r in held]
    others = good.filter(~_among(known)).count() if len(held) == LANGUAGES else 0
    strata, level = strata_of({r["lang"]: r["n"] for r in held}, alpha, delta, others)
    own = [x for x in strata if strata[x] != POOL]
    pool = [x for x in strata if strata[x] == POOL]
    small = sum(r["n"] for r in held if r["lang"] not in own)
    use_rest = others > 0 and others + small >= needed(alpha, level)
    is_pooled = _among(pool) | (~_among(known) if use_rest else F.lit(False))
    names = [*own, *([POOL] if pool or use_rest else [])]
    place = F.when(is_pooled, F.lit(len(own)))
    for k, name in enumerate(own):
        place = F.when(F.col("lang").eqNullSafe(F.lit(name)), F.lit(k)).otherwise(place)
    rows = rows.withColumn("_stratum", place).filter("_stratum is not null")
    each = rows.filter("_design").select("_stratum", "_good", F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"_level_{rule}").alias("level")) for rule, _, _ in RULES])).alias("_x"))
    found = each.groupBy("_stratum", "_good", "_x.rule", "_x.level").agg(F.count("*").alias("n")).collect()
    total = lambda k, good: {rule: [sum(r["n"] for r in found if r["rule"] == rule and r["level"] <= i and r["_good"] == good and r["_stratum"] == k) for i in range(len(grid))] for rule, _, grid in RULES}
    paths = [design(total(k, True), total(k, False), weight) for k in range(len(names))]
    none = {} if use_rest else None
    if not any(paths):
        return {lang: {} for lang in strata}, known, none
    first = F.lit(0)
    for k, path in enumerate(paths):
        first = F.when(F.col("_stratum") == k, _first_failed(path)).otherwise(first)
    judged = rows.filter("not _design").withColumn("_first", first)
    tally = {(r["_stratum"], r["_first"]): (r["good"], r["bad"]) for r in judged.groupBy("_stratum", "_first").agg(F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad")).collect()}
    out: dict = {}
    for k, (name, path) in enumerate(zip(names, paths, strict=True)):
        each = [tally.get((k, i), (0, 0)) for i in range(len(path) + 1)]
        lost, caught = ([sum(x[j] for x in each[: i + 1]) for i in range(len(path))] for j in (0, 1))
        steps = certified(lost, sum(x[0] for x in each), alpha, level)
        best = max(range(steps), key=lambda i: (caught[i] - weight * lost[i], -i), default=-1)
        cutoffs = {rule: dict((r, g) for r, _, g in RULES)[rule][i] for rule, i in path[: best + 1]}
        out |= {name: cutoffs} if k < len(own) else dict.fromkeys(pool, cutoffs)
        none = cutoffs if use_rest and k == len(own) else none
    return out, known, none


def judge(measured: DataFrame, cutoffs: dict[str | None, dict[str, float]] | DataFrame) -> DataFrame:
    """measured (lang, MEASURES and other columns) with base_failed and kept appended. cutoffs: from fit() or cutoff_table().

    Languages without cutoffs keep all that the base rules keep.
    """
    table = _table(measured.sparkSession, cutoffs) if isinstance(cutoffs, dict) else materialize(cutoffs, "quality-cutoffs")
    joined = measured.join(sized(table), F.col("lang").eqNullSafe(F.col("_stratum")), "left")
    fails = F.lit(False)
    for rule, side, _ in RULES:
        fails = fails | F.coalesce(_fails(rule, side, F.col(f"_cut_{rule}")), F.lit(False))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~fails).drop(*table.columns)


def with_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs that have a label; of several labels for a doc_id the lowest quality counts."""
    one = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    return docs.drop("quality").join(sized(one), "doc_id")


def filter_documents(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """The rows of docs (doc_id, text, lang and others) that the rules keep, with their columns as they were.

    Null and empty texts are rejected. Rows that repeat are judged alike; of several labels of an id the lowest counts
    for all its rows. An empty table gives an empty one; columns with the names of measures stay as they are.
    """
    cutoffs = cutoff_table(measure(with_quality(docs.select("doc_id", "text", "lang"), labels)), alpha, delta)
    renamed = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c not in ("text", "lang")}
    measured = measure(docs.select("text", "lang", *[F.col(f"`{c}`").alias(name) for c, name in renamed.items()]))
    return judge(measured, cutoffs).filter("kept").select(*[F.col(renamed.get(c, c)).alias(c) for c in docs.columns])


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base measures, base_failed and kept for every document.

    Null and empty texts have no words and fail. An empty table gives an empty one; without labels only the base
    rules reject. A repeated row is judged again, with the same result, and changes no cutoff.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    measured = materialize(measure(docs).withColumn("text_key", F.xxhash64("text")).drop("text"), "quality-measures")
    cutoffs = cutoff_table(with_quality(measured, labels))
    return judge(measured, cutoffs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
