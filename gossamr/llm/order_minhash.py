"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text is a sequence of k-mers of tokens (words; single letters of scripts without spaces). The j-th occurrence of a
k-mer in the text is the pair (k-mer, j), and gets one 63-bit hash. Its top bits deal the pairs to BUCKETS buckets; in
each bucket the L pairs of least hash are selected, put back in text order, and the tuple of their k-mers is hashed.
The chance that two texts agree in a bucket falls with reordering as well as with replacement of k-mers, as their edit
distance does (Marcais et al., 2019; one permutation, split into buckets, stands for their many).

Everything is computed within the row by sorting arrays of packed longs: no shuffle, no Python. Where the next
document is needed, texts are dealt to ranges of ids (one shuffle), each sorted by itself; the first document of each
range is sent along to the range before it, as a row of that range. What is broadcast are the ranges' bounds: numbers,
and a bounded number of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gossamr.session import materialize, sized

#: Tokens of a k-mer; pairs selected in a bucket are L = 2.
K = 3
#: log2 of the number of buckets.
BUCKET_BITS = 6
#: Bits of a packed long that hold the place in the text (places beyond wrap around).
PLACE_BITS = 26
#: A token: a letter of a script written without spaces, or a run of other characters without white space.
TOKEN = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]|[^\s\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]+"
#: Documents in a range of ids, about, but for so large tables that there would be more than RANGES ranges.
RANGE_ROWS, RANGES = 2000, 500_000
#: Ranges whose bounds the driver knows; each is divided further evenly.
COARSE = 256


def add_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with column `name`: an array of ints, (bucket << 16) + 16 bits of the tuple's hash for each bucket in use.

    Empty and blank texts give an empty array; null text gives null.
    """
    mask, top = (1 << PLACE_BITS) - 1, 63 - BUCKET_BITS
    keep = df.columns
    label = lambda x, occurrence: f"(shiftrightunsigned(xxhash64(shiftright({x}, {PLACE_BITS}), {occurrence}), 1) & {~mask}L) | ({x} & {mask}L)"
    kmer = ", ".join(f"_tokens[i + {j}]" for j in range(K))
    out = df.withColumn("_tokens", F.expr(f"regexp_extract_all({text}, r'{TOKEN}', 0)"))
    out = out.withColumn("_kmers", F.expr(f"CASE WHEN size(_tokens) = 0 THEN cast(array() as array<bigint>) WHEN size(_tokens) < {K} THEN array(xxhash64(_tokens)) ELSE transform(sequence(0, size(_tokens) - {K}), i -> xxhash64({kmer})) END"))
    out = out.withColumn("_packed", F.expr(f"sort_array(transform(_kmers, (h, i) -> shiftleft(h, {PLACE_BITS}) | (i & {mask})))")).drop("_tokens")
    same = f"shiftright(x, {PLACE_BITS}) = shiftright(get(_packed, j - 1), {PLACE_BITS})"
    out = out.withColumn("_again", F.expr(f"filter(_packed, (x, j) -> j > 0 AND {same})"))
    out = out.withColumn("_groups", F.expr(f"CASE WHEN size(_again) = 0 THEN cast(array() as array<int>) ELSE filter(sequence(0, size(_again) - 1), e -> e = 0 OR shiftright(_again[e], {PLACE_BITS}) <> shiftright(get(_again, e - 1), {PLACE_BITS})) END"))
    first = f"transform(filter(_packed, (x, j) -> j = 0 OR NOT ({same})), x -> {label('x', '0')})"
    later = f"flatten(transform(_groups, (s, g) -> transform(slice(_again, s + 1, coalesce(get(_groups, g + 1), size(_again)) - s), (x, o) -> {label('x', 'o + 1')})))"
    out = out.withColumn("_labels", F.expr(f"sort_array(concat({first}, {later}))"))
    out = out.withColumn("_chosen", F.expr(f"filter(_labels, (x, j) -> j < 2 OR shiftright(get(_labels, j - 2), {top}) <> shiftright(x, {top}))"))
    place = lambda e: f"cast(get(_chosen, {e}) & {mask}L as int)"
    pair = f"xxhash64(_kmers[least({place('e')}, {place('e + 1')})], _kmers[greatest({place('e')}, {place('e + 1')})])"
    value = f"CASE WHEN shiftright(get(_chosen, e + 1), {top}) = shiftright(_chosen[e], {top}) THEN {pair} ELSE xxhash64(_kmers[{place('e')}]) END"
    heads = f"filter(sequence(0, size(_chosen) - 1), e -> e = 0 OR shiftright(_chosen[e], {top}) <> shiftright(get(_chosen, e - 1), {top}))"
    entries = f"transform({heads}, e -> cast(shiftleft(shiftright(_chosen[e], {top}), 16) | (({value}) & 65535L) as int))"
    out = out.withColumn(name, F.expr(f"CASE WHEN {text} IS NULL THEN NULL WHEN size(_chosen) = 0 THEN cast(array() as array<int>) ELSE {entries} END"))
    return out.select(*keep, name)


def likeness(a: str, b: str) -> Column:
    """Share of the buckets in use in either fingerprint in which both agree; two empty fingerprints are alike."""
    used = f"size(array_union(transform({a}, x -> shiftright(x, 16)), transform({b}, x -> shiftright(x, 16))))"
    return F.expr(f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1.0D ELSE size(array_intersect({a}, {b})) / cast({used} as double) END")


def as_text(a: str) -> Column:
    """A fingerprint as hexadecimal text, six digits a bucket."""
    return F.expr(f"array_join(transform({a}, x -> lpad(lower(hex(x)), 6, '0')), '')")


def _ranges(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with _b, _s (range, in descending order of documents) and _tie."""
    n, missing = docs.select(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    size = max(RANGE_ROWS, n // RANGES)
    coarse = max(1, min(COARSE, n // size))
    at = docs.select(F.percentile_approx("doc_id", [i / coarse for i in range(1, coarse)] or [1.0], 10_000), F.min("doc_id"), F.max("doc_id")).first()
    low, high = (at[1], at[2]) if at[1] is not None else (0, 0)
    bounds = sorted({low, *(at[0] or []), high + 1}) if coarse > 1 else [low, high + 1]
    fine = max(1, math.ceil((n - missing) / max(1, len(bounds) - 1) / size))
    table = "array(" + ", ".join(f"{b}L" for b in bounds) + ")"
    b = F.when(F.col("doc_id").isNull(), -1).otherwise(F.expr(f"size(filter({table}, x -> x <= doc_id)) - 1"))
    lower, upper = F.expr(f"get({table}, _b)"), F.expr(f"get({table}, _b + 1)")
    share = (F.col("doc_id") - lower).cast("double") / (upper - lower).cast("double")
    null_bits = max(0, math.ceil(math.log2(max(1, missing / size))))
    none = F.shiftright(F.shiftright("_tie", 1), 63 - null_bits).cast("int") if null_bits else F.lit(0)
    return docs.withColumns({"_b": b.cast("int"), "_tie": F.xxhash64("text")}).withColumn("_s", F.when(F.col("doc_id").isNull(), none).otherwise(F.floor(share * fine).cast("int")))


def with_next(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the next document, descending by doc_id: next_text, and fingerprints fp and next_fp.

    After the last document comes the first. Null text counts as empty. Rows of the same id follow by a hash of the
    text; null ids come last. All rows of one id but null are in one range.
    """
    rows = _ranges(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    tops = rows.groupBy("_b", "_s").agg(F.max(F.struct(F.col("doc_id").alias("d"), F.col("_tie").alias("t"))).alias("top"))
    tops = materialize(tops.select(F.col("_b").alias("b"), F.col("_s").alias("s"), F.col("top.d").alias("d"), F.col("top.t").alias("t")), "omh-ranges")
    order = Window.orderBy(F.desc("b"), F.desc("s"))  # of at most some RANGES rows of numbers
    place = F.struct("b", "s")
    ring = F.coalesce(F.lag(place).over(order), F.last(place).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    tops = materialize(tops.select("*", ring.alias("before")).select("b", "s", "d", "t", F.col("before.b").alias("to_b"), F.col("before.s").alias("to_s")), "omh-chain")
    heads = rows.join(sized(tops), (F.col("_b") == F.col("b")) & (F.col("_s") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("_tie") == F.col("t")))
    heads = heads.select("text", F.col("to_b").alias("_b"), F.col("to_s").alias("_s")).dropDuplicates(["_b", "_s"])
    both = rows.withColumn("_sent", F.lit(False)).unionByName(heads.withColumn("_sent", F.lit(True)), allowMissingColumns=True)
    # fingerprints are made after the shuffle and so need not be moved
    dealt = add_fingerprint(both.repartition("_b", "_s"), "text", "fp")
    within = Window.partitionBy("_b", "_s").orderBy("_sent", F.desc_nulls_last("doc_id"), F.desc("_tie"), F.desc("text"))
    led = dealt.withColumn("_next", F.lead(F.struct("text", "fp")).over(within)).filter("not _sent")
    return led.select("doc_id", "text", "fp", F.col("_next.text").alias("next_text"), F.col("_next.fp").alias("next_fp"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses.

    Repeated rows are documents of their own. An empty table gives an empty one; a single document is its own next.
    """
    rows = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("_cut", F.floor(F.col("n_chars") / 3).cast("int"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars as int) - _cut), substring(next_text, 1, _cut))"))
    rows = add_fingerprint(rows.select("doc_id", "n_chars", "fp", "next_fp", "edited"), "edited", "edited_fp")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), as_text("fp").alias("fingerprint"), as_text("edited_fp").alias("edited_fingerprint"), likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))
