"""Spelling variants: a trie self-join with active-node sets at an edit distance of one.

Words are partitioned by prefix. Of two words at distance one, with the shorter one of L characters, either the first
L // 2 characters are equal or the last L - L // 2, so each word goes to the tries of its prefix and, spelled backwards,
of its suffix, for both lengths that its partner may have. Within a partition a task walks down the trie: a node's active
set holds the nodes at distance one, which its parent's set and its own neighbourhood give; two words are a pair where
both end. Partitions of too many words are split by Spark beforehand: one step down their common node, whose pairs are
found by a join of what follows the step.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.llm.common import CRC_SQL, crc_sql, emit, field
from gossamr.session import discard, materialize, ship

#: Runs of letters, after A-Z became lower case.
RUN = re.compile("[a-zÀ-ÿ]+")
#: One in so many words of a document loses a character, by its checksum.
TYPO = 97
#: Words of a partition beyond which it is split, and words that a worker counts before it passes them on.
MOST, COUNTED = 20_000, 200_000


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """Words of a text and how often it has them: lower-cased runs, of which those with a checksum that TYPO divides lack a character."""
    out: Counter = Counter()
    if not text:
        return out
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():
        h = zlib.crc32(run.encode(), head)
        if h % TYPO == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of all words of docs (doc_id, text) with at least min_chars code points and min_count occurrences.

    Null and empty texts have no words; a null id counts as empty text before the colon of the checksum. Repeated rows
    count again. Workers count before words are shuffled.
    """

    def start():
        counts: Counter = Counter()

        def rows() -> tuple[list, list]:
            made = [*counts.keys()], [*counts.values()]
            counts.clear()
            return made

        def work(ids, texts):
            for doc_id, text in zip(ids, texts, strict=True):
                for word, n in words_of(doc_id, text).items():
                    if len(word) >= min_chars:
                        counts[word] += n
            return rows() if len(counts) >= COUNTED else None

        def last():
            if counts:
                yield rows()

        return work, last

    counted = emit(docs, ["doc_id", "text"], [field("word", "string"), field("n", "long")], start, finish=True)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Trie:
    """The trie of some distinct strings, as ranges of their sorted list: a node is (first, behind the last, depth)."""

    def __init__(self, strings: list[str]):
        self.strings = sorted(strings)
        self.known = set(strings)
        self._children: dict[tuple, dict[str, tuple]] = {}

    def children(self, node: tuple[int, int, int]) -> dict[str, tuple[int, int, int]]:
        found = self._children.get(node)
        if found is None:
            found, (low, high, depth) = {}, node
            if len(self.strings[low]) == depth:
                low += 1  # the string that ends here
            while low < high:
                c, first = self.strings[low][depth], low
                while low < high and self.strings[low][depth] == c:
                    low += 1
                found[c] = first, low, depth + 1
            self._children[node] = found
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Both orders of each two strings at an edit distance of one.

        Goes down from the root with each node's active set: its own, itself at distance 0, is left out, what remains
        is at distance 1. Under a node of a single string only one walk is left, so the string is looked up.
        """
        if len(self.strings) < 2:
            return
        root = 0, len(self.strings), 0
        stack = [(root, set(self.children(root).values()))]
        while stack:
            node, active = stack.pop()
            low, high, depth = node
            own = self.strings[low]
            if high - low == 1:
                rest = own[depth:]
                seen = set()
                for first, _, at in active:
                    other = self.strings[first][:at] + rest
                    if other in self.known and other not in seen:
                        seen.add(other)
                        yield own, other
                continue
            if len(own) == depth:
                for first, _, at in active:
                    if len(self.strings[first]) == at:
                        yield own, self.strings[first]
            below = self.children(node)
            for c, child in below.items():
                near = {node, *below.values()}  # a character less, another character
                near.discard(child)
                if child[1] - child[0] > 1:
                    near.update(self.children(child).values())  # a character more
                for other in active:  # the same character after an edit above
                    first, behind, at = other
                    if behind - first == 1:
                        if len(self.strings[first]) > at and self.strings[first][at] == c:
                            near.add((first, behind, at + 1))
                    elif (to := self.children(other).get(c)) is not None:
                        near.add(to)
                near.discard(child)
                stack.append((child, near))


def _keyed(vocab: DataFrame, min_chars: int) -> DataFrame:
    """Rows of the partitions: backwards, chars (of the shorter word), held (equal characters), key, spelled, word, n."""
    length = F.length("word")
    ways = F.array(*[F.struct(F.lit(b).alias("backwards"), (length - less).alias("chars")) for b in (False, True) for less in (0, 1)])
    rows = vocab.select("word", "n", F.explode(ways).alias("way")).select("word", "n", "way.backwards", "way.chars").filter(F.col("chars") >= max(min_chars, 1))
    half = F.floor(F.col("chars") / 2).cast("int")
    held = F.when(F.col("backwards"), F.col("chars") - half).otherwise(half)
    rows = rows.withColumns({"held": held, "spelled": F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word"))})
    return rows.withColumn("key", F.substring("spelled", F.lit(1), F.col("held")))


GROUP = ["backwards", "chars", "key"]


def _counts(a: Column, b: Column, chars: Column, backwards: Column) -> Column:
    """Whether a pair counts in its partition: one of them has the partition's length, and no other partition has the pair."""
    half = F.floor(chars / 2).cast("int")
    apart = F.substring(a, F.lit(1), half) != F.substring(b, F.lit(1), half)
    return (F.least(F.length(a), F.length(b)) == chars) & (~backwards | apart)


def _split(rows: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows of partitions of at most `most` words, and the pairs (word, other, other_n) between the parts of larger ones.

    In a large partition all words share a node. Its pairs either differ in the next character, so that what follows
    is equal, or lie below one child, which is a partition of its own, smaller than the first.
    """
    small, pairs = [], []
    while True:
        sizes = rows.groupBy(*GROUP).agg(F.count("*").alias("size"), F.min("spelled").alias("low"), F.max("spelled").alias("high"))
        large = materialize(sizes.filter(F.col("size") > most), "spelling-large")
        if large.isEmpty():
            small.append(rows)
            break
        small.append(rows.join(large.select(*GROUP), GROUP, "left_anti").select(*rows.columns))
        # all that the first and the last string share, all share
        same = F.aggregate(F.sequence(F.lit(1), F.least(F.length("low"), F.length("high"))), F.lit(0), lambda acc, i: F.when((acc == i - 1) & (F.substring("low", i, 1) == F.substring("high", i, 1)), i).otherwise(acc))
        node = large.select(*GROUP, F.when(F.col("low") == F.col("high"), F.length("low")).otherwise(same).alias("depth"))
        hot = materialize(rows.join(node, GROUP), "spelling-hot")
        longer = hot.filter(F.length("spelled") > F.col("depth"))
        char = F.substring("spelled", F.col("depth") + 1, F.lit(1))
        without = F.concat(F.substring("spelled", F.lit(1), F.col("depth")), F.substring("spelled", F.col("depth") + 2, F.length("spelled")))
        steps = longer.select(*GROUP, without.alias("rest"), char.alias("char"), "word", "n")
        ends = hot.select(*GROUP, F.col("spelled").alias("rest"), char.alias("char"), "word", "n")
        named = lambda df: df.select(*GROUP, "rest", F.col("char").alias("other_char"), F.col("word").alias("other"), F.col("n").alias("other_n"))
        differ = (F.col("char") != F.col("other_char")) & _counts(F.col("word"), F.col("other"), F.col("chars"), F.col("backwards"))
        replaced = steps.join(named(steps), [*GROUP, "rest"]).filter(differ).select("word", "other", "other_n")
        shorter = steps.join(named(ends), [*GROUP, "rest"]).filter(differ)
        pairs += [replaced, shorter.select("word", "other", "other_n"), shorter.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))]
        rows = longer.withColumn("key", F.substring("spelled", F.lit(1), F.col("depth") + 1)).withColumn("held", F.col("depth") + 1).drop("depth").select(*rows.columns)
        rows = materialize(rows, "spelling-parts")
    out = small[0]
    for x in small[1:]:
        out = out.unionByName(x)
    return out, pairs


def _walked(rows: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of each word of each partition: its near words there, and of these the one of largest n."""

    def found(chars: int, backwards: bool, held: int, words: list[str], counts: list[int]) -> Iterator[tuple]:
        spelled = {(w[::-1] if backwards else w)[held:]: (w, n) for w, n in zip(words, counts, strict=True)}
        half, out = chars // 2, {}
        for a, b in Trie(list(spelled)).pairs():
            (word, _), (other, n) = spelled[a], spelled[b]
            if min(len(word), len(other)) == chars and not (backwards and word[:half] == other[:half]):
                total, best = out.get(word, (0, None))
                mine = -n, other
                out[word] = total + 1, mine if best is None or mine < best else best
        for word, (total, (minus, best)) in out.items():
            yield word, total, -minus, best

    names, types = ["word", "n_near", "best_n", "best"], [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, words, counts, done = None, [], [], []

        def pack() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for backwards, chars, key, held, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (backwards, chars, key, held) != group:
                    if len(words) > 1:
                        done.extend(found(group[1], group[0], group[3], words, counts))
                    group, words, counts = (backwards, chars, key, held), [], []
                words.append(word)
                counts.append(n)
            if len(done) >= 1000:
                yield pack()
                done.clear()
        if len(words) > 1:
            done.extend(found(group[1], group[0], group[3], words, counts))
        if done:
            yield pack()

    ship(rows.sparkSession)
    sorted_ = rows.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return sorted_.select(*GROUP, "held", "word", "n").mapInArrow(run, "word string, n_near long, best_n long, best string")


def near_words(vocab: DataFrame, min_chars: int = 1, most: int = MOST) -> DataFrame:
    """(word, n_near, best_n, best) of the words of vocab (word, n; each word once) with near words.

    Near: one character inserted, deleted or replaced. best: the near word of largest n, the smallest of those.
    min_chars: a length that no word of vocab falls below. Words of any length are compared whole.
    """
    rows, pairs = _split(_keyed(vocab, min_chars), most)
    found = _walked(rows)
    for p in pairs:
        found = found.unionByName(p.select("word", F.lit(1).cast("long").alias("n_near"), F.col("other_n").alias("best_n"), F.col("other").alias("best")))
    total = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best"))).alias("top"))
    return total.select("word", "n_near", (-F.col("top.minus")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form), which hold no circle: the last word that forms lead to, by doubling the steps."""
    up = materialize(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        step = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = materialize(up.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        discard(up)
        if further.filter("moved").isEmpty():
            return further.select("word", "root")
        up = further.select("word", "root")


def group_variants(vocab: DataFrame, ratio: int = 2, min_chars: int = 1, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of vocab (word, n; each word once, none null).

    A word's form is its near word of largest n (of several the smallest) if that is at least ratio times its own; its
    root is where forms end. An empty vocabulary gives an empty table.
    """
    near = near_words(vocab, min_chars, most)
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = vocab.join(near, "word", "left").select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
    formed = materialize(formed, "spelling-near")
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, with five characters and three occurrences at least, their near words, forms and roots."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_variants(materialize(vocabulary(docs), "spelling-vocabulary"), min_chars=5)


OP13_SQL = f"""
WITH {CRC_SQL},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counted, crc_table),
words AS (SELECT CASE WHEN h % {TYPO} = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM v),
d AS (SELECT word, n, pos, left(word, CAST(pos AS INT) - 1) || substr(word, CAST(pos AS INT) + 1) AS less FROM x),
p AS (SELECT a.word, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.less = b.less AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word),
b AS (SELECT word, count(*) AS n_near, max(other_n) AS best_n, min(struct_pack(minus := -other_n, other := other)).other AS best FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form, CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n FROM v LEFT JOIN b USING (word)),
r AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT r.word, f.form, k + 1 FROM r JOIN f ON r.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, last.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, arg_max(root, k) AS root FROM r GROUP BY word) last USING (word)
"""
