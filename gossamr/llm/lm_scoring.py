"""LM scoring by cross-entropy difference (Moore and Lewis, 2010).

Two bigram models with the same vocabulary and smoothing: the target's, from documents labelled good, and the
background's, from all documents. Words and bigrams are counted by 62-bit hash, so the models grow with the corpus and
no task holds more than a share of them: texts are taken in chunks, a chunk's distinct keys go with its own counts to the
key's bucket, the bucket sums them over all chunks and answers with the sums, and the chunk's answers meet its texts
again. Buckets are ranges of keys, in a number that follows from the counted words. A key that is common everywhere is
one entry a chunk. Background counts are scaled to the target's size, so that smoothing weighs alike in both. Each
document is scored by models without its own counts (leave one out), so that target documents gain nothing from having
trained the target's model, nor any document from being in the background. A document's score is the mean difference per token of its loss under the target's and under the background's model: the
lower, the more it is like the target.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gossamr.llm.common import WordHashes, emit, field, lowered_words_of, mixed
from gossamr.session import materialize, sized

#: Bits of a key. Keys of words are below 1 << WORD_BITS, those of bigrams follow.
WORD_BITS = 62
#: Tokens of a chunk, but for a longer text, and tokens of the corpus for each bucket.
CHUNK, BUCKET = 1_000_000, 500_000


def bigram_keys(words: np.ndarray) -> np.ndarray:
    """Keys of the bigrams of a sequence of words' keys."""
    h = words.astype(np.uint64)
    return ((mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) >> np.uint64(2)) | np.uint64(1 << WORD_BITS)).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on: their bytes in planes, lowest first and no more than the largest needs, compressed."""
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(x, np.int64).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:9], "little")
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(blob[9:], width * n, "zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.int64)


def gaps(keys: np.ndarray) -> np.ndarray:
    """Of rising keys the first and then the differences; np.cumsum gives the keys again."""
    return np.diff(keys, prepend=0)


class Chunk:
    """Texts of one task, gathered until they have enough tokens."""

    def __init__(self):
        self.hashes = WordHashes()
        self.clear()

    def clear(self) -> None:
        self.words, self.targets, self.names, self.tokens = [], [], [], 0

    def add(self, text: str | None, target: bool, name: int) -> None:
        words = (self.hashes.of(lowered_words_of(text)) >> np.uint64(2)).astype(np.int64)
        if len(words):
            self.words.append(words)
            self.targets.append(bool(target))
            self.names.append(name)
            self.tokens += len(words)

    def sums(self, bigrams: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys in order, their counts in targets and in all texts; each token's place in keys; texts' lengths."""
        lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        all_words = np.concatenate(self.words)
        chosen = np.repeat(np.array(self.targets), lengths)
        made = [_summed(all_words, chosen)]
        if bigrams:
            inside = _inside(lengths)
            made.append(_summed(bigram_keys(all_words)[inside], chosen[1:][inside]))
        keys, target, background = (np.concatenate([m[i] for m in made]) for i in range(3))
        return keys, target, background, made[0][3], lengths


def _inside(lengths: np.ndarray) -> np.ndarray:
    """Of the pairs of neighbours in texts of these lengths laid end to end, those within a text."""
    out = np.ones(int(lengths.sum()) - 1, bool)
    out[np.cumsum(lengths)[:-1] - 1] = False
    return out


def _summed(keys: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at[chosen], minlength=len(found)), np.bincount(at, minlength=len(found)), at


def counts(docs: DataFrame, bigrams: bool = True) -> DataFrame:
    """(slot, target, background): occurrences of each key in target documents and in all. docs: text, is_target."""

    def start():
        chunk = Chunk()

        def flush():
            keys, target, background, _, _ = chunk.sums(bigrams)
            chunk.clear()
            return keys, target, background

        def work(texts, targets):
            for t, x in zip(texts, targets, strict=True):
                chunk.add(t, x, 0)
            return flush() if chunk.tokens >= CHUNK else None

        return work, lambda: [flush()] if chunk.tokens else []

    own = emit(docs, ["text", "is_target"], [field("slot", "long"), field("target", "long"), field("background", "long")], start, finish=True)
    return own.groupBy("slot").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))


def _edges(buckets: int) -> np.ndarray:
    """Where each bucket's keys start."""
    return np.array([(i << (WORD_BITS + 1)) // buckets for i in range(buckets)], np.int64)


def _rows(df: DataFrame, buckets: int, tokens: int) -> DataFrame:
    """(chunk, bucket, kind, a, b, c) of df (text, key, is_target).

    Kind 0: keys of a bucket (their gaps from the bucket's start) and the chunk's counts of them in targets and in all.
    Kind 1, one row a chunk: keys of its texts (int64), twice their lengths (plus 1: a target), and each token's place
    among the chunk's words.
    All but the texts' keys are packed.
    """
    edges = _edges(buckets)

    def start():
        chunk, n, base = Chunk(), 0, TaskContext.get().partitionId() << 32

        def flush():
            nonlocal n
            keys, target, background, places, lengths = chunk.sums()
            at, name = [*np.searchsorted(keys, edges).tolist(), len(keys)], base + n
            rows = [(name, i, 0, packed(gaps(keys[x:y] - edges[i])), packed(target[x:y]), packed(background[x:y])) for i, (x, y) in enumerate(zip(at[:-1], at[1:], strict=True)) if x < y]
            rows.append((name, (name * 7919) % buckets, 1, np.array(chunk.names, np.int64).tobytes(), packed(2 * lengths + np.array(chunk.targets)), packed(places)))
            chunk.clear()
            n += 1
            return [list(x) for x in zip(*rows, strict=True)]

        def work(texts, names, targets):
            for t, k, x in zip(texts, names, targets, strict=True):
                chunk.add(t, x, k)
            return flush() if chunk.tokens >= tokens else None

        return work, lambda: [flush()] if chunk.tokens else []

    return emit(df, ["text", "key", "is_target"], [field("chunk", "long"), field("bucket", "long"), field("kind", "int"), *(field(c, "binary") for c in "abc")], start, finish=True)


def _answered(table: pa.Table, buckets: int) -> pa.Table:
    """One bucket's rows: those of kind 0 with the keys of words alone and the counts of all chunks."""
    kinds = np.array(table.column("kind").to_pylist())
    asked = table.filter(pa.array(kinds == 0))
    if not asked.num_rows:
        return table
    start = _edges(buckets)[asked.column("bucket")[0].as_py()]
    a, b, c = ([unpacked(v) for v in asked.column(x).to_pylist()] for x in "abc")
    a = [np.cumsum(x) for x in a]
    _, at = np.unique(np.concatenate(a), return_inverse=True)
    sums = [np.bincount(at, weights=np.concatenate(x)).astype(np.int64)[at] for x in (b, c)]
    ends, out = np.cumsum([0, *map(len, a)]), [[], [], []]
    for i, keys in enumerate(a):
        out[0].append(packed(gaps(keys[keys + start < 1 << WORD_BITS])))
        out[1].append(packed(sums[0][ends[i] : ends[i + 1]]))
        out[2].append(packed(sums[1][ends[i] : ends[i + 1]]))
    made = pa.table([asked.column("chunk"), asked.column("bucket"), asked.column("kind"), *(pa.array(x, pa.binary()) for x in out)], names=table.column_names)
    return pa.concat_tables([made, table.filter(pa.array(kinds == 1)).cast(made.schema)])


def _own(texts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How often each key occurs in its text. texts, keys: whole numbers from 0 on."""
    _, at, n = np.unique(texts * (keys.max(initial=0) + 1) + keys, return_inverse=True, return_counts=True)
    return n[at]


def _losses(table: pa.Table, buckets: int, totals: tuple[int, int], vocabulary: int, strength: float) -> pa.Table:
    """(key, tokens, target's loss, background's loss) of one chunk's texts: mean nats per token under both models."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
    text = rows.pop()
    starts = _edges(buckets)
    known = np.concatenate([np.cumsum(unpacked(r["a"])) + starts[r["bucket"]] for r in rows])
    sums = [np.concatenate([unpacked(r[x]) for r in rows]) for x in "bc"]
    names, lengths, places = np.frombuffer(text["a"], np.int64), unpacked(text["b"]), unpacked(text["c"])
    targets, lengths = lengths & 1, lengths >> 1
    inside = _inside(lengths)
    pairs = np.unique(bigram_keys(known[places])[inside], return_inverse=True)[1] + len(known)
    second, out = np.nonzero(inside)[0] + 1, []
    texts = np.repeat(np.arange(len(lengths)), lengths)
    own, own_pairs = _own(texts, places), _own(texts[second], pairs)
    for k in (0, 1):
        counted = np.ones_like(lengths) if k else targets  # whether the model's counts hold the text
        left = totals[k] - counted * lengths
        target = totals[0] - targets * lengths
        scale = np.where((left > 0) & (target > 0), target / np.maximum(left, 1), 1.0) if k else np.ones(len(lengths))
        n = (sums[k][places] - (counted[texts] * own)) * scale[texts]
        p = (n + 1.0) / (target[texts] + vocabulary)
        history = n[second - 1]
        both = (sums[k][pairs] - counted[texts[second]] * own_pairs) * scale[texts[second]]
        p[second] = (np.minimum(both, history) + strength * p[second]) / (history + strength)
        out.append(-np.add.reduceat(np.log(p), np.cumsum(lengths) - lengths) / lengths)
    return pa.table([pa.array(names), pa.array(lengths), *map(pa.array, out)], names=["_key", "_n", "_a", "_b"])


def score(docs: DataFrame, labels: DataFrame, strength: float = 50.0, chunk: int = CHUNK) -> DataFrame:
    """docs (doc_id, text and other columns) with n_tokens, target_loss, background_loss and score appended.

    Target documents are those with a label of quality 1 (of several labels for an id the lowest counts). Texts
    without words, null ones too, have null losses and score. Without any target document the target's model is
    uniform. Repeated rows count as often as they occur, and of these only one is left out when they are scored. Columns
    with the names of results are replaced. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    good = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_q")).filter("_q = 1").select(F.col("doc_id").alias("_good"))
    good = materialize(good, "lm-target")
    own = docs.join(sized(good), F.col("doc_id") == F.col("_good"), "left")
    is_target = F.col("_good").isNotNull()
    key = F.when(F.col("text").isNotNull(), F.xxhash64("text", is_target))
    marked = own.select("text", F.coalesce(key, F.lit(0).cast("long")).alias("key"), is_target.alias("is_target"))
    size = counts(marked, bigrams=False).agg(F.count("*").alias("n"), F.sum("target").alias("t"), F.sum("background").alias("b")).first()
    totals, vocabulary = (size.t or 0, size.b or 0), size.n + 1
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), totals[1] // BUCKET + 1)
    asked = _rows(marked, buckets, chunk)
    answers = asked.groupBy("bucket").applyInArrow(lambda t: _answered(t, buckets), asked.schema)
    kinds = T.StructType([field("_key", "long"), field("_n", "long"), field("_a", "double"), field("_b", "double")])
    losses = answers.groupBy("chunk").applyInArrow(lambda t: _losses(t, buckets, totals, vocabulary, strength), kinds)
    losses = materialize(losses.groupBy("_key").agg(*(F.min(c).alias(c) for c in ("_n", "_a", "_b"))), "lm-losses")

    new = {"n_tokens", "target_loss", "background_loss", "score"}
    kept = [c for c in docs.columns if c not in new]
    joined = own.select(*kept, key.alias("_text_key")).join(sized(losses), F.col("_text_key") == F.col("_key"), "left")
    return joined.select(*kept, F.coalesce("_n", F.lit(0).cast("long")).alias("n_tokens"), F.col("_a").alias("target_loss"), F.col("_b").alias("background_loss"), (F.col("_a") - F.col("_b")).alias("score"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, both losses and the score (to six decimals) of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    return scored.select("doc_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")))


OP10_SQL = r"""
WITH g AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id IN (SELECT doc_id FROM g), false) AS good,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT rid, good, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
t AS (SELECT *, lag(word) OVER (PARTITION BY rid ORDER BY pos) AS prev FROM w),
u AS (SELECT word, count(*) FILTER (WHERE good) AS tn, count(*) AS bn FROM w GROUP BY word),
b AS (SELECT prev, word, count(*) FILTER (WHERE good) AS tn, count(*) AS bn FROM t WHERE prev IS NOT NULL GROUP BY prev, word),
ou AS (SELECT rid, word, count(*) AS k FROM w GROUP BY rid, word),
ob AS (SELECT rid, prev, word, count(*) AS k FROM t WHERE prev IS NOT NULL GROUP BY rid, prev, word),
z AS (SELECT count(*) + 1 AS v, sum(tn) AS tt, sum(bn) AS bt FROM u),
x AS (SELECT t.rid, t.n, t.prev, z.v, tt - CASE WHEN good THEN t.n ELSE 0 END AS tl, bt - t.n AS bl,
  u.tn - CASE WHEN good THEN ou.k ELSE 0 END AS wt, u.bn - ou.k AS wb, pu.tn - CASE WHEN good THEN po.k ELSE 0 END AS ht, pu.bn - po.k AS hb,
  b.tn - CASE WHEN good THEN ob.k ELSE 0 END AS pt, b.bn - ob.k AS pb
  FROM t CROSS JOIN z JOIN u ON u.word = t.word JOIN ou ON ou.rid = t.rid AND ou.word = t.word
  LEFT JOIN u pu ON pu.word = t.prev LEFT JOIN ou po ON po.rid = t.rid AND po.word = t.prev
  LEFT JOIN b ON b.prev = t.prev AND b.word = t.word LEFT JOIN ob ON ob.rid = t.rid AND ob.prev = t.prev AND ob.word = t.word),
y AS (SELECT *, CASE WHEN tl > 0 AND bl > 0 THEN CAST(tl AS DOUBLE) / bl ELSE 1.0 END AS s FROM x),
q AS (SELECT rid, n, CASE WHEN prev IS NULL THEN (wt + 1.0) / CAST(tl + v AS DOUBLE) ELSE (least(pt, ht) + 50.0 * ((wt + 1.0) / CAST(tl + v AS DOUBLE))) / (ht + 50.0::DOUBLE) END AS pa,
  CASE WHEN prev IS NULL THEN (wb * s + 1.0) / CAST(tl + v AS DOUBLE) ELSE (least(pb * s, hb * s) + 50.0 * ((wb * s + 1.0) / CAST(tl + v AS DOUBLE))) / (hb * s + 50.0::DOUBLE) END AS pb FROM y),
l AS (SELECT rid, -sum(ln(pa)) / max(n) AS a, -sum(ln(pb)) / max(n) AS b FROM q GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_tokens, round(a, 6) AS target_loss, round(b, 6) AS background_loss, round(a - b, 6) AS score
FROM d LEFT JOIN l USING (rid)
"""
