"""Line dedup: levelled sorted runs of line hashes.

Documents come in batches. A batch is summed to a run: one row (key, docs) for each line key, dealt to buckets of keys and
sorted within them. Before it is written, the batch is merge-anti-joined with the runs already there, on keys whose total
has reached the threshold: those are settled and need no more counting. A level that has `fanout` runs is compacted: they
are merged to one run of the next level. All runs are partitions of one bucketed table, so neither the join nor
compacting nor the final sums move a run: only the batch is shuffled. Keys are 64-bit hashes of normalized lines.
"""

from __future__ import annotations

import math
import uuid

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.llm.common import append, emit, field
from gossamr.session import BROADCAST_ROWS, delete, discard, materialize, scratch_path

#: Characters stripped at both ends of a line: [\x20\x09-\x0D].
BLANKS = b" \t\n\x0b\x0c\r"
#: Documents of a batch and the least number of batches, which is more than a level's fanout; documents for each bucket of keys.
BATCH_DOCS, BATCHES, BUCKET_DOCS = 50_000_000, 6, 500_000


def line_key(line: str) -> int:
    """Hash of a line's key (stripped, A-Z lower-cased), signed; 0 for the empty key, that is never dropped."""
    key = line.encode("utf-8", "surrogatepass").strip(BLANKS).lower()
    if not key:
        return 0
    h = xxhash.xxh3_64_intdigest(key) or 1
    return h - (1 << 64) if h >> 63 else h


class LineRuns:
    """The store of sorted runs: a table in the shared folder, partitioned by run and bucketed by key."""

    def __init__(self, spark: SparkSession, buckets: int, min_docs: int = 10, fanout: int = 4):
        self.spark, self.buckets, self.min_docs, self.fanout = spark, buckets, min_docs, fanout
        self.table, self.path = f"gossamr_lines_{uuid.uuid4().hex}", scratch_path(spark, "line-runs")
        self.levels: list[list[int]] = [[]]
        self.made = self.compacted = 0

    def _read(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.table).filter(F.col("run").isin(runs)).select("key", "docs")

    def _live(self) -> list[int]:
        return [x for level in self.levels for x in level]

    def _write(self, run: DataFrame, level: int) -> None:
        rows = run.select("key", "docs", F.lit(self.made).alias("run"))
        rows.write.mode("append").partitionBy("run").bucketBy(self.buckets, "key").sortBy("key").option("path", self.path).saveAsTable(self.table)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self.made)
        self.made += 1

    def totals(self) -> DataFrame:
        return self._read(self._live()).groupBy("key").agg(F.sum("docs").alias("docs"))

    def frequent(self) -> DataFrame:
        """Keys found in at least min_docs documents."""
        return self.totals().filter(F.col("docs") >= self.min_docs).select("key")

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """A batch's counts (key, docs; one row for a key) without the keys that the runs settle."""
        if not self._live():
            return counts.repartition(self.buckets, "key")
        return counts.join(self.frequent().hint("merge"), "key", "left_anti")

    def add(self, counts: DataFrame) -> None:
        """Add a batch's counts as a run of level 0; compact full levels."""
        self._write(self.unsettled(counts), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._read(full).groupBy("key").agg(F.sum("docs").alias("docs")), level + 1)
            for run in full:
                delete(self.spark, f"{self.path}/run={run}")
            self.spark.catalog.refreshTable(self.table)
            self.compacted += 1
            level += 1

    def drop(self) -> None:
        """Delete all runs."""
        self.spark.sql(f"DROP TABLE {self.table}")
        delete(self.spark, self.path)
        self.levels = [[]]


def _keys(docs: DataFrame, batches: int) -> DataFrame:
    """Of each document: row_id (equal for equal rows), its distinct line keys, its batch."""

    def start():
        def work(ids, texts):
            return ids, [sorted({line_key(x) for x in (t or "").split("\n")} - {0}) for t in texts]

        return work

    rows = docs.select(F.xxhash64("doc_id", "text").alias("row_id"), "text")
    keys = emit(rows, ["row_id", "text"], [field("row_id", "long"), field("keys", "long[]")], start)
    return keys.withColumn("batch", F.pmod("row_id", F.lit(batches)).cast("int"))


def count_lines(docs: DataFrame, min_docs: int = 10, batch_docs: int = BATCH_DOCS, fanout: int = 4) -> tuple[LineRuns, DataFrame]:
    """Feed all documents to the runs, batch by batch. Returns the runs and the table of each document's keys.

    There are as many batches as batch_docs documents each make, but at least BATCHES.
    """
    spark, n = docs.sparkSession, docs.count()
    batches = max(BATCHES, math.ceil(n / batch_docs))
    keys = materialize(_keys(docs, batches), "line-keys", "batch")
    runs = LineRuns(spark, max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(20_000, n // BUCKET_DOCS)), min_docs, fanout)
    for b in range(batches):
        counts = materialize(keys.filter(F.col("batch") == b).select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("docs")), "line-batch")
        runs.add(counts)
        discard(counts)
    return runs, keys


def dedup_lines(docs: DataFrame, min_docs: int = 10, batch_docs: int = BATCH_DOCS, fanout: int = 4, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Drop the lines whose key is found in at least min_docs documents (rows), all their occurrences.

    docs: doc_id, text and any other columns. Returns them with text replaced by the lines kept, joined by \\n, and
    n_lines (before) and n_dropped appended. Null text counts as empty: one empty line, kept, text becomes "".
    Empty keys (blank lines) always stay. A repeated row counts again as a document. An empty table gives an empty one.
    Columns named n_lines or n_dropped are replaced. Frequent keys are broadcast if at most broadcast_rows are
    counted; beyond that each document's own are joined to it.
    """
    runs, keys = count_lines(pick_text(docs), min_docs, batch_docs, fanout)
    frequent = materialize(runs.frequent(), "line-frequent")
    runs.drop()
    n = frequent.count()
    fields = [field("text", "string"), field("n_lines", "long"), field("n_dropped", "long")]
    order = [*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped"]
    if n <= broadcast_rows:
        discard(keys)
        known = docs.sparkSession.sparkContext.broadcast(frozenset(r.key for r in frequent.toLocalIterator()))
        return append(docs, ["text"], fields, lambda: lambda texts: _dropped(texts, known.value)).select(*order)
    hits = keys.select("row_id", F.explode("keys").alias("key")).join(frequent, "key").groupBy("row_id").agg(F.collect_set("key").alias("_drop"))
    rows = docs.withColumn("_row_id", F.xxhash64("doc_id", "text")).join(hits.withColumnRenamed("row_id", "_row_id"), "_row_id", "left").drop("_row_id")
    return append(rows, ["text", "_drop"], fields, lambda: lambda texts, drops: _dropped(texts, None, drops)).select(*order)


def pick_text(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text")


def _dropped(texts: list, known: frozenset | None, drops: list | None = None) -> tuple[list, list, list]:
    out, total, gone = [], [], []
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        drop = known if drops is None else set(drops[i] or ())
        kept = [x for x in lines if line_key(x) not in drop] if drop else lines
        out.append("\n".join(kept))
        total.append(len(lines))
        gone.append(len(lines) - len(kept))
    return out, total, gone


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (SELECT rid, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT rid, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.rid, k.pos, k.line, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key),
g AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM m GROUP BY rid)
SELECT d.doc_id, CAST(g.n_lines AS BIGINT) AS n_lines, CAST(g.n_dropped AS BIGINT) AS n_dropped, sha256(g.kept) AS kept_sha256
FROM d JOIN g USING (rid)
"""
