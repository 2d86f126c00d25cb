"""Reassembly of a transaction log, by windows alone.

Streams write to one log; each runs one transaction after the other. What becomes of a change follows from what comes
after it in its stream: with savepoints that stay, it is undone if the next marker is a rollback; with savepoints that a
rollback takes away, if a rollback at its own height follows, where the height is savepoints less rollbacks so far. What
is left goes with the transaction's end. Commits, numbered over all streams, apply changes to one store; each key's
changes become intervals by a lead over epochs, each interval an event that adds and one that takes away, and the store
after an epoch is a running sum of events.

No window holds a stream, a key or the log: `scanned` cuts every window into chunks of neighbouring positions, so that no
task gets more than a chunk of one group. Joins are hinted to sort and merge, as both sides grow with the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.llm.common import CRC_SQL, crc_sql
from gossamr.operators.scan import bounds, scanned
from gossamr.session import materialize

#: Two to this power are the positions of a chunk.
BITS = 8
#: Kinds of records: the first two end a transaction, all but changes are markers.
COMMIT, ABORT, SAVEPOINT, ROLLBACK, CHANGE = "commit", "abort", "savepoint", "rollback", "change"
#: Columns of a record, in the order in which records of one position are read.
RECORD = ["seq", "stream", "kind", "key", "value"]


def resolved(records: DataFrame, keep_savepoints: bool = True, bits: int = BITS) -> DataFrame:
    """The changes of records (seq, stream, kind, key, value; no null but in key and value) with undone (rollback, abort
    or null), by (seq of the record that undoes it; null: the log's end) and commit (seq and stream of the commit that
    applies it).

    A rollback undoes its transaction's remaining changes since its latest savepoint, or the start if it has none.
    keep_savepoints: whether that savepoint stays, or is taken away, so that the one before is the latest.
    Transactions end by commit, abort, or the log's end, which is an abort. Records of one position are read in the order
    of RECORD's columns; such as are equal in all of them are records of their own.
    """
    low, high = bounds(records, "seq")
    place = F.struct("seq", "stream", "kind")
    ends = F.col("kind").isin(COMMIT, ABORT)
    rows = records.withColumns({"marker": F.when(F.col("kind") != CHANGE, place), "end": F.when(ends, place), "is_end": F.when(ends, 1).otherwise(0).cast("long")})
    if keep_savepoints:
        rows = scanned(rows, ["stream"], RECORD[:1] + RECORD[2:], low, high, nexts=("marker", "end"), bits=bits)
        rolled = F.when(F.col("next_marker.kind") == ROLLBACK, F.col("next_marker.seq"))
    else:
        order = RECORD[:1] + RECORD[2:]
        rows = materialize(scanned(rows, ["stream"], order, low, high, sums=("is_end",), nexts=("end",), bits=bits), "log-transactions")
        step = F.when(F.col("kind") == SAVEPOINT, 1).when(F.col("kind") == ROLLBACK, -1).otherwise(0).cast("long")
        rows = rows.withColumnRenamed("sum_is_end", "transaction").withColumn("step", step)
        rows = scanned(rows, ["stream", "transaction"], order, low, high, sums=("step",), bits=bits)
        rows = scanned(rows.withColumn("count", F.col("sum_step") + F.col("step")), ["stream", "transaction"], order, low, high, mins=("count",), bits=bits)
        # a rollback without savepoint leaves the height at 0: what the count fell below 0 so far is made up for
        rows = rows.withColumn("height", F.col("sum_step") - F.least(F.coalesce("min_count", F.lit(0)), F.lit(0)))
        rows = materialize(rows.withColumn("back", F.when(F.col("kind") == ROLLBACK, place)), "log-heights")
        rows = scanned(rows, ["stream", "transaction", "height"], order, low, high, nexts=("back",), bits=bits)
        rolled = F.col("next_back.seq")
    changes = rows.filter(F.col("kind") == CHANGE).withColumn("_rolled", rolled)
    applied = F.col("_rolled").isNull() & F.coalesce(F.col("next_end.kind") == COMMIT, F.lit(False))
    undone = F.when(F.col("_rolled").isNotNull(), ROLLBACK).when(~applied, ABORT)
    by = F.when(F.col("_rolled").isNotNull(), F.col("_rolled")).when(~applied, F.col("next_end.seq"))
    return changes.select("seq", "stream", "key", "value", undone.alias("undone"), by.alias("by"), F.when(applied, F.struct("next_end.seq", "next_end.stream")).alias("commit"))


def numbered_commits(records: DataFrame, every: int, bits: int = BITS) -> DataFrame:
    """(seq, stream, number, epoch) of the commits of records, numbered from 0 over all streams; `every` of them are an epoch."""
    commits = records.filter(F.col("kind") == COMMIT).select("seq", "stream", F.lit(1).cast("long").alias("one"))
    commits = scanned(commits, [], ["seq", "stream"], *bounds(records, "seq"), sums=("one",), bits=bits)
    return commits.select("seq", "stream", F.col("sum_one").alias("number"), (F.expr(f"sum_one div {every}") + 1).alias("epoch"))


def states(changes: DataFrame, commits: DataFrame, bits: int = BITS) -> DataFrame:
    """(epoch, n, total): keys stored after each epoch of commits, and the sum of their values, of applied changes
    (seq, stream, key, value, commit); a change without value takes its key away.

    A commit's changes apply in log order, of one position by value, null first.
    """
    numbers = commits.groupBy("seq", "stream").agg(F.min(F.struct("number", "epoch")).alias("c")).select(F.struct("seq", "stream").alias("commit"), "c.number", "c.epoch")
    last = changes.join(numbers.hint("merge"), "commit").groupBy("key", "epoch").agg(F.max(F.struct("number", "seq", "value")).alias("last"))
    epochs = materialize(commits.groupBy("epoch").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total")), "log-epochs")
    low, high = bounds(epochs, "epoch")
    last = materialize(last.select("key", "epoch", "last.value", F.struct("epoch").alias("until")), "log-store")
    spans = scanned(last, ["key"], ["epoch"], low, high, nexts=("until",), bits=bits).filter("value is not null")
    events = F.array(F.struct(F.col("epoch").alias("epoch"), F.lit(1).cast("long").alias("n"), F.col("value").alias("total")), F.struct(F.col("next_until.epoch").alias("epoch"), F.lit(-1).cast("long").alias("n"), (-F.col("value")).alias("total")))
    events = spans.select(F.explode(events).alias("e")).select("e.epoch", "e.n", "e.total").filter("epoch is not null")
    sums = materialize(events.unionByName(epochs).groupBy("epoch").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "log-events")
    out = scanned(sums, [], ["epoch"], low, high, sums=("n", "total"), bits=bits)
    return out.select("epoch", (F.col("sum_n") + F.col("n")).alias("n"), (F.col("sum_total") + F.col("total")).alias("total"))


def replay(records: DataFrame, every: int = 64, keep_savepoints: bool = True, bits: int = BITS) -> DataFrame:
    """(kind, id, n, value) of a log: a `state` row for each epoch (number from 1, stored keys, sum of their values), and a
    row for each change undone (`rollback` or `abort`, seq, seq of what undid it, key). See resolved() and states().

    Records without position are left out, a null stream is one; others of its columns (seq, stream, kind, key, value) may be null as well. A log
    without commits has no state; an empty one gives an empty table.
    """
    # streams are told from null by a first character, so that they group and join as values do
    stream = F.coalesce(F.concat(F.lit("="), F.col("stream").cast("string")), F.lit(""))
    rows = records.filter("seq is not null").select(F.col("seq").cast("long").alias("seq"), stream.alias("stream"), "kind", F.col("key").cast("long").alias("key"), F.col("value").cast("long").alias("value"))
    rows = materialize(rows, "log-records")
    changes = materialize(resolved(rows, keep_savepoints, bits), "log-changes")
    commits = materialize(numbered_commits(rows, every, bits), "log-commits")
    after = states(changes.filter("commit is not null").select("seq", "stream", "key", "value", "commit"), commits, bits)
    undone = changes.filter("undone is not null").select(F.col("undone").alias("kind"), F.col("seq").alias("id"), F.col("by").alias("n"), F.col("key").alias("value"))
    return after.select(F.lit("state").alias("kind"), F.col("epoch").alias("id"), "n", F.col("total").alias("value")).unionByName(undone)


#: Fixed by the test log: remainders modulo 17 of a record's checksum that stand for each kind, and the number of keys.
MODULUS, KINDS, KEYS = 17, {COMMIT: (0, 1), ABORT: (2,), SAVEPOINT: (3, 4), ROLLBACK: (5, 6)}, 30_000


def document_log(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, source, text) as records: the id's checksum tells kind and key; null and toxic texts delete.

    labels: doc_id, toxic; a document is toxic if any of its labels says so.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    kind = F.lit(CHANGE)
    for name, which in KINDS.items():
        kind = F.when((h % MODULUS).isin(*which), name).otherwise(kind)
    key = F.floor(h / 100).cast("long") % KEYS
    rows = docs.filter("doc_id is not null").select("doc_id", "source", kind.alias("kind"), F.when(kind == CHANGE, key).alias("key"), F.when(kind == CHANGE, F.crc32(F.concat(key.cast("string"), F.lit(":"), F.col("text")).cast("binary"))).alias("value"))
    toxic = labels.filter("toxic = 1").select("doc_id", F.lit(True).alias("toxic")).distinct()
    return rows.join(toxic.hint("merge"), "doc_id", "left").select(F.col("doc_id").alias("seq"), F.col("source").alias("stream"), "kind", "key", F.when(F.col("toxic").isNull(), F.col("value")).alias("value"))


def op11_log_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of the store after every 64 commits of the documents' log, and all changes that it undoes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return replay(document_log(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")), every=64)


OP11_SQL = f"""
WITH {CRC_SQL},
h AS (SELECT doc_id, coalesce('=' || source, '') AS stream, text, {crc_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc_table WHERE doc_id IS NOT NULL),
k AS (SELECT doc_id, stream, text, CASE WHEN h % 17 < 2 THEN 'commit' WHEN h % 17 = 2 THEN 'abort' WHEN h % 17 < 5 THEN 'savepoint' WHEN h % 17 < 7 THEN 'rollback' ELSE 'change' END AS kind, (h // 100) % 30000 AS key FROM h),
r AS (SELECT doc_id, stream, kind, key, CASE WHEN kind = 'change' AND text IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
  THEN {crc_sql("key || ':' || text")} END AS value FROM k, crc_table),
w AS (SELECT *, first_value(CASE WHEN kind <> 'change' THEN struct_pack(id := doc_id, kind := kind) END IGNORE NULLS) OVER later AS marker,
  first_value(CASE WHEN kind IN ('commit', 'abort') THEN struct_pack(id := doc_id, kind := kind) END IGNORE NULLS) OVER later AS ended
  FROM r WINDOW later AS (PARTITION BY stream ORDER BY doc_id, kind, key, value NULLS FIRST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
c AS (SELECT doc_id, stream, row_number() OVER (ORDER BY doc_id, stream) - 1 AS number FROM r WHERE kind = 'commit'),
n AS (SELECT doc_id, stream, min(number) AS number FROM c GROUP BY doc_id, stream),
a AS (SELECT w.key, n.number // 64 + 1 AS epoch, arg_max(struct_pack(value := w.value), struct_pack(number := n.number, id := w.doc_id, has := w.value IS NOT NULL, value := coalesce(w.value, 0))).value AS value
  FROM w JOIN n ON w.ended.id = n.doc_id AND w.stream = n.stream WHERE w.kind = 'change' AND w.marker.kind <> 'rollback' AND w.ended.kind = 'commit' GROUP BY w.key, n.number // 64 + 1),
s AS (SELECT *, lead(epoch) OVER (PARTITION BY key ORDER BY epoch) AS until FROM a),
e AS (SELECT epoch, 1 AS n, value FROM s WHERE value IS NOT NULL UNION ALL SELECT until, -1, -value FROM s WHERE value IS NOT NULL AND until IS NOT NULL UNION ALL SELECT number // 64 + 1, 0, 0 FROM c)
SELECT 'state' AS kind, CAST(epoch AS BIGINT) AS id, CAST(sum(sum(n)) OVER (ORDER BY epoch) AS BIGINT) AS n, CAST(sum(sum(value)) OVER (ORDER BY epoch) AS BIGINT) AS value FROM e GROUP BY epoch
UNION ALL SELECT CASE WHEN marker.kind = 'rollback' THEN 'rollback' ELSE 'abort' END, doc_id, CASE WHEN marker.kind = 'rollback' THEN marker.id ELSE ended.id END, key
FROM w WHERE kind = 'change' AND (coalesce(marker.kind, '') = 'rollback' OR coalesce(ended.kind, 'abort') = 'abort')
"""
