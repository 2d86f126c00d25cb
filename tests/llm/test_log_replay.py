import random
import zlib

import pytest
from pyspark.sql import functions as F

from gossamr.llm import log_replay
from gossamr.llm.log_replay import document_log, op11_log_replay, replay
from gossamr.operators import scan
from gossamr.operators.scan import scanned

SCHEMA = "seq long, stream string, kind string, key long, value long"


def brute(records, every=64, keep=True):
    """The rows of replay(), by reading one record after the other."""
    nulls = lambda x: (x is not None, x if x is not None else 0)
    records = sorted((r for r in records if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2], nulls(r[3]), nulls(r[4])))
    store, out, running, commits = {}, [], {}, 0

    def state(epoch):
        out.append(("state", epoch, len(store), sum(store.values())))

    for seq, stream, kind, key, value in records:
        made, saved = running.setdefault(stream, ([], []))  # remaining changes, and how many there were at each savepoint
        if kind == "change":
            made.append((seq, key, value))
        elif kind == "savepoint":
            saved.append(len(made))
        elif kind == "rollback":
            first = saved[-1] if saved else 0
            out.extend(("rollback", c[0], seq, c[1]) for c in made[first:])
            del made[first:]
            if saved and not keep:
                saved.pop()
        else:
            if kind == "abort":
                out.extend(("abort", c[0], seq, c[1]) for c in made)
            else:
                for _, k, v in made:
                    store.pop(k, None)
                    if v is not None:
                        store[k] = v
                commits += 1
                if commits % every == 0:
                    state(commits // every)
            del running[stream]
    for made, _ in running.values():
        out.extend(("abort", c[0], None, c[1]) for c in made)
    if commits % every:
        state(commits // every + 1)
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made_up(rng, n, streams, keys, gap=3, weights=(2, 1, 3, 3, 9)):
    seqs = rng.sample(range(-gap * n, gap * n), n)
    kinds = rng.choices(["commit", "abort", "savepoint", "rollback", "change"], weights=weights, k=n)
    return [(s, rng.choice(streams), k, *((rng.choice(keys), rng.choice([None, rng.randint(0, 99)])) if k == "change" else (None, None))) for s, k in zip(seqs, kinds, strict=True)]


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize(("bits", "every"), [(2, 3), (4, 1), (10, 64)])
def test_windows_equal_reading_one_by_one(spark, keep, bits, every):
    rng = random.Random(bits)
    records = made_up(rng, 600, ["a", "a", "a", "b", None, ""], range(12))
    df = spark.createDataFrame(records, SCHEMA)
    assert rows_of(replay(df, every, keep, bits)) == brute(records, every, keep)


@pytest.mark.parametrize("keep", [True, False])
def test_deep_savepoints_and_rollbacks_without_any(spark, keep):
    rng = random.Random(7)
    records = made_up(rng, 500, ["a", "b"], range(5), weights=(0.2, 0.2, 6, 6, 5))
    assert rows_of(replay(spark.createDataFrame(records, SCHEMA), 2, keep, 3)) == brute(records, 2, keep)


def test_repeated_and_equal_positions(spark):
    rng = random.Random(8)
    records = made_up(rng, 150, ["a", "b", None], range(6), gap=1)
    records = [*records, *rng.sample(records, 60), *((s, "b", k, x, v) for s, _, k, x, v in rng.sample(records, 40))]
    assert rows_of(replay(spark.createDataFrame(records, SCHEMA), 4, True, 3)) == brute(records, 4)


def test_ends_of_the_range_of_positions(spark):
    records = [(-(1 << 63), "a", "change", 1, 5), (-3, "a", "savepoint", None, None), (0, "a", "change", 2, 6), (4, "a", "rollback", None, None), ((1 << 63) - 1, "a", "commit", None, None)]
    assert rows_of(replay(spark.createDataFrame(records, SCHEMA))) == brute(records)


def test_scan_of_sums_least_and_next(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), i, rng.randint(-5, 5), (i, "x") if rng.random() < 0.05 else None) for i in sorted(rng.sample(range(5000), 400))]
    df = spark.createDataFrame(rows, "g string, i long, x long, v struct<i: long, t: string>").withColumn("y", F.col("x"))
    got = {r.i: (r.sum_x, r.min_y, r.next_v and tuple(r.next_v)) for r in scanned(df, ["g"], ["i"], rows[0][1], rows[-1][1], ("x",), ("y",), ("v",), bits=3).collect()}
    for g, i, _, _ in rows:
        early, late = [x for h, j, x, _ in rows if h == g and j < i], [v for h, j, _, v in rows if h == g and j > i and v]
        assert got[i] == (sum(early), min(early, default=None), late[0] if late else None)


def test_no_task_gets_a_stream_or_the_log(spark, monkeypatch):
    """A third of the log is one stream: the largest group of any window is a chunk."""
    seen = []
    real = log_replay.scanned

    def spying(rows, group, order, low, high, *args, **options):
        bits = options.get("bits", 10)
        chunk = F.lit(0) if high - low < 1 << bits else F.shiftright(order[0], bits)
        seen.append(rows.groupBy(*group, chunk.alias("_c")).count().agg(F.max("count")).first()[0])
        return real(rows, group, order, low, high, *args, **options)

    monkeypatch.setattr(log_replay, "scanned", spying)
    monkeypatch.setattr(scan, "scanned", spying)  # levels above
    records = [(i, "hot" if i % 3 else f"s{i % 7}", ["change", "change", "savepoint", "commit", "rollback", "change"][i % 6], 1 if i % 6 in (0, 1, 5) else None, i if i % 6 in (0, 1, 5) else None) for i in range(6000)]
    assert rows_of(replay(spark.createDataFrame(records, SCHEMA), 2, True, 6)) == brute(records, 2)
    assert max(seen) <= 64


def brute_log(docs, toxic):
    out = []
    for doc_id, source, text in docs:
        if doc_id is None:
            continue
        h = zlib.crc32(str(doc_id).encode())
        m = h % 17
        kind = "commit" if m < 2 else "abort" if m == 2 else "savepoint" if m < 5 else "rollback" if m < 7 else "change"
        key = h // 100 % 30_000
        value = None if text is None or doc_id in toxic else zlib.crc32(f"{key}:{text}".encode())
        out.append((doc_id, source, kind, key if kind == "change" else None, value if kind == "change" else None))
    return out


def test_query_equals_brute_force_on_a_table(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "source", "text").collect()]
    toxic = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").filter("toxic = 1").collect()}
    assert rows_of(op11_log_replay(spark, data)) == brute(brute_log(docs, toxic))


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (None, 1), (6, None)], "doc_id long, toxic int")
    docs = edge_docs.select("doc_id", "source", "text", F.lit("x").alias("kind"), F.lit(1).alias("seq"), F.lit(2).alias("value"))
    many = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") * 7 - 20)).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 100))
    rows = [(r.doc_id, r.source, r.text) for r in many.collect()]
    assert rows_of(replay(document_log(many, labels), 2)) == brute(brute_log(rows, {1, 4}), 2)
    assert replay(document_log(no_docs, labels)).collect() == [] and replay(document_log(many.filter("doc_id = 6"), labels.limit(0))).count() <= 1
    assert replay(spark.createDataFrame([(1, "a", "change", 3, 4)], SCHEMA)).collect() == [("abort", 1, None, 3)]
