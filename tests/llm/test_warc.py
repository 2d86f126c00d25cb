import base64
import gzip
import hashlib
import io
from collections import Counter

from gossamr.llm import warc
from gossamr.session import scratch_path


def round_trip(spark, rows, min_bytes=0):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(2)
    path = scratch_path(spark, "warc")
    warc.write(pages, path, min_bytes)
    return path, warc.resolved(warc.read(spark, path)).collect()


def test_round_trip_against_brute_force(spark):
    rows = [(i, f"http://h/{i}", f"page {i % 7}" if i % 3 else ("" if i % 2 else None), "clash") for i in range(40)] + [(50, None, "é\r\n\r\nWARC/1.1\r\n\0 tricky", None), (51, "http://x\r\ny", "é\r\n\r\nWARC/1.1\r\n\0 tricky", None), (52, "u", "big " * 100_000, None)]
    _, got = round_trip(spark, rows)
    first = {}
    for i, _, html, _ in sorted(rows):
        first.setdefault(html or "", i)
    want = set()
    for i, _, html, _ in rows:
        payload = (html or "").encode()
        original = first[html or ""]
        want.add((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if original == i else "revisit", None if original == i else original))
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want and len(got) == len(rows)


def test_small_payloads_may_stay_responses(spark):
    _, got = round_trip(spark, [(1, "a", "same", None), (2, "b", "same", None)], min_bytes=5)
    assert [r.record_type for r in got] == ["response"] * 2


def test_null_and_repeated_ids(spark):
    path, got = round_trip(spark, [(None, "a", "t", None), (None, "b", "t", None), (3, "c", "u", None), (3, "c", "u", None), (4, "d", "u", None), (None, "e", "u", None)])
    assert sorted(((str(r.page_id), r.record_type, r.refers_to) for r in got), key=str) == sorted([("None", "response", None), ("None", "revisit", None), ("3", "response", None), ("3", "revisit", 3), ("4", "revisit", 3), ("None", "revisit", 3)], key=str)
    assert warc.read(spark, path).select("record_id").distinct().count() == 6


def test_many_copies_of_rows_have_one_response_and_ids_of_their_own(spark):
    rows = [(1, "u", "a" * 50, None)] * 300 + [(2, "u", "a" * 50, None)] * 5 + [(7, None, None, None)] * 4 + [(8, "v", "b", None), (8, "w", "b", None)]
    path, got = round_trip(spark, rows)
    assert Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == {(1, 50, "response", None): 1, (1, 50, "revisit", 1): 299, (2, 50, "revisit", 1): 5, (7, 0, "response", None): 1, (7, 0, "revisit", 7): 3, (8, 1, "response", None): 1, (8, 1, "revisit", 8): 1}
    assert warc.read(spark, path).select("record_id").distinct().count() == len(rows)
    _, small = round_trip(spark, rows, min_bytes=2)
    assert Counter((r.page_id, r.record_type) for r in small if r.page_id > 2) == {(7, "response"): 4, (8, "response"): 2}


def test_files_are_cut_by_bytes_and_start_with_warcinfo(spark):
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "concat_ws(' ', transform(sequence(1, 20000), x -> hash(id, x))) AS html").coalesce(1)
    path = scratch_path(spark, "warc")
    warc.write(pages, path, part_bytes=100_000, file_bytes=400_000)
    files = spark.read.format("binaryFile").load(path).select("length", "content").collect()
    assert len(files) > 5 and all(f.length < 1_000_000 for f in files) and warc.read(spark, path).count() == 40
    for f in files:
        kinds = [h["warc-type"] for h, _ in warc.records(bytes(f.content))]
        assert kinds[0] == "warcinfo" and kinds.count("warcinfo") <= 4


def test_an_id_with_several_payloads(spark):
    path, got = round_trip(spark, [(5, "u", "aaaa", None), (5, "u", "b" * 20, None), (6, "v", "b" * 20, None)])
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == [(5, 4, "response", None), (5, 20, "response", None), (6, 20, "revisit", 5)]
    assert all(r.payload_digest == base64.b32encode(hashlib.sha1(b"b" * 20).digest()).decode() for r in got if r.payload_bytes == 20)
    assert warc.read(spark, path).select("record_id").distinct().count() == 3


def test_files_are_gzip_members_of_whole_records(spark):
    path, _ = round_trip(spark, [(1, "http://a/", "one", None), (2, "http://b/", "one", None)])
    names = [f.path for f in spark.read.format("binaryFile").load(path).select("path").collect()]
    raw = b"".join(open(n.removeprefix("file:"), "rb").read() for n in names)
    text = gzip.decompress(raw)
    assert text.count(b"WARC-Page-Number") == 2 and text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and text.count(b"WARC-Profile") == 1 and text.endswith(b"\r\n\r\n")
    assert [h["warc-type"] for h, _ in warc.records(raw)].count("revisit") == 1


def test_members_of_large_records_end_in_zero():
    for size in (0, 10, (1 << 24) + 5):
        packed = warc.member(b"x" * size, 1) + b"\0"
        assert gzip.open(io.BytesIO(packed)).read() == b"x" * size


def test_empty_table(spark):
    assert round_trip(spark, [])[1] == []
