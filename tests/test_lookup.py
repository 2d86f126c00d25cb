from gossamr.sources import lookup


def test_lookups_read_few_row_groups(spark, tmp_path):
    """200,000 URLs in some dozen row groups: a URL or id there costs one of them, one that is not there none."""
    n, path = 200_000, str(tmp_path / "field")
    field = spark.range(n).selectExpr("(id * 7919) % 200000 AS id", "concat('http://h', id % 97, '.org/', md5(cast(id AS string))) AS url", "id AS checkd")
    lookup.write_field(field, path, row_group_bytes=1 << 19, files=4)
    some = [tuple(r) for r in field.orderBy("id").limit(3).collect()]
    whole = lookup.rows_scanned(spark.read.parquet(path))
    assert whole == n
    for i, url, checkd in some:
        by_url, by_id = lookup.by_url(spark, path, [url]), lookup.by_id(spark, path, [i])
        assert [tuple(r) for r in by_url.collect()] == [(i, url, checkd)] == [tuple(r) for r in by_id.collect()]
        assert lookup.rows_scanned(by_url) < n / 8 and lookup.rows_scanned(by_id) < n / 3
    assert lookup.rows_scanned(lookup.by_url(spark, path, ["http://h5.org/none", None])) < n / 8
    assert lookup.rows_scanned(lookup.by_id(spark, path, [-5])) == 0
    assert sorted(r.id for r in lookup.by_url(spark, path, [u for _, u, _ in some] + ["http://no/"]).collect()) == [0, 1, 2]


def test_many_keys_are_joined(spark, tmp_path):
    path = str(tmp_path / "field")
    lookup.write_field(spark.range(1000).selectExpr("id", "concat('http://a/', id) AS url"), path)
    assert lookup.by_id(spark, path, list(range(0, 2000, 2))).count() == 500
    assert lookup.by_url(spark, path, []).count() == 0
