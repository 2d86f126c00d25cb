from gossamr.plans import fixtures as fx
from gossamr.plans.queries import QUERIES
from gossamr.streaming import frontier as streams


def test_admission_stream_equals_batch(spark, data):
    from gossamr.operators import frontier

    got = {tuple(r) for r in QUERIES["stream_admission"](spark, data).collect()}
    rows = frontier.classify(fx.page_links(spark, data), fx.tops(spark, data, True)).filter("host_id is not null and skip_reason is null")
    assert got == {(r.clean_url, r.host_id) for r in rows.collect()}


def test_hold_stream_keeps_the_latest(spark, tmp_path):
    schema = "host_id long, until long"
    spark.createDataFrame([(1, 5), (1, 9), (2, 3)], schema).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    rows = streams.collect_available(streams.hold_stream(source), "holds")
    assert {r.host_id: r.until for r in rows.groupBy("host_id").agg({"until": "max"}).withColumnRenamed("max(until)", "until").collect()} == {1: 9, 2: 3}
