from pyspark.sql import functions as F

from gossamr.streaming.activity import Activity, counted


def test_metrics_are_observed_while_rows_are_written(spark):
    df, seen = counted(spark.range(100), "numbers", rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    assert seen == {"rows": 100, "odd": 50} and df.count() == 100
    assert counted(spark.range(0), "none")[1] == {"rows": 0}


def test_activity_counts_streams_and_their_rows(spark, tmp_path):
    for k in range(3):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    with Activity(spark) as activity:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).observe("seen", F.count(F.lit(1)).alias("rows"), F.sum("id").alias("total"))
        query = stream.writeStream.queryName("counted").format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert activity.wait(30) and activity.live() == 0
        assert activity.rows["counted"] == 30 and activity.metrics["seen"] == {"rows": 30, "total": 435}
