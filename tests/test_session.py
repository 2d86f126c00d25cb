import pytest

from gossamr import session


def test_broadcasts_are_bounded_by_rows_and_bytes(spark):
    df = spark.createDataFrame([(1, "x" * 1000, [1, 2], (3, "é"), ["a"], None)] * 20, "a long, b string, c array<long>, d struct<e:int,f:string>, g array<string>, h binary")
    assert session.fits(df) and session.fits(df.limit(0))
    assert not session.fits(df, limit=19) and not session.fits(df, rows=20, limit=19)
    assert not session.fits(df, most=20_000) and not session.fits(df, rows=20, most=20_000) and session.fits(df, most=23_000)
    assert session.fits(df.select("a"), rows=100, most=800) and not session.fits(df.select("a"), rows=101, most=800)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    assert session.shared_dir(spark)
