"""Point lookups in the table of URLs: a layout with Bloom filters, and reads that touch few row groups of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.session import sized

#: Keys that are looked up by a filter on the scan; more are joined.
POINTS = 64


def write_field(field: DataFrame, path: str, row_group_bytes: int = 16 << 20, files: int | None = None) -> None:
    """Write field (id, url and others) for lookups: sorted by url, whose row groups then have apart ranges, with Bloom
    filters of url and id, of which ids are all over the files.
    """
    rows = field.repartitionByRange(files, "url") if files else field.repartitionByRange("url")
    writer = rows.sortWithinPartitions("url").write.option("parquet.block.size", row_group_bytes)
    for column in ("url", "id"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{column}", "true")
    writer.parquet(path)


def _found(spark: SparkSession, path: str, column: str, keys: list) -> DataFrame:
    rows, keys = spark.read.parquet(path), sorted({k for k in keys if k is not None})
    if len(keys) > POINTS:
        wanted = spark.createDataFrame([(k,) for k in keys], f"{column} {dict(rows.dtypes)[column]}")
        return rows.join(sized(wanted), column, "left_semi").select(*rows.columns)
    wanted = F.lit(False)
    for k in keys:
        wanted = wanted | (F.col(column) == k)  # single comparisons reach the row groups' filters, long lists do not
    return rows.filter(wanted)


def by_url(spark: SparkSession, path: str, urls: list[str | None]) -> DataFrame:
    """Rows of a table that write_field() has written, of some URLs. URLs that it does not hold give no row."""
    return _found(spark, path, "url", urls)


def by_id(spark: SparkSession, path: str, ids: list[int | None]) -> DataFrame:
    """The same of some ids."""
    return _found(spark, path, "id", ids)


def rows_scanned(df: DataFrame) -> int:
    """Runs df and tells how many rows its scans had to give out: those of the row groups that the filters left."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numOutputRows"):
            total += metrics.apply("numOutputRows").value()
    return total
