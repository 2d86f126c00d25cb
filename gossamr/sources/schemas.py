"""Schemas of the crawl tables, for readers and for empty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = {
    "instances": "id long, instance_name string",
    "tops": "id long, hostname string",
    "field": "id long, url string, checkd timestamp_ntz, parsed timestamp_ntz",
    "host_inst": "host_id long, instance_id long",
    "download_queue": "url_id long, priority long, host_id long",
    "download_error": "url_id long, error_code int, error_message string, failed timestamp_ntz",
    "directory": "id long, written timestamp_ntz",
    "content": "url_id long, volume_id long",
    "parse_queue": "url_id long",
    "redirect": "from_id long, to_id long",
    "activity": "id long, total_count long",
    "locality": "url_id long, instance_id long",
    "neighbors": "id long, url string",
    "volume_loc": "volume_id long, instance_id long",
    "nodes": "url_id long, depth int, yield double",
    "edges": "from_id long, to_id long",
    "param_blacklist": "nameval string",
    "edge_sets": "from_set array<long>, to_set array<long>",
    "param_scoreboard": "nameval string, agreement long, irrelevancy long",
    "extra": "url_id long, content_type string, has_body boolean, hash string, siz long",
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def scan(spark: SparkSession, root: str, table: str, schema: str | None = None) -> DataFrame:
    """A table stored as Parquet under root, in the folder of its crawl schema if there is one."""
    return spark.read.schema(TABLES[table]).parquet("/".join(x for x in (root, schema, table) if x))


def create_schema(spark: SparkSession, name: str) -> None:
    """A catalog database for a crawl, made current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)
