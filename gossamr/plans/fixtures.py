"""Crawl states made from the driver's tables: what the queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.functions import urls
from gossamr.session import materialize
from gossamr.sources import links as links_

#: Second that the queries take for now.
NOW = 1_706_572_800
#: Suffixes of allowed hosts, where a query needs hosts that are not.
ALLOWED = (".com", ".org")
#: Numbers of event types, as children in edge sets.
TYPES = {"view": 1, "signup": 2, "error": 3, "click": 4, "purchase": 5}
#: Offsets of the layers' node ids.
NATION, CUSTOMER, ORDER, PART, SUPPLIER = 1_000, 1_000_000, 2_000_000, 5_000_000, 9_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links_.extract(table(spark, sf_dir, "pages"))


def tops(spark: SparkSession, sf_dir: str, only_allowed: bool = False) -> DataFrame:
    """Hosts of pages, numbered by their first page; or those with an allowed suffix."""
    hosts = table(spark, sf_dir, "pages").select(urls.host(F.col("url")).alias("hostname"), "page_id").groupBy("hostname").agg((F.min("page_id") + 1).alias("id"))
    return hosts.filter(F.col("hostname").rlike(r"\.(com|org)$")) if only_allowed else hosts


def field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages (fetched, id: page_id) and the clean targets of their links (not fetched, id: first place of the link)."""
    pages = table(spark, sf_dir, "pages").groupBy(urls.clean(F.col("url")).alias("url")).agg(F.min("page_id").alias("id")).withColumn("checkd", F.lit(NOW))
    found = page_links(spark, sf_dir).select(urls.clean(F.col("link")).alias("url"), (1_000_000 + F.col("page_id") * 1000 + F.col("pos")).alias("id"))
    targets = found.groupBy("url").agg(F.min("id").alias("id")).join(pages.select("url"), "url", "left_anti")
    return pages.unionByName(targets.withColumn("checkd", F.lit(None).cast("int")))


def layered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """nodes (url_id, depth: 0 for region 0) and edges of the layered graph of regions to suppliers."""
    t = lambda name: table(spark, sf_dir, name)
    pair = lambda df, a, b: df.select(F.expr(a).cast("long").alias("from_id"), F.expr(b).cast("long").alias("to_id"))
    lines = t("lineitem")
    edges = pair(t("nation"), "n_regionkey", f"n_nationkey + {NATION}")
    edges = edges.union(pair(t("customer"), f"c_nationkey + {NATION}", f"c_custkey + {CUSTOMER}")).union(pair(t("supplier"), f"s_nationkey + {NATION}", f"s_suppkey + {SUPPLIER}"))
    edges = edges.union(pair(t("orders"), f"o_custkey + {CUSTOMER}", f"o_orderkey + {ORDER}")).union(pair(lines, f"l_orderkey + {ORDER}", f"l_partkey + {PART}")).union(pair(lines, f"l_partkey + {PART}", f"l_suppkey + {SUPPLIER}")).distinct()
    edges = materialize(edges, "layered-edges")  # read by every step of a search
    ids = edges.select(F.col("from_id").alias("url_id")).union(edges.select("to_id")).distinct()
    return ids.withColumn("depth", F.when(F.col("url_id") == 0, 0)), edges


def redirect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").filter("l_quantity >= 49 and l_discount >= 0.09").select(F.col("l_orderkey").alias("from_id"), (1_000_000 + F.col("l_partkey")).alias("to_id")).distinct()


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """edges: from a user's day to the types of its events."""
    kind = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    return table(spark, sf_dir, "events").select((F.col("user_id") * 100 + F.dayofmonth("ts")).cast("long").alias("from_id"), F.try_element_at(kind, F.col("event_type")).cast("long").alias("to_id"))


def param_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A URL for each user's day, made from its first event."""
    events = table(spark, sf_dir, "events").select((F.col("user_id") * 100 + F.dayofmonth("ts")).cast("long").alias("id"), F.struct("event_id", "event_type", "user_id", F.get_json_object("props", "$.k").alias("k")).alias("e"))
    first = events.groupBy("id").agg(F.min("e").alias("e"))
    return first.select("id", F.concat(F.lit("http://ex.org/"), F.col("e.event_type"), F.lit("?k="), F.col("e.k"), F.lit("&u="), (F.col("e.user_id") % 10).cast("string"), F.lit("&t="), F.col("e.event_type")).alias("url"))


def download_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("url_id"), F.floor(F.col("value") / 10).cast("long").alias("priority"), (F.col("user_id") % 8 + 1).alias("host_id"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as responses: errors are 429 or 503, with k seconds to wait, unless k is under 10."""
    k = F.get_json_object("props", "$.k")
    bad = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 8 + 1).alias("host_id"), F.when(~bad, 200).when(F.col("value") < 250, 429).otherwise(503).alias("code"), F.when(bad & (F.length(k) > 1), k).alias("retry_after"))


def order_state(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders as URLs: O not fetched, F parsed; locality and volumes by the customer's nation and the month."""
    orders = table(spark, sf_dir, "orders")
    nations = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey"))
    rows = orders.join(nations, "o_custkey").select(F.col("o_orderkey").alias("id"), "o_orderstatus", "c_nationkey", F.month("o_orderdate").cast("long").alias("m"), "o_totalprice", "o_orderpriority")
    seen = F.when(F.col("o_orderstatus") != "O", NOW)
    return {
        "field": rows.select("id", F.concat(F.lit("http://shop.example/"), F.col("id").cast("string")).alias("url"), seen.alias("checkd"), F.when(F.col("o_orderstatus") == "F", NOW).alias("parsed")),
        "download_error": rows.filter("o_orderstatus <> 'O' and o_orderpriority = '1-URGENT'").select(F.col("id").alias("url_id"), F.lit(500).alias("error_code")),
        "locality": rows.filter("o_orderstatus <> 'O' and c_nationkey >= 5").select(F.col("id").alias("url_id"), (F.col("c_nationkey") / 5).cast("long").alias("instance_id")),
        "content": rows.filter("o_orderstatus = 'F'").select(F.col("id").alias("url_id"), F.col("m").alias("volume_id")),
        "directory": rows.filter("o_orderstatus = 'F'").select(F.col("m").alias("id")).distinct().withColumn("written", F.when(F.col("id") <= 9, NOW)),
        "volume_loc": rows.filter("o_orderstatus = 'F'").select(F.col("m").alias("volume_id")).distinct().filter("volume_id > 3").withColumn("instance_id", (F.col("volume_id") / 3).cast("long")),
        "parse_queue": rows.filter("o_orderstatus = 'P'").filter("o_totalprice > 200000").select(F.col("id").alias("url_id")),
    }


def raw_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw headers for each page: a redirect's block and the final one, with two content types."""
    text = F.concat(F.lit("HTTP/1.1 301 Moved\r\nContent-Type: text/plain\r\n\r\nHTTP/1.1 200 All is OK\r\nServer : s\r\nContent-Type: Text/HTML; charset=utf-8\r\nX-Page: "), F.col("page_id").cast("string"), F.lit("\r\n"))
    return table(spark, sf_dir, "pages").select("page_id", text.alias("headers"))
