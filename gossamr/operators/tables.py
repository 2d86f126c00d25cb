"""Changes of keyed tables as pure functions: new ids, upserts, deletes with their rows, splits of queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gossamr.session import materialize


def last_id(table: DataFrame) -> int:
    """The largest id of a table, 0 if it is empty."""
    return table.agg(F.max("id")).first()[0] or 0


def numbered(rows: DataFrame, first: int, *order: str) -> DataFrame:
    """rows with id: first, first + 1 and so on in the given order, that must be a key.

    Ranges of rows are numbered in parallel; what meets in one place is a count for each range.
    """
    ranged = materialize(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)).cast("long")
    return ranged.join(F.broadcast(before.drop("_n")), "_range").withColumn("id", F.lit(first - 1).cast("long") + place + F.col("_before")).drop("_range", "_before")


def instance_id(instances: DataFrame, name: str | None) -> int | None:
    """The id of an instance by its name; None without a name, an error for an unknown one."""
    if not name:
        return None
    row = instances.filter(F.col("instance_name") == name).select("id").first()
    if row is None:
        raise LookupError(f"no instance is called {name}")
    return row.id


def insert_new(table: DataFrame, rows: DataFrame, *key: str) -> DataFrame:
    """table with those rows whose key it does not hold yet; of rows with equal keys one is taken."""
    return table.unionByName(rows.dropDuplicates(list(key)).join(table.select(*key), list(key), "left_anti").select(*table.columns))


def upsert_latest(table: DataFrame, rows: DataFrame, order: list[Column], *key: str) -> DataFrame:
    """table with rows put in place of those of the same key; among rows the first by order wins."""
    w = Window.partitionBy(*key).orderBy(F.desc("_new"), *order)
    both = table.withColumn("_new", F.lit(0)).unionByName(rows.select(*table.columns).withColumn("_new", F.lit(1)))
    return both.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank", "_new")


def upsert_add(table: DataFrame, deltas: DataFrame, key: str, *counters: str) -> DataFrame:
    """table with the deltas added to its counters; new keys appear."""
    both = table.select(key, *counters).unionByName(deltas.select(key, *counters))
    return both.groupBy(key).agg(*[F.sum(c).alias(c) for c in counters])


def without(table: DataFrame, column: str, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows of table whose column is not among ids; rows with null stay."""
    return table.join(ids.select(F.col(id_column).alias(column)).distinct(), column, "left_anti").select(*table.columns)


def pop(queue: DataFrame, n: int, *order: str) -> tuple[DataFrame, DataFrame]:
    """The first n rows of a queue by order (that must be a key of it), and the rest."""
    taken = queue.orderBy(*order).limit(n)
    return taken, queue.join(taken.select(*order), list(order), "left_anti").select(*queue.columns)
