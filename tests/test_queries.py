import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gossamr.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(columns), sorted(repr([plain(r[i]) for i in order]) for r in found)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    relation = duck.sql(ORACLES[name])
    assert rows(df.columns, df.collect()) == rows(relation.columns, relation.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_orders_beyond_a_million_have_bodies(spark, tmp_path):
    """Ids of 1,000,000 and more have a body on either side of a redirect, as the SQL has it."""
    rows = spark.createDataFrame([(5, 1, 50.0, 0.1), (1_000_007, 1, 50.0, 0.1), (999_999, 3, 49.0, 0.09), (8, 8, 1.0, 0.1)], "l_orderkey long, l_partkey long, l_quantity double, l_discount double")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {(r.component, r["size"], r.id, r.has_body) for r in QUERIES["redirect_classes"](spark, str(tmp_path)).collect()}
    assert got == {(5, 3, 5, False), (5, 3, 1_000_001, True), (5, 3, 1_000_007, True), (999_999, 2, 999_999, False), (999_999, 2, 1_000_003, True)}
    assert {(r.id, r.line[0]) for r in QUERIES["class_report"](spark, str(tmp_path)).collect()} == {(i, "!" if b else "h") for _, _, i, b in got}
