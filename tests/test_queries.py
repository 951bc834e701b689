"""Every query of the library against its SQL, on the smallest driver tables."""

import datetime
import glob
import os

import pytest

from airgrid import plans

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return f"{v:.6g}"
    return v.isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, db, name):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted([plain(v) for v in r] for r in df.select(*columns).collect())
    if name in plans.SQL:
        want = db.sql(plans.SQL[name])
        assert sorted(want.columns) == columns
        assert rows == sorted([plain(v) for v in r] for r in want.select(*columns).fetchall())


def test_pages_are_of_bounded_size(spark, tmp_path, monkeypatch):
    """Pages of suppliers and customers grow in number with the tables, not in size."""
    from pyspark.sql import functions as F

    from airgrid.plans import table_queries

    spark.range(5000).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name"), F.lit(1).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(5000).select(F.col("id").alias("c_custkey"), F.concat(F.lit("M"), F.col("id") % 3).alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    seen = []
    for name in ("catalogue_rows", "facet_labels"):
        def keep(pages, *more, own=getattr(table_queries.html, name)):
            seen.append(pages)
            return own(pages, *more)

        monkeypatch.setattr(table_queries.html, name, keep)
    assert table_queries.catalogue_cells(spark, str(tmp_path)).distinct().count() == 5000
    assert {tuple(r) for r in table_queries.facet_labels(spark, str(tmp_path)).collect()} == {("M0", 1667), ("M1", 1667), ("M2", 1666)}
    for pages in seen:
        n, longest = pages.agg(F.count(F.lit(1)), F.max(F.size(F.split("html", "<tr>")) - 1)).first()
        assert n >= 100 and longest <= table_queries.PAGE_ROWS


def test_without_the_optional_parts(spark):
    import __spark_entry__

    assert set(plans.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__._optional("airgrid.llm_that_is_not_there") is None
    assert __spark_entry__.entry(spark).limit(1).count() == 1
