"""Landed files, places in an order, periods by blocks of days, and separators by default."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from airgrid.operators import layout, profile
from airgrid.operators.order import numbered
from airgrid.shipping import ship
from airgrid.sources import files, landing


def test_landed_files_are_whole(spark, tmp_path):
    ship(spark)
    rows = [("a.htm", "une\r\npage é\n"), ("b.HTML", None), ("c.txt", "x")]
    df = spark.createDataFrame(rows, "name string, content string").repartition(2)
    for directory in (f"{tmp_path}/one", f"file://{tmp_path}/two", f"file:{tmp_path}/three"):
        for _ in range(2):  # the same files again
            landing.land_files(df, directory)
        got = {r["path"]: r["html"] for r in files.read_html_pages(spark, directory).collect()}
        assert got.get("a.htm") == "une\r\npage é\n" and not got.get("b.HTML") and set(got) <= {"a.htm", "b.HTML"}
    assert sorted(p.name for p in (tmp_path / "two").iterdir() if not p.name.startswith(".")) == ["a.htm", "b.HTML", "c.txt"]
    landing.land_files(df.limit(0), f"{tmp_path}/none")


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_places(spark, rows):
    r = random.Random(rows)
    values = [(r.randrange(100), i) for i in range(rows)]
    got = numbered(spark.createDataFrame(values, "a int, b int").repartition(7), F.col("a").desc(), F.col("b"), name="place").collect()
    assert [(x["a"], x["b"]) for x in sorted(got, key=lambda x: x["place"])] == sorted(values, key=lambda v: (-v[0], v[1]))
    assert sorted(x["place"] for x in got) == list(range(1, rows + 1))


def test_periods_by_brute_force(spark):
    r = random.Random(9)
    day = lambda n: datetime.date(1, 1, 1) + datetime.timedelta(n)
    bounds = [(r.randrange(3_650_000), r.choice([-1, 0, 1, 6, 300, 40_000])) for _ in range(300)] + [(0, 3_652_058), (719_162, 0), (719_160, 5)]
    periods = [(f"p{i}", day(a), day(max(0, min(a + n, 3_652_058))), (i * 7919) % 1000) for i, (a, n) in enumerate(bounds)]
    dates = [day(x) for a, n in bounds for x in (a, a + max(n, 0), a - 1) if 0 <= x <= 3_652_058] + [None]
    df = spark.createDataFrame([(d,) for d in dates], "page_date date")
    got = layout.resolve_period(df, spark.createDataFrame(periods, "period_name string, start_date date, end_date date, list_pos int"))
    for x in got.collect():
        fits = [(p[3], p[0]) for p in periods if x["page_date"] and p[1] <= x["page_date"] <= p[2]]
        assert x["period_name"] == (min(fits)[1] if fits else None)
    assert got.count() == len(dates)


def test_many_periods_of_a_decade_meet_dates_by_block(spark):
    """100,000 periods of one decade: of each block of days one stays, and a date meets one row of each level."""
    start = F.date_add(F.lit(datetime.date(1990, 1, 1)), (F.col("id") * 37 % 3600).cast("int"))
    periods = spark.range(100_000).select(F.concat(F.lit("p"), "id").alias("period_name"), start.alias("start_date"), F.date_add(start, (F.col("id") % 40).cast("int")).alias("end_date"), F.col("id").alias("list_pos"))
    dates = spark.range(3650).select(F.date_add(F.lit(datetime.date(1990, 1, 1)), F.col("id").cast("int")).alias("page_date"))
    out = layout.resolve_period(dates, periods)
    assert out.where("period_name is not null").count() >= 3600
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_separator_means_lines(spark):
    """A page without a separator, or with an unknown one, is cut as one with printed lines."""
    ink = [(p, "y", 0, y, 50 if y in (300, 301, 302) else 40 if 303 <= y < 420 else 0) for p in ("line", "none", "odd") for y in range(900)]
    rows = spark.createDataFrame(ink, "page_id string, axis string, column_index int, pos int, ink int")
    columns = spark.createDataFrame([(p, 0, 10, 50) for p in ("line", "none", "odd")], "page_id string, column_index int, x int, width int")
    pages = spark.createDataFrame([("line", 900, 2, "line"), ("none", 900, 2, None), ("odd", 900, 2, "dots")], "page_id string, height int, rows int, separator string")
    assert {r["page_id"]: r["cuts"] for r in profile.detect_row_cuts(rows, columns, pages).collect()} == dict.fromkeys(("line", "none", "odd"), [302])


def test_channel_tables_from_a_database(spark):
    """Both tables through JDBC, from a database in this JVM's memory."""
    url, properties = "jdbc:derby:memory:airgrid;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    channel = spark.createDataFrame([(1, "Une", "une"), (2, "Deux é", None)], "id_chaine int, nom_chaine string, url_chaine string")
    source = spark.createDataFrame([(1, "INA", "UNE")], "id_chaine int, code_source string, nom_chaine_source string")
    channel.write.jdbc(url, "chaine", "overwrite", properties)
    source.write.jdbc(url, "chaine_source", "overwrite", properties)
    got = files.read_channel_tables(spark, url, properties)
    assert [sorted(map(tuple, df.collect())) for df in got] == [[(1, "Une", "une"), (2, "Deux é", None)], [(1, "INA", "UNE")]]
