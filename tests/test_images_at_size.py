"""Images and profiles that Spark takes for small tables are dealt to all cores, never broadcast, and reduced by shape."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgrid.operators import profile
from airgrid.plans import page_queries
from airgrid.sources import images


def pages(spark, shapes):
    rng = np.random.default_rng(1)
    arrays = {str(i): rng.integers(0, 256, s, dtype=np.uint8) for i, s in enumerate(shapes)}
    rows = [(k, *a.shape, bytearray(a.tobytes())) for k, a in arrays.items()]
    return arrays, spark.createDataFrame(rows, "page_id string, height int, width int, nChannels int, data binary").coalesce(1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_cuts_never_broadcast_images_or_profiles(spark):
    _, read = pages(spark, [(50, 30, 1)])
    columns = spark.createDataFrame([("0", 0, 3, 8)], "page_id string, column_index int, x int, width int")
    assert "Broadcast" not in plan(images.row_ink_profile(read, columns))
    rows = spark.createDataFrame([("0", "y", 0, y, 8) for y in range(50)], "page_id string, axis string, column_index int, pos int, ink int")
    clusters = spark.createDataFrame([("0", 20.0, 1, 1)], "page_id string, pos double, coverage int, points int")
    assert "LeftOuter, BuildRight" not in plan(profile.contrast_filter(clusters, rows, columns))
    known = spark.createDataFrame([("0", 50, 2, "line")], "page_id string, height int, rows int, separator string")
    assert "BroadcastHashJoin [page_id" not in plan(profile.line_candidates(rows, columns, known, 0.08, 0.02))


def test_profiles_of_mixed_shapes(spark):
    """A batch of images of many shapes, some empty of columns, against the pixels."""
    shapes = [(50, 20, 1), (60, 24, 3), (50, 20, 1), (40, 33, 4), (50, 20, 3), (50, 20, 1)] * 3
    arrays, read = pages(spark, shapes)

    def dark(a):
        bgr = a[:, :, :3] if a.shape[2] >= 3 else np.repeat(a[:, :, :1], 3, axis=2)
        return bgr @ np.array([0.114, 0.587, 0.299]) < 180

    want = {(k, x, int(v)) for k, a in arrays.items() for x, v in enumerate(dark(a)[slice(*images.margins(a.shape[0]))].sum(axis=0))}
    assert {(r["page_id"], r["pos"], r["ink"]) for r in images.column_ink_profile(read).collect()} == want
    columns = read.where("page_id <> '0'").select("page_id", F.inline(F.expr("array(struct(0 as column_index, 3 as x, 8 as width), struct(1 as column_index, 12 as x, 40 as width))")))
    want = {(k, c, y, int(v)) for k, a in arrays.items() if k != "0" for c, x, w in ((0, 3, 8), (1, 12, 40)) for y, v in enumerate(dark(a)[:, x : x + w].sum(axis=1))}
    got = [(r["page_id"], r["column_index"], r["pos"], r["ink"]) for r in images.row_ink_profile(read, columns).collect()]
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("name, operator", [("ink_columns", "column_ink_profile"), ("ink_rows", "row_ink_profile"), ("banner_ratios", "banner_color_ratio"), ("row_cuts_of_pages", "row_cuts_of_images")])
def test_pages_of_one_row_group_reach_all_cores(spark, tmp_path, monkeypatch, name, operator):
    for table, key in (("part", "p_partkey"), ("supplier", "s_suppkey")):
        spark.range(100).withColumnRenamed("id", key).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    seen = []

    def keep(read, *more, own=getattr(images, operator)):
        seen.append(read)
        return own(read, *more)

    monkeypatch.setattr(images, operator, keep)
    getattr(page_queries, name)(spark, str(tmp_path))
    assert seen[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
