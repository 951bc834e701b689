"""Ink profiles of scanned pages to columns and rows.

A profile is a row for each position: page_id, axis, column_index, pos, ink. Runs are half open: [start, stop).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANE = ("page_id", "axis", "column_index")


def half_up(c: Column) -> Column:
    return F.floor(c + 0.5)


def threshold_runs(profile: DataFrame, keep: Column, min_width: int = 1, max_width: int | None = None, key: tuple[str, ...] = LANE) -> DataFrame:
    """(key, start, stop) of the longest runs of neighbouring positions that `keep` holds for."""
    w = Window.partitionBy(*key).orderBy("pos")
    runs = profile.where(keep).withColumn("island", F.col("pos") - F.row_number().over(w)).groupBy(*key, "island").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("stop"))
    width = F.col("stop") - F.col("start")
    return runs.where(width >= min_width).where(F.lit(True) if max_width is None else width <= max_width).drop("island")


def merge_close_runs(runs: DataFrame, max_gap: int = 20, key: tuple[str, ...] = LANE) -> DataFrame:
    """Runs with at most max_gap between them become one. They are apart and in order, so only neighbours matter."""
    w = Window.partitionBy(*key).orderBy("start")
    new = F.coalesce(F.col("start") - F.lag("stop").over(w) > max_gap, F.lit(True)).cast("int")
    return runs.withColumn("new", new).withColumn("g", F.sum("new").over(w)).groupBy(*key, "g").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("g")


def columns_from_gutters(gutters: DataFrame, min_width: int = 20, key: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """(key, column_index, x, width) of what lies between one gutter and the next."""
    w = Window.partitionBy(*key).orderBy("start")
    df = gutters.withColumn("width", F.lead("start").over(w) - F.col("stop")).where(F.col("width") >= min_width)
    return df.select(*key, (F.row_number().over(w) - 1).alias("column_index"), F.col("stop").alias("x"), "width")


def drop_edge_columns(columns: DataFrame, ratio: float = 0.5, key: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Of more than 2 columns the last goes if it is narrower than ratio times the others' upper median; then, of what is left, the first."""

    def drop(df: DataFrame, last: bool) -> DataFrame:
        order = F.desc("x") if last else F.asc("x")
        df = df.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy(order))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
        others = F.sort_array(F.collect_list(F.when(F.col("r") > 1, F.col("width"))).over(Window.partitionBy(*key)))
        df = df.withColumn("median", F.get(others, F.floor((F.col("n") - 1) / 2).cast("int")))
        gone = (F.col("n") > 2) & (F.col("r") == 1) & (F.col("width") < ratio * F.col("median"))
        return df.where(~F.coalesce(gone, F.lit(False))).drop("r", "n", "median")

    return drop(drop(columns, True), False)


def merge_nearby_points(points: DataFrame, max_gap: float = 80, key: tuple[str, ...] = ("page_id",), pos: str = "pos") -> DataFrame:
    """(key, pos): a point stays if it is more than max_gap after the last that stayed. A fold over the points of one page."""
    sorted_points = F.sort_array(F.collect_list(F.col(pos).cast("double")))
    none = F.array().cast("array<double>")
    keep = F.aggregate(sorted_points, none, lambda kept, p: F.when((F.size(kept) == 0) | (p - F.element_at(kept, -1) > max_gap), F.concat(kept, F.array(p))).otherwise(kept))
    one = F.when(F.size(sorted_points) > 0, keep).otherwise(none)
    return points.groupBy(*key).agg(one.alias("k")).select(*key, F.explode("k").alias(pos))


def greedy_clusters(points: list[tuple[int, float]], tolerance: float) -> list[tuple[float, int, int]]:
    """(mean, distinct columns, points) of clusters: a point joins the first whose running mean is within tolerance."""
    clusters: list[list] = []
    for column, pos in points:
        own = next((c for c in clusters if abs(c[0] / c[1] - pos) <= tolerance), None)
        if own is None:
            clusters.append([pos, 1, {column}])
        else:
            own[0] += pos
            own[1] += 1
            own[2].add(column)
    return [(s / n, len(cols), n) for s, n, cols in clusters]


def cluster_by_position(candidates: DataFrame, tolerance: float = 30) -> DataFrame:
    """(page_id, pos, coverage, points) of candidates (page_id, column_index, pos), column by column and top to bottom.

    Each join depends on the ones before; a page has tens of candidates, so each page is one small group.
    """
    kind = candidates.schema["page_id"].dataType.simpleString()
    pages = candidates.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("column_index", F.col("pos").cast("double").alias("pos")))).alias("c"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(page, *x) for page, c in zip(b["page_id"], b["c"], strict=True) for x in greedy_clusters([(p["column_index"], p["pos"]) for p in c], tolerance)]
            yield pd.DataFrame(out, columns=["page_id", "pos", "coverage", "points"])

    return pages.mapInPandas(run, f"page_id {kind}, pos double, coverage int, points int")


def contrast_filter(clusters: DataFrame, profile: DataFrame, columns: DataFrame, window: int = 100, offset: int = 3, density: float = 0.4, contrast: float = 0.15, offset_before: int = 0) -> DataFrame:
    """Clusters seen in nearly all columns, with dense ink after them and less before.

    profile (page_id, column_index, pos, ink) of the rows, columns (page_id, column_index, width). Ink is summed up
    along each column once, so each window is the difference of two look-ups.
    """
    total = profile.groupBy("page_id", "pos").agg(F.sum("ink").alias("ink"))
    w = Window.partitionBy("page_id").orderBy("pos")
    sums = total.select("page_id", (F.col("pos") + 1).alias("at"), F.sum("ink").over(w).alias("upto"))
    size = columns.groupBy("page_id").agg(F.sum("width").alias("area"), F.count(F.lit(1)).alias("n"))
    height = profile.groupBy("page_id").agg((F.max("pos") + 1).alias("height"))
    c = clusters.join(size, "page_id").join(height.hint("shuffle_merge"), "page_id").where(F.col("coverage") >= F.greatest(F.lit(1), F.col("n") - 1))
    y = half_up(F.col("pos"))
    clip = lambda v: F.greatest(F.lit(0), F.least(F.col("height"), v))
    c = c.withColumns({"a0": clip(y + offset), "a1": clip(y + offset + window), "b0": clip(y - offset_before - window), "b1": clip(y - offset_before)})
    # One join for all edges. Profiles are never broadcast, whatever size Spark guesses.
    edges = c.select("page_id", F.explode(F.array("a0", "a1", "b0", "b1")).alias("at")).distinct()
    known = sums.hint("shuffle_merge").join(edges, ["page_id", "at"]).groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "upto"))).alias("upto"))
    c = c.join(known.hint("shuffle_merge"), "page_id", "left")
    c = c.withColumns({f"s_{e}": F.coalesce(F.try_element_at("upto", F.col(e)), F.lit(0)) for e in ("a0", "a1", "b0", "b1")})
    mean = lambda a, b: F.when(F.col(b) > F.col(a), (F.col(f"s_{b}") - F.col(f"s_{a}")) / (F.col("area") * (F.col(b) - F.col(a)))).otherwise(F.lit(0.0))
    c = c.withColumn("after", mean("a0", "a1")).withColumn("before", mean("b0", "b1"))
    return c.where((F.col("after") >= density) & (F.col("after") - F.col("before") >= contrast)).select("page_id", "pos", "coverage", "after", "before")


def top_gap_clusters(clusters: DataFrame, rows: DataFrame) -> DataFrame:
    """(page_id, pos): of clusters seen in nearly all columns the rows - 1 with the widest coverage, then from the top. rows (page_id, columns, rows)."""
    c = clusters.join(rows, "page_id").where(F.col("coverage") >= F.greatest(F.lit(1), F.col("columns") - 1))
    r = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("coverage"), "pos"))
    return c.withColumn("r", r).where(F.col("r") <= F.col("rows") - 1).select("page_id", half_up(F.col("pos")).cast("int").alias("pos"))


def fill_missing_cuts(cuts: Column, height: Column, rows: Column) -> Column:
    """array<int> of rows - 1 cuts: the largest interval is halved until there are enough; the topmost stay if there are too many."""
    own = F.slice(F.sort_array(cuts), F.lit(1), F.greatest(rows - 1, F.lit(0)))
    edges = F.concat(F.array(F.lit(0)), own, F.array(height.cast("int")))

    def halve(e: Column, _: Column) -> Column:
        gaps = F.transform(F.slice(e, F.lit(2), F.size(e) - 1), lambda x, i: F.struct((x - F.get(e, i)).alias("gap"), (-i).alias("i")))
        widest = F.array_max(gaps)
        i = -widest["i"]
        middle = half_up((F.get(e, i) + F.get(e, i + 1)) / 2).cast("int")
        return F.concat(F.slice(e, F.lit(1), i + 1), F.array(middle), F.slice(e, i + 2, F.size(e)))

    missing = rows - 1 - F.size(own)
    steps = F.when(missing > 0, F.sequence(F.lit(1), missing)).otherwise(F.array().cast("array<int>"))
    full = F.aggregate(steps, edges, halve)
    return F.slice(full, F.lit(2), F.size(full) - 2)


def even_cuts(height: Column, rows: Column) -> Column:
    return F.when(rows > 1, F.transform(F.sequence(F.lit(1), rows - 1), lambda k: half_up(height * k / rows).cast("int"))).otherwise(F.array().cast("array<int>"))


def cuts_of_pages(pages: DataFrame, points: DataFrame) -> DataFrame:
    """pages (page_id, height, rows, separator) with cuts array<int>: even ones, or the points (page_id, pos) filled up."""
    own = points.groupBy("page_id").agg(F.sort_array(F.collect_list(half_up(F.col("pos")).cast("int"))).alias("own"))
    found = fill_missing_cuts(F.coalesce("own", F.array().cast("array<int>")), F.col("height"), F.col("rows"))
    return pages.join(own, "page_id", "left").withColumn("cuts", F.when(F.col("separator") == "even", even_cuts(F.col("height"), F.col("rows"))).otherwise(found)).drop("own")


def line_candidates(rows: DataFrame, columns: DataFrame, pages: DataFrame, top: float, bottom: float, ratio: float = 0.85, min_height: int = 2, max_height: int = 20) -> DataFrame:
    """(page_id, column_index, pos) of the middles of printed lines: runs of rows between the margins with ink over ratio of their column's width."""
    height = F.col("height")
    inside = (F.col("pos") >= half_up(height * top)) & (F.col("pos") < height - half_up(height * bottom))
    widths = columns.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("column_index", "width"))).alias("widths"))
    own = widths.hint("shuffle_merge").join(pages.select("page_id", "height"), "page_id")
    known = rows.hint("shuffle_merge").join(own, "page_id").withColumn("width", F.try_element_at("widths", F.col("column_index"))).drop("widths")
    return middles(threshold_runs(known, inside & (F.col("ink") >= ratio * F.col("width")), min_height, max_height))


def whitespace_candidates(rows: DataFrame, pages: DataFrame, most: int = 2, min_height: int = 8, margin: int = 50) -> DataFrame:
    """(page_id, column_index, pos) of the middles of blank runs of rows, those at the top and bottom of the page left out."""
    runs = threshold_runs(rows, F.col("ink") <= most, min_height).join(pages.select("page_id", "height"), "page_id")
    return middles(runs.where((F.col("start") > margin) & (F.col("stop") < F.col("height") - margin)))


def middles(runs: DataFrame) -> DataFrame:
    return runs.select("page_id", "column_index", ((F.col("start") + F.col("stop")) / 2).alias("pos"))


def whitespace_points(clusters: DataFrame, rows: DataFrame, max_gap: float = 80) -> DataFrame:
    """(page_id, pos): the top clusters of each page, without those that are near one above."""
    return merge_nearby_points(top_gap_clusters(clusters, rows), max_gap)


def detect_row_cuts(rows: DataFrame, columns: DataFrame, pages: DataFrame, top: float = 0.08, bottom: float = 0.02) -> DataFrame:
    """pages (page_id, height, rows, separator) with cuts array<int>, by the separator: whitespace, even, or line for any other or none.

    rows is the ink of each row of each column, columns (page_id, column_index, x, width). Printed lines count where a
    dense band follows them; blank runs where nearly all columns have one. What is missing is filled up.
    """
    kind = F.when(F.col("separator").isin("whitespace", "even"), F.col("separator")).otherwise(F.lit("line"))
    by = lambda separator: pages.where(kind == separator).select("page_id")
    # Spark takes profiles for small tables if they come from one; they are shuffled, never broadcast.
    of = lambda df, separator: df.hint("shuffle_merge").join(by(separator), "page_id", "left_semi")
    lines = cluster_by_position(line_candidates(of(rows, "line"), columns, pages, top, bottom))
    lines = contrast_filter(lines, of(rows, "line"), of(columns, "line"), offset_before=3).select("page_id", half_up(F.col("pos")).alias("pos"))
    wanted = pages.join(columns.groupBy("page_id").agg(F.count(F.lit(1)).alias("columns")), "page_id").select("page_id", "columns", "rows")
    blanks = whitespace_points(cluster_by_position(whitespace_candidates(of(rows, "whitespace"), pages)), wanted)
    return cuts_of_pages(pages, merge_nearby_points(lines).unionByName(blanks))
