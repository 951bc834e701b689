"""Page layouts: which period, page and version holds on a date, and where its blocks lie."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.functions.names import slugify
from airgrid.operators.order import numbered


#: Days before 1970 from the year 1 on; levels of blocks of days, the largest of which holds all years up to 9999.
_EARLIER, LEVELS = 719_162, 23


def day_number(date: Column) -> Column:
    """Days since the year 1, from 0."""
    return F.unix_date(date).cast("long") + _EARLIER


def resolve_period(dates: DataFrame, periods: DataFrame, date: str = "page_date") -> DataFrame:
    """dates with the first period, by list_pos, that covers them: period_name, null if none does.

    periods (period_name, start_date, end_date, list_pos) are cut into blocks of 2^level days that start at a multiple of
    their length, two of a level at most, and of each block the first period stays. A date is in one block of each level.
    So the join is on equal blocks, and neither long periods nor many of a time meet each other's dates.
    """
    first, behind = day_number(F.col("start_date")), day_number(F.col("end_date")) + 1

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        lo, hi = F.ceil(first / size).cast("long"), F.floor(behind / size).cast("long")
        own = F.array(F.when(lo % 2 == 1, lo), F.when(hi % 2 == 1, hi - 1))
        return F.when(lo < hi, F.transform(F.array_compact(own), lambda b: F.struct(level.alias("level"), b.alias("block"))))

    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    cut_up = periods.where("start_date <= end_date").withColumn("b", F.explode(F.flatten(F.filter(F.transform(levels, at), lambda x: x.isNotNull()))))
    best = cut_up.groupBy("b.level", "b.block").agg(F.min_by("period_name", "list_pos").alias("period_name"), F.min("list_pos").alias("list_pos"))
    d = dates.select(date).distinct().where(F.col(date).isNotNull())
    d = d.withColumn("level", F.explode(levels)).withColumn("block", F.call_function("shiftright", day_number(F.col(date)), F.col("level")))
    first_of = d.join(best, ["level", "block"]).groupBy(date).agg(F.min_by("period_name", "list_pos").alias("period_name"))
    return dates.join(first_of, date, "left")


def resolve_block_versions(blocks: DataFrame, date: str = "page_date") -> DataFrame:
    """blocks with the name of the first version that holds on the date; names without versions stay; null if none holds."""
    first = F.get(F.filter("versions", lambda v: F.col(date).between(v["from"], v["to"])), 0)["name"]
    return blocks.withColumn("name", F.when(F.coalesce(F.size("versions"), F.lit(0)) > 0, first).otherwise(F.col("name")))


def resolve_page_layout(pages: DataFrame, layout: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages with their blocks, pages that the layout doesn't have)."""
    keys = ["period_name", "page_number"]
    return pages.join(layout, keys), pages.join(layout.select(*keys).distinct(), keys, "left_anti")


def split_active_ignored(layout: DataFrame) -> tuple[DataFrame, DataFrame]:
    return layout.where("type <> 'ignored'"), layout.where("type = 'ignored'")


def channel_inventory(layout: DataFrame) -> DataFrame:
    """(name, slug) of every channel, versions included, in French order."""
    names = layout.select("name").unionByName(layout.select(F.explode("versions").alias("v")).select("v.name"))
    return names.where("name is not null").distinct().select("name", slugify(F.col("name")).alias("slug")).orderBy(F.collate("name", "fr"))


def ordered_inventory(layout: DataFrame) -> DataFrame:
    """channel_inventory with each channel's position in French order, from 1."""
    return numbered(channel_inventory(layout), F.collate("name", "fr"), F.col("name"))


def grid_cell_count(layout: DataFrame, page: tuple[str, ...] = ("period_name", "page_number")) -> DataFrame:
    return layout.groupBy(*page).agg(F.sum(F.coalesce("row_span", F.lit(1))).alias("cells"))


def row_bands(cuts: DataFrame) -> DataFrame:
    """(page_id, row, y, height) between the cuts array<int> of a page of that height; one band without cuts."""
    edges = F.concat(F.array(F.lit(0)), F.coalesce("cuts", F.array().cast("array<int>")), F.array(F.col("height")))
    bands = F.transform(F.sequence(F.lit(0), F.size("cuts")), lambda i: F.struct(F.get(edges, i).alias("y"), (F.get(edges, i + 1) - F.get(edges, i)).alias("height")))
    return cuts.select("page_id", F.posexplode(bands).alias("row", "b")).select("page_id", "row", "b.*")


def grid_mismatch(cells: DataFrame) -> DataFrame:
    """cells (page_id, cells, columns, rows): a message where the grid has not as many places as the layout."""
    expected = F.greatest(F.lit(1), F.floor(F.col("cells") / F.col("columns") + 0.5))
    message = F.concat(F.col("columns").cast("string"), F.lit(" x "), F.col("rows").cast("string"), F.lit(" places for "), F.col("cells").cast("string"), F.lit(" cells"))
    bad = F.col("columns") * F.col("rows") != F.col("cells")
    return cells.select("page_id", expected.cast("int").alias("expected_rows"), F.when(bad, message).alias("message"))


def place_blocks(spans: Sequence[int], columns: int, rows: int) -> list[tuple[int, int, int] | None]:
    """(column, row, rows taken) of each block: row by row into the first free place, spans downwards, cut at the last row."""
    taken = [[False] * columns for _ in range(rows)]
    free = ((r, c) for r in range(rows) for c in range(columns))
    out: list[tuple[int, int, int] | None] = []
    for span in spans:
        at = next(((r, c) for r, c in free if not taken[r][c]), None)
        if at is None:
            out.append(None)
            continue
        r, c = at
        n = min(max(1, span), rows - r)
        for k in range(n):
            taken[r + k][c] = True
        out.append((c, r, n))
    return out


def assign_bounds(layout: DataFrame, columns: DataFrame, bands: DataFrame) -> DataFrame:
    """(page_id, block_pos, x, y, width, height) of layout (page_id, block_pos, row_span); null bounds for blocks without a place.

    A page has tens of blocks, so each page is one small group.
    """
    c = columns.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("column_index", "x", "width"))).alias("cs"))
    b = bands.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("row", "y", "height"))).alias("bs"))
    blocks = layout.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("block_pos", F.coalesce("row_span", F.lit(1)).alias("row_span")))).alias("blocks"))
    pages = blocks.join(c, "page_id").join(b, "page_id")
    # Plain arrays of numbers: structs would be dictionaries in Python.
    flat = pages.select("page_id", "blocks.block_pos", "blocks.row_span", "cs.x", "cs.width", "bs.y", "bs.height")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placed = lru_cache(100_000)(place_blocks)
        for batch in batches:
            at, bounds = [], []
            for i, (spans, x, width, y, height) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("row_span", "x", "width", "y", "height")), strict=True)):
                for place in placed(tuple(spans), len(x), len(y)):
                    at.append(i)
                    bounds.append((None,) * 4 if place is None else (x[place[0]], y[place[1]], width[place[0]], sum(height[place[1] : place[1] + place[2]])))
            columns = [pa.array(v, pa.int32()) for v in zip(*bounds, strict=True)] if bounds else [pa.array([], pa.int32())] * 4
            yield pa.RecordBatch.from_arrays([batch.column("page_id").take(pa.array(at, pa.int64())), batch.column("block_pos").flatten().cast(pa.int32()), *columns], names)

    names = ["page_id", "block_pos", "x", "y", "width", "height"]
    kind = layout.schema["page_id"].dataType.simpleString()
    return flat.mapInArrow(run, f"page_id {kind}, block_pos int, x int, y int, width int, height int")
