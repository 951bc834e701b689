"""Monthly line-up pages to channel rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airgrid.functions.names import parse_month_filename, pick_header_columns
from airgrid.functions.titles import extract_logo_url
from airgrid.sources.html import parse_tables


def carry_category(nodes: DataFrame) -> DataFrame:
    """nodes (path, node_pos, heading) with category: the last heading that isn't empty before each node; '' before the first."""
    w = Window.partitionBy("path").orderBy("node_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return nodes.withColumn("category", F.coalesce(F.last(F.nullif(F.col("heading"), F.lit("")), ignorenulls=True).over(w), F.lit("")))


def drop_grid_noise_rows(rows: DataFrame) -> DataFrame:
    return rows.where("channel_cell is not null and not channel_cell.is_header and channel_cell.text <> ''")


def lineup_rows(pages: DataFrame) -> DataFrame:
    """(path, category, number, channel, logo) of the tables of class wikitable with two rows or more.

    A cell is dealt to the rows it spans only where it lies in one of the three columns that the headings name, so wide
    and tall spans make no more rows than their table has. All of it happens in the partitions by path of the category.
    """
    nodes = carry_category(parse_tables(pages)).where("cells is not null and is_wikitable and n_rows >= 2")
    top = F.filter("cells", lambda c: c["row"] == 0)
    head = pick_header_columns(F.transform(top, lambda c: c["text"]), F.transform(top, lambda c: c["col"]))
    cells = nodes.withColumn("h", head).select("path", "node_pos", "category", "h", F.posexplode("cells").alias("order", "x")).where("x.row + x.rows > 1")
    kinds = ("number", "channel", "logo")
    here = F.filter(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"h.{k}").alias("at")) for k in kinds)), lambda r: (r["at"] >= F.col("x.col")) & (r["at"] < F.col("x.col") + F.col("x.cols")))
    cells = cells.withColumn("r", F.explode(here)).withColumn("row", F.explode(F.sequence(F.greatest(F.col("x.row"), F.lit(1)), F.col("x.row") + F.col("x.rows") - 1)))
    last = [F.max_by("x", F.when(F.col("r.kind") == k, F.col("order"))).alias(f"{k}_cell") for k in kinds]
    rows = cells.groupBy("path", "node_pos", "row").agg(F.first("category").alias("category"), *last)
    rows = drop_grid_noise_rows(rows)
    return rows.select(
        "path", "node_pos", "row", "category", F.coalesce("number_cell.text", F.lit("")).alias("number"), F.col("channel_cell.text").alias("channel"), extract_logo_url(F.col("logo_cell.link"), F.col("logo_cell.image")).alias("logo")
    )


def channel_months(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(year, month, category, number, channel, logo) and the rejects of pages whose file name has no month."""
    dated = pages.withColumn("m", parse_month_filename(F.regexp_extract("path", r"([^/]*)\z", 1)))
    rows = lineup_rows(dated.where("m is not null").select("path", "html"))
    months = dated.select("path", "m.*").where("year is not null")
    rejects = dated.where("m is null").select(F.lit("month").alias("stage"), F.col("path").alias("input_key"), F.lit("no month in the file name").alias("reason"))
    return rows.join(months, "path").select("year", "month", "category", "number", "channel", "logo"), rejects
