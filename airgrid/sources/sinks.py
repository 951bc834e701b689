"""Writers. Each deals its rows by the partition columns first, so that a partition is one file, and replaces only the partitions it writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.functions.names import slugify
from airgrid.functions.times import format_fr_date


def _write(df: DataFrame, base: str, by: list[str], order: list[str], **options) -> None:
    rows = df.repartition(*by).sortWithinPartitions(*by, *order)
    rows.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").options(header=True, emptyValue="", **options).csv(base)


def write_programmes(df: DataFrame, base: str) -> None:
    """Ten columns, set apart by bars, under source, year, day and channel; nothing for no rows. Fields with a bar are quoted."""
    out = df.select(
        F.upper("source_code").alias("source_code"),
        F.year("air_date").alias("year"),
        "air_date",
        "channel_url",
        F.col("channel").alias("Chaine"),
        format_fr_date(F.col("air_date")).alias("Date"),
        F.col("start_time").alias("Heure début"),
        F.col("end_time").alias("Heure fin"),
        F.col("title").alias("Titre"),
        F.col("subtitle").alias("Sous-titre"),
        F.col("episode").alias("Episode"),
        F.col("genre").alias("Genre"),
        F.col("identifier").alias("Identifiant"),
        F.col("synopsis").alias("Synopsis"),
    )
    _write(out, base, ["source_code", "year", "air_date", "channel_url"], ["Heure début"], sep="|", escape='"')


def write_listings(df: DataFrame, base: str) -> None:
    out = df.select(
        F.year("page_date").alias("year"),
        "page_date",
        F.coalesce("slug", slugify(F.col("channel"))).alias("slug"),
        "entry_pos",
        F.col("channel").alias("Chaine"),
        F.col("start_time").alias("Heure"),
        F.col("title").alias("Titre Programme"),
        F.col("subtitle").alias("Sous-titre"),
        F.col("genre").alias("Genre"),
    )
    _write(out, base, ["year", "page_date", "slug"], ["entry_pos"], sep=";", escape='"')


def write_unparsed_segments(df: DataFrame, base: str) -> None:
    out = df.where("unparsed_tail <> ''").select(F.year("page_date").alias("year"), "page_date", "channel", "entry_pos", "start_time", "unparsed_tail")
    _write(out, base, ["year", "page_date"], ["channel", "entry_pos"], sep=";", escape='"')


def write_channel_months(df: DataFrame, base: str) -> None:
    out = df.select(F.col("year").alias("annee"), F.col("month").alias("mois"), F.col("category").alias("categorie"), F.col("number").alias("canal"), F.col("channel").alias("chaine"), "logo")
    _write(out, base, ["annee", "mois"], ["categorie", "canal", "chaine"], sep=",", escape='"')


def append_year_counts(df: DataFrame, base: str) -> None:
    """A year that is written again replaces itself; a year without rows writes nothing."""
    _write(df.select("year", F.col("channel").alias("chaine"), F.col("n").alias("nombre")), base, ["year"], ["chaine"], sep=";", escape='"')


def write_day_index(df: DataFrame, base: str) -> None:
    _write(df.withColumn("year", F.year("issue_date")), base, ["year"], ["issue_date"], sep=";", escape='"')
