"""Readers of landed files."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PERIODS = (
    "periods array<struct<name: string, startDate: date, endDate: date, rowSeparator: string, pages: map<string, struct<layout: string, "
    "blocks: array<struct<name: string, type: string, rowSpan: int, versions: array<struct<name: string, `from`: date, `to`: date>>>>>>>>"
)
WORDS = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left double, top double, width double, height double, conf double, text string"
MIN_ARCHIVE_BYTES = 5 * 1024 * 1024


def read_html_pages(spark: SparkSession, directory: str) -> DataFrame:
    """(path, html) of the .htm and .html files; path is the file's name."""
    df = spark.read.text(directory, wholetext=True).select(F.col("_metadata.file_name").alias("path"), F.col("value").alias("html"))
    return df.where(F.col("path").rlike(r"(?i)\.html?$"))


def read_layout_periods(spark: SparkSession, path: str) -> DataFrame:
    """A row for each block of each page of each period, in reading order."""
    return flatten_periods(spark.read.schema(PERIODS).json(path, multiLine=True))


def flatten_periods(documents: DataFrame) -> DataFrame:
    p = documents.select(F.posexplode("periods").alias("list_pos", "p"))
    pages = p.select("list_pos", "p.*").select("list_pos", F.col("name").alias("period_name"), F.col("startDate").alias("start_date"), F.col("endDate").alias("end_date"), F.col("rowSeparator").alias("row_separator"), F.explode("pages").alias("page", "v"))
    blocks = pages.select("*", F.posexplode("v.blocks").alias("block_pos", "b"))
    return blocks.select(
        "list_pos",
        "period_name",
        "start_date",
        "end_date",
        "row_separator",
        F.col("page").cast("int").alias("page_number"),
        F.col("v.layout").alias("layout"),
        "block_pos",
        F.col("b.name").alias("name"),
        F.coalesce("b.type", F.lit("channel")).alias("type"),
        F.coalesce("b.rowSpan", F.lit(1)).alias("row_span"),
        F.col("b.versions").alias("versions"),
    )


def check_range(first: str | None, last: str | None, year: int) -> tuple[datetime.date, datetime.date]:
    """The bounds of a date range, the whole year by default; an odd or reversed bound is an error."""
    lo, hi = (datetime.date.fromisoformat(x) for x in (first or f"{year}-01-01", last or f"{year}-12-31"))
    if lo > hi:
        raise ValueError(f"{lo} is after {hi}")
    return lo, hi


def filter_date_range(df: DataFrame, column: str, first: str | None, last: str | None, year: int) -> DataFrame:
    lo, hi = check_range(first, last, year)
    return df.where(F.col(column).between(F.lit(lo), F.lit(hi)))


def not_empty(df: DataFrame, message: str) -> DataFrame:
    """df, or an error if it has no row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def scan_name(name: Column) -> Column:
    """struct<date, page_number> of YYYY-MM-DD-PageN.jpg; null for other names."""
    pattern = r"(?i)^(\d{4}-\d{2}-\d{2})-Page(\d+)\.jpe?g$"
    date = F.try_to_date(F.regexp_extract(name, pattern, 1), "yyyy-MM-dd")
    return F.when(date.isNotNull(), F.struct(date.alias("date"), F.regexp_extract(name, pattern, 2).cast("int").alias("page_number")))


def _names(spark: SparkSession, directory: str) -> DataFrame:
    """Only names and lengths: the content column is never read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    return df.select("path", "length", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"))


def scan_manifest(spark: SparkSession, directory: str, first: str | None = None, last: str | None = None, year: int = 2001) -> DataFrame:
    """(date, page_number, path) of the scanned pages of a range of dates, in the order of their names; an error if there is none."""
    df = _names(spark, directory).withColumn("s", scan_name(F.col("name"))).where("s is not null").select("s.*", "path", "name")
    return not_empty(filter_date_range(df, "date", first, last, year), f"no page in {directory} between these dates").orderBy("name").drop("name")


def issue_manifest(spark: SparkSession, directory: str) -> DataFrame:
    date = F.try_to_date(F.regexp_extract("name", r"(?i)^(\d{4}-\d{2}-\d{2})\.pdf$", 1), "yyyy-MM-dd")
    return _names(spark, directory).select(date.alias("issue_date"), "path").where("issue_date is not null").orderBy("issue_date")


def read_ocr_words(spark: SparkSession, path: str) -> DataFrame:
    """Words of recognised pages (level 5, not empty) in reading order."""
    df = spark.read.csv(path, sep="\t", quote="", header=True, schema=WORDS).where("level = 5 and trim(text) <> ''")
    seq = ((F.col("block_num").cast("long") * 1000 + F.col("par_num")) * 1000 + F.col("line_num")) * 1000 + F.col("word_num")
    return df.select(F.col("_metadata.file_name").alias("file_name"), F.col("page_num").alias("page_number"), seq.cast("long").alias("seq"), "text", F.col("conf").alias("confidence"), "left", "top", "width", "height")


def read_channel_tables(spark: SparkSession, url: str, properties: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """chaine and chaine_source of a relational store."""
    return spark.read.jdbc(url, "chaine", properties=properties), spark.read.jdbc(url, "chaine_source", properties=properties)


def archive_size_gate(files: DataFrame, min_bytes: int = MIN_ARCHIVE_BYTES) -> DataFrame:
    """files (path, length) with suspect: smaller than an archive should be."""
    return files.withColumn("suspect", F.col("length") < min_bytes)
