"""Catalogue rows to programmes, counts, and the jobs that they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.functions.text import trim_blanks
from airgrid.functions.times import add_duration, expand_date_range, normalize_time
from airgrid.functions.titles import extract_identifier, resolve_title, strip_title_brackets
from airgrid.operators.stages import staged

#: Rows of a request at most: a day that has as many may be cut off.
ROW_CAP = 500


def keep_programme_rows(rows: DataFrame) -> DataFrame:
    """catalogue rows (cells array<string>, href) that are programmes, with their fields."""
    cell = lambda i: trim_blanks(F.coalesce(F.get(F.col("cells"), i), F.lit("")))
    n = F.size("cells")
    df = rows.where(n >= 6).where(~((cell(5) == "Statut de diffusion") | cell(6).contains("Première diffusion")))
    df = staged(df, t=resolve_title(cell(5), cell(6), F.when(n >= 8, cell(7)).otherwise(F.lit(""))))
    df = df.where(F.col("t.title") != "").where(~F.lower("t.title").contains("interprogrammes"))
    df = staged(df, start_time=normalize_time(cell(3)), duration=normalize_time(cell(4))).where(F.col("start_time").isNotNull())
    df = staged(df, end_time=add_duration(F.col("start_time"), F.col("duration")), b=strip_title_brackets(F.col("t.title"), F.col("t.subtitle")))
    blank = F.lit("")
    return df.select(
        *[c for c in rows.columns if c not in ("cells", "href")],
        "start_time",
        "end_time",
        F.col("b.title").alias("title"),
        F.coalesce("b.subtitle", blank).alias("subtitle"),
        blank.alias("episode"),
        F.when(n >= 9, cell(8)).otherwise(blank).alias("genre"),
        F.coalesce(extract_identifier(F.col("href")), blank).alias("identifier"),
        blank.alias("synopsis"),
    )


def upsert_programme_day(old: DataFrame, new: DataFrame, key: tuple[str, ...] = ("source_code", "channel_id", "day")) -> DataFrame:
    """old (key, n_programmes, loaded) with the counts of the programmes in new, which replace and count as not loaded."""
    fresh = new.groupBy(*key).agg(F.count(F.lit(1)).alias("n_programmes")).withColumn("loaded", F.lit(0)).withColumn("batch", F.lit(1))
    both = fresh.unionByName(old.select(*key, "n_programmes", F.col("loaded").cast("int").alias("loaded"), F.lit(0).alias("batch")))
    best = both.groupBy(*key).agg(F.max_by(F.struct("n_programmes", "loaded"), "batch").alias("r"))
    return best.select(*key, "r.*")


def capped_days(days: DataFrame, cap: int = ROW_CAP) -> DataFrame:
    return days.where(F.col("n_programmes") >= cap)


def channel_year_counts(programmes: DataFrame, channel: str = "channel", date: str = "air_date") -> DataFrame:
    """(year, channel, n). Partial counts are made before the shuffle, so a channel with most rows is no hot task."""
    return programmes.groupBy(F.year(date).alias("year"), F.col(channel).alias("channel")).agg(F.count(F.lit(1)).alias("n"))


def expand_days(jobs: DataFrame, param: str = "param") -> DataFrame:
    """A row for each day of param; rows with an odd one are left out."""
    return jobs.withColumn("day", F.explode(expand_date_range(F.col(param))))


def expand_jobs(channels: DataFrame) -> DataFrame:
    """channels (source_code, channel_url, first_year, last_year): a row for each source, channel and day."""
    years = F.sequence(F.col("first_year"), F.col("last_year")).cast("array<string>")
    return expand_days(channels.select("source_code", "channel_url", F.explode(years).alias("param"))).drop("param")


def resolve_channel_source(jobs: DataFrame, channel: DataFrame, channel_source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(jobs with id_chaine and nom_chaine_source, jobs without a match); of several matches the smallest id, then name."""
    known = channel.join(channel_source, "id_chaine").groupBy(F.col("url_chaine").alias("channel_url"), F.col("code_source").alias("source_code"))
    known = known.agg(F.min(F.struct("id_chaine", "nom_chaine_source")).alias("m")).select("channel_url", "source_code", "m.*")
    keys = ["channel_url", "source_code"]
    return jobs.join(known, keys), jobs.join(known, keys, "left_anti")
