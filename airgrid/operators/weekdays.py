"""Which page of an issue starts each weekday."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.functions.text import WEEKDAYS, match_weekday

FIRST_PAGE, SKIP, MIN_RATIO = 36, 8, 0.5


def detect_days(banner_text: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """(issue_date, page_number, day) of pages whose banner has colour enough and names one day."""
    return banner_text.where(F.col("colored_ratio") >= min_ratio).withColumn("day", match_weekday(F.col("text"))).where("day is not null").select("issue_date", "page_number", "day")


def match_day_sequence(detections: DataFrame, first_page: int = FIRST_PAGE, skip: int = SKIP) -> DataFrame:
    """(issue_date, day, page_number): days in their order, each on the first page after those that the one before skips.

    An ordered fold over the pages of one issue, which are few.
    """
    week = F.array(*[F.lit(d) for d in WEEKDAYS])
    pages = F.array_sort(F.collect_list(F.struct("page_number", "day")))
    grouped = detections.where(F.col("page_number") >= first_page).groupBy("issue_date").agg(pages.alias("pages"))
    start = F.struct(F.lit(0).alias("i"), F.lit(first_page).alias("next"), F.array().cast("array<struct<day:string,page_number:int>>").alias("found"))

    def step(s, p):
        hit = (p["page_number"] >= s["next"]) & (s["i"] < 7) & (p["day"] == F.get(week, s["i"]))
        more = F.concat(s["found"], F.array(F.struct(p["day"].alias("day"), p["page_number"].cast("int").alias("page_number"))))
        return F.struct(
            F.when(hit, s["i"] + 1).otherwise(s["i"]).alias("i"), F.when(hit, (p["page_number"] + skip).cast("int")).otherwise(s["next"]).alias("next"), F.when(hit, more).otherwise(s["found"]).alias("found")
        )

    folded = grouped.select("issue_date", F.aggregate("pages", start, step).alias("s"))
    return folded.select("issue_date", F.inline("s.found"))


def pivot_day_index(found: DataFrame) -> DataFrame:
    return found.groupBy("issue_date").pivot("day", WEEKDAYS).agg(F.first("page_number"))


def missing_days(issues: DataFrame, found: DataFrame) -> DataFrame:
    """(issue_date, day) of the days of each issue that were not found."""
    every = issues.select("issue_date").distinct().select("issue_date", F.explode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("day"))
    return every.join(found.select("issue_date", "day"), ["issue_date", "day"], "left_anti")
