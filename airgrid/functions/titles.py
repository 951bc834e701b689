"""Titles, identifiers and labels of the catalogue, and lists of the channel register."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airgrid.functions.text import WS, trim_blanks


def extract_identifier(href: Column) -> Column:
    return F.nullif(F.regexp_extract(href, "/doc/TV-RADIO/([^/]+)/", 1), F.lit(""))


def resolve_title(own: Column, collection: Column, programme: Column) -> Column:
    """struct<title, subtitle>: the collection is the title, else the programme, else the own title; null subtitle if it is empty."""
    own, collection, programme = (trim_blanks(F.coalesce(c, F.lit(""))) for c in (own, collection, programme))
    below = F.nullif(own, F.lit(""))
    pair = lambda t, s: F.struct(t.alias("title"), s.alias("subtitle"))
    return F.when(collection != "", pair(collection, below)).when(programme != "", pair(programme, below)).otherwise(pair(own, F.lit(None).cast("string")))


def strip_title_brackets(title: Column, subtitle: Column) -> Column:
    """struct<title, subtitle> without the brackets of titles that were made up; null subtitle if it says the same."""
    inside = lambda c: F.regexp_replace(c, r"^\[(.+)\]\z", "$1")
    t = inside(title)
    s = F.regexp_replace(inside(subtitle), r" : \[(.+)\]\z", "")
    return F.struct(t.alias("title"), F.when(F.lower(s) == F.lower(t), F.lit(None).cast("string")).otherwise(s).alias("subtitle"))


def parse_facet_label(c: Column) -> Column:
    """struct<channel, n> of `France 2 (62457)`; null if it has no count."""
    pattern = f"^(.+?){WS}+\\(([0-9]+)\\)\\z"
    return F.when(c.rlike(pattern), F.struct(F.regexp_extract(c, pattern, 1).alias("channel"), F.regexp_extract(c, pattern, 2).cast("long").alias("n")))


def extract_logo_url(link: Column, image: Column) -> Column:
    return F.coalesce(link, image, F.lit(""))


def parse_group_history(c: Column) -> Column:
    """array<struct<name, start_year, end_year>> of `A (1995-1997), B (1997-)`."""
    items = F.regexp_extract_all(c, F.lit(r"([^,()][^()]*\(\d{4}-(?:\d{4})?\))"), F.lit(1))
    pattern = r"^\s*(.+?)\s*\((\d{4})-(\d{4})?\)\z"
    return F.transform(
        items,
        lambda x: F.struct(
            F.regexp_extract(x, pattern, 1).alias("name"), F.regexp_extract(x, pattern, 2).cast("int").alias("start_year"), F.try_to_number(F.nullif(F.regexp_extract(x, pattern, 3), F.lit("")), F.lit("9999")).cast("int").alias("end_year")
        ),
    )


def split_distribution(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ","), trim_blanks), lambda x: x != "")
