"""Names of channels and files."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from airgrid.functions.text import WS, trim_blanks

_LATIN = [chr(i) for i in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
#: Letters that decompose into an ASCII letter and marks of U+0300 to U+036F, by rule.
_FOLDS = {c: d[0] for c in _LATIN if len(d := unicodedata.normalize("NFD", c)) > 1 and d[0].isascii() and all(0x300 <= ord(m) <= 0x36F for m in d[1:])}

#: Months as file names spell them, accents folded.
MONTHS = ["janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre"]


def fold_accents(c: Column) -> Column:
    """Lower case without accents, trimmed; null becomes the empty string. Letters such as ø and ß have no accent."""
    plain = F.translate(F.coalesce(c, F.lit("")), "".join(_FOLDS), "".join(_FOLDS.values()))
    return trim_blanks(F.lower(F.regexp_replace(plain, r"[\x{300}-\x{36f}]", "")))


def slugify(c: Column) -> Column:
    return F.btrim(F.regexp_replace(fold_accents(c), "[^a-z0-9]+", "-"), F.lit("-"))


def safe_filename(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"{WS}+", "_"), r"[\\/:*?\"<>|]+", "_")


def parse_month_filename(name: Column) -> Column:
    """struct<year int, month string> of a name such as Août_2019.htm; null if it has none."""
    base = F.regexp_replace(name, r"(?i)\.html?\z", "")
    pattern = "([A-Za-zÀ-ÿ]+)_([0-9]{4})"
    month = fold_accents(F.regexp_extract(base, pattern, 1))
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month)
    return F.when(number > 0, F.struct(F.regexp_extract(base, pattern, 2).cast("int").alias("year"), F.lpad(number.cast("string"), 2, "0").alias("month")))


def pick_header_columns(cells: Column, places: Column | None = None) -> Column:
    """struct<number int, channel int, logo int>: 0-based places of the columns of a line-up table, by their headings.

    places are the columns that the headings start in, if they are not one for each.
    """
    folded = F.transform(cells, fold_accents)

    def place(test, default):
        at = F.nullif(F.array_position(F.transform(folded, test), F.lit(True)), F.lit(0)) - 1
        return F.coalesce(at if places is None else F.get(places, at.cast("int")), F.lit(default)).cast("int")

    return F.struct(
        place(lambda x: x.contains("canal") & ~x.contains("logo"), 0).alias("number"),
        place(lambda x: x.contains("chaine") | x.contains("nom"), 3).alias("channel"),
        place(lambda x: x.contains("logo"), 2).alias("logo"),
    )
