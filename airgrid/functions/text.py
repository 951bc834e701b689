"""Cleaning of recognised text, and the split of an entry into title, subtitle and genre.

Word boundaries are those of ASCII words and blanks are those of the Unicode list below, whatever the JVM's defaults.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: code points of blanks.
_BLANKS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
#: The same as one string.
BLANKS = "".join(map(chr, _BLANKS))
WS = "[" + "".join(f"\\x{{{c:x}}}" for c in _BLANKS) + "]"
START, STOP = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
TIME = START + r"(?:[01]?\d|2[0-3])[.,][0-5]\d" + STOP
MARK = "\ufdd0\ufdd1"
LEADING_TIME = r"^([01]?\d|2[0-3])[.,]([0-5]\d)"

#: Genre keywords in the order of precedence, and the genre that each stands for.
GENRES = {
    "Film fantastique": "Film",
    "Film policier": "Film",
    "Comédie dramatique": "Film",
    "Comédie": "Film",
    "Drame": "Film",
    "Policier": "Film",
    "Western": "Film",
    "Téléfilm": "Film",
    "Film": "Film",
    "Magazine": "Magazine",
    "Série": "Série",
    "Feuilleton": "",
    "Divertissement": "",
    "Documentaire": "",
}
GENRE = f"(?iu){START}({'|'.join(GENRES)}){STOP}"


def trim_blanks(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def collapse_ws(c: Column) -> Column:
    return trim_blanks(F.regexp_replace(c, f"{WS}+", " "))


def clean_ocr_text(c: Column) -> Column:
    """Recorder codes (6 to 9 digits) and runs of blanks go, line by line."""
    c = F.regexp_replace(c, f"{START}[0-9]{{6,9}}{STOP}", "")
    c = F.regexp_replace(c, r"[ \t]{2,}", " ")
    return trim_blanks(F.regexp_replace(c, r"[ \t]+(?=\n|\z)", ""))


def normalize_ocr_text(c: Column) -> Column:
    """One line of text: stray bars, semicolons, hyphenated line ends and line ends are taken out."""
    letter = "[a-zA-ZàâäéèêëïîôöùûüçÀÂÄÉÈÊËÏÎÔÖÙÛÜÇ]"
    c = F.translate(c, "|;", " :")
    c = F.regexp_replace(c, f"(?<={letter})-{WS}*\\n{WS}*(?={letter})", "")
    return trim_blanks(F.regexp_replace(F.regexp_replace(c, r"\n+", " "), r"[ \t]{2,}", " "))


def split_entries(flat: Column) -> Column:
    """array<string>: from each time to just before the next; what stands before the first is dropped.

    One pass marks the times, so no place is tried twice; the mark is two noncharacters, which no text holds.
    """
    parts = F.split(F.regexp_replace(flat, f"(?=[0-9])({TIME})", f"{MARK}$1"), MARK)
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), trim_blanks)


def find_genre(c: Column) -> Column:
    """struct<keyword, genre> of the first keyword; null where there is none."""
    keyword = F.regexp_extract(c, GENRE, 1)
    named = F.create_map(*(F.lit(x) for k, g in GENRES.items() for x in (k.lower(), g)))
    # The one-element array holds the match, so that its pattern is tried once.
    found = F.transform(F.array(keyword), lambda k: F.when(k != "", F.struct(k.alias("keyword"), F.try_element_at(named, F.lower(k)).alias("genre"))))
    return F.get(found, 0)


def clean_fragment(c: Column) -> Column:
    c = F.regexp_replace(c, "#+", " ")
    c = F.regexp_replace(c, f"{WS}{{2,}}", " ")
    return F.rtrim(F.ltrim(c, F.lit(".,;:" + BLANKS)), F.lit(",;:" + BLANKS))


def move_episode_number(title: Column, subtitle: Column) -> Column:
    """struct<title, subtitle>: `(N/M)` at the end of the title goes to the subtitle."""
    pattern = f"{WS}*\\(([0-9]{{1,2}}){WS}*/{WS}*([0-9]{{1,2}})\\){WS}*\\z"
    number = F.concat(F.regexp_extract(title, pattern, 1), F.lit("/"), F.regexp_extract(title, pattern, 2))
    moved = F.when(subtitle != "", F.concat(F.regexp_replace(subtitle, f"\\.{WS}*\\z", ""), F.lit(" ("), number, F.lit(")"))).otherwise(F.concat(F.lit("Episode "), number))
    found = number != "/"
    return F.struct(F.when(found, clean_fragment(F.regexp_replace(title, pattern, ""))).otherwise(title).alias("title"), F.when(found, moved).otherwise(subtitle).alias("subtitle"))


def cut_garbled_tail(text: Column, anchors: Column) -> Column:
    """struct<clean, tail>: cut at the first place where an anchor stands as a word of its own.

    Blanks all become spaces, so anchors are looked up as they are, with a space before and each stop behind. A pattern,
    which would be another one for each row, is only built for an anchor that holds blanks itself.
    """

    def place(text: Column, flat: Column, a: Column) -> Column:
        ends = [F.call_function("instr", flat, F.concat(F.lit(" "), a, F.lit(stop))) for stop in " .,;:!?"]
        literal = F.replace(a, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
        pattern = F.concat(F.lit(f"(?<!{WS.replace('[', '[^', 1)})\\Q"), literal, F.lit(f"\\E(?={WS}|\\z|[.,;:!?])"))
        return F.when(F.translate(a, BLANKS, "") == a, F.array_min(F.filter(F.array(*ends), lambda i: i > 0))).otherwise(F.regexp_instr(text, pattern))

    def parts(row: Column) -> Column:
        text, at = row["text"], row["at"]
        whole = F.struct(text.alias("clean"), F.lit("").alias("tail"))
        two = F.struct(trim_blanks(F.substring(text, F.lit(1), at - 1)).alias("clean"), trim_blanks(F.substring(text, at, F.length(text))).alias("tail"))
        return F.when(at.isNull(), whole).otherwise(two)

    # One-element arrays hold what is used more than once.
    def cut(row: Column) -> Column:
        text, flat = row["text"], row["flat"]
        places = F.transform(F.filter(row["anchors"], lambda a: a != ""), lambda a: place(text, flat, a))
        at = F.when(F.size(row["anchors"]) > 0, F.array_min(F.filter(places, lambda i: i > 0)))
        return F.get(F.transform(F.array(F.struct(text.alias("text"), at.alias("at"))), parts), 0)

    flat = F.when(F.size(anchors) > 0, F.concat(F.lit(" "), F.translate(text, BLANKS, " " * len(BLANKS)), F.lit(" ")))
    return F.get(F.transform(F.array(F.struct(text.alias("text"), anchors.alias("anchors"), flat.alias("flat"))), cut), 0)


def _near(word: Column, day: str) -> Column:
    return F.levenshtein(word, F.lit(day), 1 if len(day) <= 5 else 2).between(0, 1 if len(day) <= 5 else 2)


def _has_day(words: Column, letters: Column, day: str) -> Column:
    """Is the day one of the words, or a part of all the letters, but for a misread letter or two?

    As many misread letters as allowed leave one of the day's parts whole, so only letters that hold one are compared.
    """
    most = 1 if len(day) <= 5 else 2

    def part(size: int) -> Column:
        offsets = F.when(F.length(letters) >= size, F.sequence(F.lit(1), F.length(letters) - size + 1)).otherwise(F.array().cast("array<int>"))
        return F.exists(offsets, lambda i: _near(F.substring(letters, i, F.lit(size)), day))

    in_words = F.exists(words, lambda w: (F.abs(F.length(w) - len(day)) <= most) & _near(w, day))
    held = reduce(Column.__or__, (F.contains(letters, F.lit(p)) for p in DAY_PARTS[day]))
    return held & (in_words | part(len(day) - 1) | part(len(day)) | part(len(day) + 1))


def match_weekday(text: Column) -> Column:
    """The one weekday that a banner names, misread letters allowed; null for none or several."""

    # One-element arrays hold what is used more than once.
    def named(read: Column) -> Column:
        days = F.array_compact(F.array(*[F.when(_has_day(read["words"], read["letters"], day), F.lit(day)) for day in WEEKDAYS]))
        return F.get(F.transform(F.array(days), lambda d: F.when(F.size(d) == 1, F.get(d, 0))), 0)

    def read(runs: Column) -> Column:
        words = F.filter(F.split(runs, " "), lambda w: F.length(w) >= 4)
        return F.struct(words.alias("words"), F.replace(runs, F.lit(" "), F.lit("")).alias("letters"))

    runs = F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")
    return F.get(F.transform(F.transform(F.array(runs), read), named), 0)


#: Fixed value: each day in one part more than it may have misread letters.
DAY_PARTS = {
    "samedi": ("sa", "me", "di"),
    "dimanche": ("dim", "anc", "he"),
    "lundi": ("lu", "ndi"),
    "mardi": ("ma", "rdi"),
    "mercredi": ("mer", "cr", "edi"),
    "jeudi": ("je", "udi"),
    "vendredi": ("ven", "dr", "edi"),
}
#: Fixed value: the week as the index counts it.
WEEKDAYS = ["samedi", "dimanche", "lundi", "mardi", "mercredi", "jeudi", "vendredi"]
