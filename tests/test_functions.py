import datetime

import pytest
from pyspark.sql import functions as F

from airgrid.functions import names, text, times, titles
from airgrid.operators import entries


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def parsed(spark, block, anchors=None):
    df = spark.createDataFrame([("d", 1, 0, "X", block, anchors)], "page_date string, page_number int, block_pos int, channel string, text string, garbled_anchors array<string>")
    rows = entries.programmes_of_blocks(df).orderBy("entry_pos").collect()
    return [(r["start_time"], r["title"], r["subtitle"], r["genre"]) for r in rows]


@pytest.mark.parametrize(
    "block, want",
    [
        ("te. 6.35 Music Place. 7.15 Riviera.", [("06:35", "Music Place", "", ""), ("07:15", "Riviera", "", "")]),
        ("place. 10.35 Les Aventures fantas-\ntiques de Tarzan. 11.25 Sydney Fox,", [("10:35", "Les Aventures fantastiques de Tarzan", "", ""), ("11:25", "Sydney Fox", "", "")]),
        ("22.30 Détours du monde Magazine, Spécial Pèlerinage à Rome", [("22:30", "Détours du monde", "Spécial Pèlerinage à Rome", "Magazine")]),
        ("20.00 Voyage en Antarctique (3/6). La station Wilkes", [("20:00", "Voyage en Antarctique", "La station Wilkes (3/6)", "")]),
        ("20.00 Voyage en Antarctique (3/6)", [("20:00", "Voyage en Antarctique", "Episode 3/6", "")]),
        ("22.25 L'Affaire Thomas Crown # ## Film policier de X, US 1999.", [("22:25", "L'Affaire Thomas Crown", "", "Film")]),
        ("19.55 Journal d'un globe-trotter. Le Vietnam.", [("19:55", "Journal d'un globe-trotter", "Le Vietnam.", "")]),
        ("14.00 Derrick. Série, Allemagne.", [("14:00", "Derrick.", "Allemagne.", "Série")]),
        ("12,35 Cap-Vert ; Descente", [("12:35", "Cap-Vert : Descente", "", "")]),
        ("1.20.10.40 x 25.10 y", [("01:20", "", "", ""), ("10:40", "x 25", "10 y", "")]),
        ("no time at all", []),
        ("", []),
    ],
)
def test_blocks(spark, block, want):
    assert parsed(spark, block) == want


def test_cleaning(spark):
    assert value(spark, text.normalize_ocr_text(F.lit("Elisa-\n| beth"))) == "Elisabeth"
    assert value(spark, text.clean_ocr_text(F.lit("a 5455352 b  c\n500008524 \n12345 1234567890"))) == "a b c\n\n12345 1234567890"


def test_tail(spark):
    cut = value(spark, text.cut_garbled_tail(F.lit("Voyage. Les Vestiges 10% {1 document"), F.array(F.lit("10%"))))
    assert tuple(cut) == ("Voyage. Les Vestiges", "10% {1 document")
    assert value(spark, text.cut_garbled_tail(F.lit("voir arte ce soir"), F.array(F.lit("art"))))["tail"] == ""
    assert value(spark, text.cut_garbled_tail(F.lit(r"x (a+ \E y"), F.array(F.lit(r"\E"), F.lit("(a+"))))["clean"] == "x"
    assert value(spark, text.cut_garbled_tail(F.lit("abc"), F.array().cast("array<string>")))["clean"] == "abc"


@pytest.mark.parametrize(
    "given, want", [("SAMEDJ 6 JANVIER", "samedi"), ("samedi dimanche", None), ("programmes", None), ("xxmercredixx", "mercredi"), ("", None)]
)
def test_weekday(spark, given, want):
    assert value(spark, text.match_weekday(F.lit(given))) == want


@pytest.mark.parametrize("given, want", [("Paris Première", "paris-premiere"), ("Canal+ Bleu", "canal-bleu"), ("13ème Rue", "13eme-rue"), ("Comédie !", "comedie"), ("Cœur", "c-ur"), (None, "")])
def test_slug(spark, given, want):
    assert value(spark, names.slugify(F.lit(given).cast("string"))) == want
    assert value(spark, names.slugify(names.slugify(F.lit(given).cast("string")))) == want


def test_names(spark):
    assert value(spark, names.safe_filename(F.lit("Comédie ! : A/B"))) == "Comédie_!___A_B"
    assert tuple(value(spark, names.parse_month_filename(F.lit("Août_2019.htm")))) == (2019, "08")
    assert tuple(value(spark, names.parse_month_filename(F.lit("16_Juillet_2024.htm")))) == (2024, "07")
    assert value(spark, names.parse_month_filename(F.lit("index.htm"))) is None
    assert tuple(value(spark, names.pick_header_columns(F.array(F.lit("Logo canal"), F.lit("N° de canal"), F.lit("Nom"))))) == (1, 2, 0)


@pytest.mark.parametrize("given, want", [("10:28:20", "10:28:20"), ("10:28", "10:28:00"), ("9:5:7", "09:05:07"), ("99:99", "99:99:00"), ("10abc:30", "10:30:00"), ("abc", None), ("", None), ("00:36:01:00", "00:36:01")])
def test_time(spark, given, want):
    assert value(spark, times.normalize_time(F.lit(given))) == want


def test_times(spark):
    assert value(spark, times.add_duration(F.lit("23:40:00"), F.lit("00:36:01"))) == "00:16:01"
    assert value(spark, times.add_duration(F.lit("23:40:00"), F.lit(None).cast("string"))) == ""
    for given, n in (("2003", 365), ("2010-05-29->2010-12-31", 217), ("2010-05-29", 1)):
        assert len(value(spark, times.expand_date_range(F.lit(given)))) == n
    assert value(spark, times.expand_date_range(F.lit("1949"))) is None
    d = datetime.date
    for given, want in (("31/03/2005", (d(2005, 3, 31), d(2005, 3, 31), "day")), ("03/2005", (d(2005, 3, 1), d(2005, 3, 31), "month")), ("2005", (d(2005, 1, 1), d(2005, 12, 31), "year"))):
        assert tuple(value(spark, times.parse_partial_date(F.lit(given)))) == want
    assert value(spark, times.parse_partial_date(F.lit(""))) is None


def test_titles(spark):
    t = lambda *a: tuple(value(spark, titles.resolve_title(*map(F.lit, a))))
    assert [t("a", "", ""), t("a", "", "p"), t("a", "c", "p"), t("", "c", "")] == [("a", None), ("p", "a"), ("c", "a"), ("c", None)]
    assert tuple(value(spark, titles.strip_title_brackets(F.lit("[Journal]"), F.lit("Météo : [du soir]")))) == ("Journal", "Météo")
    assert value(spark, titles.strip_title_brackets(F.lit("Thalassa"), F.lit("THALASSA")))["subtitle"] is None
    assert value(spark, titles.extract_identifier(F.lit("https://example.org/doc/TV-RADIO/TV_779674.001/x?rang=1"))) == "TV_779674.001"
    assert tuple(value(spark, titles.parse_facet_label(F.lit("France 2 (62457)")))) == ("France 2", 62457)
    assert value(spark, titles.parse_facet_label(F.lit("France 2"))) is None
    groups = value(spark, titles.parse_group_history(F.lit("Bolloré Média (2005-2012), Groupe Canal+ (2012-)")))
    assert [tuple(g) for g in groups] == [("Bolloré Média", 2005, 2012), ("Groupe Canal+", 2012, None)]
    assert value(spark, titles.split_distribution(F.lit("TNT, Câble ,ADSL"))) == ["TNT", "Câble", "ADSL"]
