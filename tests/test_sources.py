import datetime
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from airgrid.operators import layout, profile
from airgrid.sources import files, images, sinks


def png(path, rows):
    """rows of (red, green, blue) pixels."""
    raw = b"".join(b"\0" + b"".join(bytes(p) for p in r) for r in rows)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", len(rows[0]), len(rows), 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_files(spark, tmp_path):
    for name in ("2001-01-02-Page10.jpg", "2001-01-02-Page2.JPEG", "2002-01-01-Page1.jpg", "2001-03-04.pdf", "notes.txt", "Mai_2001.HTM", "b.html"):
        (tmp_path / name).write_text("x\ny")
    scans = files.scan_manifest(spark, str(tmp_path), year=2001).collect()
    assert [(r["date"], r["page_number"]) for r in scans] == [(datetime.date(2001, 1, 2), 10), (datetime.date(2001, 1, 2), 2)]
    assert [r["issue_date"] for r in files.issue_manifest(spark, str(tmp_path)).collect()] == [datetime.date(2001, 3, 4)]
    assert sorted(map(tuple, files.read_html_pages(spark, str(tmp_path)).collect())) == [("Mai_2001.HTM", "x\ny"), ("b.html", "x\ny")]


def test_ocr_words(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    (tmp_path / "w.tsv").write_text(head + '4\t1\t1\t1\t1\t0\t0\t0\t9\t9\t-1\t\n5\t1\t1\t1\t1\t1\t1\t2\t3\t4\t91.5\t"Il\n5\t1\t1\t1\t1\t2\t1\t2\t3\t4\t9\t \n')
    assert [(r["text"], r["confidence"], r["left"]) for r in files.read_ocr_words(spark, str(tmp_path)).collect()] == [('"Il', 91.5, 1.0)]


def test_periods(spark, tmp_path):
    block = {"versions": [{"name": "A", "from": "2001-04-01", "to": "2001-12-09"}, {"name": "B", "from": "2001-12-10", "to": "2001-12-31"}]}
    doc = {"periods": [{"name": "p", "startDate": "2001-03-31", "endDate": "2001-12-31", "pages": {"2": {"layout": "l", "blocks": [{"name": "X", "rowSpan": 2}, {"name": "Y", "type": "ignored"}, block]}}}]}
    (tmp_path / "p.json").write_text(json.dumps(doc, indent=1))
    blocks = files.read_layout_periods(spark, str(tmp_path / "p.json"))
    assert [(r["block_pos"], r["type"], r["row_span"]) for r in blocks.orderBy("block_pos").collect()] == [(0, "channel", 2), (1, "ignored", 1), (2, "channel", 1)]
    assert layout.grid_cell_count(blocks).first()["cells"] == 4
    for day, name in (("2001-12-09", "A"), ("2001-12-10", "B")):
        got = layout.resolve_block_versions(blocks.withColumn("page_date", F.lit(day).cast("date")))
        assert got.where("block_pos = 2").first()["name"] == name
    assert [r["name"] for r in layout.channel_inventory(blocks).collect()] == ["A", "B", "X", "Y"]


def test_sinks(spark, tmp_path):
    day = datetime.date(2001, 1, 2)
    p = spark.createDataFrame([("src", "une", "Une", day, "10:00:00", "", "a|b", 'say "x"', "", "", "", "")], "source_code string, channel_url string, channel string, air_date date, start_time string, end_time string, title string, subtitle string, episode string, genre string, identifier string, synopsis string")
    base = str(tmp_path / "p")
    for _ in range(2):
        sinks.write_programmes(p, base)
    back = spark.read.csv(base, sep="|", header=True, escape='"').collect()
    assert len(back) == 1 and (back[0]["Titre"], back[0]["Sous-titre"], back[0]["Date"], back[0]["source_code"]) == ("a|b", 'say "x"', "02/01/2001", "SRC")
    rows = spark.createDataFrame([(day, None, "Canal+ Bleu", 0, "06:35", "T;1", "", "Film", "10% x"), (day, None, "Canal+ Bleu", 1, "07:35", "U", "s", "", "")], "page_date date, slug string, channel string, entry_pos int, start_time string, title string, subtitle string, genre string, unparsed_tail string")
    sinks.write_listings(rows, str(tmp_path / "l"))
    back = spark.read.csv(str(tmp_path / "l"), sep=";", header=True, escape='"').orderBy("Heure").collect()
    assert [(r["slug"], r["Titre Programme"]) for r in back] == [("canal-bleu", "T;1"), ("canal-bleu", "U")]
    sinks.write_unparsed_segments(rows, str(tmp_path / "u"))
    assert spark.read.csv(str(tmp_path / "u"), sep=";", header=True).count() == 1
    counts = spark.createDataFrame([(1999, "x", 3), (2000, "x", 4)], "year int, channel string, n long")
    for _ in range(2):
        sinks.append_year_counts(counts, str(tmp_path / "c"))
    sinks.append_year_counts(counts.where("year = 2000").withColumn("n", F.lit(9)), str(tmp_path / "c"))
    assert sorted((r["year"], r["nombre"]) for r in spark.read.csv(str(tmp_path / "c"), sep=";", header=True, inferSchema=True).collect()) == [(1999, 3), (2000, 9)]
    months = spark.createDataFrame([(2019, "08", "c", "1", "Une", "/l")], "year int, month string, category string, number string, channel string, logo string")
    sinks.write_channel_months(months, str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), header=True).first()["chaine"] == "Une"
    index = spark.createDataFrame([(day, 40, None)], "issue_date date, samedi int, dimanche int")
    sinks.write_day_index(index, str(tmp_path / "i"))
    assert spark.read.csv(str(tmp_path / "i"), sep=";", header=True).first()["samedi"] == "40"


def test_no_page_in_range(spark, tmp_path):
    (tmp_path / "2001-01-02-Page10.jpg").write_text("x")
    with pytest.raises(ValueError):
        files.scan_manifest(spark, str(tmp_path), "2001-02-01", "2001-03-01")


def test_channel_tables(spark):
    """S6 names its two tables; the reader itself is Spark's."""
    seen = []
    fake = type("S", (), {"read": type("R", (), {"jdbc": staticmethod(lambda url, name, properties: seen.append((url, name)) or name)})})
    assert files.read_channel_tables(fake, "jdbc:x", {}) == ("chaine", "chaine_source") and [u for u, _ in seen] == ["jdbc:x"] * 2


def test_row_cuts_of_images(spark, tmp_path):
    """Pages of two columns by three rows: printed lines with a dark band below, blank runs, and even cuts."""
    white, black = (255, 255, 255), (0, 0, 0)
    height, width = 900, 140

    def page(dark):
        columns = [*range(10, 60), *range(80, 130)]
        return [[black if x in columns and dark(x, y) else white for x in range(width)] for y in range(height)]

    # Text of every second row; two lines of 4 px at 300 and 600, each with a band of 60 percent ink below.
    def lined(x, y):
        for at in (300, 600):
            if at <= y < at + 4:
                return True
            if at + 4 <= y < at + 120:
                return x % 5 < 3
        return y % 4 == 0 and (x + y // 4) % 3 == 0

    png(tmp_path / "line.png", page(lined))
    png(tmp_path / "blank.png", page(lambda x, y: not (290 <= y < 310 or 590 <= y < 612) and (y // 2 + x) % 3 < 2))
    png(tmp_path / "even.png", page(lambda x, y: (x + y) % 2 == 0))
    read = images.read_images(spark, str(tmp_path / "*.png"))
    name = F.regexp_extract("page_id", r"([a-z]+)\.png$", 1)
    columns = images.columns_of_images(read)
    assert {(r["column_index"], r["x"], r["width"]) for r in columns.collect()} == {(0, 10, 50), (1, 80, 50)}
    separator = F.when(name == "line", "line").when(name == "blank", "whitespace").otherwise("even")
    pages = read.select("page_id", F.lit(3).alias("rows"), separator.alias("separator"))
    got = {r["name"]: r["cuts"] for r in images.row_cuts_of_images(read, pages).select(name.alias("name"), "cuts").collect()}
    assert got == {"line": [302, 602], "blank": [300, 601], "even": [300, 600]}


def test_images(spark, tmp_path):
    white, black, red = (255, 255, 255), (0, 0, 0), (255, 0, 10)
    rows = [[red] * 20 if y < 6 else [black if 8 <= x < 12 else white for x in range(20)] for y in range(100)]
    png(tmp_path / "a.png", rows)
    pages = images.read_images(spark, str(tmp_path / "a.png"))
    assert images.banner_color_ratio(pages).first()["colored_ratio"] == 1.0
    across = images.column_ink_profile(pages)
    runs = profile.threshold_runs(across, F.col("ink") >= 80)
    assert [(r["start"], r["stop"]) for r in runs.collect()] == [(8, 12)]
    columns = pages.select("page_id", F.lit(0).alias("column_index"), F.lit(8).alias("x"), F.lit(4).alias("width"))
    down = {r["pos"]: r["ink"] for r in images.row_ink_profile(pages, columns).collect()}
    assert down[50] == 4 and len(down) == 100
