import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from airgrid.operators import catalogue, entries, layout, lineup, profile, register, weekdays
from airgrid.sources import html


def words(spark, line):
    pairs = [w.rsplit(":", 1) for w in line.split()]
    return spark.createDataFrame([("d", 1, 0, i, t, float(c)) for i, (t, c) in enumerate(pairs)], "page_date string, page_number int, block_pos int, seq int, text string, confidence double")


@pytest.mark.parametrize(
    "line, want",
    [
        ("Wilkes:90 10%:20 {1:15 document:80", ["10%"]),
        ("des:0 de:10", []),
        ("abc:10 |:95 def:10", ["abc"]),
        ("xyz:10 good:90", []),
        ("BA:5 zz:5", ["BA"]),
        ("US:5 zz:5", []),
        ("foo:-1 bar:10", []),
        ("foo:40 bar:39.9 baz:10", ["bar"]),
        ("aaa:1 bbb:1 ok:90 ccc:1 ddd:1", ["aaa", "ccc"]),
    ],
)
@pytest.mark.parametrize("parts", [1, 16])
def test_anchors(spark, line, want, parts):
    got = entries.garbled_anchors(words(spark, line).repartition(parts)).collect()
    assert (got[0]["garbled_anchors"] if got else []) == want


def test_last_page_wins(spark):
    df = spark.createDataFrame([("d", "s", "Page10", 1), ("d", "s", "Page2", 2), ("d", "s", "Page2", 3), ("d", "t", "Page1", 4)], "page_date string, slug string, file_name string, k int")
    assert sorted(r["k"] for r in entries.last_page_wins(df).collect()) == [2, 3, 4]


def test_upsert(spark):
    schema = "source_code string, channel_id int, day string"
    old = spark.createDataFrame([("a", 1, "x", 10, 1), ("a", 2, "x", 5, 1)], schema + ", n_programmes long, loaded int")
    new = spark.createDataFrame([("a", 1, "x")] * 12, schema)
    once = catalogue.upsert_programme_day(old, new)
    assert sorted(map(tuple, once.collect())) == [("a", 1, "x", 12, 0), ("a", 2, "x", 5, 1)]
    assert sorted(map(tuple, catalogue.upsert_programme_day(once, new).collect())) == sorted(map(tuple, once.collect()))


def test_periods(spark):
    d = datetime.date
    periods = spark.createDataFrame([("p1", d(1999, 1, 1), d(2001, 3, 30), 0), ("p2", d(2001, 3, 31), d(2001, 12, 31), 1), ("p3", d(2001, 3, 1), d(2001, 12, 31), 2)], "period_name string, start_date date, end_date date, list_pos int")
    dates = spark.createDataFrame([(d(2001, 3, 30),), (d(2001, 3, 31),), (d(2002, 1, 1),), (d(1999, 12, 31),)], "page_date date")
    got = dict(map(tuple, layout.resolve_period(dates, periods).collect()))
    assert got == {d(2001, 3, 30): "p1", d(2001, 3, 31): "p2", d(2002, 1, 1): None, d(1999, 12, 31): "p1"}


def test_bounds(spark):
    blocks = spark.createDataFrame([("a", 0, 2), ("a", 1, 1), ("a", 2, 1), ("a", 3, 1)], "page_id string, block_pos int, row_span int")
    columns = spark.createDataFrame([("a", 0, 0, 10), ("a", 1, 20, 10)], "page_id string, column_index int, x int, width int")
    bands = spark.createDataFrame([("a", 0, 0, 5), ("a", 1, 5, 7)], "page_id string, row int, y int, height int")
    got = [tuple(r)[1:] for r in layout.assign_bounds(blocks, columns, bands).orderBy("block_pos").collect()]
    assert got == [(0, 0, 0, 10, 12), (1, 20, 0, 10, 5), (2, 20, 5, 10, 7), (3, None, None, None, None)]


def test_weekdays(spark):
    rows = [(1, 20, "samedi"), (1, 40, "samedi"), (1, 42, "dimanche"), (1, 48, "dimanche"), (1, 60, "lundi"), (2, 50, "lundi")]
    d = spark.createDataFrame(rows, "issue_date int, page_number int, day string")
    for parts in (1, 16):
        found = weekdays.match_day_sequence(d.repartition(parts))
        assert sorted(map(tuple, found.collect())) == [(1, "dimanche", 48), (1, "lundi", 60), (1, "samedi", 40)]
    assert weekdays.missing_days(d, found).groupBy("issue_date").count().orderBy("issue_date").collect()[0]["count"] == 4
    assert tuple(weekdays.pivot_day_index(found).first())[:4] == (1, 40, 48, 60)
    banner = spark.createDataFrame([(1, 40, 0.7, "SAMEDJ 6 JANVIER"), (1, 41, 0.4, "DIMANCHE"), (1, 42, 0.9, "x")], "issue_date int, page_number int, colored_ratio double, text string")
    assert [tuple(r) for r in weekdays.detect_days(banner).collect()] == [(1, 40, "samedi")]


def lane(spark, inks, page="p"):
    return spark.createDataFrame([(page, "x", 0, i, v) for i, v in enumerate(inks)], "page_id string, axis string, column_index int, pos int, ink int")


def test_runs(spark):
    runs = profile.threshold_runs(lane(spark, [0, 0, 0, 5, 0, 0]), F.col("ink") <= 1, 2)
    assert sorted((r["start"], r["stop"]) for r in runs.collect()) == [(0, 3), (4, 6)]
    assert [(r["start"], r["stop"]) for r in profile.merge_close_runs(runs, 20).collect()] == [(0, 6)]
    gutters = spark.createDataFrame([("p", 0, 5), ("p", 30, 35), ("p", 40, 50), ("p", 100, 110)], "page_id string, start int, stop int")
    assert [tuple(r) for r in profile.columns_from_gutters(gutters, 20).orderBy("x").collect()] == [("p", 0, 5, 25), ("p", 1, 50, 50)]


@pytest.mark.parametrize("widths, want", [([375, 375, 375, 180], [375, 375, 375]), ([100, 375, 375, 180], [375, 375]), ([180, 375], [180, 375]), ([100, 375, 375], [375, 375])])
def test_edges(spark, widths, want):
    df = spark.createDataFrame([("p", i * 400, w) for i, w in enumerate(widths)], "page_id string, x int, width int")
    assert [r["width"] for r in profile.drop_edge_columns(df).orderBy("x").collect()] == want


def test_points_and_cuts(spark):
    points = spark.createDataFrame([("p", x) for x in (300, 150, 100, 190)], "page_id string, pos int")
    assert sorted(r["pos"] for r in profile.merge_nearby_points(points).collect()) == [100, 190, 300]
    cands = spark.createDataFrame([("p", i, x) for i, x in enumerate((100, 128, 140, 160))], "page_id string, column_index int, pos int")
    assert sorted(r["points"] for r in profile.cluster_by_position(cands).collect()) == [1, 3]
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first()["v"]
    assert value(profile.fill_missing_cuts(F.array(F.lit(100)), F.lit(300), F.lit(4))) == [50, 100, 200]
    assert value(profile.fill_missing_cuts(F.array(F.lit(9), F.lit(5), F.lit(7)), F.lit(300), F.lit(3))) == [5, 7]
    assert value(profile.fill_missing_cuts(F.array().cast("array<int>"), F.lit(300), F.lit(1))) == []
    assert value(profile.even_cuts(F.lit(100), F.lit(3))) == [33, 67]
    assert value(profile.even_cuts(F.lit(100), F.lit(1))) == []
    pages = spark.createDataFrame([("p", 600, 3, "line"), ("q", 90, 3, "even")], "page_id string, height int, rows int, separator string")
    assert {r["page_id"]: r["cuts"] for r in profile.cuts_of_pages(pages, points).collect()} == {"p": [100, 150], "q": [30, 60]}


def test_contrast(spark):
    inks = [0] * 200 + [8] * 120 + [0] * 80
    rows = spark.createDataFrame([("p", 0, y, v) for y, v in enumerate(inks)], "page_id string, column_index int, pos int, ink int")
    clusters = spark.createDataFrame([("p", 200.0, 1), ("p", 300.0, 1), ("p", 50.0, 1)], "page_id string, pos double, coverage int")
    columns = spark.createDataFrame([("p", 0, 10)], "page_id string, column_index int, width int")
    got = profile.contrast_filter(clusters, rows, columns).collect()
    assert [(r["pos"], round(r["after"], 3), r["before"]) for r in got] == [(200.0, 0.8, 0.0)]


LINEUP = """<div class="mw-parser-output"><h2><span class="mw-headline">Généralistes</span></h2>
<table class="wikitable"><tbody>
<tr><th>N° de canal</th><th>Groupe</th><th>Logo</th><th>Chaîne</th></tr>
<tr><td>1</td><td rowspan="2">G</td><td><a class="image" href="/f/un.svg"><img src="/t/un.png"></a></td><td>Une</td></tr>
<tr><td>2</td><td><img src="/t/deux.png"></td><td>Deux</td></tr>
<tr><th>N° de canal</th><th>Groupe</th><th>Logo</th><th>Chaîne</th></tr>
</tbody></table></div>"""


def test_lineup(spark):
    pages = spark.createDataFrame([("/x/Août_2019.htm", LINEUP), ("/x/index.htm", LINEUP), ("/x/Mai_2001.html", None)], "path string, html string")
    rows, rejects = lineup.channel_months(pages)
    assert sorted(map(tuple, rows.collect())) == [(2019, "08", "Généralistes", "1", "Une", "/f/un.svg"), (2019, "08", "Généralistes", "2", "Deux", "/t/deux.png")]
    assert [r["input_key"] for r in rejects.collect()] == ["/x/index.htm"]


def test_open_cells(spark):
    source = "<table><tbody><tr><td>a<td>b &amp; c<tr><td colspan=2><a href=x>d</a>"
    got = html.catalogue_rows(spark.createDataFrame([("k", source), ("n", None)], "path string, html string"), ("path",)).collect()
    assert [(r["row_pos"], r["cells"], r["href"]) for r in got] == [(0, ["a", "b & c"], None), (1, ["d"], "x")]


def test_nested_and_deep_tables(spark):
    """Only a table's own rows are its rows; spans end with it; depth is no limit."""
    inner = "<table><tr><td>x<tr><td>y</table>"
    source = f"<table><thead><tr><th>head</thead><tbody><tr><td rowspan=99999999>a<td colspan=2>b{inner}<tr><td>c<td>d</table>"
    table = next(html.walk(html.Tree(source).root, "table"))
    rows, cells = html.cells_of(table)
    assert rows == 2 and [(c["row"], c["col"], c["rows"], c["cols"], c["text"]) for c in cells] == [(0, 0, 2, 1, "a"), (0, 1, 1, 2, "bxy"), (1, 1, 1, 1, "c"), (1, 2, 1, 1, "d")]
    deep = "<div>" * 20_000 + "<a href=x>link</a>"
    got = html.page_links(spark.createDataFrame([(1, deep)], "page_id long, html string")).collect()
    assert [(r["pos"], r["href"]) for r in got] == [(0, "x")] and html.text_of(html.Tree(deep).root) == "link"


def plain_grid(trs):
    """Places of cells (rowspan, colspan) by a dict for each row, as a check of the intervals."""
    rows = [{} for _ in trs]
    for r, tds in enumerate(trs):
        c = 0
        for k, (down, across) in enumerate(tds):
            while c in rows[r]:
                c += 1
            for i in range(min(down, len(trs) - r)):
                for j in range(across):
                    rows[r + i][c + j] = (r, k)
            c += across
    return rows


def test_spans_by_brute_force():
    r = random.Random(3)
    for _ in range(200):
        trs = [[(r.choice([1, 1, 2, 3, 9]), r.choice([1, 1, 2, 4])) for _ in range(r.randrange(5))] for _ in range(r.randrange(1, 8))]
        source = "<table>" + "".join("<tr>" + "".join(f"<td rowspan={a} colspan={b}>x" for a, b in tds) for tds in trs) + "</table>"
        _, cells = html.cells_of(next(html.walk(html.Tree(source).root, "table")))
        got, names = [{} for _ in trs], [(i, k) for i, tds in enumerate(trs) for k in range(len(tds))]
        for name, c in zip(names, cells, strict=True):
            for i in range(c["rows"]):
                for j in range(c["cols"]):
                    got[c["row"] + i][c["col"] + j] = name
        assert got == plain_grid(trs)


def test_wide_and_tall_spans_cost_no_more_than_the_page(spark):
    """A thousand rows of the widest and tallest cells: each cell once, and a row for each line of the line-up."""
    source = "<table class=wikitable><tr><th>Canal<th>Nom" + "<tr><td colspan=1000 rowspan=65534>x" * 1000 + "</table>"
    began = time.perf_counter()
    rows, cells = html.cells_of(next(html.walk(html.Tree(source).root, "table")))
    assert rows == 1001 and len(cells) == 1002 and cells[-1]["col"] == 999_000 and time.perf_counter() - began < 2
    got = lineup.lineup_rows(spark.createDataFrame([("p.htm", f"<body>{source}")], "path string, html string")).collect()
    assert len(got) == 1000 and {(r["number"], r["channel"]) for r in got} == {("x", "x")}


def test_end_tags_are_linear():
    for source in ("<div>" * 40_000 + "</span>" * 40_000, "<div><table>" * 20_000 + "</div>" * 20_000, "<table><tr><td>" * 20_000 + "</tr>" * 20_000):
        began = time.perf_counter()
        html.Tree(source)
        assert time.perf_counter() - began < 2


def test_rows_without_a_body(spark):
    """Rows right in a table, cells without a row, a form between them, and tables in tables: each row once, as a browser has it."""
    source = "<table><form><tr><td> a  \n b <td>c<table><tr><td>d</table></tr></form><td>e<tbody><tr><td>f</table><tr><td>g"
    got = html.catalogue_rows(spark.createDataFrame([("k", source)], "path string, html string"), ("path",)).collect()
    assert [r["cells"] for r in got] == [["a  \n b", "cd", "d"], ["d"], ["e"], ["f"]]
    facets = "<table class=table_facettes><tr><td>filterQueryByFacet('ch') <a>A (1)</a><td><a>B (2)</a></table>"
    assert [r["label"] for r in html.facet_labels(spark.createDataFrame([(1, facets)], "year int, html string")).collect()] == ["A (1)"]


def test_statistics_of_channels(spark):
    b = spark.createDataFrame([("d", 1, "A", "channel", "abc", 80.0), ("d", 1, "A", "channel", None, 60.0), ("d", 1, "B", "ignored", "x", 1.0), ("d", 1, "C", "channel", "", None)], "page_date string, page_number int, channel string, type string, text string, confidence double")
    p = spark.createDataFrame([("d", 1, "A")] * 3, "page_date string, page_number int, channel string")
    got = sorted(map(tuple, entries.channel_statistics(b, p).drop("page_date", "page_number").collect()))
    assert got == [("A", 3, 70.0, 3), ("C", 0, None, 0)]
    failed = entries.batch_failures(spark.createDataFrame([("b", "bad"), ("a", None), ("c", "worse")], "input_key string, reason string"))
    assert [tuple(r) for r in failed.collect()] == [("b", "bad"), ("c", "worse")]


def test_rows_dropped(spark):
    ok = ["", "", "", "10:00", "00:30:00", "T", "", ""]
    bad = [ok[:5], ["", "", "", "10:00", "", "Statut de diffusion", ""], ["", "", "", "10:00", "", "[Interprogrammes]", ""], ["", "", "", "abc", "", "T", ""]]
    df = spark.createDataFrame([(c, None) for c in [ok, *bad]], "cells array<string>, href string")
    got = catalogue.keep_programme_rows(df).collect()
    assert [(r["title"], r["start_time"], r["end_time"], r["identifier"]) for r in got] == [("T", "10:00:00", "10:30:00", "")]


def test_register(spark):
    r = spark.createDataFrame([("Direct 8", None), ("D8", "Direct 8"), ("C8", "D8"), ("x", "y"), ("y", "x"), ("z", "gone")], "name string, predecessor string")
    got = {t[0]: t[1:] for t in map(tuple, register.rename_lineage(r).collect())}
    assert got["C8"] == ("Direct 8", 2) and got["Direct 8"] == ("Direct 8", 0)
    assert got["x"] == ("x", None) and got["y"] == ("y", None)
    long = spark.createDataFrame([(f"n{i}", f"n{i - 1}" if i else None) for i in range(150)] + [(f"c{i}", f"c{(i + 1) % 70}") for i in range(70)] + [("into", "c3"), ("self", "self")], "name string, predecessor string")
    got = {t[0]: t[1:] for t in map(tuple, register.rename_lineage(long).collect())}
    assert all(got[f"n{i}"] == ("n0", i) for i in range(150)) and all(got[f"c{i}"] == (f"c{i}", None) for i in range(70))
    assert got["into"] == ("into", None) and got["self"] == ("self", None)
    assert register.rename_lineage(long.limit(0)).count() == 0
    names = ["Canal+ Live 1", "Eurosport 360 4", "X HD", "X +1", "Kiosque", "À la carte", "Canal+ Bleu"]
    kept = register.exclude_technical_channels(spark.createDataFrame([(n,) for n in names], "name string"))
    assert [r["name"] for r in kept.collect()] == ["Kiosque", "À la carte", "Canal+ Bleu"]


def test_empty(spark):
    blocks = spark.createDataFrame([], "page_date string, page_number int, block_pos int, channel string, text string")
    assert entries.programmes_of_blocks(blocks).count() == 0
    assert profile.cluster_by_position(spark.createDataFrame([], "page_id string, column_index int, pos int")).count() == 0


def test_storage(spark, monkeypatch, tmp_path):
    """Small scans are dealt to all cores, others left as they lie; a folder that only one machine sees is refused on a cluster."""
    from airgrid import storage

    n = spark.sparkContext.defaultParallelism
    assert storage.dealt(spark.range(100).coalesce(1)).rdd.getNumPartitions() == n
    many = spark.range(100).repartition(n + 3)
    assert storage.dealt(many) is many
    path = storage.shared_dir(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and path != storage.shared_dir(spark, "t")
    storage.drop_dir(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    fake = type("S", (), {"sparkContext": Context, "conf": type("C", (), {"get": staticmethod(lambda k, d=None: d)})})
    with pytest.raises(RuntimeError):
        storage.shared_dir(fake, "t")
