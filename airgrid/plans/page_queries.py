"""Queries on page images, landed files, layouts in nested documents, places in an order and many short periods.

Images and files are made of table rows by Spark expressions, then read by the library's own readers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.operators import layout
from airgrid.operators.order import numbered
from airgrid.plans.registry import query, table
from airgrid.sources import files, images, landing
from airgrid.storage import shared_dir, spread

# Images: hexadecimal digits of rows of pixels. Ink is AA, paper BE, on either side of the threshold.

INK, PAPER = "AA", "BE"

#: Small images to a task, large images to a task.
PAGES, LARGE_PAGES = 20_000, 1_000


def rows_of(height: int, row) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(height - 1)), row)


def one_of(values: list, i: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), i.cast("int"))


def striped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of 50 rows for each part; the ink of row y starts at (k + 3 y) % 7 and is 1 + (k y) % 11 long."""
    k, width = F.col("p_partkey"), F.col("p_partkey") % 9 + 24
    widest = [PAPER * start + INK * (1 + more) + PAPER * (31 - start - more) for start in range(7) for more in range(11)]

    def row(y: Column) -> Column:
        return F.left(one_of(widest, (k + 3 * y) % 7 * 11 + (k * y) % 11), (2 * width).cast("int"))

    part = spread(table(spark, sf_dir, "part").select("p_partkey"), PAGES)
    return part.select(k.cast("string").alias("page_id"), F.lit(50).alias("height"), width.cast("int").alias("width"), F.lit(1).alias("nChannels"), images.raster(rows_of(50, row)).alias("data"))


_STRIPED = "SELECT p_partkey AS k, y, (p_partkey + 3 * y) % 7 AS a, (p_partkey + 3 * y) % 7 + 1 + (p_partkey * y) % 11 AS b, 24 + p_partkey % 9 AS width FROM part, range({y}) t(y)"


@query(f"""
    WITH s AS ({_STRIPED.format(y="4, 49")})
    SELECT CAST(k AS VARCHAR) AS page_id, CAST(x AS INT) AS pos, CAST(count(*) FILTER (a <= x AND x < b) AS INT) AS ink FROM s, range(33) c(x) WHERE x < width GROUP BY ALL""")
def ink_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ink of each column of pixels between the margins."""
    return images.column_ink_profile(striped(spark, sf_dir)).select("page_id", "pos", "ink")


@query(f"""
    WITH s AS ({_STRIPED.format(y="50")})
    SELECT CAST(k AS VARCHAR) AS page_id, CAST(c AS INT) AS column_index, CAST(y AS INT) AS pos, CAST(greatest(0, least(b, x + w) - greatest(a, x)) AS INT) AS ink
    FROM s, (VALUES (0, 3, 8), (1, 12, 10)) v(c, x, w)""")
def ink_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ink of each row of pixels in two columns of each page."""
    pages = striped(spark, sf_dir)
    columns = pages.select("page_id", F.inline(F.array(*(F.struct(F.lit(c).alias("column_index"), F.lit(x).alias("x"), F.lit(w).alias("width")) for c, x, w in ((0, 3, 8), (1, 12, 10))))))
    return images.row_ink_profile(pages, columns).select("page_id", "column_index", "pos", "ink")


@query("""
    WITH p AS (SELECT p_partkey AS k, [1, 3, 4][1 + p_partkey % 3] AS channels, 20 + p_partkey % 7 AS width FROM part),
    b AS (SELECT k, channels, (3 * x + y + k) % 4 = 0 AND (x + k) % 5 <> 0 AS coloured FROM p, range(3) r(y), range(27) c(x)
          WHERE x >= floor(width * CAST(0.35 AS DOUBLE)) AND x < floor(width * CAST(0.9 AS DOUBLE)))
    SELECT CAST(k AS VARCHAR) AS page_id, CAST(channels AS INT) AS channels, round(avg(CASE WHEN coloured AND channels > 1 THEN 1.0 ELSE 0.0 END), 9) AS colored_ratio FROM b GROUP BY ALL""")
def banner_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of coloured pixels in the band at the top, of pages of one, three and four channels; a fifth of the pixels is dark blue, which is no colour."""
    k, width = F.col("p_partkey"), (F.col("p_partkey") % 7 + 20).cast("int")
    channels = one_of([1, 3, 4], k % 3)

    def pixel(x: int, y: int, k: int) -> str:
        return "5A0A0AFF" if (x + k) % 5 == 0 else "2030C8FF" if (3 * x + y + k) % 4 == 0 else "808080FF"

    # Rows of each number of channels repeat with k from 20 on, and with y from 4 on.
    widest = ["".join(pixel(x, y, k)[: 2 * n] for x in range(26)) for n in (1, 3, 4) for k in range(20) for y in range(4)]
    part = spread(table(spark, sf_dir, "part").select("p_partkey"), PAGES)
    row = lambda y: F.left(one_of(widest, (k % 3 * 20 + k % 20) * 4 + y % 4), 2 * channels * width)
    pages = part.select(k.cast("string").alias("page_id"), F.lit(50).alias("height"), width.alias("width"), channels.alias("nChannels"), images.raster(rows_of(50, row)).alias("data"))
    return images.banner_color_ratio(pages, ("nChannels",)).select("page_id", F.col("nChannels").alias("channels"), F.round("colored_ratio", 9).alias("colored_ratio"))


# Pages of two columns of 30 pixels by 600 rows. By the remainder of their number they have printed lines, blank runs,
# neither, or lines and no separator named. A line has a band of ink behind it, but for the third one.

HEIGHT, WIDE, BAND = 600, 30, 110


def gridded(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    kind, shift = k % 4, k % 5
    marks = [180 + (k * 7) % 40, 400 + (k * 11) % 40, 520 + k % 3]
    pattern = lambda test: ["".join(INK if test(i, j) else PAPER for i in range(WIDE)) for j in range(3)]
    sparse, dark = pattern(lambda i, j: (i + j) % 3 == 0), pattern(lambda i, j: (i + j) % 3 < 2)
    full, band, blank = (F.lit("".join(INK if test(i) else PAPER for i in range(WIDE))) for test in (lambda i: True, lambda i: i % 5 < 3, lambda i: False))

    def column(y: Column, c: int) -> Column:
        at = [m + c * shift for m in marks]
        within = lambda first, n: (y >= first) & (y < first + n)
        thick = 3 + k % 3
        line = F.when(within(at[0], thick) | within(at[1], thick) | within(at[2], thick), full)
        line = line.when(within(at[0] + thick, BAND) | within(at[1] + thick, BAND), band)
        line = line.when(y % 4 == 0, one_of(sparse, F.floor(y / 4) % 3)).otherwise(blank)
        high = 10 + k % 5
        runs = F.when((kind == 1) & (within(at[0], high) | within(at[1], high)), blank).otherwise(one_of(dark, F.floor(y / 2) % 3))
        return F.when(kind.isin(0, 3), line).otherwise(runs)

    gutter = F.lit(PAPER * 10)
    data = images.raster(rows_of(HEIGHT, lambda y: F.concat(gutter, column(y, 0), gutter, column(y, 1), gutter)))
    separator = F.when(kind == 0, "line").when(kind == 1, "whitespace").when(kind == 2, "even")
    rows = (3 + F.floor(k / 4) % 2).cast("int")
    supplier = spread(table(spark, sf_dir, "supplier").select("s_suppkey"), LARGE_PAGES)
    return supplier.select(k.cast("string").alias("page_id"), F.lit(HEIGHT).alias("height"), F.lit(3 * 10 + 2 * WIDE).alias("width"), F.lit(1).alias("nChannels"), data.alias("data"), rows.alias("rows"), separator.alias("separator"))


@query(f"""
    WITH p AS (SELECT s_suppkey AS k, s_suppkey % 4 AS kind, CAST(3 + (s_suppkey // 4) % 2 AS INT) AS n_rows, 180 + (s_suppkey * 7) % 40 AS y1, 400 + (s_suppkey * 11) % 40 AS y2, 520 + s_suppkey % 3 AS y3,
                      3 + s_suppkey % 3 AS thick, 10 + s_suppkey % 5 AS high, s_suppkey % 5 AS shift FROM supplier),
    m AS (SELECT k, kind, n_rows, c, y, y - c * shift AS v, y1, y2, y3, thick, high FROM p, range(2) a(c), range({HEIGHT}) b(y)),
    -- Ink of each row of each column.
    ink AS (SELECT k, kind, c, y, CASE
              WHEN kind IN (0, 3) THEN CASE WHEN (v >= y1 AND v < y1 + thick) OR (v >= y2 AND v < y2 + thick) OR (v >= y3 AND v < y3 + thick) THEN 30
                   WHEN (v >= y1 AND v < y1 + thick + {BAND}) OR (v >= y2 AND v < y2 + thick + {BAND}) THEN 18 WHEN y % 4 = 0 THEN 10 ELSE 0 END
              WHEN kind = 1 AND ((v >= y1 AND v < y1 + high) OR (v >= y2 AND v < y2 + high)) THEN 0 ELSE 20 END AS ink FROM m),
    -- Candidates: the middles of runs of rows, full between the margins or blank off the edges.
    t AS (SELECT k, kind, c, y, y - row_number() OVER (PARTITION BY k, c ORDER BY y) AS island FROM ink
          WHERE (kind IN (0, 3) AND ink >= 0.85 * 30 AND y >= 48 AND y < 588) OR (kind = 1 AND ink <= 2)),
    r AS (SELECT k, kind, c, min(y) AS a, max(y) + 1 AS b FROM t GROUP BY k, kind, c, island),
    d AS (SELECT k, kind, c, (a + b) / 2.0 AS pos FROM r WHERE (kind = 1 AND b - a >= 8 AND a > 50 AND b < 550) OR (kind <> 1 AND b - a BETWEEN 2 AND 20)),
    -- Clusters, which lie more than the tolerance apart here.
    e AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY pos) AS g FROM (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY k ORDER BY pos) <= 30 THEN 0 ELSE 1 END AS new FROM d)),
    u AS (SELECT k, kind, avg(pos) AS pos, CAST(floor(avg(pos) + 0.5) AS INT) AS y FROM e GROUP BY k, kind, g),
    -- Printed lines count by the ink behind and before them.
    w AS (SELECT u.k, u.kind, u.y, sum(CASE WHEN i.y >= u.y + 3 AND i.y < u.y + 103 THEN ink ELSE 0 END) / (60.0 * (least({HEIGHT}, u.y + 103) - u.y - 3)) AS behind,
                 sum(CASE WHEN i.y >= u.y - 100 AND i.y < u.y THEN ink ELSE 0 END) / 6000.0 AS before FROM u JOIN ink i ON i.k = u.k GROUP BY u.k, u.kind, u.y),
    f AS (SELECT k, list(y ORDER BY y) AS own FROM w WHERE kind = 1 OR (behind >= 0.4 AND behind - before >= 0.15) GROUP BY k),
    -- One more row than cuts were found: the widest interval is halved.
    q AS (SELECT p.k, kind, n_rows, coalesce(own, []) AS own, list_concat([0], coalesce(own, []), [{HEIGHT}]) AS edges FROM p LEFT JOIN f USING (k)),
    h AS (SELECT *, list_transform(range(1, len(edges)), lambda i: edges[i + 1] - edges[i]) AS gaps FROM q),
    x AS (SELECT *, list_position(gaps, list_max(gaps)) AS i FROM h)
    SELECT CAST(k AS VARCHAR) AS page_id, array_to_string(CASE
             WHEN kind = 2 THEN list_transform(range(1, n_rows), lambda j: CAST(floor({HEIGHT} * j / CAST(n_rows AS DOUBLE) + 0.5) AS INT))
             WHEN len(own) < n_rows - 1 THEN list_sort(list_append(own, CAST(floor((edges[i] + edges[i + 1]) / 2.0 + 0.5) AS INT))) ELSE own END, ',') AS cuts FROM x""")
def row_cuts_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts between the rows of pages, by printed lines, blank runs, evenly, and by lines where no separator is named; from the pixels on."""
    pages = gridded(spark, sf_dir)
    cuts = images.row_cuts_of_images(pages.drop("rows", "separator"), pages.select("page_id", "rows", "separator"))
    return cuts.select("page_id", F.array_join("cuts", ",").alias("cuts"))


# Landed files


@query("""
    SELECT 'P' || page_id || CASE WHEN page_id % 5 = 0 THEN '.HTML' ELSE '.htm' END AS path, CAST(length(coalesce(html, '')) AS INT) AS n_chars, md5(coalesce(html, '')) AS md5 FROM pages WHERE page_id % 7 <> 0""")
def pages_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a file of its own, a seventh of them under another extension, read back whole."""
    k = F.col("page_id")
    name = F.concat(F.lit("P"), k.cast("string"), F.when(k % 7 == 0, ".txt").when(k % 5 == 0, ".HTML").otherwise(".htm"))
    path = shared_dir(spark, "pages")
    landing.land_files(table(spark, sf_dir, "pages").select(name.alias("name"), F.col("html").alias("content")), path)
    return files.read_html_pages(spark, path).select("path", F.length("html").alias("n_chars"), F.md5("html").alias("md5"))


@query("""
    WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey % 3 + 1 AS INT) AS page_number FROM orders WHERE year(o_orderdate) = 1996)
    SELECT date, page_number, row_number() OVER (ORDER BY date, page_number) AS position FROM d WHERE date BETWEEN DATE '1996-03-10' AND DATE '1996-11-20'""")
def scans_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of scanned pages by their names alone, in a range of dates, with their place in the order of names; other names are left out."""
    o = table(spark, sf_dir, "orders").where(F.year("o_orderdate") == 1996)
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-Page"), (F.col("o_custkey") % 3 + 1).cast("string"))
    names = o.select(F.concat(name, F.when(F.day("o_orderdate") % 2 == 0, ".jpg").otherwise(".JPEG")).alias("name")).distinct()
    path = shared_dir(spark, "scans")
    landing.land_files(names.unionByName(names.select(F.concat(F.lit("x"), "name").alias("name"))).withColumn("content", F.lit("x")), path)
    found = files.scan_manifest(spark, path, "1996-03-10", "1996-11-20")
    return numbered(found, F.regexp_extract("path", "([^/]*)$", 1)).select("date", "page_number", "position")


@query("SELECT issue_date, row_number() OVER (ORDER BY issue_date) AS position FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS issue_date FROM orders WHERE o_orderkey % 3 = 0)")
def issues_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of issues by their names alone, in order; a name without a date and one of another kind are left out."""
    name = F.date_format("o_orderdate", "yyyy-MM-dd")
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, F.concat(name, F.lit(".pdf"))).otherwise(F.concat(name, F.lit("-13.txt"))).alias("name")).distinct()
    path = shared_dir(spark, "issues")
    landing.land_files(o.withColumn("content", F.lit("x")), path)
    return numbered(files.issue_manifest(spark, path), F.col("issue_date")).select("issue_date", "position")


@query("""
    WITH b AS (SELECT p_brand, p_type, 1 + p_size % 3 AS page_number, p_partkey, p_name, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_type) - 1 AS list_pos,
                      row_number() OVER (PARTITION BY p_brand, p_type, p_size % 3 ORDER BY p_partkey) - 1 AS block_pos FROM part)
    SELECT CAST(list_pos AS INT) AS list_pos, p_brand || '/' || p_type AS period_name, DATE '1990-01-01' + CAST(list_pos AS INT) AS start_date, DATE '1990-12-31' AS end_date,
           CASE WHEN list_pos % 2 = 0 THEN 'line' END AS row_separator, CAST(page_number AS INT) AS page_number, 'grid' AS layout, CAST(block_pos AS INT) AS block_pos, p_name AS name,
           CASE WHEN p_partkey % 3 = 0 THEN 'channel' ELSE 'ignored' END AS type, CAST(CASE WHEN p_partkey % 2 = 1 THEN 1 ELSE p_partkey % 4 + 1 END AS INT) AS row_span,
           CASE WHEN p_partkey % 5 = 0 THEN 'V' || p_partkey || '@1990-01-02' END AS version FROM b""")
def layout_periods_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layouts as a JSON document for each brand, nested of the rows of part, landed and read back in reading order."""
    k = F.col("p_partkey")
    version = F.struct(F.concat(F.lit("V"), k.cast("string")).alias("name"), F.lit("1990-01-02").alias("from"), F.lit("1990-02-03").alias("to"))
    block = F.struct(F.col("p_name").alias("name"), F.when(k % 3 != 0, "ignored").alias("type"), F.when(k % 2 == 0, k % 4 + 1).alias("rowSpan"), F.when(k % 5 == 0, F.array(version)).alias("versions"))
    page = table(spark, sf_dir, "part").groupBy("p_brand", "p_type", (F.col("p_size") % 3 + 1).cast("string").alias("page")).agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), block.alias("b")))).alias("bs"))
    page = page.withColumn("v", F.struct(F.lit("grid").alias("layout"), F.transform("bs", lambda x: x["b"]).alias("blocks")))
    period = page.groupBy("p_brand", "p_type").agg(F.map_from_entries(F.collect_list(F.struct("page", "v"))).alias("pages"))
    brand = period.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.col("p_type"))).alias("names"), F.map_from_entries(F.collect_list(F.struct("p_type", "pages"))).alias("of"))

    def document(name: Column, i: Column) -> Column:
        start = F.date_add(F.lit("1990-01-01").cast("date"), i).cast("string")
        return F.struct(F.concat("p_brand", F.lit("/"), name).alias("name"), start.alias("startDate"), F.lit("1990-12-31").alias("endDate"), F.when(i % 2 == 0, "line").alias("rowSeparator"), F.element_at("of", name).alias("pages"))

    path = shared_dir(spark, "layouts")
    landing.land_files(brand.select(F.concat("p_brand", F.lit(".json")).alias("name"), F.to_json(F.struct(F.transform("names", document).alias("periods"))).alias("content")), path)
    first = F.get("versions", 0)
    return files.read_layout_periods(spark, path).withColumn("version", F.concat(first["name"], F.lit("@"), first["from"].cast("string"))).drop("versions")


# Places and periods


@query("""
    WITH n AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN replace(p_name, 'e', 'é') ELSE p_name END AS name FROM part)
    SELECT row_number() OVER (ORDER BY strip_accents(name), name) AS position, name, regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '-', 'g') AS slug FROM n""")
def inventory_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels with their places in French order, accents after the letters that bear none."""
    name = F.when(F.col("p_partkey") % 3 == 0, F.translate("p_name", "e", "é")).otherwise(F.col("p_name"))
    none = F.array().cast("array<struct<name: string, `from`: date, `to`: date>>")
    return layout.ordered_inventory(table(spark, sf_dir, "part").select(name.alias("name"), none.alias("versions"))).select("position", "name", "slug")


@query("""
    WITH p AS (SELECT l_orderkey * 8 + l_linenumber AS i, CAST(l_shipdate AS DATE) AS a, CAST(l_shipdate AS DATE) + CAST(l_partkey % 30 - 2 AS INT) AS b FROM lineitem WHERE l_orderkey % 3 <> 0),
    f AS (SELECT i, a, b FROM p WHERE a <= b), d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS page_date FROM orders)
    SELECT page_date, 'p' || min(i) AS period_name FROM d LEFT JOIN f ON page_date BETWEEN a AND b GROUP BY page_date""")
def periods_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of very many short periods, one for each line item, that covers each day; some periods are empty."""
    start = F.to_date("l_shipdate")
    i = F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").where("l_orderkey % 3 <> 0").select(F.concat(F.lit("p"), i.cast("string")).alias("period_name"), start.alias("start_date"), F.date_add(start, (F.col("l_partkey") % 30 - 2).cast("int")).alias("end_date"), i.alias("list_pos"))
    return layout.resolve_period(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("page_date")).distinct(), rows)
