"""Queries on programmes, layouts, indexes, profiles and the register."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airgrid.functions.text import collapse_ws
from airgrid.functions.times import add_duration, format_fr_date, normalize_time, parse_partial_date
from airgrid.functions.titles import extract_identifier, parse_facet_label, parse_group_history, resolve_title, split_distribution, strip_title_brackets
from airgrid.operators import catalogue, entries, layout, lineup, profile, register, weekdays
from airgrid.operators.stages import staged
from airgrid.plans.registry import query, table
from airgrid.sources import files, html, sinks
from airgrid.storage import shared_dir


def text(c: Column | str) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# Catalogue

#: Rows of a rendered page at most, so that pages grow in number and not in size.
PAGE_ROWS = 50


@query("""
    SELECT l_orderkey, l_partkey, l_extendedprice, lpad(CAST(l_linenumber * 3 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':00' AS start_time,
           lpad(CAST(((l_linenumber * 3 * 60 + l_partkey % 60 + CAST(l_quantity AS INT)) // 60) % 24 AS VARCHAR), 2, '0') || ':' ||
           lpad(CAST((l_partkey % 60 + CAST(l_quantity AS INT)) % 60 AS VARCHAR), 2, '0') || ':00' AS end_time
    FROM lineitem""")
def times_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = normalize_time(F.concat(text(F.col("l_linenumber") * 3), F.lit(":"), text(F.col("l_partkey") % 60), F.lit("abc")))
    duration = normalize_time(F.concat(F.lit("00:"), text(F.col("l_quantity").cast("int")), F.lit(":00:12")))
    df = staged(table(spark, sf_dir, "lineitem"), start_time=start, duration=duration)
    return df.select("l_orderkey", "l_partkey", "l_extendedprice", "start_time", add_duration(F.col("start_time"), F.col("duration")).alias("end_time"))


@query("""
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_type WHEN p_size % 3 = 1 THEN p_brand ELSE p_name END AS title, CASE WHEN p_size % 3 = 2 THEN NULL ELSE p_name END AS subtitle FROM part""")
def titles_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.col("p_size") % 3
    t = resolve_title(F.concat(F.lit(" "), "p_name"), F.when(third == 0, F.col("p_type")).otherwise(F.lit("  ")), F.when(third == 1, F.col("p_brand")))
    return table(spark, sf_dir, "part").select("p_partkey", t.alias("t")).select("p_partkey", "t.*")


@query("SELECT p_partkey, p_name AS title, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_brand END AS subtitle FROM part")
def brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    subtitle = F.when(F.col("p_size") % 2 == 0, F.upper("p_name")).otherwise(F.concat("p_brand", F.lit(" : [du soir]")))
    return table(spark, sf_dir, "part").select("p_partkey", strip_title_brackets(F.concat(F.lit("["), "p_name", F.lit("]")), subtitle).alias("t")).select("p_partkey", "t.*")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'TV_' || o_custkey || '.001' END AS identifier, strftime(o_orderdate, '%d/%m/%Y') AS fr_date FROM orders")
def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    href = F.concat(F.lit("https://catalogue.example.org/doc/"), F.when(F.col("o_orderkey") % 4 == 0, "RADIO").otherwise("TV-RADIO"), F.lit("/TV_"), text("o_custkey"), F.lit(".001/x?rang=1"))
    return table(spark, sf_dir, "orders").select("o_orderkey", extract_identifier(href).alias("identifier"), format_fr_date(F.col("o_orderdate")).alias("fr_date"))


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows: every seventh is a header, every fifth an interprogramme, every eleventh has no time, every thirteenth too few cells."""
    k = F.col("p_partkey")
    time = F.when(k % 11 == 0, "abc").otherwise(F.concat(text(k % 24), F.lit(":30")))
    own = F.when(k % 7 == 0, "Statut de diffusion").when(k % 5 == 0, "[Interprogrammes]").otherwise(F.col("p_name"))
    cells = F.array(F.lit("x"), F.lit("y"), F.lit("z"), time, F.lit("00:45:00"), own, F.lit(""), F.col("p_brand"), F.lit("Film"))
    cells = F.when(k % 5 == 0, F.slice(cells, 1, 6)).when(k % 13 == 0, F.slice(cells, 1, 5)).otherwise(cells)
    return table(spark, sf_dir, "part").select(F.lit("src").alias("source_code"), F.col("p_partkey").cast("int").alias("row_pos"), cells.alias("cells"), F.lit("/doc/TV-RADIO/A1/").alias("href"))


@query("""
    SELECT 'src' AS source_code, CAST(p_partkey AS INT) AS row_pos, lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') || ':30:00' AS start_time,
           lpad(CAST((p_partkey % 24 + 1) % 24 AS VARCHAR), 2, '0') || ':15:00' AS end_time, p_brand AS title, p_name AS subtitle, '' AS episode, 'Film' AS genre, 'A1' AS identifier, '' AS synopsis
    FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0""")
def programme_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.keep_programme_rows(part_rows(spark, sf_dir))


@query("""
    SELECT CAST(s_suppkey % 7 AS VARCHAR) AS path, s_suppkey, s_name || ' & ' || n_name AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def catalogue_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers rendered as the body rows of catalogue pages, PAGE_ROWS in each at most, read back."""
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    tr = F.concat(F.lit("<tr><td>"), text("s_suppkey"), F.lit("<td><b>"), "s_name", F.lit("</b> &amp;\n "), "n_name", F.lit("</td></tr>"))
    page = F.floor(F.col("s_suppkey") / (7 * PAGE_ROWS)).alias("page")
    pages = rows.groupBy(text(F.col("s_suppkey") % 7).alias("path"), page).agg(F.concat(F.lit("<html><table><tbody>"), F.concat_ws("", F.sort_array(F.collect_list(tr))), F.lit("</tbody></table>")).alias("html"))
    return html.catalogue_rows(pages, ("path",)).select("path", F.get("cells", 0).cast("long").alias("s_suppkey"), collapse_ws(F.get("cells", 1)).alias("label"))


@query(f"""
    WITH s AS (SELECT s_suppkey // {PAGE_ROWS} AS page, row_number() OVER (PARTITION BY s_suppkey // {PAGE_ROWS} ORDER BY s_suppkey) AS r, s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT page, CAST(2 * r - 2 AS INT) AS row_pos, s_suppkey || '|' || s_name || ' &' || chr(10) || '  ' || n_name || ' inner|inner' AS cells FROM s
    UNION ALL SELECT page, CAST(2 * r - 1 AS INT), 'inner' FROM s""")
def catalogue_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in pages whose tables have no tbody and a table in each row: every row once, blanks inside cells as they are."""
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    tr = F.concat(F.lit("<tr><td>\n"), text("s_suppkey"), F.lit(" <td> "), "s_name", F.lit(" &amp;\n  "), "n_name", F.lit("<table><tr><td> inner</table>"))
    own = F.array_sort(F.collect_list(F.struct("s_suppkey", tr.alias("tr"))))
    pages = rows.groupBy(F.floor(F.col("s_suppkey") / PAGE_ROWS).alias("page")).agg(F.concat(F.lit("<body><table><thead><tr><td>head</thead>"), F.array_join(F.transform(own, lambda x: x["tr"]), ""), F.lit("</table>")).alias("html"))
    return html.catalogue_rows(pages, ("page",)).select("page", "row_pos", F.array_join("cells", "|").alias("cells"))


@query("SELECT c_mktsegment AS channel, 2 * count(*) AS n FROM customer GROUP BY 1")
def facet_labels_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As facet_labels, in a table in a cell of a table of that class: the outer cell lists its links, and so does each inner one."""
    counts = table(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / PAGE_ROWS).alias("year"), "c_mktsegment").count()
    a = F.concat(F.lit("<tr><td><a onclick=\"filterQueryByFacet('ch')\">"), "c_mktsegment", F.lit(" ("), text("count"), F.lit(")</a>"))
    page = counts.groupBy("year").agg(F.concat(F.lit('<table class="x table_facettes"><tr><td><table class=table_facettes>'), F.concat_ws("", F.collect_list(a)), F.lit("</table><td><a>others (3)</a></table>")).alias("html"))
    labels = html.facet_labels(page).select(parse_facet_label(F.col("label")).alias("f")).where("f is not null").select("f.*")
    return labels.groupBy("channel").agg(F.sum("n").alias("n"))


@query("""
    WITH l AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1) SELECT c_mktsegment AS channel, n FROM l""")
def facet_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each PAGE_ROWS customers with its counts, read back and added up."""
    year = F.floor(F.col("c_custkey") / PAGE_ROWS).alias("year")
    counts = table(spark, sf_dir, "customer").groupBy(year, "c_mktsegment").count()
    a = F.concat(F.lit("<tr><td><a onclick=\"filterQueryByFacet('ch')\">"), "c_mktsegment", F.lit(" ("), text("count"), F.lit(")</a></td></tr>"))
    page = counts.groupBy("year").agg(F.concat(F.lit('<table class="table_facettes">'), F.concat_ws("", F.collect_list(a)), F.lit("<tr><td><a>others (3)</a></td></tr></table>")).alias("html"))
    labels = html.facet_labels(page).select(parse_facet_label(F.col("label")).alias("f")).where("f is not null").select("f.*")
    return labels.groupBy("channel").agg(F.sum("n").alias("n"))


@query("""
    WITH n AS (SELECT event_type AS source_code, user_id AS channel_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) >= DATE '2024-01-15' AS late FROM events),
    o AS (SELECT source_code, channel_id, day, count(*) AS n_programmes FROM n WHERE NOT late OR channel_id % 2 = 0 GROUP BY ALL),
    f AS (SELECT source_code, channel_id, day, count(*) AS n_programmes FROM n WHERE late GROUP BY ALL)
    SELECT coalesce(f.source_code, o.source_code) AS source_code, coalesce(f.channel_id, o.channel_id) AS channel_id, coalesce(f.day, o.day) AS day,
           coalesce(f.n_programmes, o.n_programmes) AS n_programmes, CAST(CASE WHEN f.day IS NULL THEN 1 ELSE 0 END AS INT) AS loaded
    FROM o FULL JOIN f ON o.source_code = f.source_code AND o.channel_id = f.channel_id AND o.day = f.day""")
def programme_day_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source_code"), F.col("user_id").alias("channel_id"), F.to_date("ts").alias("day"))
    late = F.col("day") >= F.lit(datetime.date(2024, 1, 15))
    old = e.where(~late | (F.col("channel_id") % 2 == 0)).groupBy("source_code", "channel_id", "day").agg(F.count(F.lit(1)).alias("n_programmes")).withColumn("loaded", F.lit(1))
    return catalogue.upsert_programme_day(old, e.where(late))


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, c_mktsegment AS channel, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def year_channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return catalogue.channel_year_counts(o, "c_mktsegment", "o_orderdate")


@query("""
    SELECT o_orderkey, unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INT), INTERVAL 1 DAY))::DATE AS day FROM orders""")
def date_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    n = (F.col("o_orderkey") % 5).cast("int")
    param = F.when(n == 0, text(day)).otherwise(F.concat(text(day), F.lit("->"), text(F.date_add(day, n))))
    return catalogue.expand_days(table(spark, sf_dir, "orders").select("o_orderkey", param.alias("param"))).drop("param")


@query("""
    SELECT n_name AS source_code, s_name AS channel_url, unnest(generate_series(make_date(1990 + s_suppkey % 9, 1, 1), make_date(1990 + s_suppkey % 9 + 1, 12, 31), INTERVAL 1 DAY))::DATE AS day
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def job_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    first = (F.col("s_suppkey") % 9 + 1990).cast("int")
    return catalogue.expand_jobs(s.select(F.col("n_name").alias("source_code"), F.col("s_name").alias("channel_url"), first.alias("first_year"), (first + 1).alias("last_year")))


def channel_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    channel = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id_chaine"), F.col("c_name").alias("nom_chaine"), text("c_custkey").alias("url_chaine"))
    n = table(spark, sf_dir, "nation")
    source = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id_chaine"), F.col("n_name").alias("code_source"), F.col("c_mktsegment").alias("nom_chaine_source"))
    jobs = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return jobs.select("o_orderkey", text("o_custkey").alias("channel_url"), F.col("n_name").alias("source_code")), channel, source


@query("""
    SELECT o_orderkey, CAST(c_custkey AS VARCHAR) AS channel_url, n_name AS source_code, c_custkey AS id_chaine, c_mktsegment AS nom_chaine_source
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 <> 0""")
def channel_source_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.resolve_channel_source(*channel_tables(spark, sf_dir))[0]


@query("""
    SELECT o_orderkey, CAST(c_custkey AS VARCHAR) AS channel_url, n_name AS source_code
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 = 0""")
def channel_source_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.resolve_channel_source(*channel_tables(spark, sf_dir))[1]


@query("SELECT o_orderpriority AS channel, CAST(o_orderdate AS DATE) AS day, count(*) AS n_programmes FROM orders GROUP BY ALL HAVING count(*) >= 3")
def capped_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose number of rows reaches what a request gives at most."""
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("channel"), F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n_programmes"))
    return catalogue.capped_days(days, 3)


# Listings


@query("""
    SELECT p_partkey, p_name AS channel, CASE WHEN p_name LIKE 'red%' THEN 'rouge' ELSE replace(p_name, ' ', '-') END AS slug, p_name NOT LIKE 'red%' AS slug_missing FROM part""")
def slug_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("channel"))
    mapping = p.where("channel like 'red%'").select(F.col("channel").alias("name"), F.lit("rouge").alias("slug")).distinct()
    return entries.resolve_slug(p, mapping)


@query("""
    SELECT l_orderkey, l_partkey, l_extendedprice, file_name FROM (SELECT l_orderkey, l_partkey, l_extendedprice, 'Page' || l_linenumber * 3 AS file_name,
           rank() OVER (PARTITION BY l_orderkey ORDER BY 'Page' || l_linenumber * 3 DESC) AS r FROM lineitem) WHERE r = 1""")
def last_page_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", F.concat(F.lit("Page"), text(F.col("l_linenumber") * 3)).alias("file_name"))
    return entries.last_page_wins(li, ("l_orderkey",))


@query("""
    WITH b AS (SELECT o_orderkey AS page, count(*) FILTER (WHERE o_orderstatus <> 'P') AS active_blocks, count(*) FILTER (WHERE o_orderstatus = 'F') AS channels,
                      CAST(sum(length(o_orderpriority)) AS BIGINT) AS characters, avg(o_totalprice) AS mean_confidence FROM orders GROUP BY 1),
    p AS (SELECT l_orderkey AS page, count(*) AS programmes FROM lineitem GROUP BY 1)
    SELECT b.*, coalesce(programmes, 0) AS programmes FROM b LEFT JOIN p USING (page)""")
def page_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "P", "ignored").when(F.col("o_orderstatus") == "F", "channel").otherwise("insert")
    blocks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), kind.alias("type"), F.col("o_orderpriority").alias("text"), F.col("o_totalprice").alias("confidence"))
    return entries.page_statistics(blocks, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page")), ("page",))


@query("SELECT CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'succeeded' END AS status, count(*) AS n FROM orders GROUP BY 1")
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.when(F.col("o_orderstatus") == "P", F.lit("pending"))
    return entries.batch_summary(table(spark, sf_dir, "orders").select(text("o_orderkey").alias("input_key"), reason.alias("reason")))


@query("SELECT 'orders' AS stage, CAST(c_custkey AS VARCHAR) AS input_key, 'no order' AS reason FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return entries.collect_rejects("orders", good, table(spark, sf_dir, "customer"), "c_custkey", "no order")


@query("""SELECT 'pending' AS stage, CAST(c_custkey AS VARCHAR) AS input_key, 'no pending order' AS reason FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def rejects_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return entries.collect_rejects("pending", good, table(spark, sf_dir, "customer"), "c_custkey", "no pending order")


@query("""
    WITH b AS (SELECT o_custkey AS page, o_orderpriority AS channel, CAST(sum(length(o_orderstatus || 'é')) AS BIGINT) AS characters, avg(o_totalprice) AS mean_confidence FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL),
    p AS (SELECT o_custkey AS page, o_orderpriority AS channel, count(*) AS programmes FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL)
    SELECT b.*, coalesce(programmes, 0) AS programmes FROM b LEFT JOIN p USING (page, channel)""")
def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumns({"page": F.col("o_custkey"), "channel": F.col("o_orderpriority")})
    kind = F.when(F.col("o_orderstatus") == "F", "channel").otherwise("ignored")
    blocks = o.select("page", "channel", kind.alias("type"), F.concat("o_orderstatus", F.lit("é")).alias("text"), F.col("o_totalprice").alias("confidence"))
    return entries.channel_statistics(blocks, o.where("o_orderstatus = 'O'"), ("page", "channel"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS input_key, 'pending' AS reason FROM orders WHERE o_orderstatus = 'P'")
def batch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.when(F.col("o_orderstatus") == "P", F.lit("pending"))
    return entries.batch_failures(table(spark, sf_dir, "orders").select(text("o_orderkey").alias("input_key"), reason.alias("reason")))


# Writers and readers: what is written is read back.


def read_back(spark: SparkSession, path: str, sep: str) -> DataFrame:
    return spark.read.csv(path, sep=sep, header=True, escape='"')


@query("""
    SELECT 'F' || o_orderstatus AS slug, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS page_date, o_orderpriority AS "Chaine", '06:35' AS "Heure", o_orderkey || ';' || o_custkey AS "Titre Programme",
           'dit "' || o_orderpriority || '"' AS "Sous-titre", 'Film' AS "Genre" FROM orders""")
def listings_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rows = o.select(
        F.trunc(F.to_date("o_orderdate"), "month").alias("page_date"), F.concat(F.lit("F"), "o_orderstatus").alias("slug"), F.col("o_orderkey").alias("entry_pos"), F.col("o_orderpriority").alias("channel"), F.lit("06:35").alias("start_time"),
        F.concat(text("o_orderkey"), F.lit(";"), text("o_custkey")).alias("title"), F.concat(F.lit('dit "'), "o_orderpriority", F.lit('"')).alias("subtitle"), F.lit("Film").alias("genre"),
    )
    path = shared_dir(spark, "listings")
    sinks.write_listings(rows, path)
    return read_back(spark, path, ";").select("slug", text("page_date").alias("page_date"), "Chaine", "Heure", "Titre Programme", "Sous-titre", "Genre")


@query("""
    SELECT 'INA' || o_orderstatus AS source_code, strftime(date_trunc('month', o_orderdate), '%d/%m/%Y') AS "Date", o_orderpriority AS "Chaine", '10:00:00' AS "Heure début", o_orderkey || '|' || o_custkey AS "Titre", 'Id' || o_orderkey AS "Identifiant" FROM orders""")
def programmes_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {
        "source_code": F.concat(F.lit("ina"), F.lower("o_orderstatus")), "channel_url": F.lit("une"), "channel": F.col("o_orderpriority"), "air_date": F.trunc(F.to_date("o_orderdate"), "month"), "start_time": F.lit("10:00:00"), "end_time": F.lit("11:00:00"),
        "title": F.concat(text("o_orderkey"), F.lit("|"), text("o_custkey")), "subtitle": F.lit("x"), "episode": F.lit("1"), "genre": F.lit("Film"), "identifier": F.concat(F.lit("Id"), text("o_orderkey")), "synopsis": F.lit("s"),
    }
    path = shared_dir(spark, "programmes")
    sinks.write_programmes(table(spark, sf_dir, "orders").select(*(c.alias(k) for k, c in given.items())), path)
    return read_back(spark, path, "|").select("source_code", "Date", "Chaine", "Heure début", "Titre", "Identifiant")


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS chaine, CAST(count(*) AS VARCHAR) AS nombre FROM orders GROUP BY ALL")
def year_counts_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year is written twice; the second time replaces the first."""
    counts = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("channel")).agg(F.count(F.lit(1)).alias("n"))
    path = shared_dir(spark, "year-counts")
    sinks.append_year_counts(counts.withColumn("n", F.col("n") + 1), path)
    sinks.append_year_counts(counts, path)
    return read_back(spark, path, ";").select("year", "chaine", "nombre")


@query("""SELECT o_orderpriority AS channel, CAST(o_orderkey AS VARCHAR) AS entry_pos, o_orderpriority || ';"' AS unparsed_tail FROM orders WHERE o_orderkey % 3 <> 0""")
def unparsed_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat("o_orderpriority", F.lit(';"')))
    rows = table(spark, sf_dir, "orders").select(F.trunc(F.to_date("o_orderdate"), "month").alias("page_date"), F.col("o_orderpriority").alias("channel"), F.col("o_orderkey").alias("entry_pos"), F.lit("06:35").alias("start_time"), tail.alias("unparsed_tail"))
    path = shared_dir(spark, "unparsed")
    sinks.write_unparsed_segments(rows, path)
    return read_back(spark, path, ";").select("channel", "entry_pos", "unparsed_tail")


@query("""SELECT CAST(1990 + c_nationkey AS VARCHAR) AS annee, c_mktsegment AS categorie, CAST(c_custkey AS VARCHAR) AS canal, c_name AS chaine, '/f/' || c_custkey AS logo FROM customer""")
def channel_months_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = text("c_custkey")
    rows = table(spark, sf_dir, "customer").select(text(F.col("c_nationkey") + 1990).alias("year"), F.lpad(text(F.col("c_custkey") % 12 + 1), 2, "0").alias("month"), F.col("c_mktsegment").alias("category"), k.alias("number"), F.col("c_name").alias("channel"), F.concat(F.lit("/f/"), k).alias("logo"))
    path = shared_dir(spark, "channel-months")
    sinks.write_channel_months(rows, path)
    return read_back(spark, path, ",").select(text("annee").alias("annee"), "categorie", "canal", "chaine", "logo")


@query("SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS issue_date, CAST(count(*) AS VARCHAR) AS samedi, CAST(max(o_custkey) AS VARCHAR) AS dimanche FROM orders GROUP BY 1")
def day_index_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("issue_date")).agg(F.count(F.lit(1)).alias("samedi"), F.max("o_custkey").alias("dimanche"))
    path = shared_dir(spark, "day-index")
    sinks.write_day_index(rows, path)
    return read_back(spark, path, ";").select("issue_date", "samedi", "dimanche")


@query("""
    SELECT CAST(l_linenumber AS INT) AS page_number, (CAST(l_orderkey AS BIGINT) * 1000000 + l_partkey) * 1000 + l_linenumber AS seq, '"' || l_returnflag AS text, CAST(l_quantity AS DOUBLE) AS confidence FROM lineitem WHERE l_linenumber <> 2""")
def ocr_words_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as recognised words; those of another level or without text are left out."""
    li, n = table(spark, sf_dir, "lineitem"), F.col("l_linenumber")
    zero = [F.lit(0).alias(c) for c in ("left", "top", "width", "height")]
    level = F.when(n == 2, F.when(F.col("l_partkey") % 2 == 0, 4).otherwise(5)).otherwise(5)
    word = F.when((n == 2) & (F.col("l_partkey") % 2 == 1), F.lit(" ")).otherwise(F.concat(F.lit('"'), "l_returnflag"))
    # block, par, line and word numbers are digits of one number: an order's goes over the first two.
    rows = li.select(
        level.alias("level"), n.alias("page_num"), F.col("l_orderkey").alias("block_num"), F.floor(F.col("l_partkey") / 1000).alias("par_num"), (F.col("l_partkey") % 1000).alias("line_num"), n.alias("word_num"), *zero, F.col("l_quantity").alias("conf"), word.alias("text"),
    )
    path = shared_dir(spark, "words")
    rows.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path, sep="\t", header=True, quote="")
    return files.read_ocr_words(spark, path).select("page_number", "seq", "text", "confidence")


# Layouts

_PERIODS = [("p1", "1995-03-01", "1997-12-31", 0), ("p2", "1997-06-01", "2000-02-28", 1), ("p3", "2000-01-01", "2001-03-31", 2)]
_PERIOD_SQL = ", ".join(f"('{n}', DATE '{a}', DATE '{b}', {i})" for n, a, b, i in _PERIODS)


def periods(spark: SparkSession) -> DataFrame:
    rows = [(n, datetime.date.fromisoformat(a), datetime.date.fromisoformat(b), i) for n, a, b, i in _PERIODS]
    return spark.createDataFrame(rows, "period_name string, start_date date, end_date date, list_pos int")


_RESOLVED = f"""
    WITH p(name, a, b, i) AS (VALUES {_PERIOD_SQL}),
    r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS page_date, (SELECT arg_min(name, i) FROM p WHERE CAST(o_orderdate AS DATE) BETWEEN a AND b) AS period_name FROM orders)"""


@query(_RESOLVED + " SELECT * FROM r WHERE period_name IS NOT NULL")
def period_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("page_date"))
    return layout.resolve_period(o, periods(spark)).where("period_name is not null").select("o_orderkey", "page_date", "period_name")


@query(_RESOLVED + " SELECT o_orderkey, page_date FROM r WHERE period_name IS NULL")
def period_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("page_date"))
    return layout.resolve_period(o, periods(spark)).where("period_name is null").select("o_orderkey", "page_date")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'fixed' WHEN CAST(o_orderdate AS DATE) <= DATE '1998-12-09' THEN 'before' WHEN CAST(o_orderdate AS DATE) <= DATE '2000-12-31' THEN 'after' END AS name FROM orders""")
def version_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = F.expr("array(struct('before' as name, date'1990-01-01' as `from`, date'1998-12-09' as `to`), struct('after' as name, date'1998-12-10' as `from`, date'2000-12-31' as `to`))")
    none = F.array().cast("array<struct<name:string,from:date,to:date>>")
    own = F.when(F.col("o_orderkey") % 4 == 0, none).otherwise(versions)
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("page_date"), F.lit("fixed").alias("name"), own.alias("versions"))
    return layout.resolve_block_versions(o).select("o_orderkey", "name")


def line_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a page, its lines are the blocks; returned ones are ignored."""
    li = table(spark, sf_dir, "lineitem")
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")) - 1
    return li.select(F.lit("p").alias("period_name"), F.col("l_orderkey").alias("page_number"), pos.alias("block_pos"), F.when(F.col("l_returnflag") == "R", "ignored").otherwise("channel").alias("type"), (F.col("l_quantity") % 3 + 1).cast("int").alias("row_span"))


@query("SELECT l_orderkey AS page_number, CAST(sum(CAST(l_quantity AS INT) % 3 + 1) AS BIGINT) AS cells FROM lineitem GROUP BY 1")
def cell_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.grid_cell_count(line_layout(spark, sf_dir)).select("page_number", "cells")


@query("SELECT l_orderkey AS page_number, count(*) FILTER (WHERE l_returnflag <> 'R') AS active, count(*) FILTER (WHERE l_returnflag = 'R') AS ignored FROM lineitem GROUP BY 1")
def active_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    on, off = layout.split_active_ignored(line_layout(spark, sf_dir))
    both = on.select("page_number", F.lit(1).alias("a"), F.lit(0).alias("i")).unionByName(off.select("page_number", F.lit(0).alias("a"), F.lit(1).alias("i")))
    return both.groupBy("page_number").agg(F.sum("a").alias("active"), F.sum("i").alias("ignored"))


@query("""SELECT o_orderkey, CAST(o_orderkey % 4 + 1 AS INT) AS page_number, CASE WHEN o_orderkey % 4 < 3 THEN 'single' END AS layout FROM orders""")
def page_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages 1 to 3 have a layout, page 4 is a miss."""
    known = spark.createDataFrame([("p", k, "single") for k in (1, 2, 3)], "period_name string, page_number int, layout string")
    pages = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("p").alias("period_name"), (F.col("o_orderkey") % 4 + 1).cast("int").alias("page_number"))
    found, missed = layout.resolve_page_layout(pages, known)
    return found.select("o_orderkey", "page_number", "layout").unionByName(missed.select("o_orderkey", "page_number", F.lit(None).cast("string").alias("layout")))


@query("SELECT DISTINCT n AS name, replace(lower(n), '#', '-') AS slug FROM (SELECT p_brand AS n FROM part UNION ALL SELECT replace(p_name, ' ', '-') FROM part)")
def channel_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    version = F.array(F.struct(F.translate("p_name", " ", "-").alias("name"), F.lit(None).cast("date").alias("from"), F.lit(None).cast("date").alias("to")))
    blocks = p.select(F.when(F.col("p_partkey") % 50 != 51, F.col("p_brand")).alias("name"), version.alias("versions"))
    return layout.channel_inventory(blocks)


@query("SELECT page_id, row, y, height FROM (SELECT p_partkey AS page_id, unnest([0, 1, 2]) AS row, unnest([0, p_size, p_size * 2]) AS y, unnest([p_size, p_size, p_size * 3]) AS height FROM part)")
def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    return layout.row_bands(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), F.array(s, s * 2).alias("cuts"), (s * 5).alias("height")))


@query("""
    SELECT p_partkey AS page_id, CAST(greatest(1, floor(p_size / 4.0 + 0.5)) AS INT) AS expected_rows,
           CASE WHEN p_size % 4 <> 0 THEN '4 x ' || p_size // 4 || ' places for ' || p_size || ' cells' END AS message FROM part""")
def grid_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    return layout.grid_mismatch(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), s.alias("cells"), F.lit(4).alias("columns"), F.floor(s / 4).cast("int").alias("rows")))


@query("""
    WITH RECURSIVE b AS (SELECT l_orderkey AS page_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos, CAST(l_quantity AS INT) % 3 + 1 AS span FROM lineitem),
    s AS (SELECT DISTINCT page_id, CAST(-1 AS BIGINT) AS pos, list_transform(range(10), lambda x: false) AS taken, CAST(NULL AS BIGINT) AS k, CAST(NULL AS BIGINT) AS n FROM b
      UNION ALL
      SELECT page_id, pos, CASE WHEN k IS NULL THEN taken ELSE list_transform(taken, lambda t, i: t OR ((i - 1) % 2 = (k - 1) % 2 AND (i - 1) // 2 >= (k - 1) // 2 AND (i - 1) // 2 < (k - 1) // 2 + n)) END, k, n
      FROM (SELECT *, least(span, 5 - (k - 1) // 2) AS n FROM (SELECT s.page_id, b.pos, b.span, s.taken, CAST(nullif(list_position(s.taken, false), 0) AS BIGINT) AS k FROM s JOIN b ON b.page_id = s.page_id AND b.pos = s.pos + 1)))
    SELECT page_id, CAST(pos AS INT) AS block_pos, CAST((k - 1) % 2 * 100 AS INT) AS x, CAST((k - 1) // 2 * 50 AS INT) AS y, CASE WHEN k IS NOT NULL THEN 90 END AS width, CASE WHEN k IS NOT NULL THEN CAST(n * 50 AS INT) END AS height FROM s WHERE pos >= 0""")
def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = line_layout(spark, sf_dir).withColumnRenamed("page_number", "page_id")
    ids = pages.select("page_id").distinct()
    columns = ids.select("page_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("column_index")).withColumns({"x": F.col("column_index") * 100, "width": F.lit(90)})
    rows = ids.select("page_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("row")).withColumns({"y": F.col("row") * 50, "height": F.lit(50)})
    return layout.assign_bounds(pages, columns, rows)


# Weekday index

_SEQ = """
    WITH RECURSIVE d AS (
      SELECT CAST(user_id AS INT) AS issue, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) + 30 AS INT) AS page, event_id % 7 AS k FROM events),
    s AS (
      SELECT issue, 0 AS k, min(page) AS page FROM d WHERE page >= 36 AND k = 0 GROUP BY issue
      UNION ALL
      SELECT s.issue, s.k + 1, (SELECT min(page) FROM d WHERE d.issue = s.issue AND d.page >= s.page + 8 AND d.k = s.k + 1) FROM s WHERE s.k < 6 AND s.page IS NOT NULL),
    f AS (SELECT issue, k, page FROM s WHERE page IS NOT NULL)"""


def found_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    page = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) + 30
    day = F.get(F.array(*[F.lit(d) for d in weekdays.WEEKDAYS]), (F.col("event_id") % 7).cast("int"))
    detections = table(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("issue_date"), page.alias("page_number"), day.alias("day"))
    return detections, weekdays.match_day_sequence(detections)


@query(_SEQ + " SELECT issue AS issue_date, " + ", ".join(f"max(page) FILTER (WHERE k = {i}) AS {d}" for i, d in enumerate(weekdays.WEEKDAYS)) + " FROM f GROUP BY 1")
def weekday_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekdays.pivot_day_index(found_days(spark, sf_dir)[1])


@query(_SEQ + f" SELECT i.issue AS issue_date, {weekdays.WEEKDAYS}[k + 1] AS day FROM (SELECT DISTINCT issue FROM d) i, range(7) t(k) WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.issue = i.issue AND f.k = t.k)")
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections, found = found_days(spark, sf_dir)
    return weekdays.missing_days(detections, found)


# Line-ups


def lineup_page(heading: Column, group: Column) -> Column:
    """A page with a table of the rows (number, name) of a column named rows, which share one cell."""
    tr = F.transform(
        "rows",
        lambda x, i: F.concat(
            F.lit("<tr><td>"), x["number"].cast("string"), F.when(i == 0, F.concat(F.lit("<td rowspan="), F.size("rows").cast("string"), F.lit(">"), group)).otherwise(F.lit("")),
            F.lit('<td><a class=image href="/f/'), x["number"].cast("string"), F.lit('.svg"><img src=t.png></a><td>'), x["name"],
        ),
    )
    return F.concat(F.lit('<div class="mw-parser-output"><h2><span class="mw-headline">'), heading, F.lit("</span></h2><table class=wikitable><tr><th>N° de canal<th>Groupe<th>Logo<th>Chaîne"), F.array_join(tr, ""), F.lit("</table></div>"))


@query("""SELECT r_name || '.htm' AS path, r_name AS category, CAST(n_nationkey AS VARCHAR) AS number, n_name AS channel, '/f/' || n_nationkey || '.svg' AS logo FROM nation JOIN region ON n_regionkey = r_regionkey""")
def lineup_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each region, with a cell that spans all of its rows, read back."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    g = n.groupBy("r_name").agg(F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").alias("number"), F.col("n_name").alias("name")))).alias("rows"))
    return lineup.lineup_rows(g.select(F.concat("r_name", F.lit(".htm")).alias("path"), lineup_page(F.col("r_name"), F.lit("G")).alias("html"))).select("path", "category", "number", "channel", "logo")


@query(f"""SELECT 'P' || s_suppkey // {PAGE_ROWS} || '.htm' AS path, 'Page ' || s_suppkey // {PAGE_ROWS} AS category, CAST(s_suppkey AS VARCHAR) AS number, s_name AS channel, '/f/' || s_suppkey || '.svg' AS logo FROM supplier""")
def lineup_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each PAGE_ROWS suppliers; the cell that they share holds a table of its own, whose rows are none of the page's."""
    page = text(F.floor(F.col("s_suppkey") / PAGE_ROWS))
    g = table(spark, sf_dir, "supplier").groupBy(page.alias("page")).agg(F.sort_array(F.collect_list(F.struct(F.col("s_suppkey").alias("number"), F.col("s_name").alias("name")))).alias("rows"))
    source = lineup_page(F.concat(F.lit("Page "), "page"), F.lit("G<table><tr><td>x<td>y<td>z<td>inner</table>"))
    return lineup.lineup_rows(g.select(F.concat(F.lit("P"), "page", F.lit(".htm")).alias("path"), source.alias("html"))).select("path", "category", "number", "channel", "logo")


@query(f"""
    WITH s AS (SELECT s_suppkey // {PAGE_ROWS} AS page, s_suppkey, s_name, row_number() OVER (PARTITION BY s_suppkey // {PAGE_ROWS} ORDER BY s_suppkey) - 1 AS r FROM supplier)
    SELECT 'P' || page || '.htm' AS path, CAST(s_suppkey AS VARCHAR) AS number, first_value(s_name) OVER (PARTITION BY page, r // 2 ORDER BY r) AS channel, '/f/' || first_value(s_suppkey) OVER (PARTITION BY page, r // 3 ORDER BY r) AS logo FROM s""")
def lineup_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-ups whose channels span two rows, whose logos span three, and whose group is two columns wide in the heading; spans run over the last row."""
    g = table(spark, sf_dir, "supplier").groupBy(text(F.floor(F.col("s_suppkey") / PAGE_ROWS)).alias("page")).agg(F.sort_array(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("rows"))
    cell = lambda x, i, n, html_: F.when(i % n == 0, F.concat(F.lit(f"<td rowspan={n}>"), html_)).otherwise(F.lit(""))
    tr = F.transform("rows", lambda x, i: F.concat(F.lit("<tr><td>"), text(x["s_suppkey"]), F.lit("<td>a<td>b"), cell(x, i, 3, F.concat(F.lit('<a class=image href="/f/'), text(x["s_suppkey"]), F.lit('"></a>'))), cell(x, i, 2, x["s_name"])))
    source = F.concat(F.lit('<div class="mw-parser-output"><table class=wikitable><tr><th>N° de canal<th colspan=2>Groupe<th>Logo<th>Chaîne'), F.array_join(tr, ""), F.lit("</table></div>"))
    return lineup.lineup_rows(g.select(F.concat(F.lit("P"), "page", F.lit(".htm")).alias("path"), source.alias("html"))).select("path", "number", "channel", "logo")


@query("""
    SELECT user_id, event_id, coalesce(last_value(CASE WHEN event_type = 'signup' THEN 'S' || event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), '') AS category FROM events""")
def carried_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    heading = F.when(F.col("event_type") == "signup", F.concat(F.lit("S"), text("event_id"))).otherwise(F.lit(""))
    nodes = table(spark, sf_dir, "events").select(F.col("user_id").alias("path"), F.col("event_id").alias("node_pos"), heading.alias("heading"))
    return lineup.carry_category(nodes).select(F.col("path").alias("user_id"), F.col("node_pos").alias("event_id"), "category")


@query("""SELECT page_id, CAST(i - 1 AS INT) AS pos, replace(l[i], '&amp;', '&') AS href FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages))""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.page_links(table(spark, sf_dir, "pages"))


# Profiles


def order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each day and status: a profile with gaps, filled with zeros."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("page_id"), F.datediff(F.to_date("o_orderdate"), F.lit(datetime.date(1995, 1, 1))).alias("pos")).agg(F.count(F.lit(1)).cast("int").alias("ink"))
    span = o.groupBy("page_id").agg(F.min("pos").alias("a"), F.max("pos").alias("b")).select("page_id", F.explode(F.sequence("a", "b")).alias("pos"))
    return span.join(o, ["page_id", "pos"], "left").select("page_id", F.lit("x").alias("axis"), F.lit(0).alias("column_index"), "pos", F.coalesce("ink", F.lit(0)).alias("ink"))


_PROFILE = """
    WITH c AS (SELECT o_orderstatus AS page_id, CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS pos, count(*) AS ink FROM orders GROUP BY ALL),
    s AS (SELECT page_id, unnest(range(min(pos), max(pos) + 1)) AS pos FROM c GROUP BY page_id),
    p AS (SELECT page_id, pos, coalesce(ink, 0) AS ink FROM s LEFT JOIN c USING (page_id, pos))"""
_ISLANDS = ", i AS (SELECT page_id, pos, pos - row_number() OVER (PARTITION BY page_id ORDER BY pos) AS g FROM p WHERE ink {test}), r AS (SELECT page_id, CAST(min(pos) AS INT) AS start, CAST(max(pos) + 1 AS INT) AS stop FROM i GROUP BY page_id, g HAVING count(*) >= {width})"
_LOW = _PROFILE + _ISLANDS.format(test="<= 1", width=2)
_MERGED = _LOW + """, n AS (SELECT *, CASE WHEN start - lag(stop) OVER (PARTITION BY page_id ORDER BY start) > 4 THEN 1 ELSE 0 END AS new FROM r),
    k AS (SELECT *, sum(new) OVER (PARTITION BY page_id ORDER BY start) AS g FROM n), m AS (SELECT page_id, min(start) AS start, max(stop) AS stop FROM k GROUP BY page_id, g)"""


def low_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.threshold_runs(order_profile(spark, sf_dir), F.col("ink") <= 1, 2)


@query(_LOW + " SELECT page_id, start, stop FROM r")
def runs_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    return low_runs(spark, sf_dir).select("page_id", "start", "stop")


@query(_PROFILE + _ISLANDS.format(test=">= 4", width=2) + " SELECT page_id, start, stop FROM r")
def runs_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.threshold_runs(order_profile(spark, sf_dir), F.col("ink") >= 4, 2).select("page_id", "start", "stop")


@query(_MERGED + " SELECT * FROM m")
def runs_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.merge_close_runs(low_runs(spark, sf_dir), 4).select("page_id", "start", "stop")


_COLUMNS = _MERGED + """, w AS (SELECT page_id, stop AS x, lead(start) OVER (PARTITION BY page_id ORDER BY start) - stop AS width FROM m), q AS (SELECT page_id, x, width FROM w WHERE width >= 6)"""


def gutter_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.columns_from_gutters(profile.merge_close_runs(low_runs(spark, sf_dir), 4), 6)


@query(_COLUMNS + " SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY x) - 1 AS INT) AS column_index, x, width FROM q")
def columns_from_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gutter_columns(spark, sf_dir)


_EDGE = """, {o} AS (SELECT page_id, x, width FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY x {d}) AS k, count(*) OVER (PARTITION BY page_id) AS n FROM {i}) a
    WHERE NOT (k = 1 AND n > 2 AND width < 0.5 * (SELECT list_sort(list(b.width))[(count(*) // 2 + 1)::INT] FROM {i} b WHERE b.page_id = a.page_id AND b.x <> a.x)))"""


@query(_COLUMNS + _EDGE.format(o="e1", i="q", d="DESC") + _EDGE.format(o="e2", i="e1", d="") + " SELECT page_id, x, width FROM e2")
def edge_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.drop_edge_columns(gutter_columns(spark, sf_dir)).select("page_id", "x", "width")


def ship_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_id"), F.datediff(F.to_date("l_shipdate"), F.lit(datetime.date(1995, 1, 1))).alias("pos"))


_POINTS = """WITH RECURSIVE d AS (SELECT l_orderkey AS page_id, CAST(l_shipdate AS DATE) - DATE '1995-01-01' AS pos FROM lineitem)"""


@query(_POINTS + """, k AS (SELECT page_id, min(pos) AS pos FROM d GROUP BY 1
      UNION ALL SELECT k.page_id, (SELECT min(d.pos) FROM d WHERE d.page_id = k.page_id AND d.pos > k.pos + 30) FROM k WHERE k.pos IS NOT NULL)
    SELECT page_id, CAST(pos AS DOUBLE) AS pos FROM k WHERE pos IS NOT NULL""")
def points_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.merge_nearby_points(ship_points(spark, sf_dir), 30)


@query("SELECT p_partkey, k, CAST(floor(p_size * 7 * k / (p_size % 5 + 2.0) + 0.5) AS INT) AS y FROM (SELECT *, unnest(range(1, p_size % 5 + 2))::INT AS k FROM part)")
def even_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(profile.even_cuts(s * 7, s % 5 + 2)).alias("k", "y")).select("p_partkey", (F.col("k") + 1).alias("k"), "y")


@query("""
    WITH RECURSIVE a AS (SELECT p_partkey, 3 AS rows, [0, p_size, 400] AS e FROM part WHERE p_size < 100),
    b AS (SELECT p_partkey, e, 1 AS n FROM a UNION ALL
          SELECT p_partkey, list_sort(list_append(e, CAST(floor((e[i] + e[i + 1]) / 2.0 + 0.5) AS INT))), n + 1
          FROM (SELECT *, list_position(list_transform(range(1, len(e)), lambda j: e[j + 1] - e[j]), list_max(list_transform(range(1, len(e)), lambda j: e[j + 1] - e[j]))) AS i FROM b WHERE n < 4))
    SELECT p_partkey, array_to_string(e[2:len(e) - 1], ',') AS cuts FROM b WHERE n = 4""")
def fill_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = profile.fill_missing_cuts(F.array("p_size"), F.lit(400), F.lit(5))
    return table(spark, sf_dir, "part").where("p_size < 100").select("p_partkey", F.array_join(cuts, ",").alias("cuts"))


@query("""
    WITH RECURSIVE c AS (SELECT l_orderkey AS page_id, list({'c': l_linenumber, 'p': CAST(CAST(l_shipdate AS DATE) - DATE '1995-01-01' AS DOUBLE)} ORDER BY l_linenumber, l_shipdate) AS pts FROM lineitem GROUP BY 1),
    s AS (SELECT page_id, pts, 1 AS i, CAST([] AS STRUCT(s DOUBLE, n BIGINT, cols BIGINT[])[]) AS cl FROM c
      UNION ALL
      SELECT page_id, pts, i + 1, CASE WHEN k IS NULL THEN list_append(cl, {'s': pts[i].p, 'n': CAST(1 AS BIGINT), 'cols': [CAST(pts[i].c AS BIGINT)]})
             ELSE list_transform(cl, lambda x, j: CASE WHEN j = k THEN {'s': x.s + pts[i].p, 'n': x.n + 1, 'cols': list_append(x.cols, CAST(pts[i].c AS BIGINT))} ELSE x END) END
      FROM (SELECT *, nullif(list_position(list_transform(cl, lambda x: abs(x.s / x.n - pts[i].p) <= 30), true), 0) AS k FROM s WHERE i <= len(pts)))
    SELECT page_id, x.s / x.n AS pos, CAST(len(list_distinct(x.cols)) AS INT) AS coverage, CAST(x.n AS INT) AS points FROM (SELECT page_id, unnest(cl) AS x FROM s WHERE i = len(pts) + 1)""")
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    points = li.select(F.col("l_orderkey").alias("page_id"), F.col("l_linenumber").alias("column_index"), F.datediff(F.to_date("l_shipdate"), F.lit(datetime.date(1995, 1, 1))).alias("pos"))
    return profile.cluster_by_position(points, 30)


@query("""
    SELECT page_id, pos FROM (SELECT l_orderkey AS page_id, CAST(l_partkey AS INT) AS pos, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey) AS r
           FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem) WHERE l_linenumber >= 3) WHERE r <= 2""")
def gap_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").distinct()
    c = li.select(F.col("l_orderkey").alias("page_id"), F.col("l_partkey").cast("double").alias("pos"), F.col("l_linenumber").alias("coverage"))
    return profile.top_gap_clusters(c, c.select("page_id", F.lit(4).alias("columns"), F.lit(3).alias("rows")).distinct())


@query("""
    WITH RECURSIVE t AS (SELECT page_id, pos FROM (SELECT l_orderkey AS page_id, CAST(l_partkey AS INT) AS pos, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey) AS r
           FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem) WHERE l_linenumber >= 3) WHERE r <= 3),
    k AS (SELECT page_id, min(pos) AS pos FROM t GROUP BY 1
      UNION ALL SELECT k.page_id, (SELECT min(t.pos) FROM t WHERE t.page_id = k.page_id AND t.pos > k.pos + 80) FROM k WHERE k.pos IS NOT NULL)
    SELECT page_id, CAST(pos AS DOUBLE) AS pos FROM k WHERE pos IS NOT NULL""")
def gap_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").distinct()
    c = li.select(F.col("l_orderkey").alias("page_id"), F.col("l_partkey").cast("double").alias("pos"), F.col("l_linenumber").alias("coverage"))
    return profile.whitespace_points(c, c.select("page_id", F.lit(4).alias("columns"), F.lit(4).alias("rows")).distinct())


_AT = "SELECT page_id, pos + 0.0 AS y FROM p WHERE pos % 30 = 0"


@query(_PROFILE + f""", h AS (SELECT page_id, max(pos) + 1 AS height FROM p GROUP BY 1), cl AS ({_AT}),
    w AS (SELECT cl.page_id, y, greatest(0, least(height, y + 3)) AS a0, greatest(0, least(height, y + 23)) AS a1, greatest(0, least(height, y - 20)) AS b0, greatest(0, least(height, y)) AS b1 FROM cl JOIN h USING (page_id)),
    d AS (SELECT page_id, y, coalesce((SELECT sum(ink) FROM p WHERE p.page_id = w.page_id AND p.pos >= a0 AND p.pos < a1), 0) / (4.0 * nullif(a1 - a0, 0)) AS after,
                 coalesce((SELECT sum(ink) FROM p WHERE p.page_id = w.page_id AND p.pos >= b0 AND p.pos < b1), 0) / (4.0 * nullif(b1 - b0, 0)) AS before FROM w)
    SELECT page_id, CAST(y AS DOUBLE) AS pos, round(coalesce(after, 0), 6) AS after, round(coalesce(before, 0), 6) AS before FROM d WHERE coalesce(after, 0) >= 0.4 AND coalesce(after, 0) - coalesce(before, 0) >= 0.05""")
def contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = order_profile(spark, sf_dir)
    # Positions before a page's first order have no ink.
    first = p.groupBy("page_id").agg(F.min("pos").alias("a")).select("page_id", F.lit("x").alias("axis"), F.lit(0).alias("column_index"), F.explode(F.when(F.col("a") > 0, F.sequence(F.lit(0), F.col("a") - 1)).otherwise(F.array().cast("array<int>"))).alias("pos"), F.lit(0).alias("ink"))
    c = p.where("pos % 30 = 0").select("page_id", F.col("pos").cast("double").alias("pos"), F.lit(1).alias("coverage"))
    columns = p.select("page_id", "column_index", F.lit(4).alias("width")).distinct()
    out = profile.contrast_filter(c, p.unionByName(first), columns, window=20, contrast=0.05)
    return out.select("page_id", "pos", F.round("after", 6).alias("after"), F.round("before", 6).alias("before"))


# Register


@query("""
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN date_trunc('month', o_orderdate)::DATE ELSE date_trunc('year', o_orderdate)::DATE END AS lo,
           CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN last_day(o_orderdate) ELSE make_date(year(o_orderdate), 12, 31) END AS hi, ['day', 'month', 'year'][o_orderkey % 3 + 1] AS precision
    FROM orders""")
def register_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    third, d = F.col("o_orderkey") % 3, F.to_date("o_orderdate")
    given = F.when(third == 0, F.date_format(d, "dd/MM/yyyy")).when(third == 1, F.date_format(d, "MM/yyyy")).otherwise(F.date_format(d, "yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_partial_date(given).alias("p")).select("o_orderkey", "p.*")


@query("""
    SELECT c_custkey, 0 AS pos, c_mktsegment || ' TV' AS name, CAST(1990 + c_nationkey AS INT) AS start_year, CAST(2000 + c_nationkey AS INT) AS end_year FROM customer
    UNION ALL SELECT c_custkey, 1, c_name, CAST(2000 + c_nationkey AS INT), NULL FROM customer""")
def register_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_nationkey")
    given = F.concat("c_mktsegment", F.lit(" TV ("), text(n + 1990), F.lit("-"), text(n + 2000), F.lit("), "), "c_name", F.lit(" ("), text(n + 2000), F.lit("-)"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.posexplode(parse_group_history(given)).alias("pos", "g")).select("c_custkey", "pos", "g.*")


@query("SELECT c_custkey, unnest([c_mktsegment, 'TNT', 'Câble']) AS way FROM customer")
def register_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.concat("c_mktsegment", F.lit(" , TNT,Câble ,"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.explode(split_distribution(given)).alias("way"))


@query("""
    WITH RECURSIVE r AS (SELECT c_custkey AS k, c_custkey AS root, 0 AS depth FROM customer WHERE c_custkey % 10 = 0
      UNION ALL SELECT r.k + 1, r.root, r.depth + 1 FROM r JOIN customer c ON c.c_custkey = r.k + 1 WHERE (r.k + 1) % 10 <> 0)
    SELECT 'C' || k AS name, 'C' || root AS root, CAST(depth AS INT) AS depth FROM r""")
def register_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in chains of ten renamings."""
    k = F.col("c_custkey")
    name = lambda c: F.concat(F.lit("C"), text(c))
    return register.rename_lineage(table(spark, sf_dir, "customer").select(name(k).alias("name"), F.when(k % 10 != 0, name(k - 1)).alias("predecessor")))


@query("""
    WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT 'O' || b.o_orderkey AS name, 'O' || a.o_orderkey AS predecessor, CAST(b.d - (a.d + 5) - 1 AS INT) AS gap_days FROM o a JOIN o b ON b.o_orderkey = a.o_orderkey + 1 WHERE b.d - (a.d + 5) - 1 <> 0""")
def register_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    name = lambda c: F.concat(F.lit("O"), text(c))
    return register.rename_continuity(table(spark, sf_dir, "orders").select(name(k).alias("name"), name(k - 1).alias("predecessor"), d.alias("created_on"), F.date_add(d, 5).alias("ended_on")))


@query("SELECT p_name AS name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def register_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register.duplicate_names(table(spark, sf_dir, "part").select(F.col("p_name").alias("name")))


@query("""
    SELECT c_name AS name, 'country' AS field, 'NATION' || c_nationkey AS value FROM customer WHERE c_nationkey % 3 = 0
    UNION ALL SELECT c_name, 'category', c_mktsegment FROM customer UNION ALL SELECT c_name, 'created', '1/2/' || (1990 + c_nationkey) FROM customer WHERE c_nationkey % 2 = 0""")
def register_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_nationkey")
    country = F.when(n % 3 == 0, F.concat(F.lit("NATION"), text(n))).otherwise("Suisse")
    created = F.when(n % 2 == 0, F.concat(F.lit("1/2/"), text(n + 1990))).otherwise(F.concat(F.lit("02/"), text(n + 1990)))
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), country.alias("country"), F.lit("Oui").alias("free"), F.col("c_mktsegment").alias("category"), created.alias("created"), F.lit("").alias("ended"))
    return register.validate_register(c)


@query("SELECT p_partkey, p_name || CASE p_partkey % 6 WHEN 3 THEN ' Bleu' ELSE '' END AS name FROM part WHERE p_partkey % 6 IN (3, 5)")
def register_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 6
    more = F.when(k == 0, " HD").when(k == 1, " +1").when(k == 2, " Live 1").when(k == 3, " Bleu").when(k == 4, " Mosaïque").otherwise("")
    return register.exclude_technical_channels(table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", more).alias("name")))


# Files


@query("SELECT page_id, octet_length(encode(html)) AS length, octet_length(encode(html)) < 3000 AS suspect FROM pages")
def size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", F.octet_length("html").cast("long").alias("length"))
    return files.archive_size_gate(p, 3000)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(o_custkey AS INT) AS page_number FROM orders WHERE o_orderkey % 5 <> 0 AND CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'")
def filename_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("o_orderkey") % 5 == 0, ".txt").otherwise(".JPG")
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-Page"), text("o_custkey"), end)
    o = table(spark, sf_dir, "orders").select("o_orderkey", files.scan_name(name).alias("s")).where("s is not null").select("o_orderkey", "s.*")
    return files.filter_date_range(o, "date", None, "1997-06-30", 1997)
