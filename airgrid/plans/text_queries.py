"""Queries on recognised text: entries, genres, episode numbers, garbled tails, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airgrid.functions.names import fold_accents, parse_month_filename, safe_filename, slugify
from airgrid.functions.text import WEEKDAYS, clean_ocr_text, collapse_ws, cut_garbled_tail, find_genre, match_weekday, move_episode_number, normalize_ocr_text
from airgrid.operators import entries
from airgrid.plans.registry import query, table


def event_blocks(events: DataFrame) -> DataFrame:
    """One block of text for each user and day: an entry for each event, at its time of day."""
    line = F.concat(F.date_format("ts", "H.mm"), F.lit(" Titre "), "event_type", F.lit(". suite "), F.col("event_id").cast("string"), F.lit(" fin\n"))
    day = F.to_date("ts")
    own = events.select(day.alias("page_date"), F.col("user_id").cast("int").alias("page_number"), F.struct("ts", "event_id", line.alias("line")).alias("e"))
    text = F.concat(F.lit("te | bruit ; "), F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda x: x["line"]), ""))
    return own.groupBy("page_date", "page_number").agg(text.alias("text")).select("page_date", "page_number", F.lit(0).alias("block_pos"), F.lit("Canal+ Bleu").alias("channel"), "text")


@query("""
    SELECT CAST(ts AS DATE) AS page_date, CAST(user_id AS INT) AS page_number,
           CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts, event_id) - 1 AS INT) AS entry_pos,
           strftime(ts, '%H:%M') AS start_time, 'Titre ' || event_type AS title,
           -- Whole numbers of 6 to 9 digits are recorder codes, which cleaning takes out.
           regexp_replace(regexp_replace('suite ' || event_id || ' fin', '\\b[0-9]{6,9}\\b', ''), ' {2,}', ' ') AS subtitle, '' AS genre, 'canal-bleu' AS slug
    FROM events""")
def entries_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    programmes = entries.programmes_of_blocks(event_blocks(table(spark, sf_dir, "events")))
    mapping = spark.createDataFrame([("Canal+ Bleu", "canal-bleu")], "name string, slug string")
    out = entries.resolve_slug(programmes, mapping)
    return out.select("page_date", "page_number", "entry_pos", "start_time", "title", "subtitle", "genre", "slug")


_KEYWORD = "CASE event_type WHEN 'view' THEN 'Film policier' WHEN 'click' THEN 'MAGAZINE' WHEN 'error' THEN 'Série' WHEN 'signup' THEN 'Documentaire' ELSE '' END"


@query(f"""
    SELECT event_id, 'Titre ' || event_id AS title, CASE WHEN {_KEYWORD} IN ('Film policier') THEN '' WHEN {_KEYWORD} = '' THEN '' ELSE 'de l''an ' || event_id END AS subtitle,
           CASE event_type WHEN 'view' THEN 'Film' WHEN 'click' THEN 'Magazine' WHEN 'error' THEN 'Série' ELSE '' END AS genre,
           strftime(ts, '%H:%M') AS start_time
    FROM events""")
def entries_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("k", F.expr(_KEYWORD))
    tail = F.when(F.col("k") == "", F.lit("")).otherwise(F.concat(F.lit(" # ## "), "k", F.lit(", de l'an "), F.col("event_id").cast("string")))
    entry = F.concat(F.date_format("ts", "H,mm"), F.lit(" Titre "), F.col("event_id").cast("string"), tail)
    return entries.parse_entries(e.select("event_id", entry.alias("entry")), "entry").select("event_id", "title", "subtitle", "genre", "start_time")


@query("""
    SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, 'Voyage ' || l_orderkey AS title,
           CASE WHEN l_returnflag = 'A' THEN 'La station ' || l_partkey || ' (' || l_linenumber || '/9)' ELSE 'Episode ' || l_linenumber || '/9' END AS subtitle
    FROM lineitem""")
def episode_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    title = F.concat(F.lit("Voyage "), F.col("l_orderkey").cast("string"), F.lit(" ("), F.col("l_linenumber").cast("string"), F.lit(" / 9) "))
    subtitle = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("La station "), F.col("l_partkey").cast("string"), F.lit(". "))).otherwise(F.lit(""))
    return li.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", move_episode_number(title, subtitle).alias("m")).select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "m.*")


@query("""
    WITH k AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'film' WHEN 'click' THEN 'Téléfilm' WHEN 'error' THEN 'comédie dramatique' WHEN 'signup' THEN 'filmé' ELSE 'SÉRIE' END AS k FROM events)
    SELECT event_id, CASE WHEN k IN ('film') THEN 'Film' WHEN k = 'Téléfilm' THEN 'Film' WHEN k LIKE 'com%' THEN 'Film' WHEN k = 'filmé' THEN 'Film' ELSE 'Série' END AS genre,
           CASE WHEN k = 'filmé' THEN 'film' ELSE k END AS keyword FROM k""")
def genre_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.when(F.col("event_type") == "view", "film").when(F.col("event_type") == "click", "Téléfilm").when(F.col("event_type") == "error", "comédie dramatique").when(F.col("event_type") == "signup", "filmé").otherwise("SÉRIE")
    g = find_genre(F.concat(F.lit("Un titre, filmographie "), k, F.lit(" (1999)")))
    return e.select("event_id", g.alias("g")).select("event_id", "g.genre", "g.keyword")


def event_words(events: DataFrame) -> DataFrame:
    text = F.concat("event_type", F.col("event_id").cast("string"))
    seq = F.row_number().over(_by_day())
    return events.select(F.to_date("ts").alias("page_date"), F.col("user_id").cast("int").alias("page_number"), F.lit(0).alias("block_pos"), seq.alias("seq"), text.alias("text"), F.col("value").alias("confidence"))


def _by_day():
    return Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")


_RUNS = """
    WITH w AS (SELECT CAST(ts AS DATE) AS page_date, CAST(user_id AS INT) AS page_number, event_type || event_id AS text, value,
                      row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS seq FROM events),
    r AS (SELECT *, seq - row_number() OVER (PARTITION BY page_date, page_number ORDER BY seq) AS island FROM w WHERE value >= 0 AND value < 40),
    g AS (SELECT page_date, page_number, island, count(*) AS run_length, min(seq) AS first_seq, arg_min(text, seq) AS anchor FROM r GROUP BY ALL HAVING count(*) >= 2)"""


@query(_RUNS + " SELECT page_date, page_number, first_seq, run_length FROM g")
def garbled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = entries.low_confidence_runs(event_words(table(spark, sf_dir, "events")))
    return runs.groupBy("page_date", "page_number", "run").agg(F.min("seq").cast("long").alias("first_seq"), F.count(F.lit(1)).alias("run_length")).drop("run")


@query(_RUNS + " SELECT page_date, page_number, string_agg(anchor, ' ' ORDER BY first_seq) AS anchors FROM g GROUP BY ALL")
def garbled_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = entries.garbled_anchors(event_words(table(spark, sf_dir, "events")))
    return a.select("page_date", "page_number", F.array_join("garbled_anchors", " ").alias("anchors"))


@query("SELECT event_id, 'Voyage ' || user_id || 'x' AS clean, event_type || '+' || event_id || ', reste' AS tail FROM events")
def garbled_tail_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    anchor = F.concat("event_type", F.lit("+"), F.col("event_id").cast("string"))
    text = F.concat(F.lit("Voyage "), F.col("user_id").cast("string"), F.lit("x "), anchor, F.lit(", reste"))
    anchors = F.array(F.lit("rest"), F.lit("(a+"), anchor)
    return e.select("event_id", cut_garbled_tail(text, anchors).alias("c")).select("event_id", "c.*")


def _noisy() -> Column:
    return F.concat(F.lit("12345 |"), "text", F.lit("  \n5455352 fan-\n tas ; 1234567890 500008524 a|b  "))


_NOISY = "'12345 |' || text || '  ' || chr(10) || '5455352 fan-' || chr(10) || ' tas ; 1234567890 500008524 a|b  '"
_LINES = r"regexp_replace(regexp_replace(regexp_replace({t}, '\b[0-9]{{6,9}}\b', '', 'g'), '[ \t]{{2,}}', ' ', 'g'), '[ \t]+(\n|$)', '\1', 'g')"


@query(f"SELECT doc_id, trim({_LINES.format(t=_NOISY)}, ' ' || chr(10)) AS cleaned FROM documents")
def clean_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", clean_ocr_text(_noisy()).alias("cleaned"))


@query(
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(translate(%s, '|;', ' :'),
        '([a-zA-ZàâäéèêëïîôöùûüçÀÂÄÉÈÊËÏÎÔÖÙÛÜÇ])-\s*\n\s*([a-zA-ZàâäéèêëïîôöùûüçÀÂÄÉÈÊËÏÎÔÖÙÛÜÇ])', '\1\2', 'g'), '\n+', ' ', 'g'), '[ \t]{2,}', ' ', 'g')) AS flat FROM documents"""
    % _NOISY
)
def normalize_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", normalize_ocr_text(_noisy()).alias("flat"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS one_line FROM documents")
def blanks_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", collapse_ws(F.col("text")).alias("one_line"))


_HEAD = r"regexp_extract(text, '^[^\n.]*')"


@query(f"SELECT doc_id, trim(regexp_replace(lower(strip_accents({_HEAD})), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents UNION ALL SELECT p_partkey, replace(p_name, ' ', '-') FROM part")
def slugify_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", slugify(F.regexp_extract("text", r"^[^\n.]*", 0)).alias("slug"))
    return d.unionByName(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), slugify(F.col("p_name")).alias("slug")))


@query("SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents")
def slugify_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", slugify(F.col("text")).alias("slug"))


@query("SELECT doc_id, trim(lower(strip_accents(text)), ' ' || chr(10)) AS folded FROM documents")
def accents_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", fold_accents(F.col("text")).alias("folded"))


@query(r"""SELECT page_id, regexp_replace(regexp_replace(url || ' ' || page_id, '\s+', '_', 'g'), '[\\/:*?"<>|]+', '_', 'g') AS file_name FROM pages""")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", safe_filename(F.concat("url", F.lit(" "), F.col("page_id").cast("string"))).alias("file_name"))


_FR = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre"]


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, strftime(o_orderdate, '%m') AS month FROM orders")
def month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("16_"), F.get(F.array(*[F.lit(m) for m in _FR]), F.month("o_orderdate") - 1), F.lit("_"), F.year("o_orderdate").cast("string"), F.lit(".HTM"))
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_month_filename(name).alias("m")).select("o_orderkey", "m.*")


_DAYS = "['samedi', 'dimanche', 'lundi', 'mardi', 'mercredi', 'jeudi', 'vendredi']"


@query(f"""SELECT event_id, CASE WHEN event_id % 11 = 10 THEN NULL ELSE {_DAYS}[1 + event_id % 7] END AS day FROM events""")
def weekday_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), (F.col("event_id") % 7).cast("int"))
    # A letter is misread in every third banner; every eleventh names no day.
    read = F.when(F.col("event_id") % 3 == 0, F.concat(F.substring(day, F.lit(1), F.length(day) - 1), F.lit("j"))).otherwise(F.upper(day))
    text = F.when(F.col("event_id") % 11 == 10, F.lit("zzzz 1999")).otherwise(F.concat(read, F.lit(" "), F.dayofmonth("ts").cast("string"), F.lit(" 01 99")))
    return table(spark, sf_dir, "events").select("event_id", match_weekday(text).alias("day"))
