"""Queries opN_<name> over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airgrid.llm import (
    conversation_repair,
    exact_dedup,
    html_extraction,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    quality_rules,
    toxicity,
    warc,
)
from airgrid.llm.common import held_out, table, words_of


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = language_id.learn(docs.where(~F.coalesce(held_out("doc_id"), F.lit(False))).select("doc_id", "text", "lang"))
    return language_id.predict(docs.select("doc_id", "text", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out")), dictionaries, keep=("doc_id", "held_out"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: a document is a file named by its id, in the directory of its language in that of its source.

    A null source or language is a directory of its own, beside those of all names; a file without an id has no path,
    so it neither inherits a licence nor gives one.
    """
    docs = table(spark, sf_dir, "documents")
    part = lambda c: F.coalesce(F.col(c), F.lit("\0"))
    return license_scan.scan(docs.withColumn("path", F.concat(part("source"), F.lit("/"), part("lang"), F.lit("/"), F.col("doc_id").cast("string"))))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(held_out("doc_id"), F.lit(False))
    model = toxicity.learn(docs.where(~out).select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs.select("doc_id", "text", out.alias("held_out")), model, keep=("doc_id", "held_out"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are damaged by a checksum of conversation and turn: dropped, emptied, left without their stops, repeated, or given to the user."""
    rows = table(spark, sf_dir, "conversations")
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    damage = F.crc32(F.concat_ws(":", known("conv_id"), known("turn"))) % 20
    text = F.when(damage == 1, F.lit("")).when(damage == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    copies = F.explode(F.array_repeat(F.lit(True), F.when(damage == 3, 2).otherwise(1)))
    rows = rows.select("conv_id", "turn", F.when(damage == 4, F.lit("user")).otherwise(known("role")).alias("role"), text.alias("text"), (damage != 0).alias("present"), copies.alias("copy"))
    return conversation_repair.repair(rows, present=F.col("present"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a tenth of the texts, from some word on, are made to come round with one period."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h")).withColumn("g", F.floor(F.col("h") / 10))

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (F.col("g") % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
        return F.array_join(F.transform(words, lambda w, i: F.when(i >= a, F.get(words, a + (i - a) % p)).otherwise(w)), " ")

    words = words_of(F.col("text"))
    damaged = F.when((F.col("h") % 10 == 0) & (F.size(words) > 0), quality_rules.let(words, repeated)).otherwise(F.col("text"))
    found = periodic_runs.detect(docs.select("doc_id", damaged.alias("text")))
    # The longest run, of such the first by start, then by period.
    top = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    lines = F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.floor(-1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)""",
    "op4_quality_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
        c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) > 1 AS twice FROM g),
        r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM c WHERE twice) GROUP BY doc_id),
        l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        s AS (SELECT d.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                     CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                     CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
              FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > n_words OR (n_dup_lines > 2 AND 100 * n_dup_lines > 30 * (1 + length(t) - length(replace(t, chr(10), ''))))
                    OR word_chars < 2 * n_words OR word_chars > 16 * n_words
                    OR 10 * (length(t) - length(regexp_replace(t, '[!?]', '', 'g'))) > n_words
                    OR 2 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > word_chars
                    OR 4 * (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) > word_chars
                    OR 2 * (length(t) - length(regexp_replace(t, '\p{L}', '', 'g'))) < word_chars) AS kept
        FROM b""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_join": op7_ngram_join,
    "op8_html_extraction": op8_html_extraction,
    "op9_mixing": op9_mixing,
    "op10_warc": op10_warc,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_dedup": op13_line_dedup,
}
SQL["op10_warc"] = r"""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages),
    h AS (SELECT *, sha1(b) AS hex FROM p),
    bits AS (SELECT page_id, string_agg(lpad(to_binary(CAST(strpos('0123456789abcdef', hex[i]) - 1 AS BIGINT)), 4, '0'), '' ORDER BY i) AS s
             FROM (SELECT page_id, hex, unnest(range(1, 41)) AS i FROM h) GROUP BY page_id),
    d AS (SELECT page_id, string_agg('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
                 1 + 16 * CAST(s[5 * k + 1] AS INT) + 8 * CAST(s[5 * k + 2] AS INT) + 4 * CAST(s[5 * k + 3] AS INT) + 2 * CAST(s[5 * k + 4] AS INT) + CAST(s[5 * k + 5] AS INT)], '' ORDER BY k) AS digest
          FROM (SELECT page_id, s, unnest(range(0, 32)) AS k FROM bits) GROUP BY page_id)
    SELECT h.page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN h.page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN h.page_id = last THEN NULL ELSE last END AS refers_to
    FROM h JOIN d USING (page_id)"""
#: Exact on any table, by all pairs of texts that share an n-gram: for small tables only.
SQL["op7_ngram_join"] = r"""
    WITH RECURSIVE t AS (SELECT doc_id, w, array_to_string(w, ' ') AS k FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents) WHERE len(w) > 0),
    c AS (SELECT k, min(doc_id) AS node, count(DISTINCT doc_id) AS n_copies, any_value(w) AS w FROM t GROUP BY k),
    g AS (SELECT DISTINCT node, array_to_string(w[i:least(i + 4, len(w))], ' ') AS s FROM (SELECT node, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM c)),
    z AS (SELECT node, count(*) AS m FROM g GROUP BY node),
    p AS (SELECT a.node AS x, b.node AS y, count(*) AS both_have FROM g a JOIN g b ON a.s = b.s AND a.node <> b.node GROUP BY ALL),
    l AS (SELECT x, y FROM p JOIN z zx ON zx.node = x JOIN z zy ON zy.node = y WHERE 9 * both_have >= 4 * (zx.m + zy.m)),
    r AS (SELECT node, node AS root FROM c UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.node),
    o AS (SELECT node, min(root) AS class_id FROM r GROUP BY node),
    n AS (SELECT x AS node, count(*) AS n_links FROM l GROUP BY x)
    SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(n_links, 0) AS n_links, coalesce(n_copies, 1) AS n_copies
    FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN c ON c.k = t.k LEFT JOIN o ON o.node = c.node LEFT JOIN n ON n.node = c.node"""
SQL["op13_line_dedup"] = r"""
    WITH l AS (SELECT doc_id, i, x[i] AS line, translate(trim(x[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
               FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
    c AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last <> doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last IS NULL OR last = doc_id), '')) AS kept_sha256
    FROM l LEFT JOIN c USING (k) GROUP BY doc_id"""
