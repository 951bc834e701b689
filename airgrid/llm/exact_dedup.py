"""Exact deduplication by skew-safe combining, with DataFrame operations only.

1. Local: rows of a partition with equal digest and equal normalised text become one row (the partial aggregation
   before the first shuffle), with a count and the best row so far.
2. Salted: those rows meet by digest, text and salt, so that the copies of one text spread over SALTS tasks.
3. Global: the winners of the salts, SALTS for a text at most, meet by digest and text.

All three group by the text as well as by its digest, so two texts of one digest stay apart. Documents then get
their class by digest, and where one digest has several texts by digest and text. That join has one row for each class on one
side; a class of very many copies is a hot key of the other, which Spark's own skew split deals to several tasks.

Edge cases: null counts as the empty text; of equal texts the row with the most code points before normalising
stays, then the smallest id of all 64-bit ones (null ids last); of rows that repeat that id with an equally long equal text one is
`kept`; an empty table gives an empty result; other columns, whatever their names, don't matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.llm.common import WS_CHARS, cut

SALTS = 16


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WS_CHARS, "")


def rank_of(n: Column, key: Column) -> Column:
    """Grows with length, then with smaller keys, null keys last."""
    return F.struct(n.alias("n"), key.isNotNull().alias("has"), F.bitwise_not(key).alias("minus"))


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", digest_of: Callable[[Column], Column] = sha256) -> DataFrame:
    """(digest, norm, texts, keep_id, keep_n, group_size) of each distinct normalised text; norm is null where its digest has but one text."""
    rows = docs.select(F.col(key).cast("long").alias("k"), normalised(F.col(text)).alias("norm"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n"))
    rows = rows.select(digest_of(F.col("norm")).alias("digest"), "norm", F.pmod(F.xxhash64("k", "n"), F.lit(SALTS)).alias("salt"), rank_of(F.col("n"), F.col("k")).alias("r"))
    salted = rows.groupBy("digest", "norm", "salt").agg(F.max("r").alias("r"), F.count(F.lit(1)).alias("c"))
    # Dealt by digest alone, which serves both the grouping by digest and text and the count of texts of a digest.
    merged = salted.repartition("digest").groupBy("digest", "norm").agg(F.max("r").alias("r"), F.sum("c").alias("group_size"))
    texts = F.count(F.lit(1)).over(Window.partitionBy("digest"))
    return merged.withColumn("texts", texts).select("digest", F.when(F.col("texts") > 1, F.col("norm")).alias("norm"), "texts", F.bitwise_not("r.minus").alias("keep_id"), F.col("r.n").alias("keep_n"), "group_size")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", columns: tuple[str, ...] = ("doc_id",), digest_of: Callable[[Column], Column] = sha256) -> DataFrame:
    """columns of each row of docs, with keep_id, group_size, kept and text_sha256; no row is dropped."""
    found = cut(classes(docs, key, text, digest_of))
    own = [F.col(c).alias(f"own_{i}") for i, c in enumerate(columns)]
    rows = docs.select(*own, F.col(key).cast("long").alias("k"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n"), normalised(F.col(text)).alias("own_norm"))
    rows = rows.withColumn("digest", digest_of(F.col("own_norm")))
    best = F.col("k").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))
    out = rows.drop("own_norm").join(found.where("texts = 1").drop("norm"), "digest").withColumn("kept", best).withColumn("norm", F.lit(None).cast("string"))
    if not found.where("texts > 1").isEmpty():  # a digest of several texts: those rows are matched by their text too
        several = rows.join(found.where("texts > 1"), (rows["digest"] == found["digest"]) & (rows["own_norm"] == found["norm"])).drop(found["digest"]).drop("own_norm")
        out = out.unionByName(several.withColumn("kept", best))
    repeated = cut(docs.groupBy(F.col(key).cast("long").alias("k")).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("k"))
    if not repeated.isEmpty():  # one row stays of those that are best in everything
        tie = repeated.withColumnRenamed("k", "again")
        same = F.col("k").eqNullSafe(F.col("again"))
        out = out.join(tie, same & F.col("kept"), "left_anti").unionByName(one_kept(out.where("kept").join(tie, same, "left_semi")))
    return out.select(*(F.col(f"own_{i}").alias(c) for i, c in enumerate(columns)), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def one_kept(rows: DataFrame) -> DataFrame:
    """rows with `kept` left true for one row of each id and text.

    Rows that are equal in every column become one with a count, before they meet, so a row that is there very often is no hot group.
    """
    columns = [c for c in rows.columns if c != "kept"]
    variants = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("times"))
    first = F.row_number().over(Window.partitionBy("digest", "norm", "k").orderBy(*(F.col(c) for c in columns if c.startswith("own_")))) == 1
    each = variants.withColumn("first", first).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return each.select(*columns, (F.col("first") & (F.col("i") == 1)).alias("kept"))
