"""Line deduplication over all documents, with DataFrame operations only.

1. Every line of every text is exploded with its position; lines whose key is long enough become a 128-bit hash of it.
2. Distinct documents are counted for each hash: first one row for each hash and document, combined on the map side,
   then one for each hash, so that a line of a third of all documents is nobody's hot group.
3. Lines of hashes over the threshold, but for those in the largest document that holds them, become the positions that
   their row loses. The table of such hashes is broadcast within a checked size; beyond it the lines meet it by hash and
   salt, so that a hot line spreads over SALTS tasks.
4. A row is put together again from its lines by position, without those at lost positions.

Texts travel once, in the last step; rows are told apart by a 128-bit hash of id and text, so rows that repeat an id with
another text lose their own lines only. A row that is there very often is a hot key of that last join alone, which
Spark's own skew split deals to several tasks.

Edge cases: a null or empty text is one empty line; rows that repeat an id are one document; rows with a null id
are together one document, smaller than all others; a text that loses all its lines is empty; an empty table gives an
empty result; columns other than the id and the text are given back if asked for, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airgrid.llm.common import WS_CHARS, cut

MIN_CHARS, MIN_DOCUMENTS = 20, 3
#: Hashes up to which they are broadcast; tasks that a line spreads over beyond that.
MAX_BROADCAST, SALTS = 500_000, 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: Column) -> Column:
    """text with A-Z, and nothing else, in lower case."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash_of(*columns: Column) -> list[Column]:
    """Two 64-bit hashes of the columns."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def lines_of(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(row hashes r1 and r2, doc, pos, line hashes h1 and h2) of each line whose key is long enough."""
    t = F.coalesce(F.col(text), F.lit(""))
    r1, r2 = hash_of(F.col(key), t)
    rows = docs.where(F.length(t) >= min_chars).select(r1.alias("r1"), r2.alias("r2"), F.col(key).alias("doc"), folded(t).alias("t"))
    lines = rows.select("r1", "r2", "doc", F.posexplode(F.split("t", "\n")).alias("pos", "line")).withColumn("line", F.btrim("line", F.lit(WS_CHARS)))
    h1, h2 = hash_of(F.col("line"))
    return lines.where(F.length("line") >= min_chars).select("r1", "r2", "doc", "pos", h1.alias("h1"), h2.alias("h2"))


def common_lines(lines: DataFrame, min_documents: int) -> DataFrame:
    """(h1, h2, last) of each line in min_documents documents at least; last is the largest id among them."""
    each = lines.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
    n = F.count(F.lit(1)).alias("n")
    return each.groupBy("h1", "h2").agg(n, F.max("doc").alias("last")).where(F.col("n") >= min_documents).drop("n")


def lost_lines(lines: DataFrame, common: DataFrame, max_broadcast: int) -> DataFrame:
    """(r1, r2, lost) of each row that loses lines; lost holds their positions in order."""
    if common.count() <= max_broadcast:
        met = lines.join(F.broadcast(common), ["h1", "h2"])
    else:
        salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = lines.withColumn("salt", F.pmod(F.xxhash64("r1", "pos"), F.lit(SALTS)).cast("int")).join(salted, ["h1", "h2", "salt"])
    lost = met.where(~F.col("doc").eqNullSafe(F.col("last"))).select("r1", "r2", "pos")
    return lost.groupBy("r1", "r2").agg(F.sort_array(F.collect_set("pos")).alias("lost"))  # no more than the row's own lines


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without(lines: Column, lost: Column) -> Column:
    """lines but for those at the positions lost: a mark for each lost position is sorted in front of its line."""
    element = lambda pos, line, text: F.struct(pos.alias("pos"), line.alias("line"), text.alias("text"))
    marks = F.transform(lost, lambda p: element(p, F.lit(0), F.lit("")))
    placed = F.sort_array(F.concat(F.transform(lines, lambda x, i: element(i, F.lit(1), x)), marks))
    stays = lambda at: F.filter(at, lambda x, j: (x["line"] == 1) & F.coalesce(F.get(at, j - 1)["line"] == 1, F.lit(True)))
    return F.transform(let(placed, stays), lambda x: x["text"])


def drop_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    columns: tuple[str, ...] = ("doc_id",),
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """columns of each row of docs, with n_lines, n_dropped and kept_text; no row is dropped."""
    lines = lines_of(docs, key, text, min_chars)
    lost = lost_lines(lines, cut(common_lines(lines, min_documents)), max_broadcast)
    t = F.coalesce(F.col(text), F.lit(""))
    r1, r2 = hash_of(F.col(key), t)
    rows = docs.select(*(F.col(c).alias(f"own_{i}") for i, c in enumerate(columns)), t.alias("t"), r1.alias("r1"), r2.alias("r2"))
    rows = rows.join(lost, ["r1", "r2"], "left")
    split = F.split("t", "\n")
    kept = F.when(F.col("lost").isNull(), F.col("t")).otherwise(F.array_join(without(split, F.col("lost")), "\n"))
    return rows.select(
        *(F.col(f"own_{i}").alias(c) for i, c in enumerate(columns)),
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )
