"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airgrid.shipping import ship
from airgrid.storage import cut, dealt, drop_dir, shared_dir  # noqa: F401

#: Fixed value: the white space of all contracts, as the characters of [\x20\x09-\x0D].
WS_CHARS = " \t\n\x0b\f\r"
WS_CLASS = r"[\x20\x09-\x0D]"
#: Values of a sample's key up to which their counts are broadcast.
MAX_KEYS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return dealt(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def held_out(doc_id: Column | str) -> Column:
    """True for the quarter of documents that no training step may see."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4 == 2


def words_of(text: Column) -> Column:
    """array of the maximal runs of characters other than WS_CLASS; empty for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_CLASS + "+"))


def bounded_sample(df: DataFrame, key: str, per_key: int, seed: int, order_by: str = "doc_id", columns: tuple[str, ...] = ()) -> DataFrame:
    """(key, order_by, columns) of the per_key ids order_by with the smallest hashes of each value of key, one row for each id.

    Ids are counted first, so that a threshold of the hash leaves about twice per_key of them before any are shuffled:
    what a task gets grows neither with the table nor with the number of tasks. Rows that repeat an id meet in the
    partial aggregation and are one row, the smallest by columns.
    """
    h = F.xxhash64(F.lit(seed), F.col(order_by))
    n = cut(df.groupBy(F.col(key).alias("__key")).agg(F.approx_count_distinct(order_by).alias("__ids")))
    n = F.broadcast(n) if n.count() <= MAX_KEYS else n
    near = df.select(key, order_by, *columns).join(n, F.col(key).eqNullSafe(F.col("__key")))
    near = near.where(h / 2.0**64 + 0.5 <= (2.0 * per_key + 100) / F.greatest(F.col("__ids"), F.lit(1)))
    one = near.groupBy(key, order_by).agg(F.min(F.struct(*columns) if columns else F.lit(0)).alias("__row"))
    ranked = one.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(h, order_by))).where(F.col("__rank") <= per_key)
    return ranked.select(key, order_by, *(F.col(f"__row.{c}").alias(c) for c in columns))
