"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Sources in code point order (null last) weigh 5, 2, 1, repeating. Their targets share the words of the corpus by
   weight, but none is above 3 times its source's size; what is above goes to the others by weight.
2. The mix is cut into blocks of equal numbers of words, BLOCK at most and fewer where the smallest source would have
   under FINE blocks. Blocks go to sources by the highest quotients target / (2 k + 1), then each source's blocks to
   its shards in the same way by their sizes. A source or shard whose bound of CAP times its size is no whole number
   of blocks may have one last block that is cut there.
3. In a shard, documents stand in the order of a seeded hash and their words form its blocks. A quota takes all
   words as often as it covers them, and of the next round the first ones, so one document of a shard is cut at most.

The driver sees a row for each source (MAX_SOURCES at most, else it is an error) and each shard, at most MAX_SHARDS
plus the number of sources, never one for each document.

Edge cases: a null or empty text has size 0, nothing is taken from it, it takes part in no sort, and it has no row in
the mix; a null source is a source of its own; ties of the hash go by id and by the text's hash; rows that repeat an
id are documents of their own, each taken for itself; an empty table gives an empty result. `mix` gives its own
columns only; `rows_taken` gives those of the input, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airgrid.llm.common import cut, words_of

WEIGHTS, CAP, BLOCK, FINE, SEED = (5, 2, 1), 3, 64, 8, 9
#: Words of a shard, unless that makes more than MAX_SHARDS shards.
SHARD_WORDS, MAX_SHARDS = 200_000, 50_000
MAX_SOURCES = 1_000_000
#: Rows, and characters of their names, of a table that is broadcast.
LOOKUP_ROWS, LOOKUP_CHARS = 200_000, 1 << 24


def targets(sizes: list[int], weights: list[int], cap: int = CAP) -> list[float]:
    """Shares of sum(sizes) by weight, none above cap times its size, the excess shared again by weight."""
    total, left_weight, taken = sum(sizes), sum(weights), 0
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (cap * sizes[i] / weights[i], i))
    for k, i in enumerate(order):
        if cap * sizes[i] * left_weight <= (total - taken) * weights[i]:
            out[i] = float(cap * sizes[i])
            taken += cap * sizes[i]
            left_weight -= weights[i]
        else:
            for j in order[k:]:
                out[j] = weights[j] * (total - taken) / left_weight
            break
    return out


def sainte_lague(seats: int, votes: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Seats of each party by the highest quotients votes / (2 k + 1), with at most `most` for each; ties go to the first."""
    votes, most = np.asarray(votes, dtype=np.float64), np.asarray(most, dtype=np.int64)
    got = np.zeros(len(votes), dtype=np.int64)
    seats = int(min(seats, most[votes > 0].sum())) if len(votes) else 0
    if seats <= 0:
        return got

    def above(q: float) -> np.ndarray:
        """How many quotients of each party are q or more."""
        return np.minimum(most, np.floor((votes / q + 1) / 2).astype(np.int64)) * (votes > 0)

    low, high = votes[votes > 0].min() / (2 * most.max() + 1) / 2, votes.max() * 2
    for _ in range(200):  # bisection for the quotient that ends the list
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if above(middle).sum() >= seats else (low, middle)
    got = above(high * (1 + 1e-9))  # what is surely above the end of the list; the last few seats, ties among them, go one by one
    while got.sum() < seats:
        quotient = np.where((got < most) & (votes > 0), votes / (2 * got + 1), -1)
        got[int(quotient.argmax())] += 1
    return got


def words_for(quota: np.ndarray, sizes: np.ndarray, block: int, total: int) -> np.ndarray:
    """Words of quotas in blocks, CAP times the size at most; they are total words together: the first ones give or take the difference."""
    words = np.minimum(quota * block, CAP * sizes)
    missing = total - int(words.sum())
    room = CAP * sizes - words if missing > 0 else words
    move = np.clip(abs(missing) - (np.cumsum(room) - room), 0, room)
    return words + np.sign(missing) * move


def identified(docs: DataFrame, key: str, text: str, source: str, *more: Column) -> DataFrame:
    """(q_id, q_source, q_size, q_hash, more) of each row; the hash tells apart rows that share an id."""
    return docs.select(F.col(key).alias("q_id"), F.col(source).alias("q_source"), F.size(words_of(F.col(text))).cast("long").alias("q_size"), F.xxhash64(F.lit(SEED), key, text).alias("q_hash"), *more)


def plan(sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (q_source, q_size, q_hash): the number of shards of each source, and the words that each (source, shard) gives.

    The first is (q_named, source_size, target, shards), the second (q_named, q_of, laps, extra): whole rounds and words of the next.
    """
    spark = sizes.sparkSession
    by_source = sizes.groupBy("q_source").agg(F.sum("q_size").alias("s")).limit(MAX_SOURCES + 1).collect()
    if len(by_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    by_source.sort(key=lambda r: (r["q_source"] is None, (r["q_source"] or "").encode()))
    names, totals = [r["q_source"] for r in by_source], [int(r["s"]) for r in by_source]
    target = targets(totals, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))])
    shard_words = max(SHARD_WORDS, -(-sum(totals) // MAX_SHARDS))
    schema = "q_named string, source_size long, target double, shards int"
    sources = lookup(spark, [(n, s, t, max(1, -(-s // shard_words))) for n, s, t in zip(names, totals, target, strict=True)], schema)
    shards = sharded(sizes, sources).groupBy("q_source", "q_shard").agg(F.sum("q_size").alias("s")).orderBy("q_source", "q_shard").collect()
    block = max(1, min([BLOCK, *(s // FINE for s in totals if s)]))
    every = np.array(totals, dtype=np.int64)
    quota = sainte_lague(round(sum(totals) / block), np.array(target), -(-CAP * every // block))
    full = np.array(target) >= CAP * every - 0.5  # these give all they may
    given = np.where(full, CAP * every, np.minimum(quota * block, CAP * every))
    own: dict = {}
    for r in shards:
        own.setdefault(r["q_source"], []).append((r["q_shard"], int(r["s"])))
    rows = []
    for name, words in zip(names, given.tolist(), strict=True):
        if not own.get(name):
            continue
        of = np.array([s for _, s in own[name]], dtype=np.int64)
        seats = sainte_lague(-(-words // block), of, -(-CAP * of // block))
        for (shard, s), w in zip(own[name], words_for(seats, of, block, words).tolist(), strict=True):
            laps, rest = divmod(w, s)
            rows.append((name, shard, laps, rest))
    return sources, lookup(spark, rows, "q_named string, q_of int, laps int, extra long")


def lookup(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of rows that begin with a name; broadcast if rows and names are few, so that documents don't meet by source, of which one may be hot."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= LOOKUP_ROWS and sum(len(r[0] or "") for r in rows) <= LOOKUP_CHARS else df


def sharded(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with words, with source_size, target and q_shard."""
    out = rows.where("q_size > 0").join(sources, F.col("q_source").eqNullSafe(F.col("q_named"))).drop("q_named")
    return out.withColumn("q_shard", F.pmod("q_hash", F.col("shards")).cast("int")).drop("shards")


def placed(rows: DataFrame, sources: DataFrame, quotas: DataFrame) -> DataFrame:
    """rows with words, with source_size, target, laps (whole copies) and part (words of one more)."""
    order = F.xxhash64(F.lit(SEED + 1), F.col("q_hash"))
    w = Window.partitionBy("q_source", "q_shard").orderBy(order, "q_id", "q_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    started = sharded(rows, sources).withColumn("q_start", F.sum("q_size").over(w) - F.col("q_size"))
    out = started.join(quotas, F.col("q_source").eqNullSafe(F.col("q_named")) & (F.col("q_shard") == F.col("q_of")))
    part = F.greatest(F.lit(0), F.least(F.col("q_size"), F.col("extra") - F.col("q_start")))
    return out.withColumn("part", part.cast("long"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, size, source_size, target, taken, laps, part) of each row: `laps` whole copies and `part` words of one more."""
    rows = cut(identified(docs, key, text, source))
    sources, quotas = plan(rows)
    out = placed(rows, sources, quotas)
    empty = rows.where("q_size = 0").join(sources, F.col("q_source").eqNullSafe(F.col("q_named")))
    out = out.unionByName(empty.withColumns({"laps": F.lit(0), "part": F.lit(0).cast("long")}), allowMissingColumns=True)
    taken = (F.col("laps") * F.col("q_size") + F.col("part")).cast("long")
    return out.select(F.col("q_id").alias(key), F.col("q_size").alias("size"), "source_size", "target", taken.alias("taken"), "laps", "part")


def rows_taken(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of docs as often as the mix takes them; a document that is cut has its first words, set apart by one space.

    Texts travel once, to their shard. A column n_chars is set to the length of the new text.
    """
    columns = docs.columns
    own = {c: f"q_own_{i}" for i, c in enumerate(columns)}
    sources, quotas = plan(cut(identified(docs, key, text, source)))
    out = placed(identified(docs, key, text, source, *(F.col(c).alias(o) for c, o in own.items())), sources, quotas)
    t = F.col(own[text])
    first = F.concat_ws(" ", F.slice(words_of(t), F.lit(1), F.col("part").cast("int")))
    copies = F.concat(F.array_repeat(F.lit(False), F.col("laps")), F.when(F.col("part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    out = out.withColumn("q_cut", F.explode(copies)).withColumn(own[text], F.when(F.col("q_cut") & (F.col("part") < F.col("q_size")), first).otherwise(t))
    if "n_chars" in columns:
        out = out.withColumn(own["n_chars"], F.length(own[text]).cast("long"))
    return out.select(*(F.col(o).alias(c) for c, o in own.items()))
