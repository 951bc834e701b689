"""From recognised blocks of a magazine page to programmes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airgrid.functions.names import slugify
from airgrid.functions.text import GENRE, LEADING_TIME, WS, clean_fragment, clean_ocr_text, cut_garbled_tail, find_genre, move_episode_number, normalize_ocr_text, split_entries
from airgrid.operators.stages import staged

BLOCK = ("page_date", "page_number", "block_pos")
#: Fixed value: words too common to mark a place.
COMMON_WORDS = (
    "le la les un une des de du et à a en ce cet cette ces il elle ils elles on se sa son ses ne pas que qui quoi dans pour sur avec sans ou au aux nous "
    "vous est sont y par plus ainsi us gb rf"
).split()


def low_confidence_runs(words: DataFrame, threshold: float = 40, min_run: int = 2, block: tuple[str, ...] = BLOCK) -> DataFrame:
    """words of runs of at least min_run neighbours with 0 <= confidence < threshold, with `run`; bars don't count.

    Both row numbers are over one window partition, so there is one shuffle and one sort.
    """
    w = Window.partitionBy(*block).orderBy("seq")
    low = (F.col("confidence") >= 0) & (F.col("confidence") < threshold)
    df = words.where(F.col("text") != "|").withColumn("low", low)
    df = df.withColumn("run", F.sum(F.when(F.col("low"), 0).otherwise(1)).over(w)).where("low")
    return df.withColumn("run_length", F.count(F.lit(1)).over(Window.partitionBy(*block, "run"))).where(F.col("run_length") >= min_run).drop("low")


def garbled_anchors(words: DataFrame, threshold: float = 40, min_run: int = 2, block: tuple[str, ...] = BLOCK) -> DataFrame:
    """block and garbled_anchors array<string>, in the order of the runs; blocks without one are left out."""
    t = F.col("text")
    noise = t.rlike("[0-9%{}=]") | t.rlike(r"^[A-ZÀ-Ü]{2}\z")
    useful = ~F.lower(t).isin(COMMON_WORDS) & ((F.length(t) >= 3) | noise)
    first = low_confidence_runs(words, threshold, min_run, block).where(useful).groupBy(*block, "run").agg(F.min_by("text", "seq").alias("anchor"), F.min("seq").alias("at"))
    return first.groupBy(*block).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "anchor"))), lambda x: x["anchor"]).alias("garbled_anchors"))


def parse_entries(df: DataFrame, entry: str, anchors: Column | None = None) -> DataFrame:
    """df with start_time, title, subtitle, genre and unparsed_tail of each entry."""
    kept = df.columns
    e, none = F.col(entry), F.array().cast("array<string>")
    hour = F.regexp_extract(e, LEADING_TIME, 1)
    rest = F.when(hour != "", F.regexp_replace(e, LEADING_TIME + WS + "*", "")).otherwise(e)
    df = staged(df, __hour=hour, __minute=F.regexp_extract(e, LEADING_TIME, 2), __rest=rest)
    df = staged(df, __cut=cut_garbled_tail(F.col("__rest"), none if anchors is None else F.coalesce(anchors, none)))
    timed, text = F.col("__hour") != "", F.col("__cut.clean")
    df = staged(df, __genre=F.when(timed, find_genre(text)))
    marked = F.col("__genre").isNotNull()
    parts = F.when(marked, F.split(text, GENRE, 2)).when(timed & (F.instr(text, ".") > 0), F.split(text, r"\.", 2)).otherwise(F.array(text))
    df = staged(df, __parts=parts)
    df = staged(df, __title=clean_fragment(F.get("__parts", 0)), __subtitle=clean_fragment(F.coalesce(F.get("__parts", 1), F.lit(""))))
    df = staged(df, __moved=move_episode_number(F.col("__title"), F.col("__subtitle")))
    genre = F.coalesce("__genre.genre", F.lit(""))
    return df.select(
        *kept,
        F.when(timed, F.concat(F.lpad("__hour", 2, "0"), F.lit(":"), "__minute")).otherwise(F.lit("")).alias("start_time"),
        F.col("__moved.title").alias("title"),
        F.when(genre == "Film", F.lit("")).otherwise(F.col("__moved.subtitle")).alias("subtitle"),
        genre.alias("genre"),
        F.col("__cut.tail").alias("unparsed_tail"),
    )


def programmes_of_blocks(blocks: DataFrame, anchors: DataFrame | None = None, block: tuple[str, ...] = BLOCK) -> DataFrame:
    """One row for each programme: block, channel, entry_pos and the parts of the entry."""
    if anchors is not None:
        blocks = blocks.join(anchors, list(block), "left")
    found = F.col("garbled_anchors") if "garbled_anchors" in blocks.columns else F.lit(None).cast("array<string>")
    entries = F.filter(split_entries(normalize_ocr_text(clean_ocr_text(F.col("text")))), lambda x: x != "")
    df = blocks.select(*block, "channel", found.alias("anchors"), F.posexplode(entries).alias("entry_pos", "raw_text"))
    return parse_entries(df, "raw_text", F.col("anchors")).drop("anchors")


def resolve_slug(df: DataFrame, mapping: DataFrame, name: str = "channel") -> DataFrame:
    """df with slug, from mapping (name, slug) or else computed, and slug_missing. The mapping has one row for each channel."""
    m = mapping.select(F.col("name").alias("__name"), F.col("slug").alias("__slug")).dropDuplicates(["__name"])
    out = df.join(m, F.col(name) == F.col("__name"), "left")
    return out.select(df["*"], F.coalesce("__slug", slugify(F.col(name))).alias("slug"), F.col("__slug").isNull().alias("slug_missing"))


def last_page_wins(programmes: DataFrame, key: tuple[str, ...] = ("page_date", "slug"), file_name: str = "file_name") -> DataFrame:
    """Rows of the last file of each key, in the order of file names as text. Rows of channels without entries count too."""
    last = programmes.groupBy(*key).agg(F.max(file_name).alias("__last"))
    return programmes.join(last, list(key)).where(F.col(file_name) == F.col("__last")).drop("__last")


def page_statistics(blocks: DataFrame, programmes: DataFrame, page: tuple[str, ...] = ("page_date", "page_number")) -> DataFrame:
    """Per page: active blocks, channels, characters, mean confidence, programmes; pages without programmes stay."""
    b = blocks.groupBy(*page).agg(
        F.count_if(F.col("type") != "ignored").alias("active_blocks"),
        F.count_if(F.col("type") == "channel").alias("channels"),
        F.sum(F.length(F.coalesce("text", F.lit("")))).alias("characters"),
        F.avg("confidence").alias("mean_confidence"),
    )
    p = programmes.groupBy(*page).agg(F.count(F.lit(1)).alias("programmes"))
    return b.join(p, list(page), "left").withColumn("programmes", F.coalesce("programmes", F.lit(0)))


def channel_statistics(blocks: DataFrame, programmes: DataFrame, channel: tuple[str, ...] = ("page_date", "page_number", "channel")) -> DataFrame:
    """Per channel of a page: characters, mean confidence, programmes; channels without programmes stay, ignored blocks don't."""
    own = blocks.where("type = 'channel'").groupBy(*channel).agg(
        F.sum(F.length(F.coalesce("text", F.lit("")))).alias("characters"),
        F.avg("confidence").alias("mean_confidence"),
    )
    p = programmes.groupBy(*channel).agg(F.count(F.lit(1)).alias("programmes"))
    return own.join(p, list(channel), "left").withColumn("programmes", F.coalesce("programmes", F.lit(0)))


def batch_failures(results: DataFrame) -> DataFrame:
    """(input_key, reason) of what failed of results(input_key, reason), in the order of the keys."""
    return results.where("reason is not null").select("input_key", "reason").orderBy("input_key")


def batch_summary(results: DataFrame) -> DataFrame:
    """results(input_key, reason): how many succeeded and failed."""
    return results.groupBy(F.when(F.col("reason").isNull(), "succeeded").otherwise("failed").alias("status")).agg(F.count(F.lit(1)).alias("n"))


def collect_rejects(stage: str, good: DataFrame, every: DataFrame, key: str, reason: str) -> DataFrame:
    """(stage, input_key, reason) of the inputs in `every` that `good` doesn't have."""
    missing = every.select(key).distinct().join(good.select(key).distinct(), key, "left_anti")
    return missing.select(F.lit(stage).alias("stage"), F.col(key).cast("string").alias("input_key"), F.lit(reason).alias("reason"))
