"""The register of channels: domains, exclusions, renamings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid.storage import cut

#: The register's domains.
COUNTRIES = ["France", "Belgique", "Suisse", "Luxembourg", "Monaco"]
FREE = ["Oui", "Non"]
CATEGORIES = (
    "Généraliste, Information, Sport, Cinéma, Séries, Jeunesse, Musique, Documentaire, Découverte, Nature, Histoire, Culture, Parlementaire, Religieuse, Art de vivre, Économie, Téléachat, Événementielle"
).split(", ")
DATE = r"^(\d{2}/\d{2}/\d{4}|\d{2}/\d{4}|\d{4})\z"
TECHNICAL = r"(?i)(\b(HD|UHD|3D)\z)|(\+ ?1\z)|(mosa[iï]que)|(\b(live|360|foot|sport) \d+\z)"
KEPT = ["Kiosque", "À la carte"]


def exclude_technical_channels(register: DataFrame) -> DataFrame:
    """Without definition variants, +1 variants, numbered feeds, mosaics and channels flagged as local (column local, if there)."""
    out = register.where(F.col("name").isin(KEPT) | ~F.col("name").rlike(TECHNICAL))
    return out.where("not coalesce(local, false)") if "local" in register.columns else out


def validate_register(register: DataFrame) -> DataFrame:
    """(name, field, value) of each value outside its domain; null and empty values count as unknown."""
    bad = lambda c, ok: F.when((F.coalesce(F.col(c), F.lit("")) != "") & ~ok, F.struct(F.lit(c).alias("field"), F.col(c).alias("value")))
    rules = [bad("country", F.col("country").isin(COUNTRIES)), bad("free", F.col("free").isin(FREE)), bad("category", F.col("category").isin(CATEGORIES)), bad("created", F.col("created").rlike(DATE)), bad("ended", F.col("ended").rlike(DATE))]
    return register.select("name", F.explode(F.array_compact(F.array(*rules))).alias("v")).select("name", "v.*")


def rename_lineage(register: DataFrame) -> DataFrame:
    """(name, root, depth): back along predecessors; a name on a cycle, or whose predecessors lead into one, is its own root with depth null.

    Each round doubles the step, and is written before the next one joins it with itself. It ends when every name has
    arrived, or when steps are longer than there are names, so that what is left goes in circles.
    """
    step = register.select("name", F.nullif(F.col("predecessor"), F.lit("")).alias("up")).dropDuplicates(["name"])
    names = step.select(F.col("name").alias("known"))
    depth = F.when(F.col("up").isNull(), 0).otherwise(1)
    jump = cut(step.join(names, F.col("up") == F.col("known"), "left").select("name", F.coalesce("up", "name").alias("root"), depth.alias("depth"), F.col("known").isNotNull().alias("under_way")))
    count, hops = jump.count(), 1
    while hops <= count and not jump.where("under_way").isEmpty():
        far = jump.select(F.col("name").alias("mid"), F.col("root").alias("root2"), F.col("depth").alias("depth2"), F.col("under_way").alias("under_way2"))
        next_ = jump.where("under_way").join(far, F.col("root") == F.col("mid")).select("name", F.col("root2").alias("root"), (F.col("depth") + F.col("depth2")).alias("depth"), F.col("under_way2").alias("under_way"))
        jump = cut(jump.where("not under_way").unionByName(next_))
        hops *= 2
    loop = F.col("under_way")
    return jump.select("name", F.when(loop, F.col("name")).otherwise(F.col("root")).alias("root"), F.when(~loop, F.col("depth")).alias("depth"))


def rename_continuity(register: DataFrame) -> DataFrame:
    """(name, predecessor, gap_days) where a predecessor (ended_on) doesn't end the day before its successor starts (created_on); below 0 they overlap."""
    old = register.select(F.col("name").alias("old"), F.col("ended_on").alias("old_end"))
    gap = F.datediff("created_on", "old_end") - 1
    return register.join(old, F.col("predecessor") == F.col("old")).select("name", "predecessor", gap.alias("gap_days")).where("gap_days <> 0")


def duplicate_names(register: DataFrame) -> DataFrame:
    return register.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
