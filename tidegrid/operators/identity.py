"""Who is who: duplicates across sources, attempts, status and the split by entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cross_source_duplicates(df: DataFrame, key: list[str], source: str, order: list[str], out: str = "duplicate") -> DataFrame:
    """True for rows from another source than the first row with the key; rows with a null in the key are duplicates, too."""
    first = F.first(source, ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return df.withColumn(out, F.when(missing, True).otherwise(F.coalesce(F.col(source) != first, F.lit(True))))


def attempts(df: DataFrame, entity: str, order: list[str], eligible: Column, out: str = "attempt") -> DataFrame:
    """Number each entity's eligible rows from 1; null for the others."""
    df = df.withColumn("_ok", eligible & F.col(entity).isNotNull())
    return df.withColumn(out, F.when(F.col("_ok"), F.row_number().over(Window.partitionBy(entity, "_ok").orderBy(*order)))).drop("_ok")


def status(excluded: Column, duplicate: Column, passed: Column) -> Column:
    return F.when(excluded, "excluded").when(duplicate, "duplicate").when(passed, "ok").otherwise("rejected")


def stratified_split(entities: DataFrame, entity: str, stratum: str, within: str, seed: int = 2026, out: str = "split", method: str = "hash") -> DataFrame:
    """Entities in turn to train and test within a stratum, in the order of ``within`` and a seeded hash.

    No entity is on both sides, and the sides of a stratum differ by one at most.  ``md5`` gives an order that other engines can repeat."""
    shuffle = F.xxhash64(F.col(entity), F.lit(seed)) if method == "hash" else F.md5(F.concat(F.col(entity).cast("string"), F.lit(f":{seed}")).cast("binary"))
    turn = F.row_number().over(Window.partitionBy(stratum).orderBy(within, shuffle, entity))
    return entities.withColumn(out, F.when(turn % 2 == 1, "train").otherwise("test"))


def representatives(df: DataFrame, entity: str, order: list[str], *columns: str) -> DataFrame:
    """The first row of each entity, without a sort: the smallest by ``order``."""
    return df.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_r")).select(entity, *(f"_r.{c}" for c in columns))


def map_split(df: DataFrame, entities: DataFrame, entity: str, out: str = "split") -> DataFrame:
    """Put the entities' split on every row of theirs, whatever its status."""
    return df.join(entities.select(entity, out), entity, "left")


def sequential_ids(df: DataFrame, key: str, order: list[str], digits: int = 3, out: str = "run_id") -> DataFrame:
    number = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    return df.withColumn(out, F.concat(F.col(key).cast("string"), F.lit("_"), F.when(F.length(number.cast("string")) >= digits, number.cast("string")).otherwise(F.lpad(number.cast("string"), digits, "0"))))


def head_n(df: DataFrame, key: list[str], order: list[str], n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("_r") <= n).drop("_r")
