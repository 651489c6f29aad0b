"""Readings of a display: glyph rows (frame, x, w, label, score) to fields, times and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def split_fields(glyphs: DataFrame, key: list[str], gap: int = 80, x: str = "x", w: str = "w", out: str = "field") -> DataFrame:
    """Number the fields of a frame from 0; a gap of more than ``gap`` pixels begins a new one."""
    along = Window.partitionBy(*key).orderBy(x)
    new = F.coalesce((F.col(x) - (F.lag(F.col(x) + F.col(w)).over(along)) > gap).cast("int"), F.lit(0))
    return glyphs.withColumn("_new", new).withColumn(out, F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")


def read_times(glyphs: DataFrame, key: list[str], points: str, least: float = 0.8) -> DataFrame:
    """Each field's centre and value: three sure digits with a decimal point (an array of abscissas, constant for a key) between the first two; else null."""
    fields = split_fields(glyphs, key).groupBy(*key, "field").agg(F.sort_array(F.collect_list(F.struct("x", "w", "label", "score"))).alias("g"), F.first(points, ignorenulls=True).alias("_p"))
    g = F.col("g")
    first, second, last = g[0], F.get(g, F.lit(1)), F.element_at(g, -1)
    sure = (F.size(g) == 3) & F.forall(g, lambda d: (d["label"] != "x") & (d["score"] >= least))
    point = F.exists(F.coalesce("_p", F.array().cast("array<int>")), lambda d: (d >= first["x"] + first["w"]) & (d <= second["x"]))
    value = F.when(sure & point, F.array_join(F.transform(g, lambda d: d["label"]), "").try_cast("int") / F.lit(100.0))
    return fields.select(*key, "field", F.floor((first["x"] + last["x"] + last["w"]) / 2).cast("int").alias("x"), value.alias("value"))


def read_bib(glyphs: DataFrame, key: list[str], gap: int = 10, least: float = 0.8) -> DataFrame:
    """The digits after the first word gap, joined; null if one is unsure.  A label may hold several digits."""
    words = split_fields(glyphs, key, gap, out="word").where("word > 0")
    bib = words.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("x", "label", "score"))).alias("g"))
    sure = F.forall("g", lambda d: (d["label"] != "x") & (d["score"] >= least))
    return bib.select(*key, F.when(sure, F.array_join(F.transform("g", lambda d: d["label"]), "")).alias("bib"))


def keep_timed_frames(glyphs: DataFrame, points: DataFrame, key: list[str]) -> DataFrame:
    """Glyphs of frames that show a decimal point."""
    return glyphs.join(points.select(*key).distinct(), key, "left_semi")


def label_prototypes(prototypes: DataFrame, labels: DataFrame, number: str = "number") -> DataFrame:
    """Labels go to prototypes by number; prototypes without one are dropped."""
    return prototypes.join(labels, number)


def largest_clusters(clusters: DataFrame, vectors: DataFrame, order: str, vector: str, most: int = 96) -> DataFrame:
    """The prototypes of the largest clusters (of equals, the first), numbered from 0."""
    sizes = clusters.groupBy("cluster", "leader").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "cluster").limit(most)
    ranked = sizes.withColumn("number", F.row_number().over(Window.orderBy(F.col("n").desc(), "cluster")) - 1)
    return ranked.join(vectors.select(F.col(order).alias("leader"), vector), "leader").select("number", "cluster", "n", vector)


def update_field(records: DataFrame, new: DataFrame, key: list[str], field: str) -> DataFrame:
    """Records with one field computed anew where there is a new value for it; the rest as it was, and no new records."""
    fresh = new.select(*key, F.col(field).alias("_new"), F.lit(True).alias("_has"))
    return records.join(fresh, key, "left").withColumn(field, F.when(F.col("_has"), F.col("_new")).otherwise(F.col(field))).drop("_new", "_has")
