"""Mixing sources to target weights by Pareto order sampling.

Native: DataFrame functions only.  A source's share of all words is its weight's share, but no more
than ``max_times`` its own words; what it can't take goes to the others by weight (water filling).
A source's target is so many times its size: every document is taken the whole part of that for certain, and the
words that are still missing come from a sample of its documents without replacement, with unequal probabilities: a document's
inclusion probability is in proportion to its size, and documents for which that is one or more are certain, so that the
words expected are those that are missing.  Documents are ranked by Pareto's key, random odds over inclusion odds.  What is fixed is the
number of words: documents are taken in the order of their keys, and one that is too long for what is missing is passed over, until nothing
fits or at most ``NEAR`` of the target is missing; last comes the one document that brings the source nearest to its target, if any does.

No source is gathered or sorted as a whole: sums over 4096 bands of the key show the band in which the words run out, and only that band's
rows are put in order, up to the first document that doesn't fit; a round goes on behind it with those that do.  Sources are ranked
in ranges of their names.  The table of sources is broadcast only if it has at most ``BROADCAST_SOURCES`` rows.

Defined results: null text has size 0; null sources are one source, ranked last; the random key comes
from the id (a null one counts as a text of its own) and the seed, so that reruns agree; equal keys go by the id as text and the size, and rows that are
equal in all three are taken together or not at all; documents of size 0 are never taken; an empty table gives an empty result; texts are
only counted, however long.  Other columns are kept as they are, but for those that have the names of the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.runtime import settle

WORDS = r"[^\x20\x09-\x0D]+"
BANDS = 4096
BROADCAST_SOURCES = 100_000
#: A source this share of its target away from it is near enough for another document to be sought no more.
NEAR = 0.001


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def random_unit(id_: Column, seed: int) -> Column:
    """In (0, 1), from the id and the seed: 52 bits of an md5."""
    text = F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Sums over all rows up to each row (itself included) in a total order: within ranges of the order, plus the ranges before."""
    spread = df.select("*", *order_columns(order), *(v.alias(f"_v_{k}") for k, v in sums.items()))
    keys = [F.col(f"_o{i}").asc_nulls_last() for i in range(len(order))]
    spread = settle(spread.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = spread.groupBy(F.col("_range").alias("_r")).agg(*(F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums))  # a row for each range
    totals = totals.select("_r", *(F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_b_{k}") for k in sums))
    within = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = spread.join(F.broadcast(totals), F.col("_range") == F.col("_r"))
    return out.select(*df.columns, *((F.col(f"_b_{k}") + F.sum(f"_v_{k}").over(within)).alias(k) for k in sums))


def order_columns(order: list[Column]) -> list[Column]:
    return [c.alias(f"_o{i}") for i, c in enumerate(order)]


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_times: int) -> DataFrame:
    """_source, _source_size, _target: ``weights`` repeat over the sources by code point, null last."""
    per = sizes.groupBy("_source").agg(F.sum("size").alias("_source_size"))
    per = running_sums(per, [F.col("_source")], {"_rank": F.lit(1).cast("long")})
    cycle = F.array(*(F.lit(w) for w in weights))
    per = per.withColumn("_weight", F.element_at(cycle, (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    per = per.withColumn("_cap", F.col("_source_size") * max_times)
    # In the order of cap over weight, all before the first source that isn't full are full.
    per = running_sums(per, [F.col("_cap") / F.col("_weight"), F.col("_rank")], {"_caps": F.col("_cap"), "_weights": F.col("_weight"), "_place": F.lit(1).cast("long")})
    whole = per.agg(F.sum("_source_size").alias("_words"), F.sum("_weight").alias("_all"))
    per = per.crossJoin(F.broadcast(whole))  # one row
    level = (F.col("_words") - (F.col("_caps") - F.col("_cap"))).cast("double") / (F.col("_all") - (F.col("_weights") - F.col("_weight"))).cast("double")
    first = per.where(level * F.col("_weight") <= F.col("_cap")).agg(F.min_by(level, "_place").alias("_level"))
    return per.crossJoin(F.broadcast(first)).select("_source", "_source_size", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight")).alias("_target"))


def inclusion(candidates: DataFrame) -> DataFrame:
    """_source, _certain (the least size that is taken for certain) and _rate: a smaller document's probability is its size times that.

    ``candidates`` has _source, size and _quota, the words that are missing.  Sizes are counted first: a source has few different ones."""
    sizes = candidates.groupBy("_source", "size").agg(F.count("*").alias("_n"), F.max("_quota").alias("_quota"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    down = Window.partitionBy("_source").orderBy(F.col("size").desc())
    larger = down.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_words", wide("size") * wide("_n")).withColumn("_squares", wide("_words") * wide("size"))
    above = F.coalesce(F.sum("_words").over(larger), F.lit(0)).cast("double")
    rest = (F.sum("_squares").over(Window.partitionBy("_source")) - F.coalesce(F.sum("_squares").over(larger), F.lit(0))).cast("double")
    rate = (F.col("_quota") - above) / rest
    sizes = sizes.select("_source", "size", rate.alias("_rate")).where(F.col("_rate") * F.col("size") < 1)
    return sizes.groupBy("_source").agg(F.max(F.struct("size", "_rate")).alias("_first")).select("_source", F.col("_first.size").alias("_last"), F.col("_first._rate").alias("_rate"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = (1, 2, 3), max_times: int = 3, seed: int = 17) -> DataFrame:
    """``docs`` with size, source_size, target (of its source, in words), copies and taken (copies * size)."""
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    # The row travels as a struct, so that no column of the table clashes with one of the operator's.
    facts = [word_count(F.col(f"`{text_col}`")).alias("size"), F.col(f"`{source_col}`").alias("_source"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_tie"), random_unit(F.col(f"`{id_col}`"), seed).alias("_u")]
    thin = settle(docs.select(*facts))  # words are counted once: all that follows needs a few numbers for each document
    targets = settle(source_targets(thin, weights, max_times))
    small = targets.count() <= BROADCAST_SOURCES

    def beside(df: DataFrame, table: DataFrame) -> DataFrame:
        """With the columns of a table that has a row for each source, or none."""
        table = table.withColumnRenamed("_source", "_s")
        return df.join(F.broadcast(table) if small else table, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")

    def wanted(df: DataFrame) -> DataFrame:
        times = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size").cast("double")).otherwise(F.lit(0.0))
        df = beside(df, targets).withColumn("_whole", F.floor(times).cast("long"))
        return df.withColumn("_quota", F.when((times > F.floor(times)) & (F.col("size") > 0), F.col("_target") - (F.col("_whole") * F.col("_source_size")).cast("double")))

    rates = settle(inclusion(wanted(thin).where("_quota IS NOT NULL")))

    def keyed(df: DataFrame) -> DataFrame:
        """With Pareto's key, 0 for certain documents, and the place in the order; null for those that don't compete."""
        df = beside(wanted(df), rates)
        chance = F.col("_rate") * F.col("size")
        key = (F.col("_u") / (F.lit(1.0) - F.col("_u"))) / (chance / (F.lit(1.0) - chance))
        df = df.withColumn("_key", F.when(F.col("_quota").isNull(), None).when(F.col("size") > F.col("_last"), F.lit(0.0)).when(F.col("_rate") > 0, key))
        return df.withColumn("_place", F.when(F.col("_key").isNotNull(), F.struct("_key", "_tie", "size")))

    left = keyed(thin).where("_key IS NOT NULL").select("_source", "_key", "_tie", "size", "_place", F.floor(F.col("_key") / (F.col("_key") + 1) * BANDS).alias("_band"))
    nowhere = F.struct(F.lit(-1.0).alias("_key"), F.lit("").alias("_tie"), F.lit(0).cast("long").alias("size"))
    state = wanted(targets.withColumnsRenamed({"_target": "_t", "_source_size": "_z"}).withColumn("size", F.lit(1))).where("_quota > 0").select("_source", F.col("_quota").alias("_missing"), (F.col("_target") * F.lit(NEAR)).alias("_near"), nowhere.alias("_from"))
    state, rounds, ended = settle(state), None, None
    along = Window.partitionBy("_source").orderBy("_band")
    order = Window.partitionBy("_source").orderBy("_key", "_tie", "size").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    while True:
        # Behind the last document that didn't fit, those that do.
        left = beside(left, state).where((F.col("size") <= F.col("_missing")) & (F.col("_place") > F.col("_from"))).drop("_missing", "_near", "_from")
        left = settle(left)
        bands = left.groupBy("_source", "_band").agg(F.sum("size").alias("_words")).withColumn("_after", F.sum("_words").over(along))
        bands = beside(bands, state.select("_source", "_missing"))
        cut = settle(bands.groupBy("_source").agg(F.min(F.when(F.col("_after") > F.col("_missing"), F.struct("_band", (F.col("_after") - F.col("_words")).alias("_before")))).alias("_cut"), F.max("_after").alias("_all")))
        edge = beside(left, cut.select("_source", "_cut")).where("_band = _cut._band").withColumn("_sum", F.col("_cut._before") + F.sum("size").over(order))
        edge = beside(edge, state.select("_source", "_missing"))
        stop = edge.groupBy("_source").agg(F.min(F.when(F.col("_sum") > F.col("_missing"), F.col("_place"))).alias("_to"), F.max(F.when(F.col("_sum") <= F.col("_missing"), F.col("_sum"))).alias("_got"))
        done = beside(beside(state, cut), stop)
        got = F.when(F.col("_cut").isNull(), F.coalesce("_all", F.lit(0))).otherwise(F.coalesce("_got", F.col("_cut._before")))
        done = settle(done.select("_source", "_missing", "_near", "_from", "_to", (F.col("_missing") - got).alias("_then")))
        taken = done.select("_source", F.struct("_from", "_to", F.col("_missing").alias("_most")).alias("_round"))
        rounds = taken if rounds is None else rounds.unionByName(taken)
        on = (F.col("_to").isNotNull()) & (F.col("_then") > F.col("_near"))
        over = done.where(~on).select("_source", F.col("_then").alias("_missing"))
        ended = over if ended is None else ended.unionByName(over)
        state = done.where(on).select("_source", F.col("_then").alias("_missing"), "_near", F.col("_to").alias("_from"))
        if state.isEmpty():
            break
    rounds = settle(rounds.groupBy("_source").agg(F.collect_list("_round").alias("_rounds")))

    def chosen(df: DataFrame) -> DataFrame:
        df = beside(df, rounds)
        fits = F.exists("_rounds", lambda r: (F.col("_place") > r["_from"]) & (r["_to"].isNull() | (F.col("_place") < r["_to"])) & (F.col("size") <= r["_most"]))
        return df.withColumn("_in", F.coalesce(F.col("_key").isNotNull() & fits, F.lit(False)))

    # The one document more that comes nearest to what is missing, if it comes nearer than none.
    gap = F.abs(F.col("_missing") - F.col("size"))
    extra = chosen(beside(keyed(thin).where("_key IS NOT NULL"), ended)).where(~F.col("_in") & (gap < F.col("_missing"))).groupBy("_source").agg(F.min(F.struct(gap.alias("_gap"), F.col("_place").alias("_more"))).alias("_m"))
    extra = settle(extra.select("_source", F.col("_m._more").alias("_more")))
    sized = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("_row"), *facts)
    out = beside(chosen(keyed(sized)), extra)
    copies = F.when(F.col("size") > 0, F.col("_whole") + (F.col("_in") | F.coalesce(F.col("_place") == F.col("_more"), F.lit(False))).cast("long")).otherwise(F.lit(0)).cast("long")
    return out.select(*(F.col("_row")[c].alias(c) for c in own), "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_digest(docs: DataFrame) -> DataFrame:
    return mix_sources(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT source, source_size, (r - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM s),
l AS (SELECT *, CAST(CAST((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER b, 0) AS BIGINT) AS DOUBLE)
             / CAST(CAST((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS DOUBLE) AS level,
             row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST) AS rank FROM w
      WINDOW b AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (SELECT arg_min(level, rank) FROM l WHERE level * weight <= cap)) AS target FROM l),
k AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / CAST(source_size AS DOUBLE) ELSE 0.0 END AS wanted,
             (CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':17'), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, CAST(floor(wanted) AS BIGINT) AS whole FROM k),
q AS (SELECT *, CASE WHEN wanted > whole AND size > 0 THEN target - CAST(whole * source_size AS DOUBLE) END AS quota FROM p),
z AS (SELECT source, size, max(quota) AS quota, CAST(sum(size) AS HUGEINT) AS words, CAST(sum(CAST(size AS HUGEINT) * size) AS HUGEINT) AS squares FROM q WHERE quota IS NOT NULL GROUP BY ALL),
zr AS (SELECT source, size, (quota - CAST(coalesce(sum(words) OVER b, 0) AS DOUBLE)) / CAST(sum(squares) OVER (PARTITION BY source) - coalesce(sum(squares) OVER b, 0) AS DOUBLE) AS rate
       FROM z WINDOW b AS (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rt AS (SELECT source, arg_max(rate, size) AS rate, max(size) AS last FROM zr WHERE rate * size < 1 GROUP BY source),
ky AS (SELECT q.*, CASE WHEN quota IS NULL THEN NULL WHEN size > last THEN 0.0 WHEN rate > 0 THEN (u / (1.0 - u)) / (rate * size / (1.0 - rate * size)) END AS key
       FROM q LEFT JOIN rt ON q.source IS NOT DISTINCT FROM rt.source),
c AS (SELECT doc_id, source, size, quota, target, key, row_number() OVER (PARTITION BY source ORDER BY key, CAST(doc_id AS VARCHAR), size) AS i FROM ky WHERE key IS NOT NULL),
-- One document after another: taken if it fits what is missing; one that doesn't, but would have after the last such one, ends a round.
g(source, i, missing, most, near, over, took) AS (
  SELECT source, CAST(0 AS BIGINT), any_value(quota), any_value(quota), any_value(target) * 0.001, false, CAST(NULL AS BIGINT) FROM c GROUP BY source
  UNION ALL
  SELECT g.source, c.i, CASE WHEN over OR size > missing THEN missing ELSE missing - size END, CASE WHEN size <= most AND size > missing THEN missing ELSE most END, near,
         over OR (size <= most AND size > missing AND missing <= near), CASE WHEN NOT over AND size <= missing THEN doc_id END
  FROM g JOIN c ON g.source IS NOT DISTINCT FROM c.source AND c.i = g.i + 1),
e AS (SELECT source, arg_min(missing, -i) AS missing FROM g GROUP BY source),
m AS (SELECT c.source, min(ROW(abs(missing - size), key, CAST(doc_id AS VARCHAR), size, doc_id)) AS more FROM c JOIN e ON c.source IS NOT DISTINCT FROM e.source
      WHERE doc_id NOT IN (SELECT took FROM g WHERE took IS NOT NULL) AND abs(missing - size) < missing GROUP BY c.source),
y AS (SELECT took AS doc_id FROM g WHERE took IS NOT NULL UNION SELECT more[5] FROM m)
SELECT q.doc_id, size, source_size, target, CASE WHEN size > 0 THEN size * (whole + (y.doc_id IS NOT NULL)::BIGINT) ELSE 0 END AS taken
FROM q LEFT JOIN y ON q.doc_id = y.doc_id
"""
