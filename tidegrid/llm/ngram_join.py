"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

A document is the set of its word n-grams.  Documents with equal sets are one class, so that copies are never paired.  In what is
shuffled a class goes by 64 bits of its fingerprint, and equal sets by all 128.  N-grams are ordered rare first by a table of counts over all documents: ``BUCKETS`` counters
indexed by the n-gram's hash, which has a fixed size, is added up in a tree and is all that is broadcast by default.  The order
only has to be the same everywhere for the result to be exact; collisions make it less selective.
A class sends its prefix, of size - ceil(threshold * size) + 1 n-grams; two sets that are similar enough share one of them.

Pairs are made in two rounds, so that a group of near copies doesn't expand into all of its pairs:

1. In each prefix n-gram's group every class meets only the group's leader (the one that has the n-gram earliest:
   the fewest n-grams of its own).  Pairs that pass the length, positional and suffix filters are verified,
   and links are joined into components.
2. In groups that still hold several components, the classes outside the group's largest one meet the classes of other
   components that are near them in size, by the same filters.  No pair between components goes untested, so that components are exact.

The suffix filter compares histograms of the sets over ranges of hashes: their distance can't exceed the
symmetric difference that the threshold allows.  Verification counts the n-grams that two whole texts share.

Defined results: null and empty texts and texts without words have an empty set and are linked with nothing; a text of fewer words
than n has its whole sequence as its one n-gram; repeated rows get equal results; a null id counts as smaller than
any other and stays null as a component; an empty table gives an empty result.  Of equal ranks in the rare-first order the smaller hash
comes first, and of equal leaders the smaller class.  Of a very long text, some 100 bytes a word are held; no more of it than of others is
compared.  Ids must be whole numbers or cast to one.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from fractions import Fraction
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import graph, runtime, textcore

BUCKETS = 1 << 20
BINS = 32
#: Up to so many ids, those whose texts are needed are broadcast; beyond, texts are joined by a shuffle.
BROADCAST_IDS = 200_000
LEAST = -(1 << 63)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct n-grams as (hash, text), sorted by text and hash."""
    words = textcore.Words(textcore.LOWER[data], offsets)
    hashes = words.hashes()
    keys, text = textcore.windows(hashes, words.first, n)
    many = np.diff(words.first)
    short = np.flatnonzero((many > 0) & (many < n))
    if len(short):
        whole = np.empty(len(short), np.uint64)
        for i, t in enumerate(short):
            part = hashes[words.first[t] : words.first[t + 1]]
            total = np.uint64(len(part))
            for k, h in enumerate(part):
                total = np.uint64((int(total) * int(textcore.MIX[0]) + int(h) + k) & ((1 << 64) - 1))
            whole[i] = total
        keys, text = np.concatenate((keys, textcore.mix(whole))), np.concatenate((text, short))
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[new], text[new]


def segment_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)))
    return total[edges[1:]] - total[edges[:-1]]


def fingerprints(keys: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Size, two 64-bit sums over the set, and the histogram over hash ranges."""
    edges = np.searchsorted(text, np.arange(n_texts + 1))
    size = np.diff(edges)
    one = segment_sums(textcore.mix(keys), edges)
    two = segment_sums(textcore.mix(keys * textcore.MIX[3] + textcore.MIX[2]), edges)
    bins = np.bincount(text * BINS + (keys >> np.uint64(59)).astype(np.int64), minlength=n_texts * BINS)
    return size, one.view(np.int64), two.view(np.int64), np.minimum(bins, 65535).astype(np.uint16).reshape(n_texts, BINS)


def slot(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(16)).astype(np.int64) & (BUCKETS - 1)


A_SCHEMA = "_id bigint, _th bigint, size bigint, c bigint, c2 bigint, bins binary, block int, salt int, payload binary"


def survey(n: int):
    """A row for each document, and the partition's counts in blocks."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        counts, seen = np.zeros(BUCKETS, np.int64), False
        for batch in batches:
            data, offsets = textcore.column_bytes(batch.column(2))
            parts = []
            for i, j in textcore.chunks(offsets):
                keys, text = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                np.add.at(counts, slot(keys), 1)
                parts.append(fingerprints(keys, text, j - i))
                seen = True
            if parts:
                size, one, two, bins = (np.concatenate(x) for x in zip(*parts, strict=True))
                none = pa.nulls(batch.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size.astype(np.int64)), pa.array(one), pa.array(two), pa.array([x.tobytes() for x in bins], pa.binary()), none, none, pa.nulls(batch.num_rows, pa.binary())], names=["_id", "_th", "size", "c", "c2", "bins", "block", "salt", "payload"])
        if seen:
            salt = (TaskContext.get().partitionId() if TaskContext.get() else 0) % 64
            blocks = runtime.pack(counts)
            none = pa.nulls(len(blocks), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, none, pa.nulls(len(blocks), pa.binary()), pa.array([b for b, _ in blocks], pa.int32()), pa.array([salt] * len(blocks), pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names=["_id", "_th", "size", "c", "c2", "bins", "block", "salt", "payload"])

    return run


def prefixes(n: int, threshold: Fraction, counts):
    """(n-gram, class, size, position) for each class's rarest n-grams."""

    def run(batches):
        import pyarrow as pa

        table = counts.value
        for batch in batches:
            data, offsets = textcore.column_bytes(batch.column(0))
            for i, j in textcore.chunks(offsets):
                keys, text = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                size, one, _, _ = fingerprints(keys, text, j - i)
                order = np.lexsort((keys, table[slot(keys)], text))
                keys, text = keys[order], text[order]
                position = np.arange(len(keys)) - np.searchsorted(text, text)
                length = size - -(-threshold.numerator * size // threshold.denominator) + 1
                some = position < length[text]
                at = text[some]
                yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(one[at]), pa.array(size[at].astype(np.int32)), pa.array(position[some].astype(np.int32))], names=["gram", "c", "size", "at"])

    return run


def needed(size_a: Column, size_b: Column, threshold: Fraction) -> Column:
    """The fewest shared n-grams of sets of these sizes."""
    up, down = threshold.numerator, threshold.numerator + threshold.denominator
    return F.ceil((size_a.cast("long") + size_b.cast("long")) * F.lit(up) / F.lit(down) - F.lit(1e-9))


def may_link(a: str, b: str, threshold: Fraction) -> Column:
    """Length and positional filters for a shared n-gram (exact at the first one that a pair shares)."""
    size_a, size_b, at_a, at_b = (F.col(f"{x}_{k}") for k in ("size", "at") for x in (a, b))
    return F.least(size_a - at_a, size_b - at_b) >= needed(size_a, size_b, threshold)


def suffix_filter(threshold: Fraction):
    """Drop pairs whose histograms are further apart than the symmetric difference may be."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            a, b = (np.frombuffer(b"".join(column[x].to_pylist()), np.uint16).reshape(-1, BINS).astype(np.int64) for x in ("a_bins", "b_bins"))
            size = column["a_size"].to_numpy() + column["b_size"].to_numpy()
            least = -(-threshold.numerator * size // (threshold.numerator + threshold.denominator))
            keep = np.abs(a - b).sum(1) <= size - 2 * least
            some = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([some.column(some.schema.names.index(x)) for x in PAIR], names=PAIR)

    return run


PAIR = ["a", "b", "a_id", "a_th", "b_id", "b_th"]


def verify(n: int, threshold: Fraction):
    """Pairs of whole texts whose sets are similar enough."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sides = [textcore.column_bytes(batch.column(k)) for k in (2, 3)]
            both = sides[0][1] + sides[1][1]
            keep = np.zeros(batch.num_rows, bool)
            for i, j in textcore.chunks(both):
                sets = [shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n) for data, offsets in sides]
                size = sum(np.bincount(text, minlength=j - i) for _, text in sets)
                keys, text = (np.concatenate([s[k] for s in sets]) for k in (0, 1))
                order = np.lexsort((keys, text))
                keys, text = keys[order], text[order]
                twice = (keys[1:] == keys[:-1]) & (text[1:] == text[:-1])
                shared = np.bincount(text[1:][twice], minlength=j - i)
                keep[i:j] = (shared > 0) & (threshold.denominator * shared >= threshold.numerator * (size - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    return run


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: Fraction | float = Fraction(4, 5)) -> tuple[DataFrame, DataFrame]:
    """Membership and links.

    Membership has a row for each document: its id, _th (a hash of its text), n_shingles, class (a number for equal sets)
    and component_id (the smallest id that links reach, its own included).  Links are pairs (a, b) of classes
    whose sets are at least ``threshold`` similar; within what links already connect, not all pairs are listed.
    """
    runtime.prepare(docs, __name__, textcore.__name__, runtime.__name__)
    spark, threshold = docs.sparkSession, Fraction(threshold).limit_denominator(10_000)
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST)).alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")).withColumn("_th", F.xxhash64("_text"))
    found = runtime.settle(rows.select("_id", "_th", "_text").mapInArrow(survey(n), A_SCHEMA))
    counts = spark.sparkContext.broadcast(runtime.add_arrays(found.where("block IS NOT NULL").select("block", "salt", "payload"), BUCKETS, "int64"))
    own = found.where("block IS NULL").select("_id", "_th", "size", "c", "c2", "bins")
    classes = own.where("size > 0").groupBy("c").agg(F.min(F.struct("_id", "_th", "size", "bins")).alias("r")).select("c", "r._id", "r._th", "r.size", "r.bins")

    prefix = rows.select("_text").mapInArrow(prefixes(n, threshold, counts), "gram bigint, c bigint, size int, at int")
    # A count alone travels first; what is known of a group's members is gathered once n-grams that occur in one place are gone.
    # Both tables are written out, so that joins come straight from a shuffle: only then can a hot n-gram's rows be split among tasks.
    often = runtime.settle(prefix.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    places = runtime.settle(prefix.join(often.hint("merge"), "gram").distinct())
    leads = places.groupBy("gram").agg(F.min("c").alias("_low"), F.max("c").alias("_high"), F.min(F.struct("at", "size", "c")).alias("lead")).where("_low <> _high").select("gram", F.col("lead.c").alias("l_c"), F.col("lead.size").alias("l_size"), F.col("lead.at").alias("l_at"))
    shared = runtime.settle(places.join(runtime.settle(leads).hint("merge"), "gram"))

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that are similar enough."""
        sides = [classes.select(F.col("c").alias(x), *(F.col(k).alias(f"{x}_{k.lstrip('_')}") for k in ("_id", "_th", "size", "bins"))) for x in ("a", "b")]
        pairs = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "a_id", "a_th", "b_id", "b_th", "a_size", "b_size", "a_bins", "b_bins")
        pairs = runtime.settle(pairs.mapInArrow(suffix_filter(threshold), "a bigint, b bigint, a_id bigint, a_th bigint, b_id bigint, b_th bigint"))
        wanted = runtime.settle(pairs.select(F.explode(F.array(F.struct(F.col("a_id").alias("_id"), F.col("a_th").alias("_th")), F.struct(F.col("b_id").alias("_id"), F.col("b_th").alias("_th")))).alias("w")).select("w.*").distinct())
        small = wanted.count() <= BROADCAST_IDS
        texts = rows.join(F.broadcast(wanted) if small else wanted.hint("merge"), ["_id", "_th"]).select("_id", "_th", "_text")
        side = lambda x: texts.select(F.col("_id").alias(f"{x}_id"), F.col("_th").alias(f"{x}_th"), F.col("_text").alias(f"{x}_text"))
        whole = pairs.join(side("a").hint("merge"), ["a_id", "a_th"]).join(side("b").hint("merge"), ["b_id", "b_th"]).select("a", "b", "a_text", "b_text")
        return whole.mapInArrow(verify(n, threshold), "a bigint, b bigint").distinct()

    def ordered(x: Column, y: Column) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    # Round 1: each class and the leader of the group.
    first = shared.withColumnsRenamed({"c": "x_c", "size": "x_size", "at": "x_at", "l_c": "y_c", "l_size": "y_size", "l_at": "y_at"})
    first = runtime.settle(first.where("x_c <> y_c").where(may_link("x", "y", threshold)).select(*ordered(F.col("x_c"), F.col("y_c"))).distinct())
    links = runtime.settle(linked(first))
    part = graph.components(links)

    # Round 2: what groups still hold of several components.
    member = shared.select("gram", "c", "size", "at").join(part.withColumnRenamed("node", "c"), "c", "left").withColumn("part", F.coalesce("component", "c")).drop("component")
    parts = member.groupBy("gram", "part").agg(F.count("*").alias("many")).groupBy("gram").agg(F.max(F.struct("many", "part")).alias("_m"), F.count("*").alias("_parts")).where("_parts > 1").select("gram", F.col("_m.part").alias("major"))
    member = runtime.settle(member.join(parts, "gram"))
    names = lambda x: {"c": f"{x}_c", "size": f"{x}_size", "at": f"{x}_at", "part": f"{x}_part", "major": f"{x}_major"}
    # Sets that are similar enough have sizes within a factor of the threshold, so that their bands are the same or neighbours: a group of
    # many classes that aren't linked meets only its neighbours in size.
    band = F.floor(F.log(F.col("size").cast("double")) / F.lit(-log(threshold)) + F.lit(1e-9)).cast("int") if threshold < 1 else F.col("size")
    reach = F.explode(F.array(*(F.col("_band") + k for k in ((-1, 0, 1) if threshold < 1 else (0,)))))
    member = member.withColumn("_band", band)
    minor, every = member.where("part <> major").withColumn("_band", reach).withColumnsRenamed(names("x")), member.withColumnsRenamed(names("y"))
    second = minor.join(every.hint("merge"), ["gram", "_band"]).where("x_part <> y_part AND (y_part = y_major OR x_c < y_c)").where(may_link("x", "y", threshold))
    second = second.select(*ordered(F.col("x_c"), F.col("y_c"))).distinct().join(first, ["a", "b"], "left_anti")
    links = runtime.settle(links.union(linked(second)))
    part = graph.components(links)

    # Every class's smallest id, and every component's.
    least = own.where("size > 0").groupBy("c", "c2").agg(F.min("_id").alias("_own"))
    smallest = part.join(least.groupBy("c").agg(F.min("_own").alias("_own")).withColumnRenamed("c", "node"), "node")
    smallest = part.join(smallest.groupBy("component").agg(F.min("_own").alias("_reached")), "component").select(F.col("node").alias("c"), "_reached")
    reached = least.join(smallest, "c", "left").select("c", "c2", F.coalesce("_reached", "_own").alias("_component"))
    member = own.drop("bins").join(reached.hint("merge"), ["c", "c2"], "left")
    real = lambda x: F.when(x != LEAST, x)
    member = member.select(real(F.col("_id")).alias(id_col), "_th", F.col("size").alias("n_shingles"), F.col("c").alias("class"), real(F.coalesce("_component", "_id")).alias("component_id"))
    return member, links


def join_digest(docs: DataFrame) -> DataFrame:
    """The query's columns: 3-word shingles, 90 % similarity."""
    member, _ = similar_documents(docs.select("doc_id", "text"), n=3, threshold=Fraction(9, 10))
    return member.select("doc_id", "n_shingles", "component_id")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: Fraction | float = Fraction(4, 5)) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.  Rows without an id stay, once for each text."""
    member, _ = similar_documents(docs, id_col, text_col, n, threshold)
    gone = member.where(~F.col("component_id").eqNullSafe(F.col(id_col))).select(F.col(id_col).alias("_id"), "_th").distinct()
    own = docs.columns
    # The row travels as a struct, so that no column of the table clashes with one of the operator's.
    tagged = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("_th"))
    kept = tagged.join(gone.hint("merge"), ["_id", "_th"], "left_anti").dropDuplicates(["_id", "_th"])
    return kept.select(*(F.col("_row")[c].alias(c) for c in own))
