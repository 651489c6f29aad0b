"""Suffix-array dedup: byte strings of ``length`` (200) that start at several places of the corpus.

Every stretch of ``length`` bytes is assigned to its anchor, the ``GRAM``-byte string in it with the smallest
hash (the leftmost of equals).  Equal stretches have equal anchors at equal offsets, so that all places of a
repeated string meet under one anchor, whatever documents they are in.  The stretches of one anchor in one place lie in a row
and form a context.  Anchors that occur once are dropped after a count that combines before the shuffle.  Contexts
that are equal as a whole are recognised by their hash (modulo a prime, under an anchor's own 64-bit hash) and never expanded.  For
the others, one copy of each goes to the anchor's task, which builds the suffix array of the contexts by prefix doubling (as far as
``length`` bytes) and their longest previous factors: in suffix order, the previous and the next suffix that start earlier give the
longest earlier match.  Factors of ``length`` bytes are repeats, and what they repeat is their source.  So exact copies of whole contexts
are found by hashes, and all other repeats by factors, but for an anchor with more than ``HOT`` contexts: these don't go to one task, and
their stretches are counted by two hashes modulo a prime, spread over all tasks.  Both ways remove the same bytes.

``keep="first"`` removes later copies, in the order of id, text hash and position; ``keep="none"`` removes every copy.  Strings
are judged on the input, matches never cross documents, and overlapping removals count once.

Defined results: null and empty texts and texts shorter than ``length`` lose nothing; rows that repeat in id and text are copies of
one another and get equal results; a null id counts as smaller than any other; an empty table gives an empty result.  What is left of a
text is bytes, since a cut may fall within a character.  Very long texts are read in overlapping parts, and only the last step holds
one as a whole.  Ids must be whole numbers or cast to one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import runtime, textcore

GRAM = 50
HOT = 20_000
#: Up to so many rows, lists of contexts or ranges are broadcast; beyond, texts are joined by a shuffle.
BROADCAST_ROWS = 200_000
BLOCK = 1 << 16
POSITION = np.uint64((1 << 21) - 1)
LEAST = -(1 << 63)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each position: by doubling, modulo 2**64.  It only picks anchors and brings equal ones together;
    what is under an anchor is compared by bytes or by hashes modulo a prime."""
    step, have, whole = textcore.mix(data.astype(np.uint64) + np.uint64(1)), 1, None
    done = 0
    while have <= GRAM:
        if GRAM & have:  # the next ``have`` bytes of the gram
            part = step[done:]
            whole = part.copy() if whole is None else whole[: len(part)] * textcore.MIX[0] + part[: len(whole)]
            done += have
        step = step[:-have] * textcore.MIX[3] + step[have:] if 2 * have <= GRAM else step
        if 2 * have <= GRAM:
            step ^= step >> np.uint64(29)
        have *= 2
    return textcore.mix(whole[: len(data) - GRAM + 1])


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    out, have = keys, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def contexts(data: np.ndarray, edges: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, anchor's hash, context's hash, first start in the text, number of starts), for texts that lie one after another."""
    none = tuple(np.empty(0, np.int64) for _ in range(5))
    if len(data) < length:
        return none
    sums = textcore.prefix_sums(data)
    hashes = gram_hashes(data)
    at = np.arange(len(hashes))
    least = sliding_min((hashes & ~POSITION) | at.astype(np.uint64), length - GRAM + 1)
    start = np.arange(len(data) - length + 1)
    start = start[start + length <= edges[np.searchsorted(edges, start, "right")]]
    if not len(start):
        return none
    anchor = (least[start] & POSITION).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(start)))
    begin, anchor = start[first], anchor[first]
    context = textcore.mix(textcore.span_hash(sums, begin, begin + many + length - 1) + (anchor - begin).astype(np.uint64) * textcore.MIX[1])
    text = np.searchsorted(edges, begin, "right") - 1
    return text, hashes[anchor].view(np.int64), context.view(np.int64), begin - edges[text], many


def blocks(offsets: np.ndarray, length: int):
    """(first byte, last byte, first text, edges): whole texts of about BLOCK bytes, and long texts in overlapping parts."""
    for i, j in textcore.chunks(offsets, BLOCK):
        a, b = offsets[i], offsets[j]
        if b - a <= BLOCK + length:
            yield a, b, i, offsets[i : j + 1] - a, 0
        else:  # one text, or short ones and a long one
            for k in range(i, j):
                for s in range(0, max(1, offsets[k + 1] - offsets[k] - length + 1), BLOCK):
                    e = min(offsets[k + 1], offsets[k] + s + BLOCK + length - 1)
                    yield offsets[k] + s, e, k, np.array([0, e - offsets[k] - s]), s


def find_contexts(length: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = textcore.column_bytes(batch.column(2))
            for a, b, first, edges, shift in blocks(offsets, length):
                text, anchor, context, start, many = contexts(data[a:b], edges, length)
                row = pa.array(text + first)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(anchor), pa.array(context), pa.array((start + shift).astype(np.int32)), pa.array(many.astype(np.int32))], names=["_id", "_th", "anchor", "context", "start", "many"])

    return run


def cut_contexts(length: int):
    """The bytes of the contexts that a text's list names."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = textcore.column_bytes(batch.column(2))
            lists = batch.column(3)
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            field = {name: flat.field(name) for name in ("anchor", "context", "start", "many", "copies")}
            begin = offsets[row] + field["start"].to_numpy()
            end = begin + field["many"].to_numpy() + length - 1
            cut = [data[x:y].tobytes() for x, y in zip(begin, end, strict=True)]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays([field["anchor"], batch.column(0).take(rows), batch.column(1).take(rows), field["start"], field["many"], field["copies"], pa.array(cut, pa.binary())], names=["anchor", "_id", "_th", "start", "many", "copies", "cut"])

    return run


def nearest_smaller(order: np.ndarray) -> np.ndarray:
    """For each place of a sequence, the last place before it with a smaller value (-1 if there is none).

    All places skip larger values at once, by the pointers of the place that they point to, in logarithmically many rounds."""
    to = np.arange(-1, len(order) - 1)
    left = np.flatnonzero(to >= 0)
    while len(left):
        left = left[order[to[left]] > order[left]]
        to[left] = to[to[left]]
        left = left[to[left] >= 0]
    return to


def common_prefixes(joined: np.ndarray, levels: list[tuple[int, np.ndarray]], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many bytes the strings at two positions share, as far as the last level's size: by the ranks of the sizes, and then by bytes."""
    whole, ranks = levels[-1]
    out = np.where(ranks[one] == ranks[other], whole, 0)
    left = np.flatnonzero(out < whole)
    for size, ranks in levels[-2::-1]:
        out[left[ranks[one[left] + out[left]] == ranks[other[left] + out[left]]]] += size
    for _ in range(levels[0][0] - 1):
        left = left[joined[one[left] + out[left]] == joined[other[left] + out[left]]]
        out[left] += 1
    return out


def longest_previous_factors(joined: np.ndarray, levels: list[tuple[int, np.ndarray]], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start (ascending): the length of the longest string there that also begins at an earlier start, and which one
    (-1 if there is none).

    Of the earlier starts, the one with the longest common prefix is, in suffix order, the last one before it or the first one
    after it that is earlier in the text."""
    n = len(starts)
    suffix = np.argsort(levels[-1][1][starts], kind="stable")  # the suffix array; equal strings in the order of their positions
    length, source = np.zeros(n, np.int64), np.full(n, -1)
    for near in (nearest_smaller(suffix), n - 1 - nearest_smaller(suffix[::-1])[::-1]):
        some = np.flatnonzero((near >= 0) & (near < n))
        one, other = suffix[some], suffix[near[some]]
        common = common_prefixes(joined, levels, starts[one], starts[other])
        longer = common > length[one]
        length[one[longer]], source[one[longer]] = common[longer], other[longer]
    return length, source


def ranks_by_doubling(joined: np.ndarray, n: int, length: int) -> list[tuple[int, np.ndarray]]:
    """The ranks of the strings of 8, 16, 32 ... and ``length`` bytes at the first n positions; ``joined`` has 8 bytes more."""
    rank = np.unique(np.ndarray((n,), np.dtype(">u8"), joined, 0, (1,)).astype(np.uint64), return_inverse=True)[1].astype(np.uint32)
    levels = [(8, rank)]
    while levels[-1][0] < length:
        have, rank = levels[-1]
        step = min(have, length - have)
        further = np.zeros(n, np.uint64)
        further[: n - step] = rank[step:]
        levels.append((have + step, np.unique((rank.astype(np.uint64) << np.uint64(32)) | further, return_inverse=True)[1].astype(np.uint32)))
    return levels


def factors(texts: list[bytes], many: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the first ``many`` positions of each text: whether the string of ``length`` bytes there also starts earlier in
    the list, whether it starts anywhere else, and the texts' first positions.

    It starts earlier if the longest previous factor there has ``length`` bytes, and later if it is the source of one that has."""
    sizes = np.array([len(t) for t in texts])
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    joined = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    starts = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    lpf, source = longest_previous_factors(joined, ranks_by_doubling(joined, len(joined) - 8, length), starts)
    earlier = lpf >= length
    twice = earlier.copy()
    twice[source[earlier]] = True
    return earlier, twice, np.concatenate(([0], np.cumsum(many)))


def runs(flags: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first, number) of the runs of true flags within parts."""
    on = np.flatnonzero(flags)
    if not len(on):
        return on, on, on
    part = np.searchsorted(edges, on, "right") - 1
    new = np.ones(len(on), bool)
    new[1:] = (on[1:] != on[:-1] + 1) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    return part[first], on[first] - edges[part[first]], np.diff(np.append(first, len(on)))


def repeated_in_anchors(length: int, keep_first: bool):
    """Ranges of repeated starts, from rows in the order of their anchors; a group may span batches."""

    def emit(rows):
        import pyarrow as pa

        many = np.array([r[4] for r in rows])
        earlier, twice, edges = factors([r[6] for r in rows], many, length)
        part, first, number = runs(earlier if keep_first else twice, edges)
        # Copies of a context go as a whole elsewhere, if none is to be kept.
        some = np.array([keep_first or rows[k][5] == 1 for k in part], bool)
        part, first, number = part[some], first[some], number[some]
        return pa.RecordBatch.from_arrays([pa.array([rows[k][1] for k in part], pa.int64()), pa.array([rows[k][2] for k in part], pa.int64()), pa.array(np.array([rows[k][3] for k in part], np.int32) + first.astype(np.int32), pa.int32()), pa.array(number.astype(np.int32))], names=["_id", "_th", "start", "many"])

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if size >= BLOCK and row[0] != rows[-1][0]:
                    yield emit(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[6])
        if rows:
            yield emit(rows)

    return run


def window_hashes(length: int):
    """128 bits for each start of a context, for anchors with very many contexts."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, hashes, starts, one, two = batch.column(1), batch.column(2), batch.column(3).to_numpy(), batch.column(4).to_numpy(), batch.column(6)
            data, offsets = textcore.joined_bytes(two.to_pylist())
            for i, j in textcore.chunks(offsets):
                part, base = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                sums, other = textcore.prefix_sums(part), textcore.prefix_sums(part[::-1])
                many = one[i:j]
                row = np.repeat(np.arange(j - i), many)
                nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                at = base[row] + nth
                h1 = textcore.span_hash(sums, at, at + length)
                h2 = textcore.span_hash(other, len(part) - at - length, len(part) - at)
                rows = pa.array(row + i)
                yield pa.RecordBatch.from_arrays([ids.take(rows), hashes.take(rows), pa.array((starts[row + i] + nth).astype(np.int32)), batch.column(5).take(rows), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=["_id", "_th", "start", "copies", "h1", "h2"])

    return run


def cut_texts(length: int):
    """Counts and what is left of texts, given the ranges of starts to remove."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = textcore.column_bytes(batch.column(1))
            lists = batch.column(2)
            kept, removed, spans = [], [], []
            for k in range(batch.num_rows):
                own = data[offsets[k] : offsets[k + 1]]
                ranges = lists[k].as_py() or []
                step = np.zeros(len(own) + 1, np.int64)
                for r in ranges:
                    step[r["start"]] += 1
                    step[min(len(own), r["start"] + r["many"] + length - 1)] -= 1
                gone = np.cumsum(step[:-1]) > 0
                kept.append(own[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=["_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def repeated_ranges(rows: DataFrame, length: int, keep: str, hot: int = HOT) -> DataFrame:
    """(_id, _th, start, many): the starts of strings to remove; ``rows`` has _id, _th and _text."""
    found = rows.mapInArrow(find_contexts(length), "_id bigint, _th bigint, anchor bigint, context bigint, start int, many int")
    often = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high")).where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("several"))
    # Written out, so that both sides of the join come straight from a shuffle: only then can a hot anchor's rows be split among tasks.
    often = runtime.settle(often)
    hits = runtime.settle(found.join(often.hint("merge"), "anchor"))
    each = runtime.settle(hits.groupBy("anchor", "context").agg(F.count("*").alias("copies"), F.first("several").alias("several"), F.min(F.struct("_id", "_th", "start", "many")).alias("r")))
    each = each.select("anchor", "context", F.col("copies").cast("int").alias("copies"), "several", "r.*")
    # Contexts with copies.
    copied = each.where("copies > 1").select("anchor", "context", *(F.col(c).alias(f"r{c}") for c in ("_id", "_th", "start")))
    whole = hits.join(copied.hint("merge"), ["anchor", "context"])
    if keep == "first":
        whole = whole.where("NOT (_id = r_id AND _th = r_th AND start = rstart)")
    whole = whole.select("_id", "_th", "start", "many")
    # Contexts that differ under one anchor: one copy each.
    differ = each.where("several")
    lists = differ.groupBy("_id", "_th").agg(F.collect_list(F.struct("anchor", "context", "start", "many", "copies")).alias("list"))
    few = differ.count() <= BROADCAST_ROWS
    cut = rows.dropDuplicates(["_id", "_th"]) if not few else rows
    cut = cut.join(F.broadcast(lists) if few else lists.hint("merge"), ["_id", "_th"]).select("_id", "_th", "_text", "list").mapInArrow(cut_contexts(length), "anchor bigint, _id bigint, _th bigint, start int, many int, copies int, cut binary")
    sizes = differ.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor")
    crowded = runtime.settle(sizes)
    if crowded.isEmpty():
        usual, many = cut, None
    else:
        usual, many = cut.join(crowded, "anchor", "left_anti"), cut.join(crowded, "anchor", "left_semi")
    order = usual.select("anchor", "_id", "_th", "start", "many", "copies", "cut").distinct() if few else usual.select("anchor", "_id", "_th", "start", "many", "copies", "cut")
    grouped = order.repartition("anchor").sortWithinPartitions("anchor", "_id", "_th", "start")
    out = whole.union(grouped.mapInArrow(repeated_in_anchors(length, keep == "first"), "_id bigint, _th bigint, start int, many int"))
    if many is not None:
        starts = many.select("anchor", "_id", "_th", "start", "many", "copies", "cut").mapInArrow(window_hashes(length), "_id bigint, _th bigint, start int, copies int, h1 bigint, h2 bigint").distinct()
        twice = starts.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("_id", "_th", "start")).alias("r")).where("n > 1").drop("n")
        starts = starts.join(twice.hint("merge"), ["h1", "h2"])
        starts = starts.where("NOT (_id = r._id AND _th = r._th AND start = r.start)" if keep == "first" else "copies = 1")
        out = out.union(starts.select("_id", "_th", "start", F.lit(1).alias("many")))
    return out


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, keep: str = "first", hot: int = HOT) -> DataFrame:
    """The id, n_bytes, n_removed, n_spans and ``kept`` (the bytes that are left) of each document."""
    if keep not in ("first", "none") or length <= GRAM:
        raise ValueError(f"keep is 'first' or 'none', and length more than {GRAM}")
    runtime.prepare(docs, __name__, textcore.__name__)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST)).alias("_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text")).withColumn("_th", F.xxhash64("_text")).select("_id", "_th", "_text")
    ranges = runtime.settle(repeated_ranges(rows, length, keep, hot).groupBy("_id", "_th").agg(F.collect_set(F.struct("start", "many")).alias("ranges")))
    few = (ranges.agg(F.sum(F.size("ranges"))).first()[0] or 0) <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(ranges) if few else ranges.hint("merge"), ["_id", "_th"], "left")
    out = joined.select("_id", "_text", "ranges").mapInArrow(cut_texts(length), "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.select(F.when(F.col("_id") != LEAST, F.col("_id")).cast(kind).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


def substring_digest(docs: DataFrame) -> DataFrame:
    """The query's columns: every copy goes."""
    return dedup_substrings(docs.select("doc_id", "text"), keep="none").select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
